"""Quality rules with robust multivariate outliers: minimum-covariance-determinant (MCD) estimates per language and
source, and rejection of transformed statistic vectors by Mahalanobis distance.

The MCD is found by concentration steps over all rows of all groups at once, from several fixed starts: a step takes, per
group and start, the half of the rows that is nearest to the present estimate (its bound comes from a histogram of all
distances) and estimates anew. A start goes on for as long as its determinant falls, and the estimate of a group is that of
the start with the smallest one. A step is two passes over a thin table and small group-bys; estimates are broadcast only
where they are counted to be few, and else meet rows that are dealt over salts, so a hot group costs no more than its rows.
Nothing is sampled.

Defined results: a null text counts as empty (no words, base_failed). Null lang or source form groups of their own.
Groups with fewer than ``small`` rows that passed the base rules take the estimate of their language, and languages as
small that of the whole table (column ``estimate`` says which judged a row: pair, lang, all or none); where even that is too
small, nothing is rejected beyond the base rules. Rows are judged one by one, so repeated rows and ties are judged alike. A
very long text is counted whole; it takes some 60 times its bytes in a worker for a moment. An empty table gives an empty
one. Other columns are ignored by :func:`mcd_outliers` and kept by :func:`drop_outliers`, whatever their names.
"""

from __future__ import annotations

import functools
import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import bytewords as bw
from .shared import Workspace, renamed

SYMBOLS = b"#*$%&|<>"
IS_SYMBOL = np.zeros(256, dtype=bool)
IS_SYMBOL[list(SYMBOLS)] = True
_KIND = np.zeros(256, dtype=np.uint8)  # 1 letter or part of one, 2 upper-case letter, 3 digit, 4 other mark
_KIND[33:128] = 4
_KIND[65:91] = 2
_KIND[97:123] = 1
_KIND[48:58] = 3
_KIND[128:] = 1

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: The vector of a text: mean word length, and shares of marks, capitals, digits, distinct words, repeated lines and words.
FEATURES = ("word_len", "marks", "upper", "digits", "distinct", "dup_lines", "repeats")
#: Half-weight, in words, of a typical text that each share is mixed with, so that short texts have no wild shares.
PRIOR_WORDS = 60.0
TYPICAL = np.array([5.0, 0.20, 0.10, 0.01, 0.75, 0.0, 0.0])
#: Least standard deviation of each feature after its transformation; a constant feature has no other scale.
FLOOR = np.array([0.04, 0.06, 0.06, 0.08, 0.06, 0.12, 0.12])


def _per_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of values between offsets; works for empty texts."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _earlier_equal(hashes: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each item: is an equal one earlier in the same text; is there another one at all in the same text."""
    key = bw.mix(hashes + text.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    earlier, several = np.zeros(len(key), bool), np.zeros(len(key), bool)
    earlier[order[1:][same]] = True
    several[order[1:][same]] = True
    several[order[:-1][same]] = True
    return earlier, several


def text_counts(column: pa.Array) -> dict[str, np.ndarray]:
    data, offsets = bw.text_buffers(column)
    words = bw.split_words(data, offsets)
    n = len(offsets) - 1
    n_words = words.counts()
    chars = ((data & 0xC0) != 0x80) & ~bw.IS_SPACE[data]
    out = {"n_words": n_words, "word_chars": _per_text(chars, offsets), "n_symbols": _per_text(IS_SYMBOL[data], offsets)}
    # lines: a text has one more than it has \n
    breaks = np.flatnonzero(data == 10)
    begins = np.sort(np.concatenate([offsets[:-1], breaks + 1]))
    text = np.searchsorted(offsets, begins, "right") - 1
    line_text = np.repeat(np.arange(n), np.diff(np.searchsorted(breaks, offsets)) + 1)
    ends = np.append(begins[1:], len(data)) if len(begins) else begins
    last = np.append(line_text[1:] != line_text[:-1], True) if len(begins) else np.zeros(0, bool)
    stops = np.where(last, offsets[line_text + 1], ends - 1)
    del text
    solid = np.concatenate([[0], np.cumsum(~bw.IS_SPACE[data])])
    worded = solid[stops] > solid[begins]
    earlier, _ = _earlier_equal(bw.span_hashes(data, begins[worded], stops[worded]), line_text[worded])
    out["n_lines"] = np.bincount(line_text[worded], minlength=n)
    out["n_dup_lines"] = np.bincount(line_text[worded][earlier], minlength=n)
    # five-word windows that are in the text twice or more
    hashes = words.hashes(lower=False)
    owner = words.text_of_word()
    covered = np.zeros(len(hashes) + 1, np.int64)
    where = np.flatnonzero(bw.inside(words.first, 5))
    if len(where):
        _, several = _earlier_equal(bw.gram_hashes(hashes, 5)[where], owner[where])
        np.add.at(covered, where[several], 1)
        np.add.at(covered, where[several] + 5, -1)
    out["n_repeat_words"] = np.bincount(owner[np.cumsum(covered)[:-1] > 0], minlength=n)
    again, _ = _earlier_equal(hashes, owner)
    kinds = _KIND[data]
    out["marks"] = _per_text(kinds == 4, offsets)
    out["upper"] = _per_text(kinds == 2, offsets)
    out["digits"] = _per_text(kinds == 3, offsets)
    out["distinct"] = n_words - np.bincount(owner[again], minlength=n)
    return out


def vectors(c: dict[str, np.ndarray]) -> np.ndarray:
    """Transformed statistics: each share is mixed with PRIOR_WORDS words of a typical text, then a square root makes
    its spread about even. The share of distinct words falls with length, so it is put to the power of 1/log words."""
    words = c["n_words"].astype(float)
    weight = words + PRIOR_WORDS
    length = (c["word_chars"] + PRIOR_WORDS * TYPICAL[0]) / weight
    chars = c["word_chars"] + PRIOR_WORDS * TYPICAL[0]
    out = [np.log(length)]
    for name, typical in zip(("marks", "upper", "digits"), TYPICAL[1:4]):
        # marks of a typical text are counted a word, the others a character
        base, scale = (weight, 1.0) if name == "marks" else (chars, TYPICAL[0])
        prior = PRIOR_WORDS * typical * (1.0 if name == "marks" else scale)
        out.append(np.sqrt((c[name] + prior) / base))
    distinct = (c["distinct"] + PRIOR_WORDS * TYPICAL[4]) / weight
    out.append(np.log(distinct) / np.log(weight) * math.log(300.0))
    out.append(np.sqrt(c["n_dup_lines"] / (c["n_lines"] + 12.0)))
    out.append(np.sqrt(c["n_repeat_words"] / weight))
    return np.stack(out, axis=1)


@functools.lru_cache(100_000)
def _key(*parts: str | None) -> int:
    """A number other than WHOLE for a language, or a language and source; nulls differ from all strings."""
    raw = "\x1f".join("\x00" if x is None else f"={x}" for x in parts)
    return int.from_bytes(hashlib.blake2b(raw.encode(), digest_size=8).digest(), "little", signed=True) | 1


def _measure(passed_only: bool):
    def run(batches):
        for batch in batches:
            for part in bw.slices(batch, "text"):
                c = text_counts(part.column("text"))
                failed = (c["n_words"] < 10) | (100 * c["n_repeat_words"] > 20 * c["n_words"])
                v = vectors(c)
                if passed_only:
                    if failed.all():
                        continue
                    part, v, c = part.filter(pa.array(~failed)), v[~failed], {k: x[~failed] for k, x in c.items()}
                    failed = failed[~failed]
                langs, sources = (part.column(k).to_pylist() for k in ("lang", "source"))
                arrays = [pa.array([_key(x) for x in langs], pa.int64()), pa.array([_key(*x) for x in zip(langs, sources)], pa.int64())]
                arrays += [pa.array(c[k].astype(np.int64)) for k in COUNTS] + [pa.array(failed)] + [pa.array(v[:, k]) for k in range(v.shape[1])]
                carried = [n for n in part.schema.names if passed_only or n != "text"]
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in carried), *arrays], [*carried, "lang_key", "pair_key", *COUNTS, "base_failed", *FEATURES])

    return run


P = len(FEATURES)
_MEAN, _INVERSE = [f"m{i}" for i in range(P)], [f"p{i}_{j}" for i in range(P) for j in range(i, P)]
_STATE = ", ".join(f"{c} double" for c in (*_MEAN, *_INVERSE, "logdet"))
#: Bins of a distance histogram: 64 a power of e, so a bound is exact to 1.6 %.
_BINS_PER_E = 64
#: Fixed starts: medians with spreads from quartiles, medians with FLOOR alone, and means with all covariances.
STARTS = 3
#: A start whose log determinant falls by less than this has converged.
LEAST_FALL = 1e-3
#: Most rows of estimates that are broadcast; more of them meet rows dealt over salts.
MOST_BROADCAST, SALTS = 4096, 64


#: The group of all rows.
WHOLE = 0


def _keys(thin: DataFrame, small: int) -> DataFrame:
    """pair_key -> the group whose estimate it takes: the pair of language and source, its language, or all."""
    pairs = thin.where("not base_failed").groupBy("pair_key", "lang_key").agg(F.count(F.lit(1)).alias("n"))
    langs = pairs.groupBy("lang_key").agg(F.sum("n").alias("n_lang"))
    own, of_lang = F.col("n") >= small, F.col("n_lang") >= small
    group = F.when(own, F.col("pair_key")).when(of_lang, F.col("lang_key")).otherwise(F.lit(WHOLE))
    level = F.when(own, F.lit("pair")).when(of_lang, F.lit("lang")).otherwise(F.lit("all"))
    return pairs.join(langs, "lang_key").select("pair_key", "lang_key", group.cast("long").alias("grp"), level.alias("estimate"))


def with_few(rows: DataFrame, few: DataFrame, n: int, key: str, how: str = "inner") -> DataFrame:
    """``rows`` joined by ``key`` with a table of ``n`` rows: broadcast if these are few, else with rows dealt over salts."""
    if n <= MOST_BROADCAST:
        return rows.join(F.broadcast(few), key, how)
    salted = few.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("salt", F.pmod(F.xxhash64(*FEATURES), F.lit(SALTS)).cast("int")).join(salted, [key, "salt"], how).drop("salt")


def _mahalanobis():
    d = [F.col(f) - F.col(m) for f, m in zip(FEATURES, _MEAN)]
    total = F.lit(0.0)
    for i in range(P):
        for j in range(i, P):
            total = total + d[i] * d[j] * F.col(f"p{i}_{j}") * (1.0 if i == j else 2.0)
    return F.greatest(total, F.lit(1e-9))


def _sums() -> list:
    """Number of rows, sums and sums of products of the features."""
    products = [F.sum(F.col(FEATURES[i]) * F.col(FEATURES[j])).alias(f"s{i}_{j}") for i in range(P) for j in range(i, P)]
    return [F.count(F.lit(1)).alias("n"), *[F.sum(f).alias(f"s{i}") for i, f in enumerate(FEATURES)], *products]


def _solve(batches):
    """Means and inverse covariances from the sums of each group and start."""
    for pdf in batches:
        rows = []
        for r in pdf.itertuples(index=False):
            n = max(r.n, 1)
            mean = np.array([getattr(r, f"s{i}") for i in range(P)]) / n
            cov = np.zeros((P, P))
            for i in range(P):
                for j in range(i, P):
                    cov[i, j] = cov[j, i] = getattr(r, f"s{i}_{j}") / n - mean[i] * mean[j]
            cov = (cov + cov.T) / 2 * r.scale + np.diag(FLOOR**2)
            inverse = np.linalg.inv(cov)
            rows.append([r.grp, r.start, *mean, *[inverse[i, j] for i in range(P) for j in range(i, P)], np.linalg.slogdet(cov)[1]])
        yield pd.DataFrame(rows, columns=["grp", "start", *_MEAN, *_INVERSE, "logdet"])


@functools.lru_cache(1)
def half_consistency() -> float:
    """Factor that makes the covariance of the nearest half consistent at normal rows: 0.5 / P(chi2_{p+2} <= median of chi2_p)."""
    rng = np.random.default_rng(7)
    d = np.sort(rng.chisquare(P, 400_000))[200_000]
    return 0.5 / float((rng.chisquare(P + 2, 400_000) <= d).mean())


def measure(docs: DataFrame, passed_only: bool = False) -> DataFrame:
    """The columns of ``docs`` but text, and the counts, keys and vector of the text; ``passed_only``: with the text, and
    without rows that fail the base rules."""
    carried = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.schema.fields if passed_only or f.name != "text")
    made = ", ".join(["lang_key long, pair_key long", *(f"{c} long" for c in COUNTS), "base_failed boolean", *(f"{c} double" for c in FEATURES)])
    return docs.mapInArrow(_measure(passed_only), carried + made)


def _first_states(rows_of: DataFrame, work: Workspace) -> DataFrame:
    """An estimate for each group and start; groups of fewer than twice as many rows as a covariance needs have none."""
    quartiles = [F.percentile_approx(f, [0.25, 0.5, 0.75], 2000).alias(f"q_{f}") for f in FEATURES]
    middle = work.keep(rows_of.groupBy("grp").agg(*_sums(), *quartiles).where(F.col("n") >= 2 * (P + 1)), "middle")
    zero = F.lit(0.0)

    def from_medians(start: int, spread):
        medians = [F.col(f"q_{f}")[1].alias(m) for f, m in zip(FEATURES, _MEAN)]
        inverse = [(1.0 / spread(i) if i == j else zero).alias(f"p{i}_{j}") for i in range(P) for j in range(i, P)]
        return middle.select("grp", F.lit(start).alias("start"), *medians, *inverse, F.lit(math.inf).alias("logdet"))

    def quartile_spread(i: int):
        q = F.col(f"q_{FEATURES[i]}")
        return ((q[2] - q[0]) / 1.349) ** 2 + float(FLOOR[i] ** 2)

    sums = middle.select("grp", F.lit(2).alias("start"), "n", *[c for c in middle.columns if c.startswith("s")], F.lit(1.0).alias("scale"))
    means = sums.mapInPandas(_solve, f"grp long, start int, {_STATE}").withColumn("logdet", F.lit(math.inf))
    return work.keep(from_medians(0, quartile_spread).union(from_medians(1, lambda i: F.lit(float(FLOOR[i] ** 2)))).union(means), "state-0")


def fit(thin: DataFrame, work: Workspace, small: int = 200) -> tuple[DataFrame, int]:
    """pair_key and the estimate that holds for it, from measured rows, and the number of its rows."""
    keys = work.keep(_keys(thin, small), "keys")
    # a wider group is fitted on all its rows, but only where some pair needs it
    some_lang, some_all = keys.agg(F.max(F.col("estimate") == "lang"), F.max(F.col("estimate") == "all")).first()
    base = thin.where("not base_failed")
    rows_of = base.select(F.col("pair_key").alias("grp"), *FEATURES)
    if some_lang:
        rows_of = rows_of.union(base.select(F.col("lang_key").alias("grp"), *FEATURES))
    if some_all:
        rows_of = rows_of.union(base.select(F.lit(WHOLE).cast("long").alias("grp"), *FEATURES))
    groups = work.keep(keys.select("grp").distinct(), "groups")
    n_groups = groups.count()
    rows_of = work.keep(with_few(rows_of, groups, n_groups, "grp"), "fit")

    state = _first_states(rows_of, work)
    scale, n_states = half_consistency(), STARTS * n_groups
    run = Window.partitionBy("grp", "start")
    best, moving, step = None, n_states, 0
    while moving:  # a start stays in only while its determinant falls, so this ends
        step += 1
        near = with_few(rows_of, state, n_states, "grp").withColumn("bin", F.floor(F.log(_mahalanobis()) * _BINS_PER_E).cast("int"))
        hist = near.groupBy("grp", "start", "bin").agg(F.count(F.lit(1)).alias("n"))
        upto = hist.withColumn("upto", F.sum("n").over(run.orderBy("bin"))).withColumn("every", F.sum("n").over(run))
        bound = upto.where(F.col("upto") * 2 >= F.col("every")).groupBy("grp", "start").agg(F.min("bin").alias("top"))
        bounded = work.keep(state.join(bound, ["grp", "start"]), f"bounded-{step}")
        inner = with_few(rows_of, bounded, n_states, "grp").where(F.floor(F.log(_mahalanobis()) * _BINS_PER_E) <= F.col("top"))
        sums = inner.groupBy("grp", "start").agg(*_sums())
        now = sums.withColumn("scale", F.lit(scale)).mapInPandas(_solve, f"grp long, start int, {_STATE}")
        before = state.select("grp", "start", F.col("logdet").alias("was"))
        state = work.keep(now.join(before, ["grp", "start"]).withColumn("falls", F.col("logdet") < F.col("was") - LEAST_FALL).drop("was"), f"state-{step}")
        # those that fell go on; those that didn't are done, with the estimate of this step or of the one before
        low = state.drop("falls")
        best = work.keep(low if best is None else best.union(low), f"best-{step}")
        state = state.where("falls").drop("falls")
        moving = state.count()
        if step > 1:
            work.drop(f"best-{step - 1}", f"bounded-{step - 1}", f"state-{step - 2}")
    best = state if best is None else best  # without any group there was no step
    lowest = best.groupBy("grp").agg(F.min_by(F.struct(*_MEAN, *_INVERSE, "logdet"), F.struct("logdet", "start")).alias("e"))
    judges = work.keep(keys.join(lowest, "grp").select("pair_key", "estimate", "e.*"), "judge")
    n = judges.count()
    work.drop("keys", "groups", "fit", "middle", "state-0", *(f"{kind}-{step}" for kind in ("best", "bounded", "state")), f"state-{step - 1}")
    return judges, n


def judge(measured: DataFrame, estimates: tuple[DataFrame, int], cutoff: float) -> DataFrame:
    """``measured`` with estimate, distance2 and kept; pairs all of whose rows fail the base rules have no estimate and need none."""
    scored = with_few(measured, *estimates, "pair_key", "left").withColumn("distance2", F.when(F.col(_MEAN[0]).isNotNull(), _mahalanobis()))
    scored = scored.withColumn("estimate", F.coalesce("estimate", F.lit("none")))
    return scored.withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("distance2") <= cutoff, F.lit(True)))


#: Bounds the squared robust distance: the 0.999 quantile of chi-square with 7 degrees of freedom, one for each feature.
#: FLOOR and PRIOR_WORDS pull clean texts closer than that law has them, so fewer than one in a thousand goes.
CUTOFF = 24.32


def mcd_outliers(docs: DataFrame, small: int = 200, cutoff: float = CUTOFF) -> DataFrame:
    """Counts, vector, ``estimate``, ``distance2`` and ``kept`` for each row of ``docs`` (doc_id, text, lang, source)."""
    work = Workspace(docs.sparkSession, "outliers")
    thin = work.keep(measure(docs.select("doc_id", "text", "lang", "source")), "thin")
    scored = judge(thin, fit(thin, work, small), cutoff)
    return scored.select("doc_id", "lang", "source", *COUNTS, "base_failed", *FEATURES, "estimate", "distance2", "kept")


def drop_outliers(docs: DataFrame, small: int = 200, cutoff: float = CUTOFF) -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns. The estimates are fitted on a thin table; the texts are
    measured again for the verdict, which costs less than carrying them through it."""
    work = Workspace(docs.sparkSession, "outliers")
    thin = work.keep(measure(docs.select("text", "lang", "source")), "thin")
    estimates = fit(thin, work, small)
    work.drop("thin")
    plain, old = renamed(docs, "text", "lang", "source")
    kept = judge(measure(plain, passed_only=True), estimates, cutoff).where("kept")
    return kept.select(*[F.col(n).alias(old.get(n, n)) for n in plain.columns])
