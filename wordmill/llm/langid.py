"""Language by rank-order profiles: a text's most frequent letter n-grams are compared with each language's profile by
out-of-place distance.

Words are runs of letters, lower-cased and padded with a blank; n-grams of 1 to ``LONGEST`` characters are counted
inside them. Profiles are learned from all labelled rows: each task counts its rows' n-grams by language, the partial
counts are summed by Spark, and only the ``top`` n-grams a language (a size that doesn't grow) reach the driver.

Defined results: a null text or one without letters (combining marks alone are none) is ``und`` with score 0; with no
labelled row at all every text is, and an empty table gives an empty one. Ties in frequency are ordered by the n-gram's hash, ties in distance go to the smaller language name. Long
texts are counted whole, in pieces. Repeated rows count as often as they occur. Other columns are kept; ``lang_pred`` and
``score`` are replaced.
"""

from __future__ import annotations

import sys
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import bytewords as bw

LONGEST = 4
UNDETERMINED = "und"
#: Characters counted at once.
_PIECE = 1 << 18

_fold: np.ndarray | None = None


def fold_table() -> np.ndarray:
    """For each code point its lower-case form if it is a letter or a combining mark, else 0."""
    global _fold
    if _fold is None:
        table = np.zeros(sys.maxunicode + 1, np.uint32)
        for c in range(sys.maxunicode + 1):
            if unicodedata.category(chr(c))[0] in "LM":
                low = chr(c).lower()
                table[c] = ord(low) if len(low) == 1 else c
        _fold = table
    return _fold


def _grams(chars: np.ndarray) -> np.ndarray:
    """Hashes of all n-grams of words in folded characters that begin and end with 0."""
    letter = chars != 0
    used = letter.copy()  # a blank counts where it touches a word
    used[:-1] |= letter[1:]
    used[1:] |= letter[:-1]
    value = bw.mix(chars.astype(np.uint64) + np.uint64(1))
    out = [value[letter]]
    for n in range(2, LONGEST + 1):
        if len(chars) < n:
            break
        # only the first and the last character of an n-gram may be a blank
        good = used[: len(chars) - n + 1] & used[n - 1 :]
        for k in range(1, n - 1):
            good &= letter[k : len(chars) - n + 1 + k]
        if n == 2:
            good &= letter[:-1] | letter[1:]
        out.append(bw.gram_hashes(value, n)[good])
    return np.concatenate(out)


def count_grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a text and their counts."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    chars = np.zeros(len(codes) + 2, np.uint32)
    chars[1:-1] = fold_table()[codes]
    if len(chars) <= _PIECE:
        return np.unique(_grams(chars), return_counts=True)
    found, counts = np.empty(0, np.uint64), np.empty(0, np.int64)
    at = 0
    while at < len(chars) - 1:
        to = min(len(chars), at + _PIECE)
        if to < len(chars):  # cut at a blank; only a word longer than a piece is cut inside
            blank = np.flatnonzero(chars[at + 1 : to] == 0)
            to = at + 2 + int(blank[-1]) if len(blank) else to
        piece, n = np.unique(_grams(chars[at:to]), return_counts=True)
        found, counts = merge_counts([found, piece], [counts, n])
        at = to - 1 if to < len(chars) else to
    return found, counts


def merge_counts(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    k, c = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(k, kind="stable")
    k, c = k[order], c[order]
    if not len(k):
        return k, c
    first = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
    return k[first], np.add.reduceat(c, first)


def ranked(grams: np.ndarray, counts: np.ndarray, top: int) -> np.ndarray:
    """The ``top`` most frequent n-grams, most frequent first."""
    if len(grams) > top:
        least = np.partition(counts, len(counts) - top)[len(counts) - top]
        some = counts >= least
        grams, counts = grams[some], counts[some]
    return grams[np.lexsort((grams, -counts))][:top]


def _count(batches):
    held: dict[str, list] = {}
    for batch in batches:
        for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
            k, c = count_grams(text)
            have = held.setdefault(lang, [[], [], 0])
            have[0].append(k)
            have[1].append(c)
            have[2] += len(k)
            if have[2] > 1 << 20:
                k, c = merge_counts(have[0], have[1])
                held[lang] = [[k], [c], len(k) // 2]
    for lang, (ks, cs, _) in held.items():
        k, c = merge_counts(ks, cs)
        for i in range(0, len(k), 50_000):
            n = len(k[i : i + 50_000])
            yield pa.RecordBatch.from_arrays([pa.array([lang] * n), pa.array(k[i : i + 50_000].view(np.int64)), pa.array(c[i : i + 50_000])], ["lang", "gram", "n"])


def learn_profiles(labelled: DataFrame, top: int = 400) -> dict[str, np.ndarray]:
    """lang -> its ``top`` most frequent n-grams in order, from all rows of ``labelled`` (text, lang) without nulls."""
    rows = labelled.where("text is not null and lang is not null").select("text", "lang")
    counts = rows.mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    # n-grams of one language are cut to the top in slices before they meet, so no task holds them all
    order = [F.col("n").desc(), F.col("gram")]
    part = Window.partitionBy("lang", F.pmod("gram", F.lit(64))).orderBy(*order)
    short = counts.withColumn("r", F.row_number().over(part)).where(F.col("r") <= top).drop("r")
    best = short.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("r") <= top)
    found: dict[str, list] = {}
    for r in best.select("lang", "gram", "n").collect():
        found.setdefault(r[0], []).append((r[1], r[2]))
    return {lang: ranked(np.array([g for g, _ in rows], np.int64).view(np.uint64), np.array([n for _, n in rows]), top) for lang, rows in sorted(found.items())}


class Matcher:
    """Out-of-place distances of one text to all profiles."""

    def __init__(self, profiles: dict[str, np.ndarray], top: int):
        self.langs, self.top = sorted(profiles), top
        every = np.unique(np.concatenate([profiles[x] for x in self.langs])) if self.langs else np.empty(0, np.uint64)
        self.grams = every
        self.rank = np.full((len(self.langs), len(every) + 1), -1, np.int64)
        for i, lang in enumerate(self.langs):
            self.rank[i, np.searchsorted(every, profiles[lang])] = np.arange(len(profiles[lang]))

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.langs:
            return UNDETERMINED, 0.0
        grams, counts = count_grams(text)
        if not len(grams) or not any(c.isalpha() for c in text):  # combining marks alone are no letters
            return UNDETERMINED, 0.0
        own = ranked(grams, counts, self.top)
        at = np.searchsorted(self.grams, own)
        at[at == len(self.grams)] = 0
        at = np.where(self.grams[at] == own, at, len(self.grams))
        ranks = self.rank[:, at]
        apart = np.where(ranks < 0, self.top, np.abs(ranks - np.arange(len(own))))
        total = apart.sum(axis=1)
        best = int(total.argmin())
        return self.langs[best], float(1 - total[best] / (self.top * len(own)))


def _predict(profiles, top):
    def run(batches):
        matcher = Matcher(profiles, top)
        for batch in batches:
            for part in bw.slices(batch, "text"):
                got = [matcher.predict(t) for t in part.column("text").to_pylist()]
                columns = [part.column(c) for c in range(part.num_columns)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())], [*part.schema.names, "lang_pred", "score"])

    return run


def identify(docs: DataFrame, profiles: dict[str, np.ndarray], top: int = 400) -> DataFrame:
    """``docs`` (with a column text), ``lang_pred`` and ``score`` (1: the same order, 0: no n-gram in common)."""
    docs = docs.drop("lang_pred", "score")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(_predict(profiles, top), f"{columns}, lang_pred string, score double")


def crc_remainder(column: str, n: int):
    """crc32 of an id as text, modulo n; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))), F.lit(n))


