"""Phrases whose words stand together more often than their parts would have it.

All phrases of 1 to ``most_words`` words become rows, summed by language; candidates join the counts of their beginnings and ends,
are scored in Decimal, lose to one-word extensions that make up most of their occurrences (anti join), and the rest is ranked.

Texts are cut at punctuation and line ends into pieces and these at blanks into words, A-Z in lower case. A task counts the
phrases of some megabytes of text by exact word numbers before it makes rows of them. A phrase is as rare as its rarest part at
least, so phrases of three words and more become rows only where both parts that are one word shorter occur often enough. A task
looks that up in a Bloom filter, a bit set in files that it maps; what the filter lets through by mistake is counted like
others and goes by its count. The filter has ``BITS`` bits a frequent phrase, up to ``MOST_BITS``; beyond that it lets more through.

Defined results: a null text counts as empty, a null language as ``und``; texts without words add nothing. Repeated rows count as often as
they occur. Very long texts are counted in full; the task that has one holds some 200 bytes a word. Of equal scores the more frequent
phrase comes first, then the one smaller in UTF-8 bytes; of a phrase's cuts with the lowest floored score the first counts. Other columns are ignored.
An empty table gives an empty one. Counts fit 15 digits, so products fit a Decimal's 38.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import bytewords as bw
from .shared import Workspace, mapped, write_file

UNKNOWN = "und"
LEAST_COUNT, MOST_WORDS, TOP = 10, 3, 2000
#: A candidate goes if an extension has this share of its occurrences, in percent.
SHARE = 50
#: Text that a task counts before it makes rows, in bytes.
SLICE = 1 << 20
#: Bits of the filter: for each frequent phrase, and in all (1 GB); files that they are dealt over.
BITS, MOST_BITS, FILES = 16, 1 << 33, 64
#: A language's candidates are cut to its first ones in so many parts before they meet.
PARTS = 16

_U = np.uint64
_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?", 10, 11, 12, 13]] = True
_APART = _BREAK.copy()
_APART[[9, 32]] = True


class Phrases:
    """Words of some texts: bytes in lower case, numbers by language and spelling, and whether the next word is in the same piece."""

    def __init__(self, texts: pa.Array, langs: list[str]):
        data, offsets = bw.text_buffers(texts)
        self.data, apart = bw.TO_LOWER[data], _APART[data]
        solid = ~apart
        begin, stop = solid.copy(), solid.copy()
        if len(data):
            begin[1:] &= apart[:-1]
            stop[:-1] &= apart[1:]
            inner = offsets[(offsets > 0) & (offsets < len(data))]
            begin[inner] = solid[inner]
            stop[inner - 1] = solid[inner - 1]
        self.starts, self.ends = np.flatnonzero(begin), np.flatnonzero(stop) + 1
        breaks = np.zeros(len(data) + 1, np.int64)
        np.cumsum(_BREAK[data], out=breaks[1:])
        text = np.searchsorted(offsets, self.starts, "right")
        self.linked = (breaks[self.starts[1:]] == breaks[self.ends[:-1]]) & (text[1:] == text[:-1])
        self.langs = sorted(set(langs))
        place = {lang: i for i, lang in enumerate(self.langs)}
        of_text = np.array([place[x] for x in langs], np.int64)
        self.lang = of_text[text - 1]
        spelt, ends = self._bytes(self.starts, self.ends - self.starts)
        number = pa.LargeStringArray.from_buffers(len(ends) - 1, pa.py_buffer(ends), pa.py_buffer(spelt)).dictionary_encode().indices.to_numpy() if len(text) else np.zeros(0, np.int64)
        self.number = number.astype(np.int64)

    def _bytes(self, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ends = np.zeros(len(starts) + 1, np.int64)
        np.cumsum(lengths, out=ends[1:])
        return self.data[np.repeat(starts - ends[:-1], lengths) + np.arange(ends[-1])], ends

    def runs(self, n: int) -> np.ndarray:
        """Which words begin a phrase of n words."""
        good = np.ones(max(0, len(self.starts) - n + 1), bool)
        for k in range(n - 1):
            good &= self.linked[k : k + len(good)]
        return good

    def counted(self, n: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A place of each different phrase of n words that begins at one of the places ``at``, and how often it does."""
        key = self.lang[at]
        for k in range(n):
            # numbers are below the number of words, so a phrase's number and the next word's fit 64 bits together
            key = np.unique(key * (int(self.number.max(initial=0)) + 1) + self.number[at + k], return_inverse=True)[1]
        _, place, count = np.unique(key, return_index=True, return_counts=True)
        return at[place], count

    def spelt(self, n: int, at: np.ndarray) -> pa.Array:
        """The phrases of n words that begin at ``at``, with one blank between words."""
        words = (at[:, None] + np.arange(n)).ravel()
        lengths = self.ends[words] - self.starts[words] + 1
        data, ends = _spread(self.data, self.starts[words], lengths)
        keep = np.ones(len(data), bool)
        keep[ends[n::n] - 1] = False
        offsets = ends[::n] - np.arange(len(at) + 1)
        return pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(np.ascontiguousarray(offsets)), pa.py_buffer(data[keep]))


def _spread(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of ``lengths`` - 1 bytes with a blank after each, and the place where each begins, and the end."""
    ends = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(lengths, out=ends[1:])
    padded = np.append(data, np.uint8(32))
    out = padded[np.repeat(starts - ends[:-1], lengths) + np.arange(ends[-1])]
    out[ends[1:] - 1] = 32
    return out, ends


# ------------------------------------------------------------ filter of frequent phrases


def _lang_hash(langs: list[str]) -> np.ndarray:
    data, offsets = bw.text_buffers(pa.array(langs, pa.string()))
    return bw.span_hashes(data, offsets[:-1], offsets[1:]) if len(langs) else np.zeros(0, _U)


def _phrase_hashes(word_hashes: np.ndarray, lang_hashes: np.ndarray, n: int) -> np.ndarray:
    return bw.mix(bw.gram_hashes(word_hashes, n) ^ lang_hashes[: max(0, len(word_hashes) - n + 1)])


def _bits_of(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of each phrase."""
    return (hashes >> _U(3)) & _U(bits - 1), bw.mix(hashes) & _U(bits - 1)


def _to_bits(n: int, bits: int):
    """Rows (file, bit) of phrases of n words."""

    def run(batches):
        for batch in batches:
            data, offsets = bw.text_buffers(batch.column("phrase"))
            words = bw.split_words(data, offsets)
            hashes = _phrase_hashes(words.hashes(), np.repeat(_lang_hash(batch.column("lang").to_pylist()), n), n)[::n]
            bit = np.concatenate(_bits_of(hashes, bits)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array((bit // (bits // FILES)).astype(np.int32)), pa.array(bit % (bits // FILES))], ["file", "bit"])

    return run


def _write_bits(folder: str, bits: int):
    def run(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            file, bit = (batch.column(c).to_numpy() for c in ("file", "bit"))
            for k in np.unique(file).tolist():
                mine = bit[file == k]
                np.bitwise_or.at(held.setdefault(k, np.zeros(bits // FILES // 8, np.uint8)), mine >> 3, (1 << (mine & 7)).astype(np.uint8))
        for k, data in held.items():
            write_file(f"{folder}/{k:02d}.bits", data.tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32())], ["file"])

    return run


def write_filter(frequent: DataFrame, n: int, work: Workspace, name: str) -> tuple[str, int]:
    """Files of a Bloom filter of the phrases (lang, phrase) of n words; its folder and number of bits."""
    bits = min(MOST_BITS, 1 << max(16, (BITS * frequent.count()).bit_length()))
    folder = f"{work.path}/{name}"
    marked = frequent.select("lang", "phrase").mapInArrow(_to_bits(n, bits), "file int, bit long").repartitionById(FILES, "file")
    work.keep(marked.mapInArrow(_write_bits(folder, bits), "file int"), f"{name}-files")
    return folder, bits


@functools.lru_cache(256)
def _file(folder: str, k: int) -> np.ndarray:
    return np.frombuffer(mapped(f"{folder}/{k:02d}.bits"), np.uint8)


def _known(hashes: np.ndarray, folder: str, bits: int) -> np.ndarray:
    good = np.ones(len(hashes), bool)
    for bit in _bits_of(hashes, bits):
        bit = bit.astype(np.int64)
        file, place = bit // (bits // FILES), bit % (bits // FILES)
        for k in range(FILES):
            rows = np.flatnonzero(file == k)
            data = _file(folder, k)
            good[rows] &= (data[place[rows] >> 3] >> (place[rows] & 7) & 1).astype(bool) if len(data) else False
    return good


# ------------------------------------------------------------ counts


def _rows_of(lengths: tuple[int, ...], known: tuple[str, int] | None):
    """Rows (lang, phrase, a) of each slice; the empty phrase has the number of words. ``known``: the filter that both
    parts of a phrase, each one word shorter, have to pass."""

    def of(part: pa.RecordBatch):
        words = Phrases(part.column("text"), part.column("lang").to_pylist())
        langs = pa.array(words.langs, pa.string())
        if 1 in lengths:
            n_words = np.bincount(words.lang, minlength=len(words.langs))
            yield pa.RecordBatch.from_arrays([langs, pa.array([""] * len(langs), pa.string()), pa.array(n_words.astype(np.int64))], ["lang", "phrase", "a"])
        for n in lengths:
            good = words.runs(n)
            if known is not None and good.any():
                hashes = bw.span_hashes(words.data, words.starts, words.ends)
                parts = _phrase_hashes(hashes, _lang_hash(words.langs)[words.lang], n - 1)
                # of equal phrases one is looked up
                unique, back = np.unique(parts, return_inverse=True)
                passes = _known(unique, *known)[back]
                good &= passes[:-1] & passes[1:]
            at, count = words.counted(n, np.flatnonzero(good))
            for i in range(0, len(at), 1 << 16):
                some = at[i : i + (1 << 16)]
                yield pa.RecordBatch.from_arrays([langs.take(pa.array(words.lang[some])), words.spelt(n, some).cast(pa.string()), pa.array(count[i : i + (1 << 16)].astype(np.int64))], ["lang", "phrase", "a"])

    def run(batches):
        for batch in batches:
            for part in bw.slices(batch, "text", SLICE):
                yield from of(part)

    return run


def _counts(docs: DataFrame, lengths: tuple[int, ...], known=None) -> DataFrame:
    rows = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), "text").mapInArrow(_rows_of(lengths, known), "lang string, phrase string, a long")
    return rows.groupBy("lang", "phrase").agg(F.sum("a").alias("a"))


def frequent_phrases(docs: DataFrame, work: Workspace, least_count: int = LEAST_COUNT, most_words: int = MOST_WORDS) -> tuple[DataFrame, DataFrame]:
    """Phrases (lang, phrase, words, a) that occur ``least_count`` times or more, and the number of words (lang, n) of each language."""
    if least_count < 1 or most_words < 2:
        raise ValueError("phrases have two words at least and occur once at least")
    words = (F.length("phrase") - F.length(F.replace("phrase", F.lit(" "), F.lit(""))) + 1).cast("int")
    level = work.keep(_counts(docs, (1, 2)).where((F.col("a") >= least_count) | (F.col("phrase") == "")).withColumn("words", words), "level-2")
    totals = work.keep(level.where("phrase = ''").select("lang", F.col("a").alias("n")), "totals")
    levels = [level.where("phrase <> ''")]
    for n in range(3, most_words + 1):
        known = write_filter(levels[-1].where(F.col("words") == n - 1), n - 1, work, f"filter-{n - 1}")
        levels.append(work.keep(_counts(docs, (n,), known).where(F.col("a") >= least_count).withColumn("words", F.lit(n)), f"level-{n}"))
    return functools.reduce(DataFrame.unionByName, levels).select("lang", "phrase", "words", "a"), totals


def _first_words(phrase: str, n: str, skip: str = "0") -> F.Column:
    """Words ``skip`` + 1 to ``skip`` + ``n`` of a phrase."""
    return F.expr(f"array_join(slice(split({phrase}, ' '), {skip} + 1, {n}), ' ')")


def scored(phrases: DataFrame) -> DataFrame:
    """lang, phrase, words, a, l, r, score of the phrases of two words and more, by their lowest-scoring cut."""
    candidates = phrases.where("words > 1")
    cuts = candidates.select("*", F.explode(F.expr("sequence(1, words - 1)")).alias("k"))
    cuts = cuts.withColumn("left_part", _first_words("phrase", "k")).withColumn("right_part", _first_words("phrase", "words - k", "k"))
    known = phrases.select("lang", F.col("phrase").alias("part"), F.col("a").alias("of_part"))
    for side, name in (("left_part", "l"), ("right_part", "r")):
        counts = known.withColumnsRenamed({"part": side, "of_part": name})
        cuts = cuts.join(counts, ["lang", side])
    d = lambda c: f"cast({c} as decimal(15, 0))"
    score = F.expr(f"cast(1000000 as decimal(7, 0)) * {d('a')} * {d('a')} div ({d('l')} * {d('r')})")
    best = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("best")
    return cuts.groupBy("lang", "phrase", "words", "a").agg(best).select("lang", "phrase", "words", "a", "best.l", "best.r", "best.score")


def without_parts(candidates: DataFrame, share: int = SHARE) -> DataFrame:
    """Candidates that no candidate with one word more has ``share`` percent of. That settles longer ones too, as the phrase
    between two nested ones is a candidate and at least as frequent as the longer."""
    longer = candidates.where("words > 2").select("lang", F.explode(F.array(_first_words("phrase", "words - 1"), _first_words("phrase", "words - 1", "1"))).alias("phrase"), "a")
    most = longer.groupBy("lang", "phrase").agg(F.max("a").alias("longer_a"))
    covered = (candidates["lang"] == most["lang"]) & (candidates["phrase"] == most["phrase"]) & (100 * most["longer_a"] >= share * candidates["a"])
    return candidates.join(most, covered, "left_anti")


def ranked(candidates: DataFrame, top: int = TOP) -> DataFrame:
    """The first ``top`` of each language with their rank; a language's rows are cut in parts before one task ranks what is left."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    some = candidates.withColumn("place", F.row_number().over(Window.partitionBy("lang", part).orderBy(*order))).where(F.col("place") <= top)
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top).drop("place")


def collocations(docs: DataFrame, least_count: int = LEAST_COUNT, most_words: int = MOST_WORDS, share: int = SHARE, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's first ``top`` phrases of ``docs`` (text, lang)."""
    work = Workspace(docs.sparkSession, "collocations")
    phrases, totals = frequent_phrases(docs, work, least_count, most_words)
    best = ranked(without_parts(work.keep(scored(phrases), "scored"), share), top)
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


#: What :func:`collocations` gives with its defaults, in DuckDB.
SQL = r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM d),
p AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM w),
g AS (
  SELECT lang, m AS words, array_to_string(words[i : i + m - 1], ' ') AS phrase, count(*) AS a
  FROM p, (SELECT unnest([1, 2, 3]) AS m) WHERE i + m - 1 <= len(words) GROUP BY ALL),
t AS (SELECT lang, sum(a)::BIGINT AS n FROM g WHERE words = 1 GROUP BY lang),
c AS (SELECT *, string_split(phrase, ' ') AS parts FROM g WHERE words > 1 AND a >= 10),
k AS (SELECT *, unnest(range(1, words)) AS k FROM c),
s AS (
  SELECT k.lang, k.phrase, k.words, k.a, k.k, l.a AS l, r.a AS r, ((1000000::HUGEINT * k.a * k.a) // (l.a::HUGEINT * r.a))::BIGINT AS score
  FROM k JOIN g l ON l.lang = k.lang AND l.phrase = array_to_string(k.parts[1 : k.k], ' ')
         JOIN g r ON r.lang = k.lang AND r.phrase = array_to_string(k.parts[k.k + 1 :], ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
x AS (
  SELECT lang, array_to_string(parts[1:2], ' ') AS phrase, a FROM c WHERE words = 3
  UNION ALL SELECT lang, array_to_string(parts[2:3], ' '), a FROM c WHERE words = 3),
f AS (SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM x WHERE x.lang = b.lang AND x.phrase = b.phrase AND 100 * x.a >= 50 * b.a))
SELECT f.lang, row_number() OVER (PARTITION BY f.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM f JOIN t ON t.lang = f.lang
QUALIFY rank <= 2000
"""
