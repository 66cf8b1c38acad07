"""Dictionary entries as JSON lines of any shape, read into VARIANT values."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from . import lines
from .files import filesystem

# Names under which a field may be found, in the order in which they are tried.
WORD_KEYS = ("word", "title", "headword", "lemma", "entry")
POS_KEYS = ("pos", "partOfSpeech", "part_of_speech", "part-of-speech")
GLOSS_KEYS = ("gloss", "definition", "def", "sense", "meaning", "desc", "text")
SENSES_KEYS = ("senses", "definitions", "meanings", "glosses", "entries")
LANG_KEYS = ("lang", "language", "lang_name")
LANG_CODE_KEYS = ("lang_code", "langCode", "language_code")
FLAT_KEYS = ("definitions", "glosses")
NESTED_KEYS = ("glosses", "definitions")

DEFINITION = "struct<pos:string,gloss:string>"


def read_lines(spark: SparkSession, path: str, index: str | None = None, first_line: int = 0) -> DataFrame:
    """line_no, value of text files, also gzipped, from line ``first_line`` on. With ``index``, a folder, lines are numbered from 0 over the
    files in order of their names, and each file, also a gzipped one, is read by many tasks (see :mod:`.lines`); an index that is there is used.

    Without it Spark reads the files by size, one task a gzipped file: numbers grow along each file, but have gaps, and which file comes first
    depends on their sizes.
    """
    if index is None:
        return spark.read.text(path).select(F.monotonically_increasing_id().alias("line_no"), "value").where(F.col("line_no") >= first_line)
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{index}/index/_SUCCESS")
    if not done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done):
        lines.build_index(spark, path, index)
    return lines.read_numbered(spark, index, first_line)


def read_word_list(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(T.normalize_word_key("value").alias("word")).where("word <> ''")


#: Files beyond this are read in chunks; a binary value can't be larger than 2 GB.
WHOLE_BYTES = 1 << 28


def _digests(batches):
    """SHA-256 of files that are read piece by piece; each path once, where its task runs."""
    for pdf in batches:
        found = []
        for path in pdf["path"]:
            fs, at = filesystem(path)
            digest = hashlib.sha256()
            with fs.open_input_stream(at, compression=None) as src:
                while block := src.read(1 << 22):
                    digest.update(block)
            found.append(digest.hexdigest())
        yield pdf.assign(sha256=found)


def file_facts(spark: SparkSession, path: str, whole_bytes: int = WHOLE_BYTES) -> DataFrame:
    """path, file_size, sha256, extract_key of files of any size but empty ones, which Spark's reader skips. A file beyond ``whole_bytes`` is digested in pieces by a worker
    that opens it itself."""
    files = spark.read.format("binaryFile").load(path)
    small = files.where(F.col("length") <= whole_bytes).select("path", F.col("length").alias("file_size"), F.sha2("content", 256).alias("sha256"))
    large = files.where(F.col("length") > whole_bytes).select("path", F.col("length").alias("file_size")).mapInPandas(_digests, "path string, file_size long, sha256 string")
    return small.union(large).withColumn("extract_key", F.concat(F.lit("sha256:"), F.substring("sha256", 1, 16)))


def _step(key: str) -> str:
    return f"$['{key}']"


def _kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def _string(v: Column) -> Column:
    return F.when(_kind(v) == "STRING", F.try_variant_get(v, "$", "string"))


def _list(v: Column) -> Column:
    return F.when(F.startswith(_kind(v), F.lit("ARRAY")), F.try_variant_get(v, "$", "array<variant>"))


def first_present(v: Column, keys: tuple[str, ...]) -> Column:
    """The first field that is there, isn't null and isn't an empty string; 0, false and [] count."""
    found = []
    for key in keys:
        x = F.try_variant_get(v, _step(key), "variant")
        found.append(F.when(x.isNotNull() & ~F.is_variant_null(x) & ~F.coalesce(_string(x) == "", F.lit(False)), x))
    return F.coalesce(*found)


def _pair(pos: Column, gloss: Column) -> Column:
    return F.struct(pos.alias("pos"), gloss.alias("gloss"))


def _pos(v: Column) -> Column:
    return F.try_variant_get(first_present(v, POS_KEYS), "$", "string")


def _none() -> Column:
    return F.array().cast(f"array<{DEFINITION}>")


def _kept(pairs: Column) -> Column:
    return F.filter(F.coalesce(pairs, _none()), lambda p: p["gloss"].isNotNull())


def definitions(v: Column, raw: Column) -> Column:
    """All (pos, gloss) pairs of an entry, each once, in the order of the shapes they may have.

    ``raw`` is the line itself: a map of part of speech to definitions keeps its order only there.
    """
    by_pos = F.from_json(raw, "entries map<string,array<variant>>", {"mode": "PERMISSIVE"})["entries"]
    grouped = F.flatten(F.transform(F.map_entries(by_pos), lambda e: F.transform(e["value"], lambda i: _pair(e["key"], F.coalesce(_string(i), _string(first_present(i, GLOSS_KEYS)))))))
    parent = _pos(v)
    flat = _list(first_present(v, FLAT_KEYS))
    flat = F.when((F.size(flat) > 0) & F.forall(flat, lambda x: _kind(x) == "STRING"), F.transform(flat, lambda x: _pair(parent, _string(x))))

    def of_sense(s: Column) -> Column:
        pos = F.coalesce(_pos(s), parent)
        nested = F.coalesce(_list(first_present(s, NESTED_KEYS)), F.array().cast("array<variant>"))
        return F.concat(F.array(_pair(pos, _string(first_present(s, GLOSS_KEYS)))), F.transform(nested, lambda g: _pair(pos, _string(g))))

    senses = F.filter(_list(first_present(v, SENSES_KEYS)), lambda s: F.startswith(_kind(s), F.lit("OBJECT")))
    nested = F.flatten(F.transform(senses, of_sense))
    top = F.array(*[_pair(parent, _string(F.try_variant_get(v, _step(k), "variant"))) for k in GLOSS_KEYS])
    return F.array_distinct(F.concat(*[_kept(x) for x in (grouped, flat, nested, top)]))


def _tagged(v: Column, tag: str) -> Column:
    senses = F.coalesce(_list(F.try_variant_get(v, _step("senses"), "variant")), F.array().cast("array<variant>"))
    return F.exists(senses, lambda s: F.coalesce(F.exists(_list(F.try_variant_get(s, _step("tags"), "variant")), lambda t: F.coalesce(F.contains(F.lower(_string(t)), F.lit(tag)), F.lit(False))), F.lit(False)))


def is_language(name: Column, code: Column, names: tuple[str, ...] = ("english",), codes: tuple[str, ...] = ("en", "eng")) -> Column:
    """Entries of the language, and those that name none."""
    return (name.isNull() & code.isNull()) | F.coalesce(F.lower(name).isin(*names), F.lit(False)) | F.coalesce(F.lower(code).isin(*codes), F.lit(False))


def parse(lines: DataFrame) -> DataFrame:
    """line_no, word, lang, lang_code, defs of lines (line_no, value) that hold a JSON object with a headword.

    Lines that are no JSON object are left out; :func:`rejected` gives them.
    """
    v = lines.withColumn("v", F.try_parse_json("value")).where(F.startswith(F.schema_of_variant("v"), F.lit("OBJECT")))
    named = lambda keys: F.nullif(T.strip(_string(first_present(F.col("v"), keys))), F.lit(""))
    fields = F.struct(named(WORD_KEYS).alias("word"), named(LANG_KEYS).alias("lang"), named(LANG_CODE_KEYS).alias("lang_code"), definitions(F.col("v"), F.col("value")).alias("defs"), _tagged(F.col("v"), "misspelling").alias("tagged_misspelling"))
    # generated from an array of one, so that filters on the fields don't have each of them made again
    return v.select("line_no", F.explode(F.array(fields)).alias("f")).select("line_no", "f.*")


def rejected(lines: DataFrame) -> DataFrame:
    """Lines that aren't blank and hold no JSON object."""
    object_there = F.coalesce(F.startswith(F.schema_of_variant(F.try_parse_json("value")), F.lit("OBJECT")), F.lit(False))
    return lines.where((T.strip("value") != "") & ~object_there)


def misspelling(defs: Column) -> Column:
    return F.exists(defs, lambda d: F.contains(F.lower(d["gloss"]), F.lit("misspelling")))


def gated(entries: DataFrame) -> DataFrame:
    """Entries of the language with a headword and definitions that name no misspelling."""
    return entries.where(is_language(F.col("lang"), F.col("lang_code")) & F.col("word").isNotNull() & ~misspelling(F.col("defs")) & ~F.col("tagged_misspelling") & (F.size("defs") > 0))


def exploded(entries: DataFrame) -> DataFrame:
    """A row for each definition: line_no, ordinal, word, lang_code, pos, gloss."""
    return entries.select("line_no", "word", "lang_code", F.posexplode("defs").alias("ordinal", "d")).select("line_no", "ordinal", "word", "lang_code", F.col("d.pos").alias("pos"), F.col("d.gloss").alias("gloss"))
