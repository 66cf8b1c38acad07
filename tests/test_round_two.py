import hashlib
import json

import pytest
from pyspark.sql import functions as F

from wordmill.functions import text as T
from wordmill.operators import enhance, export, forms, state, verify
from wordmill.plans import build, config
from wordmill.sources import entries


def chain(n, tail=""):
    return [(f"{tail}k{i:04d}", f"{tail}k{i - 1:04d}", "plural") for i in range(1, n + 1)]


@pytest.mark.parametrize("n", [1, 15, 16, 17, 40, 200])
def test_chains_of_any_length_end_in_one_base(spark, n):
    links = spark.createDataFrame(chain(n), "form_key string, base_key string, form_type string")
    got = {r["form_key"]: (r["base_key"], r["hops"]) for r in forms.resolve_chains(links).collect()}
    assert got == {f"k{i:04d}": ("k0000", i) for i in range(1, n + 1)}


def test_cycles_with_long_tails(spark):
    ring = [(f"r{i:02d}", f"r{(i + 1) % 37:02d}", "plural") for i in range(37)]
    tail = [("t000", "r05", "plural"), *[(f"t{i:03d}", f"t{i - 1:03d}", "plural") for i in range(1, 90)]]
    links = spark.createDataFrame(ring + tail + chain(50), "form_key string, base_key string, form_type string")
    got = {r["form_key"]: r["base_key"] for r in forms.resolve_chains(links).collect()}
    assert got == {f"r{i:02d}": "r00" for i in range(1, 37)} | {f"t{i:03d}": "r00" for i in range(90)} | {f"k{i:04d}": "k0000" for i in range(1, 51)}
    assert forms.resolve_chains(links.where("false")).count() == 0


def test_notation_has_a_pattern_of_its_own(spark):
    cases = {
        "plain words only": 0,
        "C2H5OH (ethanol) + water": 4,  # C2, H5, the brackets and +
        "x = y - z": 2,
        "a 2021 model": 1,
        "π ≈ 3.14": 3,  # the letter, the sign, 14
        "90°] north": 2,
        "90° north": 1,
        "(a) (b) (c)": 3,
        "H₂O and 10⁻³": 3,
        "()": 0,
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string").select("t", T.notation_marks("t").alias("n"), T.needs_context("t").alias("long"))
    got = {r["t"]: (r["n"], r["long"]) for r in df.collect()}
    # H₂O and 10⁻³: the lower 2, 10 and the upper 3
    assert got == {k: (n, n >= 3) for k, n in cases.items()}


def test_marks_count_in_each_class_that_has_them(spark):
    cases = {"∫": 2, "∑": 2, "π": 1, "12 345": 2, "+=": 1, "+": 0, "": 0, "∫∫ → ≤": 6}
    got = {r["t"]: r["n"] for r in spark.createDataFrame([(k,) for k in cases], "t string").select("t", T.technical_marks("t").alias("n")).collect()}
    assert got == cases


def test_combining_marks_are_no_word_characters(spark):
    (r,) = spark.createDataFrame([("éa b_c ١",)], "t string").select(T.word_count("t").alias("n")).collect()
    assert r["n"] == 4  # e, a, b_c and the digit


def test_file_facts_whole_and_in_pieces(spark, tmp_path):
    for name, size in (("small", 10), ("large", 9_000_000)):
        (tmp_path / name).write_bytes(b"x" * size)
    for limit in (1 << 28, 100, -1):
        rows = {r["path"].rsplit("/", 1)[1]: r for r in entries.file_facts(spark, str(tmp_path), limit).collect()}
        for name, size in (("small", 10), ("large", 9_000_000)):
            digest = hashlib.sha256(b"x" * size).hexdigest()
            assert (rows[name]["file_size"], rows[name]["sha256"], rows[name]["extract_key"]) == (size, digest, f"sha256:{digest[:16]}")


def test_digest_of_one_file(spark, tmp_path):
    for name in ("one", "none"):
        (tmp_path / name).write_bytes(b"x" if name == "one" else b"")
        assert build.file_digest(spark, f"{tmp_path}/{name}") == (hashlib.sha256((tmp_path / name).read_bytes()).hexdigest(), (tmp_path / name).stat().st_size)
    (tmp_path / "two").write_bytes(b"y")
    with pytest.raises(ValueError):
        build.file_digest(spark, str(tmp_path))


def test_word_lists_and_sinks(spark, tmp_path):
    (tmp_path / "words.txt").write_text(" Zebra \n\napple\nÉté\n", encoding="utf-8")
    words = entries.read_word_list(spark, f"{tmp_path}/words.txt")
    assert sorted(r["word"] for r in words.collect()) == ["apple", "zebra", "été"]
    many = spark.range(500).select(F.lpad(F.col("id").cast("string"), 5, "0").alias("word")).repartition(7)
    export.write_text(many, "word", f"{tmp_path}/sorted")
    lines = "".join(p.read_text() for p in sorted((tmp_path / "sorted").glob("part-*"))).split()
    assert lines == [f"{i:05d}" for i in range(500)]
    export.write_json_lines(spark.createDataFrame([("b", ["x"]), ("a", ["y", "z"])], "word string, definitions array<string>"), f"{tmp_path}/json")
    assert {r["word"]: r["definitions"] for r in spark.read.json(f"{tmp_path}/json").collect()} == {"a": ["y", "z"], "b": ["x"]}
    export.compact(many.withColumn("more", F.lit(1)), f"{tmp_path}/compact", ["word"], files=1)
    assert len(list((tmp_path / "compact").glob("*.parquet"))) == 1 and spark.read.parquet(f"{tmp_path}/compact").columns == ["word"]
    state.write_report(spark.createDataFrame([(1, [2])], "a int, b array<int>"), f"{tmp_path}/report")
    (part,) = (tmp_path / "report").glob("part-*")
    assert json.loads(part.read_text()) == {"a": 1, "b": [2]}


def test_legacy_tables_of_pure_words(spark):
    words = spark.createDataFrame([("abc", "Abc"), ("a-b", "A-b")], "word string, raw string")
    lines = spark.createDataFrame([("abc", 0, "noun", "x"), ("a-b", 0, "noun", "y")], "word string, idx int, pos string, definition string")
    w, d = export.legacy_pure(words, lines)
    assert [tuple(r) for r in w.collect()] == [("abc", "Abc")] and [tuple(r) for r in d.collect()] == [("abc", 0, "noun", "x")]


RESULT = "word string, definition_idx int, source string, title string, snippet string, url string, rank int, created_at bigint"


def test_results_are_stored_ranked_and_read_as_context(spark):
    old = spark.createDataFrame([("a", 0, "s", "old", "x", "u", 1, 1), ("b", 0, "s", "kept", "y", "u", 1, 1)], RESULT)
    new = spark.createDataFrame([("a", 0, "s", f"t{i}", None if i == 2 else f"s{i}", "u", i, 2) for i in range(5, 0, -1)], RESULT)
    now = state.add_results(old, new)
    assert sorted((r["word"], r["title"]) for r in now.collect()) == [("a", f"t{i}") for i in range(1, 6)] + [("b", "kept")]
    assert [r["rank"] for r in state.ranked_results(new).collect()] == [1, 2, 3, 4, 5]
    assert {r["word"]: r["context"] for r in state.contexts(now).collect()} == {"a": "t1: s1\nt2\nt3: s3", "b": "kept: y"}


def test_glosses_are_rewritten_in_three_ways(spark):
    glosses = spark.createDataFrame([("a", 0, "C2H5OH (alcohol) + x"), ("b", 0, "a plain gloss"), ("c", 0, "∑ ∫ sum of parts"), ("d", 0, "H 12 34")], "word string, definition_idx int, gloss string")
    context = spark.createDataFrame([("c", 0, "found")], "word string, definition_idx int, context string")
    planned = enhance.rewrite_plan(glosses, context)
    got = {r["word"]: r for r in enhance.rewrite_glosses(planned, lambda g, way, c, n: f'"{way} {c or ""}"' if g != "H 12 34" else None, 9).collect()}
    assert {w: r["line"] for w, r in got.items()} == {"a": "notation", "b": "plain", "c": "context found", "d": None}
    assert got["d"]["search_term"] == "H 12 34" and not got["d"]["helpful"] and got["c"]["search_term"] is None and got["b"]["search_term"] is None


def test_tries_get_warmer(spark):
    words = spark.createDataFrame([("a", "1")], "word_key string, word_hash string")
    lines = spark.createDataFrame([("a", i, "noun", "a long line of words") for i in (0, 1)], "word_key string, source_idx int, pos string, source_first_sentence string")

    def make(word, pairs, temperature):
        return f"at {temperature}" if temperature > 0.6 else None

    made = enhance.enhance(words, lines, spark.createDataFrame([], enhance.ENHANCED_WORDS), make, 4, now=1, tries=3)
    assert [r["pocket_definition"] for r in made.collect()] == ["at 0.7"]
    assert enhance.temperatures(6) == [0.3, 0.5, 0.7, 0.9, 1.0, 1.0]


def test_input_of_a_check_is_of_words_that_are_done(spark):
    lines = spark.createDataFrame([(w, i) for w in "cab" for i in (1, 0)], "word string, idx int")
    words = spark.createDataFrame([("a", "done"), ("b", "pending"), ("c", "done")], "word string, status string")
    assert [tuple(r) for r in verify.input_lines(lines, words, 3).collect()] == [("a", 0), ("a", 1), ("c", 0)]


def test_settings(spark, tmp_path):
    (tmp_path / "s.toml").write_text('max_defs = 7\nother = true\n[fast]\nurl = "localhost"\n')
    s = config.load(spark, f"{tmp_path}/s.toml")
    assert (s.max_defs, s.max_total_words, s.models, s.more) == (7, 100, {"fast": {"url": "localhost"}}, {"other": True})
    assert config.parse('{"input": "x.gz"}').input == "x.gz" and config.load(spark, "") == config.Settings()
    for bad in ("max_defs = 'x'", "= 1", '{"a"'):
        with pytest.raises(ValueError):
            config.parse(bad)
