import hashlib
import json

from pyspark.sql import functions as F

from wordmill.functions import text as T
from wordmill.operators import enhance
from wordmill.plans import queries as Q
from wordmill.streaming import ingest

LONG = "a.b.c.d.e.f.g.h.i.j.k.l.m.n.o.p.q.r.s.t one two three four five six"


def test_words_with_a_long_line_or_without_a_sentence_stay(spark, tmp_path):
    rows = [(i, text, "en", "s", 1) for i, text in ((10, LONG), (12, None), (14, " \n"), (20, "Short."))]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = sorted(tuple(r) for r in Q.QUERIES["enhance_words"](spark, str(tmp_path)).collect())
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    assert got == [("w10", "llm", md5(" ".join(LONG.split(" ")[:5]))), ("w12", "llm", None), ("w14", "llm", None), ("w20", "passthrough", md5("Short."))]


def test_what_is_not_accepted_is_kept_for_review_alone(spark):
    words = spark.createDataFrame([(w, "h") for w in "abc"], "word_key string, word_hash string")
    defs = spark.createDataFrame([("a", 0, "noun", "One two three four five six."), ("b", 0, "noun", None), ("c", 0, "noun", "Six five four three two one.")], "word_key string, source_idx int, pos string, source_first_sentence string")
    cache = spark.createDataFrame([], enhance.ENHANCED_WORDS)
    make = lambda word, d: d[0][2].split()[0] + (" x" * 9 if word == "a" else "")
    status = lambda review: {r["word_key"]: (r["pocket_definition"], r["quality_status"]) for r in enhance.enhance(words, defs, cache, make, 4, now=0, review=review).collect()}
    assert status(False) == {"c": ("Six", "accepted")}
    assert status(True) == {"a": ("One" + " x" * 9, "needs_review"), "b": (None, "failed"), "c": ("Six", "accepted")}


def _entries(folder, files):
    folder.mkdir()
    for i, rows in enumerate(files):
        (folder / f"p{i}.jsonl").write_text("".join(json.dumps({"word": w, "lang_code": code, "pos": "noun", "senses": [{"glosses": [g]} for g in glosses]}) + "\n" for w, code, glosses in rows))
    return str(folder)


def test_a_micro_batch_has_no_more_state_partitions_than_tasks(spark, tmp_path):
    source = _entries(tmp_path / "in", [[("apple", "en", ["A fruit."])]])
    had = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        running = ingest.stream_words(spark, source, str(tmp_path / "t"), str(tmp_path / "c"), 1)
        running.awaitTermination(200)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "64"
        assert {s["numShufflePartitions"] for p in running.recentProgress for s in p["stateOperators"]} == {spark.sparkContext.defaultParallelism}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", had)


def test_a_stream_keeps_the_first_of_each_within_and_over_micro_batches(spark, tmp_path):
    files = [
        [("RUN", "eng", ["To go.", "To go.", "A race."]), ("Run", "eng", ["A race.", "To go. Fast."])],
        [("run", "en", ["A race.", "A walk."]), ("run", "eng", ["A walk.", ""]), ("Run", "en", ["A hole."])],
        [("run", "eng", ["To go.", "A hole.", "A tear."]), ("empty", "en", ["  "])],
    ]
    source = _entries(tmp_path / "in", files)
    for n, per_batch in enumerate((1, 2)):
        table = f"{tmp_path}/t{n}"
        ingest.stream_words(spark, source, table, f"{tmp_path}/c{n}", per_batch).awaitTermination(200)
        got = {(r["word_key"], r["source_idx"]): r["source_first_sentence"] for r in ingest.read_definitions(spark, table).collect()}
        assert got == {("run", i): s for i, s in enumerate(("To go.", "A race.", "A walk.", "A hole.", "A tear."))}
        words = {r["word_key"]: (r["display_word"], r["language_code"]) for r in ingest.read_words(spark, table).collect()}
        assert words["run"] == ("run", "en")


def test_the_first_sentence_is_that_of_the_whole_cleaned_text(spark):
    texts = ["", " \n", ".", ". a", "  Aa  b. C d. E", "No end", "x.[[ y]] z", "a [[b. c]] d.", "End.  ", "?! Who? Me", "a.b c!\n\nd", "é. f", "[[ ]]", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    clean = T.clean_gloss("t")
    whole = F.when(clean != "", T.strip(F.coalesce(F.try_element_at(T.sentences(clean), F.lit(1)), clean)))
    assert rows.where(~T.first_sentence("t").eqNullSafe(whole)).collect() == []
