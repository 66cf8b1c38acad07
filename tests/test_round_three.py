import datetime
import gzip
import hashlib
import json
import os

import pytest

from wordmill.operators import enhance, snapshot
from wordmill.plans import queries as Q
from wordmill.sources import entries
from wordmill.streaming import ingest


def tables(spark, folder, **rows):
    for name, (data, schema) in rows.items():
        spark.createDataFrame(data, schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_a_made_line_keeps_the_quotes_of_its_words(spark, tmp_path):
    text = 'The heea token = "373e80f4" and then some more words that make it longer than twelve.'
    folder = tables(
        spark,
        tmp_path,
        documents=([(10, text, "en", "s", 1), (12, '"All of it" is said by someone, and "more" than that, in many words as well.', "en", "s", 1)], "doc_id long, text string, lang string, source string, n_chars long"),
        labels=([(1, 1, 1)], "doc_id long, quality int, toxic int"),
    )
    got = {r["word_key"]: r["line_md5"] for r in Q.QUERIES["enhance_words"](spark, folder).collect()}
    want = {"w10": 'The heea token = "373e80f4"', "w12": '"All of it" is said'}
    assert got == {k: hashlib.md5(v.encode()).hexdigest() for k, v in want.items()}


@pytest.mark.parametrize(("answer", "line"), [('"a b c"', "a b c"), ('a "b"', 'a "b"'), ("'a' b", "'a' b"), ('""', None)])
def test_only_quotes_around_the_whole_answer_go(spark, answer, line):
    words = spark.createDataFrame([("w", "h")], "word_key string, word_hash string")
    defs = spark.createDataFrame([("w", 0, "noun", "One two three four five six.")], "word_key string, source_idx int, pos string, source_first_sentence string")
    made = enhance.enhance(words, defs, spark.createDataFrame([], enhance.ENHANCED_WORDS), lambda word, d: answer, 4, now=0)
    assert [r["pocket_definition"] for r in made.collect()] == [line] * (line is not None)


def test_results_within_the_first_second_are_recent(spark, tmp_path):
    start = datetime.datetime(2024, 1, 20)
    rows = [(i, start + datetime.timedelta(microseconds=n)) for i, n in enumerate((-1, 0, 1, 500_000, 1_000_000))]
    folder = tables(spark, tmp_path, events=(rows, "event_id long, ts timestamp_ntz"))
    assert sorted(r["event_id"] for r in Q.QUERIES["recent_results"](spark, folder).collect()) == [2, 3, 4]


def test_a_stream_takes_files_by_name_whenever_they_were_modified(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for i in range(6):
        rows = [{"word": w, "lang_code": "en", "pos": "noun", "senses": [{"glosses": [f"Sense {i} of {w}."]}, {"glosses": [f"Sense {i // 2}."]}]} for w in ("apple", "run")]
        (source / f"p{i}.gz").write_bytes(gzip.compress("\n".join(map(json.dumps, rows)).encode()))
        os.utime(source / f"p{i}.gz", (1_700_000_000 - 60 * i,) * 2)
    table, check = str(tmp_path / "t"), str(tmp_path / "c")
    ingest.stream_words(spark, str(source), table, check, 1).awaitTermination(200)
    got = sorted(map(repr, ingest.read_definitions(spark, table).collect()))
    kept = entries.gated(entries.parse(entries.read_lines(spark, str(source), str(tmp_path / "ix"))))
    assert got == sorted(map(repr, snapshot.source_definitions(entries.exploded(kept)).collect()))
    # started again, it takes only what came meanwhile
    (source / "p7.jsonl").write_text(json.dumps({"word": "run", "lang_code": "en", "pos": "noun", "senses": [{"glosses": ["A late one."]}]}) + "\n")
    ingest.stream_words(spark, str(source), table, check, 1).awaitTermination(200)
    assert len(got) + 1 == ingest.read_definitions(spark, table).count()
