"""Calls that are stored as they come: a run after one that was killed asks only what is missing."""

import os
import time
import uuid

import pytest

from wordmill.operators import enhance


def frames(spark, n):
    words = spark.createDataFrame([(f"w{i}", f"h{i}") for i in range(n)], "word_key string, word_hash string")
    defs = spark.createDataFrame([(f"w{i}", j, "noun", f"line {j} of {i}") for i in range(n) for j in (0, 1)], "word_key string, source_idx int, pos string, source_first_sentence string")
    return words, defs, spark.createDataFrame([], enhance.ENHANCED_WORDS)


@pytest.mark.parametrize("at_once", [1, 4])
def test_a_killed_run_goes_on(spark, tmp_path, at_once):
    calls, well = f"{tmp_path}/calls", f"{tmp_path}/well"
    os.makedirs(calls)

    def make(word, defs):
        if word in ("w20", "w41") and not os.path.exists(well):
            raise OSError("executor lost")
        with open(f"{calls}/{word}-{uuid.uuid4().hex}", "w"):
            return f"{word} made" if word != "w7" else None

    answers = enhance.Answers(f"{tmp_path}/answers", 3)
    words, defs, cache = frames(spark, 60)
    run = lambda: enhance.enhance(words, defs, cache, make, 4, now=1, answers=answers, at_once=at_once).select("word_key", "pocket_definition").collect()
    with pytest.raises(Exception, match="executor lost"):
        run()
    before = {n.split("-")[0] for n in os.listdir(calls)}
    assert before and len(before) < 60
    open(well, "w").close()
    want = {f"w{i}": f"w{i} made" for i in range(60) if i != 7}
    assert dict(run()) == want
    assert dict(run()) == want  # from what is stored
    asked = sorted(n.split("-")[0] for n in os.listdir(calls) if not n.startswith("w7-"))
    assert asked == sorted(want)
    assert enhance.Answers(f"{tmp_path}/answers", 99).buckets == 3  # fixed by the first use
    answers.clear()
    assert not os.path.exists(f"{tmp_path}/answers")


def test_calls_overlap_within_a_task(spark, tmp_path):
    def make(word, defs):
        time.sleep(0.25)
        return "made"

    words, defs, cache = frames(spark, 24)
    answers = enhance.Answers(f"{tmp_path}/answers", 1)
    began = time.time()
    made = enhance.enhance(words, defs, cache, make, 4, now=1, answers=answers, at_once=12)
    assert made.count() == 24
    assert time.time() - began < 6  # 24 in a row take as long


def test_no_words(spark, tmp_path):
    words, defs, cache = frames(spark, 1)
    none = words.where("false")
    assert enhance.enhance(none, defs, cache, lambda w, d: "x", 4, now=1, answers=enhance.Answers(f"{tmp_path}/a")).count() == 0
