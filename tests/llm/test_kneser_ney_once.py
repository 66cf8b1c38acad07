"""op6: n-grams go to shards by their last word but one, and are shuffled once; its tables are smaller."""

import gc
import weakref

import numpy as np
import pytest

from wordmill.llm import kneser_ney as kn
from wordmill.llm.shared import Workspace

from .test_whole_kneser_ney import TRAIN, slow_scores


def test_large_tables_take_under_six_bytes_an_entry():
    rng = np.random.default_rng(1)
    hashes = np.unique(rng.integers(0, 2**63, 200_000).astype("<u8") << np.uint64(1))
    n = rng.integers(1, 40, len(hashes)).astype("<u8")
    n[rng.random(len(n)) < 0.9] = 1
    raw = kn.pack_table(hashes, [n])
    assert len(raw) < 8.5 * len(hashes)  # 16 bytes for each of the listed ones, half a byte and 4 for the others
    assert len(kn.pack_table(hashes, [np.ones(len(hashes), "<u8")])) < 6 * len(hashes)
    table = kn.Table(raw, 1)
    shuffled = rng.permutation(len(hashes))
    assert (table.numbers(0, table.find(hashes[shuffled])) == n[shuffled]).all()
    assert (table.find(hashes ^ np.uint64(1 << 17)) == -1).all()


def test_hashes_with_the_same_first_bits_are_put_in_order():
    rng = np.random.default_rng(2)
    for few in (3, 2000, 10**9):
        hashes = np.append(rng.integers(0, few, 5000), [7, 7, 3]).astype("<u8")
        places, ordered = kn.in_order(hashes)
        assert (ordered == np.sort(hashes)).all() and (hashes[places] == ordered).all()


def test_words_pack():
    rows = np.zeros(4, kn.WORD)
    rows["word"], rows["count"], rows["before"] = [1, 5, 2**63, 2**64 - 1], [1, 300, 2**40, 0], [9, 8, 7, 6]
    assert kn.unpack_words(kn.pack_words(rows)).tolist() == rows.tolist()


def test_no_words_are_hot_and_some_are(spark, monkeypatch):
    texts = [*TRAIN, "a b never"]
    frame = spark.createDataFrame([(t,) for t in TRAIN], "text string").repartition(2)
    words = kn.frequent_words(frame, 8)
    assert 0 < len(words) <= 16 and (np.diff(words.astype(object)) > 0).all()
    for hot in (np.empty(0, "<u8"), words):
        monkeypatch.setattr(kn, "frequent_words", lambda texts, shards, hot=hot: hot)
        model = kn.train(frame, Workspace(spark, "kn"), order=3, shards=8)
        got = kn.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).orderBy("doc_id").collect()
        assert [r["score"] for r in got] == pytest.approx(slow_scores(TRAIN, texts, 3), rel=1e-9)


def test_a_tasks_tables_go_with_its_model():
    model = kn.Model("/nowhere", 4, dict.fromkeys(kn._stats(2), 0))
    table = weakref.ref(model.table("pairs", 0))
    del model
    gc.collect()
    assert table() is None
