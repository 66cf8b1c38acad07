import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from wordmill.llm import bytewords as bw
from wordmill.llm import kneser_ney
from wordmill.llm.shared import Workspace

TRAIN = ["a b a c a b a d", "b a c", "c c a b a c", "a", "", None, "a b a c d b a", "d a b a", "b b b b"]


def slow_scores(train, texts, order):
    """log10 of each text's probability, by dictionaries of tuples."""
    tokens = lambda t: [*(t or "").split(), None]
    grams = {order: Counter()}
    for t in train:
        run = ["<s>"] * (order - 1) + tokens(t)
        grams[order].update(tuple(run[i : i + order]) for i in range(len(run) - order + 1))
    for k in range(order - 1, 0, -1):
        grams[k] = Counter(g[1:] for g in grams[k + 1])
    of = lambda c: (0, *kneser_ney.discounts(*[sum(v == x for v in c.values()) for x in (1, 2, 3, 4)]))
    d = {k: of(c) for k, c in grams.items()}
    after = {k: defaultdict(list) for k in grams}
    for k, c in grams.items():
        for g, n in c.items():
            after[k][g[:-1]].append(n)

    def p(k, g):
        if k == 0:
            return 1 / (len(grams[1]) + 1)
        ns = after[k][g[:-1]]
        if not ns:
            return p(k - 1, g[1:])
        n = grams[k][g]
        return max(n - d[k][min(n, 3)], 0) / sum(ns) + sum(d[k][min(x, 3)] for x in ns) / sum(ns) * p(k - 1, g[1:])

    out = []
    for t in texts:
        run = ["<s>"] * (order - 1) + tokens(t)
        out.append(sum(math.log10(p(order, tuple(run[i : i + order]))) for i in range(len(run) - order + 1)))
    return out


@pytest.mark.parametrize("order", [2, 3, 4])
def test_orders_against_brute_force(spark, order):
    texts = [*TRAIN, "a b a never seen c a", "d d d a b a c"]
    frame = spark.createDataFrame([(t,) for t in TRAIN], "text string").repartition(3)
    model = kneser_ney.train(frame, Workspace(spark, "kn"), order=order)
    got = kneser_ney.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).orderBy("doc_id").collect()
    assert [r["score"] for r in got] == pytest.approx(slow_scores(TRAIN, texts, order), rel=1e-9)
    assert {r["train_tokens"] for r in got} == {sum(len((t or "").split()) + 1 for t in TRAIN)}
    every = np.append(bw.split_words(*bw.text_buffers(pa.array(["a b c d neverseen"]))).hashes(), kneser_ney.END)
    for u in every:
        _, _, logp = model.token_scores(every, *[np.full(len(every), x) for x in (u, every[0], every[1])[: order - 1]])
        assert (10.0**logp).sum() == pytest.approx(1.0)


def test_no_rows_at_order_three(spark):
    model = kneser_ney.train(spark.createDataFrame([], "text string"), Workspace(spark, "kn"), order=3)
    (r,) = kneser_ney.score(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), model).collect()
    assert r["score"] == 0


def test_many_shards_go_by_ranges(spark, monkeypatch):
    monkeypatch.setattr(kneser_ney, "FAN_OUT", 3)
    monkeypatch.setattr(kneser_ney, "BUFFER", 7)
    frame = spark.createDataFrame([(t,) for t in TRAIN], "text string").repartition(3)
    for order in (2, 3):
        model = kneser_ney.train(frame, Workspace(spark, "kn"), order=order, shards=8)
        got = kneser_ney.score(spark.createDataFrame(list(enumerate(TRAIN)), "doc_id long, text string"), model).orderBy("doc_id").collect()
        assert [r["score"] for r in got] == pytest.approx(slow_scores(TRAIN, TRAIN, order), rel=1e-9)


def test_counts_have_no_bound():
    many = np.array([(5, 6, 2**32 - 1), (5, 6, 2**40), (5, 7, 3)], kneser_ney.PAIR)
    rows, hashes = kneser_ney.merge_pairs([many])
    assert sorted(rows["n"].tolist()) == [3, 2**40 + 2**32 - 1]
    back = kneser_ney.unpack_pairs(kneser_ney.pack_pairs(rows))
    assert sorted(back["n"].tolist()) == sorted(rows["n"].tolist())
    table = kneser_ney.Table(kneser_ney.pack_table(hashes, [rows["n"]]), 1)
    assert table.numbers(0, table.find(hashes)).tolist() == rows["n"].tolist()
    assert table.find(hashes ^ np.uint64(1 << 20)).tolist() == [-1, -1]


def test_tables_with_equal_first_bits():
    low = np.arange(1000, dtype=np.uint64)
    hashes = (np.concatenate([low + np.uint64(7 << 16), low]) << np.uint64(16))[::-1].copy()
    n = np.arange(2000, dtype=np.uint64)
    table = kneser_ney.Table(kneser_ney.pack_table(hashes, [n, n * np.uint64(2)]), 2)
    places = table.find(hashes)
    assert (table.numbers(0, places) == n).all() and (table.numbers(1, places) == 2 * n).all()
    assert (table.find(hashes + np.uint64(1 << 33)) == -1).sum() > 0
