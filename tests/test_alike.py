import itertools
import random

import numpy as np
import pytest

from wordmill.operators import alike, dedupe


@pytest.mark.parametrize("block", [1 << 22, 60])
def test_blocks_find_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(alike, "BLOCK", block)
    r = random.Random(7)
    texts = [" ".join(r.choices("bcdefghijklm", k=r.randint(0, 9))) for _ in range(60)]
    df = spark.createDataFrame([(0 if i % 4 else i // 8, i, t) for i, t in enumerate(texts)], "g int, k int, t string")
    groups = {row["k"]: row["g"] for row in df.collect()}
    sets = [set(t.split()) for t in texts]
    want = {(i, j) for i, j in itertools.combinations(range(len(texts)), 2) if groups[i] == groups[j] and sets[i] and sets[j] and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.5}
    got = [(p["i"], p["j"]) for p in dedupe.similar_pairs(df, "g", "k", "t", 0.5).collect()]
    assert set(got) == want and len(got) == len(want)


@pytest.mark.parametrize("matches", [1 << 21, 3])
@pytest.mark.parametrize("left", [20, 50])
def test_words_of_one_hash_lose_no_pair(monkeypatch, matches, left):
    monkeypatch.setattr(alike, "MATCHES", matches)
    r = random.Random(matches + left)
    sets = [r.sample(range(14), r.randint(1, 10)) for _ in range(50)]
    hashes = np.array([w // 2 for s in sets for w in s], "<u4")  # two words a hash
    found = {(min(p), max(p)) for x, y in alike.similar_sets(np.array(list(map(len, sets))), hashes, left, 0.5) for p in zip(x.tolist(), y.tolist())}
    want = {(i, j) for i, j in itertools.combinations(range(50), 2) if len({*sets[i]} & {*sets[j]}) >= 0.5 * len({*sets[i]} | {*sets[j]})}
    assert {p for p in want if left == 50 or p[0] < left <= p[1]} <= found


def test_pairs_that_share_words_are_not_shuffled(spark):
    df = spark.createDataFrame([("g", i, " ".join(f"w{(i * k) % 211}" for k in range(1, 40))) for i in range(50)], "g string, k int, t string")
    plan = dedupe.similar_pairs(df, "g", "k", "t", 0.5)._jdf.queryExecution().toString()
    assert "Generate explode" not in plan and "Window" not in plan
