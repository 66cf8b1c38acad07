import random

import numpy as np
import pytest

from wordmill.llm import outliers

DATA = "/root/testdata/sf0.01"


def test_labelled_junk_goes_and_clean_texts_stay(spark):
    labels = spark.read.parquet(f"{DATA}/labels.parquet").select("doc_id", "quality")
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = outliers.mcd_outliers(docs).where("not base_failed").join(labels, "doc_id").select("quality", "kept").collect()
    junk, clean = ([r["kept"] for r in rows if r["quality"] == q] for q in (0, 1))
    assert len(junk) >= 20 and sum(junk) <= 0.1 * len(junk)
    assert len(clean) >= 200 and sum(clean) >= 0.99 * len(clean)


def slow_mcd(x):
    """Squared robust distances by numpy: concentration steps from the same starts, with the same bins of distances."""
    n, p = x.shape
    rank = lambda q: np.sort(x, axis=0)[int(np.ceil(q * n)) - 1]
    median, floor = rank(0.5), np.diag(outliers.FLOOR**2)
    covariance = lambda y, scale: np.cov(y.T, bias=True) * scale + floor
    starts = [(median, np.diag(((rank(0.75) - rank(0.25)) / 1.349) ** 2) + floor), (median, floor), (x.mean(axis=0), covariance(x, 1.0))]
    found = []
    for k, (mean, cov) in enumerate(starts):
        was = np.inf
        while True:
            d = np.maximum(np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean), 1e-9)
            bins = np.floor(np.log(d) * 64)
            top = next(b for b in np.unique(bins) if 2 * (bins <= b).sum() >= n)
            inner = x[bins <= top]
            mean, cov = inner.mean(axis=0), covariance(inner, outliers.half_consistency())
            now = np.linalg.slogdet(cov)[1]
            found.append((now, k, mean, cov))
            if not now < was - outliers.LEAST_FALL:
                break
            was = now
    _, _, mean, cov = min(found, key=lambda f: f[:2])
    return np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean)


def test_distances_and_verdicts_against_brute_force(spark):
    r = random.Random(3)
    vocabulary = ["".join(r.choices("etaoinshrdlu", k=r.randint(2, 8))) for _ in range(400)]
    rows = []
    for i in range(900):
        words = r.choices(vocabulary, k=r.randint(12, 300))
        if i % 9 == 0:
            words = [w.upper() + r.choice(("***", "%%%", "$$$")) for w in words]
        rows.append((i, " ".join(words), "en" if i < 700 else "de", "big" if i < 450 else "mid" if i < 800 else "rare"))
    got = {g["doc_id"]: g for g in outliers.mcd_outliers(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    group = {}
    for i, _, lang, source in rows:  # (en, big) and (en, mid) have 200 rows or more, what is German has its language's estimate
        group.setdefault((lang, source) if lang == "en" else (lang,), []).append(i)
    for name, ids in group.items():
        ids = [i for i in ids if not got[i]["base_failed"]]
        x = np.array([[got[i][f] for f in outliers.FEATURES] for i in ids])
        want = slow_mcd(x)
        assert [got[i]["distance2"] for i in ids] == pytest.approx(want.tolist(), rel=1e-6)
        assert [got[i]["kept"] for i in ids] == (want <= outliers.CUTOFF).tolist()
        assert {got[i]["estimate"] for i in ids} == {"pair" if len(name) == 2 else "lang"}
