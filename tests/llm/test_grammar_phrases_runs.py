"""op11 to op13 against brute force."""

import hashlib
import random
import zlib
from collections import Counter
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pytest

from wordmill.llm import collocations, periodic, repair
from wordmill.llm import queries as Q
from wordmill.llm.shared import Workspace, mapped

from .conftest import TEXTS

DATA = "/root/testdata/sf0.001"

# ------------------------------------------------------------ op11


def plain_tokens(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(repair.tokenizer_path())
    return [[*tokenizer.encode(t or "", add_special_tokens=False).ids, repair.END_ID] for t in texts]


def expected(rows):
    out, start = [], 0
    for doc_id, ids in rows:
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_op11_against_the_tokenizer(spark):
    docs = sorted(spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect())
    got = sorted(map(tuple, Q.op11_repair(spark, DATA).collect()))
    assert got == expected(zip([d for d, _ in docs], plain_tokens([t for _, t in docs])))


def test_op11_on_odd_rows(spark, odd, empty):
    for rows, size in ((odd, 1 << 20), (odd.repartition(5), 30)):
        shards = repair.write_shards(rows, Workspace(spark, "repair"), shard_tokens=size)
        got = sorted(repair.read_documents(shards, "bigint").collect(), key=lambda r: r["start"])
        ids = [r["doc_id"] for r in got]
        assert ids == [None, *sorted(i for i in ids if i is not None)] and len(ids) == len(TEXTS)
        assert [r["start"] for r in got] == np.cumsum([0, *[r["n_tokens"] for r in got]])[:-1].tolist()
        want = Counter((d, len(t), zlib.crc32(np.array(t, "<u4").tobytes())) for d, t in zip([r[0] for r in TEXTS], plain_tokens([r[1] for r in TEXTS])))
        assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == want
    assert repair.read_documents(repair.write_shards(empty, Workspace(spark, "repair")), "bigint").count() == 0


def test_ids_word_by_word_are_those_of_the_text():
    pieces = ["<|endoftext|>", "<|startoftext|>", "<|", "|>", " ", "\n", "\x1c", "\x85", " ", "　", "'s", "'S", "'", "é", "é", "́", "≠", "İ", "Σ", "ς", "ß", "1", "2", "a", "B", "中", "😀", "​", "...", "##", "가", "가", "\x00"]
    rng = random.Random(3)
    texts = ["".join(rng.choices(pieces, k=rng.randint(0, 25))) for _ in range(3000)]
    encode = repair.Encoder(repair.tokenizer_path())
    assert [x.tolist() + [repair.END_ID] for x in encode(texts)] == plain_tokens(texts)
    encode.held = 1 << 60  # known words move to the older generation and come back
    assert [x.tolist() + [repair.END_ID] for x in encode(texts[::-1])] == plain_tokens(texts[::-1])


def test_other_tokenizers_are_refused():
    import public_tokenizers

    with pytest.raises(ValueError, match="white space"):
        repair.Encoder(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.mark.parametrize("base", [60, 49_408, 70_000])
def test_grammar_round_trip_and_random_access(base):
    rng = np.random.default_rng(base)
    docs = [np.array([7] * n, np.uint32) for n in (1, 2, 3, 50, 501)]
    docs += [rng.integers(0, k, n).astype(np.uint32) for k, n in ((2, 400), (3, 2000), (50, 3000), (base, 1000))]
    docs += [np.tile(rng.integers(0, base, 9), 200).astype(np.uint32), np.array([base - 1], np.uint32)]
    data = repair.shard_bytes(pa.array([f"d{i}" for i in range(len(docs))]), np.concatenate(docs), np.array([len(d) for d in docs]), base)
    shard = repair.Shard(data)
    assert np.array_equal(shard.all_tokens(), np.concatenate(docs)) and shard.ids.to_pylist()[-1] == f"d{len(docs) - 1}"
    assert len(shard.rules) and len(shard.symbols) < 0.7 * sum(map(len, docs))
    assert [len(repair.expand(np.array([base + k]), shard.rules, base)) for k in range(len(shard.rules))] == shard.lengths.tolist()
    for row, doc in enumerate(docs):
        for start, stop in ((0, None), (0, 1), (len(doc) // 2, len(doc) // 2 + 3), (len(doc) - 1, len(doc)), (5, 2), (len(doc), None)):
            assert np.array_equal(shard.tokens(row, start, stop), doc[start:stop])
    with pytest.raises(ValueError):
        repair.Shard(b"x" * 64)


def test_files_read_by_place(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    shards = repair.write_shards(docs, Workspace(spark, "repair"), shard_tokens=20_000).orderBy("start").collect()
    assert len(shards) > 3
    texts = dict(docs.select("doc_id", "text").collect())
    for r in shards:
        shard = repair.Shard(mapped(r["path"]))
        row = len(shard.ids) // 2
        (want,) = plain_tokens([texts[shard.ids[row].as_py()]])
        assert shard.tokens(row, 3, 9).tolist() == want[3:9]


# ------------------------------------------------------------ op12


def slow_collocations(rows, least, most_words, share, top):
    counts, totals = Counter(), Counter()
    breaks = bytes.maketrans(b".,;:!?\n\x0b\x0c\r", b"\0" * 10)
    for text, lang in rows:
        lang = lang or "und"
        # a NUL in a text would end a piece here; the texts have none
        for piece in (text or "").encode().lower().translate(breaks).split(b"\0"):
            words = [w for w in piece.replace(b"\t", b" ").split(b" ") if w]
            totals[lang] += len(words)
            for n in range(1, most_words + 1):
                counts.update((lang, tuple(words[i : i + n])) for i in range(len(words) - n + 1))
    found = {}
    for (lang, p), a in counts.items():
        if len(p) > 1 and a >= least:
            score, k = min((int(Decimal(1000000 * a * a) // Decimal(counts[lang, p[:k]] * counts[lang, p[k:]])), k) for k in range(1, len(p)))
            found[lang, p] = (score, a, counts[lang, p[:k]], counts[lang, p[k:]])
    covered = set()
    for (lang, p), (_, a, _, _) in found.items():
        for n in range(2, len(p)):
            for i in range(len(p) - n + 1):
                part = p[i : i + n]
                if 100 * a >= share * found[lang, part][1]:
                    covered.add((lang, part))
    out = []
    for lang in totals:
        mine = sorted((-s, -a, b" ".join(p), l, r) for (of, p), (s, a, l, r) in found.items() if of == lang and (of, p) not in covered)
        out += [(lang, k + 1, p.decode(), -a, l, r, totals[lang], -s) for k, (s, a, p, l, r) in enumerate(mine[:top])]
    return sorted(out)


WORDS = ["the", "The", "New", "york", "city", "of", "straße", "ÉTÉ", "x", "a b", "(", "new"]


@pytest.fixture(scope="module")
def talk():
    rng = random.Random(5)
    rows = []
    for i in range(160):
        words = []
        while len(words) < 60:
            words += ["New", "York", "City"][: rng.choice([2, 3])] if rng.random() < 0.2 else [rng.choice(WORDS)]
        joined = "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", " ! "]) for w in words)
        rows.append((joined, rng.choice(["en", "en", "de", None])))
    return [*rows, ("", "en"), (None, "fr"), (" \t\n.,", "es"), ("one", "nl")]


@pytest.mark.parametrize(("least", "most_words", "share", "top"), [(10, 3, 50, 2000), (2, 5, 50, 2000), (3, 4, 80, 7), (1, 2, 50, 2000)])
def test_collocations_against_brute_force(spark, talk, least, most_words, share, top):
    docs = spark.createDataFrame([(t, g, 1, "p", 2, 3) for t, g in talk], "text string, lang string, a long, phrase string, words int, rank int").repartition(3)
    got = sorted(map(tuple, collocations.collocations(docs, least, most_words, share, top).collect()))
    assert got == slow_collocations(talk, least, most_words, share, top) and got


def test_a_filter_that_lets_all_through_changes_nothing(spark, talk, monkeypatch):
    monkeypatch.setattr(collocations, "_known", lambda hashes, folder, bits: np.ones(len(hashes), bool))
    part = pa.RecordBatch.from_pydict({"text": pa.array([t for t, _ in talk]), "lang": pa.array([g or "und" for _, g in talk])})
    counts = Counter()
    for batch in collocations._rows_of((3,), ("none", 1 << 16))([part]):
        counts.update({(g, p): a for g, p, a in zip(*(batch.column(c).to_pylist() for c in ("lang", "phrase", "a")))})
    docs = spark.createDataFrame(talk, "text string, lang string")
    phrases, _ = collocations.frequent_phrases(docs, Workspace(spark, "collocations"), 4, 3)
    assert {(r["lang"], r["phrase"]): r["a"] for r in phrases.where("words = 3").collect()} == {k: a for k, a in counts.items() if a >= 4}


def test_collocations_on_odd_rows(spark, odd, empty):
    got = sorted(map(tuple, collocations.collocations(odd, least_count=2).collect()))
    assert got == slow_collocations([(r[1], r[2]) for r in TEXTS], 2, 3, 50, 2000)
    assert collocations.collocations(empty).count() == 0
    with pytest.raises(ValueError):
        collocations.collocations(odd, most_words=1)


# ------------------------------------------------------------ op13


def slow_runs(words, least=6, times=4):
    """Runs by trying every start, end and period."""
    n, found = len(words), {}
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, times * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def slow_row(doc_id, text, rewrite=True):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode())
    if rewrite and doc_id is not None and h % 10 == 0 and words:
        n, g = len(words), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = slow_runs(words)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(((-n, s, q) for s, n, q in runs), default=None)
    shown = (None,) * 4 if best is None else (best[1], -best[0], best[2], 1000 * -best[0] // best[2])
    digest = lambda b: hashlib.sha256(b).hexdigest()
    return (doc_id, len(runs), *shown, digest("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()), digest(b" ".join(w for i, w in enumerate(words) if i not in dropped)))


def test_op13_against_brute_force(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    got = sorted(map(tuple, Q.op13_periodic(spark, DATA).collect()))
    assert got == sorted(slow_row(*r) for r in docs) and sum(r[1] for r in got) > 10


@pytest.fixture(scope="module")
def beats():
    rng = random.Random(11)
    texts = ["a " * n for n in range(12)] + ["a b " * 4 + "a", "a b a b c " * 9, "x " + "a b c " * 5 + "a b d", "ab  ab\tab\nab\x0bab ab", "A a " * 6]
    for _ in range(300):
        words = []
        for _ in range(rng.randint(1, 6)):
            unit = [rng.choice("abc") for _ in range(rng.randint(1, 5))]
            words += unit * rng.randint(1, 7) + unit[: rng.randint(0, len(unit))]
        texts.append(" ".join(words))
    return texts


def test_runs_of_many_kinds(spark, beats, monkeypatch):
    rows = list(enumerate(beats))
    want = sorted(slow_row(*r, rewrite=False) for r in rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    assert sorted(map(tuple, periodic.periodic_runs(docs).collect())) == want
    part = pa.RecordBatch.from_pydict({"doc_id": [i for i, _ in rows], "text": beats})
    run = lambda: sorted(tuple(r.values()) for b in periodic._detect(False, 6, 4)([part]) for r in b.to_pylist())
    monkeypatch.setattr(periodic, "_PAIRS", 5)
    assert run() == want
    # hashes that mislead are found out: of words, and of stretches
    monkeypatch.setattr(periodic.bw.Words, "hashes", lambda self, lower: np.zeros(len(self.starts), np.uint64))
    assert run() == want
    monkeypatch.undo()
    monkeypatch.setattr(periodic.PrefixHashes, "equal", lambda self, i, shift, length: np.ones(len(i), bool))
    assert run() == want


@pytest.mark.parametrize(("least", "times"), [(2, 2), (6, 3), (20, 4)])
def test_other_bounds_of_runs(beats, least, times):
    for text in beats:
        words = text.encode().split()
        ids = np.array([zlib.crc32(w) for w in words], np.uint64)
        got = sorted((s, e - s, q) for _, s, e, q in periodic.find_runs(ids, np.array([0, len(ids)]), least, times).tolist())
        assert got == slow_runs(words, least, times)


def test_runs_of_odd_rows(spark, odd, empty):
    for rewrite in (False, True):
        got = sorted(map(tuple, periodic.periodic_runs(odd, rewrite).collect()), key=repr)
        assert got == sorted((slow_row(r[0], r[1], rewrite) for r in TEXTS), key=repr)
    assert periodic.periodic_runs(empty).count() == 0
    with pytest.raises(ValueError):
        periodic.periodic_runs(odd, times=1)
