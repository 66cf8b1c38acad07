import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wordmill.llm import bytewords as bw
from wordmill.llm import gif, kneser_ney, langid, licenses, minhash, outliers, pii
from wordmill.llm import queries as Q
from wordmill.llm.shared import Workspace

from .conftest import LONG, TEXTS

DATA = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
texts_of = st.lists(st.one_of(st.none(), st.text(alphabet=st.sampled_from("aAbé中 \n\t.#|"), max_size=40)), max_size=12)


def low(s):
    return re.sub("[A-Z]", lambda m: m.group().lower(), s)


# ------------------------------------------------------------ words


@given(texts_of)
@settings(max_examples=60, deadline=None)
def test_words(texts):
    w = bw.split_words(*bw.text_buffers(pa.array(texts, pa.string())))
    raw = w.data.tobytes()
    got = [[raw[s:e].decode() for s, e in zip(w.starts[a:b], w.ends[a:b])] for a, b in zip(w.first[:-1], w.first[1:])]
    assert got == [WORD.findall(t or "") for t in texts]
    hashes, seen = w.hashes(), {}
    for word, h in zip((x for ws in got for x in ws), hashes.tolist()):
        assert seen.setdefault(low(word), h) == h
    assert len(set(seen.values())) == len(seen)


def test_hashes_in_blocks(monkeypatch):
    data, offsets = bw.text_buffers(pa.array([LONG, "tail"]))
    whole = bw.split_words(data, offsets).hashes()
    monkeypatch.setattr(bw, "_BLOCK", 64)
    assert (bw.split_words(data, offsets).hashes() == whole).all()


# ------------------------------------------------------------ op10


def slow_counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in lines
            lines.add(line)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(i, i + 5)}
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)), "n_dup_lines": dup, "n_repeat_words": len(covered)}


@given(st.lists(st.one_of(st.none(), st.text(alphabet=st.sampled_from("aé \n#"), max_size=60)), max_size=8))
@settings(max_examples=80, deadline=None)
def test_counts(texts):
    c = outliers.text_counts(pa.array(texts, pa.string()))
    for i, t in enumerate(texts):
        assert {k: int(c[k][i]) for k in outliers.COUNTS} == slow_counts(t)


def test_outliers_on_odd_rows(spark, odd, empty):
    got = outliers.mcd_outliers(odd).collect()
    assert len(got) == len(TEXTS)
    for r in got:
        text = next((t for i, t, *_ in TEXTS if i == r["doc_id"]), None)
        want = slow_counts(text)
        assert {k: r[k] for k in want} == want
        assert r["base_failed"] == (want["n_words"] < 10 or 100 * want["n_repeat_words"] > 20 * want["n_words"])
        assert not (r["base_failed"] and r["kept"])
    assert outliers.mcd_outliers(empty).count() == 0
    left = outliers.drop_outliers(odd)
    assert left.columns == odd.columns and {r["doc_id"] for r in left.collect()} == {r["doc_id"] for r in got if r["kept"]}


def test_mcd_finds_planted_rows(spark):
    r = random.Random(1)
    vocabulary = ["".join(r.choices("etaoinshrdlu", k=r.randint(2, 8))) for _ in range(500)]
    rows = []
    for i in range(600):
        words = r.choices(vocabulary, k=r.randint(40, 300))
        if i % 10 == 0:  # a tenth is junk, too much for plain means and covariances
            words = [w + r.choice(("***", "%%%", "$$$")) for w in words]
        rows.append((i, " ".join(words), "en", "big" if i < 400 else "rare"))
    got = outliers.mcd_outliers(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()
    assert {r["doc_id"] for r in got if not r["kept"]} == set(range(0, 600, 10))


def test_mcd_is_near_the_best_half():
    """The estimate of a step's sums is that of numpy on the same rows."""
    import pandas as pd

    x = np.random.default_rng(0).normal(size=(500, outliers.P))
    sums = {"grp": 1, "start": 0, "n": 500, "scale": 1.0} | {f"s{i}": x[:, i].sum() for i in range(outliers.P)} | {f"s{i}_{j}": (x[:, i] * x[:, j]).sum() for i in range(outliers.P) for j in range(i, outliers.P)}
    (out,) = outliers._solve(iter([pd.DataFrame([sums])]))
    inverse = np.linalg.inv(np.cov(x.T, bias=True) + np.diag(outliers.FLOOR**2))
    assert out["p0_1"][0] == pytest.approx(inverse[0, 1]) and out["m3"][0] == pytest.approx(x[:, 3].mean())


# ------------------------------------------------------------ op3


def slow_components(rows, shingle, percent):
    sets = []
    for _, text in rows:
        w = WORD.findall(low(text or ""))
        sets.append({tuple(w[i : i + shingle]) for i in range(len(w) - shingle + 1)} if len(w) >= shingle else {tuple(w)} if w else set())
    label = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(i):
                if label[i] != label[j] and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                    a, b = sorted((label[i], label[j]))
                    label = [a if x == b else x for x in label]
                    changed = True
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[k][0] for k in range(len(rows)) if label[k] == label[i] and rows[k][0] is not None]
        out.append((d, len(sets[i]), min(ids) if ids and sets[i] else d))
    return sorted(out, key=str)


def test_near_duplicates_against_brute_force(spark, odd, empty):
    r = random.Random(3)
    base = [[r.choice("abcdefghij") + str(r.randint(0, 60)) for _ in range(60)] for _ in range(4)]
    rows = []
    for i in range(120):
        words = list(base[i % 4])
        for _ in range(r.randint(0, 5)):
            words[r.randrange(60)] = "x" + str(r.randint(0, 999))
        rows.append((i * 7 % 120, " ".join(words)))
    rows += [(200, "a b"), (201, "A  b"), (202, "a c"), (203, ""), (204, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for shingle, percent in ((3, 85), (5, 80)):
        got = minhash.near_duplicates(df, shingle, percent).collect()
        assert sorted(((g["doc_id"], g["n_shingles"], g["component_id"]) for g in got), key=str) == slow_components(rows, shingle, percent)
        assert all(g["kept"] == (g["doc_id"] == g["component_id"]) for g in got)
    got = minhash.near_duplicates(odd, 3, 85).collect()
    assert sorted(((g["doc_id"], g["n_shingles"], g["component_id"]) for g in got), key=str) == slow_components([(i, t) for i, t, *_ in TEXTS], 3, 85)
    assert minhash.near_duplicates(empty).count() == 0
    left = minhash.drop_near_duplicates(odd, 3, 85)
    assert left.columns == odd.columns
    assert sorted((x["doc_id"] for x in left.collect()), key=str) == [1, 10, 4, 5, 6, 7, 8, 9, None]


def test_blocks_lose_no_link(spark, monkeypatch):
    """Groups over a block's size are compared block with block."""
    rows = [(i, " ".join(f"w{k}" for k in range(100) if k != i % 50) + f" own{i}") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(minhash, "BLOCK_ROWS", 7)
    monkeypatch.setattr(minhash, "BLOCK_TEXTS", 7)
    got = minhash.near_duplicates(df, 3, 85).collect()
    assert sorted(((g["doc_id"], g["n_shingles"], g["component_id"]) for g in got), key=str) == slow_components(rows, 3, 85)


def test_components_of_long_chains(spark):
    n = 70
    pairs = [(f"{i:03d}".encode(), f"{i + 1:03d}".encode()) for i in range(n)] + [(b"900", b"901"), (b"902", b"901")]
    random.Random(0).shuffle(pairs)
    edges = spark.createDataFrame([(bytearray(u), bytearray(v)) for u, v in pairs], "u binary, v binary")
    got = {bytes(r["node"]): bytes(r["root"]) for r in minhash.connected_components(edges, Workspace(spark, "t"), "e").collect()}
    assert got == {f"{i:03d}".encode(): b"000" for i in range(n + 1)} | {k: b"900" for k in (b"900", b"901", b"902")}


# ------------------------------------------------------------ op1


def test_base_patterns():
    plain = {
        "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
        "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
        "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
    }

    def keep(kind, s):
        digits = re.sub("[^0-9]", "", s)
        if kind == "ip":
            return all(int(p) <= 255 for p in s.split("."))
        if kind == "card":
            return 13 <= len(digits) <= 19 and pii.luhn(digits)
        return kind != "phone" or 9 <= len(digits) <= 15

    r = random.Random(4)
    for _ in range(3000):
        text = "".join(r.choices(["a", "1", "2", "255", ".", ".", "@", "@", "-", " ", "+", "(", "4111111111111111", "x.y@z.w", "\n", "é"], k=r.randint(0, 14)))
        assert pii.base_spans(text) == {k: [m.span() for m in p.finditer(text) if keep(k, m.group())] for k, p in plain.items()}, text


def test_luhn():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


def test_long_texts_take_linear_time():
    for piece in ("a", "1", "1.", "@", "a@", "+1", "1 ", "("):
        pii.base_spans(piece * 200_000)
        pii.stretches(piece * 5_000)


def test_model_on_held_out_sentences():
    precision, recall = pii.share_found(pii.trained(), pii.training_sentences(200, 12345))
    assert precision > 0.95 and recall > 0.9


def test_best_is_best():
    """Dynamic programming against all segmentations of a short stretch."""
    model = pii.trained()
    text = "call +1 555 123 4567 or 12"
    tokens, held = pii.stretches(text)[0]
    lattice = n, segs, feats = model.lattice(text, tokens, held)
    s = model.scores(feats)

    def ways(at):
        if at == n:
            yield []
            return
        for rest in ways(at + 1):
            yield [(at, at + 1, None), *rest]
        for x, (i, j) in enumerate(segs):
            if i == at:
                for rest in ways(j):
                    for lab in range(len(pii.KINDS)):
                        yield [(i, j, (x, lab)), *rest]

    def value(way):
        total, prev = 0.0, 0
        for _, _, seg in way:
            now = 0 if seg is None else seg[1] + 1
            total += model.t[prev, now] + (0 if seg is None else s[seg[0], seg[1]])
            prev = now
        return total

    tops = max(ways(0), key=value)
    assert [(i, j, seg[1]) for i, j, seg in tops if seg] == model.best(lattice)


def test_spans_and_redaction(spark, odd, empty):
    got = {r["doc_id"]: r for r in pii.with_spans(odd).collect()}
    text = got[10]["text"]
    kinds = {s["kind"]: text[s["start"] : s["end"]] for s in got[10]["pii_spans"]}
    assert kinds == {"email": "jo.doe_1@mail.example.com", "ip": "10.0.0.1", "card": "4111 1111 1111 1111", "phone": "+1 (555) 123-4567"}
    assert not got[1]["pii_spans"] and not got[5]["pii_spans"]
    out = {r["doc_id"]: r for r in pii.redact(odd).collect()}
    assert out[10]["text"] == "Write to <EMAIL> or call <PHONE> now, host <IP>, card <CARD>." and out[5]["text"] is None and out[8]["text"] == LONG
    assert pii.redact(odd).columns == odd.columns and pii.with_spans(empty).count() == 0


def test_op1_counts(spark):
    got = {r["doc_id"]: r for r in Q.op1_pii(spark, DATA).collect()}
    docs = spark.read.parquet(f"{DATA}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        base = pii.base_spans(d["text"])
        assert got[d["doc_id"]]["n_email"] == len(base["email"]) and got[d["doc_id"]]["n_card"] == len(base["card"])
        assert got[d["doc_id"]]["base_sha256"] == pii.base_digest([(k, *s) for k in pii.BASE_KINDS for s in base[k]])


# ------------------------------------------------------------ op2


@given(st.binary(max_size=3000), st.integers(2, 8))
@settings(max_examples=60, deadline=None)
def test_lzw_round_trip(raw, depth):
    samples = bytes(b % (1 << depth) for b in raw)
    assert gif.lzw_decode(gif.lzw_encode(samples, depth), depth) == samples


def test_lzw_long_streams():
    r = random.Random(1)
    for samples in (b"a" * 100_000, bytes(r.randrange(256) for _ in range(60_000)), bytes(r.choice(b"ab") for _ in range(60_000))):
        assert gif.lzw_decode(gif.lzw_encode(samples), 8) == samples


def test_clear_codes_in_the_stream():
    """4 colours: clear, 1, clear, 2, 2, end, all of 3 bits."""
    codes = [4, 1, 4, 2, 2, 5]
    bits = sum(c << 3 * i for i, c in enumerate(codes))
    assert gif.lzw_decode(bits.to_bytes(3, "little"), 2) == b"\x01\x02\x02"
    with pytest.raises(ValueError):
        gif.lzw_decode(b"\x0c", 2)


def test_disposal_transparency_and_interlace():
    palette = np.array([[0, 0, 0], [255, 0, 0], [0, 255, 0], [0, 0, 255]], np.uint8)
    full = np.full((4, 4), 1, np.uint8)
    spot = np.array([[2, 3], [3, 2]], np.uint8)
    frames = [gif.Frame(full, 0, 0, palette, 5, 1), gif.Frame(spot, 1, 1, palette, 7, 2, transparent=3), gif.Frame(spot, 0, 0, palette, 9, 3), gif.Frame(spot[:1], 2, 3, palette, 1, 0)]
    shown = [(f.delay_cs, c.copy()) for f, c in gif.compose(*gif.decode(gif.encode(4, 4, palette, frames)))]
    assert [d for d, _ in shown] == [5, 7, 9, 1]
    assert (shown[0][1][..., 0] == 255).all()
    assert shown[1][1][1, 1].tolist() == [0, 255, 0, 255] and shown[1][1][1, 2].tolist() == [255, 0, 0, 255]
    assert shown[2][1][1:3, 2].tolist() == [[0, 0, 0, 0]] * 2  # restored to nothing
    assert shown[3][1][0, 0].tolist() == [255, 0, 0, 255]  # restored to what was there before
    data = bytearray(gif.encode(2, 8, palette, [gif.Frame(np.repeat(np.arange(8, dtype=np.uint8)[:, None] % 4, 2, 1), 0, 0, palette)]))
    data[data.index(b"\x2c", 25) + 9] |= 0x40
    stored = np.arange(8) % 4
    rows = np.argsort(np.concatenate([np.arange(0, 8, 8), np.arange(4, 8, 8), np.arange(2, 8, 4), np.arange(1, 8, 2)]))
    assert next(gif.decode(bytes(data))[2]).samples[:, 0].tolist() == stored[rows].tolist()


def test_gif_table(spark, odd, empty):
    stored = Workspace(spark, "gif").keep(gif.store_texts(odd), "s")
    got = gif.digests(stored).collect()
    assert len(got) == len(TEXTS)
    for r in got:
        text = next((t for i, t, *_ in TEXTS if i == r["doc_id"]), None) or ""
        payload = text.encode() + b" " * (max(192, -(-len(text.encode()) // 192) * 192) - len(text.encode()))
        assert r["n_bytes"] == len(text.encode()) and r["payload_bytes"] == len(payload)
        assert r["payload_sha256"] == hashlib.sha256(payload).hexdigest() and r["tail_crc32"] == zlib.crc32(payload[-16:])
    frames = gif.frames(stored).where("doc_id = 8").orderBy("frame").collect()
    assert [f["start_ms"] for f in frames] == [100 * k for k in range(len(frames))] and len(frames) > 1
    assert sum(map(sum, (f["histogram"] for f in frames))) == next(r["payload_bytes"] for r in got if r["doc_id"] == 8)
    broken = spark.createDataFrame([(1, bytearray(b"GIF89a")), (2, None)], "doc_id long, gif binary")
    assert [(r["doc_id"], r["error"] is not None) for r in gif.frames(broken).collect()] == [(1, True)]
    assert gif.digests(gif.store_texts(empty)).count() == 0


# ------------------------------------------------------------ op4


def test_licenses(spark, odd, empty):
    assert len({licenses.normal_form(s) for s in licenses.SENTENCES.values()}) == len(licenses.SENTENCES)
    S = licenses.SENTENCES
    mit = f"Copyright (c) Someone.\n\n{S['mit_grant']}:\n\n{S['mit_notice_kept']}.\n\n{S['mit_as_is']}.\n{S['mit_liability']}."
    wrapped = mit.replace(" rights to ", "\nrights to ").replace("COPYRIGHT HOLDERS BE", "COPYRIGHT\nHOLDERS BE")
    rows = [(1, mit), (2, wrapped), (3, f"{S['mit_notice_kept']}. {S['mit_grant']}."), (4, "prose\nReleased under the MIT License."), (5, f"{S['bsd_grant']}: {S['bsd_source']}. {S['bsd_binary']}. {S['bsd_names']}. {S['bsd_as_is']}."), (6, "This Released under the MIT License too."), (7, "Licensed under CC BY-NC 4.0.\n" * 2)]
    got = {r["doc_id"]: r["licenses"] for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: ["MIT"], 2: ["MIT"], 3: [licenses.UNKNOWN], 4: ["MIT"], 5: ["BSD-3-Clause"], 6: [], 7: ["CC-BY-NC-4.0"]}
    assert all(r["licenses"] == [] for r in licenses.scan(odd).collect()) and licenses.scan(empty).count() == 0


# ------------------------------------------------------------ op5


def slow_grams(text):
    out = Counter()
    for word in re.findall(r"[^\W\d_]+", text.lower()):
        padded = f" {word} "
        for n in range(1, langid.LONGEST + 1):
            for i in range(len(padded) - n + 1):
                g = padded[i : i + n]
                if n == 1 and g == " ":
                    continue
                out[g] += 1
    return out


def test_grams(monkeypatch):
    for text in ("Straße über Ähre, co-op 12x", "a", "", "...", "ab cd ef " * 30):
        assert sorted(langid.count_grams(text)[1].tolist()) == sorted(slow_grams(text).values())
    whole = langid.count_grams("one two three four five " * 50)
    monkeypatch.setattr(langid, "_PIECE", 32)
    pieces = langid.count_grams("one two three four five " * 50)
    assert all((a == b).all() for a, b in zip(whole, pieces))


def test_out_of_place(spark, odd, empty):
    rows = [("the cat and the dog", "en"), ("der hund und die katze", "de"), (None, "fr"), ("x", None)]
    profiles = langid.learn_profiles(spark.createDataFrame(rows, "text string, lang string"), top=40)
    assert sorted(profiles) == ["de", "en"]
    matcher = langid.Matcher(profiles, 40)
    for text in ("the dog", "und der hund", "zzz", "Über"):
        own = langid.ranked(*langid.count_grams(text), 40)
        scores = {}
        for lang, profile in profiles.items():
            at = {g: i for i, g in enumerate(profile.tolist())}
            scores[lang] = sum(abs(at[g] - i) if g in at else 40 for i, g in enumerate(own.tolist()))
        lang, score = matcher.predict(text)
        assert scores[lang] == min(scores.values()) and score == pytest.approx(1 - scores[lang] / (40 * len(own)))
    assert matcher.predict(None) == matcher.predict("12 !") == ("und", 0.0)
    got = langid.identify(odd, profiles, 40)
    assert {r["doc_id"]: r["lang_pred"] for r in got.collect()}[5] == "und"
    assert langid.learn_profiles(empty) == {} and {r["lang_pred"] for r in langid.identify(odd, {}).collect()} == {"und"}


def test_held_out_accuracy(spark):
    got = Q.op5_langid(spark, DATA).join(spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert got and sum(r["lang"] == r["lang_pred"] for r in got) >= 0.97 * len(got)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)


# ------------------------------------------------------------ op6


def slow_model(train, texts):
    tokens = lambda t: [*WORD.findall(low(t or "")), None]
    pairs, count = Counter(), Counter()
    for t in train:
        before = "<s>"
        for w in tokens(t):
            pairs[before, w] += 1
            count[w] += 1
            before = w
    before, total, kinds = Counter(), Counter(), {}
    for (u, w), n in pairs.items():
        before[w] += 1
        total[u] += n
        kinds.setdefault(u, Counter())[min(n, 3)] += 1
    n_of = lambda values: [sum(v == k for v in values) for k in (1, 2, 3, 4)]
    d2 = (0, *kneser_ney.discounts(*n_of(pairs.values())))
    d1 = (0, *kneser_ney.discounts(*n_of(before.values())))
    N, V, types = sum(count.values()), len(count), len(pairs)
    mass = sum(d1[min(v, 3)] for v in before.values()) / max(types, 1)
    out = []
    for t in texts:
        base = score = 0.0
        u = "<s>"
        for w in tokens(t):
            base += math.log10((count[w] + 1) / (N + V + 1))
            p1 = max(before[w] - d1[min(before[w], 3)], 0) / max(types, 1) + mass / (V + 1)
            p = p1
            if total[u]:
                n = pairs[u, w]
                p = max(n - d2[min(n, 3)], 0) / total[u] + sum(d2[k] * kinds[u][k] for k in (1, 2, 3)) / total[u] * p1
            score += math.log10(p) if N else 0
            u = w
        out.append((len(tokens(t)), sum(count[w] > 0 for w in tokens(t)), N, base, score))
    return out


def test_kneser_ney_against_brute_force(spark, odd, empty):
    docs = [r["text"] for r in spark.read.parquet(f"{DATA}/documents.parquet").select("text").limit(80).collect()]
    train, test = docs[:60], [*docs[40:], "never seen words here", "", None]
    df = spark.createDataFrame([(t,) for t in train], "text string").repartition(5)
    model = kneser_ney.train(df, Workspace(spark, "kn"))
    got = kneser_ney.score(spark.createDataFrame(list(enumerate(test)), "doc_id long, text string"), model).orderBy("doc_id").collect()
    for r, want in zip(got, slow_model(train, test)):
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == want[:3]
        assert r["base_score"] == pytest.approx(want[3], rel=1e-9) and r["score"] == pytest.approx(want[4], rel=1e-9)
    assert kneser_ney.score(odd, model).count() == len(TEXTS)
    nothing = kneser_ney.train(empty, Workspace(spark, "kn"))
    assert all(r["score"] == 0 and r["base_score"] == 0 for r in kneser_ney.score(odd, nothing).collect())


def test_probabilities_sum_to_one(spark):
    train = ["a b a c", "b a", "c c a b", "a"]
    model = kneser_ney.train(spark.createDataFrame([(t,) for t in train], "text string"), Workspace(spark, "kn"))
    words = bw.split_words(*bw.text_buffers(pa.array(["a b c neverseen"])))
    every = np.append(words.hashes(), kneser_ney.END)
    for context in [*every, kneser_ney.START]:
        _, _, logp = model.token_scores(every, np.full(len(every), context))
        assert (10.0**logp).sum() == pytest.approx(1.0)


def test_pairs_pack():
    rows = np.zeros(7, kneser_ney.PAIR)
    rows["left"], rows["right"], rows["n"] = [9, 1, 9, 5, 1, 2**63, 0], [3, 2, 1, 9, 8, 5, 0], [1, 2, 3, 4, 5, 70000, 7]
    assert sorted(kneser_ney.unpack_pairs(kneser_ney.pack_pairs(rows)).tolist()) == sorted(rows.tolist())
    assert len(kneser_ney.unpack_pairs(kneser_ney.pack_pairs(rows[:0]))) == 0
