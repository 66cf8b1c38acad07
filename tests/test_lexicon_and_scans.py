"""The radix file from ranges against a plain builder, lookups in it, and scans over keys of any size."""

import random
import struct

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from wordmill.operators import dedupe, forms, lexicon, ordered, snapshot


def plain_file(words):
    """The file by a dictionary tree, nodes numbered depth first."""
    words = sorted({w for w in words if w})
    kept = {""} | set(words)
    for a, b in zip(words, words[1:]):
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        kept.add(a[:n])
    nodes = sorted(kept)
    children = {p: [] for p in nodes}
    for p in nodes[1:]:
        up = next(p[:n] for n in range(len(p) - 1, -1, -1) if p[:n] in kept)
        children[up].append(p)
    number = {p: i for i, p in enumerate(nodes)}
    first, count, start, length, target, labels, bits = [], [], [], [], [], b"", bytearray(-(-len(nodes) // 8))
    for i, p in enumerate(nodes):
        first.append(len(start))
        count.append(len(children[p]))
        for c in children[p]:
            start.append(len(labels))
            length.append(len(c) - len(p))
            target.append(number[c])
            labels += c[len(p) :].encode()
        if p in words:
            bits[i // 8] |= 1 << i % 8
    n, e = len(nodes), len(start)
    head = b"WTRI" + struct.pack("<BBHIIII", 1, 0, 0, n, e, len(labels), len(bits))
    return head + struct.pack(f"<{n}I{n}I{e}I{e}H{e}I", *first, *count, *start, *length, *target) + bytes(bits) + labels


def some_words(seed):
    r = random.Random(seed)
    return sorted({"".join(r.choices("abcd", k=r.randint(1, 9))) for _ in range(400)} | {"a" * n for n in range(1, 30)})


@pytest.mark.parametrize("shard", [8, 64, 1 << 20])
def test_file_is_that_of_a_plain_builder(spark, tmp_path, shard):
    words = some_words(shard)
    df = spark.createDataFrame([(w,) for w in [*words, words[0], "", words[-1]]], "word string").repartition(5)
    kept = lexicon.radix_of_words(df)
    rows = lambda d: sorted(map(tuple, d.collect()))
    assert rows(kept) == rows(lexicon.radix_nodes(lexicon.trie_nodes(df)))
    path = str(tmp_path / "x.trie")
    told = lexicon.write_wtri(kept, path, shard)
    data = (tmp_path / "x.trie").read_bytes()
    assert data == plain_file(words) and told["bytes"] == len(data) and told["node_count"] == kept.count() and told["edge_count"] == told["node_count"] - 1
    tree = lexicon.Wtri(data)
    assert list(tree.words()) == words
    for step in (1, 7, 100):
        assert [w for low in range(0, told["node_count"], step) for w in tree.words(low, low + step)] == words
    assert [r["word"] for r in lexicon.file_words(spark, path, shard).orderBy("word").collect()] == words
    asked = [*words, *(w + "a" for w in words), *(w[:-1] for w in words), "", None, "é", "zzz", "aé"]
    got = lexicon.in_file(spark.createDataFrame([(w, i) for i, w in enumerate(asked)], "word string, valid int"), path).collect()
    assert {r["word"]: r["valid"] for r in got} == {w: None if w is None else w in set(words) for w in asked} and len(got) == len(asked)
    edges = {r["prefix"]: (r["node"], r["parent"], r["parent_node"], r["label"]) for r in lexicon.linked(kept).collect()}
    for prefix, (_, parent, number, label) in edges.items():
        assert prefix == "" and parent is None or parent + label == prefix and edges[parent][0] == number and not any(parent < p < prefix and prefix.startswith(p) for p in edges)
    assert [p for p, _ in sorted(edges.items(), key=lambda e: e[1][0])] == sorted(edges)


def test_files_of_nothing_and_of_too_much(spark, tmp_path, monkeypatch):
    none = lexicon.radix_of_words(spark.createDataFrame([("",)], "word string"))
    lexicon.write_wtri(none, str(tmp_path / "e.trie"))
    assert (tmp_path / "e.trie").read_bytes() == plain_file([]) and lexicon.file_words(spark, str(tmp_path / "e.trie")).count() == 0
    assert not lexicon.in_file(spark.createDataFrame([("a",)], "word string"), str(tmp_path / "e.trie")).first()["valid"]
    foreign = lexicon.radix_of_words(spark.createDataFrame([("é",), ("a",)], "word string"))
    with pytest.raises(Exception, match="ASCII"):
        lexicon.write_wtri(foreign, str(tmp_path / "f.trie"))
    long = lexicon.radix_of_words(spark.createDataFrame([("a" * 70_000,), ("b",)], "word string"))
    with pytest.raises(Exception, match="65535"):
        lexicon.write_wtri(long, str(tmp_path / "g.trie"))
    with pytest.raises(ValueError, match="no WTRI"):
        lexicon.Wtri(b"XTRI" + bytes(40))


def test_no_window_over_all_nodes(spark):
    words = spark.createDataFrame([(w,) for w in some_words(1)], "word string")
    plan = lexicon.numbered(lexicon.radix_of_words(words))._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


# ------------------------------------------------------------ scans


@pytest.fixture(scope="module")
def hot(spark):
    """Rows of which one word has half, some a few, null and a value that is missing now and then."""
    r = random.Random(4)
    rows = [("hot" if i % 2 else r.choice([None, "a", "b", f"w{r.randint(0, 50)}"]), i, r.choice([None, *range(40)])) for i in range(3000)]
    r.shuffle(rows)
    return spark.createDataFrame(rows, "k string, i long, v long").repartition(4)


@pytest.mark.parametrize("ranges", ["2", "13", "400"])
@pytest.mark.parametrize("how", ["sum", "max"])
def test_running_over_ranges_is_a_window_by_key(spark, hot, ranges, how, monkeypatch):
    monkeypatch.setattr(ordered, "KEY_ROWS", 1000)
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        agg = {"sum": F.sum, "max": F.max}[how]
        want = hot.withColumn("x", agg("v").over(Window.partitionBy("k").orderBy("i")))
        got = ordered.running(hot, "k", ["i"], F.col("v"), "x", how)
        rows = lambda d: sorted(map(repr, d.select("k", "i", "v", "x").collect()))
        assert rows(got) == rows(want)
        assert rows(ordered.numbered(hot, ["i"], "x")) == rows(hot.withColumn("x", F.col("i")))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("most", [100, 1 << 20])
def test_a_word_with_half_of_the_rows(spark, hot, most, monkeypatch):
    monkeypatch.setattr(ordered, "KEY_ROWS", most)
    rows = lambda d: sorted(map(repr, d.collect()))
    w = Window.partitionBy("k")
    got = snapshot.index_definitions(hot.na.fill(-1, ["v"]), "k", "v", ["i"], "n")
    first = hot.na.fill(-1, ["v"]).withColumn("p", F.row_number().over(Window.partitionBy("k", "v").orderBy("i"))).where("p = 1").drop("p")
    assert rows(got) == rows(first.withColumn("n", F.row_number().over(w.orderBy("i")).cast("long") - 1))
    best = hot.withColumn("b", F.max("v").over(w.orderBy("i").rowsBetween(Window.unboundedPreceding, -1))).where("b is null or v > b").drop("b")
    assert rows(dedupe.keep_running_best(hot, ["k"], "v", ["i"])) == rows(best)


def test_cycles_of_many_sizes(spark):
    links = []
    for n in (2, 3, 7, 20):
        links += [(f"c{n}-{i:02d}", f"c{n}-{(i + 1) % n:02d}", "plural") for i in range(n)] + [(f"a{n}-{i:02d}", f"a{n}-{i + 1:02d}" if i < 30 else f"c{n}-01", "plural") for i in range(31)]
    links += [(f"x{i:03d}", f"x{i + 1:03d}", "plural") for i in range(100)]
    got = {r["form_key"]: r["base_key"] for r in forms.resolve_chains(spark.createDataFrame(links, "form_key string, base_key string, form_type string")).collect()}
    want = {f: (f"{f.split('-')[0].replace('a', 'c')}-00" if "-" in f else "x100") for f, _, _ in links}
    assert got == {f: b for f, b in want.items() if f != b}


def test_limits_of_marks(spark):
    from wordmill.functions import text as T

    r = random.Random(8)
    pieces = ["12", "1", "a1", "(x)", "()", "(", ")", "+", "=", "--", "∑", "π", "→", "⇒", "∫", "²", "≤", "°", " ", "\n", "word", "Ü", "中"]
    texts = ["".join(r.choices(pieces, k=r.randint(0, 8))) for _ in range(1500)] + ["(" * 20, "x) (((1 (2", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    low = F.lower(T.strip(F.coalesce("t", F.lit(""))))
    words = F.regexp_count(low, F.lit(r"(?U)\S+"))
    helpful = (low != "") & (T.technical_marks(low) < 2) & (low.rlike(r"\p{L}") | ~((words <= 3) | (F.length(low) <= 10)))
    got = df.select("t", T.is_helpful("t").alias("a"), helpful.alias("b"), T.needs_context("t").alias("c"), F.coalesce(T.notation_marks("t") >= 3, F.lit(False)).alias("d")).collect()
    assert [r for r in got if r["a"] != r["b"] or r["c"] != r["d"]] == [] and 100 < sum(r["a"] for r in got) and 100 < sum(r["c"] for r in got)


def test_open_brackets_take_linear_time(spark):
    import time

    from wordmill.functions import text as T

    df = spark.createDataFrame([("(" * 300_000,)], "t string")
    began = time.time()
    assert not df.select(T.needs_context("t").alias("x")).first()["x"] and time.time() - began < 20
