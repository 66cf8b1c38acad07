import itertools
import random

from wordmill.operators import dedupe, enhance, export, forms, lexicon, lookup, state, verify


def rows(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())


def test_chains_cycles_and_notes(spark):
    d = [("abbassides", 0, "plural of abbasside."), ("abbasside", 0, "Alternative form of Abbasid"), ("x", 0, "plural of y"), ("y", 0, "plural of x"), ("z", 0, "plural of x"), ("self", 0, "plural of self"), ("mixed", 0, "plural of a"), ("mixed", 1, "A thing."), ("lost", 0, "clipping of nowhere")]
    links = forms.form_links(spark.createDataFrame(d, "word_key string, source_idx int, source_first_sentence string"))
    assert {r[0] for r in rows(links)} == {"abbassides", "abbasside", "x", "y", "z", "lost"}
    got = {r[0]: r[1] for r in rows(forms.resolve_chains(links), "form_key", "base_key")}
    assert got == {"abbassides": "abbasid", "abbasside": "abbasid", "y": "x", "z": "x", "lost": "nowhere"}
    many = spark.createDataFrame([("b", f"f{i}", "plural") for i in range(5)] + [("b", "a1", "alt_form"), ("b", "a2", "alt_spell")], "base_key string, form_key string, form_type string")
    assert rows(forms.forms_notes(many)) == [("b", " (also: a1, a2; plural: f0, f1, f2, ...)")]
    assert len(forms.forms_of(many).first()["forms"]) == 7


def test_export_ids(spark):
    resolved = spark.createDataFrame([("house", "A home."), ("houses", "plural of house."), ("lost", "clipping of nowhere")], "word_key string, definition string")
    links = spark.createDataFrame([("houses", "house", "plural"), ("lost", "nowhere", "clipping")], "form_key string, base_key string, form_type string")
    words, definitions = export.export(resolved, links)
    ids = {w: i for i, w in words.collect()}
    assert ids["house"] == ids["houses"] == 60484214207945349 != ids["lost"]
    assert dict(definitions.collect()) == {ids["house"]: "A home. (plural: houses)", ids["lost"]: "clipping of nowhere"}
    assert export.missing_ids(words, definitions).count() == 0 and export.colliding_ids(words, links).count() == 0


def test_similar_pairs_are_all_pairs(spark):
    r = random.Random(5)
    texts = [" ".join(r.choices("abcdefghij", k=r.randint(0, 8))) for _ in range(80)] + ["the of", "", "x y z x", "z y x"]
    df = spark.createDataFrame([(i % 3, i, t) for i, t in enumerate(texts)], "g int, k int, t string")
    stop = {"a", "the", "of"}
    sets = [set(t.split()) - stop for t in texts]
    for threshold in (0.5, 0.8):
        want = {(i, j) for i, j in itertools.combinations(range(len(texts)), 2) if i % 3 == j % 3 and sets[i] and sets[j] and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= threshold}
        assert {(p["i"], p["j"]) for p in dedupe.similar_pairs(df, "g", "k", "t", threshold).collect()} == want


def test_merge_and_decide(spark):
    df = spark.createDataFrame([("w", 0, "A fruit."), ("w", 1, "A fruit; red"), ("w", 2, "Tree. Big"), ("w", 3, "Tree"), ("v", 0, "A fruit.")], "g string, k int, t string")
    assert rows(dedupe.extension_pairs(df, "g", "k", "t")) == [("w", 0, 1, "A fruit; red"), ("w", 3, 2, "Tree. Big")]
    assert rows(dedupe.merge_first(df, "g", "k", "t"), "k", "merged")[0] == (0, "A fruit; red")
    near = spark.createDataFrame([("w", 0, "red round fruit"), ("w", 1, "red round big fruit"), ("w", 2, "red round fruit"), ("w", 3, "other"), ("v", 0, "one"), ("u", 0, "red x"), ("u", 1, "x red")], "g string, k int, t string")
    got = dedupe.decide_duplicates(near, "g", "k", "t", lambda a, b: ("merge", f"{a}+") if a[0] == "r" and len(a) > 6 else ("keep_both", ""))
    assert rows(got) == [("u", 0, "red x"), ("u", 1, "x red"), ("v", 0, "one"), ("w", 0, "red round fruit+"), ("w", 3, "other")]


def test_enhance_limits_and_failures(spark):
    words = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], "word_key string, word_hash string")
    defs = spark.createDataFrame([(w, i, "noun", f"{w} line of {i}") for w in "abc" for i in (0, 1)], "word_key string, source_idx int, pos string, source_first_sentence string")
    cache = spark.createDataFrame([], enhance.ENHANCED_WORDS)
    made = enhance.enhance(words, defs, cache, lambda w, d: None if w == "b" else "x " * (9 if w == "c" else 2), 4, now=1)
    assert rows(made, "word_key", "pocket_definition") == [("a", "x x")]
    assert enhance.work_list(words, defs, cache, 4, limit=2).count() == 2
    snaps = spark.createDataFrame([(1, w, w, "new", 2, "regenerate") for w in "abc"], "extract_id long, word_key string, display_word string, word_status string, source_definition_count long, enhancement_action string")
    assert rows(enhance.after_run(snaps, words, made), "word_key", "enhancement_action") == [("a", "regenerate"), ("b", "pending"), ("c", "pending")]


def test_trie_round_trip(spark):
    r = random.Random(2)
    words = sorted({"".join(r.choices("abc", k=r.randint(1, 6))) for _ in range(150)})
    df = spark.createDataFrame([(w,) for w in [*words, words[0], ""]], "word string")
    kept = lexicon.radix_nodes(lexicon.trie_nodes(df))
    stats = lexicon.trie_stats(kept).first()
    assert stats["edge_count"] == stats["node_count"] - 1


def test_verify_and_lookup(spark):
    lines = spark.createDataFrame([("a", 0, "src", "good"), ("b", 0, "src", "a b c d e f g"), ("c", 0, "src", "...")], "word string, idx int, source string, line string")
    checked = verify.check_lines(lines, "line", 2)
    assert verify.hit_rate(checked).first()["hit_rate"] == 1 / 3 and verify.hit_rate(checked.where("false")).first()["hit_rate"] == 0.0
    assert rows(verify.to_reprocess(checked, "word")) == [("b",), ("c",)]
    judged = verify.check_lines_with(lines, "source", "line", lambda s, c: (False, "parse_error"), 2)
    assert rows(judged, "word", "valid") == [("a", True), ("b", False), ("c", True)]
    assert [r["word"] for r in verify.sample(lines, ["word"], 2).collect()] == ["a", "b"]
    back = spark.createDataFrame([("a", 0, "new")], "word string, idx int, line string")
    assert rows(verify.apply_rewrite(lines.select("word", "idx", "line"), back, ["word", "idx"], "line"))[0] == ("a", 0, "new")
    words = spark.createDataFrame([(1, "apple")], "id long, word string")
    defs = spark.createDataFrame([(1, "A fruit.")], "id long, definition string")
    asked = spark.createDataFrame([(" Apple ",), ("pear",), ("  ",)], "word string")
    assert rows(lookup.define(asked, words, defs), "key", "status") == [("", 400), ("apple", 200), ("pear", 404)]
    assert rows(lookup.validate(asked, words), "key", "valid") == [("", False), ("apple", True), ("pear", False)]


def test_published_state(spark):
    old = spark.createDataFrame([("d1", 1, 5, "v1")], "target string, extract_id long, published_at long, artifact_version string")
    new = state.publish(state.publish(old, "d1", 2, "v2", 9), "trie", 2, "v1", 9)
    assert rows(new, "target", "extract_id") == [("d1", 2), ("trie", 2)]
