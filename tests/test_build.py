"""The life of a dictionary over small extracts."""

import gzip
import json
import time

import pytest

from wordmill.operators import delta, lexicon, snapshot
from wordmill import schemas as S
from wordmill.plans import build, config
from wordmill.sources import entries
from wordmill.streaming import ingest as streaming


def entry(word, pos, *glosses, lang="English", code="en", **more):
    return {"word": word, "lang": lang, "lang_code": code, "pos": pos, "senses": [{"glosses": [g]} for g in glosses]} | more


BASE = [
    entry("apple", "noun", "A fruit."),
    entry("run", "verb", "To move quickly on two feet."),
    entry("run", "noun", "An act of moving quickly."),
    entry("blue", "adj", "Of the colour of a clear sky.", "Sad or gloomy."),
    entry("Haus", "noun", "House.", lang="German", code="de"),
]


def write(path, rows, extra=""):
    with gzip.open(path, "wt", encoding="utf-8") as f:
        f.write("\n".join(json.dumps(r) for r in rows) + "\n" + extra)
    return str(path)


def maker():
    def make(word, defs):
        return f"short {word}"

    return make  # made in a function, so that workers get its code and not its name


make = maker()


@pytest.fixture
def store(spark, tmp_path):
    return build.Store(spark, str(tmp_path / "state"))


def step(store, tmp_path, name, rows, **options):
    build.ingest(store, write(tmp_path / f"{name}.jsonl.gz", rows))
    return build.plan_update(store), build.enhance_changed(store, make, most_words=5, **options)


def statuses(plan):
    return tuple(plan[f"{s}_words"] for s in ("new", "changed", "unchanged", "deleted"))


def test_scenarios(store, tmp_path):
    first = write(tmp_path / "base.jsonl.gz", BASE)
    one = build.ingest(store, first)
    assert build.ingest(store, first) == one
    words = {r["word_key"]: r for r in store.extract("source_words", build.S.SOURCE_WORDS, one).collect()}
    assert set(words) == {"apple", "run", "blue"} and words["apple"]["is_pure_alpha"]
    definitions = store.extract("source_definitions", build.S.SOURCE_DEFINITIONS, one)
    assert sorted((r["word_key"], r["source_idx"], r["pos"]) for r in definitions.collect()) == [("apple", 0, "noun"), ("blue", 0, "adjective"), ("blue", 1, "adjective"), ("run", 0, "verb"), ("run", 1, "noun")]
    assert words["apple"]["word_hash"] == "1fc3935a2c392b97aec10693e6d2a6ac61287e55d2e39ade78ce0ed8c0427871"
    plan = build.plan_update(store)
    assert plan["prior_extract_id"] is None and statuses(plan) == (3, 0, 0, 0) and plan["words_to_regenerate"] == 3
    assert build.enhance_changed(store, make, 5, dry_run=True) == {"to_do": 3, "reused": 0}
    assert build.enhance_changed(store, make, 5) == {"enhanced": 3, "reused": 0}
    assert build.enhance_changed(store, make, 5) == {"enhanced": 0, "reused": 3}
    lines = {r["word_key"]: (r["pocket_definition"], r["enhanced_source"]) for r in store.read("enhanced_words", build.S.ENHANCED_WORDS).collect()}
    assert lines == {"apple": ("A fruit.", "passthrough"), "run": ("short run", "llm"), "blue": ("short blue", "llm")}
    assert build.export_current(store) == {"words": 3, "definitions": 3, "pure_words": 3}
    r = build.report(store).first()
    assert (r["words"]["total"], r["source_definitions"]["total"], r["export"]["words"], r["pocket_definitions"]["llm"]) == (3, 5, 3, 2)
    assert build.status(store)["has_unpublished_extract"]
    meta, _, _ = build.publish_plan(store)
    assert meta["mode"] == "full" and meta["words_inserted"] == 3
    build.mark_published(store, "d1", "v1")
    assert not build.status(store)["has_unpublished_extract"]
    assert build.publish_plan(store)[0]["mode"] == "skip"

    changed = [*BASE[:1], entry("run", "verb", "To go fast."), *BASE[2:], entry("green", "adj", "Of the colour of grass in spring.")]
    plan, made = step(store, tmp_path, "changed", changed)
    assert statuses(plan) == (1, 1, 2, 0) and made == {"enhanced": 2, "reused": 2}
    build.export_current(store)
    meta, defs, words_sql = build.publish_plan(store)
    assert meta["mode"] == "delta" and meta["words_inserted"] == 1 and meta["total_ops"] == 2  # the line of run is the same
    assert {r["op"] for r in words_sql.collect()} == {"insert"} and defs.count() == 1
    # back to the first content, in other bytes: found in the cache
    plan, made = step(store, tmp_path, "back", [*BASE, entry("Katze", "noun", "Cat.", lang="German", code="de")])
    assert statuses(plan) == (0, 1, 2, 1) and made == {"enhanced": 0, "reused": 3} and plan["words_to_regenerate"] == 0


@pytest.mark.parametrize("edit,want", [(lambda b: b[:3] + b[4:], (0, 0, 2, 1)), (lambda b: [entry("Apple", "noun", "A fruit.")] + b[1:], (0, 1, 2, 0)), (lambda b: [entry("apple", "noun", "A fruit")] + b[1:], (0, 1, 2, 0))])
def test_edits(store, tmp_path, edit, want):
    step(store, tmp_path, "base", BASE)
    assert statuses(step(store, tmp_path, "edit", edit(BASE))[0]) == want


def test_gates_and_shapes(spark, tmp_path):
    rows = [
        {"word": "untagged", "gloss": "Kept."},
        entry("eng", "noun", "Kept.", lang=None, code="eng"),
        entry("mispel", "noun", "Misspelling of misspell."),
        {"word": "tagged", "senses": [{"glosses": ["x."], "tags": ["misspelling"]}]},
        {"word": "blank", "senses": [{"glosses": ["   "]}]},
        {"title": "shape", "entries": {"verb": [{"definition": "b"}, "c"], "noun": [{"text": "a"}]}},
        {"lemma": "flat", "part-of-speech": "n", "definitions": ["x", "y", "x"]},
        {"word": "nested", "pos": "v", "senses": [{"gloss": "g", "glosses": ["g", "h"]}, {"pos": "n", "meaning": "m"}]},
        {"word": 5, "title": "not this", "gloss": "number"},
        {"word": "", "title": "second", "gloss": "empty first"},
        {"word": "none"},
        [1, 2],
    ]
    lines = entries.read_lines(spark, write(tmp_path / "x.jsonl.gz", rows, extra="\n{bad\n"))
    kept = entries.gated(entries.parse(lines))
    got = {r["word"]: [(d["pos"], d["gloss"]) for d in r["defs"]] for r in kept.collect()}
    assert got == {
        "untagged": [(None, "Kept.")],
        "eng": [("noun", "Kept.")],
        "blank": [(None, "   ")],
        "shape": [("verb", "b"), ("verb", "c"), ("noun", "a")],
        "flat": [("n", "x"), ("n", "y")],
        "nested": [("v", "g"), ("v", "h"), ("n", "m")],
        "second": [(None, "empty first")],
    }
    assert entries.rejected(lines).count() == 2
    defs = snapshot.source_definitions(entries.exploded(kept))
    words = {r["word_key"]: r["word_hash"] for r in snapshot.source_words(kept, defs).collect()}
    assert words["blank"] == "" and len(words["flat"]) == 64


def test_display_form(spark):
    rows = spark.createDataFrame([(1, "AMP", "en"), (2, "Amp", "de"), (3, "amp", "fr"), (4, "Ämp", None), (5, "ÄMP", "x")], "line_no int, word string, lang_code string")
    none = spark.createDataFrame([], build.S.SOURCE_DEFINITIONS)
    got = {r["word_key"]: (r["display_word"], r["language_code"]) for r in snapshot.source_words(rows, none).collect()}
    assert got == {"amp": ("amp", "fr"), "ämp": ("Ämp", "en")}


def test_failed_run_is_done_again(store, tmp_path, monkeypatch):
    path = write(tmp_path / "a.jsonl.gz", BASE)

    def broken(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(build.snapshot, "source_words", broken)
        with pytest.raises(RuntimeError):
            build.ingest(store, path, now=10)
    assert store.latest() == []
    assert build.ingest(store, path, now=20) == 1 and store.latest() == [1]


def test_lexicon_artifact(store, tmp_path):
    step(store, tmp_path, "base", BASE)
    build.export_current(store)
    manifest = build.write_lexicon(store, str(tmp_path / "lex"))
    data = (tmp_path / "lex" / "lexicon.trie").read_bytes()
    assert list(lexicon.Wtri(data).words()) == ["apple", "blue", "run"] and manifest["node_count"] == 4 and manifest["edge_count"] == 3


def test_settings_drive_a_build(spark, tmp_path):
    rows = [entry("run", "verb", "To move on two feet. More.", "To manage.", "To flow."), entry("apple", "noun", "A round fruit that grows on trees.")]
    text = f'state = "{tmp_path}/state"\ninput = "{write(tmp_path / "in.jsonl.gz", rows)}"\noutput = "{tmp_path}/out"\nmax_defs = 2\nmax_words = 3\nmax_retry_count = 2\n'

    def make(word, defs, attempt=0):
        return f"{len(defs)} {word}"

    told = build.run(spark, config.parse(text), make, now=5)
    assert (told["new_words"], told["enhanced"], told["words"], told["lexicon"]["node_count"]) == (2, 2, 2, 3)
    made = build.Store(spark, f"{tmp_path}/state").read("enhanced_words", S.ENHANCED_WORDS)
    assert {r["word_key"]: (r["pocket_definition"], r["source_definition_count"]) for r in made.collect()} == {"run": ("2 run", 2), "apple": ("1 apple", 1)}
    assert (tmp_path / "out" / "manifest.json").exists()


def test_delta_brings_prior_to_new(spark):
    prior = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id long, definition string")
    new = spark.createDataFrame([(1, "a"), (2, "x"), (4, "d"), (3, "n")], "id long, definition string")
    changes = delta.definition_changes(new, prior)
    assert sorted((r["op"], r["id"]) for r in changes.collect()) == [("insert", 4), ("update", 2)]
    got = sorted(delta.apply(prior, changes, "id", "definition").collect(), key=lambda r: r["id"])
    assert [tuple(r) for r in got] == [(1, "a"), (2, "x"), (3, None), (4, "d")]


def test_snapshot_delta_keeps_shared_definitions(spark):
    snaps = spark.createDataFrame([("a", "changed"), ("b", "deleted"), ("c", "deleted"), ("d", "new")], "word_key string, word_status string")
    words = spark.createDataFrame([(1, "a"), (4, "d")], "id long, word string")
    prior = spark.createDataFrame([(1, "a"), (1, "b"), (3, "c")], "id long, word string")
    defs = spark.createDataFrame([(1, "one"), (4, "four")], "id long, definition string")
    word_ops, def_ops = delta.snapshot_changes(snaps, words, defs, prior)
    assert sorted(tuple(r) for r in word_ops.select("op", "word").collect()) == [("delete", "b"), ("delete", "c"), ("upsert", "a"), ("upsert", "d")]
    assert sorted(tuple(r) for r in def_ops.select("op", "id").collect()) == [("delete", 3), ("upsert", 1), ("upsert", 4)]


def test_stream_is_the_batch(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    write(folder / "a.jsonl.gz", BASE[:2])
    table, check = str(tmp_path / "t"), str(tmp_path / "c")
    streaming.stream_entries(spark, str(folder), table, check, 1).awaitTermination(120)
    time.sleep(1.1)
    write(folder / "b.jsonl.gz", BASE[2:])
    streaming.stream_entries(spark, str(folder), table, check, 1).awaitTermination(120)
    kept = streaming.read_entries(spark, table)
    defs = snapshot.source_definitions(entries.exploded(kept))
    assert sorted(r["word_key"] for r in defs.collect()) == ["apple", "blue", "blue", "run", "run"]
    assert {r["word_key"] for r in snapshot.source_words(kept, defs).collect()} == {"apple", "blue", "run"}
