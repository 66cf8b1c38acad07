import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wordmill import schemas
from wordmill.functions import forms as FM
from wordmill.functions import hashing as H
from wordmill.functions import text as T


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def cases():
    return [
        (T.normalize_word_key(F.lit("  Apple ")), "apple"),
        (T.normalize_word_key(F.lit("\t Apple\n")), "apple"),
        (T.normalize_pos(F.lit("adj")), "adjective"),
        (T.normalize_pos(F.lit("Noun")), "noun"),
        (T.normalize_pos(F.lit("")), None),
        (T.normalize_for_hash(F.lit("  hello   world  ")), "hello world"),
        (T.normalize_for_hash(F.lit("[[word]]")), "word"),
        (T.normalize_for_hash(F.lit("a<b>c</b>")), "a c"),
        (T.normalize_for_hash(F.lit(None).cast("string")), ""),
        (T.is_pure_alpha(F.lit("ABC")), True),
        (T.is_pure_alpha(F.lit("ice-cream")), False),
        (T.is_pure_alpha(F.lit("don't")), False),
        (T.is_pure_alpha(F.lit("hello world")), False),
        (H.hash_definition(F.lit("Apple"), F.lit("Noun"), F.lit("  A fruit. ")), "b8862a81874f02e3e367c88cdac011b421cdad1f2345bbcefc80c6699e85a4bc"),
        (H.stable_id(F.lit("apple")), 16461698612726333),
        (H.stable_id(F.lit("house")), 60484214207945349),
        (H.hash_word(F.lit("apple"), F.lit("apple"), F.array(F.lit("b8862a81874f02e3e367c88cdac011b421cdad1f2345bbcefc80c6699e85a4bc"))), "1fc3935a2c392b97aec10693e6d2a6ac61287e55d2e39ade78ce0ed8c0427871"),
        (T.casing_rank(F.lit("AMP")), 2),
        (T.casing_rank(F.lit("Amp")), 1),
        (T.casing_rank(F.lit("élan")), 0),
        (T.casing_rank(F.lit("12")), 1),
        (T.first_sentence(F.lit("One. Two.")), "One."),
        (T.first_sentence(F.lit("  ")), None),
        (T.word_count(F.lit("Être élan co-op 12 don't_x")), 7),
        (T.stem(F.lit("pneumatically")), "pneumatic"),
        (T.stem(F.lit("candies")), "candy"),
        (T.stem(F.lit("boxes")), "box"),
        (T.stem(F.lit("carving")), "carv"),
        (T.limit_words(F.lit("a b c d"), 2), "a b."),
        (T.limit_words(F.lit(" a b "), 2), "a b"),
        (T.strip_artifacts(F.lit("<think>no</think>```json {1}``` <b>x</b>")), "{1} x"),
        (T.strip_bracket_tags(F.lit("x [tag] y [z]")), "x y"),
        (T.is_extension(F.lit("A fruit."), F.lit("A fruit; red and round")), True),
        (T.is_extension(F.lit("A fruit."), F.lit("A fruit")), False),
        (T.is_extension(F.lit("A fruit, red and round"), F.lit("A fruit, red and round.")), False),
        (T.merge_extension(F.lit("A fruit."), F.lit("Round")), "A fruit; Round"),
        (T.is_helpful(F.lit("")), False),
        (T.is_helpful(F.lit("12 + 34 and 56")), False),
        (T.is_helpful(F.lit("= 1")), False),
        (T.is_helpful(F.lit("A fruit.")), True),
        (T.sanity_reason(F.lit("<b>x</b>"), 2), "tags"),
        (T.sanity_reason(F.lit("a b c d e f"), 2), "too_long"),
        (T.sanity_reason(F.lit("..."), 2), "empty"),
        (T.sanity_reason(F.lit("see http://x"), 9), "url"),
        (T.sanity_reason(F.lit("fine"), 2), "ok"),
        (T.sql_literal(F.lit("it's\nso")), "'it''s so'"),
        (T.sql_literal(F.lit(None).cast("string")), "NULL"),
        (T.accept_line(F.lit('"a b"'), 2), "a b"),
        (T.accept_line(F.lit("a b c d"), 2), None),
        (T.search_term(F.lit("Red fruit, round")), "Red fruit"),
        (T.similarity(T.content_words(F.lit("the red fruit")), T.content_words(F.lit("a red apple"))), 1 / 3),
        (T.similarity(T.content_words(F.lit("the")), T.content_words(F.lit("a red"))), 0.0),
        (T.format_eta(F.lit(60.0), F.lit(0.5)), "0:01:00"),
        (F.to_json(T.json_in(F.lit('so: {"a": 1} yes'))), '{"a":1}'),
        (FM.form_of(F.lit('Plural of "House".'))["base_key"], "house"),
        (FM.form_of(F.lit("third-person singular simple present indicative of run"))["form_type"], "third_person"),
        (FM.form_of(F.lit("A kind of fruit.")), None),
        (FM.form_label(F.lit("alt_form")), "also"),
        (FM.form_label(F.lit("past_tense")), "past tense"),
    ]


def test_values(spark):
    CASES = cases()
    got = spark.range(1).select(*[c.alias(f"c{i}") for i, (c, _) in enumerate(CASES)]).first()
    for i, (_, want) in enumerate(CASES):
        assert got[i] == want, i


def test_version():
    assert schemas.ENHANCEMENT_VERSION == "pocket_v1"


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=st.sampled_from("aZé. !?\t\n[]<>x;"), max_size=30), min_size=20, max_size=60))
def test_against_python(spark, texts):
    def normal(s):
        return re.sub(r"\s+", " ", re.sub(r"<[^>]+>", " ", re.sub(r"\[\[(.*?)\]\]", r"\1", s))).strip()

    rows = spark.createDataFrame([(i, s) for i, s in enumerate(texts)], "i int, s string").select("i", T.normalize_for_hash("s"), F.size(T.sentences("s")), T.word_count("s")).collect()
    for i, n, k, w in rows:
        assert n == normal(texts[i])
        assert k == len([p for p in re.split(r"(?<=[.!?])\s+", texts[i].strip()) if p])
        assert w == len(re.findall(r"\b\w+\b", texts[i]))


@pytest.mark.parametrize("pos,score", [("noun", 8), ("pronoun", 6), ("adj", 4), (None, 0)])
def test_score(spark, pos, score):
    got = one(spark, T.score_definition(F.lit("one two three"), F.lit(pos).cast("string"), F.lit("one two three")))
    assert got == 5 + score
