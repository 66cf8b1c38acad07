"""Definitions that only name another word's form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import C, normalize_word_key, strip

# Form types in the order in which they are tried, and what stands before the word.
FORM_PATTERNS = (
    ("plural", r"plural of"),
    ("alt_form", r"alternative form of"),
    ("alt_spell", r"alternative spelling of"),
    ("archaic", r"archaic (?:form|spelling) of"),
    ("obsolete", r"obsolete (?:form|spelling) of"),
    ("dated", r"dated (?:form|spelling) of"),
    ("rare", r"rare (?:form|spelling) of"),
    ("abbreviation", r"abbreviation of"),
    ("clipping", r"clipping of"),
    ("diminutive", r"diminutive of"),
    ("superlative", r"superlative of"),
    ("comparative", r"comparative of"),
    ("past_tense", r"(?:simple )?past(?: tense)?(?: and past participle)? of"),
    ("past_participle", r"past participle of"),
    ("present_participle", r"present participle(?: and gerund)? of"),
    ("third_person", r"third[- ]person singular .*?(?:form|indicative) of"),
    ("initialism", r"initialism of"),
    ("acronym", r"acronym of"),
    ("eye_dialect", r"eye dialect (?:spelling )?of"),
    ("informal_spell", r"informal spelling of"),
    ("censored_spell", r"censored spelling of"),
    ("nonstandard_spell", r"non-?(?:oxford )?(?:british )?(?:english )?(?:standard )?spelling of"),
    ("agent_noun", r"agent noun of"),
)
#: Types whose label isn't their name with spaces.
FORM_LABELS = {"alt_form": "also", "alt_spell": "also", "informal_spell": "informal spelling", "censored_spell": "censored spelling", "nonstandard_spell": "nonstandard spelling"}


def form_of(definition: C) -> Column:
    """struct(form_type, base_key) of the first pattern that fits, or null."""
    text = strip(definition)
    found = F.coalesce(*[F.when(F.length(F.regexp_extract(text, _pattern(p), 1)) > 0, F.struct(F.lit(t).alias("form_type"), F.regexp_extract(text, _pattern(p), 1).alias("base_key"))) for t, p in FORM_PATTERNS])
    bare = F.regexp_replace(F.regexp_replace(strip(found["base_key"]), '\\A"+|"+\\z', ""), "\\A'+|'+\\z", "")
    base = normalize_word_key(F.regexp_replace(bare, r"(?U)\s*\(.*\)\s*\z", ""))
    return F.when(base != "", F.struct(found["form_type"].alias("form_type"), base.alias("base_key")))


def _pattern(p: str) -> str:
    return rf"(?iU)\A{p}\s+(.+?)\.?\z"


def form_label(form_type: C) -> Column:
    t = F.col(form_type) if isinstance(form_type, str) else form_type
    special = F.create_map(*[F.lit(x) for pair in FORM_LABELS.items() for x in pair])
    return F.coalesce(F.element_at(special, t), F.replace(t, F.lit("_"), F.lit(" ")))
