"""Pieces of DuckDB SQL with the meaning of the column functions, for the oracles."""

from __future__ import annotations

from ..functions import forms as FM
from ..functions import text as T


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def collapse(x: str) -> str:
    return strip(rf"regexp_replace({x}, '\s+', ' ', 'g')")


def unlink(x: str) -> str:
    return rf"regexp_replace({x}, '\[\[(.*?)\]\]', '\1', 'g')"


def normalize(x: str) -> str:
    return collapse(f"regexp_replace({unlink(f'coalesce({x}, {chr(39) * 2})')}, '<[^>]+>', ' ', 'g')")


def word_key(x: str) -> str:
    return f"lower({strip(f'coalesce({x}, {chr(39) * 2})')})"


def words(x: str) -> str:
    return rf"regexp_extract_all({x}, '[\p{{L}}\p{{N}}_]+')"


def word_count(x: str) -> str:
    return f"len({words(x)})::BIGINT"


def sentences(x: str) -> str:
    marked = rf"regexp_replace({strip(x)}, '([.!?])\s+', '\1' || chr(1), 'g')"
    return f"list_filter(string_split({marked}, chr(1)), lambda s: s <> '')"


def first_sentence(x: str) -> str:
    clean = collapse(unlink(x))
    return f"CASE WHEN {clean} <> '' THEN {strip(f'({sentences(clean)})[1]')} END"


def pos(x: str) -> str:
    p = f"lower({strip(x)})"
    cases = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in T.POS_NAMES.items())
    return f"CASE WHEN length({x}) > 0 THEN CASE {p} {cases} ELSE {p} END END"


def definition_hash(word: str, part: str, sentence: str) -> str:
    return f"sha256({word_key(word)} || chr(0) || coalesce({pos(part)}, '') || chr(0) || {normalize(sentence)})"


def stable_id(x: str) -> str:
    return f"('0x' || substr(sha256({x}), 1, 14))::BIGINT"


def casing_rank(x: str) -> str:
    return f"CASE WHEN {x} = lower({x}) AND {x} <> upper({x}) THEN 0 WHEN {x} = upper({x}) AND {x} <> lower({x}) THEN 2 ELSE 1 END"


def stem(x: str) -> str:
    cases = " ".join(f"WHEN length({x}) >= {least} AND ends_with({x}, '{suffix}') THEN substr({x}, 1, length({x}) - {off}) || '{on}'" for suffix, least, off, on in T.SUFFIXES)
    return f"CASE {cases} ELSE {x} END"


def without_dots(x: str) -> str:
    return rf"regexp_replace({strip(x)}, '\.+$', '')"


def score(d: str, p: str, g: str) -> str:
    n = word_count(d)
    return f"""(CASE WHEN {n} >= 15 THEN 20 WHEN {n} >= 10 THEN 15 WHEN {n} >= 5 THEN 10 WHEN {n} >= 3 THEN 5 ELSE 0 END
      + CASE WHEN contains({d}, ';') OR len({sentences(d)}) > 1 THEN 10 ELSE 0 END
      + CASE WHEN {p} IN ('noun', 'verb', 'adjective', 'adverb') THEN 8 WHEN {p} IN ('pronoun', 'preposition', 'conjunction') THEN 6 WHEN length({p}) > 0 THEN 4 ELSE 0 END
      + CASE WHEN contains({d}, '"') OR contains({d}, '(') THEN 5 ELSE 0 END
      + CASE WHEN length({g}) > length({d}) * 1.5 THEN 3 ELSE 0 END)::BIGINT"""


def technical(x: str) -> str:
    return "(" + " + ".join(f"len(regexp_extract_all({x}, '{p}'))" for p in T.TECHNICAL) + ")::BIGINT"


def notation(x: str) -> str:
    """Of its own: digits side by side, brackets with something in them, a letter before a digit, and each single sign."""
    signs = "+=αβγδεζηθικλμνξοπρστυφχψω⁰¹²³⁴⁵⁶⁷⁸⁹₀₁₂₃₄₅₆₇₈₉→←↔⇒⇐⇔∀∃∈∉∋⊂⊆⊃⊇⊄⊅⊈⊉∪∩≠≈≡≪≫∞∂∇∑∏∐∫∮∬∭∯∰∱∲∳∧∨¬≤≥≮≯≰≱√∛∜-"
    return rf"len(regexp_extract_all({x}, '\d\d+|\([^)]+\)|[A-Za-z]\d|[{signs}]|[°′″‴⁗]\]'))::BIGINT"


def helpful(x: str) -> str:
    t = f"lower({strip(x)})"
    letter = rf"regexp_matches({t}, '\p{{L}}')"
    return rf"({t} <> '' AND {technical(t)} < 2 AND ({letter} OR NOT (len(regexp_extract_all({t}, '\S+')) <= 3 OR length({t}) <= 10)))"


def reason(x: str, most: int) -> str:
    return f"CASE WHEN regexp_matches({x}, '<[^>]+>') THEN 'tags' WHEN {word_count(x)} > {most} + 3 THEN 'too_long' WHEN {word_count(x)} = 0 THEN 'empty' WHEN contains({x}, 'http://') OR contains({x}, 'https://') THEN 'url' ELSE 'ok' END"


def literal(x: str) -> str:
    return rf"CASE WHEN {x} IS NULL THEN 'NULL' ELSE '''' || replace(regexp_replace({x}, '\r|\n', ' ', 'g'), '''', '''''') || '''' END"


def content_words(x: str) -> str:
    stop = ", ".join(f"'{w}'" for w in T.STOP_WORDS)
    return f"list_filter(list_distinct({words(f'lower({x})')}), lambda w: NOT list_contains([{stop}], w))"


def form_type(x: str) -> str:
    return "CASE " + " ".join(rf"WHEN regexp_matches({strip(x)}, '(?i)^{p}\s+(.+?)\.?$') THEN '{t}'" for t, p in FM.FORM_PATTERNS) + " END"


def form_base(x: str) -> str:
    got = "CASE " + " ".join(rf"WHEN regexp_matches({strip(x)}, '(?i)^{p}\s+(.+?)\.?$') THEN regexp_extract({strip(x)}, '(?i)^{p}\s+(.+?)\.?$', 1)" for _, p in FM.FORM_PATTERNS) + " END"
    bare = rf"regexp_replace(trim(trim({strip(got)}, '\"'), ''''), '\s*\(.*\)\s*$', '')"
    return word_key(bare)
