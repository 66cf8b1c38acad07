"""Text functions on columns. Character classes and white space are Unicode's, as ``(?U)`` asks of the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

C = Column | str

# Fixed values.
POS_NAMES = {
    "n": "noun",
    "v": "verb",
    "adj": "adjective",
    "adv": "adverb",
    "prep": "preposition",
    "pron": "pronoun",
    "det": "determiner",
    "conj": "conjunction",
    "interj": "interjection",
    "part": "particle",
    "num": "numeral",
}
STOP_WORDS = ("a", "an", "the", "and", "or", "but", "in", "on", "at", "to", "for", "of", "with", "by", "is", "are", "was", "were")
# Marks of technical notation that make a gloss hard to understand, class by class; a mark counts in each class that has it.
TECHNICAL = (
    r"[0-9]{2,}",
    r"[+\-=]{2,}",
    r"[∑∫παβγδεζηθικλμνξοπρστυφχψω]",
    r"[⁰¹²³⁴⁵⁶⁷⁸⁹₀₁₂₃₄₅₆₇₈₉]",
    r"[→←↔⇒⇐⇔∀∃∈∉⊂⊆⊃⊇≠≈≡≪≫]",
    r"[∞∂∇∫∮∬∭∮∯∰∱∲∳∧∨¬]",
    r"[≤≥≮≯≰≱∑∏∐√∛∜°′″‴⁗]",
)
# What counts as notation when a gloss is rewritten, in upper and lower case.
NOTATION = (
    r"[0-9]{2,}|\([^)]+\)|[a-zA-Z][0-9]|[+\-=]|[∑∫παβγδεζηθικλμνξοπρστυφχψω]|[⁰¹²³⁴⁵⁶⁷⁸⁹]|[₀₁₂₃₄₅₆₇₈₉]|[→←↔⇒⇐⇔]"
    r"|[∀∃∈∉⊂⊆⊃⊇]|[≠≈≡≪≫]|[∞∂∇∫∮∬∭∮∯∰∱∲∳]|[∧∨¬⇒⇔]|[∪∩∈∋⊆⊇⊂⊃⊄⊅⊈⊉]|[≤≥≮≯≰≱]|[∑∏∐∏]|[√∛∜]|[°′″‴⁗]\]"
)
# Fixed values: (suffix, least length of the token, letters that go, letters that come); the first that fits is used.
SUFFIXES = (("ally", 5, 4, ""), ("ly", 5, 2, ""), ("ing", 6, 3, ""), ("ed", 5, 2, ""), ("ies", 4, 3, "y"), ("es", 4, 2, ""), ("s", 4, 1, ""))
#: Letters, digits and underscores; combining marks end a word, as they are none of these.
WORD = r"[\p{L}\p{N}_]+"


def col(c: C) -> Column:
    return F.col(c) if isinstance(c, str) else c


#: White space of Unicode, what (?U)\\s matches.
_BLANKS = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def strip(c: C) -> Column:
    return F.btrim(col(c), F.lit(_BLANKS))


def collapse(c: C) -> Column:
    return strip(F.regexp_replace(col(c), r"(?U)\s+", " "))


def unlink(c: C) -> Column:
    """[[x]] -> x, within a line."""
    return F.regexp_replace(col(c), r"(?d)\[\[(.*?)\]\]", "$1")


def normalize_for_hash(c: C) -> Column:
    return collapse(F.regexp_replace(unlink(F.coalesce(col(c), F.lit(""))), "<[^>]+>", " "))


def normalize_word_key(c: C) -> Column:
    return F.lower(strip(F.coalesce(col(c), F.lit(""))))


def normalize_pos(c: C) -> Column:
    """The full name of a part of speech; null for null and empty."""
    p = F.lower(strip(c))
    names = F.create_map(*[F.lit(x) for pair in POS_NAMES.items() for x in pair])
    return F.when(F.length(col(c)) > 0, F.coalesce(F.element_at(names, p), p))


def clean_gloss(c: C) -> Column:
    return collapse(unlink(c))


def casing_rank(c: C) -> Column:
    """0 lower case, 2 upper case, 1 mixed or without case."""
    w = col(c)
    low, up = F.lower(w), F.upper(w)
    return F.when((w == low) & (w != up), 0).when((w == up) & (w != low), 2).otherwise(1)


def is_pure_alpha(c: C) -> Column:
    return col(c).rlike(r"\A[a-zA-Z]+\z")


def sentences(c: C) -> Column:
    return F.filter(F.split(strip(c), r"(?U)(?<=[.!?])\s+"), lambda s: s != "")


def first_sentence(gloss: C) -> Column:
    """The first sentence of a cleaned gloss; null if nothing is left of it. What follows it isn't read."""
    head = F.split(strip(unlink(gloss)), r"(?U)(?<=[.!?])\s+", 2)[0]
    return F.nullif(collapse(head), F.lit(""))


def word_count(c: C) -> Column:
    return F.regexp_count(col(c), F.lit(WORD)).cast("bigint")


def words(c: C) -> Column:
    return F.regexp_extract_all(col(c), F.lit(WORD), F.lit(0))


def first_sentence_word_count(gloss: C) -> Column:
    return word_count(F.coalesce(first_sentence(gloss), F.lit("")))


def limit_words(c: C, most: int) -> Column:
    cut = F.array_join(F.slice(words(c), 1, most), " ")
    return F.when(word_count(c) <= most, strip(c)).otherwise(F.when(cut.rlike(r"[.!?]\z"), cut).otherwise(F.concat(cut, F.lit("."))))


def stem(c: C) -> Column:
    t = col(c)
    out = None
    for suffix, least, off, on in SUFFIXES:
        fits = (F.length(t) >= least) & F.endswith(t, F.lit(suffix))
        cut = F.concat(F.substring(t, F.lit(1), F.length(t) - off), F.lit(on))
        out = F.when(fits, cut) if out is None else out.when(fits, cut)
    return out.otherwise(t)


def tokens(c: C) -> Column:
    """Stemmed words of a text in lower case."""
    return F.transform(words(F.lower(col(c))), stem)


def strip_artifacts(c: C) -> Column:
    """Model output without reasoning blocks, code fences and tags."""
    s = F.coalesce(col(c), F.lit(""))
    for pattern, by in (
        (r"(?is)<\s*(think|reasoning|reflection|chain[-_ ]?of[-_ ]?thought)[^>]*>.*?<\s*/\s*\1\s*>", " "),
        (r"(?s)```\s*json\s*(.*?)\s*```", "$1"),
        (r"(?s)```\s*(.*?)\s*```", "$1"),
        (r"<[^>]+>", " "),
    ):
        s = F.regexp_replace(s, pattern, by)
    return collapse(s)


def score_definition(definition: C, pos: C, gloss: C) -> Column:
    d, p, g = col(definition), col(pos), col(gloss)
    n = word_count(d)
    return (
        F.when(n >= 15, 20).when(n >= 10, 15).when(n >= 5, 10).when(n >= 3, 5).otherwise(0)
        + F.when(F.contains(d, F.lit(";")) | (F.size(sentences(d)) > 1), 10).otherwise(0)
        + F.when(p.isin("noun", "verb", "adjective", "adverb"), 8).when(p.isin("pronoun", "preposition", "conjunction"), 6).when(F.length(p) > 0, 4).otherwise(0)
        + F.when(F.contains(d, F.lit('"')) | F.contains(d, F.lit("(")), 5).otherwise(0)
        + F.when(F.length(g) > F.length(d) * 1.5, 3).otherwise(0)
    ).cast("bigint")


def without_dots(c: C) -> Column:
    return F.regexp_replace(strip(c), r"\.+\z", "")


def is_extension(base: C, extended: C) -> Column:
    """Does ``extended`` begin with ``base`` and go on, or is base its part before ``;`` or its first sentence?"""
    b, e = without_dots(base), strip(extended)
    first = F.try_element_at(sentences(e), F.lit(1))
    return (
        F.when(F.startswith(e, b), F.length(e) > F.length(b) * 1.1)
        .when(F.contains(e, F.lit(";")), without_dots(F.substring_index(e, ";", 1)) == b)
        .otherwise((F.size(sentences(e)) >= 2) & (without_dots(first) == b))
    )


def merge_extension(base: C, extended: C) -> Column:
    b, e = without_dots(base), col(extended)
    whole = F.startswith(e, b) | F.contains(e, F.lit(";")) | (F.size(sentences(e)) >= 2)
    return F.when(whole, e).otherwise(F.concat(b, F.lit("; "), strip(e)))


def content_words(c: C) -> Column:
    """Distinct words in lower case without stop words."""
    return F.array_except(F.array_distinct(words(F.lower(col(c)))), F.array(*[F.lit(w) for w in STOP_WORDS]))


def similarity(a: C, b: C) -> Column:
    """Jaccard similarity of arrays of distinct words; 0 if one is empty."""
    a, b = col(a), col(b)
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), both / (F.size(a) + F.size(b) - both)).otherwise(F.lit(0.0))


#: Characters of the classes of single ones, by the number of classes that have them.
_SINGLE = [p for p in TECHNICAL if not p.endswith("}")]
_IN_CLASSES = {n: "".join(sorted({c for p in _SINGLE for c in p[1:-1] if sum(c in q for q in _SINGLE) == n})) for n in (1, 2, 3)}


def technical_marks(c: C) -> Column:
    """Runs of digits and of operators, and each single mark."""
    total = sum((F.regexp_count(col(c), F.lit(p)) for p in TECHNICAL if p not in _SINGLE), F.lit(0))
    for n, marks in _IN_CLASSES.items():
        if marks:  # what translating them away takes from the length
            total = total + n * (F.length(col(c)) - F.length(F.translate(col(c), marks, "")))
    return total.cast("bigint")


def _at_least(t: Column, pattern: str, n: int) -> Column:
    """Does the pattern fit ``n`` times or more? The text is read up to the last of these; patterns match one character at least."""
    return F.size(F.split(t, pattern, n + 1)) > n


def _ranges(marks: str) -> str:
    """A few ranges that hold the marks, and characters between them."""
    out: list[list[int]] = []
    for code in sorted(map(ord, marks)):
        if out and code - out[-1][1] <= 64:
            out[-1][1] = code
        else:
            out.append([code, code])
    return "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in out)


def _up_to(tokens: str, begins: str) -> str:
    """All before the next of the tokens, with no way back into it. ``begins`` has each character that a token may begin with.

    Runs of other characters are taken at once: a class of single ones below U+0100 is a look into a table for each of them, and of those
    above only a few ranges are asked, not every mark. A possessive loop needs no stack, however long the text."""
    near = "".join(rf"\x{code:02X}" for code in range(256) if chr(code) not in begins)
    far = _ranges("".join(c for c in begins if c > "\xff"))
    return rf"(?:(?>[{near}]+)|(?>[^\x00-\xFF{far}]+)|(?!{tokens})(?s:.))*+"


def _several_marks(t: Column) -> Column:
    """Two technical marks or more: a mark of two classes, or two of what counts once. No mark counts as part of a run."""
    # digits and operators needn't be compared with every single mark
    once = "|".join([*(p for p in TECHNICAL if p not in _SINGLE), rf"(?=[^\x00-\x7F])[{_IN_CLASSES[1]}]"])
    twice = f"[{''.join(marks for n, marks in _IN_CLASSES.items() if n > 1)}]"
    before = _up_to(f"{once}|{twice}", "0123456789+-=" + "".join(_IN_CLASSES.values()))
    return t.rlike(rf"\A{before}(?:{twice}|(?>{once}){before}(?:{once}|{twice}))")


def is_helpful(gloss: C) -> Column:
    """Can a gloss be understood without looking further?"""

    def of(t: Column) -> Column:
        many = _at_least(t, r"(?U)\s+", 3)  # blanks inside, so four words
        return (t != "") & (t.rlike(r"\p{L}") | (many & (F.length(t) > 10))) & ~_several_marks(t)

    # an array of one text, so it is made once for all that reads it
    return F.element_at(F.transform(F.array(F.lower(strip(F.coalesce(col(gloss), F.lit(""))))), of), 1)


def notation_marks(c: C) -> Column:
    return F.regexp_count(col(c), F.lit(NOTATION)).cast("bigint")


def needs_context(gloss: C) -> Column:
    """Three marks of notation or more ask for the longer prompt."""
    # what is in brackets is a mark; after the last closing one each opening one would be followed to the end of the text, to no use
    t = col(gloss)
    tail = F.substring_index(t, ")", -1)
    head = F.when(F.contains(tail, F.lit("(")), F.concat(F.left(t, F.length(t) - F.length(tail)), F.translate(tail, "(", "\n"))).otherwise(t)
    # a letter before a digit is looked back at, so no mark begins with a letter; it comes first, as it takes but one of several digits
    mark = r"(?<=[a-zA-Z])[0-9]|" + NOTATION.replace(r"|[a-zA-Z][0-9]", "")
    before = _up_to(mark, "0123456789(+-=" + "".join(c for c in NOTATION if c > "\x7f"))
    return F.coalesce(head.rlike(rf"\A(?>{before}(?:{mark})){{3}}"), F.lit(False))


def sanity_reason(candidate: C, most_words: int) -> Column:
    """Why a line is rejected, or ok; the first reason in this order counts."""
    c = F.coalesce(col(candidate), F.lit(""))
    return (
        F.when(c.rlike("<[^>]+>"), "tags")
        .when(word_count(c) > most_words + 3, "too_long")
        .when(word_count(c) == 0, "empty")
        .when(F.contains(c, F.lit("http://")) | F.contains(c, F.lit("https://")), "url")
        .otherwise("ok")
    )


def accept_line(line: C, most_words: int) -> Column:
    """A model's line without surrounding quotes, or null if it is longer than one and a half times the budget."""
    s = F.regexp_replace(strip(line), "\\A[\"']+|[\"']+\\z", "")
    return F.when((s != "") & within_budget(s, most_words), s)


def within_budget(line: C, most_words: int) -> Column:
    return word_count(line) <= most_words * 1.5


def unquoted_line(line: C) -> Column:
    """A line that may quote something itself: only one pair of quotes around all of it goes; null if nothing is left."""
    s = strip(line)
    wrapped = (F.length(s) >= 2) & F.startswith(s, F.lit('"')) & F.endswith(s, F.lit('"'))
    return F.nullif(F.when(wrapped, strip(F.substring(s, F.lit(2), F.length(s) - 2))).otherwise(s), F.lit(""))


def search_term(gloss: C) -> Column:
    return F.nullif(F.regexp_extract(col(gloss), r"\A([A-Za-z][A-Za-z0-9\s-]+)", 1), F.lit(""))


def strip_bracket_tags(c: C) -> Column:
    return strip(F.regexp_replace(col(c), r"(?U)\s*\[([^\]]+)\]", ""))


def has_bracket_tag(c: C) -> Column:
    return F.contains(col(c), F.lit("[")) & F.contains(col(c), F.lit("]"))


def sql_literal(c: C) -> Column:
    """A value as a SQL string literal in one line."""
    s = F.regexp_replace(F.regexp_replace(col(c), r"\r|\n", " "), "'", "''")
    return F.when(col(c).isNull(), F.lit("NULL")).otherwise(F.concat(F.lit("'"), s, F.lit("'")))


def json_in(c: C) -> Column:
    """The JSON object in a text that may hold other words around it."""
    return F.coalesce(F.try_parse_json(col(c)), F.try_parse_json(F.regexp_extract(col(c), r"(?s)\{.*\}", 0)))


def format_eta(elapsed: C, progress: C) -> Column:
    """Time left as h:mm:ss from seconds so far and the share done."""
    left = F.floor(col(elapsed) / col(progress) - col(elapsed)).cast("bigint")
    clock = F.format_string("%d:%02d:%02d", F.floor(left / 3600).cast("bigint"), F.floor(F.pmod(left, F.lit(3600)) / 60).cast("bigint"), F.pmod(left, F.lit(60)))
    return F.when(col(progress) > 0, clock).otherwise(F.lit("--:--"))
