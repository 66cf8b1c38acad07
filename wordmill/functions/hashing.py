"""Content hashes and stable identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import C, col, normalize_for_hash, normalize_pos, normalize_word_key

NUL = "\0"


def hash_definition(word: C, pos: C, sentence: C) -> Column:
    """Digest of key, part of speech and sentence in their normal forms."""
    return F.sha2(F.concat_ws(NUL, normalize_word_key(word), F.coalesce(normalize_pos(pos), F.lit("")), normalize_for_hash(sentence)), 256)


def definition_key(definition_hash: C) -> Column:
    return F.substring(col(definition_hash), 1, 16)


def hash_word(word: C, display: C, definition_hashes: C) -> Column:
    """Digest of key, display form and the sorted digests of the definitions."""
    shown = normalize_for_hash(F.coalesce(F.nullif(col(display), F.lit("")), col(word)))
    inner = F.array_join(F.sort_array(col(definition_hashes)), NUL)
    return F.sha2(F.concat(normalize_word_key(word), F.lit(NUL), shown, F.lit(NUL), inner), 256)


def stable_id(key: C) -> Column:
    """The first 56 bits of a key's SHA-256 as a number."""
    return F.conv(F.substring(F.sha2(col(key), 256), 1, 14), 16, 10).cast("bigint")
