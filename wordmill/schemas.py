"""Schemas of the persistent tables."""

from pyspark.sql import types as T

ENHANCEMENT_VERSION = "pocket_v1"
BUILDER_VERSION = "stage1_v1"


_TYPES = {"BIGINT": T.LongType(), "INT": T.IntegerType(), "STRING": T.StringType(), "BOOLEAN": T.BooleanType(), "ARRAY<STRING>": T.ArrayType(T.StringType())}


def _schema(text: str) -> T.StructType:
    """Columns as "name TYPE, ..."; works before there is a session."""
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in (c.split() for c in text.split(", "))])


EXTRACT_RUNS = _schema("id BIGINT, extract_key STRING, source_path STRING, file_size BIGINT, sha256 STRING, status STRING, builder_version STRING, started_at BIGINT, completed_at BIGINT, notes STRING")
SOURCE_WORDS = _schema("extract_id BIGINT, word_key STRING, display_word STRING, language_code STRING, word_hash STRING, is_pure_alpha BOOLEAN")
SOURCE_DEFINITIONS = _schema("extract_id BIGINT, word_key STRING, definition_key STRING, source_idx INT, pos STRING, source_first_sentence STRING, source_hash STRING, normalized_source STRING")
ENHANCED_WORDS = _schema("word_key STRING, word_hash STRING, enhancement_version STRING, pocket_definition STRING, source_pos_list ARRAY<STRING>, source_definition_count INT, enhanced_source STRING, quality_status STRING, updated_at BIGINT")
WORD_SNAPSHOTS = _schema("extract_id BIGINT, word_key STRING, display_word STRING, word_status STRING, source_definition_count BIGINT, enhancement_action STRING")
PUBLISHED_STATE = _schema("target STRING, extract_id BIGINT, published_at BIGINT, artifact_version STRING")
WORDS = _schema("id BIGINT, word STRING")
DEFINITIONS = _schema("id BIGINT, definition STRING")
SEARCH_RESULTS = _schema("word STRING, definition_idx INT, source STRING, title STRING, snippet STRING, url STRING, rank INT, created_at BIGINT")
SEARCH_METADATA = _schema("word STRING, definition_idx INT, search_term STRING, search_engines ARRAY<STRING>, total_results INT, helpful_results INT, created_at BIGINT")
