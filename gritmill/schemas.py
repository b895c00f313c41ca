"""Schemas, label order and thresholds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StringType, StructField, StructType, TimestampType

# Labels in tie-breaking order, and keywords of items to exclude.
LABELS = ("城市、建筑", "室内", "自然", "静物", "人像")
CITY, INDOOR, NATURE, STILL, PORTRAIT = LABELS
EXCLUDED_KEYWORDS = (
    "art", "artwork", "painting", "illustration", "drawing", "sculpture", "mural", "graffiti", "sketch",
    "cartoon", "anime", "poster", "collage", "calligraphy", "watercolor", "oil painting", "installation",
)

# The least confidence by label, for decisions by rule and by model, and where a label has none.
MIN_CONFIDENCE = {NATURE: (0.98, 0.90), CITY: (0.95, 0.85), PORTRAIT: (0.80, 0.60), INDOOR: (0.70, 0.60), STILL: (0.80, 0.50)}
DEFAULT_RULE_CONFIDENCE, DEFAULT_MODEL_CONFIDENCE = 0.70, 0.75
REVIEW_CONFIDENCE, LOW_MODEL_CONFIDENCE, FALLBACK_CONFIDENCE = 0.70, 0.50, 0.20

_KINDS = {"string": StringType(), "bigint": LongType(), "double": DoubleType(), "boolean": BooleanType(), "timestamp": TimestampType()}


def fields(text: str) -> StructType:
    """A schema from 'name type, ...'; needs no session."""
    return StructType([StructField(name, _KINDS[kind]) for name, kind in (f.split() for f in text.split(","))])


ITEMS = fields(
    "item_id string, photo_url string, photo_image_url string, photo_submitted_at timestamp, photo_featured boolean, photo_width bigint, photo_height bigint,"
    " photo_aspect_ratio double, photo_description string, photographer_username string, photographer_first_name string, photographer_last_name string,"
    " exif_camera_make string, exif_camera_model string, exif_iso double, exif_aperture_value string, exif_focal_length string, exif_exposure_time string,"
    " photo_location_name string, photo_location_latitude double, photo_location_longitude double, photo_location_country string, photo_location_city string,"
    " stats_views bigint, stats_downloads bigint, ai_description string, ai_primary_landmark_name string, ai_primary_landmark_latitude double,"
    " ai_primary_landmark_longitude double, ai_primary_landmark_confidence double, blur_hash string"
)
KEYWORDS = fields("item_id string, keyword string, ai_service_1_confidence string, ai_service_2_confidence string, suggested_by_user string")
CONVERSIONS = fields("item_id string, keyword string, conversion_type string")
KEYWORDS_AGG = fields("item_id string, keyword_count bigint, keyword_user_count bigint, keyword_ai_max_conf double, keywords_joined string, keywords_highconf_joined string, keywords_user_joined string")
CONVERSIONS_AGG = fields("item_id string, conv_event_count bigint, conv_unique_keyword_count bigint, conv_keywords_joined string, conv_top_keyword string")
MODEL_RESULTS = fields(
    "item_id string, llm_label string, llm_confidence double, llm_reason string, llm_raw_response string, llm_ok boolean, llm_error string, llm_in_scope boolean,"
    " llm_reject_reason string, llm_called boolean, llm_source_hint string, llm_finished_at string, run_id string, seq bigint"
)
DOWNLOADS = fields(
    "item_id string, download_ok boolean, download_error string, download_http_status bigint, local_image_relpath string, local_image_path string,"
    " file_size bigint, image_ext string, downloaded_at string, download_attempts bigint, from_cache boolean"
)
SCORES = fields("item_id string, aesthetic_ok boolean, aesthetic_error string, aesthetic_score double")


def empty(spark: SparkSession, schema: StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Exactly the schema's columns: missing ones null, others cast, what cannot be cast null."""
    have = set(df.columns)
    return df.select(*((F.col(f.name).try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema))


def with_missing_columns(df: DataFrame, schema: StructType, defaults: dict | None = None) -> DataFrame:
    """df with the schema's columns added where absent, and nulls of named columns filled."""
    added = {f.name: F.lit(None).cast(f.dataType) for f in schema if f.name not in df.columns}
    df = df.withColumns(added) if added else df
    return df.fillna(defaults) if defaults else df


def preferred_first(df: DataFrame, *names: str) -> DataFrame:
    first = [n for n in dict.fromkeys(names) if n in df.columns]
    return df.select(*first, *(c for c in df.columns if c not in first))


def columns_like(df: DataFrame, *prefixes: str) -> list[str]:
    return [c for c in df.columns if c.startswith(prefixes)]
