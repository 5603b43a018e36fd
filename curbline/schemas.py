"""Table and message contracts."""

from __future__ import annotations

from pyspark.sql import types as T

NTZ = T.TimestampNTZType()

# Keys a feed record is expected to carry, and keys that may come and go.
EXPECTED_KEYS: tuple[str, ...] = (
    "service_request_id", "status", "service_name", "service_code", "requested_datetime",
    "updated_datetime", "address", "lat", "long", "token",
)
OPTIONAL_KEYS: tuple[str, ...] = (
    "description", "status_notes", "agency_responsible", "service_notice",
    "expected_datetime", "zipcode", "address_id", "media_url",
)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


REQUEST = _struct(
    ("service_request_id", T.StringType()),
    ("requested_datetime", NTZ),
    ("service_name", T.StringType()),
    ("service_code", T.StringType()),
    ("status", T.StringType()),
    ("address", T.StringType()),
    ("lat", T.DoubleType()),
    ("lon", T.DoubleType()),
    ("city", T.StringType()),
    ("raw_payload", T.StringType()),
)
LABEL = _struct(
    ("urgency_label", T.StringType()),
    ("urgency_score", T.DoubleType()),
    ("llm_reasoning", T.StringType()),
    ("langfuse_trace_id", T.StringType()),
    ("classified_at", NTZ),
    ("days_to_close", T.DoubleType()),
)
ENRICHED = T.StructType(REQUEST.fields + LABEL.fields)
SERVICE_REQUESTS = T.StructType(ENRICHED.fields + [T.StructField("_inserted_at", NTZ, True)])

# The extract's CSV columns arrive as text and are cast leniently afterwards.
EXTRACT_TYPES: dict[str, T.DataType] = {
    "sr_number": T.StringType(),
    "sr_type": T.StringType(),
    "sr_short_code": T.StringType(),
    "owner_department": T.StringType(),
    "status": T.StringType(),
    "origin": T.StringType(),
    "created_date": NTZ,
    "last_modified_date": NTZ,
    "closed_date": NTZ,
    "duplicate": T.BooleanType(),
    "legacy_record": T.BooleanType(),
    "parent_sr_number": T.StringType(),
    "street_address": T.StringType(),
    "zip_code": T.StringType(),
    "ward": T.IntegerType(),
    "community_area": T.IntegerType(),
    "latitude": T.DoubleType(),
    "longitude": T.DoubleType(),
}
EXTRACT_CSV = _struct(*((name, T.StringType()) for name in EXTRACT_TYPES))
PORTAL_REQUESTS = _struct(
    ("pull_id", T.StringType()), ("pulled_at", NTZ), ("partition_date", T.DateType()),
    *EXTRACT_TYPES.items(),
)
PORTAL_PULLS = _struct(
    ("pull_id", T.StringType()),
    ("window_label", T.StringType()),
    ("partition_date", T.DateType()),
    ("where_clause", T.StringType()),
    ("expected_count", T.LongType()),
    ("expected_count_after", T.LongType()),
    ("landed_count", T.LongType()),
    ("status", T.StringType()),
    ("started_at", NTZ),
    ("finished_at", NTZ),
)
PARENT_LOOKUP = _struct(
    ("sr_number", T.StringType()),
    ("found", T.BooleanType()),
    ("sr_type", T.StringType()),
    ("created_date", NTZ),
    ("looked_up_at", NTZ),
)
SR_TYPES = _struct(
    ("sr_type", T.StringType()),
    ("sr_short_code", T.StringType()),
    ("in_sla_scope", T.BooleanType()),
    ("scope_note", T.StringType()),
    ("urgency_label", T.StringType()),
    ("urgency_score", T.DoubleType()),
    ("llm_reasoning", T.StringType()),
    ("prompt_version", T.StringType()),
    ("classified_at", T.StringType()),
)
CALENDAR = _struct(
    ("calendar_date", T.DateType()),
    ("fiscal_year", T.IntegerType()),
    ("fiscal_quarter", T.IntegerType()),
    ("fiscal_month", T.IntegerType()),
    ("month_start", T.DateType()),
    ("week_start", T.DateType()),
    ("week_end", T.DateType()),
    ("day_of_week", T.IntegerType()),
)
LABEL_SHEET = _struct(
    ("item", T.IntegerType()),
    ("service_request_id", T.StringType()),
    ("service_name", T.StringType()),
    ("status", T.StringType()),
    ("address", T.StringType()),
    ("human_label", T.StringType()),
    ("notes", T.StringType()),
)
_HEADERS = T.ArrayType(_struct(("key", T.StringType()), ("value", T.BinaryType())))
MESSAGE = _struct(
    ("key", T.BinaryType()),
    ("value", T.BinaryType()),
    ("topic", T.StringType()),
    ("partition", T.IntegerType()),
    ("offset", T.LongType()),
    ("timestamp", T.TimestampType()),
    ("headers", _HEADERS),
)
DEAD_LETTER = _struct(
    ("key", T.BinaryType()),
    ("value", T.BinaryType()),
    ("headers", _HEADERS),
    ("topic", T.StringType()),
    ("partition", T.IntegerType()),
    ("offset", T.LongType()),
)
