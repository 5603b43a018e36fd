"""Parse, validate and tally drift over feed pages and stream messages.

A text is parsed once into a VARIANT; an object is opened once as a struct of its members, from which
every field, its presence and its JSON type are read. Rows are never dropped here: each carries a ``reject_reason`` that is NULL when
the record is acceptable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbline import schemas
from curbline.config import DEFAULT, TIERS, UNKNOWN, Settings
from curbline.functions import times
from curbline.operators.once import evaluate_once


def _opened(rows: DataFrame, variant: str, keys: tuple[str, ...], keep: list[str]) -> DataFrame:
    """``rows`` with each member's text (``t_<key>``) and JSON type (``k_<key>``).

    A type is NULL for an absent key and VOID for an explicit null; the text is NULL for both and
    for nested values. Texts, types and the timestamp are computed in three steps: in one, the
    generated method is too long for the JVM to compile, and runs about half as fast.
    """
    shape = "struct<" + ",".join(f"`{k}`:variant" for k in keys) + ">"
    opened = rows.select(*keep, F.try_variant_get(variant, "$", shape).alias("_f"))
    member = {k: F.col("_f")[k] for k in keys}
    texts = evaluate_once(opened, {
        "is_object": F.col("_f").isNotNull(),
        **{f"t_{k}": m.try_cast("string") for k, m in member.items()},
    })
    kinds = evaluate_once(
        texts, {f"k_{k}": F.schema_of_variant(m) for k, m in member.items()},
        [c for c in texts.columns if c != "_f"])
    return evaluate_once(kinds, {"when": times.utc_timestamp(F.col("t_requested_datetime"))})


def _kind(key: str) -> Column:
    return F.col(f"k_{key}")


def _text(key: str) -> Column:
    return F.col(f"t_{key}")


def _text_or(key: str, default: str) -> Column:
    """The default stands in for an absent key only."""
    return F.when(_kind(key).isNull(), F.lit(default)).otherwise(_text(key))


def _is(condition: Column) -> Column:
    """A condition that takes an absent key as false."""
    return F.coalesce(condition, F.lit(False))


def _nested(kind: Column) -> Column:
    return kind.startswith("OBJECT") | kind.startswith("ARRAY")


def _not_scalar(kind: Column) -> Column:
    """Present, but neither a string nor a number."""
    return _is(kind.isin("VOID", "BOOLEAN") | _nested(kind))


def is_object(variant: Column) -> Column:
    return F.coalesce(F.schema_of_variant(variant).startswith("OBJECT"), F.lit(False))


def _blank(text: Column) -> Column:
    return (text == "") | text.isNull()


def _bad_number(text: Column) -> Column:
    return ~_blank(text) & text.try_cast("double").isNull()


def explode_pages(pages: DataFrame) -> DataFrame:
    """(page, position, record, members) for every array element; one row with a NULL position for
    a page that is not an array, so that a bad envelope is reported and hides nothing else."""
    elements = pages.select("page", F.from_json("value", "array<variant>").alias("_page")).select(
        "page",
        F.col("_page").isNotNull().alias("is_list"),
        F.posexplode_outer("_page").alias("position", "record"),
    )
    return elements.filter(~F.col("is_list") | F.col("position").isNotNull())


def feed_records(
    pages: DataFrame, require_id: bool = True, settings: Settings = DEFAULT
) -> DataFrame:
    """Typed feed records with a reject reason, one row per array element or bad page.

    ``require_id`` is the polling rule that a blank id is skipped; a bounded backfill only needs
    the key to be present.
    """
    keys = ("service_request_id", "requested_datetime", "service_name", "service_code", "status",
            "address", "lat", "long", "lon")
    rows = _opened(explode_pages(pages), "record", keys, ["page", "position", "is_list", "record"])
    id_text = _text_or("service_request_id", "")
    blank_id = F.trim(id_text) == "" if require_id else _kind("service_request_id").isNull()
    has_long = _kind("long").isNotNull()
    lon_text = F.when(has_long, _text("long")).otherwise(_text("lon"))
    lon_kind = F.when(has_long, _kind("long")).otherwise(_kind("lon"))

    def bad_coordinate(text: Column, kind: Column) -> Column:
        return _is(_nested(kind) | (kind == "BOOLEAN")) | _bad_number(text)

    reason = (
        F.when(~F.col("is_list"), "unexpected_payload")
        .when(~F.col("is_object"), "record_not_object")
        .when(_is(blank_id), "missing_id")
        .when(_not_scalar(_kind("service_request_id")), "bad_service_request_id")
        .when(F.col("when").isNull() | (_kind("requested_datetime") != "STRING"),
              "bad_requested_datetime")
        .when(_is(_kind("service_name") != "STRING"), "bad_service_name")
        .when(_not_scalar(_kind("service_code")), "bad_service_code")
        .when(_is(_kind("status") != "STRING"), "bad_status")
        .when(_is(_kind("address") != "STRING"), "bad_address")
        .when(bad_coordinate(_text("lat"), _kind("lat")), "bad_lat")
        .when(bad_coordinate(lon_text, lon_kind), "bad_lon")
    )
    return rows.select(
        "page",
        "position",
        id_text.alias("service_request_id"),
        F.col("when").alias("requested_datetime"),
        _text_or("service_name", "").alias("service_name"),
        _text_or("service_code", "").alias("service_code"),
        _text_or("status", settings.default_status).alias("status"),
        _text_or("address", "").alias("address"),
        _text("lat").try_cast("double").alias("lat"),
        lon_text.try_cast("double").alias("lon"),
        F.lit(settings.default_city).alias("city"),
        F.to_json(F.col("record")).alias("raw_payload"),
        reason.alias("reject_reason"),
    )


def accepted(records: DataFrame) -> DataFrame:
    return records.filter(F.col("reject_reason").isNull()).select(schemas.REQUEST.fieldNames())


def reject_counts(records: DataFrame, by: list[str] | None = None) -> DataFrame:
    return (
        records.filter(F.col("reject_reason").isNotNull())
        .groupBy(*(by or []), "reject_reason")
        .agg(F.count(F.lit(1)).alias("records"))
    )


def key_drift(keys: Column) -> tuple[Column, Column]:
    """(missing expected keys, unexpected keys) of one JSON object's keys."""
    expected = F.array(*[F.lit(k) for k in schemas.EXPECTED_KEYS])
    known = F.array(*[F.lit(k) for k in schemas.EXPECTED_KEYS + schemas.OPTIONAL_KEYS])
    return F.array_except(expected, keys), F.array_except(keys, known)


def drift_tally(pages: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Drifting keys with the number of records showing each; every object record counts, also
    those later skipped. A clean batch yields no rows.

    Records are counted per distinct list of keys first (a VARIANT holds them sorted): a feed has
    few of those, so the key arithmetic runs once per list instead of once per record.
    """
    fields = by or ["page"]
    by = [f.rsplit(".", 1)[-1] for f in fields]
    missing, unexpected = key_drift(F.col("_keys"))

    def tagged(kind: str, keys: Column) -> Column:
        return F.transform(keys, lambda k: F.struct(F.lit(kind).alias("kind"), k.alias("key")))

    keys = F.map_keys(F.try_variant_get("record", "$", "map<string,variant>"))
    shapes = (
        explode_pages(pages).select(*fields, keys.alias("_keys")).filter(F.col("_keys").isNotNull())
        .groupBy(*by, "_keys")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    return (
        shapes.select(
            *by, "_n",
            F.explode(F.concat(tagged("missing", missing), tagged("unexpected", unexpected))).alias("_d"))
        .groupBy(*by, F.col("_d.kind").alias("kind"), F.col("_d.key").alias("key"))
        .agg(F.sum("_n").alias("records"))
    )


def parse_messages(messages: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Stream messages to typed requests; ``error_type``/``error_message`` are NULL when valid."""
    keys = ("service_request_id", "requested_datetime", "service_name", "service_code", "status",
            "address", "lat", "lon", "city", "raw_payload")
    text = F.try_validate_utf8(F.col("value").cast("string"))
    rows = _opened(
        messages.withColumn("_v", F.try_parse_json(text)), "_v", keys, [*messages.columns, "_v"])

    def bad_coordinate(key: str) -> Column:
        bad = _text(key).isNotNull() & _text(key).try_cast("double").isNull()
        return _is(_nested(_kind(key))) | bad

    def required_text(key: str) -> Column:
        return F.coalesce(_kind(key) != "STRING", F.lit(True))

    problem = F.when(F.col("_v").isNull(), "value is not JSON").when(
        ~F.col("is_object"), "value is not an object")
    for key in ("service_request_id", "service_name", "service_code", "status", "address"):
        problem = problem.when(required_text(key), f"{key} is not a string")
    problem = (
        problem.when(required_text("requested_datetime") | F.col("when").isNull(),
                     "requested_datetime is not an ISO timestamp")
        .when(bad_coordinate("lat"), "lat is not a number")
        .when(bad_coordinate("lon"), "lon is not a number")
        .when(_is(_kind("city") != "STRING"), "city is not a string")
        .when(~_is(_kind("raw_payload").startswith("OBJECT")), "raw_payload is not an object")
    )
    payload = F.to_json(F.try_variant_get("_v", "$.raw_payload", "variant"))
    return rows.select(
        *messages.columns,
        _text("service_request_id").alias("service_request_id"),
        F.col("when").alias("requested_datetime"),
        _text("service_name").alias("service_name"),
        _text("service_code").alias("service_code"),
        _text("status").alias("status"),
        _text("address").alias("address"),
        _text("lat").try_cast("double").alias("lat"),
        _text("lon").try_cast("double").alias("lon"),
        _text_or("city", settings.default_city).alias("city"),
        payload.alias("raw_payload"),
        F.when(problem.isNotNull(), F.lit("message_parse_error")).alias("error_type"),
        problem.alias("error_message"),
    )


def label_problem() -> Column:
    """Why a row's label columns break the contract, or NULL."""
    return (
        F.when(F.col("urgency_label").isNull() | ~F.col("urgency_label").isin(*TIERS),
               "urgency_label is not one of the four tiers")
        .when(F.col("urgency_score").isNull() | F.isnan("urgency_score")
              | ~F.col("urgency_score").between(0.0, 1.0),
              "urgency_score is outside 0..1")
        .when(F.col("llm_reasoning").isNull(), "reasoning is missing")
    )


def with_read_defaults(requests: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Defaults for NULL or empty text on read-back, and ``{}`` for a payload that is not JSON."""
    def default(name: str, value: str) -> Column:
        return F.when(_blank(F.col(name)), F.lit(value)).otherwise(F.col(name))

    return requests.withColumns({
        "service_name": default("service_name", ""),
        "service_code": default("service_code", ""),
        "status": default("status", settings.default_status),
        "address": default("address", ""),
        "city": default("city", settings.default_city),
        "raw_payload": F.when(
            is_object(F.try_parse_json("raw_payload")), F.col("raw_payload")).otherwise("{}"),
    })


def as_unclassified(requests: DataFrame, at: Column, settings: Settings = DEFAULT) -> DataFrame:
    """Backfilled requests carry the unrated label until a classifier reaches them."""
    return requests.select(
        *schemas.REQUEST.fieldNames(),
        F.lit(UNKNOWN).alias("urgency_label"),
        F.lit(0.0).alias("urgency_score"),
        F.lit(settings.backfill_reason).alias("llm_reasoning"),
        F.lit("").alias("langfuse_trace_id"),
        at.cast("timestamp_ntz").alias("classified_at"),
        F.lit(None).cast("double").alias("days_to_close"),
    )
