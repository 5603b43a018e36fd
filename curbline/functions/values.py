"""JSON access, lenient casts, guarded ratios and label helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from curbline.config import DEFAULT, TIERS, Settings


def json_text(payload: Column, key: str) -> Column:
    """A top-level key of a JSON text, as text."""
    return F.get_json_object(payload, f"$['{key}']")


def lenient_int(text: Column) -> Column:
    """Text to int, halves rounded away from zero; unreadable text is NULL."""
    number = F.round(text.try_cast("double"))
    return F.when(F.abs(number) < 2**31, number).try_cast("int")


def lenient_bool(text: Column) -> Column:
    return text.try_cast("boolean")


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as a double; NULL where there is nothing to divide by."""
    return F.when(whole > 0, part.cast("double") / whole)


def threshold_hours(label: Column, settings: Settings = DEFAULT) -> Column:
    """Hours allowed for a tier; NULL for a label that has no threshold."""
    hours: Column = F.lit(None).cast("int")
    for tier, limit in reversed(list(settings.sla_thresholds.items())):
        hours = F.when(label == tier, F.lit(limit)).otherwise(hours)
    return hours


def tier_rank(label: Column) -> Column:
    """0 for the least urgent tier; NULL for a label outside the tiers."""
    position = F.array_position(F.array(*[F.lit(t) for t in TIERS]), label)
    return F.when(position > 0, (position - 1).cast("int"))


def normalised_label(text: Column) -> Column:
    """Trimmed, first letter upper, rest lower."""
    clean = F.lower(F.btrim(text, F.lit(" \t\r\n")))
    return F.concat(F.upper(F.substring(clean, 1, 1)), F.substr(clean, F.lit(2)))


def prompt_text(name: Column, code: Column, status: Column, address: Column) -> Column:
    """The per-request text handed to a labelling function. The wording is a fixed value."""
    return F.format_string(
        "Service request to classify:\n- service_name: %s\n- service_code: %s\n"
        "- status: %s\n- address: %s\n",
        name, code, status, address,
    )


def trace_id(request_id: Column, settings: Settings = DEFAULT) -> Column:
    """A trace id that a retried task computes again identically."""
    return F.md5(F.concat_ws("|", request_id, F.lit(settings.prompt_version)))


def trace_tags(city: Column, code: Column) -> Column:
    return F.array(city, code, F.lit("urgency_classification"))


def trace_metadata(request_id: Column, code: Column, city: Column, settings: Settings = DEFAULT) -> Column:
    return F.struct(
        request_id.alias("service_request_id"),
        code.alias("service_code"),
        city.alias("city"),
        F.lit(settings.prompt_version).alias("prompt_version"),
    )
