"""Attach urgency labels by a chosen strategy; failures become error columns, never exceptions."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from queue import Empty, Queue
from threading import Thread, local

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbline import schemas
from curbline.config import DEFAULT, Settings
from curbline.functions import values
from curbline.operators import validate

_ERRORS = [T.StructField("error_type", T.StringType(), True),
           T.StructField("error_message", T.StringType(), True)]


def classify(requests: DataFrame, strategy: str, **options) -> DataFrame:
    """Requests with the six label columns plus ``error_type`` and ``error_message``.

    Strategies: ``recorded`` (labels=), ``by_type`` (sr_types=, at=), ``rules`` (label=, score=,
    reasoning=, at=) and ``function`` (fn=, at=, and how it is called). Labels outside the contract turn into errors.
    """
    known: dict[str, Callable[..., DataFrame]] = {
        "recorded": _recorded, "by_type": _by_type, "rules": _rules, "function": _function,
    }
    if strategy not in known:
        raise ValueError(f"strategy must be one of {sorted(known)}, got {strategy!r}")
    if "error_type" in requests.columns:
        requests = requests.drop("error_type", "error_message")
    labelled = known[strategy](requests, **options)
    problem = validate.label_problem()
    broken = F.col("error_type").isNull() & problem.isNotNull()
    return labelled.withColumns({
        "error_type": F.when(broken, "LabelContract").otherwise(F.col("error_type")),
        "error_message": F.when(broken, problem).otherwise(F.col("error_message")),
    })


def split(labelled: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows labelled properly, rows that failed)."""
    failed = F.col("error_type").isNotNull()
    return labelled.filter(~failed), labelled.filter(failed)


def _recorded(requests: DataFrame, labels: DataFrame) -> DataFrame:
    """Replay labels by request id. An id without a recording is an error; no label is invented."""
    recorded = labels.select(
        "service_request_id", *schemas.LABEL.fieldNames(), F.lit(True).alias("_hit"))
    miss = F.col("_hit").isNull()
    return (
        requests.join(recorded, "service_request_id", "left")
        .withColumns({
            "error_type": F.when(miss, "ReplayMiss"),
            "error_message": F.when(
                miss, F.concat(F.lit("no recorded classification for "), "service_request_id")),
        })
        .drop("_hit")
    )


def _by_type(
    requests: DataFrame, sr_types: DataFrame, at: Column, settings: Settings = DEFAULT
) -> DataFrame:
    """One label per service type, joined by service name; types without a label are errors."""
    types = sr_types.filter(F.col("urgency_label") != "").select(
        F.col("sr_type").alias("service_name"), "urgency_label", "urgency_score", "llm_reasoning")
    miss = F.col("urgency_label").isNull()
    return requests.join(types, "service_name", "left").withColumns({
        "langfuse_trace_id": values.trace_id(F.col("service_request_id"), settings),
        "classified_at": at.cast("timestamp_ntz"),
        "days_to_close": F.lit(None).cast("double"),
        "error_type": F.when(miss, "UnlabelledType"),
        "error_message": F.when(
            miss, F.concat(F.lit("no label for type "), F.coalesce("service_name", F.lit("")))),
    })


def _rules(
    requests: DataFrame, label: Column, score: Column, reasoning: Column, at: Column,
    settings: Settings = DEFAULT,
) -> DataFrame:
    """Labels computed by column expressions."""
    return requests.withColumns({
        "urgency_label": label,
        "urgency_score": score.cast("double"),
        "llm_reasoning": reasoning,
        "langfuse_trace_id": values.trace_id(F.col("service_request_id"), settings),
        "classified_at": at.cast("timestamp_ntz"),
        "days_to_close": F.lit(None).cast("double"),
        "error_type": F.lit(None).cast("string"),
        "error_message": F.lit(None).cast("string"),
    })


class _Caller:
    """A thread that makes calls one after another, so that a call with a time limit doesn't need one of its own."""

    def __init__(self) -> None:
        self.asked, self.done = Queue(), Queue()
        Thread(target=_make_calls, args=(self.asked, self.done), daemon=True).start()

    def __del__(self) -> None:
        self.asked.put(None)


def _make_calls(asked: Queue, done: Queue) -> None:
    while (call := asked.get()) is not None:
        try:
            done.put((call[0](*call[1]), None))
        except Exception as exc:
            done.put((None, exc))
        del call


_callers = local()


def within(seconds: float | None, fn: Callable, *args):
    """``fn(*args)``, or TimeoutError if it takes longer than that. None sets no limit."""
    if seconds is None:
        return fn(*args)
    if getattr(_callers, "own", None) is None:
        _callers.own = _Caller()
    caller = _callers.own
    caller.asked.put((fn, args))
    try:
        answer, problem = caller.done.get(timeout=seconds)
    except Empty:
        _callers.own = None
        raise TimeoutError(f"no answer within {seconds} s") from None
    if problem is not None:
        raise problem
    return answer


def _function(
    requests: DataFrame,
    fn: Callable[[pd.DataFrame], pd.DataFrame],
    at: Column,
    settings: Settings = DEFAULT,
    workers: int = 1,
    rows_a_call: int | None = None,
    attempts: int = 1,
    seconds: float | None = None,
) -> DataFrame:
    """Labels from a caller's function over Arrow batches of (service_request_id, prompt).

    ``fn`` returns urgency_label, urgency_score and llm_reasoning for each row it was given, in
    order. A call gets a batch, or ``rows_a_call`` rows of it; ``workers`` calls run at once in a task. A call that
    raises, answers another number of rows or takes longer than ``seconds`` is made ``attempts`` times in all, then its
    rows are halved until what fails is single rows; only those become errors. A call that overran is left behind in
    its own thread, and its late answer is dropped.
    """
    columns = ["urgency_label", "urgency_score", "llm_reasoning"]
    prompt = values.prompt_text(*[
        F.coalesce(c, F.lit("")) for c in ("service_name", "service_code", "status", "address")])
    asked = requests.withColumns({
        "prompt": prompt,
        "tags": values.trace_tags(F.col("city"), F.col("service_code")),
    })
    base = [f for f in requests.schema.fields if f.name not in columns]
    out = T.StructType(
        base
        + [f for f in schemas.LABEL.fields if f.name in columns]
        + _ERRORS
    )

    def answered(rows: pd.DataFrame) -> dict[str, list]:
        out: dict[str, list] = {c: [None] * len(rows) for c in columns + ["error_type", "error_message"]}
        waiting = [(0, len(rows))]
        while waiting:
            lo, hi = waiting.pop()
            part = rows.iloc[lo:hi] if hi - lo < len(rows) else rows
            for _ in range(attempts):
                try:
                    answer = within(seconds, fn, part)
                    if len(answer) != hi - lo:
                        raise ValueError(f"{len(answer)} answers for {hi - lo} rows")
                    values_of = [answer[c].tolist() for c in columns]
                except Exception as exc:  # a caller's function may raise anything
                    problem = exc
                    continue
                for c, x in zip(columns, values_of):
                    out[c][lo:hi] = x
                break
            else:
                if hi - lo == 1:
                    out["error_type"][lo], out["error_message"][lo] = type(problem).__name__, str(problem)
                else:
                    half = lo + (hi - lo) // 2
                    waiting += [(half, hi), (lo, half)]
        return out

    def label_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(workers) as pool:
            for batch in batches:
                size = rows_a_call or max(1, len(batch))
                pieces = [batch.iloc[k:k + size] for k in range(0, len(batch), size)]
                for piece, answer in zip(pieces, pool.map(answered, pieces)):
                    yield piece[[f.name for f in base]].assign(
                        **{f.name: pd.Series(answer[f.name], index=piece.index, dtype=object) for f in out.fields[len(base):]})

    return asked.mapInPandas(label_batches, out).withColumns({
        "langfuse_trace_id": values.trace_id(F.col("service_request_id"), settings),
        "classified_at": at.cast("timestamp_ntz"),
        "days_to_close": F.lit(None).cast("double"),
    })


def label_types(
    inventory: DataFrame,
    out_of_scope: DataFrame,
    strategy: str,
    at: Column,
    settings: Settings = DEFAULT,
    **options,
) -> DataFrame:
    """A type dimension: each type labelled by the strategy, out-of-scope types left unlabelled.

    ``out_of_scope`` holds (sr_type, scope_note). An in-scope type whose labelling failed keeps NULL
    labels, so it has no threshold until it is labelled.
    """
    scoped = inventory.join(out_of_scope, "sr_type", "left")
    code = F.coalesce("sr_short_code", F.lit(""))
    as_requests = scoped.filter(F.col("scope_note").isNull()).select(
        F.concat(F.lit("category:"), F.when(code != "", code).otherwise(F.col("sr_type")))
        .alias("service_request_id"),
        at.cast("timestamp_ntz").alias("requested_datetime"),
        F.col("sr_type").alias("service_name"),
        code.alias("service_code"),
        F.lit("open").alias("status"),
        F.lit("(category-level classification; no specific address)").alias("address"),
        F.lit(None).cast("double").alias("lat"),
        F.lit(None).cast("double").alias("lon"),
        F.lit(settings.default_city).alias("city"),
        F.lit("{}").alias("raw_payload"),
    )
    if strategy != "recorded":
        options.setdefault("at", at)
    labelled = classify(as_requests, strategy, **options).select(
        F.col("service_name").alias("sr_type"),
        F.col("service_code").alias("sr_short_code"),
        F.lit(True).alias("in_sla_scope"),
        F.lit("").alias("scope_note"),
        "urgency_label",
        F.round("urgency_score", 2).alias("urgency_score"),
        "llm_reasoning",
    )
    skipped = scoped.filter(F.col("scope_note").isNotNull()).select(
        "sr_type",
        code.alias("sr_short_code"),
        F.lit(False).alias("in_sla_scope"),
        "scope_note",
        F.lit(None).cast("string").alias("urgency_label"),
        F.lit(None).cast("double").alias("urgency_score"),
        F.lit(None).cast("string").alias("llm_reasoning"),
    )
    return labelled.unionByName(skipped).select(
        "*",
        F.lit(settings.prompt_version).alias("prompt_version"),
        F.date_format(at.cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("classified_at"),
    ).select(schemas.SR_TYPES.fieldNames())
