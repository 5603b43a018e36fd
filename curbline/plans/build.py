"""Build every model in order, run its checks, and stop what depends on a failed one."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession

from curbline.config import DEFAULT, PARENT_LOCATIONS, SLA_STATES, TIERS, UNKNOWN, Settings
from curbline.operators import quality
from curbline.plans import extract, requests
from curbline.session import materialise

Tables = dict[str, DataFrame]
LABELS = (*TIERS, UNKNOWN)


@dataclass
class Model:
    """A model, what it reads, and its checks. ``shared`` models are written once, because several
    others read them or because they are published."""

    name: str
    reads: tuple[str, ...]
    make: Callable[[Tables], DataFrame] | None = None
    shared: bool = False
    row_checks: dict[str, Column] = field(default_factory=dict)
    checks: dict[str, Callable[[Tables], DataFrame]] = field(default_factory=dict)
    warn_only: frozenset[str] = frozenset()


def _not_null(name: str, *columns: str) -> dict[str, Column]:
    return {f"not_null_{name}_{c}": quality.is_null(c) for c in columns}


def _accepted(name: str, column: str, accepted: tuple[str, ...]) -> dict[str, Column]:
    return {f"accepted_values_{name}_{column}": quality.not_accepted(column, accepted)}


def _unique(name: str, column: str) -> dict[str, Callable[[Tables], DataFrame]]:
    return {f"unique_{name}_{column}": lambda t: quality.duplicates(t[name], [column])}


def project(settings: Settings = DEFAULT) -> list[Model]:
    """All sources and models in build order, with the 45 checks."""
    return [
        Model("service_requests", (),
              row_checks=_not_null("service_requests", "service_request_id", "status", "requested_datetime")
              | _accepted("service_requests", "urgency_label", LABELS),
              checks=_unique("service_requests", "service_request_id")),
        Model("portal_requests", (),
              row_checks=_not_null("portal_requests", "sr_number", "pull_id")),
        Model("portal_pulls", (),
              checks={"verified_partitions_reconcile":
                      lambda t: quality.unreconciled_partitions(t["portal_pulls"])}),
        Model("portal_parent_lookup", ()),
        Model("portal_sr_types", ()),
        Model("fiscal_calendar", ("portal_pulls",),
              make=lambda t: t["fiscal_calendar"],
              checks={"fy_fully_covered": lambda t: quality.uncovered_days(
                  t["fiscal_calendar"], t["portal_pulls"], settings)}),
        Model("stg_service_requests", ("service_requests",),
              make=lambda t: requests.stg_service_requests(t["service_requests"]),
              row_checks=_not_null("stg_service_requests", "service_request_id", "requested_datetime", "status")
              | _accepted("stg_service_requests", "urgency_label", LABELS),
              checks=_unique("stg_service_requests", "service_request_id")
              | {"closed_requests_have_close_time": lambda t: quality.closed_without_close_time(
                  t["stg_service_requests"], settings)}),
        Model("int_resolved_requests", ("stg_service_requests",),
              make=lambda t: requests.int_resolved_requests(t["stg_service_requests"], settings)),
        Model("dim_request_category", ("stg_service_requests",), shared=True,
              make=lambda t: requests.dim_request_category(t["stg_service_requests"]),
              row_checks=_not_null("dim_request_category", "service_code", "service_name")
              | _accepted("dim_request_category", "typical_urgency_label", LABELS),
              checks=_unique("dim_request_category", "service_code")),
        Model("fct_sla_compliance", ("int_resolved_requests", "dim_request_category"), shared=True,
              make=lambda t: requests.fct_sla_compliance(
                  t["int_resolved_requests"], t["dim_request_category"]),
              row_checks=_not_null("fct_sla_compliance", "department", "service_code", "month", "total_requests")
              | {"sla_pct_between_0_and_1": quality.outside_unit("sla_pct")},
              checks={"fct_sla_grain_unique": lambda t: quality.grain_duplicates(
                  t["fct_sla_compliance"], ["department", "service_code", "month"])}),
        Model("stg_portal_requests", ("portal_requests", "portal_pulls"), shared=True,
              make=lambda t: extract.stg_portal_requests(t["portal_requests"], t["portal_pulls"]),
              row_checks=_not_null("stg_portal_requests", "sr_number", "created_date")
              | {"close_not_before_create": _closes_early()},
              checks=_unique("stg_portal_requests", "sr_number")
              | {"latest_version_wins": lambda t: quality.version_breaks(
                  t["portal_requests"], t["portal_pulls"], t["stg_portal_requests"])},
              warn_only=frozenset({"close_not_before_create"})),
        Model("int_portal_cohort", ("stg_portal_requests", "fiscal_calendar", "portal_sr_types"), shared=True,
              make=lambda t: extract.int_portal_cohort(
                  t["stg_portal_requests"], t["fiscal_calendar"], t["portal_sr_types"], settings),
              row_checks=_not_null("int_portal_cohort", "sr_number")
              | _accepted("int_portal_cohort", "sla_state", SLA_STATES),
              checks=_unique("int_portal_cohort", "sr_number")),
        Model("int_portal_parent_links", ("stg_portal_requests", "portal_parent_lookup"),
              make=lambda t: extract.int_portal_parent_links(
                  t["stg_portal_requests"], t["portal_parent_lookup"]),
              row_checks=_accepted("int_portal_parent_links", "parent_location", PARENT_LOCATIONS)),
        Model("fct_portal_sla_monthly", ("int_portal_cohort",), shared=True,
              make=lambda t: extract.fct_portal_sla_monthly(t["int_portal_cohort"]),
              row_checks=_not_null("fct_portal_sla_monthly", "sr_type", "month_start", "created_requests"),
              checks={
                  "cohort_denominators": lambda t: quality.denominator_breaks(
                      t["fct_portal_sla_monthly"], t["stg_portal_requests"], settings),
                  "quarters_sum_to_year": lambda t: quality.quarter_breaks(
                      t["fct_portal_sla_monthly"], t["int_portal_cohort"])}),
        Model("fct_portal_sla_by_category", ("fct_portal_sla_monthly",), shared=True,
              make=lambda t: extract.fct_portal_sla_by_category(t["fct_portal_sla_monthly"]),
              row_checks=_not_null("fct_portal_sla_by_category", "sr_type"),
              checks=_unique("fct_portal_sla_by_category", "sr_type")),
        Model("fct_portal_volume_monthly", ("int_portal_cohort",), shared=True,
              make=lambda t: extract.fct_portal_volume_monthly(t["int_portal_cohort"]),
              row_checks=_not_null("fct_portal_volume_monthly", "fiscal_month"),
              checks={"running_total_reconciles": lambda t: quality.running_total_breaks(
                  t["fct_portal_volume_monthly"], t["int_portal_cohort"])}),
        Model("fct_portal_backlog_weekly", ("int_portal_cohort", "fiscal_calendar"), shared=True,
              make=lambda t: extract.fct_portal_backlog_weekly(
                  t["int_portal_cohort"], t["fiscal_calendar"]),
              row_checks=_not_null("fct_portal_backlog_weekly", "week_end"),
              checks={"backlog_flow_identity": lambda t: quality.backlog_breaks(
                  t["fct_portal_backlog_weekly"])}),
    ]


def _closes_early() -> Column:
    from pyspark.sql import functions as F

    return F.coalesce(F.col("closed_date") < F.col("created_date"), F.lit(False))


@dataclass
class BuildResult:
    """``outcome`` has (node, kind, severity, violations, status) of every model and check, ``errors`` what
    those with status ``error`` raised."""

    tables: Tables
    outcome: list[tuple[str, str, str, int | None, str]]
    errors: dict[str, Exception] = field(default_factory=dict)

    @property
    def ok(self) -> bool:
        return all(status not in ("fail", "error") for *_, status in self.outcome)

    def named(self, status: str) -> set[str]:
        return {name for name, _, _, _, s in self.outcome if s == status}

    def report(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            self.outcome, "node string, kind string, severity string, violations long, status string")


def build(
    spark: SparkSession,
    sources: Tables,
    settings: Settings = DEFAULT,
    models: list[Model] | None = None,
    database: str | None = None,
    threads: int = 4,
) -> BuildResult:
    """Build models over ``sources``; with a ``database``, also publish the shared ones as tables.

    A model is skipped, with its checks, when one it reads was skipped, raised, or failed an error-level
    check, or when an error-level check of it raised; a model that raises has its own checks skipped. The build goes
    on with everything else and reports what was raised. Models that wait for nothing more are built side by side, so that the cluster is not left
    to one small job at a time; ``threads`` bounds how many.
    """
    order = models or project(settings)
    tables: Tables = dict(sources)
    notes: dict[str, list[tuple[str, str, str, int | None, str]]] = {}
    blocked: set[str] = set()
    errors: dict[str, Exception] = {}

    def severity(model: Model, check: str) -> str:
        return "warn" if check in model.warn_only else "error"

    def give_up(model: Model, status: str) -> None:
        blocked.add(model.name)
        made = [] if model.make is None else [(model.name, "model", "error", None, status)]
        notes[model.name] = made + [
            (name, "check", severity(model, name), None, "skipped") for name in (*model.row_checks, *model.checks)]

    def finish(model: Model) -> None:
        out: list[tuple[str, str, str, int | None, str]] = []
        if model.make is not None:
            try:
                tables[model.name] = _made(model, tables, database)
            except Exception as exc:  # whatever a model's plan or job raises
                errors[model.name] = exc
                return give_up(model, "error")
            out.append((model.name, "model", "error", None, "built"))
        for name, found in _run_checks(model, tables).items():
            level = severity(model, name)
            if isinstance(found, Exception):
                errors[name] = found
                out.append((name, "check", level, None, "error"))
            else:
                out.append((name, "check", level, found, "pass" if found == 0 else "warn" if level == "warn" else "fail"))
            if level == "error" and out[-1][-1] in ("fail", "error"):
                blocked.add(model.name)
        notes[model.name] = out

    run = inheritable_thread_target(spark)(finish)
    waiting, running = list(order), {}
    with ThreadPoolExecutor(threads) as pool:
        while waiting or running:
            unfinished = {m.name for m in waiting} | set(running.values())
            ready = [m for m in waiting if not unfinished.intersection(m.reads)]
            for model in ready:
                waiting.remove(model)
                if blocked.intersection(model.reads):
                    give_up(model, "skipped")
                else:
                    running[pool.submit(run, model)] = model.name
            if running:
                for done in wait(running, return_when=FIRST_COMPLETED).done:
                    running.pop(done)
                    done.result()
    return BuildResult(tables, [note for m in order for note in notes[m.name]], errors)


def _made(model: Model, tables: Tables, database: str | None) -> DataFrame:
    """A model's table. A shared one is written once: as the published table, or else among the intermediates."""
    made = model.make(tables)
    if not model.shared:
        if database is not None:
            made.createOrReplaceTempView(model.name)
        return made
    if database is None:
        return materialise(made, model.name)
    made.write.mode("overwrite").saveAsTable(f"{database}.{model.name}")
    return made.sparkSession.table(f"{database}.{model.name}")


def _run_checks(model: Model, tables: Tables) -> dict[str, int | Exception]:
    """Violations per check, or what it raised. The row predicates of a model are counted in one pass; its other
    checks are jobs of their own, submitted together."""
    def predicates() -> dict[str, int | Exception]:
        try:
            counts = quality.count_bad_rows(tables[model.name], model.row_checks).head()
        except Exception as exc:
            return dict.fromkeys(model.row_checks, exc)
        return {name: counts[name] for name in model.row_checks}

    def single(name: str, violating: Callable[[Tables], DataFrame]) -> dict[str, int | Exception]:
        try:
            return {name: violating(tables).count()}
        except Exception as exc:
            return {name: exc}

    jobs: list[Callable[[], dict[str, int | Exception]]] = [predicates] if model.row_checks else []
    for name, violating in model.checks.items():
        jobs.append(lambda name=name, violating=violating: single(name, violating))
    if not jobs:
        return {}
    found: dict[str, int | Exception] = {}
    with ThreadPoolExecutor(len(jobs)) as pool:
        run = inheritable_thread_target(tables[model.name].sparkSession)(lambda job: job())
        for part in pool.map(run, jobs):
            found.update(part)
    return found
