"""The build's report again as plain SQL: violations of every check, and what a fault keeps from being built."""

from __future__ import annotations

from curbline.bindings.inputs import SETTINGS
from curbline.config import PARENT_LOCATIONS, SLA_STATES, TIERS, UNKNOWN

# What each model reads, and its checks: columns that are not null, that hold accepted values, that are unique, and
# checks of its own. Sources read nothing and aren't built.
GRAPH: dict[str, tuple[str, str, str, str, str]] = {
    "service_requests": ("", "service_request_id status requested_datetime", "urgency_label", "service_request_id", ""),
    "portal_requests": ("", "sr_number pull_id", "", "", ""),
    "portal_pulls": ("", "", "", "", "verified_partitions_reconcile"),
    "fiscal_calendar": ("portal_pulls", "", "", "", "fy_fully_covered"),
    "stg_service_requests": ("service_requests", "service_request_id requested_datetime status", "urgency_label",
                             "service_request_id", "closed_requests_have_close_time"),
    "int_resolved_requests": ("stg_service_requests", "", "", "", ""),
    "dim_request_category": ("stg_service_requests", "service_code service_name", "typical_urgency_label", "service_code", ""),
    "fct_sla_compliance": ("int_resolved_requests dim_request_category", "department service_code month total_requests", "", "",
                           "sla_pct_between_0_and_1 fct_sla_grain_unique"),
    "stg_portal_requests": ("portal_requests portal_pulls", "sr_number created_date", "", "sr_number",
                            "close_not_before_create latest_version_wins"),
    "int_portal_cohort": ("stg_portal_requests fiscal_calendar portal_sr_types", "sr_number", "sla_state", "sr_number", ""),
    "int_portal_parent_links": ("stg_portal_requests portal_parent_lookup", "", "parent_location", "", ""),
    "fct_portal_sla_monthly": ("int_portal_cohort", "sr_type month_start created_requests", "", "",
                               "cohort_denominators quarters_sum_to_year"),
    "fct_portal_sla_by_category": ("fct_portal_sla_monthly", "sr_type", "", "sr_type", ""),
    "fct_portal_volume_monthly": ("int_portal_cohort", "fiscal_month", "", "", "running_total_reconciles"),
    "fct_portal_backlog_weekly": ("int_portal_cohort fiscal_calendar", "week_end", "", "", "backlog_flow_identity"),
}
MADE = [name for name, (reads, *_) in GRAPH.items() if reads]
CHECKS = [
    (model, check)
    for model, (_, known, accepted, unique, own) in GRAPH.items()
    for check in (*[f"not_null_{model}_{c}" for c in known.split()], *[f"accepted_values_{model}_{c}" for c in accepted.split()],
                  *[f"unique_{model}_{c}" for c in unique.split()], *own.split())
]

# Where the SQL of a model stands: the named steps over the requests, or those over the extract.
REQUEST_STEPS = {
    "service_requests": "service_requests", "stg_service_requests": "stg", "dim_request_category": "categories",
    "fct_sla_compliance": "compliance"}
EXTRACT_STEPS = {
    "portal_requests": "portal_requests", "stg_portal_requests": "stg", "int_portal_cohort": "cohort",
    "int_portal_parent_links": "links", "fct_portal_sla_monthly": "monthly", "fct_portal_sla_by_category": "by_category",
    "fct_portal_volume_monthly": "volume", "fct_portal_backlog_weekly": "backlog"}
ACCEPTED = {"sla_state": SLA_STATES, "parent_location": PARENT_LOCATIONS}

# Violations of the checks that aren't about one column.
SINGLE = {
    "closed_requests_have_close_time": f"""
        select 1 from closed having count_if(updated_datetime is null) > {SETTINGS.max_unparseable_close_time_pct} * count(*)""",
    "sla_pct_between_0_and_1": "select 1 from compliance where not sla_pct between 0 and 1",
    "fct_sla_grain_unique": "select 1 from compliance group by department, service_code, month having count(*) > 1",
    "verified_partitions_reconcile": """
        select 1 from portal_pulls where status = 'verified'
        and (landed_count, expected_count) is distinct from (expected_count, expected_count_after)""",
    "fy_fully_covered": f"""
        select calendar_date from calendar where fiscal_year = {SETTINGS.fiscal_year}
        except select partition_date from portal_pulls where status = 'verified'""",
    "close_not_before_create": "select 1 from stg where closed_date < created_date",
    "latest_version_wins": """
        select 1 from (select (select count(*) from stg) as mine, count(distinct sr_number) as theirs from verified) where mine <> theirs
        union all
        select 1 from verified v join stg s on s.sr_number = v.sr_number
        where v.last_modified_date > coalesce(s.last_modified_date, timestamp '0001-01-01')""",
    "cohort_denominators": """
        select 1 from monthly where created_requests <> excluded_requests + met + missed + pending
        union all
        select 1 from (select count(*) as n from cohort) where n <> (select sum(created_requests) from monthly)""",
    "quarters_sum_to_year": "select fiscal_year from cohort group by 1 having count(distinct fiscal_quarter) <> 4",
    "running_total_reconciles": """
        select 1 from volume v where created_running_total <> (
            select count(*) from cohort e where e.fiscal_year = v.fiscal_year and e.fiscal_month <= v.fiscal_month)""",
    "backlog_flow_identity": """
        select 1 from backlog w left join backlog b
          on b.owner_department = w.owner_department and b.week_end = w.week_start - 1
        where w.open_at_week_end - coalesce(b.open_at_week_end, 0) <> w.opened_in_week - w.closed_in_week""",
}
IN_REQUESTS = {"closed_requests_have_close_time", "sla_pct_between_0_and_1", "fct_sla_grain_unique"}


def _violating(model: str, check: str) -> tuple[bool, str]:
    """Whether a check is over the requests, and the rows that break it."""
    if check in SINGLE:
        return check in IN_REQUESTS, SINGLE[check]
    over = model in REQUEST_STEPS
    step = (REQUEST_STEPS if over else EXTRACT_STEPS)[model]
    rule, column = check.split(f"_{model}_")
    if rule == "not_null":
        return over, f"select 1 from {step} where {column} is null"
    if rule == "unique":
        return over, f"select 1 from {step} where {column} is not null group by {column} having count(*) > 1"
    names = ", ".join(f"'{v}'" for v in ACCEPTED.get(column, (*TIERS, UNKNOWN)))
    return over, f"select 1 from {step} where {column} not in ({names})"


def violations(requests, extract) -> str:
    """(node, violations) of every check. ``requests`` and ``extract`` put their steps before a final select."""
    found: dict[bool, list[str]] = {True: [], False: []}
    for model, check in CHECKS:
        over, rows = _violating(model, check)
        found[over].append(f"select '{check}' as node, (select count(*) from ({rows})) as violations")
    return " union all ".join(f"(from ({put(' union all '.join(found[over]))}))" for over, put in ((True, requests), (False, extract)))


def report(requests, extract) -> str:
    """Every model built, every check with its violations, of which those it has are warnings."""
    models = ", ".join(f"('{m}')" for m in MADE)
    return f"""
        select node, 'model' as kind, 'error' as severity, null::bigint as violations, 'built' as status
        from (values {models}) m(node)
        union all
        select node, 'check', 'warn', violations, case violations when 0 then 'pass' else 'warn' end
        from ({violations(requests, extract)}) v"""


def failed_report(requests, extract, raising: str, failing: tuple[str, str], raising_check: tuple[str, str]) -> str:
    """The report when a model raises, one has a check that every row breaks, and one a check that raises. What reads
    a model that raised or failed is skipped, and so on down the graph."""
    reads = ", ".join(f"('{m}', '{r}')" for m, (sources, *_) in GRAPH.items() for r in sources.split())
    made = ", ".join(f"('{m}')" for m in MADE)
    checks = ", ".join(f"('{m}', '{c}')" for m, c in CHECKS)
    failing_step = EXTRACT_STEPS[failing[0]]
    return f"""
        with recursive reads(model, source) as (values {reads}),
        broken(model) as (values ('{raising}'), ('{failing[0]}'), ('{raising_check[0]}')),
        skipped as (
            select r.model from reads r join broken b on b.model = r.source
            union select r.model from reads r join skipped s on s.model = r.source),
        unchecked as (from skipped union select '{raising}'),
        counted as ({violations(requests, extract)}),
        given(model, node) as (values {checks})
        select node, 'model' as kind, 'error' as severity, null::bigint as violations,
               case when node = '{raising}' then 'error' when node in (from skipped) then 'skipped' else 'built' end as status
        from (values {made}) m(node)
        union all
        select g.node, 'check', 'warn', case when g.model not in (from unchecked) then c.violations end,
               case when g.model in (from unchecked) then 'skipped' when c.violations = 0 then 'pass' else 'warn' end
        from given g join counted c on c.node = g.node
        union all
        select '{failing[1]}', 'check', 'error', n, 'fail' from ({extract(f"select count(*) as n from {failing_step}")}) f
        union all
        select '{raising_check[1]}', 'check', 'error', null, 'error'"""
