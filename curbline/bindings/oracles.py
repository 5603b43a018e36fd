"""The registered queries again as plain SQL over whole tables, written in their literal form: a
ranking window instead of an aggregate, a range join instead of running sums, and so on."""

from __future__ import annotations

from curbline.bindings import build_oracle, inputs, landings, streams
from curbline.bindings.catalog import FAILING, RAISING, RAISING_CHECK
from curbline.bindings.inputs import REPULL_FROM, REQUEST_SETTINGS, SETTINGS
from curbline.config import TIERS, Settings
from curbline.schemas import EXPECTED_KEYS, OPTIONAL_KEYS


def _dialect(sql: str) -> str:
    """The shared projections in the checking database's spelling."""
    return sql.replace("timestamp_ntz '", "timestamp '").replace(
        "datediff(day, date '1995-01-01')", "(day - date '1995-01-01')")


def _hours(label: str, settings: Settings) -> str:
    cases = " ".join(f"when '{t}' then {h}" for t, h in settings.sla_thresholds.items())
    return f"case {label} {cases} end"


def _list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _state_counts(states: str, closings: str) -> str:
    """Counts per state, from a map of states and one of whether closings were in time."""
    def at(of: str, key: str) -> str:
        return f"coalesce({of}[{key}], 0)::bigint"

    kept = ", ".join(f"{at(states, repr(s))} as {s}" for s in ("met", "missed", "pending"))
    return (f"{at(states, repr('excluded'))} as excluded_requests, {kept}, "
            f"{at(closings, 'true')} + {at(closings, 'false')} as closed_requests, {at(closings, 'true')} as closed_within_sla")


_FISCAL = """
    cast(year(day + interval 3 month) as int) as fiscal_year,
    cast(quarter(day + interval 3 month) as int) as fiscal_quarter,
    cast(month(day + interval 3 month) as int) as fiscal_month,
    cast(date_trunc('month', day) as date) as month_start,
    cast(date_trunc('week', day) as date) as week_start,
    cast(date_trunc('week', day) as date) + 6 as week_end,
    cast(isodow(day) as int) as day_of_week
"""

# -- named steps; each may use those before it -----------------------------------------------

EXTRACT: dict[str, str] = {
    "shipments": "select l_orderkey, max(l_shipdate) as shipped from lineitem group by 1",
    "one": _dialect(inputs.ORDER_REQUESTS_SQL),
    "pulled": f"""
        select one.*, p.pull_id from one
        join (values ('a-base'), ('b-repull')) p(pull_id)
          on p.pull_id = 'a-base' or opened_on >= timestamp '{REPULL_FROM}'""",
    "portal_requests": _dialect(inputs.VERSIONS_SQL),
    "counted": f"""
        select p.pull_id, o.day, o.n
        from (select cast(o_orderdate as date) as day, count(*) as n from orders group by 1) o
        join (values ('a-base'), ('b-repull')) p(pull_id)
          on p.pull_id = 'a-base' or day >= date '{REPULL_FROM}'""",
    "portal_pulls": _dialect(inputs.LEDGER_SQL),
    "sr_types": _dialect(inputs.TYPES_SQL),
    "parent_lookup": _dialect(inputs.LOOKUP_SQL),
    "calendar": f"""
        select cast(d as date) as calendar_date, {_FISCAL.replace("day", "cast(d as date)").replace("cast(d as date)_of_week", "day_of_week")}
        from generate_series(date '{SETTINGS.fiscal_year - 2}-10-01',
                             date '{SETTINGS.fiscal_year + 1}-09-30', interval 1 day) g(d)""",
    "verified": """
        select r.* from portal_requests r
        where exists (select 1 from portal_pulls p where p.status = 'verified'
                      and p.pull_id = r.pull_id and p.partition_date = r.partition_date)""",
    "stg": """
        select sr_number, sr_type, sr_short_code, owner_department, status, origin, created_date,
               last_modified_date, closed_date, duplicate, legacy_record,
               nullif(parent_sr_number, '') as parent_sr_number, ward, community_area,
               pull_id as latest_pull_id, pulled_at as latest_pulled_at,
               cast(count(*) over (partition by sr_number) as bigint) as versions_seen
        from verified
        qualify row_number() over (
            partition by sr_number
            order by last_modified_date desc nulls last, pulled_at desc, pull_id desc) = 1""",
    "cohort_base": f"""
        select s.sr_number, s.sr_type, s.owner_department, s.status, s.created_date, s.closed_date,
               s.duplicate, s.parent_sr_number, cast(s.created_date as date) as created_day,
               c.fiscal_year, c.fiscal_quarter, c.fiscal_month, c.month_start, c.week_start,
               coalesce(t.in_sla_scope, false) as in_sla_scope, t.urgency_label,
               cast({_hours("t.urgency_label", SETTINGS)} as int) as sla_threshold_hours,
               date_diff('second', s.created_date, s.closed_date) / 3600.0::double as hours_to_close,
               date_diff('second', s.created_date, (select max(last_modified_date) from stg))
                   / 3600.0::double as hours_open_at_as_of,
               (select max(last_modified_date) from stg) as as_of_ts
        from stg s
        join calendar c on c.calendar_date = cast(s.created_date as date)
                       and c.fiscal_year = {SETTINGS.fiscal_year}
        left join sr_types t on t.sr_type = s.sr_type""",
    "left_out": """
        select sr_number, min_by(reason, place) as exclusion_reason
        from (select sr_number, 'out_of_scope' as reason, 1 as place from cohort_base
              where sr_number not in (select sr_number from cohort_base
                                      where in_sla_scope and sla_threshold_hours is not null)
              union all select sr_number, 'duplicate', 2 from cohort_base where duplicate
              union all select sr_number, 'canceled', 3 from cohort_base where status = 'Canceled')
        group by sr_number""",
    "judged": "select * from cohort_base where sr_number not in (select sr_number from left_out)",
    "states": """
        select sr_number, 'excluded' as sla_state, null::boolean as closed_within_sla from left_out
        union all select sr_number, 'met', true from judged where hours_to_close <= sla_threshold_hours
        union all select sr_number, 'missed', false from judged where hours_to_close > sla_threshold_hours
        union all select sr_number, 'missed', null from judged
            where closed_date is null and hours_open_at_as_of > sla_threshold_hours
        union all select sr_number, 'pending', null from judged
            where closed_date is null and (hours_open_at_as_of > sla_threshold_hours) is not true""",
    "cohort": """
        select * from cohort_base join states using (sr_number) left join left_out using (sr_number)""",
    "tallied": """
        select coalesce(owner_department, 'Unknown') as owner_department, sr_type, fiscal_year,
               fiscal_quarter, fiscal_month, month_start,
               histogram(sla_state) as in_state, coalesce(histogram(closed_within_sla), map {}) as in_time
        from cohort group by all""",
    "monthly_counts": f"""
        select owner_department, sr_type, fiscal_year, fiscal_quarter, fiscal_month, month_start,
               list_sum(map_values(in_state))::bigint as created_requests,
               {_state_counts("in_state", "in_time")}
        from tallied""",
    "monthly": """
        select *,
            closed_within_sla::double / nullif(closed_requests, 0) as closed_only_sla_pct,
            met::double / nullif(met + missed, 0) as cohort_sla_pct,
            100.0::double * (closed_within_sla::double / nullif(closed_requests, 0)
                - met::double / nullif(met + missed, 0)) as bias_pct_points
        from monthly_counts""",
    "category_counts": f"""
        select sr_type, last_department as owner_department, fiscal_year,
               list_sum(map_values(in_state))::bigint as created_requests,
               {_state_counts("in_state", "in_time")}
        from (select sr_type, fiscal_year, max(coalesce(owner_department, 'Unknown')) as last_department,
                     histogram(sla_state) as in_state, coalesce(histogram(closed_within_sla), map {{}}) as in_time
              from cohort group by all)
        where map_keys(in_state) <> ['excluded']""",
    "by_category": """
        select *,
            closed_within_sla::double / nullif(closed_requests, 0) as closed_only_sla_pct,
            met::double / nullif(met + missed, 0) as cohort_sla_pct,
            100.0::double * (closed_within_sla::double / nullif(closed_requests, 0)
                - met::double / nullif(met + missed, 0)) as bias_pct_points
        from category_counts""",
    "volume": """
        select m.*, (select sum(e.created_requests)::bigint from by_month e
                     where e.fiscal_year = m.fiscal_year and e.fiscal_month <= m.fiscal_month)
                    as created_running_total
        from (select * from by_month) m""",
    "open_requests": """
        select coalesce(owner_department, 'Unknown') as owner_department, created_day,
               cast(closed_date as date) as closed_day, as_of_ts
        from cohort where sla_state <> 'excluded'""",
    "spans": """
        select owner_department, date_trunc('week', created_day) as began, date_trunc('week', closed_day) as ended
        from open_requests""",
    "flows": """
        select owner_department, began as week, 1 as opened, 0 as closed, 1 as change from spans
        union all select owner_department, ended, 0, 1, 0 from spans where ended >= began
        union all select owner_department, greatest(began, ended), 0, 0, -1 from spans where ended is not null
        union all select d.owner_department, w.d, 0, 0, 0
        from (select distinct owner_department from spans) d,
             (select unnest(generate_series(min(date_trunc('week', created_day)),
                                            max(date_trunc('week', as_of_ts + interval 1 day) - interval 7 day),
                                            interval 7 day)) as d from open_requests) w""",
    "backlog": """
        select owner_department, week::date as week_start, week::date + 6 as week_end,
               sum(sum(change)) over (partition by owner_department order by week)::bigint as open_at_week_end,
               sum(opened)::bigint as opened_in_week, sum(closed)::bigint as closed_in_week
        from flows
        where week <= (select max(date_trunc('week', as_of_ts + interval 1 day) - interval 7 day) from open_requests)
        group by owner_department, week""",
}
# The monthly volume step needs its own counts in front of it.
EXTRACT = {
    name: sql
    for step, text in EXTRACT.items()
    for name, sql in (
        [("by_month", """
        select fiscal_year, fiscal_quarter, fiscal_month, month_start,
               count(*)::bigint as created_requests,
               count(*) filter (sla_state <> 'excluded')::bigint as in_scope_requests
        from cohort group by all""")] if step == "volume" else []
    ) + [(step, text)]
}

_ISO = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$"

REQUESTS: dict[str, str] = {
    "service_requests": _dialect(inputs.REQUESTS_SQL),
    "stg": "select * from service_requests where service_request_id is not null",
    "closed": f"""
        select *,
            case when regexp_matches(raw_payload ->> 'updated_datetime', '{_ISO}')
                 then try_cast(rtrim(raw_payload ->> 'updated_datetime', 'Z') as timestamp) end
                as updated_datetime
        from stg where status = 'closed'""",
    "resolved": f"""
        select service_request_id, service_code, service_name, address, lat, lon, city,
               requested_datetime, updated_datetime,
               date_diff('millisecond', requested_datetime, updated_datetime)
                   / 3600000.0::double as hours_to_close,
               date_diff('millisecond', requested_datetime, updated_datetime)
                   / 86400000.0::double as days_to_close,
               urgency_label, urgency_score, classified_at, raw_payload ->> 'group' as department,
               cast({_hours("urgency_label", REQUEST_SETTINGS)} as int) as sla_threshold_hours,
               date_diff('millisecond', requested_datetime, updated_datetime) / 3600000.0::double
                   <= {_hours("urgency_label", REQUEST_SETTINGS)} as met_sla
        from closed where updated_datetime >= requested_datetime""",
    "label_counts": """
        select service_code, urgency_label, count(*) as n from stg
        where service_code is not null and urgency_label <> 'Unknown' group by all""",
    "categories": """
        select s.service_code, min(s.service_name) as service_name,
               min(s.raw_payload ->> 'group') as department,
               coalesce(min(u.urgency_label), 'Unknown') as typical_urgency_label,
               count(*)::bigint as total_observed
        from stg s
        left join (select service_code, urgency_label from label_counts
                   qualify row_number() over (
                       partition by service_code order by n desc, urgency_label) = 1) u
          on u.service_code = s.service_code
        where s.service_code is not null group by s.service_code""",
    "compliance": """
        select coalesce(c.department, 'Unknown') as department, r.service_code, c.service_name,
               cast(date_trunc('month', r.requested_datetime) as timestamp) as month,
               count(*)::bigint as total_requests,
               count(*) filter (r.urgency_label <> 'Unknown')::bigint as classified_requests,
               count(*) filter (r.met_sla)::bigint as closed_within_sla,
               count(*) filter (r.met_sla)::double
                   / nullif(count(*) filter (r.urgency_label <> 'Unknown'), 0) as sla_pct,
               avg(r.days_to_close) as avg_days_to_close
        from resolved r left join categories c on c.service_code = r.service_code
        group by 1, 2, 3, 4""",
}

_KEYS = ("service_request_id", "status", "service_name", "service_code", "requested_datetime",
         "address", "lat", "long", "lon")

FEED: dict[str, str] = {
    "pages": _dialect(inputs.PAGES_SQL),
    "listed": """
        select feed, page, value,
               coalesce(json_valid(value), false) and
               case when json_valid(value) then json_type(value) = 'ARRAY' end as is_list
        from pages""",
    "elements": """
        select feed, page, is_list, unnest(json_extract(value, '$[*]')) as record
        from listed where is_list
        union all
        select feed, page, false, null from listed where not coalesce(is_list, false)""",
    "fields": "select *, " + ", ".join(
        f"json_type(record, '$.{k}') as t_{k}, record ->> '$.{k}' as {k}" for k in _KEYS
    ) + " from elements",
    "parsed": f"""
        select feed, page, record,
            case when t_service_request_id is null then '' else service_request_id end as service_request_id,
            case when regexp_matches(requested_datetime, '^\\d{{4}}-\\d{{2}}-\\d{{2}}T\\d{{2}}:\\d{{2}}:\\d{{2}}(Z|-05:00)$')
                 then try_cast(substr(requested_datetime, 1, 19) as timestamp)
                      + case when requested_datetime like '%-05:00' then interval 5 hour
                             else interval 0 hour end end as requested_datetime,
            case when t_service_name is null then '' else service_name end as service_name,
            case when t_service_code is null then '' else service_code end as service_code,
            case when t_status is null then 'open' else status end as status,
            case when t_address is null then '' else address end as address,
            try_cast(lat as double) as lat,
            try_cast(case when t_long is not null then long else lon end as double) as lon,
            'chicago' as city,
            case when not is_list then 'unexpected_payload'
                 when json_type(record) <> 'OBJECT' then 'record_not_object'
                 when t_service_request_id is null or trim(service_request_id) = '' then 'missing_id'
                 when t_requested_datetime is distinct from 'VARCHAR'
                      or not regexp_matches(requested_datetime, '^\\d{{4}}-\\d{{2}}-\\d{{2}}(T|$)')
                     then 'bad_requested_datetime'
                 when t_service_name not in ('VARCHAR') then 'bad_service_name'
                 when t_service_code not in ('VARCHAR', 'UBIGINT', 'BIGINT', 'DOUBLE') then 'bad_service_code'
                 when t_status not in ('VARCHAR') then 'bad_status'
                 when t_address not in ('VARCHAR') then 'bad_address'
                 when lat <> '' and try_cast(lat as double) is null then 'bad_lat'
                 when (case when t_long is not null then long else lon end) <> ''
                      and try_cast(case when t_long is not null then long else lon end as double) is null
                     then 'bad_lon' end as reject_reason
        from fields""",
}

STREAM: dict[str, str] = {
    "service_requests": REQUESTS["service_requests"],
    "routed": """
        select *, cast(substr(service_request_id, 2) as bigint) as n,
            case when cast(substr(service_request_id, 2) as bigint) % 50 in (1, 2) then 'message_parse_error'
                 when service_code is null then 'message_parse_error'
                 when coalesce(urgency_label, 'Unknown') = 'Unknown' then 'ReplayMiss' end as problem
        from service_requests""",
}

PAIRS: dict[str, str] = {"pairs": _dialect(inputs.PAIRS_SQL)}
TWO_CLASS: dict[str, str] = {
    "pairs": """select doc_id, case quality when 1 then 'High' else 'Low' end as human,
                       case toxic when 1 then 'High' else 'Low' end as model from labels""",
}
_TIER_VALUES = ", ".join(f"('{t}', {i})" for i, t in enumerate(TIERS))
_AGREE: dict[str, str] = {
    "tiers": f"select * from (values {_TIER_VALUES}) t(tier, r)",
    "ranked": """
        select p.*, h.r as h, m.r as m from pairs p
        join tiers h on h.tier = p.human join tiers m on m.tier = p.model""",
    "cells": """
        select a.r as i, b.r as j,
               (select count(*) from ranked where h = a.r) as row_n,
               (select count(*) from ranked where m = b.r) as col_n,
               (select count(*) from ranked where h = a.r and m = b.r) as n
        from tiers a, tiers b""",
}
_AGREEMENT = """
select (select count(*) from ranked)::bigint as n,
       (select count(*) filter (h = m)::double / count(*) from ranked) as exact_agreement,
       (select count(*) filter (abs(h - m) <= 1)::double / count(*) from ranked) as within_one_tier,
       1 - (sum(case when i <> j then n else 0 end) * (select count(*) from ranked))::double
           / sum(case when i <> j then row_n * col_n else 0 end)::double as cohens_kappa,
       1 - (sum((i - j) * (i - j) * n) * (select count(*) from ranked))::double
           / sum((i - j) * (i - j) * row_n * col_n)::double as quadratic_weighted_kappa,
       (select count(*) filter (m > h) from ranked)::bigint as model_more_urgent,
       (select count(*) filter (m < h) from ranked)::bigint as model_less_urgent
from cells
"""


def _with(steps: dict[str, str], final: str, last: str | None = None) -> str:
    """The steps up to ``last`` followed by the final select."""
    used = []
    for name, sql in steps.items():
        used.append(f"{name} as ({sql.strip()})")
        if name == last:
            break
    return "with " + ",\n".join(used) + "\n" + final.strip()


def _extract(final: str, last: str | None = None) -> str:
    return _with(EXTRACT, final, last)


def _requests(final: str, last: str | None = None) -> str:
    return _with(REQUESTS, final, last)


_VERSION_CHECK = {
    **{k: v for k, v in EXTRACT.items()},
    "stale": """
        select * replace (case when ward < 5 then last_modified_date - interval 1 day
                               else last_modified_date end as last_modified_date)
        from stg where owner_department is distinct from 'Dept 1'""",
}
_CATEGORY_AGREE = {
    "service_requests": REQUESTS["service_requests"],
    "kinds": """
        select distinct service_name, case service_name when 'error' then 'Critical'
            when 'click' then 'Medium' when 'signup' then 'Medium' else 'High' end as category_label
        from service_requests""",
    "counts": """
        select service_name, urgency_label, count(*) as n from service_requests
        where urgency_label <> 'Unknown' group by all""",
    "agreed": """
        select c.service_name, k.category_label, m.urgency_label as modal_label,
               sum(c.n)::bigint as requests,
               coalesce(sum(c.n) filter (c.urgency_label = k.category_label), 0)::bigint as matching_requests,
               m.urgency_label = k.category_label as modal_matches
        from counts c join kinds k using (service_name)
        join (select * from counts qualify row_number() over (
                  partition by service_name order by n desc, urgency_label) = 1) m using (service_name)
        group by all""",
}
_MERGE = {
    "service_requests": REQUESTS["service_requests"],
    "numbered": "select *, cast(substr(service_request_id, 2) as bigint) as n from service_requests",
}
_ENRICHED = ("service_request_id, requested_datetime, service_name, service_code, status, address, "
             "lat, lon, city, raw_payload")

_FIRST, _SECOND = (f"timestamp '{t}'" for t in (landings.FIRST, landings.SECOND))
_LANDED: dict[str, str] = {
    **{name: EXTRACT[name] for name in ("shipments", "one", "pulled", "portal_requests")},
    "source": """
        select *, ((partition_date - date '1995-01-01') % 7 + 7) % 7 as kind
        from portal_requests where pull_id = 'a-base'""",
    "planned": """
        select cast(d as date) as day, ((cast(d as date) - date '1995-01-01') % 7 + 7) % 7 as kind,
               (select count(*) from source s where s.partition_date = cast(d as date)) as n
        from (select unnest(generate_series(min(partition_date), max(partition_date), interval 1 day)) as d from source)""",
}

_PAGES: dict[str, str] = {
    **{name: EXTRACT[name] for name in ("shipments", "one", "pulled", "portal_requests")},
    "paged": """
        select *, strftime(created_date, '%Y-%m') as page, (year(created_date) * 12 + month(created_date)) % 5 as kind,
               kind = 1 and substr(sr_number, 3, 8)::bigint % 2 = 0 as short
        from portal_requests where pull_id = 'a-base'""",
}

_LINKS: dict[str, str] = {
    "places": """
        select sr_number, created_date, sr_type, 'in_extract' as place from stg
        union all
        select l.sr_number, l.created_date, l.sr_type, 'outside_window' from parent_lookup l
        anti join stg using (sr_number) where l.found
        union all
        select l.sr_number, l.created_date, l.sr_type, 'not_found' from parent_lookup l
        anti join stg using (sr_number) where l.found is distinct from true""",
    "links": """
        select c.sr_number, c.sr_type, c.created_date, c.duplicate, c.parent_sr_number,
               k.created_date as parent_created_date, k.sr_type as parent_sr_type,
               coalesce(k.place, 'not_looked_up') as parent_location
        from (from stg where parent_sr_number is not null) c
        left join places k on k.sr_number = c.parent_sr_number""",
}


def _build_extract(final: str) -> str:
    return _with({**EXTRACT, **_LINKS}, final)


ORACLES: dict[str, str] = {
    "fiscal_calendar": f"""
        with span as (select min(year(o_orderdate + interval 3 month)) as lo,
                             max(year(o_orderdate + interval 3 month)) as hi from orders),
        days as (select cast(d as date) as day from (
            select unnest(generate_series(make_date(lo - 1, 10, 1)::timestamp,
                                          make_date(hi, 9, 30)::timestamp, interval 1 day)) as d from span))
        select day as calendar_date, {_FISCAL}, coalesce(n, 0)::bigint as requests
        from days left join (select cast(o_orderdate as date) as od, count(*) as n from orders group by 1)
          on od = day""",
    "partition_plan": """
        with last as (select max(year(o_orderdate + interval 3 month)) as fy from orders),
        days as (select fy, cast(d as date) as day from (
            select fy, unnest(generate_series(make_date(fy, 9, 30)::timestamp - interval 89 day,
                                              make_date(fy, 9, 30)::timestamp, interval 1 day)) as d from last))
        select 'fy' || fy || '-last90d' as window_label, day as partition_date,
               'created_date >= ''' || strftime(day, '%Y-%m-%d') || 'T00:00:00'' AND created_date < '''
                   || strftime(day + 1, '%Y-%m-%d') || 'T00:00:00''' as where_clause,
               (select count(*) from orders where cast(o_orderdate as date) = day)::bigint as requests
        from days""",
    "stg_latest_version": _extract("select * from stg", "stg"),
    "cohort_states": _extract("select * from cohort", "cohort"),
    "sla_monthly": _extract("select * from monthly", "monthly"),
    "sla_by_category": _extract("select * from by_category", "by_category"),
    "volume_running": _extract("select * from volume", "volume"),
    "backlog_weekly": _extract("select * from backlog", "backlog"),
    "parent_links": _with({**EXTRACT, **_LINKS}, "select * from links"),
    "missing_parents": _extract("""
        select m.sr_number, e.sr_number is not null as found, e.sr_type, e.created_date,
               timestamp '2001-11-22' as looked_up_at
        from (select distinct parent_sr_number as sr_number from portal_requests
              where parent_sr_number <> ''
                and parent_sr_number not in (select sr_number from verified)
                and parent_sr_number not in (select sr_number from parent_lookup)) m
        left join (select 'SRX' || (o_orderkey % 500) as sr_number, min(o_orderpriority) as sr_type,
                          min(o_orderdate) as created_date
                   from orders where o_orderkey % 7 = 0 group by 1) e on e.sr_number = m.sr_number""",
        "verified"),
    "pull_ledger": _extract("""
        select p.pull_id, p.window_label, p.partition_date, p.where_clause, p.expected_count,
               p.expected_count_after,
               (select count(*) from portal_requests r where r.pull_id = p.pull_id
                and r.partition_date = p.partition_date)::bigint as landed_count,
               case when p.expected_count = p.expected_count_after and p.expected_count =
                    (select count(*) from portal_requests r where r.pull_id = p.pull_id
                     and r.partition_date = p.partition_date) then 'verified'
                    else 'count_mismatch' end as status, p.started_at, p.finished_at
        from portal_pulls p""", "portal_pulls"),
    "fixture_requests": _extract("""
        select * from verified
        where sr_type in (select sr_type from sr_types where urgency_label = 'Critical')""", "verified"),
    "fixture_ledger": _extract("""
        select p.pull_id, p.window_label, p.partition_date, p.status, p.started_at, p.finished_at,
               concat(p.where_clause, ' AND sr_type IN (fixture types)') as where_clause,
               d.n as expected_count, d.n as expected_count_after, d.n as landed_count
        from (select pull_id, partition_date, sum(one)::bigint as n
              from (select pull_id, partition_date, 0 as one from portal_pulls where status = 'verified'
                    union all
                    select v.pull_id, v.partition_date, 1 from verified v
                    semi join (from sr_types where urgency_label = 'Critical') using (sr_type))
              group by 1, 2) d
        join portal_pulls p using (pull_id, partition_date)""", "verified"),
    "fixture_parents": _extract("""
        select * from parent_lookup where sr_number in (
            select parent_sr_number from portal_requests
            where sr_type in (select sr_type from sr_types where urgency_label = 'Critical'))""",
        "parent_lookup"),
    "type_labels": _extract("""
        select i.sr_type, i.code as sr_short_code, coalesce(t.in_sla_scope, true) as in_sla_scope,
               coalesce(t.scope_note, '') as scope_note, t.urgency_label, t.urgency_score,
               t.llm_reasoning, 'v1' as prompt_version, '2001-12-01T00:00:00Z' as classified_at
        from (select sr_type, min(sr_short_code) as code from portal_requests group by 1) i
        left join sr_types t on t.sr_type = i.sr_type""", "sr_types"),
    "closed_at_intake": _extract("""
        select sr_type, count(*)::bigint as closed_requests,
               count(*) filter (h <= 36000)::bigint as within_limit,
               quantile_cont(h, 0.5) <= 36000 as closed_at_intake
        from (select sr_type, date_diff('second', created_date, closed_date) / 3600.0::double as h
              from stg where closed_date is not null) group by 1""", "stg"),
    "stg_requests": _requests("select * from stg", "stg"),
    "resolved_requests": _requests("select * from resolved", "resolved"),
    "category_dim": _requests("select * from categories", "categories"),
    "sla_compliance": _requests(
        "select * replace (round(avg_days_to_close, 9) as avg_days_to_close) from compliance", "compliance"),
    "sla_headline": _requests("""
        select raw.n::bigint as raw_rows, raw.rated::bigint as classified_rows, r.buckets::bigint as buckets,
               r.buckets_with_sla::bigint as buckets_with_sla, r.pooled_sla_pct
        from (select count(*) as n, count_if(urgency_label <> 'Unknown') as rated from service_requests) raw,
             (select count(distinct bucket) as buckets,
                     count(distinct bucket) filter (urgency_label <> 'Unknown') as buckets_with_sla,
                     count_if(met_sla)::double / nullif(count_if(urgency_label <> 'Unknown'), 0) as pooled_sla_pct
              from (select *, row(service_code, date_trunc('month', requested_datetime)) as bucket
                    from resolved)) r""", "resolved"),
    "sla_by_service": _requests("""
        select k.service_name, k.typical_urgency_label, count_if(rated) as classified,
               avg((met_sla is true)::int) filter (rated) as sla_pct, round(avg(r.days_to_close), 9) as avg_days_to_close
        from (select *, urgency_label <> 'Unknown' as rated from resolved) r
        join categories k on k.service_code = r.service_code
        group by k.service_name, k.typical_urgency_label having count_if(rated) > 2""", "categories"),
    "fy_summary": _extract("""
        select min(fiscal_year) as fiscal_year, sum(created_requests)::bigint as created_requests,
               sum(excluded_requests)::bigint as excluded_requests, sum(met)::bigint as met,
               sum(missed)::bigint as missed, sum(pending)::bigint as pending,
               sum(closed_requests)::bigint as closed_requests,
               sum(closed_within_sla)::bigint as closed_within_sla,
               (sum(met) + sum(missed) + sum(pending))::bigint as in_cohort,
               sum(closed_within_sla)::double / sum(closed_requests) as closed_only_sla_pct,
               sum(met)::double / (sum(met) + sum(missed)) as cohort_sla_pct,
               100.0::double * (sum(closed_within_sla)::double / sum(closed_requests)
                   - sum(met)::double / (sum(met) + sum(missed))) as bias_pct_points
        from monthly""", "monthly"),
    "exclusion_reasons": _extract("""
        select exclusion_reason, count(*)::bigint as requests from cohort
        where sla_state = 'excluded' group by 1""", "cohort"),
    "top_bias": _extract("""
        select *, 100.0::double * (closed_only_sla_pct - cohort_sla_pct) as bias_pct_points
        from (select sr_type, count(*)::bigint as cohort,
                     count_if(sla_state = 'pending')::bigint as pending,
                     avg(closed_within_sla::int) as closed_only_sla_pct,
                     avg((sla_state = 'met')::int) filter (sla_state <> 'pending') as cohort_sla_pct
              from cohort where sla_state <> 'excluded' group by sr_type)
        where cohort >= 5
        qualify row_number() over (order by bias_pct_points desc nulls last, sr_type) <= 10""", "cohort"),
    "backlog_city": _extract("""
        select week_end, open_at_week_end, opened_in_week, closed_in_week
        from (select week_end, sum(open_at_week_end)::bigint as open_at_week_end,
                     sum(opened_in_week)::bigint as opened_in_week,
                     sum(closed_in_week)::bigint as closed_in_week,
                     row_number() over (order by week_end) as i, count(*) over () as weeks
              from backlog group by 1)
        where (i - 1) % 4 = 0 or i = weeks""", "backlog"),
    "label_drift": _requests("""
        select service_code, cast(date_trunc('month', classified_at) as date) as month,
               count(*)::bigint as classified,
               count(*) filter (urgency_label = 'Critical')::double / count(*) as critical_share,
               count(*) filter (urgency_label = 'High')::double / count(*) as high_share,
               count(*) filter (urgency_label = 'Medium')::double / count(*) as medium_share,
               count(*) filter (urgency_label = 'Low')::double / count(*) as low_share,
               round(quantile_cont(urgency_score, 0.5), 9) as median_score,
               min(urgency_score) as min_score
        from service_requests where urgency_label <> 'Unknown' group by 1, 2""", "service_requests"),
    "upsert_result": _with(_MERGE, f"""
        select {_ENRICHED},
               case when n % 3 = 0 then 'High' else urgency_label end as urgency_label,
               case when n % 3 = 0 then 0.9::double else urgency_score end as urgency_score,
               llm_reasoning, langfuse_trace_id,
               case when n % 3 = 0 then classified_at + interval 2 hour else classified_at end as classified_at,
               days_to_close,
               case when n % 4 <> 0 then _inserted_at else timestamp '2024-06-01' end as _inserted_at
        from numbered where n % 4 <> 0 or n % 3 = 0"""),
    "unclassified_sample": _requests(f"""
        select {_ENRICHED.replace("service_code", "coalesce(service_code, '') as service_code")}
        from service_requests where urgency_label = 'Unknown'
        order by md5(service_request_id || '7'), service_request_id limit 100""", "service_requests"),
    "unclassified_oldest": _requests(f"""
        select {_ENRICHED.replace("service_code", "coalesce(service_code, '') as service_code")}
        from service_requests where urgency_label = 'Unknown'
        order by requested_datetime nulls last, service_request_id limit 100""", "service_requests"),
    "classified": _requests(f"""
        select {_ENRICHED}, urgency_label, urgency_score, llm_reasoning, langfuse_trace_id,
               classified_at, days_to_close
        from service_requests where urgency_label <> 'Unknown'""", "service_requests"),
    "label_sheet": _requests("""
        select row_number() over (order by md5(service_request_id || '20260923'), service_request_id)::int
                   as item, service_request_id, service_name, status, address, '' as human_label, '' as notes
        from service_requests where urgency_label <> 'Unknown' qualify item <= 50""", "service_requests"),
    "json_text": """
        select event_id, props ->> '$.k' as k, props ->> '$.absent' as absent from events""",
    "drift_tally": _with(FEED, f"""
        select feed, kind, key, count(*)::bigint as records from (
            select feed, 'missing' as kind, k as key
            from parsed, (select unnest([{_list(EXPECTED_KEYS)}]) as k)
            where json_type(record) = 'OBJECT' and not list_contains(json_keys(record), k)
            union all
            select feed, 'unexpected', k
            from (select feed, unnest(json_keys(record)) as k from parsed
                  where json_type(record) = 'OBJECT')
            where k not in ({_list(EXPECTED_KEYS + OPTIONAL_KEYS)}))
        group by all"""),
    "reject_reasons": _with(FEED, """
        select feed, reject_reason, count(*)::bigint as records from parsed
        where reject_reason is not null group by all"""),
    "accepted_requests": _with(FEED, """
        select service_request_id, requested_datetime, service_name, service_code, status, address,
               lat, lon, city from parsed where reject_reason is null"""),
    "backfill_window": _with(FEED, """
        select service_request_id, requested_datetime, service_name, service_code, status, address,
               lat, lon, city, 'Unknown' as urgency_label, 0.0::double as urgency_score,
               'Backfilled — LLM classification skipped.' as llm_reasoning,
               '' as langfuse_trace_id, timestamp '2024-02-01' as classified_at,
               null::double as days_to_close
        from parsed where (reject_reason is null or reject_reason = 'missing_id')
          and status = 'closed'
          and requested_datetime between timestamp '2024-01-10' and timestamp '2024-01-20'"""),
    "replay_classify": _with(_MERGE, """
        select service_request_id, urgency_label, urgency_score, classified_at from numbered
        where n % 4 <> 1 and urgency_label <> 'Unknown'"""),
    "replay_dead_letter": _with(_MERGE, """
        select service_request_id, 'ReplayMiss' as error_type,
               'no recorded classification for ' || service_request_id as error_message
        from numbered where n % 4 = 1 or urgency_label is null or urgency_label = 'Unknown'"""),
    "function_classify": _with(_MERGE, f"""
        select service_request_id, f.error_type, f.error_message,
               case when f.error_type is null then [{_list(TIERS)}][n % {len(TIERS)} + 1] end as urgency_label,
               case when f.error_type is null then (n % 100) / 100.0::double end as urgency_score,
               case when f.error_type is null then timestamp '2024-03-01' end as classified_at
        from numbered left join (values (true, 'ValueError', 'refused'), (false, 'LabelContract', null)) f(refused, error_type, error_message)
          on case when n % 101 = 0 then f.refused when n % 23 = 0 then not f.refused else false end"""),
    "dlq_rate_alerts": """
        with failures as (select date_trunc('second', ts) as s from events where event_type = 'error'),
        windowed as (select s, count(*) over (order by s range between interval 3600 second preceding
                                              and current row) as n from failures)
        select distinct s as alert_at, n::bigint as messages_in_window from windowed where n > 5""",
    "consumer_lag": """
        select event_type as topic, (user_id % 3)::int as partition,
               coalesce(max(event_id) filter (user_id % 4 <> 0), 0)::bigint as position,
               (max(event_id) + 1)::bigint as high,
               greatest(0, max(event_id) + 1 - coalesce(max(event_id) filter (user_id % 4 <> 0), 0))::bigint as lag
        from events group by 1, 2""",
    "consumer_lag_total": """
        select topic, count(*)::bigint as partitions, sum(lag)::bigint as total_lag from (
            select event_type as topic,
                   greatest(0, max(event_id) + 1 - coalesce(max(event_id) filter (user_id % 4 <> 0), 0)) as lag
            from events group by event_type, user_id % 3) group by 1""",
    "kappa": _with({**PAIRS, **_AGREE}, _AGREEMENT),
    "kappa_two_class": _with({**TWO_CLASS, **_AGREE}, _AGREEMENT),
    "confusion": _with({**PAIRS, **_AGREE}, """
        select t.tier as human,
               (select count(*) from pairs where human = t.tier and model = 'Low')::bigint as low,
               (select count(*) from pairs where human = t.tier and model = 'Medium')::bigint as medium,
               (select count(*) from pairs where human = t.tier and model = 'High')::bigint as high,
               (select count(*) from pairs where human = t.tier and model = 'Critical')::bigint as critical
        from tiers t""", "tiers"),
    "per_tier": _with({**PAIRS, **_AGREE}, """
        select t.tier, count(*) filter (p.human = t.tier)::bigint as human_count,
               count(*) filter (p.model = t.tier)::bigint as model_count,
               count(*) filter (p.human = t.tier and p.model = t.tier)::double
                   / nullif(count(*) filter (p.model = t.tier), 0) as precision,
               count(*) filter (p.human = t.tier and p.model = t.tier)::double
                   / nullif(count(*) filter (p.human = t.tier), 0) as recall
        from tiers t, pairs p group by 1""", "tiers"),
    "disagreements": _with(PAIRS, "select * from pairs where human <> model"),
    "label_vs_category": _with(_CATEGORY_AGREE, "select * from agreed"),
    "label_vs_category_total": _with(_CATEGORY_AGREE, """
        select count(*)::bigint as shared_categories,
               count(*) filter (modal_matches)::bigint as modal_agree,
               sum(matching_requests)::bigint as matching_requests, sum(requests)::bigint as requests,
               sum(matching_requests)::double / sum(requests) as matching_share from agreed"""),
    "dq_unique": _extract("""
        select sr_number, count(*)::bigint as duplicate_count from portal_requests
        group by 1 having count(*) > 1""", "portal_requests"),
    "dq_not_null": _requests("""
        select count(*) filter (service_code is null)::bigint as null_service_code,
               count(*) filter (urgency_label is null)::bigint as null_urgency_label,
               count(*) filter (lon is null)::bigint as null_lon,
               count(*) filter (status is null)::bigint as null_status
        from service_requests""", "service_requests"),
    "dq_accepted_values": _requests(f"""
        select service_request_id, urgency_label from service_requests
        where urgency_label not in ({_list(TIERS)})""", "service_requests"),
    "dq_grain_unique": _requests("""
        select department, month, count(*)::bigint as duplicate_count from compliance
        group by 1, 2 having count(*) > 1""", "compliance"),
    "dq_ratio_range": _requests("""
        select department, service_code, month, sla_pct * 1.5::double as sla_pct from compliance
        where sla_pct * 1.5::double > 1 or sla_pct < 0""", "compliance"),
    "dq_close_time_tripwire": _requests("""
        select count(*)::bigint as closed_rows,
               count(*) filter (updated_datetime is null)::bigint as unparseable_rows,
               count(*) filter (updated_datetime is null)::double / count(*) as unparseable_pct
        from closed having count(*) filter (updated_datetime is null)::double / count(*) > 0.001""", "closed"),
    "dq_partitions_reconcile": _extract("""
        select pull_id, partition_date, expected_count, expected_count_after, landed_count
        from portal_pulls where landed_count <> expected_count or expected_count <> expected_count_after""",
        "portal_pulls"),
    "dq_year_covered": _extract(f"""
        select calendar_date from calendar where fiscal_year = {SETTINGS.fiscal_year}
          and calendar_date not in (select partition_date from portal_pulls where status = 'verified')""",
        "calendar"),
    # The query counts one met request too many in every bucket of month 3 and lacks month 5.
    "dq_denominators": _extract("""
        select 'bucket' as check_name,
               concat_ws(' | ', coalesce(owner_department, 'Unknown'), sr_type, month_start) as detail,
               count(*) as expected, count(*) + 1 as actual
        from cohort where fiscal_month = 3 group by owner_department, sr_type, month_start
        union all
        select 'fy_total', 'all', count(*), count_if(fiscal_month <> 5) from cohort
        having bool_or(fiscal_month = 5)""", "cohort"),
    # The query counts one request too many in month 4 and lacks month 2.
    "dq_running_total": _extract("""
        select case m when 4 then y end as fiscal_year, case m when 4 then m end as fiscal_month,
               case m when 4 then n + 1 end as created_running_total, n as running_total
        from (select y, m, (select count(*) from cohort e where e.fiscal_year = y and e.fiscal_month <= m) as n
              from (select distinct fiscal_year as y, fiscal_month as m from cohort where fiscal_month in (2, 4)))""",
        "cohort"),
    "dq_quarters": _extract("""
        select y.fiscal_year, q.quarters, y.created, q.created as created_from_quarters
        from (select fiscal_year, count(*)::bigint as created from cohort group by 1) y
        left join (select fiscal_year, count(distinct fiscal_quarter)::bigint as quarters,
                          sum(created_requests)::bigint as created
                   from monthly where fiscal_quarter <> 4 group by 1) q using (fiscal_year)
        where q.quarters is distinct from 4 or q.created is distinct from y.created""", "monthly"),
    "dq_latest_version": _with({**_VERSION_CHECK, "newer": """
        select sr_number, last_modified_date from verified semi join stale using (sr_number)
        where last_modified_date is not null
        except all
        select v.sr_number, v.last_modified_date from verified v join stale s using (sr_number)
        where v.last_modified_date <= s.last_modified_date"""}, """
        select 'row_count' as check_name, count(distinct sr_number)::bigint as expected,
               (select count(*) from stale)::bigint as actual
        from verified having expected <> actual
        union all
        select 'newer_version_dropped', 1, 0 from newer"""),
    "dq_backlog_flow": _extract("""
        select w.owner_department, w.week_end, w.open_at_week_end, w.opened_in_week, w.closed_in_week,
               b.open_at_week_end as prev_open
        from backlog w
        left join backlog b on b.owner_department = w.owner_department and b.week_end = w.week_start - 1
        where w.open_at_week_end + w.closed_in_week
              <> w.opened_in_week + coalesce(b.open_at_week_end, 0)""", "backlog"),
    "dq_close_before_create": _extract("""
        select sr_number, sr_type, created_date, closed_date from stg
        where closed_date < created_date""", "stg"),
    "stream_upsert": _with(STREAM, """
        select service_request_id, requested_datetime, service_name, service_code, status, address,
               lat, lon, city, urgency_label, urgency_score, llm_reasoning, langfuse_trace_id,
               classified_at, days_to_close
        from routed where problem is null"""),
    "stream_dead_letter": _with(STREAM, """
        select 'requests' as topic, (n % 3)::int as partition, n as offset, problem as exception_type,
               case when n % 50 = 1 then 'value is not JSON'
                    when n % 50 = 2 then 'service_name is not a string'
                    when service_code is null then 'service_code is not a string'
                    else 'no recorded classification for ' || service_request_id end as exception_message
        from routed where problem is not null"""),
    "stream_dedup": _with(FEED, """
        select distinct service_request_id, requested_datetime, service_name, service_code, status,
               address, lat, lon, city from parsed where reject_reason is null"""),
    "extract_pages": _with(_PAGES, """
        select page, sr_number, sr_type, sr_short_code, owner_department, status, origin, created_date, last_modified_date,
               closed_date, duplicate, legacy_record, nullif(parent_sr_number, '') as parent_sr_number,
               ' Unit "' || ward || '",' || chr(10) || street_address || ', "rear" ' as street_address,
               zip_code, ward, community_area, latitude, longitude
        from paged where kind in (0, 4)"""),
    "extract_page_report": _with(_PAGES, """
        select page, case kind when 3 then null when 2 then count(*) + 1 else count(*) end::bigint as expected_count,
               count(*)::bigint as records, count_if(short)::bigint as corrupt_records,
               min(concat(sr_number, ',', sr_type, ',', sr_short_code, ',', owner_department, ',', status)) filter (short)
                   as first_corrupt,
               case when kind = 3 then 'unplanned' when count_if(short) > 0 then 'corrupt'
                    when kind = 2 then 'count_mismatch' else 'complete' end as status
        from paged group by page, kind
        union all select '1900-01', 3, 0, 0, null, 'count_mismatch'"""),
    "pull_landed": _with(_LANDED, f"""
        select 'p1' as pull_id, case when kind = 4 then {_FIRST} else {_SECOND} end as pulled_at, partition_date,
               sr_number, sr_type, sr_short_code, owner_department,
               case when kind in (0, 5, 6) then 'Repulled' else status end as status, origin, created_date,
               last_modified_date, closed_date, duplicate, legacy_record, parent_sr_number, street_address, zip_code,
               ward, community_area, latitude, longitude, kind <> 3 as verified
        from source where kind not in (1, 2)"""),
    "pull_landed_ledger": _with(_LANDED, f"""
        select 'p1' as pull_id, 'all' as window_label, day as partition_date,
               format('created_date >= ''{{}}T00:00:00'' AND created_date < ''{{}}T00:00:00''', day, day + 1) as where_clause,
               case when kind = 2 and n > 0 then null when kind = 1 then 0 when kind = 3 then n + 1 else n end as expected_count,
               case when kind = 2 and n > 0 then null when kind = 1 then 0 when kind = 3 then n + 1 else n end as expected_count_after,
               case when kind = 2 and n > 0 then null when kind = 1 then 0 else n end as landed_count,
               case when kind = 2 and n > 0 then 'failed' when kind = 3 then 'count_mismatch' else 'verified' end as status,
               case when kind = 4 then {_FIRST} else {_SECOND} end as started_at,
               timestamp '{landings.DONE}' as finished_at
        from planned"""),
    "stream_replayed": _with({**STREAM, "settled": """
        select *, problem is null and n % 3 <> 0 as first, problem is null and n % 3 = 0 as second,
               n % 5 = 0 as pending, n % 7 = 0 as late
        from routed"""}, f"""
        select service_request_id, requested_datetime, service_name, service_code, status, address, lat, lon, city,
               case when late then 'Critical' when pending and not second then 'Low' else urgency_label end as urgency_label,
               case when late then 0.75 when pending and not second then 0.5 else urgency_score end::double as urgency_score,
               llm_reasoning, langfuse_trace_id, classified_at, days_to_close,
               case when first then null when pending then {streams.PENDING_AT.year} when second then null
                    else {streams.LATE_AT.year} end::int as inserted_year
        from settled where first or second or pending or late"""),
    "stream_write_errors": _with(STREAM, """
        select 'one' as table_refuses, false as stopped, count(*) filter (problem is null) - 1 as written,
               count(*) filter (problem is not null) + 1 as dead_letters,
               max(n) filter (problem is null) as refused_offset
        from routed
        union all select 'all', true, 0, 0, null"""),
    "stream_progress": _with(STREAM, """
        select n % 4 as batch_id, count(*) filter (problem is null) as processed,
               count(*) filter (problem is not null) as failed
        from routed group by 1"""),
    "stream_dedup_batches": _with(FEED, """
        select distinct service_request_id, requested_datetime, service_name, service_code, status,
               address, lat, lon, city from parsed where reject_reason is null"""),
    "stream_rate_alerts": """
        with errors as (select user_id % 3 as partition, date_trunc('second', ts) as s from events where event_type = 'error'),
        seconds as (select distinct partition, s from errors),
        counted as (select a.partition, a.s, count(*) as n from seconds a join errors b
                    on b.partition = a.partition and b.s between a.s - interval 3600 second and a.s group by 1, 2)
        select 'requests' as topic, partition::int as partition, s::timestamp as alert_at, n as messages_in_window
        from counted where n > 2""",
    "build_report": build_oracle.report(_requests, _build_extract),
    "build_report_failed": build_oracle.failed_report(_requests, _build_extract, RAISING, FAILING, RAISING_CHECK),
}
