"""Raw inputs derived from the driver's tables. Every row of a table is used."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbline.config import Settings
from curbline.session import materialise, prepare, spread
from curbline.sources.calendar import fiscal_calendar

SETTINGS = Settings(
    fiscal_year=2001,
    sla_thresholds={"Critical": 720, "High": 2160, "Medium": 4320, "Low": 8760},
)
REQUEST_SETTINGS = Settings()
REPULL_FROM = "2001-06-01"
OUT_OF_SCOPE_PRIORITY = "4-NOT SPECIFIED"

# One enriched request per event. Some rows lack a close time, a label, a department or a code.
REQUESTS_SQL = """
select
    'R' || cast(event_id as string) as service_request_id,
    ts as requested_datetime,
    event_type as service_name,
    case when event_id % 401 = 0 then null
         else event_type || '-' || cast(user_id % 10 as string) end as service_code,
    case when event_id % 5 = 0 then 'open' else 'closed' end as status,
    cast(user_id as string) || ' Main St' as address,
    cast(4100 + user_id % 100 as double) / cast(100 as double) as lat,
    case when event_id % 13 = 0 then null
         else cast(-8700 - user_id % 100 as double) / cast(100 as double) end as lon,
    'chicago' as city,
    '{"service_request_id":"R' || cast(event_id as string) || '"'
        || case when event_id % 211 = 0 then ''
                when event_id % 223 = 0 then ',"updated_datetime":"yesterday"'
                else ',"updated_datetime":"' || replace(cast(date_trunc('second',
                    ts + cast(round(value * 3600) as bigint) * interval '1' second) as string), ' ', 'T')
                    || 'Z"' end
        || case when user_id % 9 = 0 then ''
                else ',"group":"D' || cast(user_id % 7 as string) || '"' end
        || '}' as raw_payload,
    case when event_id % 97 = 0 then null
         when event_type = 'error' then case when event_id % 10 = 3 then 'High' else 'Critical' end
         when event_type = 'purchase' then case when event_id % 10 = 3 then 'Medium' else 'High' end
         when event_type = 'signup' then case when event_id % 10 = 3 then 'Low' else 'Medium' end
         when event_type = 'click' then case when event_id % 10 = 3 then 'Medium' else 'Low' end
         else 'Unknown' end as urgency_label,
    cast((event_id % 46 + 55) as double) / cast(100 as double) as urgency_score,
    'because ' || event_type as llm_reasoning,
    'trace-' || cast(event_id as string) as langfuse_trace_id,
    ts + 60 * interval '1' second as classified_at,
    cast(null as double) as days_to_close,
    ts + 5 * interval '1' second as _inserted_at
from events
"""

# One service request per order; its last shipment closes it. A close may precede its creation.
ORDER_REQUESTS_SQL = """
select
    o.o_orderkey as k,
    o.o_orderdate as opened_on,
    'SR' || lpad(cast(o.o_orderkey as string), 8, '0') as sr_number,
    o.o_orderpriority || '/' || cast(o.o_custkey % 5 as string) as sr_type,
    substr(o.o_orderpriority, 1, 1) || cast(o.o_custkey % 5 as string) as sr_short_code,
    case when o.o_custkey % 50 = 0 then null
         else 'Dept ' || cast(o.o_custkey % 7 as string) end as owner_department,
    case when o.o_orderstatus = 'F' then 'Completed'
         when o.o_orderstatus = 'O' then 'Open'
         when o.o_orderkey % 7 = 0 then 'Canceled'
         else 'Completed' end as status,
    'web' as origin,
    o.o_orderdate + (o.o_orderkey * 37 % 86400) * interval '1' second as created_date,
    case when o.o_orderstatus = 'O' then null
         else s.shipped + (o.o_orderkey * 101 % 86400) * interval '1' second end as closed_date,
    case when o.o_orderkey % 31 = 0 then null else o.o_orderkey % 29 = 0 end as duplicate,
    o.o_orderkey % 11 = 0 as legacy_record,
    case when o.o_orderkey % 29 = 0 and o.o_orderkey % 4 = 0
             then 'SR' || lpad(cast(cast(floor(o.o_orderkey / 2) as bigint) as string), 8, '0')
         when o.o_orderkey % 29 = 0 then 'SRX' || cast(o.o_orderkey % 500 as string)
         when o.o_orderkey % 2 = 0 then '' else null end as parent_sr_number,
    cast(o.o_custkey as string) || ' State St' as street_address,
    cast(60600 + o.o_custkey % 60 as string) as zip_code,
    cast(o.o_orderkey % 50 + 1 as int) as ward,
    cast(o.o_orderkey % 77 + 1 as int) as community_area,
    cast(41.5 as double) as latitude,
    cast(-87.5 as double) as longitude
from orders o
left join shipments s on s.l_orderkey = o.o_orderkey
"""

# Two pulls of those requests. The second one re-reads recent days: a third changed since (and
# closed if it was open), a third is the same, and a third is an older, stale copy.
VERSIONS_SQL = """
select
    pull_id,
    case when pull_id = 'a-base' then timestamp_ntz '2001-11-10 06:00:00'
         else timestamp_ntz '2001-11-20 06:00:00' end as pulled_at,
    cast(opened_on as date) as partition_date,
    sr_number, sr_type, sr_short_code, owner_department,
    case when changed and status = 'Open' then 'Completed' else status end as status,
    origin, created_date,
    case when k % 83 = 0 then null
         when changed then touched + 1 * interval '1' day
         when pull_id = 'b-repull' and k % 3 = 2 then touched - 1 * interval '1' day
         else touched end as last_modified_date,
    case when changed and status = 'Open' then touched + 1 * interval '1' day
         else closed_date end as closed_date,
    duplicate, legacy_record, parent_sr_number, street_address, zip_code, ward, community_area,
    latitude, longitude
from (
    select *, coalesce(closed_date, created_date) as touched,
           pull_id = 'b-repull' and k % 3 = 0 as changed
    from pulled
) p
"""

# The pull ledger counts orders per day; every 37th day of the first pull does not reconcile.
LEDGER_SQL = """
select
    pull_id,
    case when pull_id = 'a-base' then 'all' else 'recent' end as window_label,
    day as partition_date,
    'created_date >= ''' || cast(day as string) || 'T00:00:00''' as where_clause,
    n + case when off then 1 else 0 end as expected_count,
    n as expected_count_after,
    n as landed_count,
    case when off then 'count_mismatch' else 'verified' end as status,
    timestamp_ntz '2001-11-10 06:00:00' as started_at,
    timestamp_ntz '2001-11-10 07:00:00' as finished_at
from (
    select pull_id, day, n,
           pull_id = 'a-base' and datediff(day, date '1995-01-01') % 37 = 0 as off
    from counted
) c
"""

TYPES_SQL = """
select
    p || '/' || cast(c as string) as sr_type,
    substr(p, 1, 1) || cast(c as string) as sr_short_code,
    p <> '4-NOT SPECIFIED' as in_sla_scope,
    case when p = '4-NOT SPECIFIED' then 'no tier given' else '' end as scope_note,
    case when p = '1-URGENT' then 'Critical' when p = '2-HIGH' then 'High'
         when p = '3-MEDIUM' then 'Medium' when p = '5-LOW' then 'Low' else null end as urgency_label,
    case when p = '4-NOT SPECIFIED' then null else cast(0.85 as double) end as urgency_score,
    case when p = '4-NOT SPECIFIED' then null else 'tier of ' || p end as llm_reasoning,
    'v1' as prompt_version,
    '2001-11-10T00:00:00Z' as classified_at
from (select distinct o_orderpriority as p, o_custkey % 5 as c from orders) t
where not (p = '3-MEDIUM' and c = 3)
"""

LOOKUP_SQL = """
select
    'SRX' || cast(v as string) as sr_number,
    v % 3 = 0 as found,
    case when v % 3 = 0 then 'external' else null end as sr_type,
    case when v % 3 = 0 then timestamp_ntz '1994-06-01 08:00:00' + v * interval '1' day
         else null end as created_date,
    timestamp_ntz '2001-11-21 00:00:00' as looked_up_at
from (select distinct o_orderkey % 500 as v from orders where o_orderkey % 29 = 0) t
where v % 5 <> 4
"""

# One response page per event, most of them well formed, the rest each with one fault.
PAGES_SQL = """
select
    event_type as feed,
    'page-' || cast(event_id as string) as page,
    case when m = 1 then '{"requests":[' || record || ']}'
         when m = 2 then '["not-a-record",' || record || ']'
         when m = 16 then '[{"service_request_id":'
         else '[' || record || ']' end as value
from (
    select event_type, event_id, event_id % 20 as m,
        '{"service_request_id":' || case when event_id % 20 = 9 then '"  "'
                                         when event_id % 20 = 18 then cast(event_id as string)
                                         else '"E' || cast(event_id as string) || '"' end
        || case when event_id % 20 = 12 then '' else ',"status":"closed"' end
        || ',"service_name":' || case when event_id % 20 = 13 then 'null' else '"' || event_type || '"' end
        || ',"service_code":' || case when event_id % 20 = 17 then cast(user_id as string)
                                      else '"c' || cast(user_id % 10 as string) || '"' end
        || case when event_id % 20 = 5 then ''
                when event_id % 20 = 6 then ',"requested_datetime":"09/18/2026 01:51 PM"'
                when event_id % 20 = 7 then ',"requested_datetime":"yesterday"'
                else ',"requested_datetime":"'
                     || replace(cast(date_trunc('second', ts) as string), ' ', 'T')
                     || case when event_id % 20 = 15 then '-05:00"' else 'Z"' end end
        || ',"updated_datetime":"2026-02-11T04:30:00Z","address":"1 Main St"'
        || ',"lat":' || case when event_id % 20 = 8 then '"north-ish"'
                             when event_id % 20 = 14 then '""' else '41.5' end
        || case when event_id % 20 = 3 then ',"lng":-87.5'
                when event_id % 20 = 11 then ',"long":null,"lon":-87.25'
                else ',"long":"-87.5"' end
        || ',"token":"t"'
        || case when event_id % 20 = 4 then ',"priority":"HIGH"'
                when event_id % 20 = 10 then ',"media_url":"https://files.test/1.png"' else '' end
        || '}' as record
    from events
) r
"""

# Human and model tiers per rated event.
PAIRS_SQL = """
select
    event_id as item,
    'R' || cast(event_id as string) as service_request_id,
    event_type as service_name,
    case h when 0 then 'Low' when 1 then 'Medium' when 2 then 'High' else 'Critical' end as human,
    case case when event_id % 5 = 0 and h < 3 then h + 1
              when event_id % 7 = 0 and h > 0 then h - 1
              when event_id % 41 = 0 then 3 - h else h end
        when 0 then 'Low' when 1 then 'Medium' when 2 then 'High' else 'Critical' end as model
from (
    select event_id, event_type,
           case event_type when 'error' then 3 when 'purchase' then 2 when 'signup' then 1 else 0 end as h
    from events where event_type <> 'view'
) e
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _project(spark: SparkSession, sql: str, **views: DataFrame) -> DataFrame:
    """Run a projection over the named DataFrames."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return spark.sql(sql)


def service_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return _project(spark, REQUESTS_SQL, events=spread(table(spark, sf_dir, "events"), "event_id"))


def portal_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    shipments = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.max("l_shipdate").alias("shipped"))
    one = _project(
        spark, ORDER_REQUESTS_SQL, orders=table(spark, sf_dir, "orders"), shipments=shipments)
    recent = F.col("opened_on") >= F.lit(datetime.fromisoformat(REPULL_FROM))
    pulls = F.when(recent, F.array(F.lit("a-base"), F.lit("b-repull"))).otherwise(
        F.array(F.lit("a-base")))
    return _project(spark, VERSIONS_SQL, pulled=one.withColumn("pull_id", F.explode(pulls)))


def portal_pulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    per_day = table(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(
        F.count(F.lit(1)).alias("n"))
    recent = F.col("day") >= F.lit(REPULL_FROM).cast("date")
    pulls = F.when(recent, F.array(F.lit("a-base"), F.lit("b-repull"))).otherwise(
        F.array(F.lit("a-base")))
    counted = per_day.withColumn("pull_id", F.explode(pulls))
    return materialise(_project(spark, LEDGER_SQL, counted=counted), "portal-pulls")


def sr_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return materialise(
        _project(spark, TYPES_SQL, orders=table(spark, sf_dir, "orders")), "sr-types")


def parent_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return materialise(
        _project(spark, LOOKUP_SQL, orders=table(spark, sf_dir, "orders")), "parent-lookup")


def calendar(spark: SparkSession, settings: Settings = SETTINGS) -> DataFrame:
    return fiscal_calendar(spark, settings.fiscal_year - 1, settings.fiscal_year + 1)


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return _project(spark, PAGES_SQL, events=spread(table(spark, sf_dir, "events"), "event_id"))


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return _project(spark, PAIRS_SQL, events=table(spark, sf_dir, "events"))
