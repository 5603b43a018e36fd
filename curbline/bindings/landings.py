"""An extract pull that is run twice, over the driver's orders, with days that empty, fail and don't reconcile."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbline import schemas
from curbline.bindings import inputs
from curbline.plans import extract
from curbline.session import materialise, shared_dir
from curbline.sinks import pulls
from curbline.sources import calendar, files

FIRST, SECOND, DONE = (datetime(2001, 12, d, 6) for d in (1, 2, 3))


def _landed_twice(spark: SparkSession, sf_dir: str) -> str:
    """Pull all days; then pull them again under the same id. By the number of the day modulo 7, the second run finds
    it empty (1), with every request twice (2), or with another count than the source gives (3), doesn't plan it (4),
    or finds its requests repulled (0, 5, 6)."""
    source = materialise(
        inputs.portal_requests(spark, sf_dir).filter(F.col("pull_id") == "a-base").select("partition_date", *schemas.EXTRACT_TYPES),
        "extract")
    span = source.agg(F.min("partition_date").alias("lo"), F.max("partition_date").alias("hi")).head()
    plan = calendar.partition_plan(spark, start=span["lo"], end=span["hi"], label="all")
    kind = F.pmod(F.datediff("partition_date", F.lit("1995-01-01").cast("date")), F.lit(7))
    counts = plan.join(source.groupBy("partition_date").agg(F.count(F.lit(1)).alias("n")), "partition_date", "left")
    n = F.coalesce("n", F.lit(0).cast("long"))

    def manifest(expected) -> DataFrame:
        return counts.select("partition_date", expected.alias("expected_count"), expected.alias("expected_count_after"))

    target = f"{shared_dir(spark)}/landed-{uuid.uuid4().hex}"
    pulls.portal_pull(spark, source, plan, manifest(n), target, "p1", FIRST, DONE)
    copies = F.when(kind == 1, F.lit(0)).when(kind == 2, F.lit(2)).otherwise(F.lit(1))
    again = source.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), copies))).drop("_copy").withColumn(
        "status", F.when(kind.isin(0, 5, 6), "Repulled").otherwise(F.col("status")))
    expected = F.when(kind == 1, F.lit(0).cast("long")).when(kind == 3, n + 1).otherwise(n)
    try:
        pulls.portal_pull(spark, again, plan.filter(kind != 4), manifest(expected), target, "p1", SECOND, DONE)
    except (pulls.DuplicateKey, pulls.CountMismatch):
        pass  # the record that both leave is the result
    return target


def landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every landed version, and whether readers take it."""
    target = _landed_twice(inputs.prepare(spark), sf_dir)
    return extract.marked_versions(pulls.landed_requests(spark, target), pulls.landed_ledger(spark, target))


def landed_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pulls.landed_ledger(spark, _landed_twice(inputs.prepare(spark), sf_dir))


def _pages(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The extract landed as a page a month, with quotes and line ends in the addresses, and read back; and its report.
    By the number of the month modulo 5, half of a page's records are cut short (1), the manifest expects one more (2) or
    doesn't know the page (3). A page that never landed is expected too."""
    inputs.prepare(spark)
    root = f"{shared_dir(spark)}/pages-{uuid.uuid4().hex}"
    kind = F.pmod(F.year("created_date") * 12 + F.month("created_date"), F.lit(5))
    source = inputs.portal_requests(spark, sf_dir).filter(F.col("pull_id") == "a-base").select(
        *schemas.EXTRACT_TYPES, F.date_format("created_date", "yyyy-MM").alias("page"), kind.alias("kind")).withColumn(
        "street_address", F.concat(F.lit(' Unit "'), "ward", F.lit('",\n'), "street_address", F.lit(', "rear" ')))
    short = (F.col("kind") == 1) & (F.substring("sr_number", 3, 8).cast("long") % 2 == 0)
    pulls.write_pages(source.filter(~short), root)
    pulls.write_pages(source.filter(short), root, list(schemas.EXTRACT_TYPES)[:5])
    manifest = source.filter("kind <> 3").groupBy("page", "kind").agg(F.count(F.lit(1)).alias("n")).select(
        "page", F.when(F.col("kind") == 2, F.col("n") + 1).otherwise(F.col("n")).alias("expected_count")).unionByName(
        spark.range(1).select(F.lit("1900-01").alias("page"), F.lit(3).cast("long").alias("expected_count")))
    records = files.extract_pages(spark, root)
    return records, materialise(files.reconcile_pages(records, manifest), "page-report")


def pages_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.complete_pages(*_pages(spark, sf_dir))


def page_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pages(spark, sf_dir)[1]
