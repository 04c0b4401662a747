"""Sinks: the published marts, the KPI and quality JSON files, and the warehouse load."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from storelens.plans import marts, quality, views
from storelens.session import write_once
from storelens.sources.schemas import TABLES
from storelens.sources.star import Star, TableStar, require_unique

# Names of the published marts.
MARTS: dict[str, Callable[[Star], DataFrame]] = {
    "order_economics": views.order_economics_mart,
    "store_kpis": marts.store_kpis,
    "customer_rfm": marts.rfm_customers,
    "retention_by_service": marts.retention_by_service,
    "cohort_retention": marts.cohort_matrix,
    "experiment_summary": marts.experiment_summary,
    "product_kpis": marts.product_kpis,
    "daily_store_kpis": marts.daily_store,
    "demand_forecast": marts.demand_forecast,
    "channel_cac": marts.channel_cac,
    "inventory_product_kpis": marts.inventory_product_kpis,
    "inventory_store_kpis": marts.inventory_store_kpis,
}
# Marts with a date column, written in date folders on request so that readers skip other days.
DATED = {"order_economics": "order_date", "daily_store_kpis": "order_date"}
# Two facts join on the order id in almost every plan; hashed alike on disk, they join in place.
BUCKETED = {"fact_orders": "order_id", "fact_order_items": "order_id"}


class PricedStar(Star):
    """A star whose priced orders were written once, for a run that reads them many times."""

    def __init__(self, inner: Star):
        super().__init__(inner.spark)
        self.inner = inner
        # The merge of orders with their totals must be one to one; here that is looked at before anything is priced.
        require_unique(inner.orders.select("order_id"), ["order_id"], "fact_orders")
        self.priced = write_once(inner.orders_with_totals, "priced-orders")

    def open(self, name: str) -> DataFrame:
        if name == "fact_orders":
            return self.priced.drop("units", "item_revenue", "cogs")
        return self.inner.table(name)

    @property
    def orders_with_totals(self) -> DataFrame:
        return self.priced

    def narrowed_orders_with_totals(self, narrow) -> DataFrame:
        return narrow(self.priced)


def _write(df: DataFrame, path: str, form: str, date: str | None = None) -> None:
    writer = df.write.mode("overwrite").format(form).option("header", "true")
    (writer.partitionBy(date) if date else writer).save(path)


def _read(spark: SparkSession, path: str, form: str) -> DataFrame:
    return spark.read.csv(path, header=True) if form == "csv" else spark.read.format(form).load(path)


def publish_marts(star: Star, folder: str, form: str = "parquet", by_date: bool = False) -> DataFrame:
    """Write the twelve marts, read each back, and fail when a count differs.

    Counts are taken by the writing job itself, so no mart is computed twice. Returns mart,
    rows_written, rows_read.
    """
    spark, priced, done = star.spark, star if isinstance(star, PricedStar) else PricedStar(star), []
    for name, build in MARTS.items():
        path = f"{folder.rstrip('/')}/{name}"
        frame, date = build(priced), DATED.get(name) if by_date else None
        if date:
            # A day fills few files, a heavy day several. Counting stands behind this exchange, in the
            # writing stage itself, so a map stage that runs again counts nothing twice.
            frame = frame.hint("rebalance", F.col(date))
        watch = Observation(f"rows of {name}")
        _write(frame.observe(watch, F.count(F.lit(1)).alias("n")), path, form, date)
        written, read = watch.get["n"], _read(spark, path, form).count()
        if written != read:
            raise RuntimeError(f"{name}: wrote {written} rows, found {read}")
        done.append((name, written, read))
    return spark.createDataFrame(done, "mart string, rows_written bigint, rows_read bigint")


def write_executive_kpis(star: Star, path: str) -> None:
    """The 15 headline figures as one JSON object in a part file."""
    marts.executive_kpis(star).write.mode("overwrite").json(path)


def write_quality_report(report: DataFrame, path: str) -> None:
    """Checks as JSON lines under ``checks`` and their summary under ``summary``."""
    held = write_once(report, "quality-report")
    held.orderBy("position").coalesce(1).write.mode("overwrite").json(f"{path}/checks")
    quality.quality_summary(held).write.mode("overwrite").json(f"{path}/summary")


MANIFEST = "load_manifest"
_MANIFEST_SCHEMA = "batch string, table_name string, rows bigint"


def _staged(spark: SparkSession, df: DataFrame, target: str, buckets: int | None, key: str | None) -> int:
    """Write ``df`` as table ``target`` and give its row count, which the writing job and the table agree on."""
    spark.sql(f"drop table if exists {target}")
    watch = Observation(f"rows of {target}")
    writer = df.observe(watch, F.count(F.lit(1)).alias("n")).write.mode("errorifexists").format("parquet")
    if buckets and key:
        writer = writer.bucketBy(buckets, key).sortBy(key)
    writer.saveAsTable(target)
    written, found = watch.get["n"], spark.table(target).count()
    if written != found:
        raise RuntimeError(f"row count differs for {target}: written {written}, found {found}")
    return found


def load_tables(star: Star, database: str, buckets: int | None = None, tables: list[str] | None = None,
                mode: str = "replace", batch: str | None = None) -> dict[str, int]:
    """Load the star's tables into a warehouse database and reconcile the row counts.

    Every table is first written under a staging name and counted. Only when all of them agree are they
    swapped in, by renaming, so a fault in any table leaves the old data in place. ``replace`` puts the new
    rows in the place of the old ones; ``append`` stages old and new rows together. The counts go into the
    table ``load_manifest`` under the name of the ``batch``; a batch that the manifest lists is not loaded
    again, its counts are returned, so running it twice adds nothing.

    With ``buckets`` the order and line tables are bucketed and sorted by order id, and their join
    moves no data. One task then reads each bucket, so leave it out where a single order may hold a
    large share of all lines: a shuffled join can split such a key, a bucket cannot be split.
    """
    if mode not in ("replace", "append"):
        raise ValueError(f"unknown mode {mode!r}")
    spark, names = star.spark, tables or list(TABLES)
    spark.sql(f"create database if not exists `{database}`")
    exists = lambda name: spark.catalog.tableExists(f"{database}.{name}")
    listed = spark.table(f"`{database}`.{MANIFEST}") if exists(MANIFEST) else spark.createDataFrame([], _MANIFEST_SCHEMA)
    if batch is not None:
        known = {r["table_name"]: r["rows"] for r in listed.where(F.col("batch") == batch).collect()}
        if set(names) <= set(known):
            return {name: known[name] for name in names}
    counts, added = {}, {}
    for name in names:
        fresh = star.table(name)
        old = spark.table(f"`{database}`.`{name}`") if mode == "append" and exists(name) else None
        before = old.count() if old is not None else 0
        rows = fresh if old is None else old.unionByName(fresh)
        counts[name] = _staged(spark, rows, f"`{database}`.`{name}__staged`", buckets, BUCKETED.get(name))
        added[name] = counts[name] - before
    entries = spark.createDataFrame([(batch, name, n) for name, n in added.items()], _MANIFEST_SCHEMA)
    _staged(spark, listed.unionByName(entries), f"`{database}`.`{MANIFEST}__staged`", None, None)
    for name in [*names, MANIFEST]:
        # Renames alone: the old table steps aside and goes when the new one has its name.
        spark.sql(f"drop table if exists `{database}`.`{name}__old`")
        if exists(name):
            spark.sql(f"alter table `{database}`.`{name}` rename to `{database}`.`{name}__old`")
        spark.sql(f"alter table `{database}`.`{name}__staged` rename to `{database}`.`{name}`")
        spark.sql(f"drop table if exists `{database}`.`{name}__old`")
    return added


def warehouse_star(spark: SparkSession, database: str) -> Star:
    """Star over the tables that ``load_tables`` wrote."""
    return TableStar(spark, {name: spark.table(f"`{database}`.`{name}`") for name in TABLES})
