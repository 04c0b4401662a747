import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import DATA
from storelens.batch import QualityFailed, run_batch
from storelens.plans import business, marts, quality, views
from storelens.session import shared_folder, write_once
from storelens.sources import MappedStar, TableStar, publish, read_csv_bundle, read_csv_star, read_parquet_star
from storelens.sources.schemas import TABLES, table_schema
from storelens.sources.star import RepeatedKey


@pytest.fixture(scope="module")
def star(spark):
    return MappedStar(spark, f"{DATA}/sf0.001")


@pytest.fixture(scope="module")
def bundle(star, tmp_path_factory):
    """The star as CSV files, booleans spelled the way pandas writes them."""
    folder = tmp_path_factory.mktemp("bundle")
    for name in TABLES:
        frame = star.table(name).toPandas()
        if name == "fact_sessions":
            frame["order_id"] = frame["order_id"].astype("Int64")
        frame.to_csv(folder / f"{name}.csv", index=False)
    return folder


def test_csv_star_equals_its_source(spark, star, bundle):
    csv = read_csv_star(spark, str(bundle))
    assert csv.orders.schema["order_ts"].dataType == table_schema("fact_orders")["order_ts"].dataType
    assert csv.orders.schema["order_id"].dataType.simpleString() == "string"
    assert csv.customers.where("is_prime").count() == star.customers.where("is_prime").count()
    assert business.q01_exec_snapshot(csv).first() == business.q01_exec_snapshot(star).first()
    assert business.q04_category_profit(csv).collect() == business.q04_category_profit(star).collect()
    assert business.q06_service_repeat(csv).collect() == business.q06_service_repeat(star).collect()


def test_csv_with_columns_in_another_order(spark, bundle, tmp_path):
    text = (bundle / "dim_stores.csv").read_text().splitlines()
    flipped = "\n".join(",".join(reversed(line.split(","))) for line in text)
    (tmp_path / "dim_stores.csv").write_text(flipped)
    row = read_csv_star(spark, str(tmp_path)).stores.orderBy("store_id").first()
    assert row["zone"] == "Supplier#000000000" and row["capacity_orders_per_hour"] == 45


def test_csv_times_and_booleans(spark, tmp_path):
    head = "order_id,order_ts,delivery_ts,is_first_order"
    rows = ["a,2025-01-01 10:00:00,2025-01-01 10:20:22.200000,True", "b,2025-01-01 10:00:00,2025-01-01 10:20:22.200000123,false",
            "c,2025-01-01 10:00:00,,true"]
    (tmp_path / "fact_orders.csv").write_text("\n".join([head, *rows]) + "\n")
    got = read_csv_star(spark, str(tmp_path)).orders.orderBy("order_id").collect()
    assert [r["is_first_order"] for r in got] == [True, False, True]
    assert [r["delivery_ts"] and r["delivery_ts"].microsecond for r in got] == [200000, 200000, None]


def test_csv_that_does_not_fit_its_schema_fails(spark, tmp_path):
    (tmp_path / "dim_stores.csv").write_text("store_id,capacity_orders_per_hour\ns1,many\n")
    with pytest.raises(Exception):
        read_csv_star(spark, str(tmp_path)).stores.collect()


def test_quality_report_over_csv_bundle(spark, bundle, tmp_path):
    report = quality.quality_report(read_csv_star(spark, str(bundle)), expected_months=80, expected_orders=1500)
    failed = {r["check"] for r in report.where("not passed").collect()}
    assert failed == {"GMV reconciles to items", "balanced experiment assignment", "embedded experiment lift"}
    publish.write_quality_report(report, str(tmp_path / "report"))
    assert spark.read.json(str(tmp_path / "report" / "checks")).count() == 38
    assert spark.read.json(str(tmp_path / "report" / "summary")).first()["failed"] == 3


def test_missing_csv_is_reported(spark, bundle, tmp_path):
    for name in TABLES:
        if name != "dim_products":
            os.symlink(bundle / f"{name}.csv", tmp_path / f"{name}.csv")
    report = quality.quality_report(read_csv_star(spark, str(tmp_path)))
    assert [r["check"] for r in report.where("not passed").collect()] == ["dim_products: exists"]


@pytest.mark.parametrize("form", ["parquet", "csv"])
def test_publish_marts(spark, star, tmp_path, form):
    counts = {r["mart"]: r["rows_read"] for r in publish.publish_marts(star, str(tmp_path), form).collect()}
    assert set(counts) == set(publish.MARTS)
    assert counts["order_economics"] == 1473 and counts["demand_forecast"] == 28


def test_publish_by_date(spark, star, tmp_path, monkeypatch):
    wanted = {n: publish.MARTS[n] for n in ("order_economics", "store_kpis")}
    monkeypatch.setattr(publish, "MARTS", wanted)
    publish.publish_marts(star, str(tmp_path), by_date=True)
    day = views.economics(star).selectExpr("min(to_date(order_ts)) as day").first()["day"]
    back = spark.read.parquet(str(tmp_path / "order_economics")).where(f"order_date = date'{day}'")
    assert "PartitionFilters: [isnotnull(order_date" in back._jdf.queryExecution().executedPlan().toString()
    assert back.count() == views.economics(star).where(f"to_date(order_ts) = date'{day}'").count() > 0


def test_kpi_json(star, tmp_path):
    publish.write_executive_kpis(star, str(tmp_path / "kpis"))
    part = next(p for p in (tmp_path / "kpis").iterdir() if p.name.startswith("part"))
    kpis = json.loads(part.read_text())
    assert kpis["orders"] == 1500 and len(kpis) == 15


def test_warehouse_load_is_bucketed_and_reconciled(spark, star):
    counts = publish.load_tables(star, "shop", buckets=8)
    assert counts["fact_orders"] == 1500 and counts["fact_order_items"] == 6000
    loaded = publish.warehouse_star(spark, "shop")
    assert business.q01_exec_snapshot(loaded).first() == business.q01_exec_snapshot(star).first()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = views.economics(loaded).select("order_id", "contribution_margin")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
    assert "Exchange" not in plan
    again = publish.load_tables(star, "shop", buckets=8, tables=["dim_stores"])
    assert again["dim_stores"] == 10 and spark.table("shop.dim_stores").count() == 10
    more = publish.load_tables(star, "shop", tables=["dim_stores"], mode="append")
    assert more["dim_stores"] == 10 and spark.table("shop.dim_stores").count() == 20
    spark.sql("drop database shop cascade")


def test_a_batch_is_loaded_once(spark, star):
    first = publish.load_tables(star, "once", batch="b1")
    again = publish.load_tables(star, "once", mode="append", batch="b1")
    assert again == first and set(first) == set(TABLES) and spark.table("once.fact_orders").count() == 1500
    publish.load_tables(star, "once", mode="append", batch="b2", tables=["dim_stores"])
    listed = {(r["batch"], r["table_name"]): r["rows"] for r in spark.table("once.load_manifest").collect()}
    assert listed["b1", "fact_order_items"] == 6000 and listed["b2", "dim_stores"] == 10 and len(listed) == 9
    assert spark.table("once.dim_stores").count() == 20
    spark.sql("drop database once cascade")


def test_a_fault_in_one_table_leaves_the_old_data(spark, star):
    publish.load_tables(star, "fault", tables=["dim_stores", "dim_products"])
    broken = {name: star.table(name).limit(3) for name in TABLES}
    broken["dim_products"] = star.products.withColumn("unit_cost", F.raise_error(F.lit("no such file")).cast("decimal(10,2)"))
    with pytest.raises(Exception, match="no such file"):
        publish.load_tables(TableStar(spark, broken), "fault")
    assert spark.table("fault.dim_stores").count() == 10 and spark.table("fault.dim_products").count() == star.products.count()
    assert not spark.catalog.tableExists("fault.fact_orders")
    counts = publish.load_tables(star, "fault")
    assert counts["fact_orders"] == 1500 and len([t for t in spark.catalog.listTables("fault") if "__" in t.name]) == 0
    spark.sql("drop database fault cascade")


@pytest.mark.parametrize("build", [views.order_economics, business.q01_exec_snapshot, views.daily_store_kpis, marts.executive_kpis])
def test_a_repeated_order_stops_every_plan_that_prices_orders(make_star, build):
    star = make_star(orders=[dict(order_id="a"), dict(order_id="a"), dict(order_id="b")])
    with pytest.raises(Exception, match="fact_orders is not unique on order_id: a"):
        build(star).collect()


def test_the_assertion_moves_nothing_again(spark, make_star):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        star = make_star(orders=[dict(order_id="a"), dict(order_id="b")])
        text = views.order_economics(star)._jdf.queryExecution().executedPlan().toString()
        assert text.count("Exchange") == 2 and text.count("Window") >= 1
        free = star.orders_with_totals.select("order_id", "status")._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in free and "Window" not in free
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_parquet_star(spark, star, tmp_path):
    for name in TABLES:
        star.table(name).write.parquet(str(tmp_path / name))
    assert business.q02_city_value(read_parquet_star(spark, str(tmp_path))).collect() == business.q02_city_value(star).collect()


def test_shared_folder_is_the_named_one(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    df = write_once(spark.range(5).withColumn("d", F.lit(1).cast("decimal(18,2)")), "probe")
    assert df.count() == 5 and shared_folder(spark) in df.inputFiles()[0]


def test_batch_stops_on_a_failed_check(spark, star, tmp_path):
    with pytest.raises(QualityFailed, match="GMV reconciles to items"):
        run_batch(star, str(tmp_path), expected_months=80)
    assert (tmp_path / "quality_report" / "summary").exists() and not (tmp_path / "marts").exists()


def test_batch_publishes_everything(spark, star, tmp_path):
    counts = run_batch(star, str(tmp_path), strict=False)
    assert counts.count() == 12
    assert spark.read.json(str(tmp_path / "executive_kpis")).first()["orders"] == 1500
    facts = spark.read.json(str(tmp_path / "executive_memo_facts")).first()
    assert facts["decision"] == "do not launch the treatment yet" and facts["weakest_store_id"] is not None


def test_a_repeated_order_stops_the_marts(make_star, tmp_path):
    star = make_star(orders=[dict(order_id="a"), dict(order_id="a")])
    with pytest.raises(RepeatedKey, match="fact_orders is not unique on order_id"):
        publish.publish_marts(star, str(tmp_path / "marts"))


def test_the_stated_order_count_is_compared(make_star, tmp_path):
    (tmp_path / "metadata.json").write_text('{"row_counts": {"fact_orders": 7}}')
    with pytest.raises(QualityFailed, match="metadata order count"):
        run_batch(make_star(), str(tmp_path / "out"), metadata=str(tmp_path / "metadata.json"))


def test_a_bundle_tells_unreadable_records(spark, star, bundle, tmp_path):
    for name in TABLES:
        (tmp_path / f"{name}.csv").write_text((bundle / f"{name}.csv").read_text())
    lines = (tmp_path / "fact_orders.csv").read_text().splitlines()
    at = lines[0].split(",").index("promised_minutes")
    cells = lines[7].split(",")
    cells[at] = "soon"
    lines[7] = ",".join(cells)
    (tmp_path / "fact_orders.csv").write_text("\n".join(lines) + "\n")
    stores, orders = star.stores.count(), star.orders.count()
    (tmp_path / "meta.json").write_text(json.dumps({"seed": 1, "row_counts": {"dim_stores": stores + 1, "fact_orders": orders, "other": 3}}))
    held = read_csv_bundle(spark, str(tmp_path))
    rows = {r["check"]: r for r in quality.bundle_checks(held, str(tmp_path / "meta.json")).collect()}
    assert len(rows) == 10
    assert {c for c, r in rows.items() if not r["passed"]} == {"fact_orders: readable records", "dim_stores: stated rows"}
    assert rows["fact_orders: readable records"]["sample"] == [lines[7]] and rows["dim_stores: stated rows"]["detail"] == f"stated={stores + 1};found={stores}"
    # The broken cell is null in the table, and its not-null rule names the order.
    broken = quality.constraint_violations(held, ["fact_orders"], samples=4).where("rule = 'promised_minutes_not_null'").first()
    assert (broken["violations"], broken["sample"]) == (1, [cells[lines[0].split(",").index("order_id")]])
    with pytest.raises(QualityFailed, match="fact_orders: readable records"):
        run_batch(held, str(tmp_path / "out"), metadata=str(tmp_path / "meta.json"))
