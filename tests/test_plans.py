"""The physical plans keep what the design promises at scale."""

import re

import pytest

import __spark_entry__ as entry
from conftest import DATA
from storelens.plans import business, marts, views
from storelens.sources import MappedStar, publish


@pytest.fixture(scope="module")
def star(spark):
    return MappedStar(spark, f"{DATA}/sf0.01")


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def main_plan(df) -> str:
    """The plan without its subqueries, whose lines hang on a node's own bar."""
    lines, inside = [], None
    for line in plan(df).splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        if inside is not None and depth > inside:
            continue
        inside = depth if "Subquery" in line[depth:depth + 14] else None
        if inside is None:
            lines.append(line)
    return "\n".join(lines)


def test_only_read_columns_reach_the_scan(star):
    text = plan(business.q12_cancellation_hotspots(star))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert any(s == "o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string" for s in schemas)
    assert "lineitem" not in text


def test_unread_joins_disappear(star):
    assert plan(business.q22_payment_method(star)).count("lineitem.parquet") == 1
    assert plan(business.q22_payment_method(star)).count("/orders.parquet") == 1


def test_first_order_flag_needs_no_window(star):
    assert "Window" not in plan(views.order_economics(star))


def test_large_joins_share_one_partitioning(star, no_broadcast):
    """Orders, line totals and first orders move once each; the fourth exchange groups by customer."""
    text = plan(views.order_economics(star))
    assert text.count("SortMergeJoin") == 2 and text.count("Exchange hashpartitioning") == 4


def test_dimensions_join_after_the_facts_are_folded(star, no_broadcast):
    """The exchange on the store id carries one row per store and task, not one per order."""
    text = plan(business.q02_city_value(star))
    join = text.index("store_id")
    assert text.index("HashAggregate") < text.rindex("SortMergeJoin")
    assert join >= 0 and text.count("partial_sum(gross_merchandise_value") == 1


@pytest.mark.parametrize("name", [n for n in entry.PLANS if n != "publish_marts"])
def test_no_cartesian_products(star, no_broadcast, name):
    assert "CartesianProduct" not in plan(entry.PLANS[name](star))


@pytest.mark.parametrize("name", list(publish.MARTS))
def test_no_cartesian_products_in_marts(star, no_broadcast, name):
    assert "CartesianProduct" not in plan(publish.MARTS[name](star))


def test_the_order_sequence_moves_orders_once(star, no_broadcast):
    """Rows move once, to the task of their slice; slice heads are the only other thing that is joined."""
    main = main_plan(views.customer_order_sequence(star))
    assert main.count("shufflepartitionidpassthrough") == 1 and "hashpartitioning(customer_id" not in main
    assert main.count("Window [lead(") == 2 and "BroadcastHashJoin" in main


@pytest.mark.parametrize("build", [business.q08_rfm_segments, business.q23_margin_concentration, marts.rfm_customers])
def test_tiles_are_projections(star, build):
    """No window ranks the customers: only the slices behind the cut keys are ranked, in subqueries."""
    text = main_plan(build(star))
    assert "ntile(" not in text and "row_number" not in text
