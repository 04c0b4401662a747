"""Named business measures, computed by any related dimension under any filter.

A measure belongs to one fact. ``measure`` folds the fact to one row per key of the dimensions that
the grouping or a filter names, joins those dimensions to the folded rows, and derives ratios from
the sums: no dimension ever meets the raw fact, however many rows one store or product holds.
Dimensions filter facts one way, so a dimension that is not related to a measure's fact is an error
rather than a repeated total. Counts of orders and sessions count distinct ids, so a repeated row
counts once; they travel apart from the sums, as one row per group and id.

Filters map a field to a value, a list of values or a ``Between``. They reach the fact before
anything is joined or folded: date fields also as bounds of its time column, fields of a dimension as
a semi join with that dimension's chosen keys.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelens.functions.columns import is_cancelled, money, cents, not_cancelled, ratio
from storelens.operators.calendar import calendar_columns
from storelens.plans import views
from storelens.sources.star import Star

# Which dimensions filter which fact, and through which column.
RELATED: dict[str, dict[str, str]] = {
    "orders": {"customers": "customer_id", "stores": "store_id", "date": "order_date"},
    "order_items": {"customers": "customer_id", "stores": "store_id", "date": "order_date", "products": "product_id"},
    "sessions": {"customers": "customer_id"},
    "inventory": {"stores": "store_id", "products": "product_id", "date": "inventory_date"},
}


# The time column of each fact that has one, and whether it is a day.
TIMES = {"orders": ("order_ts", False), "order_items": ("order_ts", False), "inventory": ("inventory_date", True)}


@dataclass(frozen=True)
class Between:
    """A filter on a range, both ends included; an end of None is open."""

    low: object = None
    high: object = None


@dataclass(frozen=True)
class Base:
    """An aggregate over the rows of one fact. Partial results add up, unless ``distinct`` names the
    column whose different values are counted, over the rows where ``only`` holds."""

    fact: str
    build: Callable[[], Column] | None = None
    distinct: str | None = None
    only: Callable[[], Column] | None = None


@dataclass(frozen=True)
class Derived:
    """An expression over other measures."""

    inputs: tuple[str, ...]
    build: Callable[[], Column]


def _sum_where(name: str, condition: Callable[[], Column] | None = None) -> Callable[[], Column]:
    return lambda: F.sum(F.when(condition(), F.col(name)) if condition else F.col(name))


def _divide(a: str, b: str) -> Derived:
    return Derived((a, b), lambda: ratio(F.col(a), F.col(b)))


def _on_time() -> Column:
    return not_cancelled() & (F.col("delivery_minutes") <= F.col("promised_minutes"))


MEASURES: dict[str, Base | Derived] = {
    "orders": Base("orders", distinct="order_id"),
    "delivered_orders": Base("orders", distinct="order_id", only=lambda: F.col("status") == "Delivered"),
    "cancelled_orders": Base("orders", distinct="order_id", only=is_cancelled),
    "kept_orders": Base("orders", distinct="order_id", only=not_cancelled),
    "customers": Base("orders", distinct="customer_id"),
    "placed_gmv": Base("orders", _sum_where("gross_merchandise_value")),
    "realized_gmv": Base("orders", _sum_where("gross_merchandise_value", not_cancelled)),
    "net_revenue": Base("orders", _sum_where("net_revenue")),
    "realized_cogs": Base("orders", _sum_where("realized_cogs")),
    "delivery_cost": Base("orders", _sum_where("estimated_delivery_cost")),
    "contribution_margin": Derived(
        ("net_revenue", "realized_cogs", "delivery_cost"),
        lambda: F.col("net_revenue") - F.coalesce(F.col("realized_cogs"), F.lit(0)) - F.col("delivery_cost"),
    ),
    "contribution_margin_pct": _divide("contribution_margin", "net_revenue"),
    "aov": _divide("realized_gmv", "kept_orders"),
    "cancellation_rate": _divide("cancelled_orders", "orders"),
    "on_time_orders": Base("orders", distinct="order_id", only=_on_time),
    "on_time_rate": _divide("on_time_orders", "kept_orders"),
    "delivery_minutes": Base("orders", _sum_where("delivery_minutes", not_cancelled)),
    "timed_orders": Base("orders", lambda: F.count(F.when(not_cancelled(), F.col("delivery_minutes")))),
    "average_delivery_minutes": _divide("delivery_minutes", "timed_orders"),
    "sessions": Base("sessions", distinct="session_id"),
    "conversions": Base("sessions", distinct="session_id", only=lambda: F.col("converted")),
    "conversion_rate": _divide("conversions", "sessions"),
    "carts": Base("sessions", distinct="session_id", only=lambda: F.col("added_to_cart")),
    "add_to_cart_rate": _divide("carts", "sessions"),
    "units_sold": Base("inventory", _sum_where("units_sold")),
    "waste_units": Base("inventory", _sum_where("waste_units")),
    "waste_rate": Derived(
        ("units_sold", "waste_units"),
        lambda: ratio(F.col("waste_units"), F.col("units_sold") + F.col("waste_units")),
    ),
    "stockout_minutes": Base("inventory", _sum_where("stockout_minutes")),
    "stockout_hours": Derived(("stockout_minutes",), lambda: F.col("stockout_minutes") / F.lit(60.0)),
    # Realised cost at line grain, for grouping by product.
    "line_cogs": Base(
        "order_items",
        lambda: money(F.sum(F.when(not_cancelled(), F.col("quantity").cast("bigint") * cents("unit_cost")))),
    ),
}


def _facts(star: Star, name: str, where: dict, shift: int = 0) -> DataFrame:
    """The rows of a fact under the filters. With ``shift``, date filters see days that many months later.

    Keys and times are narrowed before orders meet their lines, the other filters follow.
    """
    def narrow(rows: DataFrame) -> DataFrame:
        return _narrowed(star, name, rows, where, shift)

    if name == "orders":
        rows = views.with_economics(star.narrowed_orders_with_totals(narrow)).withColumn("order_date", F.to_date("order_ts"))
    elif name == "order_items":
        head = narrow(star.orders).select("order_id", "customer_id", "store_id", "status", "order_ts", F.to_date("order_ts").alias("order_date"))
        rows = star.order_items.join(head, "order_id")
    else:
        rows = narrow(getattr(star, name))
    for field, wanted in where.items():
        dim, _, column = field.rpartition(".")
        if not dim:
            rows = rows.where(_matches(F.col(field), wanted))
        elif dim == "date":
            day = F.add_months(RELATED[name][dim], shift) if shift else F.col(RELATED[name][dim])
            rows = rows.where(_matches((calendar_columns(day) | {"date": day})[column], wanted))
        elif dim == "products" and name == "order_items":
            rows = _of_dimension(star, rows, dim, RELATED[name][dim], column, wanted)
    return rows


def _needed(names: list[str]) -> list[str]:
    """Base measures behind the given ones."""
    found: list[str] = []
    for name in names:
        entry = MEASURES[name]
        for base in [name] if isinstance(entry, Base) else _needed(list(entry.inputs)):
            if base not in found:
                found.append(base)
    return found


def column_name(field: str) -> str:
    """Output name of a grouping field: ``stores.city`` gives ``stores_city``, a fact column keeps its name."""
    return field.replace(".", "_")


def _matches(value: Column, wanted) -> Column:
    if isinstance(wanted, Between):
        ends = [value >= F.lit(wanted.low)] * (wanted.low is not None) + [value <= F.lit(wanted.high)] * (wanted.high is not None)
        return reduce(lambda a, b: a & b, ends, value.isNotNull())
    return value.isin(*wanted) if isinstance(wanted, (list, tuple, set)) else value == F.lit(wanted)


def _days_of(column: str, wanted) -> tuple[dt.date | None, dt.date | None]:
    """First and last day that a filter on a calendar column can let through; None is open."""
    def span(value) -> tuple[dt.date, dt.date]:
        text = str(value)
        if column == "date":
            day = dt.date.fromisoformat(text[:10])
            return day, day
        first = dt.date(int(text[:4]), int(text[5:7]) if column == "year_month" else 1, 1)
        last = dt.date(first.year + (column == "year" or first.month == 12), 1 if column == "year" else first.month % 12 + 1, 1)
        return first, last - dt.timedelta(days=1)

    if column not in ("date", "year_month", "year"):
        return None, None
    if isinstance(wanted, Between):
        return (span(wanted.low)[0] if wanted.low is not None else None), (span(wanted.high)[1] if wanted.high is not None else None)
    spans = [span(v) for v in (wanted if isinstance(wanted, (list, tuple, set)) else [wanted])]
    return min((s[0] for s in spans), default=None), max((s[1] for s in spans), default=None)


def _of_dimension(star: Star, rows: DataFrame, dim: str, key: str, column: str, wanted) -> DataFrame:
    chosen = getattr(star, dim).where(_matches(F.col(column), wanted)).select(key)
    return rows.join(chosen, key, "left_semi")


def _narrowed(star: Star, fact: str, rows: DataFrame, where: dict, shift: int) -> DataFrame:
    """Rows within the bounds of date filters and with keys that dimension filters choose."""
    for field, wanted in where.items():
        dim, _, column = field.rpartition(".")
        if dim and dim not in RELATED[fact]:
            raise ValueError(f"{dim} is not related to {fact}")
        if dim == "date":
            name, daily = TIMES[fact]
            low, high = _days_of(column, wanted)
            # Plain bounds of the stored column, which reach the scan; a month has 28 to 31 days.
            kind, at = ("date", lambda day: day) if daily else ("timestamp_ntz", lambda day: dt.datetime.combine(day, dt.time()))
            if low:
                rows = rows.where(F.col(name) >= F.lit(at(low - dt.timedelta(days=34 * shift))).cast(kind))
            if high:
                rows = rows.where(F.col(name) < F.lit(at(high - dt.timedelta(days=27 * shift - 1))).cast(kind))
        elif dim and not (dim == "products" and fact == "order_items"):
            rows = _of_dimension(star, rows, dim, RELATED[fact][dim], column, wanted)
    return rows


@dataclass(frozen=True)
class Context:
    """Grouping of one fact: columns of the fact itself, and columns of dimensions."""

    own: dict[str, Column]
    keys: dict[str, str]
    dims: dict[str, list[str]]

    @staticmethod
    def of(fact: str, by: list[str]) -> "Context":
        own: dict[str, Column] = {}
        keys: dict[str, str] = {}
        dims: dict[str, list[str]] = {}
        for field in dict.fromkeys(by):
            dim, _, column = field.rpartition(".")
            if not dim:
                own[field] = F.col(field)
            elif dim not in RELATED[fact]:
                raise ValueError(f"{dim} is not related to {fact}")
            elif dim == "date":
                day = F.col(RELATED[fact][dim])
                own[column_name(field)] = (calendar_columns(day) | {"date": day})[column]
            else:
                keys[dim] = RELATED[fact][dim]
                dims.setdefault(dim, []).append(column)
        return Context(own, keys, dims)

    def fold_keys(self) -> list[Column]:
        """What the fact is folded by: its own fields and the keys of the dimensions."""
        return [c.alias(n) for n, c in self.own.items()] + [F.col(k).alias(f"_{d}") for d, k in self.keys.items()]

    def attach(self, star: Star, folded: DataFrame) -> DataFrame:
        """Dimension columns on the folded rows. The outer join keeps rows whose key has no match, under null."""
        for dim, columns in self.dims.items():
            side = getattr(star, dim).select(
                F.col(self.keys[dim]).alias(f"_{dim}"), *[F.col(c).alias(f"{dim}_{c}") for c in columns]
            )
            folded = folded.join(side, f"_{dim}", "left")
        return folded


def _sums(star: Star, fact: str, bases: list[str], by: list[str], where: dict) -> DataFrame:
    """Additive base measures of one fact per group."""
    context = Context.of(fact, by)
    rows = _facts(star, fact, where)
    folded = rows.groupBy(*context.fold_keys()).agg(*[MEASURES[b].build().alias(b) for b in bases])
    return context.attach(star, folded).groupBy(*[column_name(f) for f in by]).agg(*[F.sum(b).alias(b) for b in bases])


def _distinct(star: Star, fact: str, column: str, bases: list[str], by: list[str], where: dict) -> DataFrame:
    """Distinct counts of one column per group, from one row per group and value with a flag per measure.

    Counted apart from the sums, or every sum would travel once per value.
    """
    context, keys = Context.of(fact, by), [column_name(f) for f in by]
    rows = _facts(star, fact, where)
    holds = [F.coalesce(MEASURES[b].only() if MEASURES[b].only else F.lit(True), F.lit(False)).alias(b) for b in bases]
    values = rows.where(F.col(column).isNotNull()).select(*context.fold_keys(), F.col(column).alias("_value"), *holds)
    folded = values.groupBy(*[n for n in values.columns if n not in bases]).agg(*[F.bool_or(b).alias(b) for b in bases])
    if context.dims:
        folded = context.attach(star, folded).groupBy(*keys, "_value").agg(*[F.bool_or(b).alias(b) for b in bases])
    return folded.groupBy(*keys).agg(*[F.count_if(b).alias(b) for b in bases])


def _join_on(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Two grouped results side by side. Groups may be null and may miss on one side; ungrouped
    results are single rows, read as a scalar subquery."""
    if not keys:
        row = right.select(F.struct("*")).scalar()
        return left.select("*", row.alias("_right")).select(*left.columns, *[F.col(f"_right.{c}") for c in right.columns])
    renamed = right.select(*[F.col(k).alias(f"_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    condition = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    rest = [c for c in [*left.columns, *right.columns] if c not in keys]
    return left.join(renamed, condition, "full").select(
        *[F.coalesce(F.col(k), F.col(f"_{k}")).alias(k) for k in keys], *rest
    )


def measure(star: Star, names: list[str] | str, by: list[str] | None = None, where: dict | None = None) -> DataFrame:
    """The named measures per group. One pass per fact and distinct count; results join on the groups."""
    names, by = [names] if isinstance(names, str) else list(names), by or []
    bases = _needed(names)
    keys = [column_name(f) for f in by]
    parts = []
    for fact in dict.fromkeys(MEASURES[b].fact for b in bases):
        additive = [b for b in bases if MEASURES[b].fact == fact and not MEASURES[b].distinct]
        if additive:
            parts.append(_sums(star, fact, additive, by, where or {}))
        counted = [b for b in bases if MEASURES[b].fact == fact and MEASURES[b].distinct]
        for value in dict.fromkeys(MEASURES[b].distinct for b in counted):
            same = [b for b in counted if MEASURES[b].distinct == value]
            parts.append(_distinct(star, fact, value, same, by, where or {}))
    result = reduce(lambda a, b: _join_on(a, b, keys), parts)

    def derive(df: DataFrame, name: str) -> DataFrame:
        entry = MEASURES[name]
        if name in df.columns or isinstance(entry, Base):
            return df
        for part in entry.inputs:
            df = derive(df, part)
        return df.withColumn(name, entry.build())

    for name in names:
        result = derive(result, name)
    return result.select(*keys, *names)


def repeat_customers(star: Star, by: list[str] | None = None, where: dict | None = None) -> DataFrame:
    """Customers with more than one order in the group, and their share of the group's customers.

    Two different order ids mean the smallest and largest differ, which combines before the shuffle.
    """
    by, where = by or [], where or {}
    keys = [column_name(f) for f in by]
    context = Context.of("orders", by)
    folded = _facts(star, "orders", where).groupBy(*context.fold_keys(), "customer_id").agg(
        F.min("order_id").alias("low"), F.max("order_id").alias("high")
    )
    per_customer = context.attach(star, folded).groupBy(*keys, "customer_id").agg(
        (F.min("low") != F.max("high")).alias("repeated")
    )
    return (
        per_customer.groupBy(*keys)
        .agg(F.count("customer_id").alias("customers"), F.count_if("repeated").alias("repeat_customers"))
        .withColumn("repeat_customer_rate", ratio(F.col("repeat_customers"), F.col("customers")))
    )


def gmv_month_over_month(star: Star, by: list[str] | None = None, where: dict | None = None) -> DataFrame:
    """Realised GMV per month beside that of the calendar month before; a missing month gives null.

    A date filter chooses the current days; the month before is seen through the same filter moved
    back by a month, so that it does not filter itself away. Other filters hold for both.
    """
    by, where = by or [], where or {}
    keys = [column_name(f) for f in by]
    context = Context.of("orders", by)

    def monthly(shift: int) -> DataFrame:
        rows = _facts(star, "orders", where, shift)
        month = F.trunc(F.add_months("order_date", shift), "month").alias("month")
        folded = rows.groupBy(*context.fold_keys(), month).agg(MEASURES["realized_gmv"].build().alias("gmv"))
        return context.attach(star, folded).groupBy(*keys, "month").agg(F.sum("gmv").alias("gmv"))

    now, before = monthly(0).withColumnRenamed("gmv", "realized_gmv"), monthly(1)
    before = before.select(
        *[F.col(k).alias(f"_{k}") for k in keys], F.col("month").alias("_month"), F.col("gmv").alias("realized_gmv_previous_month")
    )
    match = reduce(
        lambda a, b: a & b,
        [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys],
        F.col("month") == F.col("_month"),
    )
    current, previous = F.col("realized_gmv"), F.col("realized_gmv_previous_month")
    return (
        now.join(before, match, "left")
        .select(*keys, "month", "realized_gmv", "realized_gmv_previous_month")
        .withColumn("gmv_mom_pct", ratio(current - previous, previous))
    )


def row_access(df: DataFrame, access: DataFrame, user: str, column: str = "city", user_column: str = "email") -> DataFrame:
    """Rows whose ``column`` the access table grants to ``user``."""
    granted = access.where(F.col(user_column) == user).select(F.col("city").alias(column)).distinct()
    return df.join(granted, column, "left_semi")
