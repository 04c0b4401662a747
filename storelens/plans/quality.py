"""Data-quality checks. Rules over one table share one pass; the report is a DataFrame.

Keys are folded to one row per value before they meet another table, so a value that a third of
the rows share weighs no more than any other.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens.functions.columns import month_start, ratio
from storelens.operators.folds import folded
from storelens.sources.schemas import TABLES, compatible
from storelens.sources.star import UNREADABLE, CsvBundle, Star, order_totals

REPORT = "position int, check string, passed boolean, detail string, sample array<string>"
# Keys of violating rows that are kept per rule or check.
SAMPLES = 4
# Key and reference checks of the report, by table and column; the other check names
# below, in CHECK_ORDER and in the verdicts, are fixed as well.
REPORT_KEYS = {
    "customer primary key": "dim_customers", "store primary key": "dim_stores", "product primary key": "dim_products",
    "order primary key": "fact_orders", "order-item primary key": "fact_order_items", "session primary key": "fact_sessions",
}
REPORT_REFERENCES = {
    "order customer foreign key": ("fact_orders", "customer_id"),
    "order store foreign key": ("fact_orders", "store_id"),
    "item order foreign key": ("fact_order_items", "order_id"),
    "item product foreign key": ("fact_order_items", "product_id"),
    "session customer foreign key": ("fact_sessions", "customer_id"),
}
STATUSES = ("Delivered", "Cancelled", "Refunded")
# Reported together with the other checks of orders and lines.
LINE_REFERENCE = "item order foreign key"


def _verdict(check: str, passed: Column, detail: Column, slots: Column | None = None) -> Column:
    return F.struct(
        F.lit(check).alias("check"), F.coalesce(passed, F.lit(False)).alias("passed"), detail.cast("string").alias("detail"),
        _sample(F.array() if slots is None else slots).alias("sample"),
    )


def _text(template: str, *values: Column) -> Column:
    return F.format_string(template, *values)


def _rows(one_row: DataFrame, *verdicts: Column) -> DataFrame:
    return one_row.select(F.inline(F.array(*verdicts)))


# --- building blocks -------------------------------------------------------------------------


def _slots(bad: Column, key: tuple[str, ...] | list[str], samples: int) -> Column:
    """An aggregate beside the counts: the smallest key among the rows that ``bad`` marks, for each of ``samples``
    hash classes of the key. It is bounded, combines before the shuffle and needs no scan or sort of its own."""
    text = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key])
    place = F.pmod(F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint"), F.lit(max(samples, 1)))
    return F.array(*[F.min(F.when(bad & (place == j), text)) for j in range(samples)])


def _merged(slots: str, samples: int) -> Column:
    """Slots of several groups as those of all."""
    return F.array(*[F.min(F.col(slots)[j]) for j in range(samples)])


def _sample(slots: Column) -> Column:
    return F.array_sort(F.array_compact(slots.cast("array<string>")))


def key_duplicates(df: DataFrame, key: list[str]) -> DataFrame:
    """Key values held by more than one row, with their row counts."""
    return df.groupBy(*key).agg(F.count("*").alias("rows")).where(F.col("rows") > 1)


def _key_summary(star: Star, table: str, samples: int = 0) -> DataFrame:
    df, key = star.table(table), TABLES[table].key
    n = F.count("*").alias("n")
    # What is grouped by its key already is dealt out by it.
    counts = df.groupBy(*key).agg(n) if table in star.grouped else folded(df, list(key), [n], star.about_rows(table))
    return counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count_if(F.col("n") > 1).alias("violations"),
        _slots(F.col("n") > 1, key, samples).alias("slots"),
    )


def orphan_keys(child: DataFrame, column: str, parent: DataFrame, parent_column: str, allow_null: bool = False) -> DataFrame:
    """Reference values without a parent row, with the number of child rows behind each."""
    folded = child.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("rows"))
    if allow_null:
        folded = folded.where(F.col("value").isNotNull())
    known = parent.select(F.col(parent_column).alias("value"))
    return folded.join(known, "value", "left_anti")


def _orphan_summary(*args, samples: int = 0, **kwargs) -> DataFrame:
    return orphan_keys(*args, **kwargs).agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("violations"), _slots(F.lit(True), ["value"], samples).alias("slots")
    )


def row_rules(table: str, df: DataFrame) -> dict[str, Column]:
    """Predicates marking a row that breaks a declared rule: null, too long, or out of range."""
    spec, rules = TABLES[table], {}
    for name in spec.not_null():
        if name in df.columns:
            rules[f"{name}_not_null"] = F.col(name).isNull()
    for name, most in spec.lengths.items():
        if name in df.columns:
            rules[f"{name}_length"] = F.length(F.col(name).cast("string")) > most
    for name, text in spec.rules.items():
        rules[name] = ~F.expr(text)
    return {name: F.coalesce(bad, F.lit(False)) for name, bad in rules.items()}


def constraint_violations(star: Star, tables: list[str] | None = None, samples: int = 0) -> DataFrame:
    """Number of rows breaking each declared column rule; one pass per table. With ``samples`` a column
    ``sample`` holds up to so many keys of such rows, from the same pass."""
    parts = []
    for table in tables or list(TABLES):
        df = star.table(table)
        rules = row_rules(table, df)
        key = [k for k in TABLES[table].key if k in df.columns]
        counts = df.agg(*[F.struct(F.count_if(bad).alias("n"), _slots(bad, key, samples).alias("slots")).alias(name) for name, bad in rules.items()])
        pairs = [
            F.struct(F.lit(table).alias("table_name"), F.lit(name).alias("rule"), F.col(name)["n"].alias("violations"),
                     _sample(F.col(name)["slots"]).alias("sample"))
            for name in rules
        ]
        parts.append(counts.select(F.inline(F.array(*pairs))))
    found = reduce(DataFrame.unionByName, parts).withColumn("passed", F.col("violations") == 0)
    return found if samples else found.drop("sample")


def violating_rows(star: Star, table: str) -> DataFrame:
    """Rows of a table that break a declared column rule, once per broken rule."""
    df = star.table(table)
    broken = [F.when(bad, F.lit(name)) for name, bad in row_rules(table, df).items()]
    return df.withColumn("rule", F.explode(F.array_compact(F.array(*broken))))


def key_checks(star: Star) -> DataFrame:
    """Duplicate keys of all eight tables, composite keys included."""
    parts = [
        _key_summary(star, t).select(
            F.lit(t).alias("table_name"), F.lit("+".join(spec.key)).alias("key"), "rows", "violations"
        )
        for t, spec in TABLES.items()
    ]
    return reduce(DataFrame.unionByName, parts).withColumn("passed", F.col("violations") == 0)


def reference_checks(star: Star) -> DataFrame:
    """Child rows without a parent for all eight references; only an optional one may be null."""
    parts = []
    for table, spec in TABLES.items():
        for column, (parent, parent_column) in spec.references.items():
            optional = column not in spec.not_null()
            found = _orphan_summary(star.table(table), column, star.table(parent), parent_column, allow_null=optional)
            parts.append(found.select(F.lit(table).alias("table_name"), F.lit(column).alias("column_name"), "violations"))
    return reduce(DataFrame.unionByName, parts).withColumn("passed", F.col("violations") == 0)


def gmv_differences(star: Star) -> DataFrame:
    """Orders whose value differs from their lines by more than 0.05, or that miss one side."""
    items = order_totals(star.order_items).select("order_id", "item_revenue")
    both = star.orders.select("order_id", "gross_merchandise_value").join(items, "order_id", "full")
    gap = F.abs(F.col("gross_merchandise_value") - F.col("item_revenue"))
    return both.withColumn("difference", gap).withColumn("broken", ~F.coalesce(gap <= F.lit("0.05").cast("decimal(4,2)"), F.lit(False)))


def status_counts(star: Star) -> DataFrame:
    return star.orders.groupBy("status").agg(F.count("*").alias("orders"))


# --- the report ------------------------------------------------------------------------------


def wrong_types(df: DataFrame, table: str) -> list[tuple[str, str, str]]:
    """Columns whose type can't stand for the declared one: name, declared and found type."""
    found = {f.name: f.dataType for f in df.schema}
    return [
        (f.name, f.dataType.simpleString(), found[f.name].simpleString())
        for f in TABLES[table].schema() if f.name in found and not compatible(f.dataType, found[f.name])
    ]


def type_checks(star: Star) -> DataFrame:
    """Declared columns of all tables: whether each is there and of a type that can stand for the declared one."""
    rows = []
    for table, spec in TABLES.items():
        df = star.table(table)
        found = {f.name: f.dataType for f in df.schema}
        wrong = {name for name, _, _ in wrong_types(df, table)}
        rows += [(table, f.name, f.dataType.simpleString(), f.name in found, f.name in found and f.name not in wrong) for f in spec.schema()]
    return star.spark.createDataFrame(rows, "table_name string, column_name string, declared string, present boolean, passed boolean")


def _table_checks(star: Star) -> tuple[list[tuple], bool]:
    """Existence, required columns and declared types of every table, from the catalog or file headers alone."""
    found, complete = [], True
    for name, spec in TABLES.items():
        try:
            df = star.table(name)
            columns = set(df.columns)
        except (AnalysisException, KeyError):
            found.append((f"{name}: exists", False, "missing"))
            complete = False
            continue
        found.append((f"{name}: exists", True, "present"))
        missing = sorted(set(spec.required) - columns)
        wrong = wrong_types(df, name)
        detail = "missing=" + ",".join(missing) + "".join(f";{column}={kind} instead of {declared}" for column, declared, kind in wrong)
        found.append((f"{name}: required columns", not missing and not wrong, detail))
        complete = complete and not missing and not wrong
    return found, complete


def _key_reports(star: Star, samples: int) -> list[DataFrame]:
    keys = [
        _rows(
            _key_summary(star, table, samples),
            _verdict(check, F.col("violations") == 0, _text("rows=%d", F.col("rows")), F.col("slots")),
        )
        for check, table in REPORT_KEYS.items()
    ]
    references = []
    for check, (table, column) in REPORT_REFERENCES.items():
        if check == LINE_REFERENCE:
            continue
        parent, parent_column = TABLES[table].references[column]
        summary = _orphan_summary(star.table(table), column, star.table(parent), parent_column, samples=samples)
        references.append(_rows(summary, _verdict(check, F.col("violations") == 0, _text("orphans=%d", F.col("violations")), F.col("slots"))))
    return keys + references


def _order_reports(star: Star, months: int, expected_orders: int | None, samples: int) -> list[DataFrame]:
    """All checks of orders and their lines: one pass over orders with their line totals, one over the
    lines' order ids. Orders without lines miss one side of the reconciliation, and so do the ids of
    lines without an order, which the second pass finds anyway."""
    gap = F.abs(F.col("gross_merchandise_value") - F.col("item_revenue"))
    close = F.coalesce(gap <= F.lit("0.05").cast("decimal(4,2)"), F.lit(False))
    known = F.col("status").isin(*STATUSES)
    negative = F.least("gross_merchandise_value", "discount_amount", "refund_amount") < 0
    summary = star.orders_with_totals.agg(
        F.count("*").alias("n"),
        F.count_if(~close).alias("broken"),
        F.max(gap).cast("double").alias("largest"),
        F.count_if(~F.coalesce(known, F.lit(False))).alias("other"),
        *[F.count_if(F.col("status") == s).alias(s) for s in STATUSES],
        # The calendar bounds this set; a distinct count would carry the other figures per month.
        F.size(F.collect_set(month_start("order_ts"))).cast("long").alias("months"),
        F.count_if(F.coalesce(negative, F.lit(False))).alias("negative"),
        _slots(~close, ["order_id"], samples).alias("broken_slots"),
        _slots(~F.coalesce(known, F.lit(False)), ["order_id"], samples).alias("other_slots"),
        _slots(F.coalesce(negative, F.lit(False)), ["order_id"], samples).alias("negative_slots"),
    )
    stray = orphan_keys(star.order_items, "order_id", star.orders, "order_id").agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("lines"), F.count("*").alias("ids"),
        _slots(F.lit(True), ["value"], samples).alias("slots"),
    )
    both = summary.select("*", stray.select(F.struct("*")).scalar().alias("stray"))
    broken, orphans = F.col("broken") + F.col("stray.ids"), F.col("stray.lines")
    unequal = F.array(*[F.least(F.col("broken_slots")[j], F.col("stray.slots")[j]) for j in range(samples)])
    checks = [
        _verdict(LINE_REFERENCE, orphans == 0, _text("orphans=%d", orphans), F.col("stray.slots")),
        _verdict("GMV reconciles to items", broken == 0, _text("orders=%d;max_absolute_difference=%.4f", broken, F.col("largest")), unequal),
        _verdict("valid order status", F.col("other") == 0,
                 _text("Delivered=%d;Cancelled=%d;Refunded=%d;other=%d", *[F.col(s) for s in STATUSES], F.col("other")), F.col("other_slots")),
        _verdict("orders span all calendar months", F.col("months") == months, _text("months=%d", F.col("months"))),
        _verdict("non-negative financials", F.col("negative") == 0, _text("rows=%d", F.col("negative")), F.col("negative_slots")),
    ]
    if expected_orders is not None:
        checks.append(_verdict("metadata order count", F.col("n") == expected_orders, F.lit(f"expected={expected_orders}")))
    return [_rows(both, *checks)]


def _session_reports(star: Star, imbalance: float, lift: tuple[float, float], samples: int) -> list[DataFrame]:
    sessions = star.sessions

    def implies(later: str, earlier: str) -> Column:
        return ~F.col(later) | F.col(earlier)

    logical = (
        implies("added_to_cart", "viewed_product") & implies("checkout_started", "added_to_cart")
        & implies("converted", "checkout_started")
    )
    per_variant = sessions.groupBy("experiment_variant").agg(
        F.count("*").alias("n"), F.count_if("converted").alias("x"),
        F.count_if(~F.coalesce(logical, F.lit(False))).alias("illogical"),
        _slots(~F.coalesce(logical, F.lit(False)), ["session_id"], samples).alias("slots"),
    )

    def of(variant: str, name: str) -> Column:
        return F.max(F.when(F.col("experiment_variant") == variant, F.col(name)))

    summary = per_variant.agg(
        F.sum("illogical").alias("illogical"), _merged("slots", samples).alias("slots"),
        ratio(F.max("n") - F.min("n"), F.sum("n")).alias("imbalance"),
        *[of(v, c).alias(f"{v}_{c}") for v in ("Control", "Treatment") for c in ("n", "x")],
    ).withColumn(
        "lift", ratio(F.col("Treatment_x"), F.col("Treatment_n")) - ratio(F.col("Control_x"), F.col("Control_n"))
    )
    unlinked = _orphan_summary(sessions.where("converted"), "order_id", star.orders, "order_id", samples=samples)
    return [
        _rows(unlinked, _verdict("converted sessions link to orders", F.col("violations") == 0,
                                 _text("unlinked=%d", F.col("violations")), F.col("slots"))),
        _rows(
            summary,
            _verdict("logical session funnel", F.col("illogical") == 0, _text("rows=%d", F.col("illogical")), F.col("slots")),
            _verdict("balanced experiment assignment", F.col("imbalance") <= imbalance,
                     _text("Control=%d;Treatment=%d", F.col("Control_n"), F.col("Treatment_n"))),
            _verdict("embedded experiment lift", F.col("lift").between(*lift), _text("absolute_lift=%.4f", F.col("lift"))),
        ),
    ]


def _inventory_report(star: Star, samples: int) -> DataFrame:
    stocks = ("opening_stock", "units_received", "units_sold", "waste_units", "closing_stock")
    closing = F.col("opening_stock") + F.col("units_received") - F.col("units_sold") - F.col("waste_units")
    key, unbalanced, negative = TABLES["fact_inventory_daily"].key, ~closing.eqNullSafe(F.col("closing_stock")), F.least(*stocks) < 0
    summary = star.inventory.agg(
        F.count("*").alias("n"), F.count_if(unbalanced).alias("unbalanced"), F.count_if(negative).alias("negative"),
        _slots(unbalanced, key, samples).alias("unbalanced_slots"), _slots(negative, key, samples).alias("negative_slots"),
    )
    return _rows(
        summary,
        _verdict("inventory balance equation", F.col("unbalanced") == 0,
                 _text("rows=%d;errors=%d", F.col("n"), F.col("unbalanced")), F.col("unbalanced_slots")),
        _verdict("non-negative inventory", F.col("negative") == 0, _text("rows=%d", F.col("negative")), F.col("negative_slots")),
    )


CHECK_ORDER = [
    *REPORT_KEYS, *REPORT_REFERENCES, "GMV reconciles to items", "valid order status", "orders span all calendar months",
    "non-negative financials", "logical session funnel", "converted sessions link to orders",
    "balanced experiment assignment", "embedded experiment lift", "inventory balance equation", "non-negative inventory",
    "metadata order count",
]


def quality_report(star: Star, expected_months: int = 12, lift: tuple[float, float] = (0.035, 0.045),
                   imbalance: float = 0.02, expected_orders: int | None = None, samples: int = 0) -> DataFrame:
    """One row per check, in a fixed order. A missing table or column ends the run after the
    table checks, since no rule could be trusted beyond it.

    With ``samples`` a column ``sample`` holds up to so many keys of violating rows for each check that rows
    can break, sorted, from the scans that count them; key columns are joined by a bar.
    """
    found, complete = _table_checks(star)
    head = star.spark.createDataFrame([(i, *row, []) for i, row in enumerate(found)], REPORT)
    extra = [] if samples else ["sample"]
    if not complete:
        return head.drop(*extra)
    parts = [
        *_key_reports(star, samples), *_order_reports(star, expected_months, expected_orders, samples),
        *_session_reports(star, imbalance, lift, samples), _inventory_report(star, samples),
    ]
    place = F.create_map(*[F.lit(v) for i, c in enumerate(CHECK_ORDER) for v in (c, i + len(found))])
    body = reduce(DataFrame.unionByName, parts).withColumn("position", place[F.col("check")])
    return head.unionByName(body).drop(*extra)


def quality_summary(report: DataFrame) -> DataFrame:
    """One row: number of checks, passed, failed, and whether all passed."""
    return report.agg(
        F.count("*").alias("checks"), F.count_if("passed").alias("passed"), F.count_if(~F.col("passed")).alias("failed"),
        F.every("passed").alias("all_passed"),
    )


def expected_row_count(spark: SparkSession, path: str, table: str = "fact_orders") -> int | None:
    """Row count that a bundle's JSON metadata states for a table."""
    row = spark.read.json(path, multiLine=True).select(F.col(f"row_counts.{table}")).first()
    return None if row is None else row[0]


def stated_counts(spark: SparkSession, path: str) -> dict[str, int]:
    """Row counts that a bundle's JSON metadata states, by table; tables that are not ours are passed over."""
    metadata = spark.read.json(path, multiLine=True)
    counts = metadata.select("row_counts.*").first() if "row_counts" in metadata.columns else None
    return {} if counts is None else {t: n for t, n in counts.asDict().items() if t in TABLES and n is not None}


def bundle_checks(star: CsvBundle, metadata: str | None = None, samples: int = SAMPLES) -> DataFrame:
    """Per table of a CSV bundle, whether every record could be read, and whether there are as many as its JSON states.

    One scan of a table answers both; ``sample`` holds up to ``samples`` whole unreadable records.
    """
    stated, parts = stated_counts(star.spark, metadata) if metadata else {}, []
    for place, name in enumerate(TABLES):
        df = star.with_unreadable(name)
        broken = F.col(UNREADABLE).isNotNull()
        # Spark looks only at cells that a query reads, so rows are counted by a hash of all of them.
        mark = F.xxhash64(*[c for c in df.columns if c != UNREADABLE])
        counts = df.agg((F.count_if(mark != 0) + F.count_if(mark == 0)).alias("n"), F.count_if(broken).alias("broken"),
                        _slots(broken, [UNREADABLE], samples).alias("slots"))
        read = _text("records=%d;unreadable=%d", F.col("n"), F.col("broken"))
        checks = [_verdict(f"{name}: readable records", F.col("broken") == 0, read, F.col("slots"))]
        if name in stated:
            checks.append(_verdict(f"{name}: stated rows", F.col("n") == stated[name], _text(f"stated={stated[name]};found=%d", F.col("n"))))
        parts.append(_rows(counts, *checks).withColumn("position", F.lit(100 + place)))
    return reduce(DataFrame.unionByName, parts)
