"""Global tiles and exact percentiles without sending all rows through one task.

``ntile`` over the whole table puts every row into a single sort. Five tiles, however, are fully
described by four cut keys: the rows standing at four known ranks. They are found by narrowing: count rows
between split keys, split the slices that hold a wanted rank again, until those are small. All sort orders
asked for and all their open slices share the jobs of a round, one that samples split keys and one aggregate that
counts. Splitting is by the whole sort key including a unique last column, so a value shared by a third
of all rows is cut up like any other. The last step stays in the plan: the few small slices are ranked
by one window each, cut keys and percentiles are scalar subqueries, and tiling is a projection that
compares each row with a few keys.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from itertools import count

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from storelens.operators.slices import packed, sample_place

# A slice of at most this many rows is ranked by one ordinary window.
SMALL_SLICE = 1_000_000
# Slices that a slice is cut into each round, and sampled rows for each of them. The sample sets only
# where to split; every row is counted.
PARTS, SAMPLED, DRAWS = 8, 64, 3

# The wanted 1-based ranks, from the number of rows.
Ranks = Callable[[int], list[int]]


@dataclass(frozen=True)
class Key:
    """One column of a sort key."""

    name: str
    descending: bool = False

    def order(self) -> Column:
        return F.col(self.name).desc() if self.descending else F.col(self.name).asc()


def as_keys(keys) -> list[Key]:
    return [k if isinstance(k, Key) else Key(k) for k in keys]


def at_or_after(keys: list[Key], value: Callable[[int], Column]) -> Column:
    """True where a row sorts at or after the key whose columns ``value`` gives."""

    def compare(i: int) -> Column:
        name, other = F.col(keys[i].name), value(i)
        beyond = (name < other) if keys[i].descending else (name > other)
        if i == len(keys) - 1:
            return beyond | (name == other)
        return beyond | ((name == other) & compare(i + 1))

    return compare(0)


def _reached(keys: list[Key], split: Row) -> Column:
    return at_or_after(keys, lambda i: F.lit(split[i]))


def _slice_number(keys: list[Key], splits: list[Row]) -> Column:
    """How many split keys a row has reached, as a balanced tree of comparisons."""

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(_reached(keys, splits[middle]), search(middle + 1, high)).otherwise(search(low, middle))

    return search(0, len(splits))


@dataclass(frozen=True)
class _Slice:
    """Rows from ``low`` on and before ``high`` (none: no bound), ``before`` rows ahead of them, and the ranks wanted inside."""

    low: Row | None
    high: Row | None
    before: int
    rows: int
    ranks: list[int]

    def holds(self, keys: list[Key]) -> Column:
        """Plain comparisons, which reach the scan."""
        after = F.col(keys[0].name).isNotNull() if self.low is None else _reached(keys, self.low)
        return after if self.high is None else after & ~_reached(keys, self.high)


def _ordered(keys: list[Key], rows: list[Row]) -> list[Row]:
    for i in reversed(range(len(keys))):
        rows = sorted(rows, key=lambda row: row[i], reverse=keys[i].descending)
    return rows


def _sampled_splits(df: DataFrame, known: dict[str, list[Key]], large: dict[tuple[str, int], _Slice], number: int) -> dict[tuple[str, int], list[Row]]:
    """Evenly spaced rows inside each large slice of each order, from one job."""
    chosen = {
        (name, i): s.holds(known[name]) & (sample_place([k.name for k in known[name]], number) * s.rows < PARTS * SAMPLED) for (name, i), s in large.items()
    }
    near = df.where(reduce(lambda a, b: a | b, chosen.values()))
    drawn = near.agg(*[F.collect_list(F.when(c, packed([k.name for k in known[name]]))).alias(f"{name} {i}") for (name, i), c in chosen.items()]).first()
    made = {}
    for (name, i), s in large.items():
        rows = [r for r in _ordered(known[name], drawn[f"{name} {i}"]) if r != s.low]
        step = len(rows) // PARTS + 1
        made[name, i] = rows[step - 1::step]
    return made


def _counts(df: DataFrame, known: dict[str, list[Key]], edges: dict[str, list[Row]]) -> dict[tuple[str, int], int]:
    """Rows between the edges of every order, from one aggregate."""
    numbers = [
        F.struct(F.lit(name).alias("order"), _slice_number(known[name], rows).alias("slice"), F.col(known[name][0].name).isNotNull().alias("ranked"))
        for name, rows in edges.items()
    ]
    counted = df.select(F.explode(F.array(*numbers)).alias("e")).where("e.ranked").groupBy("e.order", "e.slice").count()
    return {(r["order"], r["slice"]): r["count"] for r in counted.collect()}


def rows_at_ranks(df: DataFrame, orders: dict[str, tuple[list, Ranks]], small: int | None = None) -> dict[str, DataFrame]:
    """For each named order ``rank`` and ``at`` (the packed key): one row for each wanted rank there is, as
    often as it is wanted.

    An order is a sort key whose last column is unique, and its ranks. Rows whose first key column is null are
    not ranked; no other key column may be null. ``df`` is read several times, so it should come from ``write_once``. The driver
    sees the row counts, the split keys and one count for each slice.
    """
    small = small or SMALL_SLICE
    known = {name: as_keys(keys) for name, (keys, _) in orders.items()}
    rows = df.agg(*[F.count(keys[0].name).alias(name) for name, keys in known.items()]).first().asDict()
    wanted = {name: orders[name][1](rows[name]) for name in orders}
    slices = {name: [_Slice(None, None, 0, rows[name], wanted[name])] for name in orders}
    # A slice in which no draw finds a split key, for want of distinct keys, is ranked as it is.
    idle: Counter[tuple] = Counter()
    for number in count(1):
        large = {(name, i): s for name, held in slices.items() for i, s in enumerate(held) if s.ranks and s.rows > small and idle[name, s.low, s.high] < DRAWS}
        if not large:
            break
        splits = _sampled_splits(df, known, large, number)
        idle.update((name, s.low, s.high) for (name, i), s in large.items() if not splits[name, i])
        edges = {}
        for name, held in slices.items():
            if not any(n == name for n, _ in large):
                continue
            kept = [[s.low, *splits.get((name, i), []), s.high] for i, s in enumerate(held) if s.ranks]
            edges[name] = list(dict.fromkeys(e for part in kept for e in part if e is not None))
        counts = _counts(df, known, edges)
        for name, bounds in edges.items():
            before, made = 0, []
            for i, (low, high) in enumerate(zip([None, *bounds], [*bounds, None])):
                held = counts.get((name, i), 0)
                made.append(_Slice(low, high, before, held, [r for r in wanted[name] if before < r <= before + held]))
                before += held
            slices[name] = made
    found = {}
    for name, keys in known.items():
        open_slices = [s for s in slices[name] if s.ranks]
        # Where no rank is wanted nothing is read.
        start = reduce(lambda a, s: a.when(s.holds(keys), F.lit(s.before).cast("long")), open_slices, F.when(F.lit(False), F.lit(0).cast("long")))
        near = df.select(*dict.fromkeys(k.name for k in keys), start.alias("_start")).where("_start is not null")
        place = F.row_number().over(Window.partitionBy("_start").orderBy(*[k.order() for k in keys]))
        hits = F.explode(F.filter(F.array(*[F.lit(r).cast("long") for r in wanted[name]]), lambda r: r == F.col("rank")))
        found[name] = near.withColumn("rank", place + F.col("_start")).select(hits.alias("rank"), packed([k.name for k in keys]).alias("at"))
    return found


def _tile_starts(n: int, method: str) -> Ranks:
    """First rank of tiles 2 to ``n``; a rank beyond the number of rows marks an empty tile."""
    if method == "ntile":
        return lambda rows: [t * (rows // n) + min(t, rows % n) + 1 for t in range(1, n)]
    if method == "qcut":
        # Right-closed bins over ranks 1..rows at evenly spaced interpolated quantiles.
        return lambda rows: [t * (rows - 1) // n + 2 for t in range(1, n)]
    raise ValueError(f"unknown tiling method {method!r}")


def tiles(df: DataFrame, wanted: dict[str, tuple], small: int | None = None) -> DataFrame:
    """``df`` and for each name of ``wanted`` a column with the tile (1 to ``n``) of each row.

    ``wanted`` gives a sort key whose last column is unique, ``n``, and the method: ``ntile`` gives the SQL
    function's sizes; ``qcut`` cuts the ranks at evenly spaced quantiles. No key may be null.
    """
    orders = {name: (keys, _tile_starts(n, method)) for name, (keys, n, method) in wanted.items()}

    cuts = {name: rows.agg(F.collect_list("at")).scalar() for name, rows in rows_at_ranks(df, orders, small).items()}

    def tile(name: str, n: int, keys: list[Key]) -> Column:
        # A tile without a row has no cut key, which no row has reached.
        reached = [at_or_after(keys, lambda i: F.get(f"_cuts_{name}", F.lit(t))[f"k{i}"]) for t in range(n - 1)]
        return reduce(lambda a, b: a + F.when(b, 1).otherwise(0), reached, F.lit(1))

    held = df.select("*", *[c.alias(f"_cuts_{name}") for name, c in cuts.items()])
    return held.select(*[F.col(f"`{c}`") for c in df.columns], *[tile(name, n, as_keys(keys)).alias(name) for name, (keys, n, _) in wanted.items()])


def percentiles(df: DataFrame, wanted: dict[str, float], unique: list[str], small: int | None = None) -> dict[str, Column]:
    """The interpolated percentile of each named column over its non-null values, exact, as a scalar subquery
    (null where there is no value)."""

    def position(share: float, rows: int) -> float:
        return share * (rows - 1)

    def ranks(share: float) -> Ranks:
        return lambda rows: [int(position(share, rows)) + 1, min(int(position(share, rows)) + 2, rows)]

    rows = df.agg(*[F.count(name).alias(name) for name in wanted]).first().asDict()
    found = rows_at_ranks(df, {name: ([name, *unique], ranks(share)) for name, share in wanted.items()}, small)
    made = {}
    for name, share in wanted.items():
        below, above = F.min("at.k0").cast("double"), F.max("at.k0").cast("double")
        part = position(share, rows[name]) % 1
        made[name] = found[name].agg(F.when(below == above, below).otherwise((1 - part) * below + part * above)).scalar()
    return made
