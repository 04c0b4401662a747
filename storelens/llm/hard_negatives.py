"""Hard negatives for contrastive training, by angular triangle filtering.

Components are scaled and floored to integers; a row's score for an anchor is their exact inner
product. Every row stores its norm and its angles to a few reference directions. For an anchor and a
row the triangle inequality on the sphere confines their angle to

    max |a_r - x_r|  <=  angle  <=  min(a_r + x_r, 2 pi - a_r - x_r)      over all references r,

so the cosines of both ends times both norms, widened for rounding, bound the score. Only rows whose
bounds reach what is asked for are scored, in integers:

1. Positives: the best rows of the anchor's label. A row whose upper bound is below the k-th best lower
   bound can't be one of the first k.
2. Negatives: each positive opens a window of scores. Rows of other labels whose bounds overlap it, and
   whose upper bound reaches the k-th best lower bound among rows surely inside, are scored.

Anchors and rows are dealt into blocks of bounded size by a hash of their id; each block of anchors meets
each block of rows once a step, and hands on its best few per anchor. So no task or group grows with
the tables, whatever share of them one label or one vector holds, and a lost task is run again.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from storelens.llm.shared import column, hashed_sample, write_once

# Rows and anchors of one block.
ROWS, ANCHORS = 4096, 2048
# Reference directions, and the rows among which they are picked. They set how much is scored, never the result.
REFERENCES, PICKED_FROM = 16, 512
# What rounding may add to an angle, and to a score in proportion to the product of the norms.
ANGLE_SLACK, SCORE_SLACK = 1e-6, 1e-9
# Rows of this length or more in scaled units take no part, so that scores fit a long.
TOO_LONG = 2.0 ** 31
# Up to this product of norms, sums of products are exact as doubles.
EXACT = 2.0 ** 53


def reference_directions(sample: np.ndarray, wanted: int = REFERENCES) -> np.ndarray:
    """Unit vectors spread over ``sample``: each next one is the row furthest in angle from those before."""
    norms = np.linalg.norm(sample, axis=1)
    unit = sample[norms > 0] / norms[norms > 0, None]
    if not len(unit):
        return unit
    picked, nearest = [0], unit @ unit[0]
    while len(picked) < min(wanted, len(unit)):
        picked.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, unit @ unit[picked[-1]])
    return unit[picked]


def angles_to(references: np.ndarray, vectors: np.ndarray, norms: np.ndarray) -> np.ndarray:
    """The angle of each vector to each reference; of a zero vector some angle, its score bounds are zero."""
    cosines = vectors @ references.T / np.where(norms > 0, norms, 1.0)[:, None]
    return np.arccos(np.clip(cosines, -1.0, 1.0))


def score_bounds(angles: np.ndarray, norm: float, row_angles: np.ndarray, row_norms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lowest and the highest score that rows can have with an anchor."""
    product = norm * row_norms
    slack = SCORE_SLACK * product + 1.0
    if not len(angles):
        return -product - slack, product + slack
    total = row_angles + angles
    low = np.abs(row_angles - angles).max(axis=1) - ANGLE_SLACK
    high = np.minimum(total, 2 * np.pi - total).min(axis=1) + ANGLE_SLACK
    return (
        np.cos(np.minimum(high, np.pi)) * product - slack,
        np.cos(np.maximum(low, 0.0)) * product + slack,
    )


def exact_scores(anchor: np.ndarray, rows: np.ndarray, largest: float) -> np.ndarray:
    """Integer inner products; ``largest`` bounds the product of the norms."""
    if largest < EXACT:
        return (rows.astype(np.float64) @ anchor.astype(np.float64)).astype(np.int64)
    return rows @ anchor


def _floor_of_best(lower: np.ndarray, wanted: int) -> float:
    return np.partition(lower, len(lower) - wanted)[len(lower) - wanted] if len(lower) >= wanted else -np.inf


def _best(scores: np.ndarray, ids: np.ndarray, wanted: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:wanted]


class _Block:
    """Rows of one dimension as matrices."""

    def __init__(self, table: pa.Table):
        def matrix(name: str) -> np.ndarray:
            lists = table.column(name).combine_chunks()
            return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1 if len(lists.flatten()) else 0)

        self.ids = table.column("id").to_numpy()
        self.vectors, self.angles = matrix("vector"), matrix("angles")
        self.norms = table.column("norm").to_numpy()
        self.labels = table.column("label").to_pandas().to_numpy()


def _same_labels(anchors: _Block, rows: _Block) -> tuple[np.ndarray, np.ndarray]:
    numbers = np.unique(np.concatenate([anchors.labels, rows.labels]), return_inverse=True)[1]
    return numbers[:len(anchors.ids)], numbers[len(anchors.ids):]


def _find_positives(wanted: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[list] = [[], [], []]
        if left.num_rows and right.num_rows:
            anchors, rows = _Block(left), _Block(right)
            own, labels = _same_labels(anchors, rows)
            by_label = np.argsort(labels, kind="stable")
            begins = np.searchsorted(labels[by_label], own, "left")
            ends = np.searchsorted(labels[by_label], own, "right")
            for i, (a, b) in enumerate(zip(begins.tolist(), ends.tolist())):
                near = by_label[a:b]
                near = near[rows.ids[near] != anchors.ids[i]]
                if len(near) > wanted:
                    lower, upper = score_bounds(anchors.angles[i], anchors.norms[i], rows.angles[near], rows.norms[near])
                    near = near[upper >= _floor_of_best(lower, wanted)]
                if len(near):
                    scores = exact_scores(anchors.vectors[i], rows.vectors[near], anchors.norms[i] * rows.norms[near].max())
                    best = _best(scores, rows.ids[near], wanted)
                    found[0] += [int(anchors.ids[i])] * len(best)
                    found[1] += rows.ids[near][best].tolist()
                    found[2] += scores[best].tolist()
        return pa.table([pa.array(f, pa.int64()) for f in found], ["anchor_id", "positive_id", "positive_score"])

    return run


def _find_negatives(low: int, high: int, wanted: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[list] = [[], [], [], [], []]
        if left.num_rows and right.num_rows:
            anchors, rows = _Block(left), _Block(right)
            own, labels = _same_labels(anchors, rows)
            for i, positives in enumerate(left.column("positives").to_pylist()):
                # low * positive <= 100 * score <= high * positive, in whole scores.
                windows = [(p["positive_id"], p["positive_score"], -(-low * p["positive_score"] // 100), high * p["positive_score"] // 100) for p in positives]
                other = np.flatnonzero(labels != own[i])
                if not len(other):
                    continue
                lower, upper = score_bounds(anchors.angles[i], anchors.norms[i], rows.angles[other], rows.norms[other])
                asked = np.zeros(len(other), bool)
                for _, _, least, most in windows:
                    if least <= most:
                        sure = lower[(lower >= least) & (upper <= most)]
                        asked |= (upper >= least) & (lower <= most) & (upper >= _floor_of_best(sure, wanted))
                other = other[asked]
                if not len(other):
                    continue
                scores = exact_scores(anchors.vectors[i], rows.vectors[other], anchors.norms[i] * rows.norms[other].max())
                for positive, score, least, most in windows:
                    inside = np.flatnonzero((scores >= least) & (scores <= most))
                    best = inside[_best(scores[inside], rows.ids[other][inside], wanted)]
                    found[0] += [int(anchors.ids[i])] * len(best)
                    found[1] += [positive] * len(best)
                    found[2] += [score] * len(best)
                    found[3] += rows.ids[other][best].tolist()
                    found[4] += scores[best].tolist()
        names = ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"]
        return pa.table([pa.array(f, pa.int64()) for f in found], names)

    return run


def _met(anchors: DataFrame, rows: DataFrame, row_blocks: int, anchor_blocks: int, run, schema: str) -> DataFrame:
    """``run`` on every block of anchors with every block of rows of their dimension."""
    asking = anchors.withColumn("x", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(anchor_blocks))).withColumn("y", F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1))))
    asked = rows.withColumn("y", F.pmod(F.xxhash64("id"), F.lit(row_blocks)).cast("int")).withColumn("x", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(anchor_blocks - 1).cast("long"))))
    return asking.groupBy("dimension", "x", "y").cogroup(asked.groupBy("dimension", "x", "y")).applyInArrow(run, schema)


def _prepared(df: DataFrame, scale: int) -> DataFrame:
    """``id, label, anchor, dimension, vector, norm, angles`` of the rows that take part."""
    schema = df.select("id", "label", "anchor").schema.simpleString()[len("struct<"):-1]
    finite = df.where("id is not null and label is not null and vector is not null").where(
        "size(vector) > 0 and forall(vector, x -> x is not null and x > double('-infinity') and x < double('infinity'))"
    )
    references: dict[int, np.ndarray] = {}
    by_size: dict[int, list] = {}
    for row in hashed_sample(finite.select("id", "vector"), ["id"], PICKED_FROM).collect():
        by_size.setdefault(len(row["vector"]), []).append(row["vector"])
    for size, vectors in by_size.items():
        with np.errstate(over="ignore"):
            scaled = np.floor(scale * np.array(vectors, np.float64))
            references[size] = reference_directions(scaled[np.linalg.norm(scaled, axis=1) < TOO_LONG])
    shared = df.sparkSession.sparkContext.broadcast(references)

    def run(batches):
        for batch in batches:
            lists = batch.column(3)
            sizes = np.asarray(lists.value_lengths())
            values = lists.flatten().to_numpy(zero_copy_only=False)
            begins = np.concatenate([[0], np.cumsum(sizes)])[:-1]
            for size in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == size)
                vectors = np.floor(scale * values[begins[at][:, None] + np.arange(size)])
                with np.errstate(over="ignore"):
                    norms = np.sqrt((vectors * vectors).sum(axis=1))
                fits = norms < TOO_LONG
                at, vectors, norms = at[fits], vectors[fits], norms[fits]
                directions = shared.value.get(size, np.empty((0, size)))
                angles = angles_to(directions, vectors, norms) if len(directions) else np.empty((len(at), 0))
                kept = batch.take(pa.array(at))

                def listed(matrix: np.ndarray, kind: pa.DataType) -> pa.Array:
                    offsets = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
                    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(matrix.ravel(), kind))

                yield pa.RecordBatch.from_arrays(
                    [*kept.columns[:3], pa.array(np.full(len(at), size, np.int32)), listed(vectors.astype(np.int64), pa.int64()),
                     pa.array(norms), listed(angles, pa.float64())],
                    names=["id", "label", "anchor", "dimension", "vector", "norm", "angles"],
                )

    made = write_once(finite.mapInArrow(run, f"{schema}, dimension int, vector array<long>, norm double, angles array<double>"), "vectors")
    repeated = write_once(made.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id"), "repeated-ids")
    if repeated.isEmpty():
        return made
    rest = [c for c in made.columns if c != "id"]
    one = made.join(repeated, "id", "left_semi").groupBy("id").agg(F.min(F.struct("label", "vector", *[c for c in rest if c not in ("label", "vector")])).alias("r"))
    return write_once(made.join(repeated, "id", "left_anti").unionByName(one.select("id", *[F.col(f"r.{c}").alias(c) for c in rest])), "vectors-once")


def hard_negatives(
    vectors: DataFrame, anchors: Column, id_column: str = "vec_id", vector_column: str = "embedding", label: Column | None = None,
    scale: int = 256, positives: int = 5, negatives: int = 10, percent: tuple[int, int] = (30, 90),
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    A score is the inner product of the vectors with components floored after multiplying by ``scale``.
    For each row that ``anchors`` holds for and each of its first ``positives`` other rows of the same
    label, the first ``negatives`` rows of other labels whose score is between ``percent`` of the
    positive's; higher scores come first, ties by smaller id. Fewer where there are fewer; a positive
    without a negative gives no row.

    Rows without an id, label or vector, with an empty vector, or with a null or non-finite component take no part, nor do
    rows whose scaled length reaches 2**31. An anchor meets only rows of as many components. Rows that
    share an id are one row, the one with the smallest label and vector. An empty table, or one without
    anchors, gives an empty result; further columns are ignored.
    """
    label = column("label") if label is None else label
    chosen = vectors.select(
        column(id_column).cast("long").alias("id"), label.alias("label"), F.coalesce(anchors, F.lit(False)).alias("anchor"),
        column(vector_column).cast("array<double>").alias("vector"),
    )
    rows = _prepared(chosen, scale)
    sizes = rows.agg(F.count("*").alias("rows"), F.count_if("anchor").alias("anchors")).first()
    row_blocks, anchor_blocks = -(-sizes["rows"] // ROWS) or 1, -(-sizes["anchors"] // ANCHORS) or 1
    asking, asked = rows.where("anchor").drop("anchor"), rows.drop("anchor")
    near = _met(asking, asked, row_blocks, anchor_blocks, _find_positives(positives), "anchor_id long, positive_id long, positive_score long")
    first = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    best = near.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= positives)
    windows = best.groupBy("anchor_id").agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))
    opened = write_once(asking.join(windows, asking.id == windows.anchor_id).drop("anchor_id"), "score-windows")
    schema = "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"
    far = _met(opened, asked, row_blocks, anchor_blocks, _find_negatives(*percent, negatives), schema)
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    return (
        far.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
