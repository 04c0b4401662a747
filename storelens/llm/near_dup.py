"""Near duplicates by SetSketch registers: band, estimate jointly, verify on full sets.

A text's set is its distinct five-word shingles. Each of 384 registers of a SetSketch holds the
truncated exponent of the smallest of exponentially distributed shingle values; sketches of parts
merge by the larger register, and two sketches agree in a register with a probability close to the
Jaccard similarity of the sets.

1. One pass over the texts makes sketches and a digest of the set. Texts with one digest are a class;
   from here on only one row per class counts, so thousands of copies cost one row.
2. Classes that agree in all registers of a band are candidates: 48 bands of eight registers at a
   threshold of 0.85, 64 of six at 0.8, so that a pair at the threshold shares no band at most once in
   a million. Each bucket hangs its members on its smallest
   one; the components of these links are clusters.
3. Inside a cluster pairs are compared in groups of bounded weight. A pair already connected is
   skipped; for the others the closed-form likelihood estimate of the similarity from both sketches
   and both set sizes sifts (six standard errors below the threshold), and the full sets decide.
   A group hands out a spanning forest of its links, at most one row per member, never all pairs.
   A cluster of ordinary weight is one group. A heavier one is cut at random into blocks: first each
   block meets itself and the first block, whose members serve as hubs; then the members that are not
   in the cluster's largest component so far meet all other blocks. No pair that may be a link is left out.
4. The components of the links give each class, and so each document, its smallest reachable id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from storelens.llm.bloom import parted, sift
from storelens.llm.components import components
from storelens.llm.shared import apart, column, only, plain_key, tidy, write_once
from storelens.llm.words import NOT_BLANK, U64, Words, constants, gram_hashes, mix, slices, text_bytes

SHINGLE = 5
REGISTERS = 384
# Registers per band that may be taken, and how often a pair at the threshold may share no band.
BAND_ROWS, MISSED = (8, 6, 4), 1e-6
# Base, rate and largest value of the registers: two bytes each, base close to one.
SKETCH_BASE, SKETCH_RATE, SKETCH_TOP = 1.001, 20.0, 65535
# A block of a cluster holds about so many shingles, a member counting as MEMBER more.
BLOCK, MEMBER = 300_000, 200

_FACTORS = (constants(REGISTERS, 404) >> U64(32)).astype(np.uint32) | np.uint32(1)
_SHIFTS = (constants(REGISTERS, 505) >> U64(32)).astype(np.uint32)
_BAND_FACTORS = constants(max(BAND_ROWS), 606)
_BAND_SALTS = constants(REGISTERS, 707)


def shingle_sets(words: Words) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its shingles; the whole sequence where it is shorter."""
    hashes = words.hashes()
    grams = gram_hashes(hashes, SHINGLE)
    sets = []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if b - a >= SHINGLE:
            sets.append(np.unique(grams[a:b - SHINGLE + 1]))
        else:
            sets.append(gram_hashes(hashes[a:b], b - a) if b > a else np.empty(0, U64))
    return sets


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """The registers of each set, one row per set (zeros for an empty set)."""
    lowest = np.full((len(sets), REGISTERS), 0xFFFFFFFF, np.uint32)
    for row, members in zip(lowest, sets):
        values = (mix(members) >> U64(32)).astype(np.uint32)
        for at in range(0, len(values), 512):
            part = values[at:at + 512, None] * _FACTORS
            part += _SHIFTS
            np.minimum(row, part.min(axis=0), out=row)
    # The smallest of uniform values, as the smallest of exponential ones, as its truncated exponent.
    smallest = -np.log1p(-(lowest + 0.5) / 2.0 ** 32) / SKETCH_RATE
    registers = np.floor(1.0 - np.log(smallest) / np.log(SKETCH_BASE))
    registers = np.clip(registers, 0, SKETCH_TOP).astype(np.uint16)
    registers[np.array([len(s) == 0 for s in sets], bool)] = 0
    return registers


def rows_per_band(percent: int) -> int:
    """The longest band with which a pair at the threshold is missed by all bands at most once in a million."""
    chance = percent / 100
    return next((r for r in BAND_ROWS if (1 - chance ** r) ** (REGISTERS // r) <= MISSED), BAND_ROWS[-1])


def band_keys(registers: np.ndarray, rows: int) -> np.ndarray:
    """One hash per text and band of ``rows`` registers."""
    parts = registers.reshape(len(registers), REGISTERS // rows, rows).astype(U64)
    total = np.broadcast_to(_BAND_SALTS[:REGISTERS // rows], parts.shape[:2]).copy()
    for k in range(rows):
        total = mix(total + parts[:, :, k] * _BAND_FACTORS[k])
    return total


def joint_estimate(equal, above, below, u, v):
    """The similarity that makes the counts of equal, higher and lower registers likeliest.

    ``u`` and ``v`` are the shares of the two set sizes. With a base close to one the likelihood is
    above*log(u - v*J) + below*log(v - u*J) + equal*log(J); its maximum is the smaller root below.
    """
    square = u * v * (equal + above + below)
    linear = equal * (u * u + v * v) + v * v * above + u * u * below
    rest = np.maximum(linear * linear - 4 * square * equal * u * v, 0.0)
    return (linear - np.sqrt(rest)) / (2 * square)


def _sketch(rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            sizes, digests, bands = [], [], []
            for lo, hi in slices(offsets):
                at = offsets[lo:hi + 1]
                sets = shingle_sets(Words(data[at[0]:at[-1]], at - at[0], NOT_BLANK, lower=True))
                sizes += [len(s) for s in sets]
                # Sums over the set, so neither order nor repetition counts.
                digests += [(int(mix(s ^ U64(7)).sum()), int(mix(s ^ U64(11)).sum())) for s in sets]
                keys = band_keys(sketches(sets), rows).view(np.int64)
                bands += [k if len(s) else None for k, s in zip(keys, sets)]
            digests = np.array(digests, U64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests[:, 0]), pa.array(digests[:, 1]),
                 pa.array(bands, pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "hi", "lo", "bands"],
            )

    return run


def _linked(ids: np.ndarray, side: np.ndarray, label: np.ndarray, texts: pa.ChunkedArray, percent: int, across: bool) -> list[tuple[int, int]]:
    """A spanning forest of the links among these members; equal labels are connected already.

    With ``across`` only the two sides meet; else all pairs but those within side 0 beside a side 1.
    """
    data, offsets = text_bytes(texts)
    sets: list[np.ndarray] = []
    for lo, hi in slices(offsets):
        at = offsets[lo:hi + 1]
        sets += shingle_sets(Words(data[at[0]:at[-1]], at - at[0], NOT_BLANK, lower=True))
    registers = sketches(sets)
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    known, dense = np.unique(np.concatenate(sets), return_inverse=True)
    dense = np.split(dense, np.cumsum(sizes)[:-1])
    threshold = percent / 100
    floor = threshold - 6 * np.sqrt(threshold * (1 - threshold) / REGISTERS)
    mask = np.zeros(len(known), bool)
    group = label.copy()
    hubs_met = side.max() == 1
    links = []
    for i in range(len(ids)):
        others = np.arange(i + 1, len(ids))
        keep = group[others] != group[i]
        if across:
            keep &= side[others] != side[i]
        elif hubs_met and side[i] == 0:
            keep &= side[others] == 1
        keep &= 100 * np.minimum(sizes[others], sizes[i]) >= percent * np.maximum(sizes[others], sizes[i])
        others = others[keep]
        if not len(others):
            continue
        equal = (registers[others] == registers[i]).sum(axis=1)
        above = (registers[others] < registers[i]).sum(axis=1)
        share = sizes[i] / (sizes[i] + sizes[others])
        estimate = joint_estimate(equal, above, REGISTERS - equal - above, share, 1 - share)
        others = others[estimate >= floor]
        if not len(others):
            continue
        mask[dense[i]] = True
        for j in others.tolist():
            if group[j] == group[i]:
                continue
            both = int(np.count_nonzero(mask[dense[j]]))
            if 100 * both >= percent * (int(sizes[i]) + int(sizes[j]) - both):
                links.append((int(ids[i]), int(ids[j])))
                group[group == group[j]] = group[i]
        mask[dense[i]] = False
    return links


def _verify(percent: int, across: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by group; a group is gathered across batches and compared as a whole."""
        current, held = None, []

        def flush():
            if not held:
                return []
            ids, side, label = (np.concatenate([h[k] for h in held]) for k in range(3))
            if len(ids) < 2:
                return []
            return _linked(ids, side, label, pa.chunked_array([h[3] for h in held]), percent, across)

        def made(links):
            return pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in links], pa.int64()), pa.array([x[1] for x in links], pa.int64())], names=["a", "b"]
            )

        for batch in batches:
            columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(6)]
            keys = np.stack(columns[:3], axis=1)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            found = []
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)]):
                if b == a:
                    continue
                if current != tuple(keys[a].tolist()):
                    found += flush()
                    current, held = tuple(keys[a].tolist()), []
                held.append((columns[3][a:b], columns[4][a:b], columns[5][a:b], batch.column(6).slice(a, b - a)))
            yield made(found)
        yield made(flush())

    return run


def _compared(groups: DataFrame, texts: DataFrame, percent: int, across: bool) -> DataFrame:
    """``a, b``: the links found in ``groups(cluster, x, y, node, side, label)``; members alone travel, not pairs."""
    rows = groups.join(texts, "node").select("cluster", "x", "y", "node", F.col("side").cast("long").alias("side"), "label", "text")
    key = ["cluster", "x", "y"]
    sorted_rows = rows.repartition(*key).sortWithinPartitions(*key, "side", "node")
    return write_once(sorted_rows.mapInArrow(tidy(_verify(percent, across)), "a long, b long"), "near-links")


def _links(clusters: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """``a, b``: links that connect all linked members of ``clusters(cluster, node, n_shingles)``."""
    weight = F.col("n_shingles") + MEMBER
    parts = clusters.groupBy("cluster").agg(F.ceil(F.sum(weight) / BLOCK).cast("int").alias("parts"))
    cut = write_once(clusters.join(plain_key(parts, "cluster"), "cluster").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")), "cut")
    # The first block meets every block; another one meets itself and the first.
    meets = F.when(F.col("part") == 0, F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array("part"))
    first = cut.select("cluster", F.lit(0).alias("x"), F.explode(meets).alias("y"), "node", (F.col("part") > 0).cast("long").alias("side"),
                       F.col("node").alias("label"))
    links = _compared(first, texts, percent, across=False)
    heavy = cut.where("parts > 2")
    if heavy.isEmpty():
        return links
    # What is not in the largest component of a heavy cluster meets the blocks it has not met.
    labelled = write_once(
        heavy.join(components(links, "a", "b"), "node", "left").withColumn("label", F.coalesce("root", "node")).drop("root"), "labelled"
    )
    largest = labelled.groupBy("cluster", "label").agg(F.count("*").alias("n")).groupBy("cluster").agg(
        F.max_by("label", F.struct("n", "label")).alias("largest"))
    outside = labelled.join(plain_key(largest, "cluster"), "cluster").where("label <> largest").drop("largest")
    spread = outside.groupBy("cluster").agg(F.ceil(F.sum(weight) / BLOCK).cast("int").alias("shares"))
    askers = plain_key(outside, "cluster").join(plain_key(spread, "cluster"), "cluster").select(
        "cluster", F.pmod(F.xxhash64("node", F.lit(1)), F.col("shares")).cast("int").alias("x"),
        F.explode(F.sequence(F.lit(1), F.col("parts") - 1)).alias("y"), "node", F.lit(0).cast("long").alias("side"), "label")
    asked = labelled.where("part > 0").join(plain_key(spread, "cluster"), "cluster").select(
        "cluster", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("x"), F.col("part").alias("y"), "node", F.lit(1).cast("long").alias("side"), "label")
    return links.unionByName(_compared(askers.unionByName(asked), texts, percent, across=True))


def near_duplicates(docs: DataFrame, percent: int = 85, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``.

    Words are runs of non-blank characters after lower-casing A-Z. Two documents are linked when 100
    times the shingles they share is at least ``percent`` times those of both; ``component_id`` is the
    smallest id reachable over links, ``kept`` says that the document is that one. Null or empty texts, and texts without a word, have an empty
    set and stand alone. Rows without an id have no component and are kept. Rows that share an id are
    one document to the links; equal rows get equal results. Other columns are ignored.
    """
    texts = only(docs, [id_column, text_column]).toDF("doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    sketched = write_once(
        texts.mapInArrow(tidy(_sketch(rows_per_band(percent))), "doc_id long, n_shingles long, hi long, lo long, bands array<long>"), "sketches"
    )
    some = sketched.where("n_shingles > 0 and doc_id is not null")
    classes = write_once(
        some.groupBy("hi", "lo").agg(F.min("doc_id").alias("node"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands")),
        "classes",
    )
    keys = classes.select("node", F.explode("bands").alias("band"))
    hubs = write_once(
        keys.groupBy("band").agg(F.min("node").alias("hub"), F.max("node").alias("last")).where("hub < last").select("band", "hub"), "hubs"
    )
    # Most buckets hold one class, most classes no near one: both are sifted out before they are shuffled.
    near = sift(keys, F.col("band"), hubs, "band").join(hubs, "band").where("node != hub").select("node", "hub").distinct()
    clusters = components(near, "node", "hub").withColumnRenamed("root", "cluster")
    clusters = write_once(classes.select("node", "n_shingles").join(clusters, "node"), "clusters")
    members = clusters.select(F.xxhash64("node").alias("hash"))
    near_texts = sift(texts.where("doc_id is not null"), F.xxhash64("doc_id"), members, "hash").withColumnRenamed("doc_id", "node")
    links = _links(clusters, near_texts, percent)
    found = components(links, "a", "b")
    root = classes.join(found, "node", "left").select("hi", "lo", F.coalesce("root", "node").alias("root"))
    lone = F.when(F.col("n_shingles") > 0, F.col("root")).otherwise(F.col("doc_id"))
    return (
        sketched.select("doc_id", "n_shingles", "hi", "lo").join(root, ["hi", "lo"], "left")
        .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), lone).alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def one_of_each(docs: DataFrame, percent: int = 80, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` with one document of each component, all columns kept.

    The document with the component's id stays. Of rows that share an id and a text one stays, the one whose
    columns have the smallest hash; another text under the id is another document and stays if the id does.
    Rows without an id all stay. Only rows that may have to go are shuffled: a Bloom filter of their
    ids sends the others straight on.
    """
    key = column(id_column).cast("long")
    judged = write_once(near_duplicates(docs, percent, id_column, text_column).where("doc_id is not null"), "judged")
    gone = judged.where("not kept").select("doc_id").distinct()
    twice = judged.where("kept").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id")
    special = write_once(gone.withColumn("stays", F.lit(False)).unionByName(twice.withColumn("stays", F.lit(True))), "special")
    passed, held = parted(docs, F.xxhash64(key), special.select(F.xxhash64("doc_id").alias("hash")), "hash")
    mine, found, stays, place = (apart(docs, f"_{n}") for n in ("mine", "found", "stays", "place"))
    marks = special.select(F.col("doc_id").alias(found), F.col("stays").alias(stays))
    marked = held.withColumn(mine, key).join(marks, F.col(mine) == F.col(found), "left")
    alone = marked.where(F.col(found).isNull())
    order = Window.partitionBy(mine, column(text_column)).orderBy(F.xxhash64(*[column(c) for c in docs.columns]))
    first = marked.where(F.col(stays)).withColumn(place, F.row_number().over(order)).where(F.col(place) == 1).drop(place)
    return passed.unionByName(alone.unionByName(first).select(*[column(c) for c in docs.columns]))
