"""Near-duplicate vectors by an epsilon grid order join.

A cosine of at least c between unit vectors is a distance of at most e = sqrt(2 - 2c). Vectors are sorted by their
grid cells (side e) on the leading principal directions and the sequence is cut into blocks with bounding boxes.
Pairs of sequence intervals are joined recursively, from the whole sequence down to blocks, and dropped as soon as
their boxes are farther apart than e. Block pairs that remain are compared in full; inside a block pair, so are
only those stretches whose boxes are near.

Each comparison yields one row per linked vector - how many it is linked with, and the smallest linked vector of
its group in that comparison - so a dense group costs no list of pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textree.llm.components import components
from textree.llm.secret_scan import join_measured
from textree.llm.vectors import matrix, sound_vectors, unit, value_kind
from textree.storage import store

LEADING = 12  # principal directions of the grid
BLOCK = 2048
STRETCH = 128
FAN_OUT = 16  # intervals that make one of the next level
SLACK = 1e-9  # rounding: boxes are taken as near a little beyond e


def principal(classes: DataFrame, kind: str, leading: int) -> np.ndarray:
    """Leading principal directions of all unit vectors. Sums are combined by place; d * d rows come back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0.0
        for batch in batches:
            if batch.num_rows:
                u = unit(matrix(batch.column("values"), kind))
                u = np.hstack([u, np.ones((len(u), 1))])
                total = total + u.T @ u
        if not np.isscalar(total):
            flat = np.asarray(total).ravel()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat)], ["place", "value"])

    sums = classes.select("values").mapInArrow(run, "place long, value double").groupBy("place").agg(F.sum("value").alias("value"))
    got = sums.collect()
    flat = np.zeros(len(got))
    for row in got:
        flat[row["place"]] = row["value"]
    full = flat.reshape(int(len(flat) ** 0.5), -1)
    n, mean = full[-1, -1], full[-1, :-1] / full[-1, -1]
    _, directions = np.linalg.eigh(full[:-1, :-1] / n - np.outer(mean, mean))
    return directions[:, ::-1][:, :leading].copy()


def _boxes(leading: int) -> list[str]:
    return [f"{side}{i}" for side in ("lo", "hi") for i in range(leading)]


def _box_distance(leading: int):
    """Squared distance between the boxes of a pair (columns a_lo0, b_lo0, ...)."""
    total = F.lit(0.0)
    for i in range(leading):
        gap = F.greatest(F.lit(0.0), F.col(f"a_lo{i}") - F.col(f"b_hi{i}"), F.col(f"b_lo{i}") - F.col(f"a_hi{i}"))
        total = total + gap * gap
    return total


def block_pairs(blocks: DataFrame, epsilon: float, leading: int) -> DataFrame:
    """Pairs (a <= b) of block numbers whose boxes are within ``epsilon``, by descent over sequence intervals."""
    limit = epsilon * epsilon + SLACK
    levels = [blocks.select(F.col("number").alias("node"), *_boxes(leading))]
    top = blocks.agg(F.max("number")).first()[0]
    if top is None:
        return blocks.select(F.col("number").alias("a"), F.col("number").alias("b"))
    while top > 0:
        merged = [F.min(x).alias(x) if x.startswith("lo") else F.max(x).alias(x) for x in _boxes(leading)]
        levels.append(levels[-1].groupBy(F.floor(F.col("node") / FAN_OUT).alias("node")).agg(*merged))
        top //= FAN_OUT
    pairs = levels[-1].select(F.col("node").alias("a"), F.col("node").alias("b"))
    for level in reversed(levels[:-1]):
        parent = F.floor(F.col("node") / FAN_OUT)
        left = level.select(parent.alias("a"), F.col("node").alias("x"), *[F.col(c).alias(f"a_{c}") for c in _boxes(leading)])
        right = level.select(parent.alias("b"), F.col("node").alias("y"), *[F.col(c).alias(f"b_{c}") for c in _boxes(leading)])
        near = pairs.join(left, "a").join(right, "b").where((F.col("x") <= F.col("y")) & (_box_distance(leading) <= limit))
        pairs = store(near.select(F.col("x").alias("a"), F.col("y").alias("b")), "grid-pairs").df
    return pairs


def _stretches(low: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    starts = np.arange(0, len(low), STRETCH)
    return starts, np.minimum.reduceat(low, starts), np.maximum.reduceat(low, starts)


def compare(a: np.ndarray, b: np.ndarray | None, low_a: np.ndarray, low_b: np.ndarray | None, cosine: float, epsilon: float):
    """Places (i, j) linked between ``a`` and ``b`` (None: inside ``a``, i < j), stretch by stretch."""
    starts_a, lo_a, hi_a = _stretches(low_a)
    starts_b, lo_b, hi_b = (starts_a, lo_a, hi_a) if b is None else _stretches(low_b)
    for p, start in enumerate(starts_a):
        gap = np.maximum(0, np.maximum(lo_a[p] - hi_b, lo_b - hi_a[p]))
        near = np.flatnonzero((gap * gap).sum(axis=1) <= epsilon * epsilon + SLACK)
        if b is None:
            near = near[near >= p]
        if not len(near):
            continue
        other = a if b is None else b
        columns = np.concatenate([np.arange(starts_b[q], min(starts_b[q] + STRETCH, len(other))) for q in near])
        rows = a[start : start + STRETCH]
        i, j = np.nonzero(rows @ other[columns].T >= cosine)
        i, j = i + start, columns[j]
        if b is None:
            keep = i < j
            i, j = i[keep], j[keep]
        yield i, j


class LocalGroups:
    """Smallest member of each linked group among numbered places, and weighted link counts."""

    def __init__(self, weights: np.ndarray):
        self.weights = weights
        self.links = np.zeros(len(weights), np.int64)
        self.label = np.arange(len(weights))

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        if not len(i):
            return
        np.add.at(self.links, i, self.weights[j])
        np.add.at(self.links, j, self.weights[i])
        while True:  # the smaller root takes the larger one, until both ends of all links agree
            x, y = self.label[i], self.label[j]
            low, high = np.minimum(x, y), np.maximum(x, y)
            if (low == high).all():
                break
            np.minimum.at(self.label, high, low)
            while True:
                deeper = self.label[self.label]
                if (deeper == self.label).all():
                    break
                self.label = deeper


def near_duplicates(
    df: DataFrame,
    cosine: float = 0.95,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    leading: int = LEADING,
    block: int = BLOCK,
) -> DataFrame:
    """vec_id, n_links, component_id, kept for each row: all pairs with a cosine of at least ``cosine`` are links.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing, nor do rows with a
    null id. Equal vectors are one class while joining and count each other as links; repeated ids are one row
    each. Vectors must have one length (others raise an error). An empty table gives an empty table; other columns
    are not read. ``cosine`` is over 0 and at most 1.
    """
    kind, epsilon = value_kind(df, vector_col), (2.0 - 2.0 * cosine) ** 0.5
    rows = store(sound_vectors(df, id_col, vector_col), "grid-vectors").df
    lengths = rows.agg(F.min("size").alias("low"), F.max("size").alias("high")).first()
    if lengths["low"] != lengths["high"]:
        raise ValueError("vectors differ in length")
    grouped = rows.groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("weight"), F.max("values").alias("values"))
    classes = store(grouped, "grid-classes").df
    size = classes.count()
    if size:
        leading = min(leading, lengths["low"])
        axes = principal(classes, kind, leading)
    else:
        axes = np.zeros((0, leading))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cells = np.floor(unit(matrix(batch.column("values"), kind)) @ axes / max(epsilon, 1e-6))
                cells = np.clip(cells, -(2**31), 2**31 - 1).astype(np.int64) + 2**31
                keys = [x.tobytes() for x in cells.astype(">u4")]
                yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in ("first", "weight", "values")), pa.array(keys, pa.binary())], ["first", "weight", "values", "cell"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, number = TaskContext.get().partitionId(), 0
        held: list[tuple] = []

        def flush() -> pa.RecordBatch:
            low = unit(matrix([x[2] for x in held], kind)) @ axes
            columns = [
                [file], [number],
                [np.array([x[0] for x in held], "<i8").tobytes()], [np.array([x[1] for x in held], "<i8").tobytes()],
                [b"".join(x[2] for x in held)],
                *[[x] for x in low.min(axis=0)], *[[x] for x in low.max(axis=0)],
            ]
            return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["file", "part", "firsts", "weights", "values", *_boxes(leading)])

        for batch in batches:
            for row in zip(*(batch.column(x).to_pylist() for x in ("first", "weight", "values")), strict=True):
                held.append(row)
                if len(held) == block:
                    yield flush()
                    held, number = [], number + 1
        if held:
            yield flush()

    celled = classes.mapInArrow(place, "first long, weight long, values binary, cell binary")
    pieces = max(1, -(-size // (16 * block)))
    ordered = celled.repartitionByRange(pieces, "cell", "first").sortWithinPartitions("cell", "first")
    boxes = ", ".join(f"{x} double" for x in _boxes(leading))
    blocks = store(ordered.mapInArrow(cut, f"file long, part long, firsts binary, weights binary, values binary, {boxes}"), "grid-blocks").df
    # number the blocks along the sequence: one row per file
    per_file = blocks.groupBy("file").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))
    offsets = per_file.select("file", F.coalesce(before, F.lit(0)).alias("before"))
    numbered = blocks.join(F.broadcast(offsets), "file").withColumn("number", F.col("before") + F.col("part"))
    pairs = block_pairs(numbered.select("number", *_boxes(leading)), epsilon, leading)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                get = {name: batch.column(name)[row].as_py() for name in batch.schema.names}
                ids_a, weight_a = (np.frombuffer(get[x], "<i8") for x in ("firsts_a", "weights_a"))
                a = unit(np.frombuffer(get["values_a"], kind).reshape(len(ids_a), -1).astype(np.float64))
                if get["a"] == get["b"]:
                    ids, weights, b, shift = ids_a, weight_a, None, 0
                else:
                    ids_b, weight_b = (np.frombuffer(get[x], "<i8") for x in ("firsts_b", "weights_b"))
                    b = unit(np.frombuffer(get["values_b"], kind).reshape(len(ids_b), -1).astype(np.float64))
                    ids, weights, shift = np.r_[ids_a, ids_b], np.r_[weight_a, weight_b], len(ids_a)
                groups = LocalGroups(weights)
                for i, j in compare(a, b, a @ axes, None if b is None else b @ axes, cosine, epsilon):
                    groups.add(i, j + shift)
                linked = np.flatnonzero(groups.links)
                columns = [ids[linked], groups.links[linked], ids[groups.label[linked]]]
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], ["first", "n", "mate"])

    def side(name: str) -> DataFrame:
        return numbered.select(F.col("number").alias(name), *[F.col(x).alias(f"{x}_{name}") for x in ("firsts", "weights", "values")])

    met = pairs.join(side("a"), "a").join(side("b"), "b")
    found = store(met.mapInArrow(join, "first long, n long, mate long"), "grid-links").df
    counts = found.groupBy("first").agg(F.sum("n").alias("n"))
    named = components(found.select(F.col("first").alias("a"), F.col("mate").alias("b"))).df
    by_class = join_measured(classes.select("digest", "first", "weight"), counts, "first", "left")
    by_class = join_measured(by_class, named.withColumnRenamed("node", "first"), "first", "left")
    by_class = by_class.select(
        "digest", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "first").alias("component_id")
    )
    result = join_measured(rows.select("id", "digest"), by_class, "digest").select(F.col("id").alias("vec_id"), "n_links", "component_id")
    others = _left_out(df, id_col, vector_col).select(F.col("id").alias("vec_id"), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    out = result.unionAll(others)
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _left_out(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Ids of the rows that :func:`sound_vectors` passes over."""
    vector = F.col(vector_col)
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    zero = ~F.exists(vector, lambda x: x != 0)
    out = F.col(id_col).isNull() | vector.isNull() | F.coalesce(bad, F.lit(False)) | F.coalesce(zero, F.lit(False))
    return df.where(out).select(F.col(id_col).cast("long").alias("id"))
