"""Approximate nearest neighbours over balanced posting lists.

Centroids come from a bounded sample, split in halves of equal size until the parts are small. They are joined to
a graph in memory; a search walks it from the nearest centroid outwards and stops where centroids are farther than
a ratio of the nearest one's distance. A vector is put into the list of its nearest centroid and, if it lies near a
boundary, into those of the next ones; a query reads all lists within its ratio. Lists hold every vector; long ones
are cut in chunks and scanned whole.
"""

from __future__ import annotations

import functools
import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textree.llm.vectors import matrix, sound_vectors, unit, value_kind
from textree.storage import store


@dataclass(frozen=True)
class Settings:
    """``sample`` bounds what the centroids are fitted on; ``most_lists`` what is held in memory of each worker."""

    sample: int = 16_384
    list_size: int = 512
    most_lists: int = 1024
    replicas: int = 2
    boundary: float = 1.15  # a vector also enters lists up to this ratio of its nearest centroid's distance
    ratio: float = 1.25  # a query reads lists up to this ratio
    least_lists: int = 12  # and at least so many, for where small lists split what lies close together
    chunk: int = 2048  # rows of a list, and queries of a list, that meet in one group


class CentroidGraph:
    """Centroids (unit vectors) with links to their nearest ones and a ring that ties all together."""

    def __init__(self, centroids: np.ndarray, degree: int = 16):
        self.centroids = centroids
        n = len(centroids)
        near = np.argsort(-(centroids @ centroids.T), axis=1, kind="stable")[:, 1 : degree + 1] if n > 1 else np.zeros((1, 0), int)
        links = [set(row.tolist()) | {(i + 1) % n, (i - 1) % n} for i, row in enumerate(near)]
        for i, row in enumerate(near.tolist()):
            for j in row:
                links[j].add(i)
        self.links = [np.array(sorted(x - {i})) for i, x in enumerate(links)]
        self.entries = np.unique(np.linspace(0, n - 1, min(n, 8)).astype(int))

    def search(self, vector: np.ndarray, ratio: float, limit: int | None = None, least_lists: int = 0, beam: int = 24) -> list[int]:
        """Centroids in order of distance: ``least_lists`` and all up to ``ratio`` times the least distance met, ``limit`` at most.

        The walk goes on while fewer than ``beam`` are settled or the next one may still be within the ratio.
        """
        distances = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (self.centroids[self.entries] @ vector)))
        open_ = [(d, int(c)) for d, c in zip(distances.tolist(), self.entries, strict=True)]
        heapq.heapify(open_)
        met = {c for _, c in open_}
        settled: list[tuple[float, int]] = []
        least = open_[0][0]
        while open_:
            distance, at = heapq.heappop(open_)
            if distance > ratio * least and len(settled) >= beam:
                break
            settled.append((distance, at))
            fresh = [c for c in self.links[at].tolist() if c not in met]
            if fresh:
                met.update(fresh)
                for d, c in zip(np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (self.centroids[fresh] @ vector))).tolist(), fresh, strict=True):
                    least = min(least, d)
                    heapq.heappush(open_, (d, c))
        return [c for place, (d, c) in enumerate(sorted(settled)) if d <= ratio * least or place < least_lists][:limit]


def balanced_centroids(rows: np.ndarray, lists: int) -> np.ndarray:
    """Halve the largest part at the median along its two-means axis until there are ``lists`` parts."""
    rng = np.random.default_rng(7)
    parts = [(-len(rows), 0, np.arange(len(rows)))]
    serial = 1
    while len(parts) < lists and -parts[0][0] > 1:
        _, _, part = heapq.heappop(parts)
        x = rows[part]
        ends = x[rng.choice(len(part), 2, replace=False)]
        for _ in range(8):
            order = np.argsort(x @ (ends[0] - ends[1]), kind="stable")
            half = len(part) // 2
            ends = np.stack([x[order[:half]].mean(axis=0), x[order[half:]].mean(axis=0)])[::-1]
        for side in (order[:half], order[half:]):
            heapq.heappush(parts, (-len(side), serial, part[side]))
            serial += 1
    means = np.stack([rows[p].mean(axis=0) for _, _, p in sorted(parts, key=lambda x: x[1])])
    return means / np.maximum(np.linalg.norm(means, axis=1, keepdims=True), 1e-12)


@functools.lru_cache(maxsize=2)
def _graph(raw: bytes, count: int) -> CentroidGraph:
    return CentroidGraph(np.frombuffer(raw, np.float64).reshape(count, -1))


def nearest(
    df: DataFrame,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    query_step: int = 50,
    settings: Settings = Settings(),
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score (cosine): the ``k`` nearest found for each id divisible by ``query_step``.

    Vectors that are null, empty, zero or hold null or non-finite components take no part, nor do null ids. Equal
    vectors are one entry with its ``k + 1`` smallest ids, which is all that a ranking with ties to the smaller id
    can show. A repeated id counts once as a candidate and once as a query for each of its different vectors. With
    fewer than ``k`` candidates all are returned. An empty table gives an empty table; other columns are not read.
    Vectors must have one length (others raise an error).
    """
    kind = value_kind(df, vector_col)
    rows = store(sound_vectors(df, id_col, vector_col), "posting-vectors").df
    known = rows.agg(F.min("size").alias("low"), F.max("size").alias("high"), F.count("*").alias("n")).first()
    if known["low"] != known["high"]:
        raise ValueError("vectors differ in length")
    entries = _entries(rows, k + 1)
    n_lists = max(1, min(settings.most_lists, round(known["n"] / settings.list_size)))
    sample = rows.orderBy(F.xxhash64("digest", "id"), "id").limit(settings.sample).select("values").collect()
    if sample:
        centroids = balanced_centroids(unit(matrix([bytes(x["values"]) for x in sample], kind)), n_lists)
    else:
        centroids = np.ones((1, 1))
    raw, count = np.ascontiguousarray(centroids).tobytes(), len(centroids)

    def assign(ratio: float, limit: int | None, least_lists: int, names: list[str]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            graph = _graph(raw, count)
            for batch in batches:
                if not batch.num_rows:
                    continue
                found = [graph.search(x, ratio, limit, least_lists) for x in unit(matrix(batch.column("values"), kind))]
                at = pa.array(np.repeat(np.arange(len(found)), [len(x) for x in found]))
                lists = pa.array([c for x in found for c in x], pa.int32())
                yield pa.RecordBatch.from_arrays([lists, *(batch.column(x).take(at) for x in names)], ["list", *names])

        return run

    postings = entries.mapInArrow(assign(settings.boundary, settings.replicas, 0, ["digest", "ids", "values"]), "list int, digest binary, ids array<long>, values binary")
    postings = store(postings, "posting-lists").df
    # equal query vectors are searched once; their ids come back at the end
    asking = store(rows.where(F.col("id") % query_step == 0).select("id", "digest", "values").dropDuplicates(["id", "digest"]), "posting-asking").df
    asked = asking.dropDuplicates(["digest"]).select("digest", "values")
    asked = asked.mapInArrow(assign(settings.ratio, None, settings.least_lists, ["digest", "values"]), "list int, digest binary, values binary")
    asked = store(asked, "posting-queries").df

    # long lists and long lines of queries are cut; every chunk of the one meets every chunk of the other
    def chunks(table: DataFrame, name: str) -> DataFrame:
        return table.groupBy("list").agg(F.ceil(F.count("*") / settings.chunk).cast("int").alias(name))

    cuts = chunks(postings, "p").join(chunks(asked, "q"), "list")

    def dealt(table: DataFrame, own: str, other: str) -> DataFrame:
        sized = table.join(F.broadcast(cuts), "list")
        mine = F.pmod(F.xxhash64("digest"), F.col(own)).cast("int").alias(f"{own}_chunk")
        theirs = F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(f"{other}_chunk")
        return sized.select(*table.columns, mine, theirs)

    def scan(key, left: pa.Table, right: pa.Table) -> pa.Table:
        columns: list[list] = [[], [], []]
        if left.num_rows and right.num_rows:
            ids = left.column("ids").to_pylist()
            vectors = matrix(left.column("values").combine_chunks(), kind)
            vectors = unit(vectors)
            queries = unit(matrix(right.column("values").combine_chunks(), kind))
            digests = right.column("digest").to_pylist()
            most = min(k + 1, len(ids))
            for start in range(0, len(queries), 256):
                scores = queries[start : start + 256] @ vectors.T
                best = np.argpartition(-scores, most - 1, axis=1)[:, :most]
                for row, chosen in enumerate(best):
                    # all that tie with the last one, so that the smaller id can win
                    tied = np.flatnonzero(scores[row] >= scores[row, chosen].min() - 1e-12)
                    exact = (vectors[tied] * queries[start + row]).sum(axis=1)
                    offered = sorted((-s, i) for s, t in zip(exact.tolist(), tied, strict=True) for i in ids[t])
                    for s, i in offered[: k + 1]:
                        columns[0].append(digests[start + row])
                        columns[1].append(i)
                        columns[2].append(-s)
        kinds = (pa.binary(), pa.int64(), pa.float64())
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["digest", "vec_id", "score"])

    keys = ["list", "p_chunk", "q_chunk"]
    left, right = dealt(postings, "p", "q").groupBy(*keys), dealt(asked, "q", "p").groupBy(*keys)
    found = left.cogroup(right).applyInArrow(scan, "digest binary, vec_id long, score double")
    found = found.groupBy("digest", "vec_id").agg(F.max("score").alias("score"))
    first = Window.partitionBy("digest").orderBy(F.desc("score"), "vec_id")
    # one more than asked for, since a query is its own nearest
    found = found.withColumn("place", F.row_number().over(first)).where(F.col("place") <= k + 1).drop("place")
    answers = found.groupBy("digest").agg(F.collect_list(F.struct("vec_id", "score")).alias("answers"))
    own = asking.select(F.col("id").alias("query_id"), "digest").join(answers, "digest").select("query_id", "digest", F.inline("answers")).where("vec_id != query_id")
    order = Window.partitionBy("query_id", "digest").orderBy(F.desc("score"), "vec_id")
    ranked = own.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _entries(rows: DataFrame, most: int) -> DataFrame:
    """One row per vector: digest, values and its ``most`` smallest ids. The rank limit already holds before the
    shuffle, so a vector with many copies sends few rows."""
    place = F.row_number().over(Window.partitionBy("digest").orderBy("id"))
    first = rows.dropDuplicates(["digest", "id"]).withColumn("place", place).where(F.col("place") <= most)
    return first.groupBy("digest").agg(F.max("values").alias("values"), F.sort_array(F.collect_list("id")).alias("ids"))
