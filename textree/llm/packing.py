"""Conflict-constrained best-fit packing.

Items are dealt evenly over the partitions and packed in shards of bounded size, longest first. A shard's open
bins are ordered by what they have left; each carries one bit per source and one per duplicate cluster it
holds. For an item the search starts at the first bin that is large enough and goes on to its successors until
one shares neither the source nor the cluster: the tightest compatible bin.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHARD_ITEMS = 4096
PACKED = pa.schema([
    ("doc_id", pa.int64()), ("piece", pa.int32()), ("n_tokens", pa.int64()),
    ("shard", pa.int64()), ("bin", pa.int32()), ("bin_start", pa.int64()),
    ("source", pa.string()), ("cluster", pa.int64()),
])
PACKED_SQL = "doc_id long, piece int, n_tokens long, shard long, bin int, bin_start long, source string, cluster long"


def best_fit(lengths: list[int], sources: list, clusters: list, capacity: int) -> list[tuple[int, int]]:
    """(bin, start in the bin) of each item, in the given order; lengths are 1 to ``capacity``.

    A null source or cluster conflicts with nothing.
    """
    source_bit = {x: 1 << i for i, x in enumerate(dict.fromkeys(x for x in sources if x is not None))}
    counts: dict = {}
    for x in clusters:
        counts[x] = counts.get(x, 0) + 1
    # a cluster met once in the shard cannot conflict and needs no bit
    shared = [x for x, n in counts.items() if n > 1 and x is not None]
    cluster_bit = {x: 1 << (i + len(source_bit)) for i, x in enumerate(shared)}
    least = min(lengths, default=0)
    masks: list[int] = []
    open_bins: list[tuple[int, int]] = []  # (left, bin)
    placed = []
    for length, source, cluster in zip(lengths, sources, clusters, strict=True):
        bits = source_bit.get(source, 0) | cluster_bit.get(cluster, 0)
        at = bisect_left(open_bins, (length, -1))
        while at < len(open_bins) and masks[open_bins[at][1]] & bits:
            at += 1
        if at < len(open_bins):
            left, number = open_bins.pop(at)
        else:
            left, number = capacity, len(masks)
            masks.append(0)
        placed.append((number, capacity - left))
        masks[number] |= bits
        if left - length >= least:
            insort(open_bins, (left - length, number))
    return placed


def pack_shard(rows: dict[str, list], capacity: int, shard: int) -> pa.RecordBatch:
    """Cut long documents at the capacity, then pack all pieces, longest first (ties: doc_id, piece)."""
    pieces = []
    for doc_id, n, source, cluster in zip(rows["doc_id"], rows["n_tokens"], rows["source"], rows["cluster"], strict=True):
        n = n or 0
        for piece in range(max(1, -(-n // capacity))):
            pieces.append((min(capacity, n - piece * capacity), doc_id, piece, source, cluster))
    pieces.sort(key=lambda x: (-x[0], x[1] is not None, x[1] or 0, x[2]))
    full = [x for x in pieces if x[0] > 0]
    placed = best_fit([x[0] for x in full], [x[3] for x in full], [x[4] for x in full], capacity)
    bins = [b for b, _ in placed] + [None] * (len(pieces) - len(full))
    starts = [s for _, s in placed] + [None] * (len(pieces) - len(full))
    n, ids, piece, source, cluster = (list(x) for x in zip(*pieces, strict=True))
    columns = [ids, piece, n, [shard] * len(n), bins, starts, source, cluster]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, PACKED, strict=True)], schema=PACKED)


def pack(items: DataFrame, capacity: int = 2048, shard_items: int = SHARD_ITEMS) -> DataFrame:
    """Pack ``items`` (doc_id, n_tokens, source, cluster) into bins of ``capacity``.

    One row per piece: doc_id, piece (from 0), n_tokens, shard, bin (number in the shard), bin_start, source,
    cluster. A document longer than a bin is cut into full pieces and a rest. No two pieces in a bin share a
    source or a cluster; null sources and clusters conflict with nothing. Documents without tokens (0 or null)
    keep a row with bin null. Repeated rows and null ids are packed like others. An empty table gives an empty
    table. Rows are dealt round robin, so no source, cluster or input order fills one task, and in an order
    by hash inside each partition, so a retried task packs alike; a task holds one shard.
    """
    spark = items.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition = TaskContext.get().partitionId()
        held: list[pa.RecordBatch] = []
        count = shard = 0

        def flush(batch: pa.RecordBatch) -> pa.RecordBatch:
            return pack_shard(batch.to_pydict(), capacity, (partition << 32) | shard)

        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, shard_items - count)
                held.append(part)
                at, count = at + part.num_rows, count + part.num_rows
                if count == shard_items:
                    yield flush(pa.concat_batches(held))
                    held, count, shard = [], 0, shard + 1
        if held:
            yield flush(pa.concat_batches(held))

    rows = items.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("n_tokens").cast("long").alias("n_tokens"),
        F.col("source").cast("string").alias("source"), F.col("cluster").cast("long").alias("cluster"),
    )
    dealt = rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    ordered = dealt.sortWithinPartitions(F.xxhash64("doc_id", "n_tokens", "source", "cluster"), "doc_id", "n_tokens")
    return ordered.mapInArrow(run, PACKED_SQL)
