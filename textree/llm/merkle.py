"""Merkle manifest of a table: leaves per group in id order, runs of 16 hashed level by level to one root.

Where a leaf stands is a rank query. Ids go into bitmaps of 65,536 ids, one per group and bucket (short lists where
few ids are set), made inside each task and merged by bucket; a directory of counts over buckets, buckets of buckets
and so on gives the rows before a bucket, popcounts the ids before an id inside it. No group is sorted or numbered
as a whole. Every level is then one aggregation keyed by (group, place / 16) into an array of 16 slots.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textree.llm.secret_scan import join_measured
from textree.operators.features import add_row_id
from textree.storage import store

FANOUT = 16
BUCKET = 1 << 16  # ids of one bitmap
PART_ROWS = 1 << 16  # rows of a bucket that are ranked in one group; beyond twice as many it is dealt to several
HELD_IDS = 2_000_000  # ids a task gathers before it writes its bitmaps
BITMAP = "g string, high long, bits binary, repeated binary, more binary"
PATH = "array<struct<slot:int,run:array<string>>>"
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def digest(columns: Sequence[Column]) -> Column:
    """Hex sha256 of the values: ``-`` for null, else UTF-8 byte count, ``:`` and the value (numbers in decimal)."""
    return F.sha2(F.concat(*[field(c) for c in columns]), 256)


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def lowered(text: Column) -> Column:
    return F.translate(text, LETTERS, LETTERS.lower())


# --- bitmaps -----------------------------------------------------------------------------------------


def packed(lows: np.ndarray) -> bytes:
    """Sorted distinct places 0..65535: a list of 16-bit numbers while that is shorter than 8,192 bytes of bits."""
    if len(lows) < BUCKET // 16:
        return lows.astype("<u2").tobytes()
    bits = np.zeros(BUCKET, np.uint8)
    bits[lows] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def members(bits: bytes) -> np.ndarray:
    if len(bits) < BUCKET // 8:
        return np.frombuffer(bits, "<u2").astype(np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little"))


class RankDirectory:
    """Answers how many rows of a bucket have a smaller place: popcounts of the ids and the copies beyond the first."""

    def __init__(self, bits: bytes, repeated: bytes, more: bytes):
        self.list = members(bits) if len(bits) < BUCKET // 8 else None
        if self.list is None:
            self.words = np.frombuffer(bits, "<u8")
            self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words).astype(np.int64))))
        self.repeated = np.frombuffer(repeated, "<u2").astype(np.int64)
        self.copies = np.concatenate(([0], np.cumsum(np.frombuffer(more, "<i8"))))

    def rank(self, lows: np.ndarray) -> np.ndarray:
        if self.list is not None:
            ids = np.searchsorted(self.list, lows)
        else:
            word, bit = lows >> 6, (lows & 63).astype(np.uint64)
            below = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
            ids = self.before[word] + np.bitwise_count(below).astype(np.int64)
        return ids + self.copies[np.searchsorted(self.repeated, lows)]

    def is_repeated(self, lows: np.ndarray) -> np.ndarray:
        return np.isin(lows, self.repeated)


def _bitmap_row(counts: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """Bitmap, places that are held more than once, and how often beyond the first time."""
    lows = np.flatnonzero(counts)
    again = lows[counts[lows] > 1]
    return packed(lows), again.astype("<u2").tobytes(), (counts[again] - 1).astype("<i8").tobytes()


def _task_bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bitmaps of the ids of one task, by group and bucket."""
    held: dict[tuple[str, int], list[np.ndarray]] = {}
    size = 0

    def made() -> pa.RecordBatch:
        rows = [(g, high, *_bitmap_row(np.bincount(np.concatenate(parts), minlength=BUCKET))) for (g, high), parts in held.items()]
        held.clear()
        kinds = (pa.string(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["g", "high", "bits", "repeated", "more"])

    for batch in batches:
        if not batch.num_rows:
            continue
        groups = pc.dictionary_encode(batch.column("g"))
        codes, ids = groups.indices.to_numpy(), batch.column("id").to_numpy()
        high = ids >> 16
        order = np.lexsort((high, codes))
        codes, high, low = codes[order], high[order], (ids & (BUCKET - 1))[order]
        starts = np.flatnonzero(np.r_[True, (codes[1:] != codes[:-1]) | (high[1:] != high[:-1])])
        for start, end in zip(starts.tolist(), [*starts[1:].tolist(), len(low)], strict=True):
            key = (groups.dictionary[int(codes[start])].as_py(), int(high[start]))
            held.setdefault(key, []).append(low[start:end])
        size += len(ids)
        if size >= HELD_IDS:
            yield made()
            size = 0
    if held:
        yield made()


def _merged(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All bitmaps of one bucket as one; they stream through 65,536 counters."""
    counts = np.zeros(BUCKET, np.int64)
    for batch in batches:
        for bits, repeated, more in zip(*(batch.column(x).to_pylist() for x in ("bits", "repeated", "more")), strict=True):
            counts[members(bits)] += 1
            counts[np.frombuffer(repeated, "<u2")] += np.frombuffer(more, "<i8")
    columns = [[key[0].as_py()], [key[1].as_py()], *([x] for x in _bitmap_row(counts)), [int(counts.sum())]]
    kinds = (pa.string(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int64())
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["g", "high", "bits", "repeated", "more", "n"])


def with_directory(buckets: DataFrame) -> DataFrame:
    """``before``: rows of the group in smaller buckets. No window has more than 65,536 rows, whatever the ids."""
    one, two = F.shiftright("high", 16).alias("one"), F.shiftright("high", 32).alias("two")

    def running(by: list[str], order: str) -> Column:
        frame = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("n").over(frame), F.lit(0))

    sized = buckets.select("g", "high", one, two, "n")
    top = sized.groupBy("g", "two").agg(F.sum("n").alias("n")).select("g", "two", running(["g"], "two").alias("before_two"))
    middle = sized.groupBy("g", "two", "one").agg(F.sum("n").alias("n")).withColumn("inside", running(["g", "two"], "one"))
    middle = middle.join(top, ["g", "two"]).select("g", "one", (F.col("before_two") + F.col("inside")).alias("before_one"))
    placed = buckets.withColumn("one", one).withColumn("inside", running(["g", "one"], "high")).join(middle, ["g", "one"])
    return placed.select(*buckets.columns, (F.col("before_one") + F.col("inside")).alias("before"))


def _ranked(key, rows: pa.Table, bitmap: pa.Table) -> pa.Table:
    """The place of every row of one bucket (or of one salted part of it)."""
    kinds = {"place": pa.int64(), "again": pa.bool_()}
    if not rows.num_rows:
        return pa.table({**{x: rows.column(x) for x in ("g", "id", "serial", "leaf", "other")}, **{x: pa.array([], t) for x, t in kinds.items()}})
    entry = bitmap.to_pylist()[0]
    directory = RankDirectory(entry["bits"], entry["repeated"], entry["more"])
    lows = rows.column("id").to_numpy() & (BUCKET - 1)
    out = rows.select(["g", "id", "serial", "leaf", "other"])
    return out.append_column("place", pa.array(entry["before"] + directory.rank(lows))).append_column("again", pa.array(directory.is_repeated(lows)))


def places(leaves: DataFrame) -> DataFrame:
    """(g, id, serial, leaf, other) with the place (from 0) of each row in its group: null ids first, then by id;
    rows that share an id by leaf. Every row gets a place of its own.
    """
    known = leaves.where("id IS NOT NULL")
    parts = known.select("g", "id").mapInArrow(_task_bitmaps, BITMAP)
    merged = parts.groupBy("g", "high").applyInArrow(_merged, BITMAP + ", n long")
    buckets = store(with_directory(store(merged, "merkle-bitmaps").df), "merkle-directory").df
    # ids that repeat may fill a bucket beyond its 65,536 ids: its rows are dealt to several parts
    cuts = buckets.where(F.col("n") > 2 * PART_ROWS).select("g", "high", F.ceil(F.col("n") / PART_ROWS).cast("int").alias("cuts"))
    rows = join_measured(known.withColumn("high", F.shiftright("id", 16)), cuts, ["g", "high"], "left")
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("serial"), F.coalesce("cuts", F.lit(1))).cast("int"))
    maps = buckets.join(cuts, ["g", "high"], "left").withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("cuts", F.lit(1)) - 1)))
    keys = ["g", "high", "salt"]
    rows = rows.select(*keys, "id", "serial", "leaf", "other").groupBy(*keys)
    maps = maps.select(*keys, "bits", "repeated", "more", "before").groupBy(*keys)
    schema = "g string, id long, serial long, leaf string, other string, place long, again boolean"
    ranked = rows.cogroup(maps).applyInArrow(_ranked, schema)
    unknown = leaves.where("id IS NULL").select("g", "id", "serial", "leaf", "other", F.lit(0).cast("long").alias("place"), F.lit(True).alias("again"))
    ranked = store(ranked.unionAll(unknown), "merkle-ranked").df
    again = ranked.where("again")
    if again.isEmpty():
        return ranked.drop("again")
    numbered = store(add_row_id(again, ["g", "id", "leaf", "serial"], "number"), "merkle-again").df
    first = numbered.groupBy("g", "id").agg(F.min("number").alias("first")).withColumnsRenamed({"g": "_g", "id": "_id"})
    here = (F.col("g") == F.col("_g")) & F.col("id").eqNullSafe(F.col("_id"))
    moved = join_measured(numbered, store(first, "merkle-first").df, here).withColumn("place", F.col("place") + F.col("number") - F.col("first"))
    nulls = moved.where("id IS NULL").groupBy("g").agg(F.count("*").alias("shift"))
    whole = ranked.where("NOT again").drop("again").unionByName(moved.select("g", "id", "serial", "leaf", "other", "place"))
    shifted = join_measured(whole, store(nulls, "merkle-nulls").df, "g", "left")
    place = F.col("place") + F.when(F.col("id").isNull(), 0).otherwise(F.coalesce("shift", F.lit(0)))
    return shifted.select("g", "id", "serial", "leaf", "other", place.cast("long").alias("place"))


# --- levels --------------------------------------------------------------------------------------------


def climb(nodes: DataFrame, largest: int) -> tuple[DataFrame, DataFrame]:
    """From (g, place, n, digest, item), ``n`` nodes in each group: rows (g, item, digest, ``path``) and tops (g, top).

    ``path`` lists, from the bottom, the slot a node's ancestor has in its run and the digests of that run. A group
    of one node is its own top, with an empty path.
    """
    levels, now = [], nodes
    while True:
        levels.append((now.where("n = 1"), None))
        if largest <= 1:
            break
        slot = F.pmod("place", F.lit(FANOUT)).cast("int").alias("slot")
        fields = [slot, F.col("digest").alias("digest")] + ([F.col("item").alias("item")] if "item" in now.columns else [])
        run = F.floor(F.col("place") / FANOUT).cast("long").alias("run")
        runs = now.where("n > 1").groupBy("g", "n", run).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("slots"))
        runs = store(runs, "merkle-runs").df
        levels[-1] = (levels[-1][0], runs)
        up = F.sha2(F.concat_ws("", "slots.digest"), 256).alias("digest")
        now = runs.select("g", F.col("run").alias("place"), F.ceil(F.col("n") / FANOUT).cast("long").alias("n"), up)
        largest = -(-largest // FANOUT)
    ends = reduce(DataFrame.unionAll, [tops.select("g", F.col("digest").alias("top")) for tops, _ in levels])
    above = None
    for height in reversed(range(len(levels))):
        tops, runs = levels[height]
        kept = ["item", "digest"] if height == 0 else []
        tops = tops.select("g", "place", *kept, F.array().cast(PATH).alias("path"))
        if runs is None:
            above = tops
            continue
        met = runs.join(above.withColumnRenamed("place", "run"), ["g", "run"])
        met = met.select("g", "run", "path", F.col("slots.digest").alias("digests"), F.explode("slots").alias("own"))
        step = F.array(F.struct(F.col("own.slot").alias("slot"), F.col("digests").alias("run")))
        place = (F.col("run") * FANOUT + F.col("own.slot")).alias("place")
        below = met.select("g", place, *[F.col(f"own.{x}").alias(x) for x in kept], F.concat(step, "path").cast(PATH).alias("path"))
        above = tops.unionByName(below)
    return above.drop("place"), ends


def siblings(path: Column) -> Column:
    """The digests beside the path, run by run, left to right."""
    return F.flatten(F.transform(path, lambda p: F.concat(_left(p), _right(p))))


def folded(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` leads to with the siblings on its path."""
    return F.aggregate(path, leaf, lambda own, p: F.sha2(F.concat_ws("", _left(p), own, _right(p)), 256))


def _left(p: Column) -> Column:
    return F.slice(p["run"], 1, p["slot"])


def _right(p: Column) -> Column:
    return F.slice(p["run"], p["slot"] + 2, FANOUT)


def manifest(
    docs: DataFrame,
    columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    id_col: str = "doc_id",
    group_col: str = "source",
    other: Column | None = None,
) -> DataFrame:
    """id, leaf, subroot, root, path (to the root) and other for each row of ``docs``.

    A leaf covers ``columns``. ``other`` is any string kept with the row, such as the leaf of a copy to be proved; null
    if not given. Null ids come first in their group, rows of one id in order of their leaves (equal rows in either
    order, with the same digests); a null group comes first. Null columns count as ``-``, empty and long texts as they
    are. An empty table gives no rows; columns not named are not read.
    """
    leaf = digest([F.col(f"`{c}`") for c in columns])
    other = F.lit(None).cast("string") if other is None else other
    read = docs.select(
        field(F.col(f"`{group_col}`")).alias("g"), F.col(f"`{group_col}`").cast("string").alias("name"), F.col(f"`{id_col}`").cast("long").alias("id"),
        F.monotonically_increasing_id().alias("serial"), leaf.alias("leaf"), other.alias("other"),
    )
    leaves = store(read, "merkle-leaves").df
    sizes = store(leaves.groupBy("g", "name").agg(F.count("*").alias("n")), "merkle-sizes").df
    largest, groups = sizes.agg(F.max("n"), F.count("*")).first()
    item = F.struct("id", "other").alias("item")
    nodes = join_measured(places(leaves), sizes.select("g", "n"), "g").select("g", "place", "n", F.col("leaf").alias("digest"), item)
    rows, tops = climb(nodes, largest or 0)

    # the groups in turn are the leaves of a tree over all of them
    ordered = add_row_id(sizes.join(tops, "g"), [F.asc_nulls_first("name")], "place", start=0)
    item = F.struct("g").alias("item")
    upper, root = climb(ordered.select(F.lit("").alias("g"), "place", F.lit(groups).cast("long").alias("n"), F.col("top").alias("digest"), item), groups)
    upper = upper.select(F.col("item.g").alias("g"), F.col("path").alias("above"), F.col("digest").alias("subroot"))
    upper = store(upper.crossJoin(F.broadcast(root.select(F.col("top").alias("root")))), "merkle-groups").df  # one root
    whole = join_measured(rows, upper, "g")
    return whole.select(F.col("item.id").alias("id"), F.col("digest").alias("leaf"), "subroot", "root", F.concat("path", "above").alias("path"), F.col("item.other").alias("other"))
