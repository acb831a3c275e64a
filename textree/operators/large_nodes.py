"""Splits of the nodes that are too large for one task, found by tasks that each hold ranges of sorted values.

Every feature has a list of all rows, sorted by its values and cut into ranges. The ranges are dealt to as many tasks as
run at once; these stay for all levels (one barrier stage) and tell each other what their ranges hold of a node and which
split is their best, so a level moves no rows and starts no job. A row stands in each list with the values of all
features, as places in the range's own tables of values, so the split alone tells on which side it is.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import BarrierTaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textree.operators.subtrees import SPLITS, best_split, entropy, midpoints
from textree.storage import store

# Rows up to which a list is one range: its task needs no word of the others to know what lies left of a value.
LIST_ROWS = 1_000_000
# Rows of a range of a longer list, about.
RANGE_ROWS = 262_144
# Rows of all lists that are worth a task.
TASK_ROWS = 50_000
# Bytes of lists that a task may hold.
TASK_BYTES = 512 * 1024 * 1024
# Rows whose ranges are looked up at once.
PACK_ROWS = 100_000

CHUNKS = "feature int, range int, y binary, x binary"
RANGES = "feature int, range int, y binary, tables array<binary>, places array<binary>"


def tasks_for(spark: SparkSession, n_rows: int, n_features: int) -> int:
    """Tasks that may hold the lists of a table at the same time; 0 if they would be too large, or if the number of
    executors may change, as a barrier stage does not allow that."""
    context = spark.sparkContext
    if context.getConf().get("spark.dynamicAllocation.enabled", "false") == "true":
        return 0
    scala = context._jsc.sc()
    slots = scala.maxNumConcurrentTasks(scala.resourceProfileManager().defaultResourceProfile())
    rows = n_rows * n_features
    fits = rows * (4 * n_features + 1) <= slots * TASK_BYTES
    return min(slots, max(2, -(-rows // TASK_ROWS))) if fits else 0


def range_bounds(rows: DataFrame, n_features: int, pieces: int) -> list[np.ndarray]:
    """For each feature the values at which its list is cut; one that makes up several pieces stands there as often."""
    shares = [i / pieces for i in range(1, pieces)]
    found = rows.agg(*[F.percentile_approx(F.col("x")[k], shares, max(1000, 8 * pieces)) for k in range(n_features)]).first()
    return [np.array(bounds) for bounds in found]


def _packed(bounds: list[np.ndarray]):
    """Rows as chunks of ranges: one row for each feature and range that a number of rows falls into."""

    def chunks(y: np.ndarray, x: np.ndarray) -> Iterator[tuple]:
        for k, cuts in enumerate(bounds):
            low, high = (np.searchsorted(cuts, x[:, k], side).astype(np.int32) for side in ("left", "right"))
            # rows with one value that is several bounds are dealt to the ranges between them
            at = low + np.arange(len(y), dtype=np.int32) % np.maximum(1, high - low)
            order = np.argsort(at, kind="stable")
            for ids in np.split(order, np.flatnonzero(np.diff(at[order])) + 1):
                yield k, int(at[ids[0]]), y[ids].tobytes(), x[ids].T.tobytes()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds, held, n = [pa.int32(), pa.int32(), pa.binary(), pa.binary()], [], 0

        def out() -> pa.RecordBatch:
            made = zip(*chunks(*(np.concatenate(a) for a in zip(*held, strict=True))), strict=True)
            names = [c.split()[0] for c in CHUNKS.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(made, kinds, strict=True)], names)

        for batch in batches:
            if not batch.num_rows:
                continue
            y = batch["y"].to_numpy().astype(np.uint8)
            held.append((y, batch["x"].flatten().to_numpy().reshape(len(y), len(bounds))))
            n += len(y)
            if n >= PACK_ROWS:
                yield out()
                held, n = [], 0
        if held:
            yield out()

    return pack


def sorted_ranges(rows: DataFrame, n_rows: int, n_features: int, tasks: int) -> DataFrame:
    """The lists of all features, one row for each range of one: labels, and for each feature its values that occur
    there and their places, row by row."""
    pieces = max(4 * tasks, -(-n_rows // RANGE_ROWS))
    bounds = [np.zeros(0)] * n_features if n_rows <= LIST_ROWS else range_bounds(rows, n_features, pieces)

    def merged(key: tuple, chunks: pa.Table) -> pa.Table:
        feature = key[0].as_py()
        y = np.concatenate([np.frombuffer(b, np.uint8) for b in chunks["y"].to_pylist()])
        x = np.concatenate([np.frombuffer(b).reshape(n_features, -1) for b in chunks["x"].to_pylist()], axis=1)
        order = np.argsort(x[feature], kind="stable")
        tables, places = [], []
        for column in x:
            values, at = np.unique(column[order], return_inverse=True)
            tables.append(values.tobytes())
            places.append(at.astype(_place_type(len(values))).tobytes())
        kinds = [pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.binary())]
        row = (feature, key[1].as_py(), y[order].tobytes(), tables, places)
        return pa.table([pa.array([c], t) for c, t in zip(row, kinds, strict=True)], [c.split()[0] for c in RANGES.split(", ")])

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = rows.select("y", "x").mapInArrow(_packed(bounds), CHUNKS)
    return chunks.repartition(parts, "feature", "range").groupBy("feature", "range").applyInArrow(merged, RANGES)


def _place_type(n: int) -> type:
    return np.uint8 if n <= 1 << 8 else np.uint16 if n <= 1 << 16 else np.uint32


@dataclass
class Held:
    """One range of a feature's list: for each open node its rows in order, as places in the tables of all features, and
    their labels."""

    feature: int
    number: int
    tables: list[np.ndarray]
    nodes: dict[str, tuple[list[np.ndarray], np.ndarray]]

    def told(self, at: int, path: str) -> list[float]:
        """Node, feature, range, rows, ones, first and last value, rows and ones before the last value."""
        places, y = self.nodes[path]
        own, table = places[self.feature], self.tables[self.feature]
        start = int(np.searchsorted(own, own[-1], "left"))
        counts = len(y), np.count_nonzero(y), table[own[0]], table[own[-1]], start, np.count_nonzero(y[:start])
        return [at, self.feature, self.number, *counts]

    def part(self, path: str, place: int, split: float, keep: list[bool]) -> None:
        """Put the rows of a node into those of its two children that are kept."""
        places, y = self.nodes.pop(path)
        right = places[place] >= np.searchsorted(self.tables[place], split, "left")
        for side, mask in enumerate((~right, right)):
            if keep[side] and mask.any():
                self.nodes[f"{path}{side}"] = [p[mask] for p in places], y[mask]


def _read_ranges(batches: Iterator[pa.RecordBatch]) -> list[Held]:
    held = []
    for batch in batches:
        for row in batch.to_pylist():
            tables = [np.frombuffer(b) for b in row["tables"]]
            places = [np.frombuffer(b, _place_type(len(t))) for b, t in zip(row["places"], tables, strict=True)]
            held.append(Held(row["feature"], row["range"], tables, {"": (places, np.frombuffer(row["y"], np.uint8))}))
    return sorted(held, key=lambda h: (h.feature, h.number))


def _everyones(context: BarrierTaskContext, rows: list, width: int) -> np.ndarray:
    """The rows of numbers of all tasks."""
    told = context.allGather(base64.b64encode(np.array(rows, float).tobytes()).decode())
    return np.concatenate([np.frombuffer(base64.b64decode(t)).reshape(-1, width) for t in told])


def _around(told: np.ndarray) -> dict[tuple[int, int, int], dict]:
    """What lies around each range of a node's list: ``before``, ``bin_before`` and ``after`` of ``midpoints``."""
    if not len(told):
        return {}
    told = told[np.lexsort((told[:, 2], told[:, 1], told[:, 0]))]
    keys, counts, (first, last) = told[:, :3].astype(int), told[:, 3:5].astype(int), told[:, 5:7].T
    joined = np.append(False, (keys[1:, :2] == keys[:-1, :2]).all(axis=1))  # to the range before, of the same list
    start = np.maximum.accumulate(np.where(joined, 0, np.arange(len(keys))))
    before = np.cumsum(counts, axis=0) - counts
    before = before - before[start]
    goes_on = joined & np.append(False, first[1:] == last[:-1])
    # where the last value of a range begins: there, or where the ranges before it begin that have no other one
    origin = np.maximum.accumulate(np.where(goes_on & (first == last), 0, np.arange(len(keys))))
    begin = (before + told[:, 7:9].astype(int))[origin]
    bin_before = np.where(goes_on[:, None], np.roll(begin, 1, axis=0), before)
    follows = np.append(joined[1:], False) & np.append(first[1:] != last[:-1], False)
    return {
        tuple(key): {"before": tuple(before[i]), "bin_before": tuple(bin_before[i]), "after": first[i + 1] if follows[i] else None}
        for i, key in enumerate(keys.tolist())
    }


def _levels(context: BarrierTaskContext, held: list[Held], n0: int, n1: int, largest: int, whole: bool, rule) -> Iterator[tuple]:
    """Path, depth, place of the feature, split, l0, l1, r0 and r1 of the splits of all nodes of over ``largest`` rows.

    Spark's barrier takes a second each time it is met, so lists of one range, which need it once a level, do without the other.
    """
    nodes, depth = {"": (n0, n1)}, 0
    while nodes:
        paths = sorted(nodes)
        own = [h.told(i, path) for i, path in enumerate(paths) for h in held if path in h.nodes]
        around = _around(np.array(own).reshape(-1, 9) if whole else _everyones(context, own, 9))
        bests = []
        for i, path in enumerate(paths):
            parts = (
                (h.feature, *part)
                for h in held
                if path in h.nodes
                for part in midpoints(h.nodes[path][0][h.feature], h.nodes[path][1], rule.max_group, h.tables[h.feature], **around[i, h.feature, h.number])
            )
            best = best_split(parts, sum(nodes[path]), nodes[path][1], rule)
            if best:
                bests.append([i, *best])
        winners: dict[int, tuple] = {}
        for i, ratio, place, split, n_left, ones in _everyones(context, bests, 6).tolist():
            found = (-ratio, int(place), split, int(n_left), int(ones))
            winners[int(i)] = min(found, winners.get(int(i), found))
        after = {}
        for i, path in enumerate(paths):
            if i not in winners:
                for h in held:
                    h.nodes.pop(path, None)
                continue
            _, place, split, n_left, l1 = winners[i]
            all0, all1 = nodes[path]
            sides = ((n_left - l1, l1), (all0 - (n_left - l1), all1 - l1))
            yield path, depth, place, split, *sides[0], *sides[1]
            keep = [sum(side) > largest and opens(*side, depth + 1, rule) for side in sides]
            after |= {f"{path}{side}": sides[side] for side in (0, 1) if keep[side]}
            for h in held:
                if path in h.nodes:
                    h.part(path, place, split, keep)
        nodes, depth = after, depth + 1


def opens(n0: int, n1: int, depth: int, rule) -> bool:
    return depth < rule.max_depth and entropy(n0, n1, rule.entropy_digits) > rule.entropy_stop


def large_splits(rows: DataFrame, n0: int, n1: int, names: Sequence[str], tasks: int, largest: int, rule) -> list[dict]:
    """The splits of all nodes with more than ``largest`` rows, as rows of ``SPLITS`` below the root."""
    ranges = store(sorted_ranges(rows, n0 + n1, len(names), tasks), "ranges")
    names, whole = list(names), n0 + n1 <= LIST_ROWS

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = BarrierTaskContext.get()
        made = list(_levels(context, _read_ranges(batches), n0, n1, largest, whole, rule))
        if context.partitionId() == 0 and made:  # every task knows all of them
            path, depth, place, *rest = zip(*made, strict=True)
            columns = [[1] * len(made), path, depth, [names[p] for p in place], *rest]
            kinds = [pa.int64(), pa.string(), pa.int32(), pa.string(), pa.float64(), *[pa.int64()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], [c.split()[0] for c in SPLITS.split(", ")])

    splits = ranges.df.repartition(tasks).mapInArrow(found, SPLITS, barrier=True).collect()
    ranges.release()
    return [r.asDict() for r in splits]


def rows_below(rows: DataFrame, splits: list[dict], names: Sequence[str], tops: dict[int, tuple[str, int]]) -> DataFrame:
    """(node_id, y, x) of the rows in ``tops``, whose paths are those of children of ``splits``; all others are done."""
    at = {s["path"]: i for i, s in enumerate(splits)}
    end = {path: -1 - number for number, (path, _) in tops.items()}
    closed = np.iinfo(np.int64).min
    place = np.array([names.index(s["feature"]) for s in splits], np.int32)
    split = np.array([s["split"] for s in splits])
    sides = [np.array([at.get(f"{s['path']}{side}", end.get(f"{s['path']}{side}", closed)) for s in splits], np.int64) for side in (0, 1)]
    root = at[""]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch["x"].flatten().to_numpy().reshape(batch.num_rows, len(names))
            now = np.full(len(x), root, np.int64)
            inside = np.arange(len(x))
            while len(inside):
                node = now[inside]
                now[inside] = np.where(x[inside, place[node]] >= split[node], sides[1][node], sides[0][node])
                inside = inside[now[inside] >= 0]
            ids = pa.array(-1 - np.where(now == closed, -1, now))
            moved = pa.RecordBatch.from_arrays([ids, batch["y"], batch["x"]], ["node_id", "y", "x"])
            yield moved.filter(pa.array(now != closed))

    return rows.select("y", "x").mapInArrow(walk, "node_id long, y int, x array<double>")
