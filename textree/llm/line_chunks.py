"""Removal of repeated multi-line chunks; DataFrame operations only.

Lines are hashed. A rolling hash over the last ``WINDOW`` line hashes ends a chunk where it falls on a fixed
residue, so boundaries depend on nearby lines alone and stay put when lines are added elsewhere. Chunks of at
least ``LEAST_LINES`` lines whose hash is met more than once in all texts are compared byte by byte with their
first occurrence; equal ones go, the first stays.

``dedup_line_runs`` takes every two neighbouring lines for a window instead, so that a repeated run goes whole,
wherever it starts and ends.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textree.llm.secret_scan import join_measured
from textree.storage import store

WINDOW = 2
LEAST_LINES = 2
#: A chunk ends where the rolling hash starts with one of these hexadecimal digits: every second place.
ENDING = "01234567"
#: What exempts a text that lacks it: any letter or digit of any script.
WORD = r"[\p{L}\p{N}_]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, also where the body uses it inside a lambda."""
    return F.transform(F.array(value), body)[0]


def chunk_starts(lines: Column, window: int = WINDOW) -> Column:
    """Places (from 1) of the lines that start a chunk."""

    def starts(hashes: Column, place: Column) -> Column:
        before = F.slice(hashes, place - window, F.lit(window))
        ends = F.instr(F.lit(ENDING), F.substring(F.md5(F.array_join(before, "")), 1, 1)) > 0
        return (place == 1) | F.when(place > window, ends).otherwise(False)

    places = F.sequence(F.lit(1), F.size(lines))
    return let(F.transform(lines, F.md5), lambda hashes: F.filter(places, lambda place: starts(hashes, place)))


def chunk_list(text: Column, window: int = WINDOW) -> Column:
    """The chunks of a text in order; joined by line ends they are the text."""

    def cut(lines: Column, starts: Column) -> Column:
        ends = F.concat(F.slice(starts, 2, F.size(starts)), F.array(F.size(lines) + 1))
        pairs = F.arrays_zip(starts.alias("start"), ends.alias("end"))
        return F.transform(pairs, lambda x: F.array_join(F.slice(lines, x["start"], x["end"] - x["start"]), "\n"))

    lines = F.split(F.coalesce(text, F.lit("")), "\n", -1)
    return let(lines, lambda lines: let(chunk_starts(lines, window), lambda starts: cut(lines, starts)))


def line_count(chunk: Column) -> Column:
    return F.char_length(chunk) - F.char_length(F.replace(chunk, F.lit("\n"), F.lit(""))) + 1


def dedup_line_chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, least_lines: int = LEAST_LINES, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, text without repeated chunks, n_lines and n_removed_lines for each row of ``docs``, and the columns ``keep``.

    The first occurrence is the one with the smallest doc_id (null ids first, then smaller text hash) and place.
    A text that is all repetition becomes empty; null texts stay null; empty ones stay empty. Chunks without a
    letter or digit (of any script) or underscore are never removed. Rows with the same id and text are one document: they lose the same
    chunks, and a chunk repeated only between them stays. An empty table gives an empty table; other columns
    are not read. Texts are taken whole; one row holds one text at most.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *[F.col(x).alias(f"_keep_{x}") for x in keep])
    version = F.xxhash64("text").alias("version")
    placed = rows.select("doc_id", version, F.posexplode(chunk_list(F.col("text"), window)).alias("place", "chunk"))
    placed = placed.where((line_count(F.col("chunk")) >= least_lines) & F.col("chunk").rlike(WORD))
    placed = placed.select(F.md5("chunk").alias("hash"), F.struct("doc_id", "version", "place").alias("here"), "chunk")
    # three passes over the texts: hashes, the chunks that are met again, and the result
    hashed = store(placed.select("hash", "here"), "line-hashes")
    repeated = hashed.df.groupBy("hash").agg(F.min("here").alias("first"), F.max("here").alias("last"))
    repeated = store(repeated.where("first != last").select("hash", "first"), "line-repeated")
    again = store(join_measured(placed, repeated.df, "hash"), "line-again")
    first = again.df.where("here = first").select("hash", F.col("chunk").alias("first_chunk")).dropDuplicates(["hash"])
    copies = join_measured(again.df.where("here != first"), first, "hash").where("chunk = first_chunk")
    gone = copies.groupBy("here.doc_id", "here.version").agg(F.collect_set("here.place").alias("gone"))
    gone = store(gone, "line-gone").df
    for used in (hashed, repeated, again):
        used.release()
    gone = gone.select(F.col("doc_id").alias("_id"), F.col("version").alias("_version"), "gone")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_version"))
    joined = join_measured(rows, gone, same, "left")
    all_chunks = F.when(F.col("gone").isNotNull(), chunk_list(F.col("text"), window))
    kept = F.filter(all_chunks, lambda _, place: ~F.array_contains("gone", place))
    kept_text = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    kept_lines = F.when(F.col("gone").isNull(), line_count(F.col("text"))).otherwise(
        F.aggregate(kept, F.lit(0), lambda n, x: n + line_count(x))
    )
    n_lines = line_count(F.coalesce("text", F.lit("")))
    return joined.select(
        "doc_id",
        kept_text.alias("text"),
        n_lines.cast("long").alias("n_lines"),
        (n_lines - F.coalesce(kept_lines, n_lines)).cast("long").alias("n_removed_lines"),
        *[F.col(f"_keep_{x}").alias(x) for x in keep],
    )


def line_windows(lines: Column) -> Column:
    """(place, last) of the windows of a text's lines, from 1: every two neighbours of which one has a letter or digit.

    Lines in a longer stretch without any are reached by one window from the line with letters before the stretch
    to the one after it (or to the start or end of the text), so the windows add up to a few times the text.
    """

    def window(place: Column, last: Column) -> Column:
        return F.struct(place.cast("int").alias("place"), last.cast("int").alias("last"))

    def windows(worded: Column) -> Column:
        n = F.size(worded)
        places = F.sequence(F.lit(1), n)
        pairs = F.filter(F.slice(places, F.lit(1), n - 1), lambda i: F.get(worded, i - 1) | F.get(worded, i))
        spots = F.filter(places, lambda i: F.get(worded, i - 1))
        ends = F.concat(F.array(F.lit(1)), spots, F.array(n))

        def stretches(ends: Column) -> Column:
            spans = F.transform(F.slice(ends, F.lit(1), F.size(ends) - 1), lambda a, k: window(a, F.get(ends, k + 1)))
            # two lines of a stretch between lines with letters are reached by pairs, at an end of the text one
            least = lambda x: F.when((x["place"] == 1) | (x["last"] == n), 2).otherwise(4)
            return F.filter(spans, lambda x: (F.size(ends) > 2) & (x["last"] - x["place"] >= least(x)))

        return F.concat(F.transform(pairs, lambda i: window(i, i + 1)), let(ends, stretches))

    return let(F.transform(lines, lambda x: x.rlike(WORD)), windows)


def dedup_line_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, text without repeated runs of lines, n_lines and n_removed_lines for each row of ``docs``, and ``keep``.

    Every run of two or more whole lines that stands earlier goes whole: a line goes if a window of ``line_windows``
    around it is equal, byte by byte, to the window's first occurrence and does not overlap it. So an equal line is
    always left at an earlier place. Order of places, empty and null texts, equal rows, windows without a letter or
    digit and other columns are as in ``dedup_line_chunks``.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *[F.col(x).alias(f"_keep_{x}") for x in keep])
    version = F.xxhash64("text").alias("version")
    all_lines = F.split(F.coalesce("text", F.lit("")), "\n", -1)

    def placed(*made: str) -> DataFrame:
        """A row per window: where it is, and its text or the hash of it."""

        def read(lines: Column, x: Column) -> Column:
            text = F.array_join(F.slice(lines, x["place"], x["last"] - x["place"] + 1), "\n")
            values = {"hash": lambda t: F.md5(t), "chunk": lambda t: t}
            here = F.struct(x["place"].alias("place"), x["last"].alias("last"))
            return let(text, lambda t: F.struct(here.alias("at"), *[values[name](t).alias(name) for name in made]))

        found = let(all_lines, lambda lines: F.transform(line_windows(lines), lambda x: read(lines, x)))
        exploded = rows.select("doc_id", version, F.explode(found).alias("w"))
        here = F.struct("doc_id", "version", F.col("w.at.place").alias("place"), F.col("w.at.last").alias("last")).alias("here")
        return exploded.select(*[F.col(f"w.{name}").alias(name) for name in made], here)

    # three passes over the texts, as above
    hashed = store(placed("hash"), "run-hashes")
    repeated = hashed.df.groupBy("hash").agg(F.min("here").alias("first"), F.max("here").alias("last"))
    repeated = store(repeated.where("first != last").select("hash", "first"), "run-repeated")
    again = store(join_measured(placed("hash", "chunk"), repeated.df, "hash"), "run-again")
    first = again.df.where("here = first").select("hash", F.col("chunk").alias("first_chunk")).dropDuplicates(["hash"])
    copies = join_measured(again.df.where("here != first"), first, "hash").where("chunk = first_chunk")
    overlap = (
        F.col("here.doc_id").eqNullSafe(F.col("first.doc_id"))
        & F.col("here.version").eqNullSafe(F.col("first.version"))
        & (F.col("here.place") <= F.col("first.last"))
    )
    gone = copies.where(~overlap).groupBy("here.doc_id", "here.version")
    gone = store(gone.agg(F.collect_set(F.struct("here.place", "here.last")).alias("gone")), "run-gone").df
    for used in (hashed, repeated, again):
        used.release()
    gone = gone.select(F.col("doc_id").alias("_id"), F.col("version").alias("_version"), "gone")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_version"))
    joined = join_measured(rows, gone, same, "left")
    gone_places = F.flatten(F.transform("gone", lambda x: F.sequence(x["place"], x["last"])))
    n_lines = line_count(F.coalesce("text", F.lit("")))
    places = F.array_except(F.sequence(F.lit(1), n_lines), gone_places)
    kept = let(all_lines, lambda lines: F.transform(places, lambda i: F.get(lines, i - 1)))
    cut = joined.withColumn("_kept", F.when(F.col("gone").isNotNull(), kept))
    return cut.select(
        "doc_id",
        F.when(F.col("_kept").isNull(), F.col("text")).otherwise(F.array_join("_kept", "\n")).alias("text"),
        n_lines.cast("long").alias("n_lines"),
        F.when(F.col("_kept").isNull(), F.lit(0)).otherwise(n_lines - F.size("_kept")).cast("long").alias("n_removed_lines"),
        *[F.col(f"_keep_{x}").alias(x) for x in keep],
    )
