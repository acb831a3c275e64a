"""Similarity join on word n-grams with adaptive multi-match prefixes.

The shingles of a document are put in one global order, frequent ones last. Two similar documents share at
least ``m`` shingles of their prefixes if each prefix is ``m - 1`` longer than needed for one. Every document
chooses its own ``m``: it lengthens its prefix while the saving in estimated candidates pays for the longer
prefix, and a pair must share as many prefix shingles as the smaller of its two choices before it is verified,
first on short profiles that allow every similar pair, then on whole sets.

Links come in rounds, so that groups of near copies are never written out as all pairs: first each document
against one hub, then, twice, each document outside the main component of a prefix shingle against one drawn from
inside it, and at last, without any limit, all remaining candidates whose ends are not yet connected. There the parities of both
profiles (256 bits a document) are compared inside the join, so that pairs which differ too much are not written out.
Documents with equal sets are one class.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textree.llm.batches import text_slices
from textree.llm.components import components
from textree.llm.secret_scan import join_measured
from textree.storage import Stored, store

BUCKETS = 1 << 16  # of the frequency table; its size does not depend on the data
MOST_MATCHES = 8
DRAWS = 4  # hubs per token in the later rounds
EMIT_COST = 1.0  # of one more prefix shingle, next to comparing one shingle in a verification
FACTOR = np.uint64(0x9E3779B97F4A7C15)
SUMMARY = ["kind", "id", "n", "digest", "profile"]
PARITIES = ["odd0", "odd1", "odd2", "odd3"]
MET = ["doc", "n", "level", "matches", "component"]
OTHER = {"doc": "other"} | {x: f"other_{x}" for x in [*MET[1:], *PARITIES]}
MIXERS = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))


@dataclass(frozen=True)
class Rule:
    """Shingles of ``words`` words; linked when 100 * intersection >= percent * union."""

    words: int = 5
    percent: int = 80

    def least_shared(self, n):
        """Shingles that a set of ``n`` must share with any partner."""
        return (self.percent * n + 99) // 100


def shingle_set(text: bytes, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles (A-Z lower-cased, ASCII white space between words).

    With fewer words the whole sequence is one shingle; without words there is none. Two different shingles
    have equal hashes with a chance of 2^-64.
    """
    parts = text.lower().split()
    if not parts:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, parts), np.uint64, len(parts))
    size = min(words, len(parts))
    made = np.full(len(parts) - size + 1, size, np.uint64)
    for place in range(size):
        made = made * FACTOR + hashes[place : place + len(made)]
    for factor in MIXERS:
        made = (made ^ (made >> np.uint64(33))) * factor
    made ^= made >> np.uint64(33)
    made.sort()
    return made[np.r_[True, made[1:] != made[:-1]]]


def profile(shingles: np.ndarray) -> bytes | None:
    """How many shingles lie in each of 256 parts of the hash range; None where a byte cannot hold a count."""
    counts = np.bincount((shingles >> np.uint64(56)).astype(np.int64), minlength=256)
    return counts.astype(np.uint8).tobytes() if counts.max() < 256 else None


def most_similar(x: bytes | None, y: bytes | None) -> tuple[int, int]:
    """Bounds (shared, union) of the similarity of two sets: the smaller counts add up to at least what they share."""
    if x is None or y is None:
        return 1, 1
    a, b = (np.frombuffer(p, np.uint8).astype(np.int64) for p in (x, y))
    most = int(np.minimum(a, b).sum())
    return most, int(a.sum()) + int(b.sum()) - most


def profiles_allow(x: bytes | None, y: bytes | None, percent: int) -> bool:
    shared, union = most_similar(x, y)
    return 100 * shared >= percent * union


def parities(profiles: pa.Array) -> list[pa.Array]:
    """Four 64-bit columns: whether each of the 256 counts of a profile is odd. Null where there is no profile."""
    held = profiles.to_pylist()
    bits = [np.packbits(np.frombuffer(x or bytes(256), np.uint8) & 1).view(np.int64) for x in held]
    none = np.array([x is None for x in held], bool)
    words = np.array(bits, np.int64).reshape(len(held), 4)
    return [pa.array(words[:, i], pa.int64(), mask=none) for i in range(4)]


def _parities_allow(rule: Rule) -> Column:
    """Sets that are similar enough differ in so few shingles that no more counts can be odd in one and even in the other.

    Each shingle that only one of two sets has turns one parity, so the parities that differ are at most as many.
    """
    differ = sum((F.bit_count(F.col(x).bitwiseXOR(F.col(OTHER[x]))) for x in PARITIES), F.lit(0))
    most = F.expr(f"({100 - rule.percent} * (n + other_n)) div {100 + rule.percent}")
    return F.coalesce(differ <= most, F.lit(True))


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))


def _summary(texts: DataFrame, rule: Rule) -> Stored:
    """One pass: per document its set's size, digest and profile (kind 0), per task the shingles in each bucket (kind 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for start, slice_ in text_slices(batch, "text"):
                sizes, digests, profiles, held = [], [], [], []
                for text in slice_:
                    shingles = shingle_set(text or b"", rule.words)
                    held.append((shingles % np.uint64(BUCKETS)).astype(np.int64))
                    sizes.append(len(shingles))
                    digests.append(xxhash.xxh3_128_digest(shingles.tobytes()) if len(shingles) else None)
                    profiles.append(profile(shingles))
                counts += np.bincount(np.concatenate(held), minlength=BUCKETS)
                ids = batch.column("doc_id").slice(start, len(slice_))
                kind = pa.array(np.zeros(len(slice_), np.int32))
                yield pa.RecordBatch.from_arrays([kind, ids, pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(profiles, pa.binary())], SUMMARY)
        met = np.flatnonzero(counts)
        kind, none = pa.array(np.ones(len(met), np.int32)), pa.nulls(len(met), pa.binary())
        yield pa.RecordBatch.from_arrays([kind, pa.array(met), pa.array(counts[met]), none, none], SUMMARY)

    return store(texts.mapInArrow(run, "kind int, id long, n long, digest binary, profile binary"), "jaccard-summary")


def _excess(summary: DataFrame) -> np.ndarray:
    """By bucket, how many more shingles it holds than usual: frequent shingles stand out. BUCKETS rows at most."""
    counts = np.zeros(BUCKETS)
    for row in summary.where("kind = 1").groupBy("id").agg(F.sum("n").alias("n")).collect():
        counts[row["id"]] = row["n"]
    usual = np.median(counts)
    return np.maximum(0.0, counts - usual - 4.0 * np.sqrt(usual) - 1.0)


def prefix(shingles: np.ndarray, excess: np.ndarray, rule: Rule) -> tuple[np.ndarray, np.ndarray, int]:
    """Prefix shingles, the number of matches from which each belongs to the prefix, and the chosen number."""
    n = len(shingles)
    shared = rule.least_shared(n)
    weight = excess[(shingles % np.uint64(BUCKETS)).astype(np.int64)]
    order = np.lexsort((shingles, weight))
    first = n - shared + 1
    most = min(MOST_MATCHES, shared)
    matches = np.arange(1, most + 1)
    mass = np.cumsum(weight[order[: first + most - 1]])[first - 1 :]
    # a candidate with m matches takes m of the mass, so there are at most mass / m
    chosen = 1 + int(np.argmin(EMIT_COST * matches + n * mass / matches))
    held = order[: first + chosen - 1]
    level = np.maximum(1, np.arange(len(held)) - first + 2)
    return shingles[held], level.astype(np.int32), chosen


def _prefixes(texts: DataFrame, classes: DataFrame, excess: np.ndarray, rule: Rule) -> DataFrame:
    """(token, doc, n, level, matches) of the first document of each class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, slice_ in text_slices(batch, "text"):
                ids = batch.column("doc_id").slice(start, len(slice_)).to_pylist()
                digests = batch.column("digest").slice(start, len(slice_)).to_pylist()
                tokens, levels, rows = [], [], []
                for doc, digest, text in zip(ids, digests, slice_, strict=True):
                    shingles = shingle_set(text or b"", rule.words)
                    if xxhash.xxh3_128_digest(shingles.tobytes()) != digest:
                        continue  # another text under the same id
                    held, level, chosen = prefix(shingles, excess, rule)
                    tokens.append(held.view(np.int64))
                    levels.append(level)
                    rows.append((doc, len(shingles), chosen, len(held)))
                if rows:
                    doc, n, chosen, length = (np.array(x) for x in zip(*rows, strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.concatenate(tokens)),
                            pa.array(np.repeat(doc, length)),
                            pa.array(np.repeat(n, length).astype(np.int32)),
                            pa.array(np.concatenate(levels)),
                            pa.array(np.repeat(chosen, length).astype(np.int32)),
                        ],
                        ["token", "doc", "n", "level", "matches"],
                    )

    firsts = classes.select(F.col("first").alias("_first"), "digest")
    chosen = join_measured(texts, firsts, F.col("doc_id") == F.col("_first")).select("doc_id", "text", "digest")
    return chosen.mapInArrow(run, "token long, doc long, n int, level int, matches int")


def _sets_of(texts: DataFrame, classes: DataFrame, wanted: DataFrame, end: str, rule: Rule) -> DataFrame:
    """``wanted`` (a and perhaps b) with the set of the document in column ``end``, computed where its text is read."""
    names = wanted.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = (None, None)
        for batch in batches:
            for start, slice_ in text_slices(batch, "text"):
                digests = batch.column("digest").slice(start, len(slice_)).to_pylist()
                kept, sets = [], []
                for row, (digest, text) in enumerate(zip(digests, slice_, strict=True), start):
                    if last[0] != text:  # a document in several pairs has its rows side by side
                        last = (text, shingle_set(text or b"", rule.words).tobytes())
                    if xxhash.xxh3_128_digest(last[1]) == digest:
                        kept.append(row)
                        sets.append(last[1])
                ends = [batch.column(x).take(pa.array(kept, pa.int64())) for x in names]
                yield pa.RecordBatch.from_arrays([*ends, pa.array(sets, pa.binary())], [*names, f"set_{end}"])

    named = join_measured(classes.select(F.col("first").alias(end), "digest"), wanted, end)
    chosen = join_measured(texts, named, F.col("doc_id") == F.col(end)).select(*names, "digest", "text")
    return chosen.mapInArrow(run, ", ".join(f"{x} long" for x in names) + f", set_{end} binary")


def _verified(pairs: DataFrame, texts: DataFrame, classes: DataFrame, rule: Rule) -> Stored:
    """The pairs (a, b) whose whole sets are similar enough. Of a pair, the set of b travels to the set of a."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for left, right in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
                x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (left, right))
                both = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * both >= rule.percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    kept = store(pairs.select("a", "b"), "jaccard-pairs")
    left = _sets_of(texts, classes, kept.df.select("a").distinct(), "a", rule)
    right = _sets_of(texts, classes, kept.df, "b", rule)
    links = store(left.join(right, "a").mapInArrow(run, "a long, b long"), "jaccard-links")
    kept.release()
    return links


def _may_link(rule: Rule) -> Column:
    """Sizes near enough, and the shingle is in the prefix that the smaller choice of matches asks for."""
    sizes = 100 * F.least("n", "other_n") >= rule.percent * F.greatest("n", "other_n")
    asked = F.least("matches", "other_matches")
    return sizes & (F.col("level") <= asked) & (F.col("other_level") <= asked)


def _candidates(met: DataFrame, whole: Rule | None = None) -> DataFrame:
    """Pairs (doc, other) that share enough prefix shingles: as many as they ask for and, where ``met`` holds all that
    they share (``whole``), so many that what lies beyond the prefixes can make up the rest.

    Of the two prefixes one ends first in the global order; its document shares nothing else but what follows it, which
    is its least number of shared shingles less the matches asked for.
    """
    asked = F.least("matches", "other_matches").alias("asked")
    counted = met.groupBy("doc", "other", asked, "n", "other_n").agg(F.countDistinct("token").alias("shared"))
    counted = counted.where("shared >= asked")
    if whole:
        beyond = F.expr(f"({whole.percent} * greatest(n, other_n) + 99) div 100 - asked")
        counted = counted.where((F.col("shared") + beyond) * (100 + whole.percent) >= whole.percent * (F.col("n") + F.col("other_n")))
    return counted.select(F.col("other").alias("a"), F.col("doc").alias("b"))


def _plausible(candidates: DataFrame, classes: DataFrame, rule: Rule) -> DataFrame:
    """Candidates that the profiles of both sets allow; no similar pair is lost."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = zip(batch.column("profile_a").to_pylist(), batch.column("profile_b").to_pylist(), strict=True)
            bounds = [most_similar(x, y) for x, y in ends]
            allowed = pa.array([100 * shared >= rule.percent * union for shared, union in bounds], pa.bool_())
            bound = pa.array([shared / union for shared, union in bounds], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.select(["a", "b"]).columns, bound], ["a", "b", "bound"]).filter(allowed)

    left, right = (classes.select(F.col("first").alias(x), F.col("profile").alias(f"profile_{x}")) for x in "ab")
    return candidates.join(left, "a").join(right, "b").mapInArrow(run, "a long, b long, bound double")


def _best_hub(candidates: DataFrame) -> DataFrame:
    """One pair per document: with the hub whose profile is nearest. The others wait for a later round."""
    best = candidates.groupBy("b").agg(F.max(F.struct("bound", "a")).alias("best"))
    return best.select(F.col("best.a").alias("a"), "b")




def _speakers(labelled: DataFrame, salt: int) -> DataFrame:
    """(token, draws, main): of the component with most rows at a token, ``DRAWS`` documents drawn by hash."""
    draws = [F.min(F.struct(F.xxhash64("doc", "token", F.lit(salt + i)).alias("draw"), *MET)).alias(f"d{i}") for i in range(DRAWS)]
    by_component = labelled.groupBy("token", "component").agg(F.count("*").alias("rows"), *draws)
    largest = F.max(F.struct("rows", F.col("component").alias("c"), *[f"d{i}" for i in range(DRAWS)])).alias("m")
    main = by_component.groupBy("token").agg(largest)
    return main.select("token", F.col("m.c").alias("main"), F.array_distinct(F.array(*[f"m.d{i}" for i in range(DRAWS)])).alias("draws"))


def _hub_pairs(labelled: DataFrame, salt: int, rule: Rule) -> DataFrame:
    """(a, b): every document outside the main component of a token with the ones drawn from inside.

    Whether enough prefix shingles are shared is left to the profiles, since a document is drawn at few tokens.
    """
    outside = join_measured(labelled, _speakers(labelled, salt), "token").where("component != main")
    met = outside.select(*labelled.columns, F.explode("draws").alias("hub"))
    met = met.select(*labelled.columns, *[F.col(f"hub.{old}").alias(OTHER[old]) for old in MET])
    return met.where(_may_link(rule)).select(F.col("other").alias("a"), F.col("doc").alias("b")).distinct()


def _labelled(rows: DataFrame, named: DataFrame) -> DataFrame:
    """Rows with their component so far, of those shingles only that more than one component has."""
    mine = named.select(F.col("node").alias("doc"), "component")
    labelled = join_measured(rows, mine, "doc", "left").withColumn("component", F.coalesce("component", "doc"))
    split = labelled.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return join_measured(labelled, split.where("low < high").select("token"), "token", "left_semi")


def _with_parities(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Stored ``rows`` with the parities of their documents' profiles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc"), *parities(batch.column("profile"))], ["doc", *PARITIES])

    wanted = store(rows.select("doc").distinct(), "jaccard-docs").df
    profiles = join_measured(classes.select(F.col("first").alias("doc"), "profile"), wanted, "doc")
    odd = store(profiles.mapInArrow(run, "doc long, " + ", ".join(f"{x} long" for x in PARITIES)), "jaccard-parities").df
    return join_measured(rows, odd, "doc")


def _joined(named: Stored, links: Stored) -> Stored:
    """Components of what was connected before and the new links."""
    known = named.df.select(F.col("node").alias("a"), F.col("component").alias("b"))
    return components(known.unionAll(links.df.select("a", "b")))


def link_documents(docs: DataFrame, rule: Rule = Rule(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links) for each row of ``docs``.

    Texts without words (null, empty, blank) have 0 shingles and are their own component. Rows with a null id
    share the component of documents with their set, or have none. Rows that repeat an id are one row each; one
    of different texts under one id is compared for each of its sets. An empty table gives an empty table; other
    columns are not read; texts are taken whole. No link between different sets is lost: what the first rounds
    connect is skipped later only because its ends are connected.
    """
    texts = _texts(docs, id_col, text_col)
    summary = _summary(texts, rule)
    excess = _excess(summary.df)
    sets = summary.df.where("kind = 0").select(F.col("id").alias("doc_id"), "n", "digest", "profile")
    grouped = sets.where("digest IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("profile").alias("profile"))
    classes = store(grouped.where("first IS NOT NULL"), "jaccard-classes")
    prefixes = store(_prefixes(texts, classes.df, excess, rule), "jaccard-prefixes")
    shared = prefixes.df.groupBy("token").agg(F.count("*").alias("rows")).where("rows > 1").select("token")
    rows = store(join_measured(prefixes.df, store(shared, "jaccard-shared").df, "token"), "jaccard-rows")
    prefixes.release()

    fields = F.struct(F.xxhash64("doc").alias("draw"), "doc", "n", "level", "matches")
    hubs = rows.df.groupBy("token").agg(F.min(fields).alias("hub"))
    named_hubs = hubs.select("token", *[F.col(f"hub.{old}").alias(OTHER[old]) for old in MET[:-1]])
    met = join_measured(rows.df, named_hubs, "token").where((F.col("doc") != F.col("other")) & _may_link(rule))
    links = _verified(_best_hub(_plausible(_candidates(met), classes.df, rule)), texts, classes.df, rule)
    named = components(links.df)

    # documents outside the main component of a token against several inside it, drawn anew each time
    for salt in (0, DRAWS):
        mixed = store(_labelled(rows.df, named.df), "jaccard-rows")
        hubs = _plausible(_hub_pairs(mixed.df, salt, rule), classes.df, rule)
        more = _verified(_best_hub(hubs), texts, classes.df, rule)
        named, last = _joined(named, more), named
        for used in (mixed, more, last):
            used.release()

    # the rest, whole: every candidate whose ends are not connected yet
    apart = store(_labelled(rows.df, named.df), "jaccard-rows")
    left = store(_with_parities(apart.df, classes.df), "jaccard-rows")
    apart.release()
    right = left.df.select("token", *[F.col(old).alias(new) for old, new in OTHER.items()])
    open_ = (F.col("doc") < F.col("other")) & (F.col("component") != F.col("other_component"))
    met = left.df.join(right, "token").where(open_ & _may_link(rule) & _parities_allow(rule))
    rest = _verified(_plausible(_candidates(met, rule), classes.df, rule), texts, classes.df, rule)
    done = _joined(named, rest)

    named_class = join_measured(classes.df, done.df.select(F.col("node").alias("first"), "component"), "first", "left")
    named_class = named_class.select("digest", F.coalesce("component", "first").alias("component"))
    out = join_measured(sets.drop("profile"), named_class, "digest", "left")
    for used in (rows, left, links, rest, named):
        used.release()
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))
