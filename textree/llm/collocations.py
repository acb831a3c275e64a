"""Phrases of words that occur together more often than their parts would, mined by Rabin-Karp fingerprints.

Texts are cut into pieces and words by numpy on their bytes. A prefix polynomial over the bytes hashes every word, one
over the words every n-gram. One pass for each phrase length sends 64-bit fingerprints, counted inside the task,
through a shuffle; from two words on only n-grams travel whose two shorter halves are frequent. These are known from a
Bloom filter of at most 32 MB: if it fills up on more data, more n-grams travel, and the result is the same. A last
pass turns the frequent fingerprints into phrases: inside a task every occurrence is compared with the one that its
fingerprint points at, word by word and word against bytes, and counts are added up by phrase. So two phrases with
one fingerprint never count as one.
"""

from __future__ import annotations

import functools
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textree.llm.secret_scan import join_measured
from textree.storage import Stored, store

BREAKS = b".,;:!?\n\x0b\x0c\r"
BLANKS = b" \t"
LONGEST = 5
WINDOW_BYTES = 1 << 20  # hashed at once
SLAB_BYTES = 8 << 20  # counted at once
HELD_PHRASES = 500_000  # phrases whose counts a task adds up before it hands them on
MOST_BITS = 1 << 28
BASE, WORD_BASE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93  # odd, so that powers have inverses modulo 2^64
MIXERS = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))

KIND = np.zeros(256, np.uint8)
KIND[list(BLANKS)] = 1
KIND[list(BREAKS)] = 2
AT_BREAK = re.compile(b"[" + BREAKS + b"]")


@dataclass(frozen=True)
class Rule:
    """Phrases of 2 to ``longest`` words that occur at least ``least`` times; the best ``top`` of each language."""

    least: int = 100
    longest: int = LONGEST
    top: int = 2000


def mixed(values: np.ndarray) -> np.ndarray:
    for factor in MIXERS:
        values = (values ^ (values >> np.uint64(33))) * factor
    return values ^ (values >> np.uint64(33))


@functools.lru_cache(maxsize=8)
def _powers(base: int, size: int) -> np.ndarray:
    """1, base, base^2, ... modulo 2^64."""
    out = np.full(size, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


def powers(base: int, size: int) -> np.ndarray:
    return _powers(base, 1 << max(size - 1, 1).bit_length())[:size]


def stretches(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Polynomial hash of values[start:end] for each pair, from one prefix polynomial."""
    prefix = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(base, len(values)), out=prefix[1:])
    return (prefix[ends] - prefix[starts]) * powers(pow(base, -1, 1 << 64), len(values) + 1)[starts]


class Slab:
    """Words of some texts in one language: where they start and end, their piece and their hash."""

    def __init__(self, lang: str, windows: list[bytes]):
        self.seed = np.uint64(xxhash.xxh3_64_intdigest(lang.encode()))
        self.data = b"\n".join(windows)
        starts, ends, pieces, hashes = [], [], [], []
        at = piece = 0
        for window in windows:
            raw = np.frombuffer(window, np.uint8)
            kind = KIND[raw]
            edge = np.diff(np.concatenate(([0], (kind == 0).view(np.int8), [0])))
            start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
            breaks = np.cumsum(kind == 2)
            if len(start):
                hashes.append(mixed(stretches(raw.astype(np.uint64) + np.uint64(1), start, end, BASE)))
                starts.append(start + at)
                ends.append(end + at)
                pieces.append(breaks[start] + piece)
            at += len(raw) + 1
            piece += (int(breaks[-1]) if len(breaks) else 0) + 1

        def joined(parts: list[np.ndarray], kind: type) -> np.ndarray:
            return np.concatenate(parts) if parts else np.zeros(0, kind)

        self.starts, self.ends = joined(starts, np.int64), joined(ends, np.int64)
        self.pieces, self.hashes = joined(pieces, np.int64), joined(hashes, np.uint64)

    def whole(self, n: int) -> np.ndarray:
        """First words of the n-grams that lie in one piece."""
        if len(self.pieces) < n:
            return np.zeros(0, np.int64)
        return np.flatnonzero(self.pieces[: len(self.pieces) - n + 1] == self.pieces[n - 1 :])

    def fingerprints(self, n: int, firsts: np.ndarray) -> np.ndarray:
        grams = stretches(self.hashes, firsts, firsts + n, WORD_BASE) if len(firsts) else np.zeros(0, np.uint64)
        return mixed(grams ^ (self.seed + np.uint64(n)))

    def word_ids(self) -> np.ndarray:
        """Equal numbers for equal words: words of one hash are compared byte by byte with the first of them."""
        _, first, ids = np.unique(self.hashes, return_index=True, return_inverse=True)
        model = first[ids]
        sizes = self.ends - self.starts
        same = sizes == sizes[model]
        raw = np.frombuffer(self.data + bytes(8), np.uint8)
        eights = np.lib.stride_tricks.sliding_window_view(raw, 8)
        left = np.flatnonzero(same)
        for offset in range(0, int(sizes.max(initial=0)), 8):
            left = left[sizes[left] > offset]
            kept = np.minimum(sizes[left] - offset, 8)
            differ = eights[self.starts[left] + offset] != eights[self.starts[model[left]] + offset]
            same[left[(differ & (np.arange(8) < kept[:, None])).any(axis=1)]] = False
        if not same.all():  # two words share a hash: number those that differ by their bytes
            known: dict[bytes, int] = {}
            for i in np.flatnonzero(~same):
                word = self.data[self.starts[i] : self.ends[i]]
                ids[i] = known.setdefault(word, len(first) + len(known))
        return ids

    def phrase(self, first: int, n: int) -> bytes:
        return b" ".join(self.data[self.starts[first] : self.ends[first + n - 1]].split())


def _windows(text: bytes) -> Iterator[bytes]:
    """A text in parts that end at a break, so that no piece is cut."""
    start = 0
    while len(text) - start > WINDOW_BYTES:
        at = AT_BREAK.search(text, start + WINDOW_BYTES)
        if at is None:
            break
        yield text[start : at.start()]
        start = at.end()
    yield text[start:]


def slabs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Slab]]:
    """The texts (lower-cased in A-Z) of a task by language, ``SLAB_BYTES`` of them at a time."""
    held: dict[str, list[bytes]] = {}
    size = 0
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
            raw = text.as_py()
            if not raw:
                continue
            for window in _windows(raw.lower()):
                held.setdefault(lang, []).append(window)
                size += len(window)
                if size >= SLAB_BYTES:
                    yield from ((x, Slab(x, parts)) for x, parts in held.items())
                    held, size = {}, 0
    yield from ((x, Slab(x, parts)) for x, parts in held.items())


class Filter:
    """Fingerprints that may be frequent; two bits for each."""

    def __init__(self, bits: bytes):
        self.bits = np.frombuffer(bits, np.uint8)
        self.mask = np.uint64(8 * len(bits) - 1)

    def has(self, keys: np.ndarray) -> np.ndarray:
        def bit(places: np.ndarray) -> np.ndarray:
            return (self.bits[places >> np.uint64(3)] >> (places & np.uint64(7)).astype(np.uint8)) & 1

        found = bit(keys & self.mask).astype(bool)
        found[found] = bit((keys[found] >> np.uint64(32)) & self.mask).astype(bool)
        return found


def bloom(keys: DataFrame, count: int) -> Broadcast:
    """Bits of the fingerprints, 16 for each and ``MOST_BITS`` in all; they are set inside Spark, 32,768 to a row."""
    size = min(MOST_BITS, 1 << max(15, (16 * count - 1).bit_length()))
    both = F.array(F.col("key"), F.shiftrightunsigned("key", 32))
    places = keys.select(F.explode(both).alias("p")).select(F.col("p").bitwiseAND(size - 1).alias("p"))
    rows = places.groupBy(F.shiftright("p", 15).alias("at")).agg(F.bitmap_construct_agg(F.col("p").bitwiseAND(32767)).alias("bits"))
    bits = bytearray(size // 8)
    for row in rows.collect():
        bits[row["at"] * 4096 : (row["at"] + 1) * 4096] = row["bits"]
    return keys.sparkSession.sparkContext.broadcast(bytes(bits))


def _counted(texts: DataFrame, n: int, shorter: Broadcast | None) -> DataFrame:
    """(key, rows) of n-grams by task; with n = 1 also (lang, rows): all words of a language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Filter(shorter.value) if shorter else None
        for lang, slab in slabs(batches):
            firsts = slab.whole(n)
            if known is not None:
                halves = slab.whole(n - 1)
                frequent = np.zeros(len(slab.hashes) + 1, bool)
                frequent[halves] = known.has(slab.fingerprints(n - 1, halves))
                firsts = firsts[frequent[firsts] & frequent[firsts + 1]]
            keys, rows = np.unique(slab.fingerprints(n, firsts), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.nulls(len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(rows)], ["lang", "key", "rows"])
            if n == 1:
                yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.nulls(1, pa.int64()), pa.array([len(firsts)], pa.int64())], ["lang", "key", "rows"])

    return texts.mapInArrow(run, "lang string, key long, rows long").groupBy("lang", "key").agg(F.sum("rows").alias("rows"))


def _phrases(texts: DataFrame, filters: list[Broadcast]) -> DataFrame:
    """(lang, phrase, words, rows) of phrases whose fingerprint may be frequent, by task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [Filter(x.value) for x in filters]
        held: defaultdict[tuple[str, int], Counter] = defaultdict(Counter)

        def handed_on() -> Iterator[pa.RecordBatch]:
            for (lang, n), counts in held.items():
                columns = [pa.array([lang] * len(counts), pa.string()), pa.array(list(counts), pa.binary()), pa.array([n] * len(counts), pa.int32()), pa.array(list(counts.values()), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "phrase", "words", "rows"])
            held.clear()

        for lang, slab in slabs(batches):
            ids = slab.word_ids()
            for n, frequent in enumerate(known, 1):
                firsts = slab.whole(n)
                keys = slab.fingerprints(n, firsts)
                may = frequent.has(keys)
                firsts, keys = firsts[may], keys[may]
                _, pointer, group, rows = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
                model = firsts[pointer]
                same = np.ones(len(firsts), bool)
                for place in range(n):
                    same &= ids[firsts + place] == ids[model[group] + place]
                if not same.all():  # another phrase under this fingerprint is counted on its own
                    rows = rows - np.bincount(group[~same], minlength=len(rows))
                counts = held[lang, n]
                for first, times in zip(model.tolist(), rows.tolist(), strict=True):
                    counts[slab.phrase(first, n)] += times
                counts.update(slab.phrase(i, n) for i in firsts[~same].tolist())
            if sum(map(len, held.values())) >= HELD_PHRASES:
                yield from handed_on()
        yield from handed_on()

    made = texts.mapInArrow(run, "lang string, phrase binary, words int, rows long")
    return made.groupBy("lang", F.col("phrase").cast("string").alias("phrase"), "words").agg(F.sum("rows").alias("rows"))


def frequent_phrases(docs: DataFrame, rule: Rule = Rule(), lang_col: str = "lang", text_col: str = "text") -> tuple[Stored, Stored]:
    """Phrases of 1 to ``longest`` words with at least ``least`` occurrences: (lang, phrase, words, rows), exact; and
    the words of each language: (lang, n).

    Null languages count as ``und``, null and empty texts have no words, repeated rows count as often as they stand
    there. Empty tables give empty tables; other columns are not read; texts are taken whole.
    """
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("binary").alias("text"))
    filters: list[Broadcast] = []
    totals = None
    for n in range(1, rule.longest + 1):
        kept = _counted(texts, n, filters[-1] if filters else None)
        if n == 1:
            kept = kept.where((F.col("rows") >= rule.least) | F.col("key").isNull())
        else:
            kept = kept.where(F.col("rows") >= rule.least)
        level = store(kept, "phrase-keys")
        if n == 1:
            totals = store(level.df.where("key IS NULL").select("lang", F.col("rows").alias("n")), "phrase-totals")
        keys = level.df.where("key IS NOT NULL")
        count = keys.count()
        if count:
            filters.append(bloom(keys, count))
        level.release()
        if not count:
            break
    found = store(_phrases(texts, filters).where(F.col("rows") >= rule.least), "phrases")
    for used in filters:
        used.destroy()
    return found, totals


def collocations(docs: DataFrame, rule: Rule = Rule(), lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """lang, rank (from 1), phrase, a, l, r, n, score: the best phrases of each language.

    a is the number of occurrences, n the words of the language. Cut after its first k words a phrase has parts with l
    and r occurrences and the score floor(1000 * a * n / (l * r)); the cut with the lowest counts, ties to the smallest
    k. A phrase inside a longer one that occurs as often goes. Ranked by score, a and phrase (bytes); decimals of 38
    digits keep products exact. Nulls, empty tables and repeated rows as in ``frequent_phrases``.
    """
    found, totals = frequent_phrases(docs, rule, lang_col, text_col)
    known = found.df
    longer = known.where("words > 1").withColumn("parts", F.split("phrase", " ")).withColumnRenamed("rows", "a")
    cuts = longer.select("lang", "phrase", "a", "parts", F.explode(F.expr("sequence(1, words - 1)")).alias("k"))
    sides = cuts.select(
        "lang", "phrase", "a", "k", F.array_join(F.expr("slice(parts, 1, k)"), " ").alias("first"), F.array_join(F.expr("slice(parts, k + 1, size(parts) - k)"), " ").alias("rest")
    )
    left, right = (known.select("lang", F.col("phrase").alias(part), F.col("rows").alias(name)) for part, name in (("first", "l"), ("rest", "r")))
    scored = join_measured(join_measured(sides, left, ["lang", "first"]), right, ["lang", "rest"])
    scored = join_measured(scored, totals.df, "lang")
    over = "CAST(a AS DECIMAL(17, 0)) * CAST(n AS DECIMAL(17, 0)) * CAST(1000 AS DECIMAL(4, 0))"
    scored = scored.withColumn("score", F.expr(f"({over}) div (CAST(l AS DECIMAL(17, 0)) * CAST(r AS DECIMAL(17, 0)))"))
    best = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inner = F.expr("flatten(transform(sequence(2, words - 1), w -> transform(sequence(1, words - w + 1), i -> array_join(slice(parts, i, w), ' '))))")
    covered = longer.where("words > 2").select("lang", F.explode(inner).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    open_ = best.join(covered, ["lang", "phrase"], "left").where("most IS NULL OR most < a")
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    ranked = open_.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= rule.top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
