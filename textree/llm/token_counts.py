"""Token counts by rank-synchronous merging over ragged arrays.

Texts are cut into pre-tokens. Those not met before are held as one flat array of symbols with their
sequence numbers; each round looks up the lowest merge rank of every sequence, applies it at all places of
that sequence at once and closes the gaps. Sequences without a further merge leave with their count.
Known pre-tokens are only looked up, so a text costs one split and one sum.
"""

from __future__ import annotations

import functools
import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StructField, StructType
from tokenizers import Tokenizer

from textree.llm.batches import BoundedCache, mapper
from textree.llm.text_encoder import BYTE_OF, UNUSUAL, as_text

NO_RANK = np.iinfo(np.int64).max
#: The library's pattern in the faster built-in module, where both agree: not on UNUSUAL.
PRE_TOKEN = re.compile(r"'(?:[stmd]|re|ve|ll)| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
COUNTS = StructType([StructField("n_bytes", LongType()), StructField("n_tokens", LongType())])


class RankMerger:
    """Counts the symbols that remain of words (as bytes) when all merges are done."""

    def __init__(self, model: dict, byte_of: dict[str, int]):
        vocab = model["vocab"]
        self.base = np.full(256, -1, np.int64)
        for char, byte in byte_of.items():
            self.base[byte] = vocab[char]
        self.width = 1 + max(vocab.values())
        pairs = [x.split(" ") if isinstance(x, str) else x for x in model["merges"]]
        keys = np.array([vocab[a] * self.width + vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int64)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NO_RANK)

    def count(self, words: list[bytes]) -> np.ndarray:
        lengths = np.array([len(x) for x in words], np.int64)
        counts = lengths.copy()
        flat = np.frombuffer(b"".join(words), np.uint8)
        symbols, seq = self.base[flat], np.repeat(np.arange(len(words)), lengths)
        # rank[i] belongs to the pair (i, i + 1); the last symbol of a sequence has none
        rank = np.full(len(symbols), NO_RANK)
        inner = np.flatnonzero(seq[:-1] == seq[1:])
        rank[inner] = self._rank(symbols[inner], symbols[inner + 1])
        while len(symbols):
            starts = np.flatnonzero(np.r_[True, seq[1:] != seq[:-1]])
            sizes = np.diff(np.r_[starts, len(symbols)])
            lowest = np.minimum.reduceat(rank, starts)
            open_ = lowest != NO_RANK
            counts[seq[starts[~open_]]] = sizes[~open_]
            if not open_.all():
                stay = np.repeat(open_, sizes)
                symbols, seq, rank = symbols[stay], seq[stay], rank[stay]
                lowest, sizes = lowest[open_], sizes[open_]
                if not len(symbols):
                    break
            hit = rank == np.repeat(lowest, sizes)
            # of overlapping places (a run of one symbol) every second is merged, from the left
            places = np.flatnonzero(hit)
            run = np.flatnonzero(np.r_[True, np.diff(places) != 1])
            offset = np.arange(len(places)) - np.repeat(run, np.diff(np.r_[run, len(places)]))
            places = places[offset % 2 == 0]
            symbols[places] = self.made[rank[places]]
            stay = np.ones(len(symbols), bool)
            stay[places + 1] = False
            merged = np.zeros(len(symbols), bool)
            merged[places] = True
            symbols, seq, rank, merged = symbols[stay], seq[stay], rank[stay], merged[stay]
            merged[:-1] |= merged[1:]
            at = np.flatnonzero(merged)
            rank[at] = NO_RANK
            at = at[at + 1 < len(symbols)]
            at = at[seq[at] == seq[at + 1]]
            rank[at] = self._rank(symbols[at], symbols[at + 1])
        return counts


class Counter:
    """Token counts of texts as the library's ``encode(text, add_special_tokens=False)`` has them."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.cut = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self.merger = RankMerger(spec["model"], BYTE_OF)
        special = [re.escape(x["content"]) for x in spec["added_tokens"]]
        self.special = re.compile("|".join(sorted(special, key=len, reverse=True)) or r"(?!)")
        self.special_starts = {x["content"][:2] for x in spec["added_tokens"]}
        self.known: BoundedCache = BoundedCache()

    def words(self, text: str) -> list[str]:
        """Pre-tokens; those of texts with unusual characters come from the library itself."""
        if not UNUSUAL.search(text):
            return PRE_TOKEN.findall(text)
        return [as_text(x) for x, _ in self.cut(text)]

    def count(self, texts: list[str]) -> list[int]:
        self.known.make_room()
        parts, specials = [], []
        for text in texts:
            if any(x in text for x in self.special_starts):
                pieces = self.special.split(text)
                specials.append(len(pieces) - 1)
                parts.append([x for piece in pieces if piece for x in self.words(piece)])
            else:
                specials.append(0)
                parts.append(self.words(text))
        fresh = [x for x in set().union(*parts) if x not in self.known]
        if fresh:
            counts = self.merger.count([x.encode("utf-8", "surrogateescape") for x in fresh])
            self.known.update(zip(fresh, counts.tolist(), strict=True))
        get = self.known.__getitem__
        counts = [n + sum(map(get, p)) for n, p in zip(specials, parts, strict=True)]
        for word in fresh:  # long ones are rarely met again and would fill the cache
            if len(word) > 64:
                del self.known[word]
        return counts


@functools.lru_cache(maxsize=1)
def counter(path: str) -> Counter:
    """One per Python worker: its known pieces outlive the task."""
    return Counter(path)


def count_tokens(
    docs: DataFrame,
    tokenizer_path: str,
    limit: int = 1024,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: dict[str, tuple[Column, str]] | None = None,
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for each row of ``docs``, and the columns ``keep`` (name: value, type).

    Null and empty texts have 0 bytes and 0 tokens; repeated rows and null ids each give a row; an empty
    table gives an empty table; other columns are not read. A narrow projection: no shuffle. Very long
    texts are cut like others and never shortened. ``tokenizer_path`` must exist on every executor.
    """

    def make():
        count = counter(tokenizer_path).count
        return lambda texts: {"n_bytes": [len(x.encode("utf-8")) for x in texts], "n_tokens": count(texts)}

    kept = {f"_{name}": value.cast(kind).alias(f"_{name}") for name, (value, kind) in (keep or {}).items()}
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *kept.values())
    arrow = to_arrow_schema(rows.drop("text").schema)
    schema = pa.schema([*arrow, ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])
    out = StructType([*rows.drop("text").schema, *COUNTS])
    counted = rows.mapInArrow(mapper(make, ["doc_id", *kept], "text", schema), out)
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), *[F.col(x).alias(x[1:]) for x in kept])
