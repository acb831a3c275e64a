"""BPE encoding and decoding by dynamic programming over prefixes.

An automaton of all tokens, with links from each state to its longest suffix, gives the tokens that end at
each place of a word. The encoding of a prefix ends in exactly one token: the one that spans the prefix from
a place whose own last token it may follow. Two tokens may stand side by side if no merge across their border
would have come before the merges that made them; a test walks those merges back. Following the stored last
tokens from the end of the word gives its ids.
"""

from __future__ import annotations

import functools
import json
from itertools import pairwise

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textree.llm.batches import BoundedCache, mapper
from textree.llm.text_encoder import BYTE_OF, TextEncoder, id_lists

LAST = 0xE000  # symbols that end a word are written as other characters, from here on
NEVER = 1 << 60
SCHEMA = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])


class PrefixBpe:
    """Words (in the byte-level alphabet) to ids for one vocabulary with ranked merges."""

    def __init__(self, model: dict):
        vocab, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        self.suffix = suffix
        shape = {}
        for char in BYTE_OF:
            if char in vocab:
                shape[char] = char
            if suffix and char + suffix in vocab:
                shape[char + suffix] = chr(LAST + ord(char))
        self.left, self.right, self.rank, self.pair = {}, {}, {}, {}
        for token in shape:
            self.rank[vocab[token]] = -1
        for place, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            made = vocab[a + b]
            self.pair[vocab[a], vocab[b]] = place
            if made in self.rank:
                raise ValueError("a token that two merges make is not supported")
            shape[a + b] = shape[a] + shape[b]
            self.left[made], self.right[made], self.rank[made] = vocab[a], vocab[b], place
        self.shape = {vocab[token]: text for token, text in shape.items()}
        self.number = {text: number for number, text in self.shape.items()}
        self.matches = ahocorasick.Automaton()
        for token, text in self.shape.items():
            if self._reachable(token):
                self.matches.add_word(text, (token, len(text)))
        self.matches.make_automaton()
        self.fits: BoundedCache = BoundedCache()

    def compatible(self, x: int, y: int) -> bool:
        """Whether the merges leave ``x`` next to ``y``: undo them from the last to the first and look for
        a merge across the border that would have come earlier (on equal rank the left place is first)."""
        rank, until_x, until_y = self.rank, NEVER, NEVER
        while True:
            across = self.pair.get((x, y))
            if across is not None and across < until_x and across <= until_y:
                return False
            made_x, made_y = rank[x], rank[y]
            if made_x < 0 and made_y < 0:
                return True
            if made_x > made_y:
                until_x, x = made_x, self.right[x]
            else:
                until_y, y = made_y, self.left[y]

    def _reachable(self, token: int) -> bool:
        """Whether merging the token's own symbols gives the token; others never end a prefix."""
        parts = [self.number[x] for x in self.shape[token]]
        while len(parts) > 1:
            place, at = min((self.pair.get((x, y), NEVER), i) for i, (x, y) in enumerate(pairwise(parts)))
            if place == NEVER:
                break
            parts[at : at + 2] = [self.number[self.shape[parts[at]] + self.shape[parts[at + 1]]]]
        return parts == [token]

    def encode(self, word: str) -> list[int]:
        if not word:
            return []
        if self.suffix:
            word = word[:-1] + chr(LAST + ord(word[-1]))
        size = len(word)
        last, length = [-1] * (size + 1), [0] * (size + 1)
        fits = self.fits
        for end, (token, span) in self.matches.iter(word):
            end += 1
            if last[end] >= 0:
                continue
            if end > span:
                previous = last[end - span]
                if previous < 0:
                    continue
                fit = fits.get((previous, token))
                if fit is None:
                    fits.make_room()
                    fit = fits[previous, token] = self.compatible(previous, token)
                if not fit:
                    continue
            last[end], length[end] = token, span
        ids = []
        while size > 0:
            if last[size] < 0:
                raise ValueError("a symbol of the word is not in the vocabulary")
            ids.append(last[size])
            size -= length[size]
        ids.reverse()
        return ids


class Decoder:
    """Texts of ids as the library's ``decode(ids, skip_special_tokens=False)``: tokens set apart by spaces
    where the file names no decoder, bytes (invalid ones replaced) where it names the byte-level one."""

    def __init__(self, spec: dict):
        token = {i: x for x, i in spec["model"]["vocab"].items()}
        token |= {x["id"]: x["content"] for x in spec["added_tokens"]}
        self.token = np.array([token.get(i, "") for i in range(1 + max(token))], object)
        kind = (spec["decoder"] or {}).get("type")
        if kind not in (None, "ByteLevel"):
            raise ValueError(f"decoder {kind} is not supported")
        self.byte_of = BYTE_OF if kind else None

    def decode(self, ids: np.ndarray) -> str:
        tokens = self.token[ids].tolist()
        if self.byte_of is None:
            return " ".join(tokens)
        out = bytearray()
        for token in tokens:
            known = all(x in self.byte_of for x in token)
            out += bytes(map(self.byte_of.__getitem__, token)) if known else token.encode("utf-8")
        return out.decode("utf-8", "replace")


@functools.lru_cache(maxsize=1)
def codec(path: str) -> tuple[TextEncoder, Decoder]:
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    return TextEncoder(path, PrefixBpe(spec["model"]).encode), Decoder(spec)


def encode_decode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (array of int) and decoded (text of those ids) for each row of ``docs``.

    Null and empty texts give no ids and an empty text; repeated rows and null ids each give a row; an empty
    table gives an empty table; other columns are not read. A narrow projection: no shuffle. Very long texts
    are encoded whole. ``tokenizer_path`` must exist on every executor.
    """

    def make():
        encoder, decoder = codec(tokenizer_path)

        def work(texts: list[str]) -> dict[str, list]:
            ids = [encoder.encode(x) for x in texts]
            return {"ids": id_lists(ids), "decoded": [decoder.decode(np.frombuffer(x, "<i4")) for x in ids]}

        return work

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(mapper(make, ["doc_id"], "text", SCHEMA), "doc_id long, ids array<int>, decoded string")
