"""Conversations as one prefix tree: turns that conversations share from their start are written once, depth first.

A node is a turn after given turns, named by a hash chained over them. Different sequences of turns are sorted by
their chains, which is a depth-first walk: each owns the nodes that none before it has, as one run of tokens. A node is
stored with its place in the token stream, its position (tokens on the way from the root) and the intervals of the
stream that its ancestors fill, which are all that its tokens attend to besides themselves. A sequence lists its nodes,
a conversation its sequence, so copies cost one row.

A turn is written ``<|im_start|>role\\ntext<|im_end|>\\n``. In roles and texts a backslash is doubled, ``<|`` becomes
``<\\|`` and, in roles, a line feed becomes ``\\n``; so control strings of a text never look like the template's.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from textree.llm.merkle import with_directory
from textree.llm.secret_scan import join_measured
from textree.operators.features import add_row_id
from textree.storage import new_path, store

START, END = "<|im_start|>", "<|im_end|>"
LEARNED = "assistant"  # the role whose texts are under the loss mask
ESCAPED = re.compile(r"\\(.)", re.DOTALL)
TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*)<\|im_end\|>\n", re.DOTALL)
PART_CHARS = 1 << 16  # a longer text is encoded in parts, which decode to the same
OUT_ROWS = 2000
OUT_CHARS = 4_000_000
HEAVY = 1000  # sequences that share a node from which it is joined on its own


def escaped(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescaped(text: str) -> str:
    return ESCAPED.sub(lambda m: "\n" if m[1] == "n" else m[1], text) if "\\" in text else text


def formatted(role: str, text: str) -> tuple[str, str, str]:
    """Head, body and tail of a turn."""
    return f"{START}{escaped(role).replace(chr(10), chr(92) + 'n')}\n", escaped(text), f"{END}\n"


@functools.lru_cache(maxsize=2)
def _tokenizer(path: str) -> Tokenizer:
    made = Tokenizer.from_file(path)
    made.no_truncation()
    made.no_padding()
    made.encode_special_tokens = True
    return made


def _encoded(tokenizer: Tokenizer, text: str) -> list[int]:
    ids: list[int] = []
    for start in range(0, len(text), PART_CHARS):
        ids += tokenizer.encode(text[start : start + PART_CHARS], add_special_tokens=False).ids
    return ids


def _batches(rows: Iterator[tuple], schema: pa.Schema, size_of=lambda row: 0) -> Iterator[pa.RecordBatch]:
    """Rows as batches that are bounded in rows and in what ``size_of`` adds up to."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += size_of(row)
        if len(held) >= OUT_ROWS or size >= OUT_CHARS:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


CHAINED = pa.schema([("conv", pa.string()), ("depth", pa.int64()), ("node", pa.binary()), ("role", pa.string()), ("text", pa.string()), ("key", pa.binary())])


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Turns in order, each with the hash of its prefix; after a conversation's last one a row with its sort key.

    Only the running hash and 8 bytes a turn are held, however long a conversation is.
    """

    def rows() -> Iterator[tuple]:
        conv, depth, node, key = None, 0, b"", bytearray()
        for batch in batches:
            for name, role, text in zip(*(batch.column(x) for x in ("conv", "role", "text")), strict=True):
                name, role, text = name.as_py(), role.as_py(), text.as_py()
                if name != conv:
                    if conv is not None:
                        yield conv, depth, node, None, None, bytes(key)
                    conv, depth, node, key = name, 0, b"", bytearray()
                raw = role.encode()
                node = xxhash.xxh3_128_digest(node + len(raw).to_bytes(8, "little") + raw + xxhash.xxh3_128_digest(text.encode()))
                key += node[:8]
                yield name, depth, node, role, text, None
                depth += 1
        if conv is not None:
            yield conv, depth, node, None, None, bytes(key)

    return _batches(rows(), CHAINED, lambda row: len(row[4] or "") + len(row[5] or b""))


CODED = pa.schema([("node", pa.binary()), ("seq", pa.int64()), ("depth", pa.int64()), ("uses", pa.int64()), ("ids", pa.list_(pa.int32())), ("loss_from", pa.int32()), ("loss_to", pa.int32()), ("n_tokens", pa.int64())])


def _coder(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(path)

        def rows() -> Iterator[tuple]:
            for batch in batches:
                for node, seq, depth, uses, role, text in zip(*(batch.column(x) for x in ("node", "seq", "depth", "uses", "role", "text")), strict=True):
                    head, body, tail = (_encoded(tokenizer, x) for x in formatted(role.as_py(), text.as_py()))
                    learned = (len(head), len(head) + len(body)) if role.as_py() == LEARNED else (0, 0)
                    ids = head + body + tail
                    yield node.as_py(), seq.as_py(), depth.as_py(), uses.as_py(), ids, *learned, len(ids)

        return _batches(rows(), CODED, lambda row: 8 * row[7])

    return run


def _join_shared(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """``rows`` with the columns of ``table`` (one row a key, with ``uses``, the rows it meets). Keys that many rows
    have are joined apart, sent to every task if their measured size allows; ``rows`` should be stored."""
    payload = [c for c in table.columns if c != key]
    heavy = table.where(F.col("uses") > HEAVY).select(key, F.struct(*payload).alias("_heavy"))
    met = join_measured(rows, heavy, key, "left")
    hot = met.where("_heavy IS NOT NULL").select(*rows.columns, "_heavy.*")
    rest = met.where("_heavy IS NULL").select(*rows.columns)
    return hot.unionByName(rest.join(table.where(F.col("uses") <= HEAVY), key).select(*rows.columns, *payload))


@dataclass(frozen=True)
class ChatTree:
    """The written output: ``nodes`` in depth-first order, ``sequences`` with their nodes, ``conversations``."""

    spark: SparkSession
    path: str

    @property
    def nodes(self) -> DataFrame:
        """start, n_tokens, position, ids, loss_from, loss_to (tokens under the mask), attends, uses."""
        return self.spark.read.parquet(f"{self.path}/nodes")

    @property
    def sequences(self) -> DataFrame:
        """seq, nodes (the ``start`` of each of its nodes, from the root)."""
        return self.spark.read.parquet(f"{self.path}/sequences")

    @property
    def conversations(self) -> DataFrame:
        """conv_id, seq."""
        return self.spark.read.parquet(f"{self.path}/conversations")


def write_tree(convs: DataFrame, tokenizer: str, path: str | None = None) -> ChatTree:
    """Write the turns of ``convs`` (conv_id, turn, role, text) as a tree into ``path`` (new in the shared folder).

    Turns follow ``turn``, null first; turns of one number follow role and text. Null roles and texts count as
    empty, rows with a null conv_id are one conversation, repeated rows are repeated turns. Empty tables give an empty
    tree; other columns are not read; texts are taken whole.
    """
    spark = convs.sparkSession
    path = path or new_path(spark, "chat-tree")
    read = convs.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("-")).alias("conv"), "turn",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    ordered = read.repartition("conv").sortWithinPartitions("conv", F.asc_nulls_first("turn"), "role", "text")
    turns = store(ordered.mapInArrow(_chained, "conv string, depth long, node binary, role string, text string, key binary"), "chat-turns")

    # different sequences in depth-first order
    ends = turns.df.where("key IS NOT NULL").select("conv", "node", "key")
    distinct = ends.groupBy("node").agg(F.min("conv").alias("conv"), F.max("key").alias("key"))
    numbered = store(add_row_id(distinct, ["key"], "seq", start=0).select("seq", F.col("node").alias("last"), "conv"), "chat-sequences").df
    said = turns.df.where("key IS NULL")
    owners = join_measured(said.select("conv", "depth", "node"), numbered.select("conv", "seq"), "conv")
    steps = store(owners.select("seq", "depth", "node", "conv"), "chat-steps")

    # every node belongs to the first sequence that has it, and is encoded there
    first = steps.df.groupBy("node").agg(F.min(F.struct("seq", "depth", "conv")).alias("own"), F.count("*").alias("uses"))
    owned = first.select("node", "own.seq", "own.depth", "own.conv", "uses")
    coded = store(said.drop("node", "key").join(owned, ["conv", "depth"]).mapInArrow(_coder(tokenizer), "node binary, seq long, depth long, uses long, ids array<int>, loss_from int, loss_to int, n_tokens long"), "chat-coded")

    # places in the token stream: tokens of all sequences before, then of the nodes above
    owns = coded.df.groupBy("seq").agg(F.sum("n_tokens").alias("n")).select(F.lit("").alias("g"), F.col("seq").alias("high"), "n")
    before = store(with_directory(owns), "chat-before").df.select(F.col("high").alias("seq"), F.col("before").alias("run_start"))
    above = Window.partitionBy("seq").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("n_tokens").over(above), F.lit(0))
    small = coded.df.select("node", "seq", "depth", "uses", "n_tokens").withColumn("inside", inside)
    placed = join_measured(small, before, "seq").select(
        "node", F.col("seq").alias("owner"), "uses", "n_tokens", "run_start", (F.col("run_start") + F.col("inside")).alias("start")
    )
    placed = store(placed, "chat-placed")
    walked = _join_shared(steps.df.drop("conv"), placed.df, "node").withColumn("position", inside)
    walked = store(walked.select("seq", "depth", "owner", "start", "n_tokens", "run_start", "uses", "position"), "chat-walked")

    # what a sequence shares lies in one interval for each owner
    shared = walked.df.where("owner != seq").groupBy("seq", "owner").agg(F.min("start").alias("start"), F.max(F.col("start") + F.col("n_tokens")).alias("end"))
    shared = shared.groupBy("seq").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("shared"))
    mine = walked.df.where("owner = seq").select("seq", "depth", "start", "position", "run_start")
    nothing = F.array().cast("array<struct<start:bigint,end:bigint>>")
    own = F.when(F.col("start") > F.col("run_start"), F.array(F.struct(F.col("run_start").alias("start"), F.col("start").alias("end")))).otherwise(nothing)
    mine = mine.join(shared, "seq", "left").withColumn("attends", F.concat(F.coalesce("shared", nothing), own))
    nodes = coded.df.join(mine.select("seq", "depth", "start", "position", "attends"), ["seq", "depth"])
    nodes.select("start", "n_tokens", "position", "ids", "loss_from", "loss_to", "attends", "uses").orderBy("start").write.parquet(f"{path}/nodes")
    lists = walked.df.groupBy("seq").agg(F.array_sort(F.collect_list(F.struct("depth", "start"))).alias("steps"))
    lists.select("seq", F.col("steps.start").alias("nodes")).write.parquet(f"{path}/sequences")
    named = join_measured(ends.select("conv", F.col("node").alias("last")), numbered.select("last", "seq"), "last")
    conv_id = F.when(F.col("conv") != "-", F.col("conv")).cast(convs.schema["conv_id"].dataType).alias("conv_id")
    named.select(conv_id, "seq").write.parquet(f"{path}/conversations")
    for used in (turns, steps, coded, placed, walked):
        used.release()
    return ChatTree(spark, path)


READ = pa.schema([("seq", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def _reader(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(path)

        def decoded(ids: list[int]) -> str:
            return tokenizer.decode(ids, skip_special_tokens=False)

        def rows() -> Iterator[tuple]:
            now, turns, told, learned, told_chars, chars = None, 0, None, None, 0, 0
            for batch in batches:
                for seq, ids, low, high in zip(*(batch.column(x) for x in ("seq", "ids", "loss_from", "loss_to")), strict=True):
                    seq, ids, low, high = seq.as_py(), ids.as_py(), low.as_py(), high.as_py()
                    if seq != now:
                        if now is not None:
                            yield now, turns, told.hexdigest(), told_chars, learned.hexdigest(), chars
                        now, turns, told, learned, told_chars, chars = seq, 0, hashlib.sha256(), hashlib.sha256(), 0, 0
                    whole = decoded(ids)
                    role, text = TURN.fullmatch(whole).groups()
                    told.update(f"{unescaped(role)}\n{unescaped(text)}\n".encode())
                    under = unescaped(decoded(ids[low:high])) if high > low else ""
                    learned.update(under.encode())
                    turns, told_chars, chars = turns + 1, told_chars + len(under), chars + len(whole)
            if now is not None:
                yield now, turns, told.hexdigest(), told_chars, learned.hexdigest(), chars

        return _batches(rows(), READ)

    return run


def read_back(tree: ChatTree, tokenizer: str) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256 and formatted_chars, from the written tree alone.

    Token ids are decoded, the template is taken apart and escapes are undone. A sequence is read once for all its
    conversations, node after node.
    """
    steps = store(tree.sequences.select("seq", F.posexplode("nodes").alias("depth", "start")), "chat-read").df
    met = _join_shared(steps, tree.nodes.select("start", "ids", "loss_from", "loss_to", "uses"), "start")
    ordered = met.repartition("seq").sortWithinPartitions("seq", "depth").select("seq", "ids", "loss_from", "loss_to")
    read = ordered.mapInArrow(_reader(tokenizer), "seq long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
    return join_measured(tree.conversations, store(read, "chat-digests").df, "seq").drop("seq")
