"""The Merkle manifest against a plain tree, and its bitmaps."""

import hashlib
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from textree.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, g int, place string"


def plain_hash(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def plain_leaf(row, text):
    return plain_hash(*[plain_field(x) for x in (row[0], row[3], row[2], row[4], text)])


def plain_levels(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([plain_hash(*below[i : i + 16]) for i in range(0, len(below), 16)])
    return levels


def plain_path(levels, place):
    path = []
    for level in levels[:-1]:
        start = place // 16 * 16
        path.append((level[start:place], level[place + 1 : start + 16]))
        place //= 16
    return path


def plain_manifest(rows):
    lowered = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    groups = {}
    for row in rows:
        groups.setdefault(row[3], []).append((row, plain_leaf(row, row[1])))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for name in order:
        groups[name].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
    trees = {name: plain_levels([leaf for _, leaf in groups[name]]) for name in order}
    whole = plain_levels([trees[name][-1][0] for name in order])
    out = []
    for at, name in enumerate(order):
        for place, (row, leaf) in enumerate(groups[name]):
            path = plain_path(trees[name], place) + plain_path(whole, at)
            tampered = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0
            now = plain_leaf(row, row[1] and row[1].translate(lowered)) if tampered else leaf
            for left, right in path:
                now = plain_hash(*left, now, *right)
            proof = plain_hash(*[x for left, right in path for x in left + right])
            out.append((row[0], leaf, trees[name][-1][0], whole[-1][0], proof, now, now == whole[-1][0]))
    return sorted(out, key=str)


def found(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5) if rows else spark.createDataFrame([], SCHEMA)
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    columns = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    made = merkle.manifest(docs, other=F.when(tampered, merkle.digest([*columns, merkle.lowered(F.col("text"))])))
    got = made.select(
        "id", "leaf", "subroot", "root", F.sha2(F.concat_ws("", merkle.siblings(F.col("path"))), 256).alias("proof"),
        merkle.folded(F.coalesce("other", "leaf"), F.col("path")).alias("fold"),
    ).collect()
    return sorted([(*r, r.fold == r.root) for r in got], key=str)


def test_manifest_equals_plain_tree(spark):
    draw = random.Random(3)
    rows = [(i, f"Text {i} Äö", "en", draw.choice(["b", "a", "ä", "hot", "hot", "hot"]), i, 1, "x") for i in range(700)]
    rows += [(10**15 + 70_000 * i, "", None, "far", None, None, None) for i in range(40)]
    rows += [(-i, "A" * i, "de", "minus", i, 0, "") for i in range(1, 300)]
    rows += [(7, None, "en", None, None, 1, "x"), (8, "lone", "en", "lone", 4, 1, "x")]
    assert found(spark, rows) == plain_manifest(rows)


def test_manifest_with_repeated_and_null_ids(spark):
    rows = [(None, f"n{i % 3}", "en", "a", 1, 1, "x") for i in range(40)]
    rows += [(5, f"copy {i % 2}", "en", "a", 1, 1, "x") for i in range(100)] + [(i, "x", "en", "a", 1, 1, "x") for i in range(30)]
    rows += [(None, None, None, None, None, None, None)] * 17
    assert found(spark, rows) == plain_manifest(rows)


def test_manifest_of_few_rows(spark):
    assert found(spark, []) == []
    one = [(3, "Only", "en", "a", 4, 1, "x")]
    assert found(spark, one) == plain_manifest(one)
    many = [(i, "T", "en", f"s{i:03d}", 4, 1, "x") for i in range(300)]
    assert found(spark, many) == plain_manifest(many)


def test_rank_directory():
    draw = np.random.default_rng(1)
    for size in (0, 1, 50, 4095, 4096, 30_000, 65_536):
        lows = np.sort(draw.choice(65_536, size, replace=False))
        bits = merkle.packed(lows)
        assert len(bits) <= 8192 and (merkle.members(bits) == lows).all()
        again = lows[::7]
        more = draw.integers(1, 5, len(again))
        directory = merkle.RankDirectory(bits, again.astype("<u2").tobytes(), more.astype("<i8").tobytes())
        asked = draw.integers(0, 65_536, 500)
        counts = np.bincount(lows, minlength=65_536)
        counts[again] += more
        assert (directory.rank(asked) == np.concatenate(([0], np.cumsum(counts)))[asked]).all()
        assert (directory.is_repeated(asked) == np.isin(asked, again)).all()


def test_a_crowded_bucket_is_dealt_to_parts(spark, monkeypatch):
    monkeypatch.setattr(merkle, "HELD_IDS", 100)
    monkeypatch.setattr(merkle, "PART_ROWS", 20)
    rows = [(i % 50, str(i), "en", "a", 1, 1, "x") for i in range(900)]
    assert found(spark, rows) == plain_manifest(rows)
