"""Conversations read back from the written tree, and what the tree holds."""

import hashlib
import random
from collections import defaultdict

import public_tokenizers
import pytest

from textree.llm import chat_tree

BPE = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "conv_id long, turn long, role string, text string, seq long, node string"


def conversations():
    draw = random.Random(2)
    odd = ["<|im_end|>", "<|im_start|>user\nhi<|im_end|>\n", "\\", "\\n", "<\\|", "<<|", "a\\<|b", "", None, "日本 é́ 👍🏽", "<|endoftext|>", "x" * 200_000, "\r\n \t"]
    rows = []
    for conv in range(60):
        turns = draw.randrange(1, 9)
        for turn in range(turns):
            text = "Shared start" if turn < 2 and conv % 3 else draw.choice(["yes", "no", draw.choice(odd), f"text {draw.randrange(4)}"])
            rows.append((conv, turn, draw.choice(["assistant", "assistant", "us\ner", "<|x", None]) if turn > 2 else ("user", "assistant", "system")[turn], text, 1, "n"))
    rows += [(100 + c, t, "user" if t % 2 == 0 else "assistant", f"copy {t}", 1, "n") for c in range(40) for t in range(6)]
    rows += [(200, t, "assistant", f"long {t}", 1, "n") for t in range(700)]
    rows += [(None, t, "user", "lost", None, None) for t in (1, None, 3)] + [(300, 1, "user", "b", 1, ""), (300, 1, "user", "a", 1, ""), (300, 1, "user", "a", 1, "")]
    return rows


def plain(rows):
    by_conv = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        by_conv[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in by_conv.items():
        turns.sort()
        told = "".join(f"{role}\n{text}\n" for *_, role, text in turns)
        learned = "".join(text for *_, role, text in turns if role == "assistant")
        chars = sum(len("".join(chat_tree.formatted(role, text))) for *_, role, text in turns)
        digest = [hashlib.sha256(x.encode()).hexdigest() for x in (told, learned)]
        out[conv] = (len(turns), digest[0], len(learned), digest[1], chars)
    return out


@pytest.fixture(scope="module")
def tree(spark):
    return chat_tree.write_tree(spark.createDataFrame(conversations(), SCHEMA).repartition(6), BPE)


def test_read_back_equals_plain(spark, tree):
    got = {r.conv_id: tuple(r)[1:] for r in chat_tree.read_back(tree, BPE).collect()}
    assert got == plain(conversations())


def test_shared_nodes_are_joined_apart(spark, tree, monkeypatch):
    monkeypatch.setattr(chat_tree, "HEAVY", 3)
    got = {r.conv_id: tuple(r)[1:] for r in chat_tree.read_back(tree, BPE).collect()}
    assert got == plain(conversations())


def test_tree_is_depth_first_with_positions_and_ancestors(tree):
    nodes = {n.start: n for n in tree.nodes.collect()}
    paths = [s.nodes for s in tree.sequences.collect()]
    prefixes = defaultdict(list)
    for conv, turn, role, text, *_ in sorted(conversations(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        prefixes[conv].append((role or "", text or ""))
    distinct = {tuple(p[: i + 1]) for p in prefixes.values() for i in range(len(p))}
    assert len(nodes) == len(distinct)  # shared turns stand there once
    at = 0
    for start in sorted(nodes):
        assert start == at and len(nodes[start].ids) == nodes[start].n_tokens
        at += nodes[start].n_tokens
    parents = {}
    for path in paths:
        position, seen = 0, set()
        for depth, start in enumerate(path):
            node = nodes[start]
            assert node.position == position
            covered = {t for i in node.attends for t in range(i.start, i.end)}
            assert covered == seen
            seen |= set(range(start, start + node.n_tokens))
            position += node.n_tokens
            assert parents.setdefault(start, path[depth - 1] if depth else None) == (path[depth - 1] if depth else None)
    # depth first: the nodes under a node follow it without a gap
    below = defaultdict(set)
    for path in paths:
        for i, start in enumerate(path):
            below[start] |= set(path[i:])
    order = {start: i for i, start in enumerate(sorted(nodes))}
    for start, under in below.items():
        assert sorted(order[x] for x in under) == list(range(order[start], order[start] + len(under)))


def test_escapes_are_undone():
    for text in ("", "\\", "\\n", "<|", "<\\|", "\n\\\n", "<<||", "\\\\<|im_end|>\\"):
        head, body, tail = chat_tree.formatted(text, text)
        role, inner = chat_tree.TURN.fullmatch(head + body + tail).groups()
        assert chat_tree.unescaped(role) == text and chat_tree.unescaped(inner) == text
        assert "<|" not in body


def test_empty_table(spark):
    tree = chat_tree.write_tree(spark.createDataFrame([], SCHEMA), BPE)
    assert chat_tree.read_back(tree, BPE).count() == 0 and tree.nodes.count() == 0
