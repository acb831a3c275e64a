"""Phrases against plain counting."""

import random
import re
from collections import Counter

import numpy as np

from textree.llm import collocations
from textree.llm.collocations import Rule, Slab

SCHEMA = "doc_id long, text string, lang string, rows long, key string"


def plain_collocations(rows, rule):
    counts, totals = {}, Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for n in range(1, rule.longest + 1):
                for i in range(len(words) - n + 1):
                    counts.setdefault(lang, Counter())[tuple(words[i : i + n])] += 1
    out = []
    for lang, f in counts.items():
        chosen = {p: a for p, a in f.items() if len(p) > 1 and a >= rule.least}
        listed = []
        for p, a in chosen.items():
            cuts = [(1000 * a * totals[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            inside = any(len(q) > len(p) and 100 * b >= 100 * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in chosen.items())
            if not inside:
                listed.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(listed)[: rule.top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def texts():
    draw = random.Random(5)
    words = [f"w{i}" for i in range(25)] + ["Über", "naïve", "x" * 9, "日本語", "a b", "\x1c"]
    phrases = ["New York city", "carpe\tdiem", "x" * 30 + " is  long", "one two three four five six"]
    rows = []
    for i in range(400):
        parts = [draw.choice(phrases) if draw.random() < 0.2 else draw.choice(words) for _ in range(draw.randrange(1, 60))]
        text = "".join(p + draw.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", "!"]) for p in parts)
        rows.append((i, text, draw.choice(["en", "en", "de", None, ""]), 1, "k"))
    return rows + [(None, None, "en", None, None), (1, "", None, 1, ""), (2, "...", "fr", 1, ""), (0, rows[0][1], rows[0][2], 1, "")]


def found(spark, rows, rule):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4) if rows else spark.createDataFrame([], SCHEMA)
    return sorted(tuple(r) for r in collocations.collocations(docs, rule).collect())


def test_collocations_equal_plain_counting(spark):
    for rule in (Rule(least=20), Rule(least=5, top=30), Rule(least=10, longest=3)):
        want = plain_collocations(texts(), rule)
        assert want and found(spark, texts(), rule) == want


def test_small_slabs_and_windows_change_nothing(spark, monkeypatch):
    want = plain_collocations(texts(), Rule(least=20))
    monkeypatch.setattr(collocations, "WINDOW_BYTES", 50)
    monkeypatch.setattr(collocations, "SLAB_BYTES", 700)
    parts = list(collocations._windows(b"one two. three, " * 30))
    assert len(parts) > 5 and b" ".join(b" ".join(x.split()) for x in parts).count(b"three") == 30
    assert found(spark, texts(), Rule(least=20)) == want


def test_nothing_frequent_and_empty_table(spark):
    assert found(spark, [], Rule()) == []
    assert found(spark, texts()[:3], Rule()) == []


def test_exact_score_beyond_64_bits(spark):
    row = spark.sql("SELECT (CAST(99999999999L AS DECIMAL(17,0)) * CAST(99999999999999L AS DECIMAL(17,0)) * CAST(1000 AS DECIMAL(4,0))) div (CAST(7L AS DECIMAL(17,0)) * CAST(99999999999L AS DECIMAL(17,0))) AS s")
    assert row.first().s == 1000 * 99999999999 * 99999999999999 // (7 * 99999999999)


def test_words_of_one_hash_are_told_apart():
    slab = Slab("en", [b"aa bb aa cccccccccccc bb cccccccccccd"])
    slab.hashes = np.full(len(slab.hashes), 9, np.uint64)  # as if every word had the same hash
    ids = slab.word_ids().tolist()
    assert ids[0] == ids[2] and ids[1] == ids[4] and len(set(ids)) == 4
