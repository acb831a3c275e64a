"""Toxicity scores by held-out accuracy and by hand; packing against a plain search over all bins."""

import math
import random
import re
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from textree.llm import packing, token_counts, toxicity
from textree.llm.queries import QUERIES, packed, table

MIDDLE = "/root/testdata/sf0.01"


def test_folding():
    assert toxicity.fold("ІDIОT") == "idiot"  # Cyrillic I and O
    assert toxicity.fold("l0s3r m0r0n 1diot") == "loser moron idiot"
    assert toxicity.fold("10 2024 a1 x5") == "10 2024 a1 x5"


def test_matches_words_beginnings_and_exceptions():
    matcher = toxicity.Matcher({"bad ": 2.0, "lowei": 3.0, "low ": 1.0, "lowe ": 5.0}, frozenset({"not bad"}))
    assert matcher.weigh("bad BAD badly unbad")[1] == 4.0
    assert matcher.weigh("not bad, bad")[1] == 2.0
    assert matcher.weigh("loweium xlowei low lowe")[1] == 9.0
    assert matcher.weigh("") == (0, 0.0)
    assert toxicity.Matcher({}).weigh("bad") == (1, 0.0)


def synthetic(spark, n=600):
    draw = random.Random(8)
    word = lambda: "".join(draw.choice("abcdefghij") for _ in range(5))
    rows = []
    for i in range(n):
        toxic = i % 5 == 0
        words = [word() for _ in range(draw.randrange(5, 60))]
        if toxic:
            words.insert(draw.randrange(len(words)), draw.choice(["scum", "m0ron", "vileword"]))
        elif i % 40 == 1:
            words[2:2] = ["no", "scum"]
        rows.append((i, " ".join(words), int(toxic)))
    return rows, spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(4)


def test_exception_phrases_are_learned(spark):
    rows, df = synthetic(spark)
    model = toxicity.fit(df)
    assert "no scum" in model.exceptions
    got = {r.doc_id: r.predicted for r in toxicity.score(df, model).collect()}
    assert sum(got[i] == y for i, _, y in rows) >= 0.97 * len(rows)
    kept = toxicity.drop_toxic(df.withColumn("weight", F.lit("w")), model)
    assert {r.doc_id for r in kept.collect()} == {i for i, p in got.items() if p == 0}
    assert kept.columns == ["doc_id", "text", "toxic", "weight"]


def plain_weight(text, lexicon, exceptions):
    """Word by word, without an automaton."""
    folded, total = toxicity.fold(text), 0.0
    words = [(m.start(), m.end(), m[0]) for m in re.finditer(r"[^\W\d_]+", folded)]
    for at, (start, end, word) in enumerate(words):
        weights = [lexicon.get(word + " ", 0.0), *(lexicon.get(word[:k], 0.0) for k in range(1, len(word) + 1))]
        near = [f"{w} {word}" for _, e, w in words[max(0, at - 1) : at] if start - e <= 64 and e > start - 64]
        near += [f"{word} {w}" for s, _, w in words[at + 1 : at + 2] if s < end + 64]
        if not exceptions.intersection(near):
            total += max(weights)
    return total


def test_matcher_and_score_against_plain_python(spark):
    draw = random.Random(21)
    lexicon = {"ab ": 2.0, "ab": 1.5, "abc ": 3.0, "bc": 2.5, "cab ": 4.0, "c ": 2.25, "é ": 2.0}
    exceptions = frozenset({"no ab", "bc no", "cab cab"})
    texts = ["", "no", "ab" * 40, "4b c@b", *("".join(draw.choice(["a", "b", "c", " ", " ", "no ", "4", ".", "é", "\n", "А"]) for _ in range(draw.randrange(1, 60))) for _ in range(800))]
    matcher = toxicity.Matcher(lexicon, exceptions)
    want = [plain_weight(t, lexicon, exceptions) for t in texts]
    assert [matcher.weigh(t)[1] for t in texts] == pytest.approx(want) and sum(w > 0 for w in want) > 400
    model = toxicity.Model(lexicon, exceptions, (0.7, 1.1), -3.0)
    got = {r.doc_id: r.score for r in toxicity.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()}
    for i, (text, weight) in enumerate(zip(texts, want, strict=True)):
        words = text.count(" ") + 1 if text else 0
        curve = -3.0 + 0.7 * math.log1p(weight) + 1.1 * math.log1p(100 * weight / max(words, 1))
        assert got[i] == pytest.approx(1 / (1 + math.exp(-curve)))


def plain_evidence(toxic, clean, share):
    return 2 * sum(n * math.log(n / ((toxic + clean) * p)) for n, p in ((toxic, share), (clean, 1 - share)) if n)


def test_forms_and_exceptions_by_plain_evidence(spark):
    rows, df = synthetic(spark, 1500)
    rows += [(9000 + i, f"quite rareword{i} here", 1) for i in range(9)]  # 3 % of the toxic texts
    rows += [(9100, "really no scum at all", 1)]  # one wrong label among 38 does not undo the exception
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    toxic = sum(y for _, _, y in rows)
    clean = len(rows) - toxic
    counts = {0: Counter(), 1: Counter()}
    for _, text, label in rows:
        counts[label].update({f for w in set(re.findall(r"[^\W\d_]+", toxicity.fold(text))) for f in toxicity.word_forms(w)})
    strong = {}
    for form, n in counts[1].items():
        weight = math.log((n + 0.5) / (toxic + 1)) - math.log((counts[0][form] + 0.5) / (clean + 1))
        if n >= 3 and weight >= 2.0 and plain_evidence(n, counts[0][form], toxic / len(rows)) >= 25.0:
            strong[form] = weight
    model = toxicity.fit(df)
    assert set(model.lexicon) <= set(strong) and "rare" in model.lexicon
    for form, weight in strong.items():
        covered = any(strong.get(form[:k], -9.0) >= weight - 0.5 for k in toxicity.PREFIX_LENGTHS if k < len(form.strip()))
        assert covered == (form not in model.lexicon)
        assert covered or model.lexicon[form] == pytest.approx(weight)
    assert "no scum" in model.exceptions


def test_sample_of_the_labelled_rows(spark):
    _, df = synthetic(spark, 1200)
    assert toxicity.learnable(df, "text", "toxic", 10_000).count() == 1200
    assert 200 < toxicity.learnable(df, "text", "toxic", 400).count() < 600
    assert "vile" in toxicity.fit(df, most_rows=600).lexicon


def test_held_out_accuracy(spark):
    got = QUERIES["op7_toxicity"](spark, MIDDLE)
    assert got.where("score < 0 OR score > 1 OR score IS NULL").count() == 0
    joined = got.join(table(spark, MIDDLE, "labels"), "doc_id").where("held_out").toPandas()
    assert len(joined) > 50 and (joined.predicted == joined.toxic).mean() > 0.95


def test_scores_of_odd_rows_and_without_labels(spark):
    schema = "doc_id long, text string, toxic int"
    model = toxicity.fit(spark.createDataFrame([], schema))
    odd = spark.createDataFrame([(1, None, 1), (1, "", 0), (None, "x " * 50_000, None)], schema)
    got = toxicity.score(odd, model).collect()
    assert len(got) == 3 and all(0 <= r.score <= 1 for r in got)
    assert toxicity.score(odd.where("doc_id > 5"), model).count() == 0
    assert toxicity.fit(spark.createDataFrame([(1, "x", 1)], schema)).score(*map(toxicity.np.array, ([1], [0.0])))[0] > 0.5


def plain_best_fit(lengths, sources, clusters, capacity):
    bins, out = [], []
    for length, source, cluster in zip(lengths, sources, clusters, strict=True):
        fits = [
            (b["left"], i) for i, b in enumerate(bins)
            if b["left"] >= length and (source is None or source not in b["s"]) and (cluster is None or cluster not in b["c"])
        ]
        if fits:
            at = min(fits)[1]
        else:
            at = len(bins)
            bins.append({"left": capacity, "s": set(), "c": set()})
        out.append((at, capacity - bins[at]["left"]))
        bins[at]["left"] -= length
        bins[at]["s"].add(source)
        bins[at]["c"].add(cluster)
    return out


@pytest.mark.parametrize("seed", range(5))
def test_best_fit_matches_a_plain_search(seed):
    draw = random.Random(seed)
    n = 400
    lengths = sorted((draw.randrange(1, 101) for _ in range(n)), reverse=True)
    sources = [draw.choice(["hot", "hot", "a", "b", "c", "d", "e", None]) for _ in range(n)]
    clusters = [draw.choice([1, 2, 3, None, *range(10, 300)]) for _ in range(n)]
    assert packing.best_fit(lengths, sources, clusters, 100) == plain_best_fit(lengths, sources, clusters, 100)


def test_packed_rows_are_whole_and_without_conflict(spark):
    draw = random.Random(2)
    rows = [(i, draw.choice([0, 1, 7, 50, 90, 100, 101, 350]), draw.choice(["x", "y", "z", None]), draw.randrange(100)) for i in range(500)]
    rows += [(0, *rows[0][1:]), (None, 20, "x", 1), (900, None, None, None)]
    items = spark.createDataFrame(rows, "doc_id long, n_tokens long, source string, cluster long")
    got = packing.pack(items, 100, shard_items=64).collect()
    total = {}
    for r in got:
        total[r.doc_id] = total.get(r.doc_id, 0) + r.n_tokens
    want = {}
    for i, n, _, _ in rows:
        want[i] = want.get(i, 0) + (n or 0)
    assert total == want
    bins = {}
    for r in got:
        if r.n_tokens:
            bins.setdefault((r.shard, r.bin), []).append(r)
        else:
            assert r.bin is None
    for held in bins.values():
        held.sort(key=lambda r: r.bin_start)
        assert sum(r.n_tokens for r in held) <= 100
        assert [r.bin_start for r in held] == [sum(x.n_tokens for x in held[:i]) for i in range(len(held))]
        for field in ("source", "cluster"):
            named = [r[field] for r in held if r[field] is not None]
            assert len(named) == len(set(named))
    assert packing.pack(items.where("doc_id > 10000"), 100).count() == 0
    assert sorted(map(str, packing.pack(items, 100, 64).collect())) == sorted(map(str, got))


def test_packed_documents_have_their_exact_token_counts(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents").withColumn("cluster", F.lit("clash"))
    counted = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json")).collect()}
    got = packed(docs).groupBy("doc_id").agg(F.sum("n_tokens").alias("n")).collect()
    assert {r.doc_id: r.n for r in got} == counted


def test_conflicting_labels_count_as_toxic(spark):
    docs = spark.createDataFrame([(i, "vile scum" if i % 2 else "calm words here") for i in range(400)], "doc_id long, text string")
    labels = [(i, i % 2) for i in range(400)] + [(i, 0) for i in range(1, 400, 2)] + [(3, None)]
    model = toxicity.fit_split(docs, spark.createDataFrame(labels, "doc_id long, toxic int").repartition(5))
    assert {r.doc_id for r in toxicity.score(docs, model).where("predicted = 1").collect()} == set(range(1, 400, 2))
