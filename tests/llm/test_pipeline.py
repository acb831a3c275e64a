"""The pipeline stage by stage on a small folder of hand-made tables."""

import random
import re
from collections import defaultdict

import pytest
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from textree.llm.queries import BIN_TOKENS, BYTE_BPE, QUERIES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    draw = random.Random(6)
    word = lambda: "".join(draw.choice("abcdefghij") for _ in range(6))
    line = lambda: " ".join(word() for _ in range(12))
    rows, labels = [], []
    for i in range(300):
        text = "\n".join(line() for _ in range(draw.randrange(2, 8)))
        if i % 6 == 0:
            text += "\nyou scum and moron"
        labels.append((i, 1, int(i % 6 == 0)))
        rows.append([i, text])
    block = "\n".join(line() for _ in range(12))
    for i in (11, 13, 17):
        rows[i][1] += "\n" + block
    rows.append([400, rows[1][1].replace("\n", " ")])
    rows[1][1] = rows[400 - 100][1] + " " + word()
    rows.append([401, "plain words then password = abcdefgh12 with more of them here"])
    rows.append([402, rows[19][1]])
    rows += [[403, None], [404, ""], [405, "\n\n"]]
    path = str(tmp_path_factory.mktemp("tables"))
    docs = [(i, x, "en", f"src{i % 7}", len(x or "")) for i, x in rows]
    spark.createDataFrame(docs, SCHEMA).repartition(4).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    held = {"start": {r.doc_id: r for r in docs.collect()}}
    for name, stage in pipeline.STAGES:
        out = stage(spark, docs, folder)
        if name != pipeline.STAGES[-1][0]:
            assert out.columns == list(pipeline.COLUMNS) and out.dtypes == docs.dtypes
            out.write.parquet(f"{folder}/out/{name}")
            docs = spark.read.parquet(f"{folder}/out/{name}")
        held[name] = {r.doc_id: r for r in (docs if name != pipeline.STAGES[-1][0] else out).collect()}
    toxic = set(range(0, 300, 6))
    assert set(held["start"]) - set(held["toxicity"]) == toxic
    lines = held["line_dedup"]
    assert sum(len(held["start"][i].text) - len(lines[i].text) for i in (13, 17)) > 500
    assert lines[11].text == held["start"][11].text
    assert all(lines[i].text == held["toxicity"][i].text for i in lines if i not in (13, 17, 402))
    assert {403, 404, 405} <= set(lines)
    near = held["ngram_jaccard_join"]
    assert 400 not in near and 1 in near
    assert set(lines) - set(near) <= {400, 402}
    secrets = held["secret_scans"]
    assert secrets[401].text == "plain words then [SECRET] with more of them here" and secrets[401].n_chars == len(secrets[401].text)
    assert all(secrets[i].text == near[i].text for i in near if i != 401) and set(secrets) == set(near)
    assert set(held["best_fit_packing"]) == set(secrets)


def test_one_row_of_each_group_stays(spark):
    draw = random.Random(3)
    a, b, z = (" ".join(f"{x}{draw.randrange(10**6)}" for _ in range(80)) for x in "abz")
    rows = [(1, a), (2, a), (2, b), (None, a), (5, b + " more"), (7, a), (7, a), (9, z), (9, z), (None, None), (3, " "), (3, " "), (None, "lost row"), (None, "lost row")]
    docs = spark.createDataFrame([(i, x, "en", f"s{k % 3}", 1) for k, (i, x) in enumerate(rows)], SCHEMA)
    got = [(r.doc_id, r.text) for r in pipeline.drop_near_copies(spark, docs.withColumn("_number", docs.doc_id), "").collect()]
    assert sorted(got, key=str) == sorted([(1, a), (2, b), (9, z), (None, None), (3, " "), (3, " "), (None, "lost row")], key=str)
    assert pipeline.drop_near_copies(spark, docs.limit(0), "").count() == 0


def plain_run(docs, labels):
    """The five stages in plain Python on {doc_id: (text, source)}; the toxic rows and the line stage's text are given."""
    kept = {i: x for i, x in docs.items() if i not in labels}
    sets = {}
    for i, (text, _) in kept.items():
        words = text.lower().split()
        sets[i] = {tuple(words[k : k + 5]) for k in range(len(words) - 4)} or ({tuple(words)} if words else set())
    gone = {i for i in kept for j in kept if j < i and sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])}
    out = {}
    for i, (text, source) in kept.items():
        if i not in gone:
            out[i] = (re.sub(r"(?i)(password|passwd|secret|token|api_?key)[\"']? *[:=] *[\"']?[A-Za-z0-9+/_.=-]{8,}", "[SECRET]", text), source)
    return out


def test_run_equals_the_plain_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    cut = {r.doc_id: (r.text or "", r.source) for r in pipeline.dedup_lines(spark, docs, folder).collect()}
    want = plain_run(cut, set(range(0, 300, 6)))
    tokenizer = Tokenizer.from_file(BYTE_BPE)
    sizes = {i: len(tokenizer.encode(text, add_special_tokens=False).ids) for i, (text, _) in want.items()}
    packed = pipeline.run(spark, folder).collect()
    found, bins = defaultdict(int), defaultdict(list)
    for r in packed:
        found[r.doc_id] += r.n_tokens
        bins[r.shard, r.bin].append(r)
    assert dict(found) == sizes
    for rows in bins.values():
        assert sum(r.n_tokens for r in rows) <= BIN_TOKENS
        named = [r.source for r in rows if r.source is not None]
        assert len(set(named)) == len(named) or len(rows) == 1


def test_pipeline_is_registered_with_its_stages():
    assert pipeline.ORACLE_SQL is None
    assert [name for name, _ in pipeline.STAGES] == ["toxicity", "line_dedup", "ngram_jaccard_join", "secret_scans", "best_fit_packing"]
    assert {"op1_best_fit", "op10_token_counts"} <= set(QUERIES)
