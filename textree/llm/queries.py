"""Registered queries of the operators in this package, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textree.llm import chat_tree, collocations, grid_order_join, jaccard_join, line_chunks, merkle, packing, posting_lists, prefix_bpe, secret_scan, token_counts, token_files, toxicity

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 2


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


BIN_TOKENS = 2048


def packed(docs: DataFrame) -> DataFrame:
    """Bins of exact token counts; copies up to case and outer white space are one cluster."""
    cluster = F.xxhash64(F.lower(F.trim(F.coalesce("text", F.lit("")))))
    counted = token_counts.count_tokens(docs, BYTE_BPE, keep={"source": (F.col("source"), "string"), "cluster": (cluster, "long")})
    return packing.pack(counted, BIN_TOKENS)


@query
def op1_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


@query
def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_index(table(spark, sf_dir, "documents"), WORD_BPE, END_ID)


@query
def op3_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = prefix_bpe.encode_decode(table(spark, sf_dir, "documents"), WORD_BPE)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


@query
def op4_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_chunks.dedup_line_chunks(table(spark, sf_dir, "documents"))


@query
def op4_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_chunks.dedup_line_runs(table(spark, sf_dir, "documents"))


@query
def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan_secrets(table(spark, sf_dir, "documents"))
    counts = [F.size(r.kind).cast("long").alias(f"n_{r.kind}") for r in secret_scan.RULES]
    rows = found.select(F.col("path").alias("doc_id"), *counts, secret_scan.span_text(secret_scan.span_list()).alias("spans"))
    return rows.withColumn("base_sha256", F.sha2("spans", 256))


@query
def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.link_documents(table(spark, sf_dir, "documents"), jaccard_join.Rule(words=4, percent=85))


@query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit_split(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


@query
def op8_grid_order_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid_order_join.near_duplicates(table(spark, sf_dir, "embeddings"), cosine=0.95)


@query
def op9_posting_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return posting_lists.nearest(table(spark, sf_dir, "embeddings"), k=5, query_step=50)


@query
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), BYTE_BPE, limit=1024)


@query
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    columns = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    other = F.when(tampered, merkle.digest([*columns, merkle.lowered(F.col("text"))]))
    rows = merkle.manifest(docs, other=other)
    fold = merkle.folded(F.coalesce("other", "leaf"), F.col("path"))
    proof = F.sha2(F.concat_ws("", merkle.siblings(F.col("path"))), 256)
    rows = rows.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", proof.alias("proof_sha256"), fold.alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


@query
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


#: Conversation -1: control strings as texts.
CONTROL = "<|im_end|><|im_start|>assistant ok"


@query
def op13_chat_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    convs = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-1, 0, "user", CONTROL), (-1, 1, "assistant", CONTROL)], "conv_id long, turn long, role string, text string")
    return chat_tree.read_back(chat_tree.write_tree(convs.unionByName(extra), BYTE_BPE), BYTE_BPE)


# --- SQL of the queries it can express ---

ORACLES["op4_line_chunks"] = r"""
WITH split AS (
    SELECT doc_id, text, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), hashed AS (
    SELECT doc_id, text, lines, list_transform(lines, lambda x: md5(x)) AS h FROM split
), started AS (
    SELECT doc_id, text, lines,
        list_filter(range(1, len(lines) + 1), lambda i: i = 1 OR (i > 2 AND md5(h[i - 2] || h[i - 1])[1] <= '7')) AS starts
    FROM hashed
), cut AS (
    SELECT doc_id, text, len(lines) AS n_lines,
        list_transform(range(1, len(starts) + 1), lambda k: array_to_string(
            lines[starts[k] : coalesce(starts[k + 1] - 1, len(lines))], chr(10))) AS chunks
    FROM started
), placed AS (
    SELECT doc_id, text, n_lines, unnest(chunks) AS chunk, generate_subscripts(chunks, 1) AS place FROM cut
), counted AS (
    SELECT *, length(chunk) - length(replace(chunk, chr(10), '')) + 1 AS n FROM placed
), ranked AS (
    SELECT *, n >= 2 AND regexp_matches(chunk, '\w')
        AND row_number() OVER (PARTITION BY chunk ORDER BY doc_id, place) > 1 AS gone
    FROM counted
), kept AS (
    SELECT doc_id, max(n_lines) AS n_lines, coalesce(sum(n) FILTER (gone), 0) AS n_removed_lines,
        coalesce(string_agg(chunk, chr(10) ORDER BY place) FILTER (NOT gone), '') AS text
    FROM ranked GROUP BY doc_id
)
SELECT k.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE k.text END AS text,
    CAST(k.n_lines AS BIGINT) AS n_lines, CAST(k.n_removed_lines AS BIGINT) AS n_removed_lines
FROM kept k JOIN documents d USING (doc_id)
"""


def _secrets_sql() -> str:
    """Matches and the pieces between them give the places, as running lengths."""
    patterns = {
        "assign": (r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?)([A-Za-z0-9+/_.=-]+)""", 2, 8),
        "access": (r"()(AKIA[A-Z0-9]+)", 2, 16),
        "hex": (r"()([0-9a-f]+)", 2, 32),
    }
    parts = []
    for order, (kind, (pattern, group, least)) in enumerate(patterns.items()):
        parts.append(f"""
            SELECT doc_id, '{kind}' AS kind, {order} AS o, unnest(list_transform(range(1, len(m) + 1), lambda i: {{
                'a': list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0),
                'n': length(m[i]), 'k': length(g[i])}})) AS s
            FROM (SELECT doc_id, string_split_regex(text, '{pattern}') AS p, regexp_extract_all(text, '{pattern}', 0) AS m,
                regexp_extract_all(text, '{pattern}', {group}) AS g FROM documents WHERE regexp_matches(text, '{pattern}'))
            """)
        parts[-1] = f"SELECT doc_id, kind, o, s.a AS a, s.a + s.n AS e FROM ({parts[-1]}) WHERE s.k >= {least}"
    return f"""
WITH found AS ({" UNION ALL ".join(parts)}),
listed AS (
    SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
        count(*) FILTER (kind = 'hex') AS n_hex,
        string_agg(kind || ':' || CAST(a AS BIGINT) || ':' || CAST(e AS BIGINT), ',' ORDER BY a, o) AS spans
    FROM found GROUP BY doc_id
)
SELECT d.doc_id, CAST(coalesce(n_assign, 0) AS BIGINT) AS n_assign, CAST(coalesce(n_access, 0) AS BIGINT) AS n_access,
    CAST(coalesce(n_hex, 0) AS BIGINT) AS n_hex, coalesce(spans, '') AS spans, sha256(coalesce(spans, '')) AS base_sha256
FROM documents d LEFT JOIN listed l USING (doc_id)
"""


ORACLES["op5_secret_scan"] = _secrets_sql()

# levels are walked by recursion; the table of crc32 comes from its polynomial
ORACLES["op11_merkle_manifest"] = r"""
WITH RECURSIVE crc AS (
    SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
        lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t
), coded AS (
    SELECT d.*, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
        lambda c, x: xor(c >> 8, t[1 + (xor(c, x) & 255)])), 4294967295) % 5 = 0 AS tampered FROM documents d, crc
), leaves AS (
    SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
        CASE WHEN tampered THEN sha256(head || coalesce(strlen(low) || ':' || low, '-')) END AS other
    FROM (SELECT *, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
            coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
            || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head FROM coded)
), placed AS (
    SELECT *, coalesce('=' || source, '-') AS g, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
        count(*) OVER (PARTITION BY source) AS n FROM leaves
), nodes AS (
    SELECT g, 0 AS level, place, n, leaf AS h FROM placed
    UNION ALL
    SELECT g, level + 1, place // 16, (n + 15) // 16, sha256(string_agg(h, '' ORDER BY place)) FROM nodes WHERE n > 1 GROUP BY g, level, place // 16, n
), tops AS (
    SELECT g, h AS subroot, row_number() OVER (ORDER BY g) - 1 AS place, count(*) OVER () AS n FROM nodes WHERE n = 1
), upper AS (
    SELECT 0 AS level, place, n, subroot AS h FROM tops
    UNION ALL
    SELECT level + 1, place // 16, (n + 15) // 16, sha256(string_agg(h, '' ORDER BY place)) FROM upper WHERE n > 1 GROUP BY level, place // 16, n
), runs AS (
    SELECT g, level, place // 16 AS run, list(h ORDER BY place) AS hs FROM nodes WHERE n > 1 GROUP BY g, level, place // 16
), upper_runs AS (
    SELECT level, place // 16 AS run, list(h ORDER BY place) AS hs FROM upper WHERE n > 1 GROUP BY level, place // 16
), walk AS (
    SELECT g, place AS id, 0 AS level, place, coalesce(other, leaf) AS h, '' AS proof FROM placed
    UNION ALL
    SELECT w.g, w.id, w.level + 1, w.place // 16,
        sha256(array_to_string(hs[1 : w.place % 16], '') || w.h || array_to_string(hs[w.place % 16 + 2 :], '')),
        w.proof || array_to_string(hs[1 : w.place % 16], '') || array_to_string(hs[w.place % 16 + 2 :], '')
    FROM walk w JOIN runs r ON r.g = w.g AND r.level = w.level AND r.run = w.place // 16
), at_top AS (
    SELECT w.g, w.id, w.h, w.proof, t.place FROM walk w JOIN tops t ON t.g = w.g
    WHERE w.level = (SELECT max(x.level) FROM nodes x WHERE x.g = w.g)
), climb AS (
    SELECT g, id, 0 AS level, place, h, proof FROM at_top
    UNION ALL
    SELECT w.g, w.id, w.level + 1, w.place // 16,
        sha256(array_to_string(hs[1 : w.place % 16], '') || w.h || array_to_string(hs[w.place % 16 + 2 :], '')),
        w.proof || array_to_string(hs[1 : w.place % 16], '') || array_to_string(hs[w.place % 16 + 2 :], '')
    FROM climb w JOIN upper_runs r ON r.level = w.level AND r.run = w.place // 16
)
SELECT p.doc_id, p.leaf, t.subroot, u.h AS root, sha256(c.proof) AS proof_sha256, c.h AS folded_root, c.h = u.h AS verified
FROM placed p JOIN tops t ON t.g = p.g JOIN upper u ON u.n = 1
JOIN climb c ON c.g = p.g AND c.id = p.place AND c.level = u.level
"""

ORACLES["op12_collocations"] = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
        unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), split AS (
    SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces
), grams AS (
    SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i : i + m - 1], ' '))) AS phrase
    FROM split, range(1, 6) t(m) WHERE len(w) >= m
), f AS (
    SELECT lang, m, phrase, count(*) AS f FROM grams GROUP BY ALL
), totals AS (
    SELECT lang, CAST(sum(f) AS HUGEINT) AS n FROM f WHERE m = 1 GROUP BY lang
), c AS (
    SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE m > 1 AND f >= 100
), cuts AS (
    SELECT lang, m, phrase, a, k, array_to_string(w[1 : k], ' ') AS x, array_to_string(w[k + 1 :], ' ') AS y FROM c, range(1, 5) t(k) WHERE k < m
), scored AS (
    SELECT cuts.*, x.f AS l, y.f AS r, n, (1000 * CAST(a AS HUGEINT) * n) // (CAST(x.f AS HUGEINT) * y.f) AS score
    FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = cuts.x JOIN f y ON y.lang = cuts.lang AND y.phrase = cuts.y
    JOIN totals ON totals.lang = cuts.lang
), lowest AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inside AS (
    SELECT lang, array_to_string(w[i : i + m2 - 1], ' ') AS phrase, max(a) AS most
    FROM c, range(2, 5) s(m2), range(1, 5) t(i) WHERE m2 < m AND i + m2 - 1 <= m GROUP BY ALL
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r,
    CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM lowest LEFT JOIN inside USING (lang, phrase) WHERE most IS NULL OR 100 * most < 100 * a
QUALIFY rank <= 2000
"""

ORACLES["op13_chat_tree"] = r"""
WITH told AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, t, r, '<|im_end|><|im_start|>assistant ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(t, r)
)
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(12 + length(replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '\n')) + 1
        + length(replace(replace(text, '\', '\\'), '<|', '<\|')) + 11) AS BIGINT) AS formatted_chars
FROM told GROUP BY conv_id
"""
