"""Secret scans over an incremental ledger of blobs; DataFrame operations only.

Every version of a text is addressed by its content. The ledger is a Parquet table with one row per blob, rule
and version of the rule: what was found there. An update scans only pairs that the ledger does not hold, and
findings are joined back to all rows that have the blob.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textree.operators.joins import BROADCAST_BYTES, size_in_bytes
from textree.storage import new_path, store

LEDGER = "blob string, rule string, version string, spans array<struct<start: int, end: int>>"
SPANS = "array<struct<start: int, end: int>>"


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` whose ``group`` has at least ``least`` characters; others are passed over."""

    kind: str
    pattern: str
    group: int
    least: int

    @property
    def version(self) -> str:
        return hashlib.sha256(f"{self.pattern}\n{self.group}\n{self.least}".encode()).hexdigest()[:16]


RULES = (
    Rule("assign", r"""((?i)password|passwd|secret|token|api_?key)(?-i)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]+", 0, 32),
)


def rule_spans(text: Column, rule: Rule) -> Column:
    """Start and end (code points, end exclusive) of the leftmost non-overlapping matches that pass.

    The pieces between the matches and the matches themselves give the places as running lengths.
    """
    pieces = F.split(text, rule.pattern, -1)
    whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    sizes = F.transform(F.arrays_zip(pieces.alias("p"), whole.alias("m")), lambda x: F.struct(
        F.char_length(x["p"]).alias("p"), F.coalesce(F.char_length(x["m"]), F.lit(0)).alias("m")))
    ends = F.aggregate(
        sizes,
        F.array(F.lit(0)),
        lambda done, x: F.concat(done, F.array(F.element_at(done, -1) + x["p"] + x["m"])),
    )
    kept = whole if rule.group == 0 else F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    found = F.transform(F.arrays_zip(whole.alias("m"), kept.alias("k"), F.slice(ends, 2, F.size(whole)).alias("end")), lambda x: F.struct(
        (x["end"] - F.char_length(x["m"])).alias("start"), x["end"].alias("end"), F.char_length(x["k"]).alias("kept")))
    passed = F.filter(found, lambda x: x["kept"] >= rule.least)
    return F.transform(passed, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))).cast(SPANS)


def quick_pattern(rule: Rule) -> str:
    """A pattern that every text with a passing match has; texts without it are not taken apart."""
    if rule.group == 0 and rule.pattern.endswith("+"):
        fixed = len(rule.pattern.split("[")[0])
        return f"{rule.pattern[:-1]}{{{rule.least - fixed}}}"
    return rule.pattern


def join_measured(big: DataFrame, small: DataFrame, on, how: str = "inner") -> DataFrame:
    """Broadcast ``small`` up to a measured size; beyond it a shuffle join, whose hot keys the adaptive planner splits."""
    return big.join(F.broadcast(small) if size_in_bytes(small) <= BROADCAST_BYTES else small, on, how)


class Ledger:
    """A ledger in ``path``, a folder Spark can write (a new one in the shared folder if not given)."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark = spark
        self.path = path or new_path(spark, "secret-ledger")

    def table(self) -> DataFrame | None:
        """All rows so far; None before the first update."""
        try:
            return self.spark.read.schema(LEDGER).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def update(self, docs: DataFrame, rules=RULES, id_col: str = "doc_id", text_col: str = "text") -> None:
        """Scan the blobs of ``docs`` with the rules they have not been scanned with, and append."""
        rows = keyed(docs, id_col, text_col)
        first = rows.groupBy("blob").agg(F.min("path").alias("path"))
        asked = F.array(*[F.struct(F.lit(r.kind).alias("rule"), F.lit(r.version).alias("version")) for r in rules])
        pairs = first.select("blob", "path", F.inline(asked))
        known = self.table()
        if known is not None:
            pairs = pairs.join(known, ["blob", "rule", "version"], "left_anti")
        unseen = pairs.groupBy("blob", "path").agg(F.collect_set("rule").alias("todo"))
        unseen = store(unseen.select(F.col("blob").alias("_blob"), F.col("path").alias("_path"), "todo"), "secret-unseen").df
        here = (F.col("blob") == F.col("_blob")) & F.col("path").eqNullSafe(F.col("_path"))
        texts = join_measured(rows, unseen, here)
        empty = F.array().cast(SPANS)
        scanned = texts.select(
            "blob",
            F.inline(F.array(*[
                F.struct(
                    F.when(F.array_contains("todo", r.kind), r.kind).alias("rule"),
                    F.lit(r.version).alias("version"),
                    F.when(F.array_contains("todo", r.kind) & F.col("text").rlike(quick_pattern(r)), rule_spans(F.col("text"), r)).otherwise(empty).alias("spans"),
                )
                for r in rules
            ])),
        )
        scanned.where("rule IS NOT NULL").dropDuplicates(["blob", "rule"]).write.mode("append").parquet(self.path)

    def by_blob(self, rules=RULES) -> DataFrame:
        """blob and an array of spans (or null) per rule, of blobs where something was found."""
        known = self.table()
        if known is None:
            raise ValueError("the ledger has not been filled")
        current = F.concat_ws(":", "rule", "version").isin([f"{r.kind}:{r.version}" for r in rules])
        found = known.where(current & (F.size("spans") > 0))
        return found.groupBy("blob").agg(*[F.max(F.when(F.col("rule") == r.kind, F.col("spans"))).alias(r.kind) for r in rules])

    def findings(self, docs: DataFrame, rules=RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """path (the id), blob and an array of spans per rule for every row of ``docs``, found or not."""
        rows = join_measured(keyed(docs, id_col, text_col).select("path", "blob"), self.by_blob(rules), "blob", "left")
        empty = F.array().cast(SPANS)
        return rows.select("path", "blob", *[F.coalesce(r.kind, empty).alias(r.kind) for r in rules])

    def redact(self, docs: DataFrame, rules=RULES, text_col: str = "text") -> DataFrame:
        """``docs`` with what the ledger holds of their texts replaced; other columns and rows stay as they are."""
        names = docs.columns
        found = self.by_blob(rules).select(F.col("blob").alias("_blob"), F.struct(*[r.kind for r in rules]).alias("_found"))
        # the columns of docs travel inside a struct, so no name of theirs can meet one used here
        row, own = F.struct(*[F.col(f"`{x}`") for x in names]).alias("row"), F.sha2(F.coalesce(text_col, F.lit("")), 256).alias("_own")
        joined = join_measured(docs.select(row, own), found, F.col("_own") == F.col("_blob"), "left")
        empty = F.array().cast(SPANS)
        spans = span_list(rules, lambda kind: F.coalesce(F.col("_found")[kind], empty))
        before = F.col("row")[text_col]
        text = F.when(F.col("_found").isNull(), before).otherwise(redacted(before, spans))
        return joined.select(*[text.alias(x) if x == text_col else F.col("row")[x].alias(x) for x in names])


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("path"), text.alias("text"), F.sha2(text, 256).alias("blob"))


def span_list(rules=RULES, spans: Callable[[str], Column] = F.col) -> Column:
    """All spans as structs (start, order, end, kind), by start and then in the order of the rules."""

    def named(order: int, kind: str) -> Column:
        return F.transform(spans(kind), lambda x: F.struct(x["start"].alias("start"), F.lit(order).alias("order"), x["end"].alias("end"), F.lit(kind).alias("kind")))

    parts = [named(order, rule.kind) for order, rule in enumerate(rules)]
    return F.array_sort(F.concat(*parts))


def span_text(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))))


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """``text`` with every stretch that spans cover replaced; overlapping spans give one mark each."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    done = F.aggregate(
        spans,
        start,
        lambda acc, x: F.struct(
            F.greatest(acc["at"], x["end"]).alias("at"),
            F.when(x["start"] >= acc["at"], F.concat(acc["out"], F.substring(text, acc["at"] + 1, x["start"] - acc["at"]), F.lit(mark)))
            .otherwise(acc["out"]).alias("out"),
        ),
        lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.char_length(text))),
    )
    return F.when(F.size(spans) == 0, text).otherwise(done)


def scan_secrets(docs: DataFrame, ledger: Ledger | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """path, blob, assign, access, hex for every row of ``docs``, through ``ledger`` (a new one if not given).

    Null texts count as empty and have no findings. Repeated rows and copies are scanned once and each get the
    findings; rows with a null id too. An empty table gives an empty table; other columns are not read; texts
    are scanned whole. The ledger stays in its folder.
    """
    ledger = ledger or Ledger(docs.sparkSession)
    ledger.update(docs, id_col=id_col, text_col=text_col)
    return ledger.findings(docs, id_col=id_col, text_col=text_col)
