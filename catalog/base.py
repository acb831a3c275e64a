from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textree.storage import spread

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- documents as raw corpus ---

def english_doc() -> Column:
    return F.when(F.col("lang") == "en", 1).otherwise(0)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents"))


def chain_sql(text: str) -> str:
    out = f"lower(trim({text}))"
    for pattern in (r"@[a-zA-Z0-9_]+", r"\b(?:https?|ftp|com)://\S+", r"\n", r"\t", r"\d+"):
        out = f"regexp_replace({out}, '{pattern}', '', 'g')"
    out = rf"regexp_replace({out}, '\s+', ' ', 'g')"
    return rf"regexp_replace({out}, '[^a-zA-Z0-9\s]', '', 'g')"


def last_sql(text: str) -> str:
    return rf"regexp_replace({text}, '[^a-zA-Z0-9\s]', '', 'g')"


# --- lineitem as numeric feature table ---

FEATURES = ["l_discount", "l_quantity", "l_tax"]
def returned() -> Column:
    return F.when(F.col("l_returnflag") == "R", 1).otherwise(0)


RETURNED_SQL = "CAST(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS INTEGER)"
LINE_ID = ["l_orderkey", "l_linenumber"]


def lines(spark: SparkSession, sf_dir: str, features=FEATURES) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(*LINE_ID, *features, returned().alias("y"))


LINES_SQL = f"SELECT l_orderkey, l_linenumber, l_discount, l_quantity, l_tax, {RETURNED_SQL} AS y FROM lineitem"
