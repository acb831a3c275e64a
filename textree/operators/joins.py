"""Equi-joins with a small side whose size is measured before it is sent to every task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textree.storage import store

BROADCAST_BYTES = 64 * 1024 * 1024
PARTS_A_TASK = 8  # so many parts of a heavy key make a task of usual size: more parts fall more evenly


def width_of(value: Column, kind: T.DataType) -> Column:
    """Bytes of one value: strings and binaries at their length, arrays, maps and structs with all they hold."""
    if isinstance(kind, T.StringType | T.BinaryType):
        return F.coalesce(F.octet_length(value), F.lit(0)).cast("long") + 8
    if isinstance(kind, T.StructType):
        parts = [width_of(value.getField(f.name), f.dataType) for f in kind]
        return sum(parts, F.lit(8).cast("long"))
    if isinstance(kind, T.ArrayType):
        if _fixed(kind.elementType):
            return F.coalesce(F.size(value), F.lit(0)).cast("long") * 8 + 8
        held = F.aggregate(value, F.lit(0).cast("long"), lambda n, x: n + width_of(x, kind.elementType))
        return F.coalesce(held, F.lit(0).cast("long")) + 8
    if isinstance(kind, T.MapType):
        return width_of(F.map_keys(value), T.ArrayType(kind.keyType)) + width_of(F.map_values(value), T.ArrayType(kind.valueType))
    if _fixed(kind):
        return F.lit(16 if isinstance(kind, T.DecimalType) else 8).cast("long")
    raise ValueError(f"the size of a {kind.simpleString()} is not known")


def _fixed(kind: T.DataType) -> bool:
    fixed = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.NullType, T.DayTimeIntervalType)
    return isinstance(kind, fixed)


def size_in_bytes(df: DataFrame) -> int:
    """Rows times widths, nested values with all they hold. ``df`` should be stored or cheap."""
    width = sum((width_of(F.col(f"`{f.name}`"), f.dataType) for f in df.schema), F.lit(16).cast("long"))
    return df.agg(F.sum(width)).first()[0] or 0


def join_small(
    big: DataFrame,
    small: DataFrame,
    keys: list[str],
    how: str = "inner",
    salt_on: list[str] | None = None,
    small_bytes: int | None = None,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Broadcast ``small`` up to ``limit`` bytes; beyond it shuffle with every heavy key of ``big`` cut in parts.

    A key is heavy if it has more rows than a task should have on average; it gets as many parts as its measured count
    asks for, and only its rows of ``small`` are repeated. There are fewer heavy keys than tasks, so that table may be
    sent to all of them. The part of a row is a hash of ``salt_on`` (all columns if not given), so a retried task places
    it in the same way.
    """
    if small_bytes is None:
        small_bytes = size_in_bytes(small)
    if small_bytes <= limit:
        return big.join(F.broadcast(small), keys, how)
    heavy = heavy_keys(big, keys)
    parts = F.coalesce("_parts", F.lit(1))
    salt = F.pmod(F.xxhash64(*(salt_on or big.columns)), parts).cast("int")
    cut = big.join(F.broadcast(heavy), keys, "left").withColumn("_salt", salt).drop("_parts")
    copies = small.join(F.broadcast(heavy), keys, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_parts")
    return cut.join(copies, [*keys, "_salt"], how).drop("_salt")


def heavy_keys(big: DataFrame, keys: list[str]) -> DataFrame:
    """Keys with more rows than a shuffle partition holds on average, and ``_parts``, in how many each is to be cut.

    Counts are combined inside the tasks. At most as many keys as partitions can be so heavy.
    """
    tasks = int(big.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = store(big.groupBy(*keys).agg(F.count("*").alias("_n")), "key-counts").df
    usual = max(1.0, (counts.agg(F.sum("_n")).first()[0] or 0) / tasks)
    parts = F.ceil(F.col("_n") / F.lit(usual) * PARTS_A_TASK).cast("int").alias("_parts")
    return counts.filter(F.col("_n") > usual).select(*keys, parts)
