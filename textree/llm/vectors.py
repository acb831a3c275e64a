"""Vectors as bytes: what takes part, and classes of equal vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType


def value_kind(df: DataFrame, column: str) -> str:
    """numpy type of the stored values."""
    kind = df.schema[column].dataType
    if not isinstance(kind, ArrayType):
        raise ValueError(f"{column} is not an array")
    return "<f4" if isinstance(kind.elementType, FloatType) else "<f8"


def sound_vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, digest, size, values) of rows that take part; ``values`` are the bytes of the vector.

    Null, empty and zero vectors, and those with a null or non-finite component, are left out, as are null ids.
    """
    kind = value_kind(df, vector_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, digests, sizes, values = [], [], [], []
            for number, vector in zip(batch.column("id").to_pylist(), batch.column("vector"), strict=True):
                inner = vector.values
                if inner is None or not len(inner) or inner.null_count:
                    continue
                x = np.asarray(inner.to_numpy(zero_copy_only=False), kind)
                if np.isfinite(x).all() and x.any():
                    raw = x.tobytes()
                    ids.append(number)
                    digests.append(xxhash.xxh3_128_digest(raw))
                    sizes.append(len(x))
                    values.append(raw)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(digests, pa.binary()), pa.array(sizes, pa.int32()), pa.array(values, pa.binary())],
                ["id", "digest", "size", "values"],
            )

    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector")).where("id IS NOT NULL")
    return rows.mapInArrow(run, "id long, digest binary, size int, values binary")


def matrix(values: list[bytes] | pa.Array, kind: str) -> np.ndarray:
    """Rows of equal length in double precision."""
    raw = values.to_pylist() if isinstance(values, pa.Array | pa.ChunkedArray) else values
    if not raw:
        return np.zeros((0, 0))
    return np.frombuffer(b"".join(raw), kind).reshape(len(raw), -1).astype(np.float64)


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows at length 1; scaled by the largest component first, so that squares neither overflow nor vanish."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)
