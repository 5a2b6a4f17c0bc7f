"""Vectors as rows: checks, exact classes and plain float64 bytes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def matrices(col: pa.Array) -> list[np.ndarray | None]:
    """One float64 array per row; None if the vector is null, empty, zero, or holds null or
    non-finite components."""
    out: list[np.ndarray | None] = []
    col = col.cast(pa.large_list(pa.float64()))
    at, values = col.offsets.to_numpy(), col.values
    gaps = values.is_null().to_numpy(zero_copy_only=False)
    flat = values.fill_null(0.0).to_numpy(zero_copy_only=False) if len(values) else np.empty(0)
    ok = np.isfinite(flat) & ~gaps
    valid = col.is_valid().to_numpy(zero_copy_only=False)
    for i in range(len(col)):
        s, e = at[i], at[i + 1]
        x = flat[s:e]
        out.append(x + 0.0 if valid[i] and e > s and ok[s:e].all() and x.any() else None)
    return out


def classes(table: DataFrame) -> DataFrame:
    """vec_id, dim, key (a 128-bit digest of the components), x (float64 bytes) of each row;
    dim, key and x are null where the vector takes no part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = matrices(batch.column("embedding"))
            raw = [None if x is None else x.tobytes() for x in rows]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"),
                    pa.array([None if x is None else len(x) for x in rows], pa.int32()),
                    pa.array([None if r is None else hashlib.blake2b(r, digest_size=16).digest() for r in raw], pa.binary()),
                    pa.array(raw, pa.binary()),
                ],
                names=["vec_id", "dim", "key", "x"],
            )

    return table.select(F.col("vec_id").cast("bigint"), F.col("embedding").cast("array<double>")).mapInArrow(run, "vec_id bigint, dim int, key binary, x binary")


def stack(blobs: pa.Array | list[bytes], dim: int) -> np.ndarray:
    items = blobs.to_pylist() if isinstance(blobs, pa.Array) else blobs
    return np.frombuffer(b"".join(items), np.float64).reshape(len(items), dim)


def sample(vectors: DataFrame, dim: int, most: int) -> np.ndarray:
    """At most ``most`` vectors of one dimension, picked by a hash of their ids."""
    rows = vectors.filter(F.col("dim") == dim).select("x", F.xxhash64("id").alias("h"), "id").orderBy("h", "id").limit(most)
    return stack([bytes(r["x"]) for r in rows.collect()], dim)
