"""Misra-Gries heavy hitters of a 64-bit key, found in one pass without a shuffle of rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isobar.llm.common import materialize


def _merge(keys: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Adds up equal keys; beyond ``k`` keys the (k + 1)-th largest count is taken from all."""
    keys, at = np.unique(keys, return_inverse=True)
    counts = np.bincount(at, weights=counts, minlength=len(keys)).astype(np.int64)
    if len(keys) > k:
        counts = counts - np.partition(counts, len(counts) - k - 1)[len(counts) - k - 1]
        keys, counts = keys[counts > 0], counts[counts > 0]
    return keys, counts


def _summarise(k: int):
    def run(batches):
        keys, counts, n = np.empty(0, np.int64), np.empty(0, np.int64), 0
        for batch in batches:
            new = batch.column(0).drop_null().to_numpy(zero_copy_only=False)
            n += len(new)
            keys, counts = _merge(np.concatenate([keys, new]), np.concatenate([counts, np.ones(len(new), np.int64)]), k)
        yield pa.RecordBatch.from_arrays(
            [pa.array([None, *keys.tolist()], pa.int64()), pa.array([n, *counts.tolist()], pa.int64())], ["key", "n"]
        )

    return run


def heavy_keys(df: DataFrame, key: str, k: int = 1024) -> DataFrame:
    """Keys (long) that may hold ``2 / k`` of the rows or more; at most ``k`` of them.

    Each task keeps ``k`` counters and so undercounts a key by at most its own rows / k.
    Summed over the tasks, a key with 2 n / k of all n rows keeps a count of n / k or more,
    and no more than ``k`` keys can: the result has a proven size bound and can be
    broadcast. Nulls are no key. An empty table has no heavy keys."""
    parts = materialize(df.select(F.col(key).cast("long")).mapInArrow(_summarise(k), "key long, n long"), "misra_gries")
    sums = parts.groupBy("key").agg(F.sum("n").alias("n"))
    total = parts.where("key IS NULL").agg(F.sum("n")).first()[0] or 0
    return sums.where(F.col("key").isNotNull() & (F.col("n") * k >= total)).select("key")


def join_by_key(rows: DataFrame, values: DataFrame, key: str, k: int = 1024) -> DataFrame:
    """``rows`` joined with ``values``, which has one row per value of ``key`` (long, without
    nulls). The values of heavy keys, ``k`` at most, are broadcast, so that their rows don't
    move; all others meet by a shuffle. ``rows`` is read several times: pass a written table."""
    heavy = F.broadcast(materialize(heavy_keys(rows, key, k).withColumnRenamed("key", key), "heavy_keys"))
    hot = rows.join(heavy, key, "left_semi").join(F.broadcast(values.join(heavy, key, "left_semi")), key)
    rest = rows.join(heavy, key, "left_anti").join(values.join(heavy, key, "left_anti"), key)
    return hot.unionByName(rest)
