"""Exact dedup with a heavy-hitter split.

Misra-Gries finds the digests that may hold many rows. Their winners are verified by a
partial aggregation, at most one row per digest and task moves, and broadcast: rows of
heavy digests never shuffle. All other digests are aggregated before a shuffle and joined with
their winners by one that Spark may split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isobar.llm.common import documents, materialize, one_space
from isobar.llm.heavy import heavy_keys


def winners_of(rows: DataFrame, counters: int = 1024) -> DataFrame:
    """``rows`` (doc_id, rid unique, digest) plus ``keep_id``, ``keep_rid`` and
    ``group_size`` of the row's digest.

    The row that stays has the smallest ``doc_id`` (null last), then the smallest ``rid``."""
    order = F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "rid")
    keyed = rows.withColumn("key", F.xxhash64("digest"))
    heavy = materialize(heavy_keys(keyed, "key", counters), "heavy_digests")  # at most `counters` rows
    best = (
        keyed.join(F.broadcast(heavy), "key", "left_semi")
        .groupBy("digest")
        .agg(F.min(order).alias("best"), F.count("*").alias("group_size"))
    )
    of_heavy = keyed.join(F.broadcast(heavy), "key", "left_semi").join(F.broadcast(best), "digest")
    rest = keyed.join(F.broadcast(heavy), "key", "left_anti")
    of_rest = rest.join(rest.groupBy("digest").agg(F.min(order).alias("best"), F.count("*").alias("group_size")), "digest")
    return of_heavy.unionByName(of_rest).select(
        *rows.columns, F.col("best.doc_id").alias("keep_id"), F.col("best.rid").alias("keep_rid"), "group_size"
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = 1024) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal if they are the same after each run of white space became one space;
    a null text counts as empty, and all empty texts are one group. Of equal texts the row
    with the smallest doc_id stays, a null doc_id comes last, and of repeated rows with the
    same doc_id one stays. Texts are read whole, whatever their length. An empty table
    gives an empty result; other columns of the input are ignored."""
    rows = materialize(
        documents(docs, id_col, text_col).select(
            "doc_id", F.monotonically_increasing_id().alias("rid"), F.unhex(F.sha2(one_space("text"), 256)).alias("digest")
        ),
        "digests",
    )
    return winners_of(rows, counters).select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("rid") == F.col("keep_rid")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
