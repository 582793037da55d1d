"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source starts with the same, usually fractional, number of copies.
The pivotal method rounds them: two fractional documents meet, words move from one to the
other until one of the two is integral, which of the two directions is drawn so that each
document's expectation stays. The words of a source's mix stay as they are in each step.
Documents meet in groups of bounded size; each group passes at most one fractional document
on, and groups of groups reduce those, as a tree, down to one document per source.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isobar.llm.common import LAST_ID, materialize, n_words, pick

#: Weights of the sources in order, repeating.
WEIGHTS = (3, 1, 2)
#: Words of the mix by words of the input, and the most copies of a source or document.
BUDGET = 1.5
MOST_COPIES = 2
#: Documents in a group of the reduction tree, at most about twice as many.
GROUP = 4096
#: Documents above this part of their source's words are rounded first.
LARGE = 0.01

_ROUNDED = "doc_id long, text_key long, size long, source string, part long, copies double, settled boolean"


def _ranked(sources: DataFrame) -> DataFrame:
    """``rank`` of each source by code point, null last, without sorting in one task: a
    range partitioning sorts, then one count per partition gives the offsets."""
    order = [F.col("source").isNull(), F.col("source")]
    sorted_ = materialize(
        sources.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("*", F.spark_partition_id().alias("piece"), F.monotonically_increasing_id().alias("row")),
        "sources",
    )
    pieces = sorted_.groupBy("piece").agg(F.min("row").alias("first"), F.count("*").alias("n"))
    before = pieces.select("piece", "first", (F.sum("n").over(Window.orderBy("piece")) - F.col("n")).alias("before"))
    return sorted_.join(F.broadcast(before), "piece").select(
        "source", "source_size", "n_docs", (F.col("before") + F.col("row") - F.col("first")).alias("rank")
    )


def _weight(rank: Column, weights) -> Column:
    return F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))


def source_targets(sizes: DataFrame, weights=WEIGHTS, budget=BUDGET, most_copies=MOST_COPIES) -> DataFrame:
    """Per source: source, source_size, n_docs, target (double).

    ``budget`` times all words are shared by weight; no source gets more than
    ``most_copies`` times its words, and the excess is shared again by weight until none is
    above. Each round is one aggregation over the sources; at least one source reaches its
    limit in each, and the driver keeps two numbers."""
    sources = _ranked(sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs")))
    sources = materialize(sources.withColumn("weight", _weight(F.col("rank"), weights)), "weighted_sources")
    limit = F.col("source_size") * float(most_copies)
    all_words = sources.agg(F.sum("source_size")).first()[0] or 0
    rate, full = None, -1
    while True:
        is_full = F.lit(False) if rate is None else F.col("weight") * rate >= limit
        row = sources.agg(
            F.sum(F.when(is_full, limit).otherwise(0.0)).alias("given"),
            F.sum(F.when(is_full, 0.0).otherwise(F.col("weight"))).alias("weight"),
            F.sum(F.when(is_full, 1).otherwise(0)).alias("full"),
        ).first()
        if not row["weight"] or row["full"] == full:
            break
        rate, full = (budget * all_words - row["given"]) / row["weight"], row["full"]
    target = F.least(limit, F.col("weight") * (0.0 if rate is None else rate))
    return sources.select("source", "source_size", "n_docs", target.alias("target"))


def _uniform(seed: int, *columns) -> Column:
    """A number in [0, 1) that depends on the row's own values only."""
    return (F.xxhash64(F.lit(seed), *columns).bitwiseAND(F.lit(2**53 - 1)) / F.lit(float(2**53))).cast("double")


def pivot(size: np.ndarray, copies: np.ndarray, draw: np.ndarray) -> np.ndarray:
    """Rounds the fractional ``copies`` of documents of ``size`` words, keeping the sum of
    size * copies in each step; at most one document stays fractional."""
    out, held = copies.astype(float).copy(), -1
    for i in range(len(out)):
        part = out[i] - np.floor(out[i])
        if part < 1e-9 or part > 1 - 1e-9 or size[i] == 0:
            out[i] = np.rint(out[i]) if size[i] else np.floor(out[i])
            continue
        if held < 0:
            held = i
            continue
        low_i, low_h = np.floor(out[i]), np.floor(out[held])
        up = min((low_i + 1 - out[i]) * size[i], (out[held] - low_h) * size[held])  # words from held to i
        down = min((out[i] - low_i) * size[i], (low_h + 1 - out[held]) * size[held])
        moved = up if draw[i] * (up + down) < down else -down
        out[i] += moved / size[i]
        out[held] -= moved / size[held]
        for j in (i, held):
            if abs(out[j] - np.rint(out[j])) * max(size[j], 1) < 1e-6:
                out[j] = np.rint(out[j])
        still = [j for j in (held, i) if out[j] != np.rint(out[j])]
        held = still[0] if still else -1
    return out


def _round_group(docs: pd.DataFrame) -> pd.DataFrame:
    """One group of documents by size; what stays fractional goes up the tree."""
    docs = docs.sort_values(["size", "draw", "doc_id", "text_key"], kind="stable")
    copies = pivot(docs["size"].to_numpy(), docs["copies"].to_numpy(), docs["draw"].to_numpy())
    done = docs[["doc_id", "text_key", "size", "source", "part"]].assign(copies=copies)
    return done.assign(settled=copies == np.rint(copies))


def _reduce(docs: DataFrame, seed: int, group: int, name: str) -> DataFrame:
    """Whole numbers of copies for ``docs`` (doc_id, text_key, size, source, part, copies)."""
    settled, level = [], 0
    parts = 1 if docs.isEmpty() else (docs.agg(F.max("part")).first()[0] or 0) + 1
    while True:
        drawn = docs.withColumn("draw", _uniform(seed + level, "doc_id", "text_key", "source"))
        done = materialize(drawn.groupBy("source", "part").applyInPandas(_round_group, _ROUNDED), f"{name}_{level}")
        settled.append(done.where("settled"))
        docs, level = done.where("NOT settled").withColumn("part", F.floor(F.col("part") / group)), level + 1
        if parts == 1:
            break
        parts = -(-parts // group)
    # The one fractional document that a source may have left.
    up = _uniform(seed + level, "doc_id", "text_key", "source") < F.col("copies") - F.floor("copies")
    settled.append(docs.withColumn("copies", F.floor("copies") + up.cast("double")))
    out = settled[0]
    for more in settled[1:]:
        out = out.unionByName(more)
    return out


def _parts(docs: DataFrame, seed: int, group: int) -> DataFrame:
    """Salts each source into groups of about ``group`` documents."""
    n = F.greatest(F.lit(1), F.ceil(F.col("n_docs") / group))
    return docs.withColumn("part", F.pmod(F.xxhash64(F.lit(seed), "doc_id", "text_key"), n))


def mix(
    docs: DataFrame, id_col="doc_id", text_col="text", source_col="source",
    weights=WEIGHTS, budget=BUDGET, most_copies=MOST_COPIES, seed=7, group=GROUP, large=LARGE,
) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken; and source, copies
    and text_key (a hash of the text).

    Size is the number of words, 0 for a null or empty text, which is never taken. Sources
    are ordered by code point and get ``weights`` in turn, a null source comes last and is a
    source like any other. A document is taken floor or ceil of target / source_size times,
    ``most_copies`` times at most, and a source's taken words miss its target by no more
    than one of its documents. The few documents above ``large`` of their source's words
    are rounded first and the rest makes up for them, so the miss is small. Draws depend on
    doc_id, text, source and ``seed`` only: reruns agree, repeated rows included (which
    share their draws). A null doc_id is an id like others. An empty table gives no rows."""
    sizes = pick(docs, doc_id=id_col, text=text_col, source=source_col).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"),
        F.col("source").cast("string").alias("source"),
        n_words(F.coalesce("text", F.lit(""))).alias("size"),
    )
    sizes = materialize(sizes, "sizes")
    targets = materialize(source_targets(sizes, weights, budget, most_copies), "targets")
    known = sizes.withColumnRenamed("source", "of").join(targets, F.col("of").eqNullSafe(F.col("source"))).drop("of")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    known = materialize(known.withColumn("large", (F.col("size") > large * F.col("source_size")) & (F.col("size") > 0)), "known_sizes")
    # At most 1 / large documents of a source are large.
    first = known.where("large").select("doc_id", "text_key", "size", "source", F.lit(0).cast("long").alias("part"), ratio.alias("copies"))
    rounded = materialize(_reduce(first, seed, group, "large_docs"), "large_rounded")
    given = rounded.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("given"), F.sum("size").alias("large_size"))
    left = targets.withColumnRenamed("source", "of").join(given, F.col("of").eqNullSafe(F.col("source")), "left").drop("source")
    small_size = F.col("source_size") - F.coalesce("large_size", F.lit(0))
    rest = F.when(small_size > 0, (F.col("target") - F.coalesce("given", F.lit(0.0))) / small_size).otherwise(0.0)
    rest = left.select("of", F.greatest(F.lit(0.0), F.least(F.lit(float(most_copies)), rest)).alias("copies"))
    small = known.where("NOT large").join(rest, F.col("of").eqNullSafe(F.col("source")))
    small = _parts(small, seed, group).select("doc_id", "text_key", "size", "source", "part", "copies")
    taken = rounded.unionByName(_reduce(small, seed + 100, group, "small_docs"))
    return (
        taken.withColumnRenamed("source", "of")
        .join(targets, F.col("of").eqNullSafe(F.col("source")))
        .select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken"), F.col("of").alias("source"), F.col("copies").cast("long").alias("copies"), "text_key")
    )


__all__ = ["LAST_ID", "mix", "pivot", "source_targets"]
