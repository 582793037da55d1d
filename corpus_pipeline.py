"""Corpus pipeline: quality classifier, line dedup, near dedup, benchmark decontamination
and mixing, each stage a function of Spark session, documents and the folder of tables.

Each stage's result is written as Parquet and read again as the next one's documents. All
but the last return the columns of their input, whatever else it has. Nulls, empty and
repeated rows are treated as the operators' docstrings say.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from isobar.llm import decontaminate, line_dedup, mixing, near_dedup, quality
from isobar.llm.common import materialize, placed, restored, table

#: Near duplicates of the pipeline: percent of Jaccard similarity.
NEAR_PERCENT = 80

_KEY = ["rank", "text_key"]


def _in_order(docs: DataFrame) -> Column:
    """Orders rows that ``placed`` gives one key, by all their other columns, so that the
    choice among repeated rows doesn't depend on the order of the input."""
    return F.to_json(F.struct(*[f"c{i}" for i, name in enumerate(docs.columns) if name != "text"]))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject. Null and empty texts are judged like any
    other, repeated rows alike; an empty table stays empty."""
    return restored(quality.classify(docs, quality.fit(docs)).where("kept"), docs.columns)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that match an earlier line in any letter case; a document that loses
    all of them stays with an empty text. n_chars follows the text."""
    kept = line_dedup.dedup_lines(docs).select(*_KEY, "kept_text").dropDuplicates(_KEY)
    out, names = placed(docs).join(kept, _KEY), docs.columns
    text = f"c{names.index('text')}"
    out = out.withColumn(text, F.when(F.col(text).isNotNull(), F.col("kept_text")))
    if "n_chars" in names:
        n_chars = names.index("n_chars")
        out = out.withColumn(f"c{n_chars}", F.length(text).cast(docs.schema[n_chars].dataType))
    return restored(out, names)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, and all documents without words. Of
    repeated rows of the document that stays, the first by all its columns stays."""
    groups = materialize(near_dedup.near_groups(docs, percent=NEAR_PERCENT), "near_groups")
    rows = placed(docs)
    one = rows.join(groups.where("kept AND n_shingles > 0").select(*_KEY), _KEY)
    one = one.withColumn("nth", F.row_number().over(Window.partitionBy(*_KEY).orderBy(_in_order(docs)))).where("nth = 1").drop("nth")
    empty = rows.join(groups.where("n_shingles = 0").select(*_KEY).distinct(), _KEY, "left_semi")
    return restored(one.unionByName(empty), docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found; those with null or empty texts, and all
    if the benchmark is empty, stay."""
    found = materialize(decontaminate.find_leaks(docs, table(spark, sf_dir, "benchmark")).select(*_KEY).distinct(), "leaking")
    return restored(placed(docs).join(found, _KEY, "left_anti"), docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents that are taken, with their size, source_size, target, taken words
    and number of copies (with ``mix_`` before names that the documents already have)."""
    key = [*_KEY, "src"]
    mixed = mixing.mix(docs).withColumns({"rank": F.coalesce("doc_id", F.lit(mixing.LAST_ID)), "src": F.coalesce("source", F.lit(""))})
    mixed = mixed.withColumn("src", F.concat(F.col("source").isNull().cast("string"), "src"))
    # Of repeated rows, which share all but their copies: how many rows get how many copies.
    mixed = mixed.groupBy(*key, "size", "source_size", "target", "copies").agg(F.max("taken").alias("taken"), F.count("*").alias("n"))
    up_to = F.sum("n").over(Window.partitionBy(*key).orderBy(F.desc("copies")))
    mixed = mixed.withColumn("up_to", up_to).where("copies > 0")
    rows, source = placed(docs), F.col(f"c{docs.columns.index('source')}").cast("string")
    rows = rows.withColumn("src", F.concat(source.isNull().cast("string"), F.coalesce(source, F.lit(""))))
    # Numbered before the join, which has the window's keys: one shuffle of the documents.
    rows = rows.withColumn("nth", F.row_number().over(Window.partitionBy(*key).orderBy(_in_order(docs))))
    taken = rows.join(mixed, key).where("nth > up_to - n AND nth <= up_to")
    more = ["size", "source_size", "target", "taken", "copies"]
    free = [name if name not in docs.columns else f"mix_{name}" for name in more]
    return taken.select(*[f"c{i}" for i in range(len(docs.columns))], *more).toDF(*docs.columns, *free)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality", quality_stage),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
]

#: The classifier is trained and the mix is drawn: no SQL can express the result.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage_{name}")
    return docs
