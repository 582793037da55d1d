"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isobar.session import discard, materialize

#: Runs of white space and of everything else, as the operators' contracts define words.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

#: Orders a null id after every other id.
LAST_ID = 2**63 - 1


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """``pick(df, doc_id="id")``: the column named exactly ``id``, as ``doc_id``, and no
    other. Other columns may have any names, also the operator's own or repeated ones."""
    names = df.columns
    places = [f"_{i}" for i in range(len(names))]
    return df.toDF(*places).select(*[F.col(places[names.index(old)]).alias(new) for new, old in columns.items()])


def documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` (long, may be null) and ``text`` (null as empty) of a document table."""
    return pick(df, doc_id=id_col, text=text_col).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text")
    )


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``documents`` plus ``rank``, the id with null as the largest, and ``text_key``, a
    hash of the text. Rows with the same two count as repeated rows."""
    return documents(docs, id_col, text_col).withColumns({"rank": F.coalesce("doc_id", F.lit(LAST_ID)), "text_key": F.xxhash64("text")})


def placed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` by place (c0, c1, ...), so that any names may occur, and
    ``rank`` and ``text_key`` as ``keyed`` has them."""
    names = docs.columns
    doc_id, text = F.col(f"c{names.index(id_col)}").cast("long"), F.coalesce(F.col(f"c{names.index(text_col)}"), F.lit(""))
    named = docs.toDF(*[f"c{i}" for i in range(len(names))])
    return named.withColumns({"rank": F.coalesce(doc_id, F.lit(LAST_ID)), "text_key": F.xxhash64(text)})


def restored(df: DataFrame, names: list[str]) -> DataFrame:
    """The columns c0, c1, ... of ``df`` under their names again."""
    return df.select(*[f"c{i}" for i in range(len(names))]).toDF(*names)


def one_kind_of_space(df: DataFrame, text: Column) -> DataFrame:
    """``df`` with ``_flat``, the text with each white space character as a space. Most
    texts have spaces and line breaks only, which needs no regular expression."""
    odd = reduce(or_, [F.contains("_flat", F.lit(space)) for space in "\t\v\f\r"])
    df = df.withColumn("_flat", F.replace(text, F.lit("\n"), F.lit(" ")))
    return df.withColumn("_flat", F.when(odd, F.regexp_replace("_flat", r"[\x09-\x0D]", " ")).otherwise(F.col("_flat")))


def split_words() -> Column:
    """The words of ``_flat``."""
    return F.array_remove(F.split("_flat", " "), "")


def n_words(text: str | Column) -> Column:
    """Number of words, without building them: each word with the white space around it
    becomes one character."""
    text = F.col(text) if isinstance(text, str) else text
    marked = F.regexp_replace(text, rf"[\x20\x09-\x0D]*{WORD}[\x20\x09-\x0D]*", "x")
    return F.when(F.regexp_like(text, F.lit(WORD)), F.length(marked).cast("long")).otherwise(F.lit(0).cast("long"))


def one_space(text: str | Column) -> Column:
    """The text with each run of white space as one space."""
    return F.regexp_replace(text, SPACES, " ")


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


__all__ = [
    "LAST_ID", "SPACES", "WORD", "discard", "documents", "keyed", "materialize", "n_words", "one_kind_of_space", "one_space", "pick", "placed", "restored", "split_words", "table",
]
