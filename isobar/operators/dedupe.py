"""Top-1 per group.

``latest_per_key`` keeps the exact ``row_number() == 1`` form so Catalyst inserts a
*partial* ``WindowGroupLimit`` before the shuffle: every map task forwards at most one
row per key, so a key that holds many re-delivered copies never lands whole on one
reducer.

``first_in_order`` builds the struct for a ``min`` aggregate that picks one row per
group under an explicit NULL order. It rides inside an ordinary ``groupBy`` (partial
aggregation before the shuffle), which is how T3-T5 fold into the summary's single
aggregation instead of three sorts and three joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Keep the first row of each ``keys`` group under ``order``.

    ``order`` must be total for a deterministic result (e.g. ``ingested_at desc,
    forecast_id desc, index desc``).
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def order_keys(c: Column, descending: bool, nulls_first: bool) -> list[Column]:
    """Ascending-comparable keys reproducing ``c [desc|asc] nulls [first|last]``.

    Numeric ``c`` only (descending is expressed by negation).
    """
    flag = c.isNotNull() if nulls_first else c.isNull()  # false sorts first
    return [flag, -c if descending else c]


def first_in_order(keys: list[Column], payload: dict[str, Column]) -> Column:
    """Struct whose ``min`` over a group is the first row under ``keys`` (ascending).

    Read the chosen values back with ``.getField(name)``.
    """
    fields = [k.alias(f"_k{i}") for i, k in enumerate(keys)]
    fields += [v.alias(name) for name, v in payload.items()]
    return F.struct(*fields)
