"""Window operators (W1-W3) in skew-safe form.

W1 is a window per location: after the dedupe a location has one row per hour, so its
partition is bounded by the time span, not by the data volume.

W2/W3, a mean and a count over all rows of a date, are a partial aggregation per date
joined back, not a window over the date: a date holding a third of all rows is
pre-aggregated map-side, and the per-date table is small enough for AQE to broadcast
it at run time (otherwise AQE splits the skewed side of the shuffle join).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isobar.functions.numeric import WIDE_INT, mean_half_up


def rolling_mean_3(
    df: DataFrame,
    part: list[str],
    order: str,
    value_scaled: Column,
    out: str,
    digits: int = 2,
    scale: int = 6,
    tie: list[Column] | None = None,
) -> DataFrame:
    """Rounded mean of the current and two preceding rows (NULLs skipped).

    Row based: gaps in time are not filled, the first rows of a partition use one or two
    values. ``value_scaled`` is the value as an integer at ``10^scale``."""
    rows = Window.partitionBy(*part).orderBy(F.col(order), *(tie or [])).rowsBetween(-2, 0)
    v = value_scaled.cast(WIDE_INT)
    summed = df.withColumns({"_s": F.sum(v).over(rows), "_n": F.count(v).over(rows)})
    return summed.withColumn(out, mean_half_up("_s", "_n", digits, scale)).drop("_s", "_n")


def with_group_means(
    df: DataFrame,
    keys: list[str],
    means: dict[str, tuple[Column, int]],
    count_name: str | None = None,
    scale: int = 6,
) -> DataFrame:
    """Attach per-group rounded means (and the group's row count) to every row.

    ``means`` maps output name -> (value scaled to ``10^scale`` as integer, digits).
    Equivalent to ``round(avg(v) over (partition by keys), d)`` and
    ``count(*) over (partition by keys)``; NULL keys form their own group. ``df`` is read
    twice (aggregate and join): pass a materialised table, as the pipeline does.
    """
    aggs = []
    for name, (v, _) in means.items():
        aggs.append(F.sum(v.cast(WIDE_INT)).alias(f"_s_{name}"))
        aggs.append(F.count(v).alias(f"_n_{name}"))
    if count_name:
        aggs.append(F.count(F.lit(1)).alias(count_name))
    g = df.groupBy(*keys).agg(*aggs)
    g = g.select(
        *[F.col(k).alias(f"_g_{k}") for k in keys],
        *[mean_half_up(f"_s_{n}", f"_n_{n}", d, scale).alias(n) for n, (_, d) in means.items()],
        *([F.col(count_name)] if count_name else []),
    )
    cond = None
    for k in keys:
        c = df[k].eqNullSafe(g[f"_g_{k}"])
        cond = c if cond is None else cond & c
    return df.join(g, cond, "left").drop(*[f"_g_{k}" for k in keys])
