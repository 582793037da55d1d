"""Nested JSON / array operators.

A document holds parallel arrays under a section (``hourly`` or ``daily``): one
``time`` array plus one array per variable. Flattening emits one row per position of
``time`` (1-based index); a shorter variable array yields NULL past its end and a
longer one is cut to ``time``'s length. Everything stays in the JVM: ``from_json``
with a section-only schema, ``posexplode`` and ``get``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isobar.schemas import PASSTHROUGH, section_schema


def parse_section(body: Column, section: str, variables) -> Column:
    """Parse only ``section`` of the document (column pruning inside the JSON)."""
    return F.from_json(body, section_schema(section, variables)).getField(section)


def flatten_section(
    raw: DataFrame,
    section: str,
    variables,
    index_name: str,
    time_name: str,
    time_type: T.DataType,
    passthrough: list[str] = PASSTHROUGH,
    body_col: str = "response_body",
    parsed_col: str | None = None,
    errors_col: str | None = None,
) -> DataFrame:
    """One row per element of ``section.time``.

    With ``parsed_col`` the documents were parsed already (see :func:`parse_sections`)
    and the section is read from that struct column instead of parsing ``body_col``.

    * N4: ``posexplode`` is an inner generator, so an absent section, a JSON null or an
      empty ``time`` array contributes no rows; ``index = pos + 1``.
    * N2: ``get(arr, pos)`` is NULL out of range (never ``arr[pos]``, which raises
      under ANSI).
    * N5: ANSI casts from the token text; a bad token fails the job, unless
      ``errors_col`` names a column: then the casts are ``try_cast`` and the column has one
      (column, token, reason) per bad token of the row, built in the same projection (see
      :func:`isolate`).
    """
    if parsed_col:
        sec = F.col(parsed_col).getField(section)
    else:
        sec = parse_section(F.col(body_col), section, variables)
    parsed = raw.select(*passthrough, sec.alias("_s"))
    # ``posexplode_outer`` + an explicit filter on the generated position: same rows as
    # the inner generator, but Catalyst does not infer ``size(from_json(..)) > 0`` below
    # the generator, which would parse every document a second time.
    exploded = parsed.select(
        *passthrough,
        "_s",
        F.posexplode_outer(F.col("_s.time")).alias("_pos", "_time"),
    ).filter(F.col("_pos").isNotNull())
    # one projection as SQL text: ``get(arr, pos)`` then an ANSI cast per variable
    cols = [f"`{c}`" for c in passthrough]
    cols.append(f"CAST(_pos + 1 AS INT) AS `{index_name}`")
    cast = "TRY_CAST" if errors_col else "CAST"
    tokens = [("_time", time_name, time_type)] + [(f"get(_s.`{key}`, _pos)", name, dtype) for key, name, dtype in variables]
    cols += [f"{cast}({token} AS {dtype.simpleString()}) AS `{name}`" for token, name, dtype in tokens]
    if errors_col:
        cols.append(f"array_compact(array({', '.join(_error(*t) for t in tokens)})) AS `{errors_col}`")
    return exploded.selectExpr(*cols)


def _error(token: str, name: str, dtype: T.DataType) -> str:
    """NULL, or what is wrong with a token that its column's type can't take."""
    if isinstance(dtype, T.IntegerType):
        reason = (
            f"CASE WHEN TRY_CAST({token} AS DOUBLE) IS NULL THEN 'not_a_number' "
            f"WHEN abs(TRY_CAST({token} AS DOUBLE)) < 2147483648 THEN 'not_an_integer' ELSE 'out_of_range' END"
        )
    elif isinstance(dtype, T.DecimalType):
        reason = f"CASE WHEN TRY_CAST({token} AS DOUBLE) IS NULL THEN 'not_a_number' ELSE 'out_of_range' END"
    else:
        reason = "'bad_time'"
    bad = f"{token} IS NOT NULL AND TRY_CAST({token} AS {dtype.simpleString()}) IS NULL"
    return f"CASE WHEN {bad} THEN named_struct('column', '{name}', 'token', {token}, 'reason', {reason}) END"


def isolate(checked: DataFrame, lineage: list[str], errors_col: str = "errors") -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantine) of a flatten with ``errors_col``, in one pass: the rows
    are written once, as they come (no shuffle), with a flag by which either side's scan
    filters. The quarantine has one row per bad token: ``lineage``, column, token
    and reason. No token ends the job, and a row with one bad token leaves no others behind."""
    from isobar.session import materialize

    rows = materialize(checked.withColumn("_bad", F.size(errors_col) > 0), "isolated_rows")
    bad = rows.where("_bad").select(*lineage, F.explode(errors_col).alias("_e")).select(*lineage, "_e.*")
    return rows.where("NOT _bad").drop("_bad", errors_col), bad


def parse_sections(
    raw: DataFrame,
    sections: dict[str, list],
    passthrough: list[str] = PASSTHROUGH,
    body_col: str = "response_body",
    out: str = "_doc",
) -> DataFrame:
    """Parse several sections of every document in one pass (one ``from_json``), for
    pipelines that flatten more than one section: pass the result and
    ``parsed_col=out`` to :func:`flatten_section`."""
    fields = []
    for name, variables in sections.items():
        fields += section_schema(name, variables).fields
    return raw.select(*passthrough, F.from_json(F.col(body_col), T.StructType(fields)).alias(out))


def typed_sections(
    raw: DataFrame,
    sections: dict[str, list],
    passthrough: list[str] = PASSTHROUGH,
    doc_col: str = "response_doc",
    out: str = "_doc",
) -> DataFrame:
    """The same column as :func:`parse_sections`, read from documents that are a VARIANT:
    nothing is parsed, and the scan takes only the arrays that are used."""
    array = "try_variant_get(`{doc}`, '$.{section}.{key}', 'array<string>')"
    fields = []
    for section, variables in sections.items():
        keys = ["time"] + [key for key, _, _ in variables]
        arrays = [F.expr(array.format(doc=doc_col, section=section, key=key)).alias(key) for key in keys]
        fields.append(F.struct(*arrays).alias(section))
    return raw.select(*passthrough, F.struct(*fields).alias(out))


def document_reason(body: Column, sections: list[str]) -> Column:
    """Why a document cannot be flattened, NULL if it can; one JSON pass.

    ``not_json`` for text that is no JSON object, ``<section>_time_not_array`` when a
    section's ``time`` is present but not an array (the reference would raise on the whole
    run). An absent section or a JSON null is not an error: it just yields no rows."""
    shape = ", ".join(f"{s} struct<time: string>" for s in sections) + ", _corrupt string"
    doc = F.from_json(body, shape, {"columnNameOfCorruptRecord": "_corrupt"})
    # the corrupt record first: of several bad sections the first one names the reason
    reason = F.when(body.isNull() | doc["_corrupt"].isNotNull(), F.lit("not_json"))
    for s in sections:
        time = doc[s]["time"]
        reason = reason.when(time.isNotNull() & ~F.startswith(F.ltrim(time), F.lit("[")), F.lit(f"{s}_time_not_array"))
    return reason


def split_valid(raw: DataFrame, sections: list[str], body_col: str = "response_body"):
    """Split documents into (good, quarantined) without failing the batch; ``bad``
    carries a ``reason`` column (see :func:`document_reason`)."""
    tagged = raw.withColumn("reason", document_reason(F.col(body_col), sections))
    return tagged.filter(F.col("reason").isNull()).drop("reason"), tagged.filter(F.col("reason").isNotNull())


def regular_axis(
    df: DataFrame,
    start_s: Column,
    end_s: Column,
    step_s: int,
    values: dict[str, Column],
    keep: list[str],
    index_name: str = "step_index",
    time_name: str = "step_time_utc",
) -> DataFrame:
    """Values on a regular time axis ``[start, end)`` with step ``step_s`` seconds.

    The axis is left-closed (``end`` excluded); ``start >= end`` gives no rows. Each value
    array is zipped by position with the axis (NULL past its end). Times are UTC
    ``timestamp_ntz`` built from epoch seconds.
    """
    from isobar.functions.columns import epoch_to_utc

    n = F.greatest(F.lit(0), F.ceil((end_s - start_s) / F.lit(step_s))).cast("int")
    axis = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    base = df.select(
        *keep,
        start_s.cast("bigint").alias("_start"),
        *[v.alias(f"_v_{k}") for k, v in values.items()],
        F.posexplode(axis).alias("_pos", "_k"),
    )
    return base.select(
        *keep,
        (F.col("_pos") + 1).cast("int").alias(index_name),
        epoch_to_utc(F.col("_start") + F.col("_k").cast("bigint") * F.lit(step_s)).alias(time_name),
        *[F.get(F.col(f"_v_{k}"), F.col("_pos")).alias(k) for k in values],
    )
