"""Scalar Column helpers (F8-F18, P6). All built-in expressions: no Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the token the surrogate-key macro substitutes for NULL members.
SURROGATE_NULL_TOKEN = "_dbt_utils_surrogate_key_null_"
# Fixed value: state used when a coordinate pair has no dimension row.
UNKNOWN_STATE = "UNKNOWN"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*cols) -> Column:
    """md5 of the members' text joined by ``-``; NULL members become a token."""
    parts = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit("-"))
        parts.append(F.coalesce(_col(c).cast("string"), F.lit(SURROGATE_NULL_TOKEN)))
    return F.md5(F.concat(*parts))


def number_text(c) -> Column:
    """text of a double as PostgreSQL prints it (``34.0`` -> ``34``, ``0.0005``, no
    exponent), by its shortest exact decimal; NULL for what is no number of that range."""
    return F.regexp_replace(_col(c).try_cast("decimal(38,18)").cast("string"), r"\.?0+$", "")


def coordinate_label(lat, lon) -> Column:
    """``lat_lon`` text; NULL if either member is NULL (``concat``, not ``concat_ws``)."""
    return F.concat(number_text(lat), F.lit("_"), number_text(lon))


def observation_date(ts) -> Column:
    """F8: calendar date of a local timestamp."""
    return F.to_date(_col(ts))


def hour_of_day(ts) -> Column:
    """F9."""
    return F.hour(_col(ts))


def day_of_week(ts) -> Column:
    """0 = Sunday ... 6 = Saturday."""
    return F.dayofweek(_col(ts)) - 1


def is_weekend(ts) -> Column:
    """Saturday or Sunday; NULL stays NULL."""
    return F.dayofweek(_col(ts)).isin(1, 7)


def fahrenheit_to_celsius_1dp(f_scaled, scale: int = 6) -> Column:
    """``round((f - 32) * 5 / 9, 1)`` exactly, from ``f`` scaled by ``10^scale``.

    tenths = round_half_up((f_s - 32*10^s) * 50 / (9 * 10^s)).
    """
    from isobar.functions.numeric import round_div, round_div_sql, to_decimal, to_decimal_sql

    if isinstance(f_scaled, str):  # SQL text: one expression, one JVM round trip
        num = f"(CAST(({f_scaled}) AS DECIMAL(38,0)) - {32 * 10**scale}) * 50"
        return F.expr(to_decimal_sql(round_div_sql(num, str(9 * 10**scale)), 1))
    num = (f_scaled.cast("decimal(38,0)") - F.lit(32 * 10**scale)) * F.lit(50)
    return to_decimal(round_div(num, F.lit(9 * 10**scale)), 1)


def title_label(c) -> Column:
    """``new_york`` -> ``New York``."""
    return F.initcap(F.regexp_replace(_col(c), "_", " "))


def one_decimal_text(c) -> Column:
    """text with exactly one decimal of a value already rounded to 1 dp."""
    v = F.round(_col(c).cast("decimal(20,6)"), 1)
    return F.when(v.isNotNull(), F.format_string("%.1f", v.cast("double")))


def signed_label(delta) -> Column:
    """F16: ``+1.3°F warmer`` when positive, else ``-0.4°F`` / ``0.0°F``.

    Round before formatting: ``printf`` ties differ between engines.
    """
    d = F.round(_col(delta).cast("decimal(20,6)"), 1)
    txt = one_decimal_text(d)
    return (
        F.when(d > 0, F.concat(F.lit("+"), txt, F.lit("°F warmer")))
        .when(d.isNotNull(), F.concat(txt, F.lit("°F")))
    )


def signed_text(delta) -> Column:
    """``{v:+.1f}°F`` of a value rounded to 1 dp first."""
    d = F.round(_col(delta).cast("decimal(20,6)"), 1)
    return F.concat(F.when(d >= 0, F.lit("+")).otherwise(F.lit("")), one_decimal_text(d), F.lit("°F"))  # NULL in, NULL out


def plain_text(value, digits: int) -> Column:
    """``{v:.0f}`` or ``{v:.2f}`` of a value rounded half away from zero first."""
    return F.round(_col(value).cast("decimal(20,6)"), digits).cast(f"decimal(20,{digits})").cast("string")


def utc_to_local(ts_utc, zone) -> Column:
    """wall-clock time in ``zone`` of a UTC ``timestamp_ntz`` (zone may be a column)."""
    return F.convert_timezone(F.lit("UTC"), _col(zone), _col(ts_utc))


def ntz_epoch_micros(ts_ntz) -> Column:
    """Microseconds since 1970-01-01 00:00 of a ``timestamp_ntz`` wall clock, computed
    from its date and time parts so no session zone (and no DST gap) takes part."""
    t = _col(ts_ntz)
    return (
        F.unix_date(F.to_date(t)).cast("bigint") * F.lit(86_400_000_000)
        + F.hour(t).cast("bigint") * F.lit(3_600_000_000)
        + F.minute(t).cast("bigint") * F.lit(60_000_000)
        + (F.date_part(F.lit("SECOND"), t) * F.lit(1_000_000)).cast("bigint")
    )


def epoch_to_utc(seconds) -> Column:
    """epoch seconds -> UTC wall clock as ``timestamp_ntz``.

    Pure interval arithmetic on the epoch, so no session zone takes part.
    """
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return epoch + F.make_dt_interval(secs=_col(seconds).cast("decimal(18,6)"))
