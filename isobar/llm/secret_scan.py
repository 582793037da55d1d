"""Secret scan with multipart credential linking.

Strong patterns are reported wherever they match. Weak parts (identifiers, random-looking
strings, endpoints) are noise on their own; an interval join reports them only where
complementary parts of a credential lie within one scope of each other.
All of it is DataFrame code: match positions come from the lengths of a text's matches and
of the pieces between them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isobar.llm.common import keyed, materialize

# The strong patterns, in the order in which kinds are listed.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
LEAST_VALUE = 8
ACCESS = r"AKIA[A-Z0-9]{12,}"  # longest runs: the same as all runs without those under 16
HEX = r"[0-9a-f]{32,}"

# Weak parts.
WEAK_ID = r"(?i:(client_?id|user_?name|user|login|account))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9@_.-]{3,})"
WEAK_SECRET = r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{20,}"
ENDPOINT = r"https?://[A-Za-z0-9.:/_-]+"

KINDS = ["assign", "access", "hex", "weak_id", "weak_secret", "endpoint"]
STRONG = KINDS[:3]
#: What a kind stands for in a credential.
PARTS = {"identifier": ["access", "weak_id"], "secret": ["assign", "hex", "weak_secret"]}
#: A weak kind is reported if each of these parts starts within its scope.
NEEDS = {"weak_id": ["secret"], "weak_secret": ["identifier"], "endpoint": ["identifier", "secret"]}
#: Code points that may lie between two parts of a credential.
SCOPE = 256


def _lengths(strings: Column) -> Column:
    return F.transform(strings, F.length)


def _matches(text: Column, kind: str, pattern: str, good) -> Column:
    """kind, lengths of the pieces before each match, lengths of the matches, and which of
    them count; matches are leftmost and do not overlap."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.struct(
        F.lit(kind).alias("kind"),
        F.when(F.regexp_like(text, F.lit(pattern)), _lengths(F.split(text, pattern, -1))).alias("gaps"),
        F.when(F.regexp_like(text, F.lit(pattern)), _lengths(found)).alias("sizes"),
        F.when(F.regexp_like(text, F.lit(pattern)), good(text, pattern)).alias("good"),
    )


def _all_good(text, pattern):
    return F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda _: F.lit(True))


def _long_value(text, pattern):
    return F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(2)), lambda v: F.length(v) >= LEAST_VALUE)


def _random_looking(text, pattern):
    mixed = lambda v: F.regexp_like(v, F.lit("[0-9]")) & F.regexp_like(v, F.lit("[a-z]")) & F.regexp_like(v, F.lit("[A-Z]"))
    return F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), mixed)


def spans(docs: DataFrame) -> DataFrame:
    """Matches of every kind in ``docs`` (rank, text_key, text): rank, text_key, kind,
    start, end, in code points with the end exclusive; weak ones not linked yet."""
    rules = [
        ("assign", ASSIGN, _long_value),
        ("access", ACCESS, _all_good),
        ("hex", HEX, _all_good),
        ("weak_id", WEAK_ID, _all_good),
        ("weak_secret", WEAK_SECRET, _random_looking),
        ("endpoint", ENDPOINT, _all_good),
    ]
    per_kind = docs.select("rank", "text_key", F.explode(F.array(*[_matches(F.col("text"), *r) for r in rules])).alias("m"))
    per_kind = per_kind.where(F.size("m.sizes") > 0).select("rank", "text_key", "m.*").dropDuplicates(["rank", "text_key", "kind"])
    each = per_kind.select(
        "rank", "text_key", "kind", F.posexplode(F.arrays_zip("sizes", F.slice("gaps", 1, F.size("sizes")).alias("gaps"), "good")).alias("n", "m")
    )
    before = Window.partitionBy("rank", "text_key", "kind").orderBy("n")
    end = F.sum(F.col("m.gaps") + F.col("m.sizes")).over(before)
    return (
        each.select("rank", "text_key", "kind", "m.good", (end - F.col("m.sizes")).alias("start"), end.alias("end"))
        .where("good")
        .drop("good")
    )


def _outside_strong(found: DataFrame) -> DataFrame:
    """Without the weak matches that begin inside a strong one."""
    strong_end = F.when(F.col("kind").isin(STRONG), F.col("end"))
    ahead = Window.partitionBy("rank", "text_key").orderBy("start", ~F.col("kind").isin(STRONG)).rowsBetween(Window.unboundedPreceding, 0)
    inside = F.coalesce(F.max(strong_end).over(ahead) > F.col("start"), F.lit(False))
    return found.withColumn("inside", inside).where(F.col("kind").isin(STRONG) | ~F.col("inside")).drop("inside")


def link_parts(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """The weak matches that have all the parts they need within ``scope``: no more than so
    many code points lie between the two.

    An interval join over stretches of ``scope`` code points: a weak match lies in those that
    it touches, a part in those within reach of it, and two that are near meet in one. It is
    a semi-join, so no pairs are made; a match has stretches in proportion to its length."""
    reach = lambda low, high: F.explode(F.sequence(F.floor(low / scope), F.floor(high / scope)))
    out = None
    for kind, needs in NEEDS.items():
        weak = found.where(F.col("kind") == kind)
        for part in needs:
            other = found.where(F.col("kind").isin(PARTS[part])).select(
                F.col("rank").alias("r"), F.col("text_key").alias("k"), F.col("start").alias("from"), F.col("end").alias("to"),
                reach(F.col("start") - scope, F.col("end") + scope).alias("s"),
            )
            asked = weak.withColumn("stretch", reach(F.col("start"), F.col("end")))
            same = (F.col("rank") == F.col("r")) & (F.col("text_key") == F.col("k")) & (F.col("stretch") == F.col("s"))
            near = (F.col("start") - F.col("to") <= scope) & (F.col("from") - F.col("end") <= scope)
            weak = asked.join(other, same & near, "left_semi").drop("stretch").distinct()
        out = weak if out is None else out.unionByName(weak)
    return out


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """One row per document: doc_id and ``found``, its spans as an array of struct<start,
    place (of the kind in KINDS), kind, end>, sorted, strong ones and linked weak ones.

    A null text is empty, rows with a null id are searched too, repeated rows get the same
    spans, an empty table gives no rows, other columns of any names are ignored. Whole texts
    are searched, whatever their length."""
    source = keyed(docs, id_col, text_col)
    parts = materialize(_outside_strong(spans(source)), "secret_parts")
    reported = parts.where(F.col("kind").isin(STRONG)).unionByName(link_parts(parts, scope))
    place = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    found = reported.groupBy("rank", "text_key").agg(
        F.sort_array(F.collect_list(F.struct("start", place.alias("place"), "kind", "end"))).alias("found")
    )
    none = F.array().cast("array<struct<start:bigint,place:bigint,kind:string,end:bigint>>")
    return source.select("doc_id", "rank", "text_key").join(found, ["rank", "text_key"], "left").select("doc_id", F.coalesce("found", none).alias("found"))


def _joined(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def secret_digests(docs: DataFrame) -> DataFrame:
    """``find_secrets`` as counts, the digest of the strong spans, and all spans as text."""
    of = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")
    strong = F.filter("found", lambda s: s["kind"].isin(STRONG))
    return find_secrets(docs).select(
        "doc_id",
        of("assign").alias("n_assign"),
        of("access").alias("n_access"),
        of("hex").alias("n_hex"),
        F.sha2(_joined(strong), 256).alias("base_sha256"),
        _joined(F.col("found")).alias("spans"),
    )
