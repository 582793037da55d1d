"""Line dedup by an exact set-similarity join.

A line is the set of its words in lower case. Tokens are ordered by rarity, and two sets of
Jaccard 0.8 or more share a token among the first few of that order (prefix filter). Sets
that meet on one are checked by length, by the positions of the shared token, and by parity
bitmaps of the whole sets, which differ in no more bits than the sets differ in tokens. What
is left is verified as whole sets. A line with an earlier match is removed. DataFrame
functions throughout.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isobar.llm.common import discard, keyed, materialize, one_kind_of_space, split_words
from isobar.session import setting

#: Jaccard similarity from which on lines match, as a fraction.
ALIKE = (4, 5)
#: Counters of the rarity table, half a byte each, which goes to every task. Tokens that
#: share a counter get the same rarity, which costs candidates but loses none: corpora with
#: many more distinct words want more. A power of 2.
COUNTERS = 1 << 18

_HASH_BITS = 57  # of a token; the six bits before are log2 of its count
#: Lines just before a line, among those that share a token, that it is first tested against.
NEIGHBOURS = 4
#: Tokens by which lines are first tested: of each prefix the least in so many orders.
DRAWN = 4
#: Windows over the lines by token.
SHARES = 1 << 14
#: Lets Spark sift the documents by a Bloom filter of those that a join wants, before it
#: shuffles their texts, whatever their size.
SIEVED = ("spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold", "0")
_LINE = ["rank", "text_key", "line_no"]
_SET = ["set_a", "set_b", "n"]
#: Parity bitmap of a token set, 64 bits a column.
_PARITY = ["even_0", "even_1"]


def lines_of(text: str | Column) -> Column:
    return F.split(text, "\n", -1)


def _flat_words(df: DataFrame, text: str) -> DataFrame:
    """``df`` with ``_flat``, of which ``split_words`` gives the words that are compared."""
    return one_kind_of_space(df, F.lower(text))


def _rarity(docs: DataFrame, counters: int) -> Column:
    """log2 of the count of each hash counter (15 at most), over all words of all texts: an
    array of ``counters`` / 16 numbers, whatever the input."""
    each = _flat_words(docs.select("text"), "text").select(F.explode(split_words()).alias("word"))
    counts = each.groupBy(F.xxhash64("word").bitwiseAND(F.lit(counters - 1)).alias("id")).agg(F.least(F.floor(F.log2(F.count("*"))), F.lit(15)).alias("class"))
    packed = counts.groupBy(F.shiftright("id", 4).alias("at")).agg(F.bit_or(F.expr("shiftleft(class, cast(4 * (id & 15) AS int))")).alias("classes"))
    table = [0] * (counters // 16)
    for row in packed.collect():  # at most counters / 16 rows
        table[row["at"]] = row["classes"]
    return F.split(F.lit(",".join(map(str, table))), ",").cast("array<bigint>")


def _tokens(rarity: Column, counters: int) -> Column:
    """Distinct token hashes of the words of ``_flat``, the rarest first."""

    def ordered(h):
        # Never null, which lets Spark sort the tokens as plain numbers.
        packed = F.coalesce(F.get(rarity, F.shiftright(h, 4).bitwiseAND(F.lit(counters // 16 - 1)).cast("int")), F.lit(0).cast("long"))
        kind = F.call_function("shiftrightunsigned", packed, (h.bitwiseAND(F.lit(15)) * 4).cast("int")).bitwiseAND(F.lit(15))
        return F.shiftleft(kind, _HASH_BITS).bitwiseOR(F.shiftrightunsigned(h, 64 - _HASH_BITS))

    hashes = F.transform(F.split("_flat", " "), lambda word: F.xxhash64(word))
    return F.sort_array(F.transform(F.array_except(hashes, F.array(F.xxhash64(F.lit("")))), ordered))


def _prefix_size(n: Column) -> Column:
    """n minus the fewest tokens a set of n shares with any match, plus one."""
    return n - F.ceil(n * ALIKE[0] / ALIKE[1]).cast("int") + 1


def _parity(tokens: Column) -> list[Column]:
    """Parity of how many tokens fall on each of 64 bits, twice over: a token counts in one
    of the two. The first is what all tokens give without the second's."""

    def parity(here) -> Column:
        bit = lambda t: F.call_function("shiftleft", here(t), t.bitwiseAND(F.lit(63)).cast("int"))
        return F.aggregate(tokens, F.lit(0).cast("long"), lambda acc, t: acc.bitwiseXOR(bit(t)))

    odd = parity(lambda t: F.shiftright(t, 6).bitwiseAND(F.lit(1).cast("long")))
    return [parity(lambda t: F.lit(1).cast("long")).bitwiseXOR(odd).alias(_PARITY[0]), odd.alias(_PARITY[1])]


def _lines(docs: DataFrame, rarity: Column, counters: int) -> DataFrame:
    """All lines: position, identity of its token set, prefix and parity bitmap."""
    each = docs.select("rank", "text_key", F.posexplode(lines_of("text")).alias("line_no", "line"))
    each = _flat_words(each, "line").select(*_LINE, _tokens(rarity, counters).alias("tokens"))
    return each.select(
        *_LINE,
        F.size("tokens").alias("n"),
        F.xxhash64("tokens").alias("set_a"),
        F.hash("tokens").alias("set_b"),
        F.slice("tokens", F.lit(1), _prefix_size(F.size("tokens"))).alias("prefix"),
        *_parity(F.col("tokens")),
    )


def _first_lines(lines: DataFrame) -> DataFrame:
    """The first line of each token set with its prefix and parity bitmap, and ``cid``:
    numbers in the order of position."""
    first = lines.where("n > 0").groupBy(*_SET).agg(F.min(F.struct("rank", "line_no", "text_key", "prefix", *_PARITY)).alias("at"))
    place = first.select(*_SET, "at.*").repartitionByRange("rank", "line_no", "text_key").sortWithinPartitions("rank", "line_no", "text_key")
    return place.withColumn("cid", F.monotonically_increasing_id())


def _size(side: str) -> Column:
    return F.shiftrightunsigned(F.col(f"{side}.place"), 32)


def _differ(a: str, b: str) -> Column:
    """Bits in which the parity bitmaps of two sets differ."""
    return sum(F.bit_count(F.col(f"{a}.{word}").bitwiseXOR(F.col(f"{b}.{word}"))) for word in _PARITY)


def _alike(a: str, b: str) -> Column:
    """Length and bitmap filters for two sets."""
    n, m = _size(a), _size(b)
    up, down = ALIKE
    in_length = F.least(n, m) * down >= F.greatest(n, m) * up
    # Of n + m tokens, at most (n + m) * (down - up) / (up + down) are in one set only.
    return in_length & (_differ(a, b) * (up + down) <= (n + m) * (down - up))


def _in_position(a: str, b: str) -> Column:
    """Positional filter for two sets at the first token they share."""
    position = lambda x: F.shiftrightunsigned(F.col(f"{x}.place"), 1).bitwiseAND(F.lit(0x7FFFFFFF))
    n, m = _size(a), _size(b)
    up, down = ALIKE
    return F.least(n - position(a), m - position(b)) * (up + down) >= (n + m) * up


def _place(settled: Column) -> Column:
    """The size of a set, the token's position in it, and whether it is settled."""
    size, position = F.shiftleft(F.col("n").cast("long"), 32), F.shiftleft(F.col("i").cast("long"), 1)
    return size.bitwiseOR(position).bitwiseOR(settled.cast("long"))


def _verified(pairs: DataFrame, docs: DataFrame, firsts: DataFrame, rarity: Column, counters: int) -> DataFrame:
    """The pairs (early, late) of cids whose whole token sets are similar enough. Only
    documents with a line among the pairs are split again."""
    needed = pairs.select(F.col("early").alias("cid")).union(pairs.select("late")).distinct().join(firsts, "cid")
    per_doc = materialize(needed.groupBy("rank", "text_key").agg(F.sort_array(F.collect_list(F.struct("line_no", "cid"))).alias("wanted"), F.count("*").alias("n")), "wanted_lines")
    picked = docs.join(per_doc.where("n > 0"), ["rank", "text_key"]).withColumn("lines", lines_of("text"))
    picked = picked.select(F.explode(F.transform("wanted", lambda w: F.struct(w["cid"].alias("cid"), F.get("lines", w["line_no"]).alias("line")))).alias("w"))
    split = _flat_words(picked.select("w.cid", "w.line"), "line").select("cid", _tokens(rarity, counters).alias("tokens"))
    with setting(docs.sparkSession, *SIEVED):
        sets = materialize(split.dropDuplicates(["cid"]), "line_sets")  # repeated rows give a line twice
    discard(per_doc)
    one = sets.select(F.col("cid").alias("early"), F.col("tokens").alias("a"))
    two = sets.select(F.col("cid").alias("late"), F.col("tokens").alias("b"))
    both = F.size(F.array_intersect("a", "b"))
    alike = both * ALIKE[1] >= (F.size("a") + F.size("b") - both) * ALIKE[0]
    found = materialize(pairs.join(one, "early").join(two, "late").where(alike).select(F.col("late").alias("cid")).distinct(), "matched_lines")
    discard(sets)
    return found


def _removed(known: DataFrame, firsts: DataFrame, docs: DataFrame, rarity: Column, counters: int) -> DataFrame:
    """cids of the first lines that have an earlier match; ``known`` has cid, n, prefix
    and parity of all first lines.

    First a line is tested against a few others that have the same least token of the prefix
    in one of ``DRAWN`` orders, wherever it ranks: the earliest and the ``NEIGHBOURS`` just
    before it, as far as the bitmaps let them match. Those are ``DRAWN * (NEIGHBOURS + 1)``
    pairs a line at most. Lines that this settles, nearly all of a dense group, are only
    paired as the earlier one from then on."""
    drawn = F.array(*[F.array_min(F.transform("prefix", lambda t: F.xxhash64(t, F.lit(k)))) for k in range(DRAWN)])  # noqa: B023
    some = known.select("cid", "n", F.lit(0).alias("i"), *_PARITY, F.explode(drawn).alias("token"))
    # A window over each token's lines would have few rows each: many tokens share one, in
    # which a row's token is compared with its neighbours'.
    by_place = Window.partitionBy("share").orderBy("token", "cid")
    met = some.select(F.pmod("token", F.lit(SHARES)).alias("share"), "token", "cid", F.struct("token", "cid", _place(F.lit(0)).alias("place"), *_PARITY).alias("me"))
    met = met.withColumn("start", F.when(F.lag("token").over(by_place).eqNullSafe(F.col("token")), F.lit(None)).otherwise(F.col("me")))
    others = [F.last("start", ignorenulls=True).over(by_place.rowsBetween(Window.unboundedPreceding, 0)), *[F.lag("me", k).over(by_place) for k in range(1, NEIGHBOURS + 1)]]
    met = met.select("me", *[other.alias(f"other_{k}") for k, other in enumerate(others)])
    met = met.select("me", F.explode(F.array(*[f"other_{k}" for k in range(len(others))])).alias("other"))
    met = met.where((F.col("other.token") == F.col("me.token")) & (F.col("other.cid") < F.col("me.cid")) & _alike("other", "me"))
    met = met.select(F.col("other.cid").alias("early"), F.col("me.cid").alias("late")).distinct()
    met = materialize(met, "near_lines")
    settled = _verified(met, docs, firsts, rarity, counters)
    discard(met)
    # One shuffle of the prefixes serves both sides: what holds for one side only, that its
    # line is not settled, is written as a condition on both, and the filter that Spark
    # would infer for one side is on both from the start.
    flagged = known.where("cid IS NOT NULL").join(settled.withColumn("done", F.lit(1)), "cid", "left").withColumn("done", F.coalesce("done", F.lit(0)))
    shared = flagged.select("cid", "n", "done", *_PARITY, F.posexplode("prefix").alias("i", "token"))
    shared = shared.select("token", "cid", _place(F.col("done")).alias("place"), *_PARITY)
    late, early = shared.alias("l"), shared.alias("e")
    limit = F.when(F.col("l.place").bitwiseAND(F.lit(1)) == 1, F.lit(-1)).otherwise(F.col("l.cid"))
    meet = (F.col("l.token") == F.col("e.token")) & (F.col("e.cid") < limit) & _in_position("e", "l") & _alike("e", "l")
    pairs = late.join(early, meet).select(F.col("e.cid").alias("early"), F.col("l.cid").alias("late")).distinct()
    pairs = materialize(pairs, "line_pairs")
    more = _verified(pairs, docs, firsts, rarity, counters)
    discard(pairs)
    return settled.union(more).distinct()


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS) -> DataFrame:
    """One row per document: rank, text_key, doc_id, n_lines, n_removed, kept_text.

    Lines end at ``\\n`` and go by doc_id (null last), then line number. A line's tokens
    are its distinct words in lower case. A line is removed if an earlier line anywhere has
    a token set of Jaccard 0.8 or more with its own, removed or not. Lines without words
    stay. Repeated rows with the same doc_id and text count as one and get the same text.
    A null text is empty and has one line; an empty table gives no rows; other columns, of
    any names, are ignored. Whole texts and lines of any length count."""
    source = keyed(docs, id_col, text_col)
    rarity = _rarity(source, counters)
    lines = materialize(_lines(source, rarity, counters), "lines")
    firsts = materialize(_first_lines(lines), "first_lines")
    known = firsts.select("cid", "n", "prefix", *_PARITY)
    places = materialize(lines.where("n > 0").select(*_LINE), "line_places")
    discard(lines)
    removed = _removed(known, firsts, source, rarity, counters)
    kept_first = firsts.join(removed, "cid", "left_anti").select(*_LINE)
    gone = places.join(kept_first, _LINE, "left_anti").groupBy("rank", "text_key").agg(F.collect_set("line_no").alias("gone"))
    gone = materialize(gone, "removed_lines")
    for table in (places, firsts):
        discard(table)
    out = source.join(gone, ["rank", "text_key"], "left").withColumn("lines", lines_of("text"))
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone")
    kept = F.when(F.col("gone").isNull(), F.col("lines")).otherwise(F.transform(left, lambda i: F.get("lines", i)))
    out = out.select("rank", "text_key", "doc_id", F.size("lines").cast("long").alias("n_lines"), kept.alias("kept"))
    return out.select(
        "rank", "text_key", "doc_id", "n_lines", (F.col("n_lines") - F.size("kept")).alias("n_removed"), F.array_join("kept", "\n").alias("kept_text")
    )


def line_digests(docs: DataFrame) -> DataFrame:
    """``dedup_lines`` with the SHA-256 of the kept text in its place."""
    return dedup_lines(docs).select("doc_id", "n_lines", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def brute_force(docs: list[tuple[int, str | None]]) -> dict[int, tuple[int, int, str]]:
    """The same over a small list of documents with distinct ids, for tests."""
    out, before = {}, []
    for i, text in sorted(docs, key=lambda d: d[0]):
        kept, lines = [], (text or "").split("\n")
        for line in lines:
            tokens = {w for w in line.lower().replace("\t", " ").replace("\r", " ").split(" ") if w}
            if not tokens or not any(5 * len(tokens & b) >= 4 * len(tokens | b) for b in before if 5 * len(tokens) >= 4 * len(b) and 5 * len(b) >= 4 * len(tokens)):
                kept.append(line)
            if tokens:
                before.append(tokens)
        out[i] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out
