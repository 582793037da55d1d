"""Benchmark decontamination by item-sized windows.

Windows as long as a benchmark item slide over a document; they are built only where enough
of an item's shingles occur, and windows of the same shingles once. Each gets a fingerprint
(64-bit SimHash). The items' fingerprints lie in a multi-index: cut into one block more than
the radius has bits, two fingerprints within the radius agree in a whole block, so that the
join on blocks finds all of them. Candidates are verified by the exact weighted similarity
of their shingles, a shingle's weight being its occurrences.

At a similarity of 0.8 some fingerprints lie beyond any small radius. Windows are therefore
verified against the items whose shingles they were built for as well, at any distance:
``found_by`` says which way found a pair. DataFrame functions throughout.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isobar.llm.common import LAST_ID, keyed, materialize, one_kind_of_space, pick, split_words

SHINGLE = 5
#: Radius of the multi-index and its blocks, one of which any two fingerprints within the
#: radius have in common.
RADIUS = 15
BLOCKS = RADIUS + 1
BLOCK_BITS = 64 // BLOCKS
#: Similarity from which on a window counts as the item, as a fraction.
ALIKE = (4, 5)
#: Shingles of the benchmark up to which they are broadcast (about 30 MB); with more, Spark
#: joins by shuffling.
BROADCAST_SHINGLES = 1_000_000

_LANES = 0x0000000100000001  # two counters of 32 bits in a long: more than an array has values


def with_hashes(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``h``, the hashes of the text's lower-cased words, in place of the text."""
    flat = one_kind_of_space(df, F.lower(text)).drop(text)
    return flat.withColumn("h", F.transform(split_words(), lambda w: F.xxhash64(w))).drop("_flat")


def _shingle(h: Column, at: Column) -> Column:
    return F.xxhash64(*[F.get(h, at + k) for k in range(SHINGLE)])


def shingles(h: Column) -> Column:
    """Hashes of the 5 words from each position on; none for fewer words. ``h`` has to be a
    plain column: it is read for each of them."""
    return F.when(F.size(h) >= SHINGLE, F.transform(F.sequence(F.lit(0), F.size(h) - SHINGLE), lambda p: _shingle(h, p))).otherwise(
        F.array().cast("array<bigint>")
    )


def _lane_sums(values: Column, shift: int) -> Column:
    """How many of ``values`` have the bits shift and shift + 32: two counters."""
    add = lambda acc, x: acc + F.shiftright(x, shift).bitwiseAND(F.lit(_LANES))
    return F.aggregate(values, F.lit(0).cast("long"), add)


def simhash(values: Column) -> Column:
    """64-bit SimHash of an array of hashes: bit by bit, the majority."""
    n = F.size(values)
    bits = []
    for shift in range(32):
        lanes = _lane_sums(values, shift)
        for lane in range(2):
            count = F.shiftrightunsigned(lanes, 32 * lane).bitwiseAND(F.lit(0xFFFFFFFF))
            bit = 1 << (shift + 32 * lane)
            bits.append(F.when(count * 2 > n, F.lit(bit - (1 << 64) if bit >> 63 else bit)).otherwise(F.lit(0)))
    while len(bits) > 1:  # each bit is set in one of the terms only
        bits = [a.bitwiseOR(b) for a, b in zip(bits[::2], bits[1::2], strict=True)]
    return bits[0]


def blocks(fingerprint: Column) -> Column:
    """(block number, its value) of a fingerprint."""
    value = lambda i: F.shiftrightunsigned(fingerprint, i * BLOCK_BITS).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1))
    return F.array(*[F.struct(F.lit(i).alias("block"), value(i).alias("value")) for i in range(BLOCKS)])


def _tagged(df: DataFrame, ordered: str, out: str) -> DataFrame:
    """A multiset, given as a column of sorted values, as a set ``out``: each value with the
    numbers of its occurrences, run by run."""
    starts, n = f"_starts_{out}", F.size(ordered)
    new = lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1))
    df = df.withColumn(starts, F.filter(F.sequence(F.lit(0), n - 1), new))
    runs = F.transform(
        starts,
        lambda s, j: F.transform(F.sequence(F.lit(0), F.coalesce(F.get(starts, j + 1), n) - s - 1), lambda k: F.xxhash64(F.get(ordered, s), k)),
    )
    return df.withColumn(out, F.flatten(runs)).drop(starts)


def _needed(m: Column, of_window: Column) -> Column:
    """Fewest common shingles at which two sizes reach the similarity."""
    a, b = ALIKE
    return F.ceil((m + of_window) * a / (a + b)).cast("int")


def benchmark_items(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item_id, item_key, values (sorted shingle hashes), tagged (as a set), m (their number),
    fingerprint."""
    items = pick(benchmark, item_id=id_col, text=text_col).select("item_id", F.coalesce("text", F.lit("")).alias("text")).distinct()
    items = with_hashes(items.select("item_id", F.xxhash64("item_id", "text").alias("item_key"), "text"))
    items = items.select("item_id", "item_key", F.sort_array(shingles(F.col("h"))).alias("values"))
    items = _tagged(items.where(F.size("values") > 0), "values", "tagged").withColumn("m", F.size("values"))
    return items.withColumn("fingerprint", simhash(F.col("values")))


def _windows(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Windows with enough shingles of an item: rank, text_key, windows, an array of
    struct<start, m, size, item_keys> (size is below m in documents shorter than the item)."""
    of_items = materialize(items.select("item_key", "m", F.explode(F.array_distinct("values")).alias("shingle")), "benchmark_shingles")
    small = of_items.count() <= BROADCAST_SHINGLES
    each = docs.select("rank", "text_key", "h", (F.size("h") - (SHINGLE - 1)).alias("n"), F.posexplode("h").alias("at", "word"))
    each = each.where("at < n").select("rank", "text_key", "n", "at", _shingle(F.col("h"), F.col("at")).alias("shingle"))
    hits = each.join(F.broadcast(of_items) if small else of_items, "shingle")
    hits = hits.groupBy("rank", "text_key", "item_key", "m", "n").agg(F.sort_array(F.collect_set("at")).alias("p"))
    hits = hits.withColumn("size", F.least("m", "n")).withColumn("need", _needed(F.col("m"), F.col("size"))).where(F.size("p") >= F.col("need"))
    last = lambda i: F.get("p", i + F.col("need") - 1)  # noqa: E731  of `need` hits from the i-th on
    final = lambda i: F.least(F.get("p", i), F.col("n") - F.col("size"))
    # Windows that hold `need` hits from the i-th on start from `low` to `final`. Both grow
    # with i, so what the hit before covers is left out and every start comes once.
    low = lambda i: F.greatest(F.lit(0), last(i) - F.col("size") + 1, F.when(i > 0, final(i - 1) + 1).otherwise(0))
    ranges = F.transform(F.sequence(F.lit(0), F.size("p") - F.col("need")), lambda i: F.struct(low(i).alias("low"), final(i).alias("high")))
    ranges = hits.select("rank", "text_key", "item_key", "m", "size", F.explode(F.filter(ranges, lambda r: r["low"] <= r["high"])).alias("r"))
    spots = ranges.select("rank", "text_key", "item_key", "m", "size", F.explode(F.sequence("r.low", "r.high")).alias("start"))
    spots = spots.groupBy("rank", "text_key", "start", "m", "size").agg(F.collect_set("item_key").alias("item_keys"))
    return spots.groupBy("rank", "text_key").agg(F.collect_list(F.struct("start", "m", "size", "item_keys")).alias("windows"))


def indexed(windows: DataFrame, items: DataFrame) -> DataFrame:
    """The pairs of ``windows`` (m, print and others) and items of as many shingles whose
    fingerprints are within the radius: all of them, through the blocks of the multi-index."""
    index = items.select("item_key", "m", "fingerprint", F.explode(blocks(F.col("fingerprint"))).alias("b")).select("item_key", "m", "fingerprint", "b.*")
    asked = windows.withColumn("b", F.explode(blocks(F.col("print")))).select(*windows.columns, "b.*")
    met = asked.join(index, ["m", "block", "value"]).where(F.bit_count(F.col("print").bitwiseXOR(F.col("fingerprint"))) <= RADIUS)
    return met.drop("block", "value", "fingerprint")


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """One row per document and benchmark item found in it: rank and text_key of the
    document, doc_id, item_id, similarity, start and n_words of the best window (the first
    of equally good ones), distance of the fingerprints, found_by (``index`` within the
    radius, else ``shingles``). Other columns of any names are ignored.

    Words are lower-cased. A window has as many words as the item, or the whole document if
    that is shorter. Windows and items under five words have no shingle and match nothing,
    so null and empty texts don't. Equal rows count once, rows with a null id are searched
    too. Of an empty table or benchmark nothing is found. Items and
    documents may have any number of words."""
    source = keyed(docs, id_col, text_col)
    hashed = with_hashes(source.select("rank", "text_key", "text"))
    items = materialize(benchmark_items(benchmark, item_id_col, item_text_col), "benchmark_items")
    windows = materialize(_windows(hashed, items), "leak_windows")
    met = source.join(windows, ["rank", "text_key"]).dropDuplicates(["rank", "text_key"]).select("rank", "text_key", "windows", "text")
    met = with_hashes(met).withColumn("all", shingles(F.col("h"))).select("rank", "text_key", F.explode("windows").alias("w"), "all")
    seen = F.sort_array(F.slice("all", F.col("w.start") + 1, F.col("w.size")))
    met = met.select("rank", "text_key", "w.*", seen.alias("seen"))
    # of windows with the same shingles the first one stands for all
    met = met.groupBy("rank", "text_key", "m", "size", "seen").agg(F.min("start").alias("start"), F.array_distinct(F.flatten(F.collect_set("item_keys"))).alias("item_keys"))
    met = materialize(met.withColumn("print", simhash(F.col("seen"))), "window_prints")
    window = ["rank", "text_key", "start", "m", "size"]
    ways = [indexed(met, items).select(*window, "item_key"), met.select(*window, F.explode("item_keys").alias("item_key"))]
    pairs = ways[0].unionByName(ways[1]).distinct()
    near = pairs.join(met.select(*window, "seen", "print"), window).join(items.drop("m"), "item_key")
    both = F.size(F.array_intersect("seen_tagged", "tagged"))
    alike = _tagged(near, "seen", "seen_tagged").withColumn("both", both).withColumn("either", F.col("m") + F.col("size") - F.col("both"))
    alike = alike.where(F.col("both") * ALIKE[1] >= F.col("either") * ALIKE[0])
    alike = alike.withColumn("distance", F.bit_count(F.col("print").bitwiseXOR(F.col("fingerprint"))))
    best = alike.groupBy("rank", "text_key", "item_key").agg(
        F.max(F.struct((F.col("both") / F.col("either")).alias("similarity"), (-F.col("start")).alias("first"), "size", "distance", "item_id")).alias("x")
    )
    return best.select(
        "rank",
        "text_key",
        F.when(F.col("rank") != LAST_ID, F.col("rank")).alias("doc_id"),
        "x.item_id",
        "x.similarity",
        (-F.col("x.first")).cast("long").alias("start"),
        (F.col("x.size") + SHINGLE - 1).cast("long").alias("n_words"),
        F.col("x.distance").alias("distance"),
        F.when(F.col("x.distance") <= RADIUS, "index").otherwise("shingles").alias("found_by"),
    )


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The found pairs as doc_id, item_id, similarity, start, n_words."""
    return find_leaks(docs, benchmark).select("doc_id", "item_id", "similarity", "start", "n_words")
