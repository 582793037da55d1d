"""Near-duplicate documents: MinHash bands find candidates, odd sketches of the MinHash
samples estimate their similarity, and whole shingle sets confirm each link.

An odd sketch has the parity of how many MinHash samples fall on each bit, so the
exclusive or of two sketches counts the samples that differ, precisely when there are few.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isobar.llm import wordhash
from isobar.llm.common import LAST_ID, keyed, materialize
from isobar.llm.components import components
from isobar.llm.exact_dedup import winners_of
from isobar.llm.heavy import join_by_key

SHINGLE = 5
BANDS, ROWS = 32, 4
SAMPLES = BANDS * ROWS
SKETCH_BITS = 512


@dataclass(frozen=True)
class Likeness:
    """Documents are linked from ``percent`` % Jaccard similarity of their shingle sets on.

    32 bands of 4 samples miss a pair at 85 % with probability 6e-11, at 80 % with 5e-8.
    A pair is passed on to the exact test unless its sketches differ in more bits than a
    linked pair's ever do but for a probability below 1e-9 (``most_bits``)."""

    percent: int = 85

    @property
    def most_bits(self) -> int:
        p = 1 - self.percent / 100
        differ = SAMPLES * p + 6.5 * math.sqrt(SAMPLES * p * (1 - p))
        bits = SKETCH_BITS / 2 * (1 - math.exp(-4 * differ / SKETCH_BITS))
        return math.ceil(bits + 3 * math.sqrt(bits))


_RNG = np.random.Generator(np.random.PCG64(909090))
_A = _RNG.integers(0, 2**63, size=SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RNG.integers(0, 2**64, size=SAMPLES, dtype=np.uint64)
_C = _RNG.integers(0, 2**64, size=SAMPLES, dtype=np.uint64)


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, concatenated, and their bounds.

    Shingles are 5 words with A-Z folded; a text of 1 to 4 words has one shingle, all of
    them; a text without words has none."""
    found = wordhash.split(texts)
    hashes, first = found.hashes(lower=True), found.first
    grams, whole = wordhash.ngrams(hashes, first, SHINGLE)
    counts = found.counts
    for k in range(1, SHINGLE):
        short = first[:-1][counts == k]
        if len(short):
            grams[short] = wordhash.mix(wordhash.ngrams(hashes, first, k)[0][short] + np.uint64(k))
            whole[short] = True
    sets = [np.unique(grams[a:b][whole[a:b]]) for a, b in zip(first[:-1], first[1:], strict=True)]
    bounds = np.concatenate([[0], np.cumsum([len(s) for s in sets], dtype=np.int64)]).astype(np.int64)
    return (np.concatenate(sets) if sets else np.empty(0, np.uint64)), bounds


def samples(shingles: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """MinHash samples (texts x SAMPLES, 32 bits) of non-empty sets."""
    out = np.empty((len(bounds) - 1, SAMPLES), dtype=np.uint64)
    i = 0
    while i < len(out):  # slices that stay in the processor's cache
        j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + 30_000, side="right")) - 1)
        part, at = shingles[bounds[i] : bounds[j]], bounds[i:j] - bounds[i]
        for k in range(SAMPLES):
            out[i:j, k] = np.minimum.reduceat(part * _A[k] + _B[k], at) >> np.uint64(32)
        i = j
    return out


def odd_sketches(sampled: np.ndarray) -> np.ndarray:
    """Parity bitmaps (texts x 8 longs)."""
    bits = (wordhash.mix(sampled ^ _C) % np.uint64(SKETCH_BITS)).astype(np.int64)
    cells = bits + np.arange(len(bits))[:, None] * SKETCH_BITS
    parity = (np.bincount(cells.ravel(), minlength=len(bits) * SKETCH_BITS) & 1).astype(np.uint8)
    return np.packbits(parity.reshape(len(bits), SKETCH_BITS), axis=1).view(np.int64)


def band_keys(sampled: np.ndarray) -> np.ndarray:
    """One 64-bit key per band (texts x BANDS); equal only within the same band."""
    shaped = sampled.reshape(len(sampled), BANDS, ROWS)
    keys = (wordhash.mix(shaped + _C.reshape(BANDS, ROWS)) * wordhash._STEPS[:ROWS]).sum(axis=2, dtype=np.uint64)
    return wordhash.mix(keys + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


_SIGNED = "rid long, rank long, text_key long, n_shingles long, digest binary, bands array<long>, sketch array<long>"


def _sign(batches):
    for batch in wordhash.small_batches(batches, "text"):
        shingles, bounds = shingle_sets(batch.column("text"))
        n = np.diff(bounds)
        some = np.flatnonzero(n)
        sampled = samples(shingles, np.r_[bounds[some], bounds[-1]]) if len(some) else np.empty((0, SAMPLES), np.uint64)
        at = np.full(len(n), -1)
        at[some] = np.arange(len(some))
        digest = [hashlib.sha256(shingles[a:b].tobytes()).digest()[:16] if b > a else None for a, b in zip(bounds[:-1], bounds[1:], strict=True)]

        def lists(rows):
            width = rows.shape[1]
            return pa.ListArray.from_arrays(
                pa.array(np.r_[0, np.cumsum(np.where(n > 0, width, 0))], pa.int32()), pa.array(rows.ravel(), pa.int64())
            )

        yield pa.RecordBatch.from_arrays(
            [batch.column("rid"), batch.column("rank"), batch.column("text_key"), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), lists(band_keys(sampled)), lists(odd_sketches(sampled))],
            ["rid", "rank", "text_key", "n_shingles", "digest", "bands", "sketch"],
        )


def _sets(batches):
    for batch in wordhash.small_batches(batches, "text"):
        shingles, bounds = shingle_sets(batch.column("text"))
        sets = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(shingles.view(np.int64), pa.int64()))
        yield pa.RecordBatch.from_arrays([batch.column("rid"), sets], ["rid", "shingles"])


def differing_bits(a: Column, b: Column) -> Column:
    """Population count of the exclusive or of two sketches."""
    parts = [F.bit_count(a[i].bitwiseXOR(b[i])) for i in range(SKETCH_BITS // 64)]
    return sum(parts[1:], parts[0])


def _may_link(like: Likeness) -> Column:
    """Length filter and sketch estimate, for pairs a, b of nodes."""
    small, large = F.least("a.n_shingles", "b.n_shingles"), F.greatest("a.n_shingles", "b.n_shingles")
    return (small * 100 >= large * like.percent) & (differing_bits(F.col("a.sketch"), F.col("b.sketch")) <= like.most_bits)


def _confirmed(pairs: DataFrame, sets: DataFrame, like: Likeness) -> DataFrame:
    """The pairs (a, b) whose whole sets are as similar as asked."""
    one = sets.select(F.col("rid").alias("a"), F.col("shingles").alias("of_a"))
    two = sets.select(F.col("rid").alias("b"), F.col("shingles").alias("of_b"))
    both = F.size(F.array_intersect("of_a", "of_b"))
    either = F.size("of_a") + F.size("of_b") - both
    return pairs.join(one, "a").join(two, "b").where(both * 100 >= either * like.percent).select("a", "b")


def _hub_pairs(buckets: DataFrame, nodes: DataFrame, like: Likeness) -> DataFrame:
    """Pairs of each bucket's hub with its other members: as many as members. The hub is
    the member with the most bucket mates over all bands, the middle of a dense group."""
    sizes = buckets.groupBy("key").agg(F.count("*").alias("n"))
    mates = buckets.join(sizes, "key").groupBy("rid").agg(F.sum("n").alias("mates"))
    ranked = buckets.join(mates, "rid")
    hubs = ranked.groupBy("key").agg(F.max(F.struct("mates", (-F.col("rid")).alias("last"))).alias("hub"))
    pairs = buckets.join(hubs.select("key", (-F.col("hub.last")).alias("hub")), "key").where("rid <> hub")
    pairs = pairs.select(F.least("rid", "hub").alias("a"), F.greatest("rid", "hub").alias("b")).distinct()
    return _likely(pairs, nodes, like)


def _likely(pairs: DataFrame, nodes: DataFrame, like: Likeness) -> DataFrame:
    a, b = nodes.alias("a"), nodes.alias("b")
    joined = pairs.alias("p").join(a, F.col("p.a") == F.col("a.rid")).join(b, F.col("p.b") == F.col("b.rid"))
    return joined.where(_may_link(like)).select("p.a", "p.b")


def _open_nodes(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """rid and label of the members of buckets that hold more than one component."""
    known = F.coalesce("label", "rid").alias("label")
    rows = buckets.join(labels.withColumnRenamed("node", "rid"), "rid", "left").select("key", "rid", known)
    mixed = rows.groupBy("key").agg(F.min("label").alias("l"), F.max("label").alias("m")).where("l < m").select("key")
    return rows.join(mixed, "key", "left_semi").select("rid", "label").distinct()


def _open_pairs(open_nodes: DataFrame, sets: DataFrame, nodes: DataFrame, like: Likeness) -> DataFrame:
    """All pairs of open nodes in different components that may be linked.

    Sets that are as similar as asked share one of the first few of their shingles, taken
    from the rarest on, and no more shingles than allowed come before it in either. Around
    a template each copy's own changes are its rarest shingles, so copies that differ too
    much never meet, whatever the size of the group."""
    each = sets.join(open_nodes.select("rid"), "rid").select("rid", F.size("shingles").alias("n"), F.explode("shingles").alias("token"))
    counts = each.groupBy("token").agg(F.count("*").alias("times"))
    by_rarity = Window.partitionBy("rid").orderBy("times", "token")
    ranked = each.join(counts, "token").withColumn("i", F.row_number().over(by_rarity) - 1)
    prefix = F.col("n") - F.ceil(F.col("n") * like.percent / 100) + 1
    rows = ranked.where((F.col("i") < prefix) & (F.col("times") > 1)).select("rid", "n", "token", "i").join(open_nodes, "rid")
    rows = materialize(rows, "rare_shingles")
    a, b = rows.alias("a"), rows.alias("b")
    meet = (F.col("a.token") == F.col("b.token")) & (F.col("a.rid") < F.col("b.rid")) & (F.col("a.label") != F.col("b.label"))
    long_enough = F.least("a.n", "b.n") * 100 >= F.greatest("a.n", "b.n") * like.percent
    ahead = F.least(F.col("a.n") - F.col("a.i"), F.col("b.n") - F.col("b.i"))
    in_reach = ahead * (100 + like.percent) >= (F.col("a.n") + F.col("b.n")) * like.percent
    pairs = a.join(b, meet & long_enough & in_reach).select(F.col("a.rid").alias("a"), F.col("b.rid").alias("b")).distinct()
    return _likely(pairs, nodes, like)


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85) -> DataFrame:
    """One row per document: rank and text_key (as in ``keyed``), rid, n_shingles, the
    component's smallest rank, and whether the row is the one of its component that stays.

    Equal sets become one node first. Nodes that share a band key are candidates: first
    each bucket's hub is tested with the other members, which links dense groups at linear
    cost; then the members of buckets that are still in different components are paired by
    their rarest shingles. Every pair passes its sketches and is tested on whole sets."""
    like = Likeness(percent)
    docs = keyed(docs, id_col, text_col)
    signed = materialize(
        docs.withColumn("rid", F.monotonically_increasing_id()).select("rid", "rank", "text_key", "text").mapInArrow(_sign, _SIGNED), "signatures"
    )
    classes = winners_of(signed.where("digest IS NOT NULL").select(F.col("rank").alias("doc_id"), "rid", "digest"))
    classes = materialize(classes.select("rid", F.col("keep_rid").alias("node")), "set_classes")
    nodes = signed.join(classes.where("rid = node").select("rid"), "rid")
    band_rows = materialize(nodes.select("rid", F.explode("bands").alias("key")), "bands")
    several = band_rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    buckets = materialize(band_rows.join(several, "key"), "buckets")
    near = materialize(
        nodes.join(buckets.select("rid").distinct(), "rid").select("rid", "rank", "text_key", "n_shingles", "sketch"), "bucket_nodes"
    )
    info = near.select("rid", "n_shingles", "sketch")
    hub_pairs = materialize(_hub_pairs(buckets, info, like), "hub_pairs")
    of_near = near.select("rid", "rank", "text_key")
    sets = materialize(
        docs.join(of_near, ["rank", "text_key"]).select("rid", "text").mapInArrow(_sets, "rid long, shingles array<long>").dropDuplicates(["rid"]),
        "shingle_sets",
    )
    links = materialize(_confirmed(hub_pairs, sets, like), "hub_links")
    labels = materialize(components(links), "hub_components")
    open_nodes = materialize(_open_nodes(buckets, labels), "open_nodes")
    open_pairs = materialize(_open_pairs(open_nodes, sets, info, like).join(hub_pairs, ["a", "b"], "left_anti"), "open_pairs")
    more = materialize(_confirmed(open_pairs, sets, like), "open_links")
    if not more.isEmpty():
        edges = labels.select(F.col("node").alias("a"), F.col("label").alias("b")).unionByName(more)
        labels = materialize(components(edges), "components")
    members = signed.select("rid", "rank", "text_key", "n_shingles").join(classes, "rid", "left").join(labels, "node", "left")
    members = members.withColumn("group", F.coalesce("label", "node", "rid"))
    members = materialize(members, "group_members")
    best = members.groupBy("group").agg(F.min(F.struct("rank", "rid")).alias("best"))
    return join_by_key(members, best, "group").select(
        "rank", "text_key", "rid", "n_shingles", F.col("best.rank").alias("component"), (F.col("rid") == F.col("best.rid")).alias("kept")
    )


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents are linked when their shingle sets have a Jaccard similarity of ``percent`` %
    or more; component_id is the smallest doc_id reachable by links (null counts as the
    largest), and that row is kept. Of repeated rows with the same doc_id and text one is
    kept. A null or empty text has no shingles and is linked with nothing. An empty table
    gives no rows. Whole texts count, whatever their length."""
    doc_id = lambda rank: F.when(F.col(rank) != LAST_ID, F.col(rank))
    return near_groups(docs, id_col, text_col, percent).select(
        doc_id("rank").alias("doc_id"), "n_shingles", doc_id("component").alias("component_id"), "kept"
    )


def brute_force(docs: list[tuple[int, str | None]], percent: int = 85) -> dict[int, tuple[int, int, bool]]:
    """The contract over a list of documents with distinct ids, for tests."""
    import re

    sets, inverted, label = {}, {}, {}
    for i, text in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[i] = {tuple(w[p : p + 5]) for p in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
        for s in sets[i]:
            inverted.setdefault(s, []).append(i)
        label[i] = i

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in sets:
        both: dict[int, int] = {}
        for s in sets[i]:
            for j in inverted[s]:
                if j < i:
                    both[j] = both.get(j, 0) + 1
        for j, n in both.items():
            if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                x, y = root(i), root(j)
                label[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i), root(i) == i) for i in sets}
