"""Source divergence audit by single-pass in-memory indexing.

Each task counts the terms of its documents into block postings until a set number is
held, then spills them as a term-sorted run, cut by hash shard into pages. One task per
shard merges its runs by a heap: pages come in the order of their first term, so only the
pages that overlap are held, as Arrow arrays, and summed into one when they are many: what
is held grows with the shard's terms, not with the runs. The merged postings hold one row per kept term. Two sources of
a language are compared over all its terms: what terms that neither has add is known in
closed form, and one pass over the postings streams the corrections of the others.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections import Counter, defaultdict
from itertools import count, groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isobar.llm.common import materialize, pick
from isobar.session import setting

#: A term is kept by a language that has it in so many documents.
MIN_DOCS = 10
#: Ranks of the part ``term``.
TOP = 10
#: Postings (term of a source) and terms that a task holds before it spills a run.
BLOCK_POSTINGS, BLOCK_TERMS = 600_000, 200_000
#: Tokens that are counted at a time.
CHUNK = 1 << 18
#: Rows of a batch of documents or terms that are Python objects at a time.
ROWS = 256
#: Postings of a run's page, the unit that the merge reads.
PAGE = 4_000
#: Pages of a batch, and postings of a page that are Python objects at a time.
PAGES, STEP = 32, 128
#: Postings of held pages beyond which the merge sums them.
HELD = 1 << 20
#: Cells (terms x sources) that a correction step works on at a time.
CELLS = 1 << 19

BATCH_ROWS, SCAN_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.parquet.columnarReaderBatchSize"

_SCALE = 1_000_000_000
_TERM = re.compile(rb"[a-z\x80-\xff]+")  # on UTF-8 with A-Z lower-cased
#: Of a page: its postings by key (language, NUL, term: no term has one) and source.
_RUNS = "shard int, first string, key array<string>, source array<string>, n array<long>, docs array<long>"


def terms_of(text: str) -> list[bytes]:
    return _TERM.findall(text.encode().lower())  # bytes.lower() folds A-Z only


def _summed(pairs: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Equal pairs once, in order, with the sums of their values."""
    order = np.argsort(pairs, kind="stable")
    pairs = pairs[order]
    starts = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]])) if len(pairs) else np.empty(0, np.int64)
    return (pairs[starts], *(np.add.reduceat(v[order], starts) if len(pairs) else v for v in values))


def _added(old: tuple[np.ndarray, ...], new: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
    """The sums of two ``_summed``; the values of ``old`` are added to in place."""
    at = np.searchsorted(old[0], new[0])
    fresh = np.append(old[0], -1)[at] != new[0]
    for a, b in zip(old[1:], new[1:], strict=True):
        a[at[~fresh]] += b[~fresh]
    return tuple(np.insert(a, at[fresh], b[fresh]) for a, b in zip(old, new, strict=True))


class Block:
    """Postings in memory: numbers for the terms of each language and for sources, tokens
    not counted yet, and per (source, term) occurrences and documents."""

    def __init__(self):
        number = count()
        self.terms: dict[str, defaultdict] = defaultdict(lambda: defaultdict(number.__next__))
        self.sources: dict[str, int] = {}
        self.tokens: list[np.ndarray] = []
        self.doc_source: list[int] = []
        self.waiting = 0
        self.counted = (np.empty(0, np.int64),) * 3

    def add(self, lang: str, source: str, found: list[bytes]):
        ids = np.fromiter(map(self.terms[lang].__getitem__, found), np.int64, len(found))
        self.tokens.append(ids + (len(self.doc_source) << 32))
        self.doc_source.append(self.sources.setdefault(source, len(self.sources)))
        self.waiting += len(found)
        if self.waiting >= CHUNK:
            self.count()

    def count(self):
        if not self.tokens:
            return
        tokens = np.concatenate(self.tokens)
        each, n = _summed(tokens, np.ones(len(tokens), np.int64))  # per document and term
        pairs = (np.array(self.doc_source, np.int64)[each >> 32] << 32) + (each & 0xFFFFFFFF)
        self.counted = _added(self.counted, _summed(pairs, n, np.ones(len(n), np.int64)))
        self.tokens, self.doc_source, self.waiting = [], [], 0

    def full(self, postings: int, terms: int) -> bool:
        return len(self.counted[0]) >= postings or sum(map(len, self.terms.values())) >= terms

    def run(self, shards: int, schema: pa.Schema):
        """The block as one term-sorted run, cut by shard into pages. The block is empty then."""
        self.count()
        (pairs, n, docs), terms, names = self.counted, self.terms, pa.array(list(self.sources), pa.string())
        self.__init__()
        if not len(pairs):
            return
        keys = [b"%s\0%s" % (lang.encode(), term) for lang, found in terms.items() for term in found]
        ids = np.fromiter((i for found in terms.values() for i in found.values()), np.int64, len(keys))
        del terms
        order = np.array(sorted(range(len(keys)), key=keys.__getitem__), np.int64)
        shard = np.fromiter((zlib.crc32(k) % shards for k in keys), np.int32, len(keys))
        order = order[np.argsort(shard[order], kind="stable")]  # by shard, then by term
        keys, shard = pa.array(keys, pa.binary()).cast(pa.string()).take(pa.array(order)), shard[order]
        rank = np.empty(len(order), np.int64)
        rank[ids[order]] = np.arange(len(order))
        pairs = (rank[pairs & 0xFFFFFFFF] << 32) + (pairs >> 32)
        place = np.argsort(pairs)
        of = shard[pairs[place] >> 32]
        new = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
        starts = np.concatenate([np.arange(i, j, PAGE) for i, j in zip(new, [*new[1:], len(of)], strict=True)])
        for i in range(0, len(starts), 32):  # pages at a time: bounds the batch
            cut = starts[i : i + 33]
            low, high = int(cut[0]), int(cut[32]) if len(cut) > 32 else len(of)
            bounds = pa.array(np.append(cut[:32], high) - low, pa.int32())
            part = place[low:high]
            key, source = pa.array(pairs[part] >> 32), pa.array(pairs[part] & 0xFFFFFFFF)
            lists = [keys.take(key), names.take(source), pa.array(n[part]), pa.array(docs[part])]
            columns = [pa.array(of[cut[:32]], pa.int32()), lists[0].take(pa.array(cut[:32] - low)), *(pa.ListArray.from_arrays(bounds, x) for x in lists)]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)


def _index(shards: int, postings: int, terms: int, schema: pa.Schema):
    def run(batches):
        block = Block()
        for batch in (b.slice(i, ROWS) for b in batches for i in range(0, b.num_rows, ROWS)):
            for lang, source, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                found = terms_of(text)
                if found:
                    block.add(lang, source, found)
                    if not block.waiting or postings < CHUNK and block.waiting >= postings:
                        block.count()
                    if not block.waiting and block.full(postings, terms):
                        yield from block.run(shards, schema)
                        block = Block()
        yield from block.run(shards, schema)

    return run


def _postings(columns: list[pa.Array]):
    """The postings of a page with their places, a few of which are Python objects at a time."""
    for i in range(0, len(columns[0]), STEP):
        yield from zip(*(c.slice(i, STEP).to_numpy(zero_copy_only=False).tolist() for c in columns), range(i, i + STEP))


def _one_page(parts: list[list[pa.Array]]) -> list[pa.Array]:
    """Pages (key, source, n, docs) as one, in the order of keys, equal postings summed."""
    keys, sources, n, docs = (pa.concat_arrays(c) for c in zip(*parts, strict=True))
    keys, sources = keys.dictionary_encode(), sources.dictionary_encode()
    order = pc.sort_indices(keys.dictionary).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    pairs, n, docs = _summed((rank[keys.indices.to_numpy()] << 32) + sources.indices.to_numpy(), n.to_numpy(), docs.to_numpy())
    names = keys.dictionary.take(pa.array(order[pairs >> 32]))
    return [names, sources.dictionary.take(pa.array(pairs & 0xFFFFFFFF)), pa.array(n), pa.array(docs)]


def _merged(pages, most: int = HELD):
    """Per key of one shard, in order: key, occurrences by source, documents. ``pages`` come
    in the order of their first key: a page is read when the heap's least key is not before
    it, so no more pages are held than overlap. Beyond ``most`` postings these become one."""
    pages, heap, serial, held, limit = iter(pages), [], count(), 0, most

    def opened(columns):
        postings = _postings(columns)
        key, source, n, d, i = next(postings)
        return key, next(serial), source, n, d, i, postings, columns

    coming = next(pages, None)
    while heap or coming is not None:
        while coming is not None and (not heap or coming[0] <= heap[0][0]):
            columns = [c if isinstance(c, pa.Array) else pa.array(c) for c in coming[1]]
            heapq.heappush(heap, opened(columns))
            held += len(columns[0])
            if held > limit:
                columns = _one_page([[c.slice(entry[5]) for c in entry[7]] for entry in heap])
                heap, held = [opened(columns)], len(columns[0])
                limit = max(most, 2 * held)  # summed again when it has doubled
            coming = next(pages, None)
        key, found, docs = heap[0][0], {}, 0
        while heap and heap[0][0] == key:
            _, order, source, n, d, i, postings, columns = heap[0]
            at = key
            while at == key:
                found[source] = found.get(source, 0) + n
                docs += d
                at, source, n, d, i = next(postings, (None, None, 0, 0, 0))
            if at is None:
                heapq.heappop(heap)
                held -= len(columns[0])
            else:
                heapq.heapreplace(heap, (at, order, source, n, d, i, postings, columns))
        yield key, found, docs


def _merge(min_docs: int, schema: pa.Schema):
    """Runs sorted by (shard, first) -> one row per (lang, term) that enough documents have."""

    def pages(batches):
        for batch in batches:
            lists = [batch.column(c) for c in range(2, 6)]
            for i, (shard, first) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                yield shard, first, [c[i].values for c in lists]

    def run(batches):
        rows = []
        for _, shard in groupby(pages(batches), lambda page: page[0]):
            for key, found, docs in _merged(page[1:] for page in shard):
                if docs >= min_docs:
                    lang, term = key.rsplit("\0", 1)
                    sources = sorted(found)
                    rows.append({"lang": lang, "term": term, "sources": sources, "counts": [found[s] for s in sources]})
                if len(rows) == 4096:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows = []
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)

    return run


def frequencies(docs: DataFrame, min_docs: int = MIN_DOCS, block_postings: int = BLOCK_POSTINGS, shards: int | None = None) -> DataFrame:
    """The merged index: lang, term, sources (those that have the term, ascending) and their
    counts, one row per term that at least ``min_docs`` documents of the language have."""
    spark = docs.sparkSession
    shards = shards or max(32, int(spark.conf.get("spark.sql.shuffle.partitions")))
    strings, longs = pa.list_(pa.string()), pa.list_(pa.int64())
    page = pa.schema([("shard", pa.int32()), ("first", pa.string()), ("key", strings), ("source", strings), ("n", longs), ("docs", longs)])
    runs = docs.select("lang", "source", "text").mapInArrow(_index(shards, block_postings, min(BLOCK_TERMS, block_postings), page), _RUNS)
    # Batches by rows: in the JVM, too, a task holds few documents and few pages at a time.
    with setting(spark, BATCH_ROWS, str(ROWS)):
        runs = materialize(runs, "term_runs")
    dealt = runs.repartitionById(shards, "shard").sortWithinPartitions("shard", "first")
    row = pa.schema([("lang", pa.string()), ("term", pa.string()), ("sources", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))])
    merged = dealt.mapInArrow(_merge(min_docs, row), "lang string, term string, sources array<string>, counts array<long>")
    with setting(spark, BATCH_ROWS, str(PAGES)), setting(spark, SCAN_ROWS, str(PAGES)):
        return materialize(merged, "term_frequencies")


def scaled(count: np.ndarray, size: np.ndarray) -> np.ndarray:
    """1 + floor(10^9 (count + 2) / size), exact below 9 * 10^13: in two steps, as the
    product may not fit 64 bits."""
    high, rest = np.divmod((count + 2) * 100_000, size)
    return 1 + high * 10_000 + rest * 10_000 // size


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / (p + q)); both at most 10^9 + 1, so that the square fits."""
    return (p - q) ** 2 // (p + q)


def _correct(batches):
    """Per pair of sources, what the terms that one of them has add to the closed form."""
    sums: dict = {}

    def flushed(least):
        for lang in [x for x in sums if sums[x][1].size >= least]:
            names, total = sums.pop(lang)
            at = np.argwhere(total)
            at = at[at[:, 0] != at[:, 1]]
            for i in range(0, len(at), 65_536):
                g, h = at[i : i + 65_536].T
                columns = [pa.array([lang] * len(g)), pa.array(names).take(pa.array(g)), pa.array(names).take(pa.array(h)), pa.array(total[g, h])]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "item", "more"])

    for batch in (b.slice(i, ROWS) for b in batches for i in range(0, b.num_rows, ROWS)):
        rows = [dict(zip(("lang", "sources", "counts"), r, strict=True)) for r in zip(*(batch.column(c).to_pylist() for c in ("lang", "sources", "counts")), strict=True)]
        for lang, same in groupby(enumerate(rows), lambda r: r[1]["lang"]):
            at, same = zip(*same, strict=True)
            names, sizes = batch.column("names")[at[0]].as_py(), np.array(batch.column("sizes")[at[0]].as_py(), dtype=np.int64)
            place, none = {s: i for i, s in enumerate(names)}, scaled(np.zeros(1, np.int64), sizes)
            base = distance(none[:, None], none[None, :])
            total = sums.setdefault(lang, (names, np.zeros((len(names), len(names)), np.int64)))[1]
            step = max(1, CELLS // len(names))
            for i in range(0, len(same), step):
                part = same[i : i + step]
                counts = np.zeros((len(part), len(names)), np.int64)
                for t, r in enumerate(part):
                    counts[t, [place[s] for s in r["sources"]]] = r["counts"]
                p = scaled(counts, sizes[None, :])
                for g in range(len(names)):
                    has = np.flatnonzero(counts[:, g])
                    add = distance(p[has, g][:, None], p[has]) - base[g]
                    total[g] += add.sum(axis=0)
                    total[:, g] += np.where(counts[has] == 0, add, 0).sum(axis=0)
        yield from flushed(1 << 22)
    yield from flushed(0)


def _p(count: str, size: str) -> Column:
    return F.expr(f"1 + (cast({count} + 2 AS decimal(28,0)) * {_SCALE}BD) div cast({size} AS decimal(20,0))")


def _f(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, block_postings: int = BLOCK_POSTINGS, shards: int | None = None) -> DataFrame:
    """How far the sources of each language are from each other and which terms set them
    apart: lang, source, part, item, value, rank.

    A null text, lang or source is empty. A term is a run of ASCII letters and of characters
    beyond ASCII, A-Z lower-cased. A language keeps the V terms that at least ``min_docs``
    of its documents have. With N the occurrences of kept terms in a group, a term has
    p = 1 + floor(10^9 (count + 2) / (N + 2 V)) there, also if it does not occur. The part
    ``pair`` has all other sources of the language with the sum over its kept terms of
    floor((p - q)^2 / (p + q)), 0 if V is 0; the part ``term`` the ``top`` kept terms of the
    group that are more frequent there than in the language, by the same value. Ranks go by
    value descending, then item. A language without a second source has no pairs, a group
    without kept terms no terms, an empty table no rows; repeated rows are documents of
    their own, other columns are ignored. Whole texts of any length count: a text must fit
    its task, postings beyond ``block_postings`` are spilled."""
    docs = pick(docs, lang="lang", source="source", text="text")
    docs = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    terms = frequencies(docs, min_docs, block_postings, shards)
    each = terms.select("lang", "term", F.explode(F.arrays_zip("sources", "counts")).alias("x"))
    each = each.select("lang", "term", F.col("x.sources").alias("source"), F.col("x.counts").alias("n"))
    kept = terms.groupBy("lang").agg(F.count("*").alias("v"))
    sizes = each.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = docs.select("lang", "source").distinct().join(sizes, ["lang", "source"], "left").join(kept, "lang", "left")
    groups = groups.select("lang", "source", F.coalesce("v", F.lit(0).cast("long")).alias("v"), (F.coalesce("total", F.lit(0).cast("long"))).alias("total"))
    groups = materialize(groups.withColumn("size", F.expr("total + 2 * v")), "source_sizes")

    # Pairs: V terms that neither has, corrected by those that one of them has.
    every = groups.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("source", "size"))).alias("of"))
    every = every.select("lang", F.col("of.source").alias("names"), F.col("of.size").alias("sizes"))
    more = terms.join(every, "lang").mapInArrow(_correct, "lang string, source string, item string, more long")
    more = more.groupBy("lang", "source", "item").agg(F.sum("more").alias("more"))
    unseen = groups.where("v > 0").select("lang", "source", "v", _p("0", "size").alias("p"))
    none = groups.where("v = 0").select("lang", "source", "v", F.lit(1).cast("long").alias("p"))
    unseen = unseen.unionByName(none)
    other = unseen.select("lang", F.col("source").alias("item"), F.col("p").alias("q"))
    pairs = unseen.join(other, "lang").where("source <> item").withColumn("base", _f("p", "q"))
    pairs = pairs.join(more, ["lang", "source", "item"], "left")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", F.expr("v * base + coalesce(more, 0)").alias("value"))

    # Terms: the group's share of a term against the language's.
    whole = groups.groupBy("lang").agg((F.sum("total") + 2 * F.max("v")).alias("lang_size"))
    told = terms.withColumn("m", F.expr("aggregate(counts, 0L, (a, x) -> a + x)"))
    told = told.select("lang", "term", "m", F.explode(F.arrays_zip("sources", "counts")).alias("x"))
    told = told.select("lang", "term", "m", F.col("x.sources").alias("source"), F.col("x.counts").alias("n"))
    told = told.join(groups.select("lang", "source", "size"), ["lang", "source"]).join(whole, "lang")
    told = told.select("lang", "source", "term", _p("n", "size").alias("p"), _p("m", "lang_size").alias("q")).where("p > q")
    told = told.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _f("p", "q").alias("value"))

    group = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    told = told.withColumn("rank", F.row_number().over(group)).where(F.col("rank") <= top)
    return pairs.withColumn("rank", F.row_number().over(group)).unionByName(told).select("lang", "source", "part", "item", "value", "rank")


def brute_force(docs: list[tuple[str | None, str | None, str | None]], min_docs: int = MIN_DOCS, top: int = TOP) -> list[tuple]:
    """The same over a small list of (lang, source, text), sorted, for tests."""
    out, langs = [], {}
    for lang, source, text in docs:
        langs.setdefault(lang or "", {}).setdefault(source or "", []).append(re.findall("[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+", text or ""))
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for lang, sources in langs.items():
        sources = {s: [[w.translate(fold) for w in d] for d in texts] for s, texts in sources.items()}
        seen = Counter(w for texts in sources.values() for d in texts for w in set(d))
        kept = sorted(w for w, n in seen.items() if n >= min_docs)
        counts = {s: Counter(w for d in texts for w in d if seen[w] >= min_docs) for s, texts in sources.items()}
        counts[None] = sum(counts.values(), Counter())
        p = {s: {w: 1 + _SCALE * (c[w] + 2) // (sum(c.values()) + 2 * len(kept)) for w in kept} for s, c in counts.items()}
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pair = sorted((-sum(f(p[s][w], p[o][w]) for w in kept), o) for o in sources if o != s)
            term = sorted((-f(p[s][w], p[None][w]), w) for w in kept if counts[s][w] and p[s][w] > p[None][w])[:top]
            out += [(lang, s, part, item, -v, i) for part, found in (("pair", pair), ("term", term)) for i, (v, item) in enumerate(found, 1)]
    return sorted(out)
