"""Substring dedup with difference-cover anchors.

Windows of 13 words are compared by hash, but not all of them are hashed into a shuffle.
Anchors are the 7-word hashes at positions 0, 1 and 3 modulo 7. For any two positions there
is a shift below 7 that brings both onto such positions (a perfect difference cover), so
two equal windows always share an anchor at the same offset. Only windows around anchors
that occur in more than one document are extended to 13 words and compared: by a 64-bit hash
that brings equal windows together, and by 32 bits of a second, independent one.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from isobar.llm import wordhash
from isobar.llm.common import keyed, materialize

WINDOW = 13
PERIOD = 7
COVER = (0, 1, 3)  # each difference modulo 7 is a difference of two of these
ANCHOR = WINDOW - PERIOD + 1

_ASK = "h long, rank long, text_key long, pos int, known boolean"
_ASK_TWICE = f"{_ASK}, g int"


def _positions(first: np.ndarray) -> np.ndarray:
    """Each word's position in its own text."""
    return np.arange(first[-1]) - np.repeat(first[:-1], np.diff(first))


def _asks(h, g, rank, key, pos, least_only):
    """Rows that ask the shuffle about a hash (and ``g``, a second one). Within a batch one row per hash does, that
    of the smallest document; what the batch itself knows about the others rides along
    under a spread key, so a frequent hash sends one row per batch.

    ``least_only``: a smaller document settles a row, else any other document does."""
    order = np.lexsort((rank, g, h))
    h, g, rank, key, pos = h[order], g[order], rank[order], key[order], pos[order]
    starts = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (g[1:] != g[:-1])]) if len(h) else np.empty(0, np.int64)
    sizes = np.diff(np.r_[starts, len(h)])
    least, most = np.repeat(rank[starts], sizes), np.repeat(rank[starts + sizes - 1], sizes)
    known = rank > least if least_only else least != most
    asking = ~known
    if not least_only:  # one row per hash tells the others of a document that has it
        asking[starts] = True
    spread = wordhash.mix(key.view(np.uint64) + pos.astype(np.uint64)).view(np.int64)
    return [
        pa.array(np.concatenate([h[asking].view(np.int64), spread[known]])),
        *[pa.array(np.concatenate([x[asking], x[known]])) for x in (rank, key, pos)],
        pa.array(np.concatenate([np.zeros(asking.sum(), bool), np.ones(known.sum(), bool)])),
        pa.array(np.concatenate([g[asking], g[known]])),
    ]


_ASK_NAMES = ["h", "rank", "text_key", "pos", "known", "g"]


def _per_word(batch, counts):
    rank = np.repeat(batch.column("rank").to_numpy(), counts)
    return rank, np.repeat(batch.column("text_key").to_numpy(), counts)


def _anchors(batches):
    """(rank, text_key, text) to one row per asked or known anchor."""
    for batch in wordhash.small_batches(batches, "text", 16 << 20):
        found = wordhash.split(batch.column("text"))
        grams, whole = wordhash.ngrams(found.hashes(), found.first, ANCHOR)
        pos = _positions(found.first)
        at = np.flatnonzero(whole & np.isin(pos % PERIOD, COVER))
        rank, key = _per_word(batch, found.counts)
        yield pa.RecordBatch.from_arrays(_asks(grams[at], np.zeros(len(at), np.int32), rank[at], key[at], pos[at].astype(np.int32), False)[:5], _ASK_NAMES[:5])


def _windows(batches):
    """(rank, text_key, text, anchors) to one row per asked or known window."""
    for batch in wordhash.small_batches(batches, "text", 16 << 20):
        found = wordhash.split(batch.column("text"))
        hashes = found.hashes()
        grams, whole = wordhash.ngrams(hashes, found.first, WINDOW)
        checks = wordhash.ngrams(hashes, found.first, WINDOW, salt=1)[0].astype(np.uint32).view(np.int32)
        anchors = batch.column("anchors")
        marks = np.zeros(len(grams) + 1, dtype=np.int64)
        places = anchors.flatten().to_numpy() + np.repeat(found.first[:-1], anchors.value_lengths().to_numpy())
        begin = np.maximum(places - (WINDOW - ANCHOR), np.repeat(found.first[:-1], anchors.value_lengths().to_numpy()))
        np.add.at(marks, begin, 1)
        np.add.at(marks, places + 1, -1)
        at = np.flatnonzero(whole & (np.cumsum(marks[:-1]) > 0))
        rank, key = _per_word(batch, found.counts)
        pos = _positions(found.first)
        yield pa.RecordBatch.from_arrays(_asks(grams[at], checks[at], rank[at], key[at], pos[at].astype(np.int32), True), _ASK_NAMES)


def _cut(batches):
    """(doc_id, text, windows) to the text without the words that the windows cover."""
    for batch in wordhash.small_batches(batches, "text", 16 << 20):
        found = wordhash.split(batch.column("text"))
        counts = found.counts
        windows = batch.column("windows")
        lengths = windows.value_lengths().fill_null(0).to_numpy()
        marks = np.zeros(len(found.start) + WINDOW + 1, dtype=np.int64)
        begin = windows.flatten().to_numpy() + np.repeat(found.first[:-1], lengths)
        np.add.at(marks, begin, 1)
        np.add.at(marks, begin + WINDOW, -1)
        gone = np.cumsum(marks)[: len(found.start)] > 0
        removed = np.diff(np.r_[0, np.cumsum(gone)][found.first])
        texts = []
        for i in range(batch.num_rows):
            kept = np.flatnonzero(~gone[found.first[i] : found.first[i + 1]]) + found.first[i]
            texts.append(b" ".join(found.text(j) for j in kept).decode())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(texts, pa.string())],
            ["doc_id", "n_words", "n_removed", "kept_text"],
        )


def _places(rows: DataFrame, name: str) -> DataFrame:
    return rows.groupBy("rank", "text_key").agg(F.sort_array(F.collect_set("pos")).alias(name))


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_text (kept words joined by
    one space).

    A word goes if a window of 13 consecutive words that covers it also starts in a
    document with a smaller doc_id; windows are judged on the input. Repeats within a
    document and texts under 13 words stay. A null text has no words, a null doc_id comes
    after all others, rows that share a doc_id do not remove each other's words. An empty
    table gives no rows, other columns of any names are ignored. Texts of any length are read
    whole."""
    docs = keyed(docs, id_col, text_col)
    same_hash = Window.partitionBy("h")
    asked = docs.select("rank", "text_key", "text").mapInArrow(_anchors, _ASK)
    several = (F.min("rank").over(same_hash) < F.max("rank").over(same_hash)).alias("several")
    shared = asked.select("rank", "text_key", "pos", "known", several).where("known OR several")
    anchors = materialize(_places(shared, "anchors"), "anchors")
    asked = docs.join(anchors, ["rank", "text_key"]).select("rank", "text_key", "text", "anchors").mapInArrow(_windows, _ASK_TWICE)
    earlier = (F.min("rank").over(Window.partitionBy("h", "g")) < F.col("rank")).alias("earlier")
    covered = asked.select("rank", "text_key", "pos", "known", earlier).where("known OR earlier")
    windows = materialize(_places(covered, "windows"), "windows")
    return (
        docs.join(windows, ["rank", "text_key"], "left")
        .select("doc_id", "text", "windows")
        .mapInArrow(_cut, "doc_id long, n_words long, n_removed long, kept_text string")
    )


def removed_words(docs: DataFrame) -> DataFrame:
    """``cut_repeats`` with the kept text's SHA-256 in its place."""
    return cut_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def brute_force(docs: list[tuple[int, str | None]]) -> dict[int, tuple[int, int, str]]:
    """The contract over a small list of documents with distinct ids, for tests."""
    import re

    split = {i: re.findall(r"[^\x20\x09-\x0D]+", text or "") for i, text in docs}
    least: dict[tuple, int] = {}
    for i, w in split.items():
        for p in range(len(w) - WINDOW + 1):
            g = tuple(w[p : p + WINDOW])
            least[g] = min(least.get(g, i), i)
    out = {}
    for i, w in split.items():
        gone = {q for p in range(len(w) - WINDOW + 1) if least[tuple(w[p : p + WINDOW])] < i for q in range(p, p + WINDOW)}
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        out[i] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out
