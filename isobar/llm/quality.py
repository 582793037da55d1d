"""Quality classifier from weak labels.

Overlapping heuristic labellers vote on each document: clean, junk, or nothing. Expectation
maximisation over the counts of vote patterns estimates how each labeller votes on clean
and on junk documents, without any given label. The posteriors are soft labels of a bounded
sample, on which a linear scorer over hashed features is trained; it scores all documents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isobar.llm import wordhash
from isobar.llm.common import documents, materialize, pick

#: Documents that the scorer is trained on, at most (about; chosen by hash).
TRAIN_DOCS = 20_000
#: Hashed features of the scorer.
FEATURES = 4096
#: Documents with a higher probability of being junk are rejected.
REJECT = 0.5

# Common short words of the corpus' languages.
STOP_WORDS = {
    "en": "the of and to in is that it for on was with as by at from be this are or an not a he which",
    "fr": "le la les de des du un une et en que qui dans par pour sur au aux est ce il ne pas avec",
    "de": "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an",
    "es": "el la los las de del que y en un una por con no se su para es al lo como más o pero",
}
_STOP = np.unique(wordhash.split(pa.array([" ".join(STOP_WORDS.values())], pa.string())).hashes(lower=True))

LABELLERS = ["symbols", "capitals", "adjacent_repeats", "repeated_passages", "vocabulary", "stop_words", "punctuation", "word_length", "lone_symbols"]
ABSTAIN, CLEAN, JUNK = 0, 1, 2

_UPPER, _LETTER, _SYMBOL, _ENDS = (np.zeros(256, dtype=bool) for _ in range(4))
_UPPER[ord("A") : ord("Z") + 1] = True
_LETTER[ord("a") : ord("z") + 1] = True
_LETTER |= _UPPER
_LETTER[128:] = True
_SYMBOL[[ord(c) for c in "#$%&*|@~^<>{}[]\\=+_/!"]] = True
_ENDS[[ord(c) for c in ".,;:?"]] = True

# Classes of bytes for the shapes of words: letters, capitals and digits; others stay.
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[_LETTER], _SHAPE[_UPPER] = ord("a"), ord("A")
_SHAPE[ord("0") : ord("9") + 1] = ord("9")


def _count(mask: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(mask)])[bounds])


def _distinct(values: np.ndarray, usable: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Usable values of each text, and distinct ones among them."""
    sizes = [(int(u.sum()), len(np.unique(v[u]))) for v, u in ((values[a:b], usable[a:b]) for a, b in zip(first[:-1], first[1:], strict=True))]
    return tuple(np.array(sizes, dtype=np.int64).reshape(-1, 2).T)


def _vote(measure: np.ndarray, clean_below: float, junk_from: float, enough: np.ndarray) -> np.ndarray:
    return np.where(~enough, ABSTAIN, np.where(measure >= junk_from, JUNK, np.where(measure < clean_below, CLEAN, ABSTAIN)))


def votes(texts: pa.Array) -> np.ndarray:
    """One vote per text and labeller (texts x labellers). Texts too short for a measure
    get no vote on it; a text without words gets none at all."""
    w = wordhash.split(texts)
    n, hashes = w.counts, w.hashes(lower=True)
    part = lambda k: k / np.maximum(n, 1)
    letters, size = _count(_LETTER[w.data], w.bounds), (w.end - w.start)
    chars = np.add.reduceat(np.r_[size, 0], np.minimum(w.first[:-1], len(size))) * (n > 0)
    same = np.zeros(len(hashes), dtype=bool)
    same[1:] = hashes[1:] == hashes[:-1]
    same[w.first[:-1][n > 0]] = False
    grams, whole = wordhash.ngrams(hashes, w.first, 5)
    passages, distinct_passages = _distinct(grams, whole, w.first)
    _, vocabulary = _distinct(hashes, np.ones(len(hashes), dtype=bool), w.first)
    symbol_bytes = np.concatenate([[0], np.cumsum(_SYMBOL[w.data])])
    lone = symbol_bytes[w.end] - symbol_bytes[w.start] == size
    stop = part(_count(np.isin(hashes, _STOP), w.first))
    ended = part(_count(_ENDS[w.data[w.end - 1]], w.first))
    mean = chars / np.maximum(n, 1)
    return np.column_stack(
        [
            _vote(_count(_SYMBOL[w.data], w.bounds) / np.maximum(chars, 1), 0.01, 0.05, n >= 5),
            _vote(_count(_UPPER[w.data], w.bounds) / np.maximum(letters, 1), 0.2, 0.5, (n >= 5) & (letters > 0)),
            _vote(part(_count(same, w.first)), 0.1, 0.3, n >= 10),
            _vote(1 - distinct_passages / np.maximum(passages, 1), 0.2, 0.5, passages >= 20),
            _vote(1 - part(vocabulary), 0.75, 0.85, (n >= 50) & (n <= 2000)),
            _vote(-stop, -0.12, -0.04, n >= 30),
            _vote(np.abs(ended - 0.14), 0.11, 0.135, n >= 30),
            _vote(np.abs(mean - 6), 3, 6, n >= 10),
            _vote(part(_count(lone, w.first)), 0.02, 0.15, n >= 10),
        ]
    ).astype(np.int8)


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed features of each text as (text, feature, value) arrays: shapes of words,
    short words, word lengths and repeats, by their share of the words, length 1."""
    w = wordhash.split(texts)
    n, hashes, size = w.counts, w.hashes(lower=True), w.end - w.start
    owner = np.repeat(np.arange(len(n)), n)
    shapes = _SHAPE[w.data]
    first_of_run = np.ones(len(shapes), dtype=bool)
    first_of_run[1:] = shapes[1:] != shapes[:-1]
    first_of_run[w.start] = True
    kept = np.concatenate([[0], np.cumsum(first_of_run)])
    shape = wordhash.Words(shapes[first_of_run], kept[w.start], kept[w.end], w.first, kept[w.bounds]).hashes()
    short = size <= 4
    again = np.zeros(len(hashes), dtype=np.uint64)
    again[1:] = hashes[1:] == hashes[:-1]
    length = wordhash.mix(np.minimum(size, 24).astype(np.uint64) + np.uint64(1000))
    who = np.concatenate([owner, owner[short], owner, owner])
    what = np.concatenate([shape, hashes[short], length, wordhash.mix(again + np.uint64(2000))]) % np.uint64(FEATURES)
    cell, count = np.unique(who * FEATURES + what.astype(np.int64), return_counts=True)
    who, what = cell // FEATURES, cell % FEATURES
    value = np.sqrt(count / n[who])
    norm = np.sqrt(np.bincount(who, weights=value**2, minlength=len(n)))
    return who, what, value / norm[who]


def _each_vote(batches):
    for batch in wordhash.small_batches(batches, "text"):
        cast = votes(batch.column("text"))
        text = ["".join(map(str, row)) for row in cast.tolist()]
        yield pa.RecordBatch.from_arrays([batch.column("pick"), pa.array(text)], ["pick", "votes"])


def _each_feature(batches):
    for batch in wordhash.small_batches(batches, "text"):
        who, what, value = features(batch.column("text"))
        bounds = pa.array(np.searchsorted(who, np.arange(batch.num_rows + 1)), pa.int32())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("pick"),
                pa.array(["".join(map(str, row)) for row in votes(batch.column("text")).tolist()]),
                pa.ListArray.from_arrays(bounds, pa.array(what, pa.int32())),
                pa.ListArray.from_arrays(bounds, pa.array(value, pa.float32())),
            ],
            ["pick", "votes", "features", "vals"],
        )


def expectation_maximisation(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """(probability of junk per pattern, table of P(vote | labeller, class, a vote)).

    ``patterns`` (patterns x labellers) with their document ``counts``. Labellers are taken
    as independent given the class, and an abstention, mostly that of a short text, as no
    evidence. The start is the share of junk among the votes cast."""
    junk, clean = (patterns == JUNK).sum(1), (patterns == CLEAN).sum(1)
    posterior = (junk + 0.05) / (junk + clean + 0.5)
    hot = np.stack([patterns == v for v in (CLEAN, JUNK)], axis=2).astype(float)  # patterns x labellers x votes
    for _ in range(rounds):
        mass = np.stack([counts * (1 - posterior), counts * posterior])  # classes x patterns
        table = np.einsum("cp,plv->clv", mass, hot) + 0.5
        table /= table.sum(axis=2, keepdims=True)
        prior = (mass.sum(axis=1) + 1) / (mass.sum() + 2)
        loglike = np.log(prior)[:, None] + np.einsum("plv,clv->cp", hot, np.log(table))
        new = 1 / (1 + np.exp(np.clip(loglike[0] - loglike[1], -500, 500)))
        done = np.abs(new - posterior).max(initial=0) < 1e-9
        posterior = new
        if done:
            break
    return posterior, table.transpose(1, 0, 2)


def train_scorer(rows, columns, values, labels, rounds: int = 300, decay: float = 1e-5) -> np.ndarray:
    """Weights (the last is the bias) of a logistic regression on soft labels, by full
    gradient steps with a step size per feature. Inputs are a sample's sparse features."""
    weights, squares, n = np.zeros(FEATURES + 1), np.full(FEATURES + 1, 1e-8), max(len(labels), 1)
    for _ in range(rounds):
        margin = np.bincount(rows, weights=weights[columns] * values, minlength=len(labels)) + weights[-1]
        error = 1 / (1 + np.exp(-np.clip(margin, -500, 500))) - labels
        slope = np.r_[np.bincount(columns, weights=error[rows] * values, minlength=FEATURES), error.sum()] / n + decay * weights
        squares += slope**2
        weights -= 0.5 * slope / np.sqrt(squares)
    return weights


class Scorer:
    """A trained scorer: what EM found, and the weights. Small, and sent to every task."""

    def __init__(self, posteriors: dict[str, float], accuracy: np.ndarray, weights: np.ndarray):
        self.posteriors, self.accuracy, self.weights = posteriors, accuracy, weights

    def score(self, texts: pa.Array) -> np.ndarray:
        """Probability of junk; 0.5 of what has no words."""
        who, what, value = features(texts)
        margin = np.bincount(who, weights=self.weights[what] * value, minlength=len(texts)) + self.weights[-1]
        score = 1 / (1 + np.exp(-np.clip(margin, -500, 500)))
        return np.where(np.bincount(who, minlength=len(texts)) > 0, score, 0.5)


def _renamed(docs: DataFrame) -> DataFrame:
    """All columns by place (they may have any names), and the text that is judged."""
    return docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", train_docs: int = TRAIN_DOCS) -> Scorer:
    """EM over the vote patterns of all documents (3 ** labellers rows at most reach the
    driver), then training on ``train_docs`` documents at most, but for a few in a hundred,
    chosen by the hash of id and text; repeated rows count once there."""
    texts = documents(docs, id_col, text_col).select(F.xxhash64("doc_id", "text").alias("pick"), "text")
    patterns = materialize(texts.mapInArrow(_each_vote, "pick long, votes string"), "votes").groupBy("votes").agg(F.count("*").alias("n")).collect()
    patterns = sorted((row["votes"], row["n"]) for row in patterns)
    table = np.array([[int(v) for v in votes_] for votes_, _ in patterns], dtype=np.int8).reshape(len(patterns), len(LABELLERS))
    counts = np.array([n for _, n in patterns], dtype=float)
    posterior, accuracy = expectation_maximisation(table, counts)
    posteriors = {votes_: float(p) for (votes_, _), p in zip(patterns, posterior, strict=True)}
    share = min(1.0, train_docs / max(counts.sum(), 1.0))
    chosen = texts.where(F.pmod("pick", F.lit(1 << 30)) < int(share * (1 << 30))).groupBy("pick").agg(F.first("text").alias("text"))
    sample = chosen.mapInArrow(_each_feature, "pick long, votes string, features array<int>, vals array<float>").toArrow()
    sample = sample.sort_by([("pick", "ascending")]).combine_chunks()
    sizes = np.array([len(x) for x in sample.column("features").to_pylist()], dtype=np.int64)
    flat = lambda c: (np.concatenate([x.flatten().to_numpy(zero_copy_only=False) for x in sample.column(c).chunks]) if len(sample) else np.empty(0))
    labels = np.array([posteriors[v] for v in sample.column("votes").to_pylist()])
    weights = train_scorer(np.repeat(np.arange(len(sizes)), sizes), flat("features").astype(np.int64), flat("vals").astype(float), labels)
    return Scorer(posteriors, accuracy, weights)


def _each_score(place: int, scorer, reject: float):
    def run(batches):
        model = scorer.value
        for batch in wordhash.small_batches(batches, f"c{place}"):
            text = batch.column(place).fill_null("")
            cast = ["".join(map(str, row)) for row in votes(text).tolist()]
            score = model.score(text)
            new = [pa.array(cast), pa.array([model.posteriors.get(v, 0.5) for v in cast]), pa.array(score), pa.array(score <= reject)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], [*batch.schema.names, "votes", "posterior", "score", "kept"])

    return run


def classify(docs: DataFrame, scorer: Scorer, text_col: str = "text", reject: float = REJECT) -> DataFrame:
    """All rows of ``docs`` with its columns named by place (c0, c1, ...) and votes,
    posterior, score, kept. No row is dropped or repeated; a null text counts as empty,
    gets no vote and is kept; an empty table gives no rows."""
    named = _renamed(docs)
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in named.schema] + ["votes string, posterior double, score double, kept boolean"])
    sent = docs.sparkSession.sparkContext.broadcast(scorer)
    return named.mapInArrow(_each_score(docs.columns.index(text_col), sent, reject), schema)


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, votes (a digit per labeller), posterior (of EM),
    score (probability of junk), kept."""
    scored = classify(pick(docs, doc_id=id_col, text=text_col), fit(docs, id_col, text_col), "text")
    return scored.select(F.col("c0").cast("long").alias("doc_id"), "votes", "posterior", "score", "kept")
