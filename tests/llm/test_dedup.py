"""Exact, near, line and substring dedup against brute force, and odd inputs."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from isobar.llm import line_dedup, near_dedup, substring_dedup
from isobar.llm.components import components
from isobar.llm.exact_dedup import exact_dedup
from isobar.llm.heavy import heavy_keys
from tests.llm.conftest import prose


def by_id(df, *columns):
    return {row["doc_id"]: tuple(row[c] for c in columns) for row in df.collect()}


def test_exact_dedup_equals_brute_force(docs, corpus):
    groups = {}
    for i, text, *_ in corpus:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text or ""), []).append(i)
    want = {i: (min(g), len(g), i == min(g), hashlib.sha256(t.encode()).hexdigest()) for t, g in groups.items() for i in g}
    assert by_id(exact_dedup(docs), "keep_id", "group_size", "kept", "text_sha256") == want


@pytest.mark.parametrize("counters", [4, 1024])
def test_exact_dedup_of_a_hot_group_with_few_counters(spark, counters):
    rows = [(i, "hot" if i % 3 else f"t{i}") for i in range(600)]
    got = exact_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), counters=counters).collect()
    assert sum(r["kept"] for r in got) == 201 and {r["group_size"] for r in got} == {1, 400}
    assert all(r["keep_id"] == (1 if r["doc_id"] % 3 else r["doc_id"]) for r in got)


def test_heavy_keys_are_bounded_and_complete(spark):
    keys = [5] * 500 + list(range(1000, 1500))
    df = spark.createDataFrame([(k,) for k in keys], "k long").repartition(7)
    found = [r["key"] for r in heavy_keys(df, "k", 16).collect()]
    assert 5 in found and len(found) <= 16


def test_substring_dedup_equals_brute_force(docs, corpus):
    want = substring_dedup.brute_force([(i, t) for i, t, *_ in corpus])
    assert by_id(substring_dedup.removed_words(docs), "n_words", "n_removed", "kept_sha256") == want
    assert sum(v[1] for v in want.values()) > 5000  # the long copy and the passages


def test_cover_has_a_shift_for_any_two_positions():
    for i in range(7):
        for j in range(7):
            assert any((i + d) % 7 in substring_dedup.COVER and (j + d) % 7 in substring_dedup.COVER for d in range(7))


def test_near_dedup_equals_brute_force(spark, docs, corpus):
    want = near_dedup.brute_force([(i, t) for i, t, *_ in corpus])
    assert by_id(near_dedup.near_dedup(docs), "n_shingles", "component_id", "kept") == want
    rng, rows = random.Random(3), []
    for family in range(6):  # copies with few and many changes, so that chains form
        words = prose(200 + family, 150).split()
        for copy in range(25):
            changed = list(words)
            for _ in range(rng.randrange(6)):
                changed[rng.randrange(150)] = f"new{rng.randrange(10**6)}"
            rows.append((family * 100 + copy, " ".join(changed)))
    want = near_dedup.brute_force(rows)
    assert len({v[1] for v in want.values()}) > 6
    got = near_dedup.near_dedup(spark.createDataFrame(rows, "doc_id long, text string"))
    assert by_id(got, "n_shingles", "component_id", "kept") == want


def test_sketches_estimate_high_similarity():
    import numpy as np

    rng = np.random.default_rng(1)
    common = rng.integers(0, 2**64, 900, dtype=np.uint64)
    one, two = (np.unique(np.concatenate([common, rng.integers(0, 2**64, 50, dtype=np.uint64)])) for _ in range(2))
    far = np.unique(rng.integers(0, 2**64, 900, dtype=np.uint64))
    sampled = near_dedup.samples(np.concatenate([one, two, far]), np.array([0, len(one), len(one) + len(two), len(one) + len(two) + len(far)]))
    bits = [int(sum(int(x).bit_count() for x in row.view(np.uint64))) for row in (a ^ b for a, b in zip(near_dedup.odd_sketches(sampled)[:-1], near_dedup.odd_sketches(sampled)[1:]))]
    assert bits[0] <= near_dedup.Likeness().most_bits < bits[1]


def test_components_of_long_chains(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (103, 102), (102, 101)], "a long, b long")
    got = {r["node"]: r["label"] for r in components(links).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 104)}}


def test_line_dedup_equals_brute_force(spark, docs, corpus):
    want = line_dedup.brute_force([(i, t) for i, t, *_ in corpus])
    assert by_id(line_dedup.dedup_lines(docs), "n_lines", "n_removed", "kept_text") == want
    rng, rows = random.Random(4), []
    for i in range(60):  # variants of a few lines, so that similarities lie around 0.8
        lines = []
        for _ in range(5):
            words = prose(300 + rng.randrange(4), 12).replace("\n", " ").split()
            for _ in range(rng.randrange(4)):
                words[rng.randrange(len(words))] = f"v{rng.randrange(9)}"
            lines.append(" ".join(words))
        rows.append((i, "\n".join(lines)))
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), counters=64)
    assert by_id(got, "n_lines", "n_removed", "kept_text") == line_dedup.brute_force(rows)


def test_lines_match_in_any_letter_case(spark):
    rows = [(1, "Terms of Use Apply Here"), (2, "TERMS OF USE APPLY HERE\nother words"), (3, "terms of Use apply HERE"), (4, "a B c D e f g h i J"), (5, "A b C d E F G H I x")]
    want = {1: (0, rows[0][1]), 2: (1, "other words"), 3: (1, ""), 4: (0, rows[3][1]), 5: (1, "")}
    assert by_id(line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")), "n_removed", "kept_text") == want


def test_lines_of_a_dense_group_are_settled_wherever_their_edits_rank(spark, monkeypatch):
    rng, shared = random.Random(11), [f"w{k}" for k in range(70)]
    rows = [(i, " ".join(rng.sample(shared, 66) + [f"edit{i}x{k}" for k in range(rng.randrange(6))])) for i in range(300)]
    pairs, write = [], line_dedup.materialize

    def counted(df, name):
        table = write(df, name)
        pairs.extend([table.count()] * (name == "line_pairs"))
        return table

    monkeypatch.setattr(line_dedup, "materialize", counted)
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    assert by_id(got, "n_lines", "n_removed", "kept_text") == line_dedup.brute_force(rows)
    assert pairs[0] < 2000  # 4,010 when tokens were drawn by their place in the prefix, 448 now


def test_long_and_equally_rare_lines_equal_brute_force(spark):
    rng, rows = random.Random(9), []
    for i in range(40):  # all words are equally rare, lines are long, many share a third
        shared, own = [f"S{k}" for k in range(60)], [f"o{i % 8}x{k}" for k in range(120)]
        for _ in range(rng.choice([0, 5, 18, 25])):
            own[rng.randrange(120)] = f"n{i}y{rng.randrange(999)}"
        rows.append((i, " ".join(shared + own) + "\n" + " ".join(f"t{i % 5}z{k}" for k in range(i % 5 + 4))))
    rows += [(100, rows[0][1]), (100, rows[0][1]), (101, "\n".join(f"line {k % 3000} of many" for k in range(6000)))]
    distinct = dict(rows)
    got = line_dedup.dedup_lines(spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n long").repartition(3), counters=16)
    assert by_id(got, "n_lines", "n_removed", "kept_text") == line_dedup.brute_force(list(distinct.items()))


def test_parity_bitmaps_differ_in_no_more_bits_than_sets_in_tokens(spark):
    rng, rows = random.Random(5), []
    for k in range(200):
        one = [rng.randrange(2**61) for _ in range(1 + k)]
        rows.append((k, one, rng.sample(one, rng.randrange(k + 1)) + [rng.randrange(2**61) for _ in range(rng.randrange(9))]))
    pairs = spark.createDataFrame(rows, "k long, one array<long>, two array<long>")
    sides = pairs.select("k", *[F.struct(*line_dedup._parity(F.col(side))).alias(side) for side in ("one", "two")])
    bits = {r["k"]: r["bits"] for r in sides.select("k", line_dedup._differ("one", "two").alias("bits")).collect()}
    assert all(bits[k] <= len(set(one) ^ set(two)) and (bits[k] - len(set(one) ^ set(two))) % 2 == 0 for k, one, two in rows)


def test_copies_around_a_template_equal_brute_force(spark):
    rng, rows = random.Random(6), []
    template = [f"t{k}" for k in range(20)]
    for i in range(150):  # each changes a few words: some match the earliest, some only others
        words = list(template)
        for at in rng.sample(range(20), 3 if i == 0 else rng.randrange(4)):
            words[at] = f"x{rng.randrange(400)}"
        rows.append((i, " ".join(words) + f"\nown{i} line{i}"))
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    assert by_id(got, "n_lines", "n_removed", "kept_text") == line_dedup.brute_force(rows)


def test_odd_rows(odd_docs):
    exact = [(r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup(odd_docs).collect()]
    assert sorted(exact, key=str) == sorted([(2, 2, 1, True), (7, 7, 3, False), (7, 7, 3, True), (9, 9, 1, True), (9, 9, 1, True), (None, 7, 3, False)], key=str)
    near = sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in near_dedup.near_dedup(odd_docs).collect()), key=str)
    assert near == sorted([(2, 2, True), (7, 7, False), (7, 7, True), (9, 7, False), (9, 9, True), (None, 7, False)], key=str)
    cut = sorted(((r["doc_id"], r["n_words"], r["n_removed"]) for r in substring_dedup.removed_words(odd_docs).collect()), key=str)
    assert cut == sorted([(2, 0, 0), (7, 60, 0), (7, 60, 0), (9, 1, 0), (9, 61, 60), (None, 60, 60)], key=str)
    lines = [(r["doc_id"], r["n_lines"] - r["n_removed"]) for r in line_dedup.line_digests(odd_docs).collect()]
    kept = dict(lines)
    assert len(lines) == 6 and kept[None] == 0 and kept[2] == 1 and kept[7] > 0


def test_empty_tables(no_docs):
    for operator in (exact_dedup, near_dedup.near_dedup, substring_dedup.removed_words, line_dedup.line_digests):
        assert operator(no_docs).collect() == []


def thue_morse(n: int, first: str, other: str) -> str:
    out = first
    while len(out) < n:
        out += "".join(other if c == first else first for c in out)
    return out[:n]


@pytest.mark.parametrize("n", [64, 1024, 4096])
def test_words_that_collide_in_linear_hashes_stay_apart(spark, n):
    x, y = thue_morse(n, "a", "b"), thue_morse(n, "b", "a")
    start = " ".join(f"w{i}" for i in range(12))
    rows = [(1, f"{start} {x}"), (2, f"{start} {y}"), (3, x), (4, y), (5, x.upper()), (6, f"{start} {x} tail")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert by_id(substring_dedup.removed_words(df), "n_words", "n_removed", "kept_sha256") == substring_dedup.brute_force(rows)
    assert by_id(near_dedup.near_dedup(df), "n_shingles", "component_id", "kept") == near_dedup.brute_force(rows)
