"""Quality classifier by held-out labels, the pipeline stage by stage against brute force."""

import os
import random

import numpy as np
import pytest

import corpus_pipeline
from isobar.llm import line_dedup, near_dedup, quality
from isobar.llm.queries import ORACLE_SQL, QUERIES
from isobar.session import materialize
from tests.llm.conftest import DOCS_SCHEMA, prose
from tests.llm.test_secrets_and_leaks import brute_leaks

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def test_em_recovers_the_accuracy_of_labellers():
    rng = np.random.default_rng(3)
    junk = rng.random(20_000) < 0.2
    votes = np.zeros((len(junk), 5), dtype=np.int8)
    accuracy = [0.95, 0.9, 0.8, 0.7, 0.6]
    for k, right in enumerate(accuracy):
        said = np.where(rng.random(len(junk)) < right, junk, ~junk)
        votes[:, k] = np.where(rng.random(len(junk)) < 0.2, quality.ABSTAIN, np.where(said, quality.JUNK, quality.CLEAN))
    patterns, at, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    posterior, table = quality.expectation_maximisation(patterns, counts.astype(float))
    assert np.abs(table[:, 0, 0] - accuracy).max() < 0.05  # clean votes on clean documents
    assert ((posterior[at.ravel()] > 0.5) == junk).mean() > 0.95


@needs_tables
def test_quality_agrees_with_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = {r["doc_id"]: r["kept"] for r in quality.quality(spark.read.parquet(f"{sf}/documents.parquet")).collect()}
    right = [got[i] == bool(q) for i, q in labels.items()]
    assert sum(right) / len(right) > 0.98


def test_quality_of_odd_and_empty_tables(spark, odd_docs, no_docs):
    assert quality.quality(no_docs).collect() == []
    got = quality.quality(odd_docs).collect()
    assert len(got) == 6 and all(r["kept"] for r in got if r["doc_id"] == 2)


def test_every_query_with_sql_is_registered():
    assert set(ORACLE_SQL) <= set(QUERIES)
    assert [int(name[2:].split("_")[0]) for name in QUERIES] == list(range(1, 11))


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A small corpus with junk, copies, leaks, nulls and repeated rows, and a benchmark."""
    folder = str(tmp_path_factory.mktemp("tables"))
    rng, rows = random.Random(8), []
    items = [(j, prose(900 + j, 25).replace("\n", " ")) for j in range(5)]
    for i in range(160):
        text = prose(2000 + i % 120, 40 + i % 70, 4000)
        if i % 10 == 3:
            text = " ".join(w.upper() + "!!" for w in text.split())
        if i % 17 == 5:
            text += "\n" + items[i % 5][1]
        rows.append((i, text, "en", None if i % 9 == 0 else f"s{i % 4}", len(text)))
    rows += [rows[0], rows[0], (500, None, None, None, None), (501, "", "en", "s1", 0), (None, prose(1, 30), "en", "s1", 1)]
    rng.shuffle(rows)
    spark.createDataFrame(rows, DOCS_SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_stages_against_brute_force(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    names, before = docs.columns, docs.collect()
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, tables), name)
        after = docs.collect()
        unique = {r["doc_id"]: r["text"] for r in before if r["doc_id"] is not None}
        if name != "mixing":
            assert docs.columns == names
        if name == "quality":
            assert {r["doc_id"] for r in before if r["doc_id"] is not None and r["doc_id"] % 10 == 3 and r["doc_id"] < 160}.isdisjoint(r["doc_id"] for r in after)
            assert len(after) == len(before) - 16
        if name == "line_dedup":
            want = line_dedup.brute_force(list(unique.items()))
            assert len(after) == len(before)
            assert all(r["text"] == want[r["doc_id"]][2] and r["n_chars"] == len(r["text"]) for r in after if r["doc_id"] is not None and r["text"] is not None)
        if name == "near_dedup":
            want = near_dedup.brute_force(list(unique.items()), 80)
            kept = [r["doc_id"] for r in after if r["doc_id"] is not None and (r["text"] or "").strip()]
            assert sorted(kept) == sorted(i for i, (n, _, k) in want.items() if k and n)
        if name == "decontamination":
            items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{tables}/benchmark.parquet").collect()]
            leaking = {i for i, _ in brute_leaks(list(unique.items()), items)}
            assert leaking and len(after) == sum(r["doc_id"] not in leaking for r in before)
        if name == "mixing":
            assert all(r["taken"] == r["size"] * r["copies"] and r["copies"] in (1, 2) for r in after)
            assert {r["doc_id"] for r in after} <= {r["doc_id"] for r in before}
        before = after
    whole = corpus_pipeline.run(spark, tables).collect()
    assert sorted(map(str, whole)) == sorted(map(str, before))


def test_line_dedup_stage_folds_case(spark, tables):
    rows = [(1, "Terms of Use Apply Here", "en", "s", 23), (2, "TERMS OF USE APPLY HERE\nother words", "en", "s", 35)]
    got = corpus_pipeline.line_dedup_stage(spark, spark.createDataFrame(rows, DOCS_SCHEMA), tables).collect()
    assert {r["doc_id"]: (r["text"], r["n_chars"]) for r in got} == {1: ("Terms of Use Apply Here", 23), 2: ("other words", 11)}


def test_stages_of_odd_and_empty_tables(spark, tables, odd_docs, no_docs):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs, tables).collect() == [], name
    named = odd_docs.toDF("doc_id", "text", "rank", "size", "source")
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, named, tables)
        assert len(got.collect()) <= 6 and got.columns[:5] == named.columns, name


def test_mixing_stage_shuffles_the_documents_once(spark, tables):
    rows = [(i % 40, prose(i % 40, 30), "en", f"s{i % 3}" if i % 7 else None, i) for i in range(120)]
    got = corpus_pipeline.mixing_stage(spark, spark.createDataFrame(rows, DOCS_SCHEMA), tables)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in plan.split("\n") if "Exchange" in line and "nth#" in line]
    assert all(r["taken"] == r["size"] * r["copies"] > 0 for r in got.collect())


def test_choice_among_repeated_rows_does_not_depend_on_their_order(spark, tables):
    text = prose(5, 80)
    rows = [(1, text, "en", f"s{i}", i) for i in range(6)] + [(2, prose(6, 50), "en", "s1", 1)]
    found = set()
    for order in (rows, rows[::-1], rows[3:] + rows[:3]):
        df = spark.createDataFrame(order, DOCS_SCHEMA).repartition(3)
        near = corpus_pipeline.near_dedup_stage(spark, df, tables)
        found.add(str(sorted(near.collect())) + str(sorted(corpus_pipeline.mixing_stage(spark, df, tables).collect())))
    assert len(found) == 1 and "source='s0'" in found.pop()
