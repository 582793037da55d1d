import random

import pytest

DOCS_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, words: int, vocabulary: int = 400) -> str:
    """Reproducible invented prose, a line break now and then."""
    rng = random.Random(seed)
    made = [f"w{rng.randrange(vocabulary)}{'.' if rng.random() < 0.14 else ''}" for _ in range(words)]
    return "".join(w + ("\n" if rng.random() < 0.05 else " ") for w in made).strip()


def small_corpus() -> list[tuple]:
    """Documents with exact and near copies, shared passages, repeated lines, empty, null
    and very long texts, odd white space, and null sources; ids are distinct."""
    base = [prose(i, 20 + 13 * (i % 9)) for i in range(24)]
    passage = prose(1000, 40)
    texts = [
        *base,
        base[3],
        base[3].replace(" ", "  \t"),
        base[8] + " one more word",
        base[8].upper(),
        "start " + passage + " end",
        prose(51, 30) + "\n" + passage,
        passage + " " + passage,
        None,
        "",
        " \t\n ",
        "one two three",
        "one two three",
        "ONE two\rthree",
        "été où\x0bça",
        prose(77, 6000),
        prose(77, 6000) + " tail",
        "same line here\nsame line here\nsame line HERE",
    ]
    return [(i * 3 + 1, t, "en", None if i % 7 == 0 else f"src{i % 3}", len(t or "")) for i, t in enumerate(texts)]


@pytest.fixture(scope="session")
def corpus():
    return small_corpus()


@pytest.fixture(scope="session")
def docs(spark, corpus):
    return spark.createDataFrame(corpus, DOCS_SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS_SCHEMA)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Repeated rows, a null id, two texts with one id, clashing and repeated column names."""
    text = prose(5, 60)
    rows = [(7, text, "a", 1, 1), (7, text, "b", 2, 2), (None, text, "c", 3, 3), (2, None, "d", 4, 4), (9, "x", "e", 5, 5), (9, text + " y", "f", 6, 6)]
    return spark.createDataFrame(rows, "c0 long, c1 string, c2 string, c3 int, c4 int").toDF("doc_id", "text", "rank", "kept", "kept")
