"""Wrapper induction, conversation repair and source divergence against brute force, and
odd inputs."""

import hashlib
import random

import pytest

from isobar.llm import divergence, repair, wrapper
from tests.llm.conftest import prose

# ---- op11


def page(i: int, article: str, host: str = "news.example.org", extra: str = "") -> tuple:
    menu = "".join(f'<td><a href="/{j}">section {j} {i % 3}</a></td>' for j in range(4))
    html = (
        f"<html><head><title>t{i}</title><style>p{{}}</style></head><body><table><tr>{menu}</tr></table>"
        f"<div>All times are local</div>{article}<div>Made by example &copy;</div>{extra}</body></html>"
    )
    return (i, f"https://{host}/p/{i}", html)


def story(i: int, n: int = 3) -> list[str]:
    return [" ".join(prose(900 + 10 * i + k, 12).split()) for k in range(n)]


def texts(spark, rows, schema="page_id long, url string, html string"):
    got = wrapper.main_texts(spark.createDataFrame(rows, schema).repartition(3)).collect()
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    return {r["page_id"]: r["text"] for r in got}


def test_constant_nodes_and_link_slots_of_plain_markup_are_template(spark):
    rows = [page(i, "<div><h2>Title</h2>" + "".join(f"<p>{p}</p>" for p in story(i, 2 + i % 3)) + "</div>") for i in range(12)]
    got = texts(spark, rows)
    # neither the menu (links), nor notices nor the headline that all pages share is content
    assert got == {i: " ".join(story(i, 2 + i % 3)) for i in range(12)}
    lone = texts(spark, [page(0, f"<p>{story(0)[0]}</p>")])  # a single page gives no evidence
    assert story(0)[0] in lone[0] and "All times are local" in lone[0] and "section" not in lone[0]


def test_copies_of_an_article_do_not_make_it_template(spark):
    body = "".join(f"<p>{p}</p>" for p in story(5))
    rows = [page(i, f"<div>{body}</div>") for i in range(30)] + [page(100 + i, f"<div><p>{story(i)[0]}</p></div>") for i in range(4)]
    got = texts(spark, rows)
    assert all(got[i] == " ".join(story(5)) for i in range(30)) and got[101] == story(1)[0]


def test_declared_regions_and_odd_pages(spark):
    article = (
        "<main><article class=x><header><h1>A &lt;title&gt;</h1></header><p>one<br>two <b>th</b>ree\n\t&eacute;<p>four<script>var a='</p>'</script>"
        "<aside>see also</aside><form>mail <input></form><ul><li>x<li>y</ul><section id=comments><p>first!</p></section><footer>by</footer></article>"
        "<article class='teaser'>other</article></main>"
    )
    long = "word " * 200_000
    rows = [
        (1, "http://a/", f"<body class='has-sidebar'><header>H</header><nav>n</nav>{article}<div class=cookie-notice>ok?</div></body>"),
        (2, None, None),
        (3, "no host", ""),
        (4, "http://b", "just  text"),
        (5, "http://c:80/x", f"<article><p>{long}</article>"),
        (6, "http://d", "<article></article><div class=entry-content>fallback</div><div>beside</div>"),
        (7, "http://e", "<div>" * 3000 + "deep" + "</div>" * 3000),
        (7, "http://e", "<div>" * 3000 + "deep" + "</div>" * 3000),
        (8, "http://f", "<b>unclosed <i>a < b &amp &notaref; <!-- gone -->end"),
        (None, "http://g", "<nav>only a menu</nav>"),
    ]
    got = texts(spark, [(*r, "x") for r in rows], "page_id long, url string, html string, text string")
    assert got[1] == "A <title> one two three é four x y" and got[2] == got[3] == "" and got[4] == "just text"
    assert got[5] == long.strip() and got[6] == "fallback" and got[7] == "deep" and got[None] == ""
    assert got[8] == "unclosed a < b & ¬aref; end"
    assert texts(spark, []) == {}


def random_tree(rng, depth=3):
    return wrapper.Node(rng.choice("ab") if depth < 3 else "#", [random_tree(rng, depth - 1) for _ in range(rng.randrange(4))] if depth else [])


def brute_score(a, b):
    if a.label != b.label:
        return 0

    def best(xs, ys):
        if not xs or not ys:
            return 0
        return max(best(xs[1:], ys), best(xs, ys[1:]), brute_score(xs[0], ys[0]) + best(xs[1:], ys[1:]))

    return 1 + best(a.kids, b.kids)


def test_simple_tree_matching_is_optimal_and_merging_loses_no_node():
    rng = random.Random(4)
    for _ in range(200):
        a, b = random_tree(rng), random_tree(rng)
        score = wrapper._score(a, b, {})
        assert score == brute_score(a, b)
        for places, tree in ((0, a), (1, b)):
            for i, node in enumerate(tree.walk()):
                node.at, node.pages = i, 1
        assert len(wrapper.matches(a, b)) == score
        both = wrapper.merged(a, b)
        assert sum(n.pages for n in both.walk()) == sum(1 for t in (a, b) for _ in t.walk())


def test_templates_of_many_structures_reduce_to_one_per_host(spark):
    rows = [(i, "http://h/", "<div>" + "".join(f"<{t}>x{i}</{t}>" for t in random.Random(i).choices(["p", "h2", "ul", "pre"], k=9)) + f"</div><div>same</div><p>{prose(i, 20)}</p>") for i in range(300)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = wrapper.templates(df.select(wrapper.host_of(df["url"]).alias("host"), "html")).collect()
    assert [(r["host"], r["host_pages"], r["keys"]) for r in found] == [("h", 300, 300)]
    assert all("same" not in t for t in texts(spark, rows).values())


def test_templates_of_thousands_of_nodes_lose_none_of_them(spark):
    name = lambda k: "".join("abcdefghij"[int(d)] for d in str(k))
    notices = "".join(f"<div class=x{name(k)}>" + "".join(f"<{t}>notice {k} {j}</{t}>" for j, t in enumerate(["p", "pre"] * 20)) + "</div>" for k in range(60))
    rows = [(i, "http://h/", f"<body>{notices}<div class=own>{story(i)[0]}</div></body>") for i in range(6)]
    assert sum(1 for _ in wrapper.parse(rows[0][2])[0].walk()) > 2_400
    assert texts(spark, rows) == {i: story(i)[0] for i in range(6)}
    # and beyond any number, if pages have few nodes each: a notice is on half of a host's pages
    rows = [(i, "http://h/", "<body>" + "".join(f"<div class=y{name(30 * i + k)}>own {i} {k}</div>" for k in range(30)) + (f"<div class=z>common</div>" if i % 2 else "") + "</body>") for i in range(100)]
    assert texts(spark, rows) == {i: " ".join(f"own {i} {k}" for k in range(30)) for i in range(100)}


def dense_alignment(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = max(table[i][j + 1], table[i + 1][j], table[i][j] + brute_score(x, y))
    out, i, j = [], len(a), len(b)
    while i or j:
        if i and j and brute_score(a[i - 1], b[j - 1]) and table[i][j] == table[i - 1][j - 1] + brute_score(a[i - 1], b[j - 1]):
            i, j = i - 1, j - 1
            out.append((a[i], b[j]))
        elif j and table[i][j] == table[i][j - 1]:
            j -= 1
            out.append((None, b[j]))
        else:
            i -= 1
            out.append((a[i], None))
    return out[::-1]


def test_alignment_among_nodes_that_can_not_match_is_the_dense_one():
    rng = random.Random(6)
    for _ in range(200):
        a, b = ([wrapper.Node(rng.choice(labels), random_tree(rng, 1).kids) for _ in range(rng.randrange(7))] for labels in ("abx", "aby"))
        assert wrapper.aligned(a, b, {}) == dense_alignment(a, b)


# ---- op12


def test_search_equals_brute_force():
    rng = random.Random(7)
    for _ in range(400):
        rows = [(rng.choice(["s", "u", "u", "a", "a", "x", " ", ""]), rng.choice(["", "", "blank", "duplicate", "truncated"])) for _ in range(rng.randrange(4))]
        if not any(first == "" for first, _ in rows):
            assert repair.cheapest(rows) == repair.brute_force(rows)
        assert repair.bounds(rows)[0][0] == repair.cheapest(rows)[0]


def test_long_conversations_are_proved_in_linear_time():
    rng = random.Random(8)
    rows = [("s", "")] + [("ua"[i % 2] if rng.random() < 0.9 else "s", rng.choice([""] * 9 + ["blank", "duplicate", "truncated"])) for i in range(20_000)]
    cost, audit = repair.cheapest(rows)
    said = "".join({"user": "u", "assistant": "a"}.get(r, "s") for r, _ in repair.repaired([({"u": "user", "a": "assistant"}.get(i, "system"), "x.") for i, _ in rows], audit))
    assert __import__("re").fullmatch(r"(s?(ua)+)?", said) and cost == repair.bounds(rows)[0][0]


def test_damage_and_diagnosis_of_small_conversations(spark):
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"said {t}.", "x") for t in range(40)]
    rows += [(None, None, None, None, "x"), (2, 5, "user", "a" * 400_000 + ".", "y"), (2, 5, "user", "a" * 400_000 + ".", "y"), (2, None, "assistant", "b?", "y")]
    rows += [(c, 0, "user", f"only {c}!", "z") for c in range(100, 160)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, audit string").repartition(4)
    got = {r["conv_id"]: r for r in repair.damage_and_repair(df).collect()}
    assert set(got) == {r[0] for r in rows}

    import zlib

    def after(conv):
        out = []
        for c, turn, role, text, _ in rows:
            if c == conv:
                kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
                role, text = role or " ", text or " "
                text = "" if kind == 1 else "".join(x for x in text if x not in ".!?") if kind == 2 else text
                out += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
        return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))

    for conv, row in got.items():
        kept = after(conv)
        said = [(r, t) for _, r, t in kept]
        cost, audit = repair.cheapest([(r[:1], f) for (r, _), f in zip(said, repair.faults(said), strict=True)])
        fixed = "\n".join(f"{r}:{t}" for r, t in repair.repaired(said, audit))
        assert (row["cost"], row["audit"], row["repaired_sha256"]) == (cost, audit, hashlib.sha256(fixed.encode()).hexdigest())
        turns = {t for t, _, _ in kept if t is not None}
        assert row["gaps"] == (max(turns) - min(turns) + 1 - len(turns) if turns else 0)
    lost = [c for c in got if not after(c)]
    assert lost and all(got[c]["audit"] == "" and got[c]["cost"] == 0 and got[c]["repaired_sha256"] == hashlib.sha256(b"").hexdigest() for c in lost)
    assert repair.damage_and_repair(df.limit(0)).collect() == []


# ---- op13


def sources(seed: int, n: int = 160) -> list[tuple]:
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lang = rng.choice(["en", "en", "de", None, "fr"])
        words = [rng.choice(["Été", "I'm", "x9y", "don\x00e", "ÀB"]) if rng.random() < 0.1 else f"w{'abcdefghij'[int(rng.random() ** 2 * 10)]}" for _ in range(rng.randrange(30))]
        out.append((lang, rng.choice(["s1", "s2", "S3", None, "ü"]) if lang != "fr" else "one", None if i % 17 == 0 else " ".join(words)))
    return out + [("it", "a", "rare words"), ("it", "b", None), ("en", "silent", "")]


@pytest.mark.parametrize(("block", "shards"), [(200_000, None), (3, 5)])
def test_divergence_equals_brute_force(spark, block, shards):
    rows = sources(1) + [("en", "s1", "wa " * 100_000)] + sources(1)[:20]
    df = spark.createDataFrame([(*r, 1) for r in rows], "lang string, source string, text string, rank int").repartition(6)
    got = sorted(tuple(r) for r in divergence.divergence(df, block_postings=block, shards=shards).collect())
    assert got == divergence.brute_force(rows) and {r[0] for r in got} == {"", "de", "en", "it"}
    assert ("it", "a", "pair", "b", 0, 1) in got
    assert divergence.divergence(df.limit(0)).collect() == []


def test_merge_holds_only_overlapping_pages():
    runs = [[(f"en\0t{i:04d}", f"s{r}", 1, 1) for i in range(r, 2000, 3)] for r in range(3)]
    pages = sorted((run[i][0], [list(c) for c in zip(*run[i : i + 50], strict=True)]) for run in runs for i in range(0, len(run), 50))
    read = []

    def told():
        for page in pages:
            read.append(page[0])
            yield page

    for i, (key, found, docs) in enumerate(divergence._merged(told())):
        assert key == f"en\0t{i:04d}" and found == {f"s{i % 3}": 1} and docs == 1
        assert len(read) <= 3 * (i // 150 + 1) + 1  # the three pages that overlap, and the next
    assert i == 1999


def test_index_task_holds_a_bounded_part_of_its_documents():
    import tracemalloc

    import pyarrow as pa

    strings, longs = pa.list_(pa.string()), pa.list_(pa.int64())
    page = pa.schema([("shard", pa.int32()), ("first", pa.string()), ("key", strings), ("source", strings), ("n", longs), ("docs", longs)])
    text = " ".join(["some words that are told again"] * 130)
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * 2000), pa.array(["a", "b"] * 1000), pa.array([text] * 2000)], ["lang", "source", "text"])
    index = divergence._index(4, divergence.BLOCK_POSTINGS, divergence.BLOCK_TERMS, page)
    tracemalloc.start()
    runs = list(index(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(sum(n) for r in runs for n in r.column(4).to_pylist()) == 2000 * 6 * 130
    assert peak < 24e6  # 57 MB when whole batches were converted and a million tokens counted at a time


def test_merge_of_many_overlapping_runs_holds_few_objects():
    import tracemalloc

    import pyarrow as pa

    strings, longs = pa.list_(pa.string()), pa.list_(pa.int64())
    row = pa.schema([("lang", pa.string()), ("term", pa.string()), ("sources", strings), ("counts", longs)])
    keys, ones = pa.array([f"en\0t{i:04d}" for i in range(1000)]), pa.array([1] * 1000)
    runs, batches = 300, []
    for i in range(0, runs, 10):
        lists = [pa.ListArray.from_arrays(pa.array(range(0, 10_001, 1000), pa.int32()), pa.concat_arrays(x)) for x in ([keys] * 10, [pa.array([f"s{r % 7}"] * 1000) for r in range(i, i + 10)], [ones] * 10, [ones] * 10)]
        batches.append(pa.RecordBatch.from_arrays([pa.array([0] * 10, pa.int32()), pa.array(["en\0t0000"] * 10), *lists], ["shard", "first", "key", "source", "n", "docs"]))
    tracemalloc.start()
    found = [r for b in divergence._merge(10, row)(iter(batches)) for r in b.select(["counts"]).slice(0, 1).to_pylist()]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [sum(r["counts"]) for r in found] == [runs]
    assert peak < 20e6  # 70 MB when the postings of all pages were objects


def test_summing_held_pages_changes_nothing():
    rng = random.Random(3)
    runs = [sorted((f"{lang}\0{'é' * (i % 2)}t{i}", f"s{s}", rng.randrange(9), 1) for lang in ("de", "en") for i in range(60) for s in range(4) if rng.random() < 0.4) for _ in range(20)]
    pages = sorted(((run[i][0], [list(c) for c in zip(*run[i : i + 17], strict=True)]) for run in runs for i in range(0, len(run), 17)), key=lambda page: page[0])
    whole = [(key, dict(found), docs) for key, found, docs in divergence._merged(pages, 10**9)]
    assert [key for key, *_ in whole] == sorted({p[0] for run in runs for p in run})
    assert sum(docs for *_, docs in whole) == sum(map(len, runs))
    for most in (1, 50, 400):
        assert [(key, dict(found), docs) for key, found, docs in divergence._merged(pages, most)] == whole


def test_scaled_is_exact_for_large_counts():
    import numpy as np

    for count, size in [(0, 2), (10**13, 3 * 10**13), (9 * 10**12, 9 * 10**12 + 5), (5, 7)]:
        assert divergence.scaled(np.array([count]), np.array([size]))[0] == 1 + 10**9 * (count + 2) // size
