"""Secret scan and benchmark decontamination."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from isobar.llm import decontaminate, secret_scan
from tests.llm.conftest import prose

ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base_spans(text):
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in sorted(found))


SECRETS = [
    'é password="abcdefgh12" end',
    "password = token: abcdefghij",  # the first match fails and consumes `token`
    "token==abcdefgh APIKEY: 'x.y-z_12345' api_key=short",
    "AKIA1234567890AB AKIA123 AKIAAKIA1234567890",
    "x" * 5 + "0123456789abcdef" * 2 + "g " + "ab" * 15,
    "𝄞𝄞 secret:0123456789abcdef0123456789abcdef",
    "password=12345678" * 3,
    "",
    None,
    "passwd=" + "a" * 50_000,
]


def test_strong_spans_equal_brute_force(spark):
    rows = list(enumerate(SECRETS))
    got = {r["doc_id"]: r for r in secret_scan.secret_digests(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows:
        want = base_spans(text or "")
        assert got[i]["base_sha256"] == hashlib.sha256(want.encode()).hexdigest(), (i, want, got[i]["spans"])
        assert got[i]["n_assign"] + got[i]["n_access"] + got[i]["n_hex"] == (want.count(",") + 1 if want else 0)


def test_weak_parts_need_their_complements(spark):
    weak, far = "Zx9Kq2LmN8vB4tR6wY1p", "." * 400
    rows = [
        (1, f"nothing else {weak} here"),
        (2, f"user: alice key {weak} at https://db.example.net:5432/x"),
        (3, f"AKIA1234567890AB {weak}"),
        (4, f"user: alice {far} {weak}"),
        (5, "user: alice at https://db.example.net"),
        (6, "user: alice, password: abcdefgh99"),
        (7, f"{weak * 15} user: alice"),  # the gap counts, not how far apart the two begin
        (8, f"user: alice {weak * 15}"),
        (9, f"user: alice {'.' * 255}{weak}"),
        (10, f"user: alice {'.' * 256}{weak}"),
        (11, f"user: alice {weak * 200} user: bob"),
    ]
    got = {r["doc_id"]: [s.split(":")[0] for s in r["spans"].split(",") if s] for r in secret_scan.secret_digests(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: [], 2: ["weak_id", "weak_secret", "endpoint"], 3: ["access", "weak_secret"], 4: [], 5: [], 6: ["weak_id", "assign"]} | {
        7: ["weak_secret", "weak_id"], 8: ["weak_id", "weak_secret"], 9: ["weak_id", "weak_secret"], 10: [], 11: ["weak_id", "weak_secret", "weak_id"]
    }


def test_odd_and_empty_tables(spark, odd_docs, no_docs):
    assert secret_scan.secret_digests(odd_docs).count() == 6
    assert secret_scan.secret_digests(no_docs).collect() == []
    rows = spark.createDataFrame([(None, "token=abcdefgh1"), (4, "token=abcdefgh1"), (4, "token=abcdefgh1")], "doc_id long, text string")
    assert [r["n_assign"] for r in secret_scan.secret_digests(rows).collect()] == [1, 1, 1]


def brute_leaks(docs, items):
    """Best similarity of any item-sized window, by (document, item)."""

    def grams(text):
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
        return [tuple(w[p : p + 5]) for p in range(len(w) - 4)]

    out = {}
    for i, text in docs:
        g = grams(text)
        for j, item in items:
            h = grams(item)
            size = min(len(h), len(g))
            for start in range(len(g) - size + 1 if size else 0):
                window, rest = g[start : start + size], list(h)
                both = sum(1 for x in window if x in rest and not rest.remove(x))
                if 5 * both >= 4 * (len(h) + size - both):
                    out[i, j] = max(out.get((i, j), 0), both / (len(h) + size - both))
    return out


def test_leaks_equal_brute_force(spark):
    rng = random.Random(9)
    items = [(j, prose(500 + j, 12 + 7 * j).replace("\n", " ")) for j in range(8)] + [(90, "too few words"), (91, None), (92, "again " * 30)]
    docs = [(0, None), (1, ""), (2, items[2][1]), (3, "a a a a a a a " * 5), (4, "AGAIN " * 29)]
    for i in range(5, 40):
        words = prose(600 + i, 80).split()
        leak = items[rng.randrange(8)][1].split()
        for _ in range(rng.randrange(3)):
            leak[rng.randrange(len(leak))] = "changed"
        at = rng.randrange(60)
        docs.append((i, " ".join(words[:at] + leak + words[at:])))
    docs.append((40, " ".join(items[7][1].split()[:-3])))  # shorter than the item
    want = brute_leaks(docs, items)
    got = decontaminate.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in got.collect()}
    assert len(want) > 15 and min(want.values()) < 1
    assert got == want


def test_leaks_at_the_threshold_are_found_at_any_distance_of_fingerprints(spark):
    items, docs = [], []
    for i in range(300):  # the last but one of 22 words differs: 16 of 18 shingles, 16 / 20
        words = [f"i{i}w{k}" for k in range(22)]
        items.append((i, " ".join(words)))
        docs.append((i, " ".join([*words[:20], "changed", words[21]])))
    found = decontaminate.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((r["doc_id"], r["item_id"], r["similarity"]) for r in found) == [(i, i, 0.8) for i in range(300)]
    assert {r["found_by"] for r in found} == {"index", "shingles"} and all((r["distance"] <= decontaminate.RADIUS) == (r["found_by"] == "index") for r in found)


def test_ties_go_to_the_first_window_and_repetitive_texts_are_linear(spark):
    item = prose(11, 30)
    docs = [(1, prose(12, 40) + " " + item + " " + prose(13, 9) + " " + item), (2, "same " * 20_000), (3, "x y z " * 3_000)]
    items = [(1, item), (2, "same " * 1_500), (3, "x y z " * 40)]
    found = decontaminate.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((r["doc_id"], r["item_id"], r["similarity"], r["start"]) for r in found) == [(1, 1, 1.0, 40), (2, 2, 1.0, 0), (3, 3, 1.0, 0)]


def test_leaks_in_odd_and_empty_tables(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, prose(5, 60)), (1, prose(5, 60))], "item_id long, text string")
    assert sorted(str(r["doc_id"]) for r in decontaminate.leaks(odd_docs, items).collect()) == ["7", "9", "None"]
    assert decontaminate.leaks(no_docs, items).collect() == []
    assert decontaminate.leaks(odd_docs, items.limit(0)).collect() == []


def test_simhash_of_more_values_than_16_bits_count(spark):
    # arrays from columns: one of literals would be folded into the plan, value by value
    df = spark.range(140_000).selectExpr("collect_list(xxhash64(id % 50000)) AS few", "collect_list(id * 0 - 1) AS same", "collect_list(id * 0 + 1099511627776) AS none")
    row = df.select("few", *[decontaminate.simhash(F.col(c)).alias(f"{c}_print") for c in ("few", "same", "none")]).first()
    counts = [sum(x >> b & 1 for x in row["few"]) for b in range(64)]
    assert row["few_print"] & (1 << 64) - 1 == sum(1 << b for b in range(64) if counts[b] * 2 > 140_000)
    assert (row["same_print"], row["none_print"]) == (-1, 1 << 40)


def test_multi_index_finds_all_fingerprints_within_the_radius(spark):
    rng = random.Random(2)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    prints, queries = [rng.getrandbits(64) for _ in range(60)], []
    for i, one in enumerate(prints):
        for apart in (0, 1, decontaminate.RADIUS - 1, decontaminate.RADIUS, decontaminate.RADIUS + 1, 24):
            two = one
            for place in rng.sample(range(64), apart):
                two ^= 1 << place
            queries.append((len(queries), 3 + i % 2, signed(two)))
    items = spark.createDataFrame([(i, 3 + i % 2, signed(x)) for i, x in enumerate(prints)], "item_key long, m int, fingerprint long")
    got = decontaminate.indexed(spark.createDataFrame(queries, "id long, m int, print long"), items).select("id", "item_key").distinct().collect()
    want = {(q, i) for q, m, two in queries for i, one in enumerate(prints) if m == 3 + i % 2 and ((two ^ signed(one)) & (1 << 64) - 1).bit_count() <= decontaminate.RADIUS}
    assert {tuple(r) for r in got} == want and len(want) >= 240
