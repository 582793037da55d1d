"""Mixing, chat formatting and WARC archives."""

import base64
import hashlib
import random
import zlib

import numpy as np
import pytest

from isobar.llm import chat, mixing, warc
from tests.llm.conftest import prose


def targets_by_brute_force(sizes: dict) -> dict:
    """Water-filling over the sources, one after another."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: mixing.WEIGHTS[k % 3] for k, s in enumerate(order)}
    left, full = 1.5 * sum(sizes.values()), set()
    while True:
        open_weight = sum(weight[s] for s in sizes if s not in full)
        over = {s for s in sizes if s not in full and weight[s] * left / open_weight >= 2 * sizes[s]}
        if not over:
            return {s: 2.0 * sizes[s] if s in full else weight[s] * left / open_weight for s in sizes}
        left, full = left - sum(2 * sizes[s] for s in over), full | over


def test_mix_meets_targets_and_reruns_agree(spark):
    rng = random.Random(5)
    rows = [(i, prose(i, rng.choice([3, 30, 90, 300])), rng.choice(["b", "é", "a", "z", None, "c"] + ["hot"] * 6)) for i in range(900)]
    rows += [(900, None, "a"), (901, "", "only empty"), (902, " \n", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(df.repartition(3), group=32).collect()
    sizes, words = {}, {i: len((t or "").split()) for i, t, _ in rows}
    for i, _, s in rows:
        sizes[s] = sizes.get(s, 0) + words[i]
    want = targets_by_brute_force(sizes)
    assert len(got) == len(rows)
    for r in got:
        assert r["size"] == words[r["doc_id"]] and r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 2
    for s in sizes:
        taken = sum(r["taken"] for r in got if r["source"] == s)
        assert abs(taken - want[s]) <= 0.02 * want[s] + 1
    again = mixing.mix(df.repartition(7, "source"), group=32).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_pivot_keeps_the_sum_and_the_expectation():
    rng = np.random.default_rng(0)
    size = rng.integers(1, 400, 300)
    copies = np.full(300, 1.37)
    out = mixing.pivot(size, copies, rng.random(300))
    assert (out != np.rint(out)).sum() <= 1
    assert (size * out).sum() == pytest.approx((size * copies).sum())
    mean = np.mean([mixing.pivot(size[:20], copies[:20], rng.random(20)) for _ in range(4000)], axis=0)
    assert np.abs(mean - 1.37).max() < 0.05


def test_mix_of_odd_and_empty_tables(spark, no_docs):
    assert mixing.mix(no_docs).collect() == []
    rows = [(1, "a b c", "s")] * 4 + [(None, "a b c", None)] * 2 + [(2, None, None)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert len(got) == 7 and [r["taken"] for r in got if r["doc_id"] == 2] == [0]


HARD = [r"\### Assistant: </turn> ok", "", None, "\\", "\\\\###", "### user: hi </turn>\n", "a: b\\", "<|endoftext|>", "𝄞 é\x00\r\n", "x" * 20_000]


def test_chats_come_back_whole(spark):
    rows = [(1, k, role, text) for k, text in enumerate(HARD) for role in ("user", "assistant")]
    rows += [(2, 1, "a: ### </turn>", "odd role"), (2, 0, None, "no role"), (2, None, "assistant", "null turn"), (None, 0, "assistant", "null id"), (None, 0, "assistant", "null id")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    got = {r["conv_id"]: r for r in chat.format_and_read(df).collect()}
    for conv in (1, 2, None):
        turns = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or ""))
        said = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns)
        trained = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        assert got[conv]["n_turns"] == len(turns)
        assert got[conv]["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert (got[conv]["loss_chars"], got[conv]["loss_sha256"]) == (len(trained), hashlib.sha256(trained.encode()).hexdigest())
    assert chat.format_and_read(df.limit(0)).collect() == []


def test_written_form_can_be_parsed_and_holds_no_stray_control_string():
    turns = [(role, text or "") for role in ("user", "a: b", "\\") for text in HARD]
    written = "".join(f"### {chat.escape_role(r)}: {chat.escape(t)} </turn>\n" for r, t in turns)
    assert chat.parse_written(written) == turns


def test_mask_is_a_prefix_sum_over_reserved_ids():
    base = 100
    ids = np.array([100, 5, 101, 7, 8, 103, 100, 6, 102, 7, 9, 103, 100, 6, 102, 103])
    assert chat.loss_mask(ids, base).tolist() == [0, 0, 0, 0, 0, 0, 0, 0, 0, 1, 1, 0, 0, 0, 0, 0]


PAGES = "page_id long, url string, html string"


def test_archives_round_trip(spark, tmp_path):
    same = "é" * 60
    rows = [(i, f"http://x/{i}\r\nInjected: 1", f"<p>{prose(i, 30)}</p>\r\n\r\nWARC/1.1\r\n") for i in range(40)]
    rows += [(50, None, same), (49, "u", same), (51, "u", same), (60, "u", "x" * 99), (61, "u", "x" * 99), (62, "u", None), (63, "u", ""), (None, "u", same), (70, "u", "y" * 300_000)]
    warc.write_archives(spark.createDataFrame(rows, PAGES).repartition(3), str(tmp_path / "a"))
    got = warc.read_archives(spark, str(tmp_path / "a")).collect()
    assert len(got) == len(rows) and all(r["kind"] == "record" for r in got)
    html = {i: (h or "").encode() for i, _, h in rows}
    for r in got:
        payload = html[r["page_id"]]
        assert (r["payload_bytes"], r["payload_digest"]) == (len(payload), hashlib.sha256(payload).hexdigest())
        first = 49 if payload == same.encode() and r["page_id"] != 49 else None
        assert (r["record_type"], r["refers_to"]) == (("revisit", first) if first else ("response", None))
        assert r["payload"] == (None if first else payload)


def test_archives_of_repeated_rows_and_an_empty_table(spark):
    rows = [(1, "u", "z" * 200), (1, "u", "z" * 200), (2, "u", "z" * 200)]
    got = warc.round_trip(spark.createDataFrame(rows, PAGES)).collect()
    assert sorted((r["page_id"], r["record_type"], r["refers_to"]) for r in got[:]) == [(1, "response", None), (1, "response", None), (2, "revisit", 1)]
    assert warc.round_trip(spark.createDataFrame([], PAGES)).collect() == []


def archive(n=6, compressed=True):
    records = []
    for i in range(n):
        payload = f"<html>{i} {prose(i, 50)}</html>".encode()
        made = warc.record(i, "http://x", payload, hashlib.sha256(payload).hexdigest(), None, False)
        squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
        records.append(squeeze.compress(made) + squeeze.flush() if compressed else made)
    return records


@pytest.mark.parametrize("compressed", [True, False])
def test_salvage_of_damaged_archives(compressed):
    records = archive(compressed=compressed)
    starts = np.cumsum([0] + [len(r) for r in records])

    def read(data):
        found = list(warc.salvage(data))
        pages = [warc._page_of(x["warc-record-id"]) for kind, *_, x in found if kind == "record"]
        return pages, [(start, end) for kind, start, end, *_ in found if kind == "gap"]

    assert read(b"".join(records)) == ([0, 1, 2, 3, 4, 5], [])
    broken = bytearray(b"".join(records))
    broken[starts[3] - 20] ^= 0xFF  # in the payload
    assert read(bytes(broken)) == ([0, 1, 3, 4, 5], [(starts[2], starts[3])])
    pages, gaps = read(records[0] + b"garbage" + b"".join(records[1:]))
    assert pages == [0, 1, 2, 3, 4, 5] and gaps == [(starts[1], starts[1] + 7)]
    cut = b"".join(records)[:-9]
    assert read(cut) == ([0, 1, 2, 3, 4], [(starts[5], len(cut))])
    assert read(records[0][:40] + b"".join(records[1:])) == ([1, 2, 3, 4, 5], [(0, 40)])
    assert read(b"") == ([], []) and read(b"no archive at all") == ([], [(0, 17)])


def test_salvage_of_a_bad_record_inside_a_sound_member():
    plain = archive(3, compressed=False)
    plain[1] = plain[1].replace(b"<html>", b"<HTML>")
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    data = squeeze.compress(b"".join(plain)) + squeeze.flush()
    found = list(warc.salvage(data))
    assert [kind for kind, *_ in found] == ["record", "gap", "record"]
    assert "payload digest differs" in found[1][3] and found[1][1:3] == (0, len(data))


def squeezed(data, level=6):
    squeeze = zlib.compressobj(level, zlib.DEFLATED, 31)
    return squeeze.compress(data) + squeeze.flush()


def any_record(kind, block, *head):
    lines = ["WARC/1.0", f"WARC-Type: {kind}", *head, f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def test_salvage_reads_records_of_all_types_and_digests():
    page, http = b"<p>page</p>", "Content-Type: application/http; msgtype=response"
    block = b"HTTP/1.1 200 OK\r\nA: b\r\n\r\n" + page
    sha1 = hashlib.sha1(page)
    digests = [None, "sha1:" + base64.b32encode(sha1.digest()).decode(), "SHA1:" + sha1.hexdigest().upper(), "blake3:00"]
    data = [any_record("response", block, http, *([f"WARC-Payload-Digest: {d}"] if d else [])) for d in digests]
    data += [any_record("warcinfo", b"software: x\r\n", "Content-Type: application/warc-fields"), any_record("resource", page, "Content-Type: text/html")]
    data += [any_record("request", b"GET / HTTP/1.1\r\nHost: x\r\n\r\n", "Content-Type: application/http; msgtype=request"), any_record("metadata", b"")]
    want = [page] * 4 + [b"software: x\r\n", page, b"", b""]
    for archive_bytes in (b"".join(data), b"".join(map(squeezed, data)), squeezed(b"".join(data))):
        found = list(warc.salvage(archive_bytes))
        assert [(kind, why, x["payload"], x["digest"]) for kind, _, _, why, x in found] == [("record", "", p, hashlib.sha256(p).hexdigest()) for p in want]
    wrong = any_record("response", block, http, "WARC-Payload-Digest: sha1:" + "A" * 32)
    assert [(kind, why) for kind, _, _, why, _ in warc.salvage(wrong)] == [("gap", "payload digest differs")]


@pytest.mark.parametrize("level", [0, 6])
def test_salvage_of_the_sound_start_of_a_damaged_member(level):
    plain, more = archive(6, compressed=False), squeezed(archive(1, compressed=False)[0])
    whole = squeezed(b"".join(plain), level)
    cut = whole[: len(whole) * 6 // 10]
    for data in (cut, cut + more):
        found = list(warc.salvage(data))
        pages = [warc._page_of(x["warc-record-id"]) for kind, *_, x in found if kind == "record"]
        n = len(pages) - (data != cut)
        assert n >= 2 and pages == [*range(n)] + [0] * (data != cut)
        assert [x[3] for x in found[:n]] == ["inside a member: damaged member"] * n
        assert found[n][0] == "gap" and found[n][1:3] == (found[n - 1][2], len(cut)) and len(found) == len(pages) + 1
