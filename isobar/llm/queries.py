"""Registered queries of the training-data operators and the SQL of those that have one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from isobar.llm.chat import format_and_read
from isobar.llm.common import table
from isobar.llm.decontaminate import leaks
from isobar.llm.divergence import divergence
from isobar.llm.exact_dedup import exact_dedup
from isobar.llm.line_dedup import line_digests
from isobar.llm.mixing import mix
from isobar.llm.near_dedup import near_dedup
from isobar.llm.quality import quality
from isobar.llm.repair import damage_and_repair
from isobar.llm.secret_scan import secret_digests
from isobar.llm.substring_dedup import removed_words
from isobar.llm.warc import round_trip
from isobar.llm.wrapper import main_texts


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"))


def op2_secret_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digests(table(spark, sf_dir, "documents"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_digests(table(spark, sf_dir, "documents"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removed_words(table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    hard = r"\### Assistant: </turn> ok"  # a conversation full of control strings
    extra = [(-7, 0, "user", hard), (-7, 1, "assistant", hard)]
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return format_and_read(turns.unionByName(spark.createDataFrame(extra, "conv_id long, turn long, role string, text string")))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "pages"))


def op10_minhash_odd_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(table(spark, sf_dir, "documents"))


def op11_wrapper(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(table(spark, sf_dir, "pages"))


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return damage_and_repair(table(spark, sf_dir, "conversations"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_secret_linking": op2_secret_linking,
    "op3_line_dedup": op3_line_dedup,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_decontamination": op5_decontamination,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_mixing": op7_mixing,
    "op8_chat": op8_chat,
    "op9_warc": op9_warc,
    "op10_minhash_odd_sketch": op10_minhash_odd_sketch,
    "op11_wrapper": op11_wrapper,
    "op12_repair": op12_repair,
    "op13_divergence": op13_divergence,
}

# The oracle's own patterns, in the order in which kinds are listed, and what counts.
_SECRET_RULES = [
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", "length(v) >= 8"),
    ("access", r"(AKIA)([A-Z0-9]+)", "length(m) >= 16"),
    ("hex", r"()([0-9a-f]+)", "length(m) >= 32"),
    ("weak_id", r"""(?i:(client_?id|user_?name|user|login|account))["']?\x20*[:=]\x20*["']?([A-Za-z0-9@_.-]{3,})""", "true"),
    ("weak_secret", r"()([A-Za-z0-9+/]{20,})", "regexp_matches(m, '[0-9]') AND regexp_matches(m, '[a-z]') AND regexp_matches(m, '[A-Z]')"),
    ("endpoint", r"(https?://)([A-Za-z0-9.:/_-]+)", "true"),
]


def _secrets_sql() -> str:
    def matches(place: int, kind: str, pattern: str, good: str) -> str:
        quoted = "'" + pattern.replace("'", "''") + "'"
        return f"""
            SELECT doc_id, {place} AS place, '{kind}' AS kind, m, p, {good} AS good,
                   sum(length(gap) + length(m)) OVER (PARTITION BY doc_id ORDER BY p) AS e
            FROM (SELECT doc_id, unnest(ms) AS m, unnest(vs) AS v, unnest(gaps[:len(ms)]) AS gap, generate_subscripts(ms, 1) AS p
                  FROM (SELECT doc_id, regexp_extract_all(t, {quoted}, 0) AS ms, regexp_extract_all(t, {quoted}, 2) AS vs,
                               string_split_regex(t, {quoted}) AS gaps FROM d))"""

    def near(parts: str) -> str:
        return f"EXISTS (SELECT 1 FROM f o WHERE o.doc_id = f.doc_id AND o.kind IN ({parts}) AND f.s - o.e <= 256 AND o.s - f.e <= 256)"

    identifier, secret = "'access', 'weak_id'", "'assign', 'hex', 'weak_secret'"
    return f"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
        a AS ({" UNION ALL ".join(matches(i, *r) for i, r in enumerate(_SECRET_RULES, 1))}),
        g AS (SELECT doc_id, place, kind, CAST(e - length(m) AS BIGINT) AS s, CAST(e AS BIGINT) AS e FROM a WHERE good),
        f AS (SELECT * FROM g WHERE place <= 3 OR NOT EXISTS (
            SELECT 1 FROM g o WHERE o.doc_id = g.doc_id AND o.place <= 3 AND o.s <= g.s AND o.e > g.s)),
        r AS (SELECT *, kind || ':' || s || ':' || e AS span FROM f
              WHERE place <= 3 OR kind = 'weak_id' AND {near(secret)} OR kind = 'weak_secret' AND {near(identifier)}
                 OR kind = 'endpoint' AND {near(identifier)} AND {near(secret)})
        SELECT d.doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
               count(*) FILTER (kind = 'hex') AS n_hex,
               sha256(coalesce(string_agg(span, ',' ORDER BY s, place) FILTER (place <= 3), '')) AS base_sha256,
               coalesce(string_agg(span, ',' ORDER BY s, place), '') AS spans
        FROM d LEFT JOIN r USING (doc_id) GROUP BY d.doc_id
    """


ORACLE_SQL = {
    "op2_secret_linking": _secrets_sql(),
    "op3_line_dedup": r"""
        WITH l AS (
            SELECT doc_id, unnest(a) AS line, generate_subscripts(a, 1) AS i
            FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS a FROM documents)
        ),
        t AS (
            SELECT doc_id, i, line, list_sort(list_distinct(list_filter(string_split_regex(lower(line), '[\x20\x09-\x0D]+'), lambda x: x <> ''))) AS w FROM l
        ),
        c AS (
            SELECT w, len(w) AS n, first, row_number() OVER (ORDER BY first) AS id
            FROM (SELECT w, min({'doc_id': doc_id, 'i': i}) AS first FROM t WHERE len(w) > 0 GROUP BY w)
        ),
        e AS (SELECT id, n, unnest(w) AS g FROM c),
        f AS (SELECT g, count(*) AS k FROM e GROUP BY g),
        o AS (SELECT id, n, g, row_number() OVER (PARTITION BY id ORDER BY k, g) AS r FROM e JOIN f USING (g)),
        p AS (SELECT id, n, g FROM o WHERE r <= n - (4 * n + 4) // 5 + 1),
        q AS (SELECT DISTINCT a.id AS late, b.id AS early FROM p a JOIN p b USING (g) WHERE b.id < a.id AND 5 * b.n >= 4 * a.n AND 5 * a.n >= 4 * b.n),
        x AS (SELECT DISTINCT late FROM q JOIN c a ON a.id = late JOIN c b ON b.id = early
              WHERE 9 * len(list_intersect(a.w, b.w)) >= 4 * (a.n + b.n)),
        k AS (SELECT first.doc_id AS doc_id, first.i AS i FROM c WHERE id NOT IN (SELECT late FROM x)),
        z AS (SELECT t.doc_id, t.i, line, len(w) = 0 OR k.i IS NOT NULL AS kept FROM t LEFT JOIN k ON k.doc_id = t.doc_id AND k.i = t.i)
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (NOT kept) AS n_removed,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (kept), '')) AS kept_sha256
        FROM z GROUP BY doc_id
    """,
    "op4_substring_dedup": r"""
        WITH d AS (
            SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
        ),
        s AS (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS p FROM d WHERE len(w) >= 13),
        g AS (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY array_to_string(w[p:p + 12], ' ')) < doc_id AS cut FROM s),
        c AS (SELECT DISTINCT doc_id, unnest(range(p, p + 13)) AS q FROM g WHERE cut),
        l AS (SELECT doc_id, list(q) AS gone FROM c GROUP BY doc_id)
        SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
               sha256(coalesce(array_to_string([w[i] FOR i IN range(1, len(w) + 1) IF gone IS NULL OR NOT list_contains(gone, i)], ' '), '')) AS kept_sha256
        FROM d LEFT JOIN l USING (doc_id)
    """,
    # By the exact similarity alone: fingerprints must not lose any of these.
    "op5_decontamination": r"""
        WITH d AS (SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
        b AS (SELECT item_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM benchmark),
        s AS (SELECT doc_id, len(w) - 4 AS n, p, array_to_string(w[p + 1:p + 5], ' ') AS g
              FROM (SELECT *, unnest(range(len(w) - 4)) AS p FROM d WHERE len(w) >= 5)),
        i AS (SELECT item_id, len(w) - 4 AS m, array_to_string(w[p + 1:p + 5], ' ') AS g
              FROM (SELECT *, unnest(range(len(w) - 4)) AS p FROM b WHERE len(w) >= 5)),
        c AS (SELECT item_id, m, g, count(*) AS k FROM i GROUP BY ALL),
        h AS (SELECT doc_id, n, p, item_id, m, c.g, k, least(m, n) AS size FROM s JOIN c USING (g)),
        z AS (SELECT DISTINCT doc_id, item_id, m, size, unnest(range(greatest(0, p - size + 1), least(p, n - size) + 1)) AS start FROM h),
        o AS (SELECT z.doc_id, z.item_id, z.m, z.size, z.start, h.g, least(h.k, count(*)) AS k
              FROM z JOIN h ON h.doc_id = z.doc_id AND h.item_id = z.item_id AND h.p BETWEEN z.start AND z.start + z.size - 1
              GROUP BY z.doc_id, z.item_id, z.m, z.size, z.start, h.g, h.k),
        t AS (SELECT doc_id, item_id, m, size, start, sum(k) AS k FROM o GROUP BY ALL),
        a AS (SELECT *, CAST(k AS DOUBLE) / (m + size - k) AS similarity FROM t WHERE 5 * k >= 4 * (m + size - k))
        SELECT doc_id, item_id, similarity, CAST(start AS BIGINT) AS start, CAST(size + 4 AS BIGINT) AS n_words
        FROM a QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start) = 1
    """,
    "op6_exact_dedup": r"""
        WITH t AS (
            SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS s FROM documents
        )
        SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = min(doc_id) OVER g AS kept, s AS text_sha256
        FROM t WINDOW g AS (PARTITION BY s)
    """,
    "op8_chat": r"""
        WITH c AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS t FROM conversations
            UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
            UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
        ),
        e AS (
            SELECT *, length(replace(replace(replace(t, '\', '\\'), '###', '\###'), '</turn>', '\</turn>')) AS text_chars,
                   length(replace(replace(replace(replace(role, '\', '\\'), '###', '\###'), '</turn>', '\</turn>'), ':', '\:')) AS role_chars
            FROM c
        )
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || t || chr(10), '' ORDER BY turn, role)) AS turns_sha256,
               CAST(sum(CASE WHEN role = 'assistant' THEN length(t) ELSE 0 END) AS BIGINT) AS loss_chars,
               sha256(string_agg(CASE WHEN role = 'assistant' THEN t ELSE '' END, '' ORDER BY turn, role)) AS loss_sha256,
               CAST(sum(length('### ') + role_chars + length(': ') + text_chars + length(' </turn>') + 1) AS BIGINT) AS formatted_chars
        FROM e GROUP BY conv_id
    """,
    "op9_warc": """
        WITH t AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
        h AS (SELECT page_id, octet_length(b) AS n, sha256(b) AS s FROM t),
        w AS (SELECT *, min(page_id) OVER (PARTITION BY s) AS first FROM h)
        SELECT page_id, n AS payload_bytes, s AS payload_digest,
               CASE WHEN n >= 100 AND first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN n >= 100 AND first < page_id THEN first END AS refers_to
        FROM w
    """,
    "op10_minhash_odd_sketch": r"""
        WITH RECURSIVE d AS (
            SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
        ),
        p AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0),
        s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g FROM p),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        b AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y USING (g) WHERE x.doc_id <> y.doc_id GROUP BY ALL),
        l AS (
            SELECT a, b FROM b JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)
        ),
        r AS (SELECT doc_id, doc_id AS c FROM d UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.c),
        m AS (SELECT doc_id, min(c) AS component_id FROM r GROUP BY doc_id)
        SELECT m.doc_id, coalesce(n, 0) AS n_shingles, component_id, m.doc_id = component_id AS kept FROM m LEFT JOIN n USING (doc_id)
    """,
    # By the markup of the given pages alone: one article element, paragraphs, two references.
    "op11_wrapper": r"""
        WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '<article>((?s:.*?))</article>', 1) AS t FROM pages),
        b AS (SELECT page_id, url, regexp_replace(regexp_replace(t, '</?(p|h1)>|<br>', ' ', 'g'), '</?b>', '', 'g') AS t FROM a),
        c AS (SELECT page_id, url, regexp_replace(regexp_replace(t, '&quot;?', '"', 'g'), '&amp;?', '&', 'g') AS t FROM b),
        d AS (SELECT page_id, url, trim(regexp_replace(t, '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS text FROM c)
        SELECT page_id, url, text, length(text) AS n_chars FROM d
    """,
    # One step of the recursion: inserts before a row, then what happens to the row.
    "op12_repair": r"""
        WITH RECURSIVE r AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                                    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
        h AS (SELECT *, xor(list_reduce(list_prepend(4294967295::UBIGINT, [CAST(ascii(c) AS UBIGINT) FOR c IN string_split(k, '')]),
                  lambda x, b: list_reduce([xor(x, b), 1, 1, 1, 1, 1, 1, 1, 1], lambda y, i: xor(y >> 1, 3988292384::UBIGINT * (y & 1)))),
                  4294967295::UBIGINT) % 20 AS kind FROM r),
        m AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                     CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                     unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM h),
        n AS (SELECT *, row_number() OVER w AS i, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again,
                     lag(role[1]) OVER w || role[1] AS steps
              FROM m WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)),
        f AS (SELECT *, role[1] AS first, CASE WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 'blank' WHEN again THEN 'duplicate'
                     WHEN NOT regexp_matches(text, '[.!?][ 	-
]*$') THEN 'truncated' ELSE '' END AS fault FROM n),
        z AS (SELECT conv_id, count(*) AS n,
                     coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
                     count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
                     count(*) FILTER (steps NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id),
        e AS (SELECT * FROM (VALUES (0, 0, '', ''), (0, 2, 'I', 'u'), (0, 3, 'II', 'ua'), (1, 1, '', ''), (1, 2, 'I', 'u'), (1, 3, 'II', 'ua'),
                                    (2, 2, '', ''), (2, 3, 'I', 'a'), (3, 3, '', ''), (3, 2, 'I', 'u')) AS e(q, p, letters, said)),
        t AS (SELECT * FROM (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)) AS t(q, c, p)),
        x AS (SELECT conv_id, i, q0.q, 'D' AS letter, 4 AS cost, q0.q AS p, [] AS said FROM f, (SELECT DISTINCT q FROM e) q0
              UNION ALL SELECT conv_id, i, q, 'K', CASE fault WHEN 'truncated' THEN 3 ELSE 0 END, p, [role || ':' || text]
              FROM f JOIN t ON c = first WHERE fault IN ('', 'truncated')
              UNION ALL SELECT conv_id, i, q, 'R', CASE fault WHEN 'truncated' THEN 6 ELSE 3 END, p, [CASE c WHEN 'u' THEN 'user:' ELSE 'assistant:' END || text]
              FROM f, t WHERE fault IN ('', 'truncated') AND c <> 's'),
        s AS (SELECT conv_id, 0 AS i, 0 AS q, {'cost': 0, 'audit': '', 'said': []::VARCHAR[]} AS best FROM z
              UNION ALL
              SELECT s.conv_id, x.i, x.p, min({'cost': best.cost + 3 * len(e.letters) + x.cost, 'audit': best.audit || e.letters || x.letter,
                  'said': best.said || [CASE c WHEN 'u' THEN 'user:' ELSE 'assistant:' END FOR c IN string_split(e.said, '') IF c <> ''] || x.said})
              FROM s JOIN e ON e.q = s.q JOIN x ON x.conv_id IS NOT DISTINCT FROM s.conv_id AND x.i = s.i + 1 AND x.q = e.p
              GROUP BY s.conv_id, x.i, x.p),
        o AS (SELECT z.conv_id, min({'cost': best.cost + 3 * len(e.letters), 'audit': best.audit || e.letters,
                  'said': best.said || [CASE c WHEN 'u' THEN 'user:' ELSE 'assistant:' END FOR c IN string_split(e.said, '') IF c <> '']}) AS best
              FROM z JOIN s ON s.conv_id IS NOT DISTINCT FROM z.conv_id AND s.i = z.n JOIN e ON e.q = s.q AND e.p IN (0, 3) GROUP BY z.conv_id)
        SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
               coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(best.cost, 0) AS BIGINT) AS cost,
               coalesce(best.audit, '') AS audit, sha256(coalesce(array_to_string(best.said, chr(10)), '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN z ON z.conv_id IS NOT DISTINCT FROM c.conv_id
        LEFT JOIN o ON o.conv_id IS NOT DISTINCT FROM c.conv_id
    """,
    "op13_divergence": r"""
        WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
        w AS (SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
        k AS (SELECT lang, term FROM w GROUP BY ALL HAVING count(DISTINCT r) >= 10),
        g AS (SELECT DISTINCT lang, source FROM d),
        c AS (SELECT lang, source, term, count(*) AS c FROM w JOIN k USING (lang, term) GROUP BY ALL),
        v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
        x AS (SELECT g.lang, g.source, k.term, CAST(coalesce(c.c, 0) AS HUGEINT) AS c
              FROM g JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
        p AS (SELECT lang, source, term, c, 1 + (1000000000 * (c + 2)) // (sum(c) OVER (PARTITION BY lang, source) + 2 * v) AS p FROM x JOIN v USING (lang)),
        a AS (SELECT lang, term, sum(c) AS c FROM p GROUP BY ALL),
        q AS (SELECT lang, term, 1 + (1000000000 * (c + 2)) // (sum(c) OVER (PARTITION BY lang) + 2 * v) AS q FROM a JOIN v USING (lang)),
        s AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS f
              FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
        o AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f, 0) AS value
              FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
              LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
              UNION ALL
              SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM p JOIN q USING (lang, term) WHERE c > 0 AND p > q)
        SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
               CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INT) AS rank
        FROM o QUALIFY part = 'pair' OR rank <= 10
    """,
}
