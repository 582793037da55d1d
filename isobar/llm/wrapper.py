"""Main text of web pages by wrapper induction.

Pages of a host come from the same templates. Their DOM trees, with runs of like siblings
folded, are aligned by simple tree matching and merged, a host's trees in a reduction tree,
into one template per host. A node whose text is the same on most pages is template, a node
whose text varies is a slot; how much of a slot is links tells menus from content. What the
markup itself declares (regions, roles, class names) is read besides. Statistics come from
all pages of a host; pages with the same longest block count as one, so that copies of an
article don't make it a template.
"""

from __future__ import annotations

import hashlib
import json
import math
import re
from functools import reduce
from html.parser import HTMLParser
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isobar.llm.common import materialize, pick

#: A text is constant if so many of a host's distinct pages have it at one node, and at least
#: so many; within a declared article, where licence lines recur, the second pair holds.
CONSTANT, CONSTANT_PAGES = 0.5, 3
CONSTANT_IN_ARTICLE, CONSTANT_PAGES_IN_ARTICLE = 0.9, 10
#: A slot outside an article is a menu if so much of its text is links.
MENU = 0.8
#: Children of a node beyond which all of one label are folded, and levels beyond which
#: nodes belong to their ancestor's; bounds of the alignment, texts are kept anyway.
WIDE, DEEP = 100, 100
#: Trees that one step of the reduction merges, as bits.
FAN_BITS = 5
#: Rows with trees that are Python objects at a time, and characters of trees in a batch.
ROWS, BATCH_CHARS = 64, 1 << 20
#: Hosts with more than one of so many pages are salted; there are no more than this.
SHARES = 1024

# Elements and names by which markup declares what isn't the article.
_BLOCKS = set(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select "
    "summary table tbody td textarea tfoot th thead title tr ul".split()
)
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_NEVER = set("applet button canvas datalist embed head iframe input math noframes noscript object script select style svg template textarea title".split())
_BESIDE = set("aside dialog footer form menu nav search".split())
_ROLES = set("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
_NAMES = set(
    "ad ads advert adverts advertisement advertisements advertising adsense sponsor sponsored promo promotion promoted banner banners nav navbar navigation menu "
    "menus breadcrumb breadcrumbs masthead footer sidebar sidebars aside rail widget widgets cookie cookies consent gdpr notice notices notification alert popup modal "
    "overlay newsletter subscribe subscription signup login social share sharing comment comments commentlist disqus discussion reply replies respond related recommended "
    "recommendations teaser teasers pagination pager toolbar skip copyright".split()
)
_ARTICLES = set("article articlebody post postbody postcontent entry entrycontent story storybody maincontent content".split())
_CLOSES_P = _BLOCKS - {"button", "caption", "legend", "option", "optgroup", "tbody", "td", "tfoot", "th", "thead", "tr", "body", "html", "head", "title"}
_CLOSES = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
           "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "body": ({"head"}, set())}

_SPACES = re.compile(r"[\x20\x09-\x0D]+")
_WORDS = re.compile(r"[^a-z]+")
_PAGE = "host string, skeleton string, page_key long, nodes array<struct<node: int, text: long, chars: int, links: int>>"


class Node:
    """A node of a page's tree or of a template: label, children and, by place in the
    folded tree, what is known of its own texts."""

    __slots__ = ("label", "kids", "at", "pages", "chars", "links", "texts")

    def __init__(self, label: str, kids: list | None = None, at: int = 0):
        self.label, self.kids, self.at = label, kids if kids is not None else [], at
        self.pages = self.chars = self.links = 0
        self.texts: dict[str, int] = {}

    def pack(self) -> list:
        return [self.label, self.pages, self.chars, self.links, self.texts, [k.pack() for k in self.kids]]

    @staticmethod
    def unpack(packed: list) -> Node:
        node = Node(packed[0], [Node.unpack(k) for k in packed[5]])
        node.pages, node.chars, node.links, node.texts = packed[1:5]
        return node

    def walk(self):
        yield self
        for kid in self.kids:
            yield from kid.walk()


class Block:
    """A run of text between block boundaries, with its node and what its markup says."""

    __slots__ = ("node", "text", "links", "level", "drops")

    def __init__(self, node, text, links, level, drops):
        self.node, self.text, self.links, self.level, self.drops = node, text, links, level, drops


def _names(attrs: dict) -> list[list[str]]:
    """The words of each class and id."""
    return [[w for w in _WORDS.split(name) if w] for name in f"{attrs.get('class') or ''} {attrs.get('id') or ''}".lower().split()]


def _declares_beside(tag: str, attrs: dict, names: list[list[str]]) -> bool:
    if tag in _BESIDE or tag in _NEVER or (attrs.get("role") or "").lower() in _ROLES or "hidden" in attrs:
        return True
    if "display:none" in _SPACES.sub("", (attrs.get("style") or "").lower()):
        return True
    if tag in ("html", "body", "article", "main"):
        return tag == "article" and any(w in ("comment", "comments", "teaser", "related", "promo", "ad") for name in names for w in name)
    return any(name[0] not in ("has", "with", "no", "is") and any(w in _NAMES for w in name) for name in names if name)


def _level(tag: str, attrs: dict, names: list[list[str]]) -> int:
    """How plainly an element says that it holds the article: 0 not, 1 by name, 2, 3."""
    if tag == "article" or (attrs.get("itemprop") or "").lower() == "articlebody":
        return 3
    if tag == "main" or (attrs.get("role") or "").lower() == "main":
        return 2
    return int(tag in ("div", "section", "td") and any("".join(name) in _ARTICLES for name in names))


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#")
        # open elements: tag, node, whether a link, article level, levels at which it is beside
        self.open = [("#", self.root, False, 0, ())]
        self.blocks: list[Block] = []
        self.text: list[tuple[str, bool]] = []

    def flush(self):
        if not self.text:
            return
        text = _SPACES.sub(" ", "".join(t for t, _ in self.text)).strip(" ")
        if text:
            links = sum(len(t) for t, link in self.text if link)
            _, node, _, level, drops = self.open[-1]
            self.blocks.append(Block(node, text, min(links, len(text)), level, drops))
        self.text = []

    def close_to(self, depth: int):
        self.flush()
        del self.open[depth:]

    def handle_starttag(self, tag, attrs):
        if tag in ("br", "wbr"):
            self.text += [(" ", False)] if tag == "br" else []
            return
        block = tag in _BLOCKS or tag in _NEVER
        if block:
            self.flush()
        if tag in _CLOSES or tag in _CLOSES_P:
            ends, within = _CLOSES.get(tag, ((), ()))
            for depth in range(len(self.open) - 1, 0, -1):
                above = self.open[depth][0]
                if above in ends:
                    self.close_to(depth)
                elif above == "p" and tag in _CLOSES_P:
                    self.close_to(depth)
                    if not ends:
                        break
                elif above in within or above in ("button", "td", "th", "table", "caption"):
                    break
                elif not ends and above in _BLOCKS:
                    break
        if tag in _VOID:
            return
        attrs = dict(attrs)
        names = _names(attrs)
        _, node, link, level, drops = self.open[-1]
        if tag == "header" and level < 2:
            beside = True
        elif level < 2 and any(name == ["header"] for name in names):
            beside = tag not in ("html", "body", "article", "main")
        else:
            beside = _declares_beside(tag, attrs, names)
        own = _level(tag, attrs, names)
        if beside and own < 2:
            own = 0
        # what an element inside a plainer one says counts only within that one
        drops = (*drops, 4 if tag in _NEVER else max(level, own if tag == "article" else 0)) if beside else drops
        if block and len(self.open) < DEEP:
            label = ".".join([tag, *sorted({"-".join(n) for n in names if n})])
            kid = Node(label)
            node.kids.append(kid)
            node = kid
        self.open.append((tag, node, link or tag == "a", max(level, own), drops))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID and tag in ("script", "style"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        for depth in range(len(self.open) - 1, 0, -1):
            if self.open[depth][0] == tag:
                if tag in _BLOCKS or tag in _NEVER or any(t in _BLOCKS for t, *_ in self.open[depth:]):
                    self.close_to(depth)
                else:
                    del self.open[depth:]
                return

    def handle_data(self, data):
        _, _, link, _, drops = self.open[-1]
        if 4 not in drops:  # scripts, forms' fields and the like have no text
            self.text.append((data, link))


def _folded(group: list[Node], out: list[Node]) -> Node:
    """One node for like siblings: runs of children with one label become one child."""
    node = Node(group[0].label, at=len(out))
    out.append(node)
    for member in group:
        member.at = node.at
    runs: list[list[Node]] = []
    for kid in (k for member in group for k in member.kids):
        if runs and runs[-1][0].label == kid.label:
            runs[-1].append(kid)
        else:
            runs.append([kid])
    if len(runs) > WIDE:
        by_label: dict[str, list[Node]] = {}
        for run in runs:
            by_label.setdefault(run[0].label, []).extend(run)
        runs = list(by_label.values())
    node.kids = [_folded(run, out) for run in runs]
    return node


def parse(html: str) -> tuple[Node, list[Block]]:
    """The folded tree of a page and its text blocks, whose ``node.at`` is a place there."""
    builder = _Builder()
    builder.feed(html)
    builder.close()
    builder.flush()
    return _folded([builder.root], []), builder.blocks


# ---- simple tree matching


def _score(a: Node, b: Node, memo: dict) -> int:
    """Nodes in the largest order-preserving match of two trees (0 if the labels differ)."""
    if a.label != b.label:
        return 0
    if not a.kids or not b.kids:
        return 1
    key = (id(a), id(b))
    if key not in memo:
        memo[key] = 1 + _best(*_alike(a.kids, b.kids), memo)[-1][-1]
    return memo[key]


def _alike(a: list[Node], b: list[Node]) -> tuple[list[Node], list[Node]]:
    """The nodes of either list whose label the other has: only these can match, however
    many others a template holds."""
    both = {x.label for x in a} & {y.label for y in b}
    return [x for x in a if x.label in both], [y for y in b if y.label in both]


def _best(a: list[Node], b: list[Node], memo: dict) -> list[list[int]]:
    """Nodes in the largest order-preserving match of each prefix of ``a`` and of ``b``."""
    table = [[0] * (len(b) + 1)]
    for x in a:
        before, row, label, most = table[-1], [0], x.label, 0
        for j, y in enumerate(b):
            most = max(before[j + 1], most, before[j] + _score(x, y, memo)) if y.label == label else max(before[j + 1], most)
            row.append(most)
        table.append(row)
    return table


def aligned(a: list[Node], b: list[Node], memo: dict) -> list[tuple[Node | None, Node | None]]:
    """Children in common order, matched ones as pairs."""
    some_a, some_b = _alike(a, b)
    table, places_a, places_b = _best(some_a, some_b, memo), set(map(id, some_a)), set(map(id, some_b))
    # i and j count the nodes that are left, r and c those of them that the table has
    out, i, j, r, c = [], len(a), len(b), len(some_a), len(some_b)
    while i or j:
        in_a, in_b = bool(i) and id(a[i - 1]) in places_a, bool(j) and id(b[j - 1]) in places_b
        score = _score(a[i - 1], b[j - 1], memo) if in_a and in_b else 0
        if score and table[r][c] == table[r - 1][c - 1] + score:
            i, j, r, c = i - 1, j - 1, r - 1, c - 1
            out.append((a[i], b[j]))
        elif j and table[r][c] == table[r][c - in_b]:
            j, c = j - 1, c - in_b
            out.append((None, b[j]))
        else:
            i, r = i - 1, r - in_a
            out.append((a[i], None))
    return out[::-1]


def merged(a: Node, b: Node, memo: dict | None = None) -> Node:
    """Two trees with like roots as one: matched nodes add up, others stand side by side."""
    memo = {} if memo is None else memo
    node = Node(a.label)
    node.pages, node.chars, node.links = a.pages + b.pages, a.chars + b.chars, a.links + b.links
    node.texts = {t: a.texts.get(t, 0) + b.texts.get(t, 0) for t in sorted(a.texts.keys() | b.texts.keys())}
    for x, y in aligned(a.kids, b.kids, memo):
        kid = merged(x, y, memo) if x is not None and y is not None else x if x is not None else y
        if node.kids and node.kids[-1].label == kid.label:
            node.kids[-1] = merged(node.kids[-1], kid)
        else:
            node.kids.append(kid)
    return node


def matches(page: Node, template: Node) -> dict[int, Node]:
    """The template's node for each place of a page's folded tree that has one."""
    out, memo, todo = {}, {}, [(page, template)]
    while todo:
        a, b = todo.pop()
        out[a.at] = b
        todo += [(x, y) for x, y in aligned(a.kids, b.kids, memo) if x is not None and y is not None]
    return out


# ---- what is template and what is content


def text_hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def main_text(html: str, template: Node | None, keys: int) -> str:
    """The page's blocks that its host's template leaves as content, joined by a space."""
    tree, blocks = parse(html)
    known = matches(tree, template) if template is not None else {}

    def constant(block: Block, level: int) -> bool:
        node = known.get(block.node.at)
        n = node.texts.get(str(text_hash(block.text)), 0) if node is not None else 0
        share, least = (CONSTANT_IN_ARTICLE, CONSTANT_PAGES_IN_ARTICLE) if level >= 2 else (CONSTANT, CONSTANT_PAGES)
        return n >= least and n >= share * keys

    def menu(block: Block) -> bool:
        node = known.get(block.node.at)
        if node is not None and node.pages >= CONSTANT_PAGES and node.chars:
            return node.links >= MENU * node.chars
        return block.links == len(block.text)

    # The plainest declaration that holds any text; what stands beside it outside is no matter.
    for level in (3, 2, 1, 0):
        inside = [b for b in blocks if b.level >= level and not any(d >= level for d in b.drops)]
        inside = [b for b in inside if not constant(b, level) and not (level < 2 and menu(b))]
        if inside:
            return " ".join(b.text for b in inside)
    return ""


# ---- Spark


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[^:/?#]+://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def _observe(batches):
    """Per page its folded tree, the hash of its longest block, and the blocks by place."""
    for batch in batches:
        hosts, skeletons, keys, nodes = [], [], [], []
        for host, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            tree, blocks = parse(html)
            packed = lambda n: [n.label, [packed(k) for k in n.kids]]  # noqa: B023, E731
            hosts.append(host)
            skeletons.append(json.dumps(packed(tree), ensure_ascii=False, separators=(",", ":")))
            keys.append(text_hash(max((b.text for b in blocks), key=lambda t: (len(t), t), default="")))
            nodes.append([{"node": b.node.at, "text": text_hash(b.text), "chars": len(b.text), "links": b.links} for b in blocks])
        kind = pa.list_(pa.struct([("node", pa.int32()), ("text", pa.int64()), ("chars", pa.int32()), ("links", pa.int32())]))
        columns = [pa.array(hosts, pa.string()), pa.array(skeletons, pa.string()), pa.array(keys, pa.int64()), pa.array(nodes, kind)]
        yield pa.RecordBatch.from_arrays(columns, ["host", "skeleton", "page_key", "nodes"])


def _packed(trees):
    """(host, at, tree) as batches of few trees: a template has all nodes of its host's pages."""
    rows, chars = [], 0

    def batch():
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.string()), strict=True)], ["host", "at", "tree"])

    for host, at, tree in trees:
        rows.append((host, at, json.dumps(tree.pack(), ensure_ascii=False, separators=(",", ":"))))
        chars += len(rows[-1][2])
        if chars >= BATCH_CHARS:
            yield batch()
            rows, chars = [], 0
    if rows:
        yield batch()


def _rows(batches):
    """The rows of the batches, a few of which are Python objects at a time."""
    for batch in batches:
        for i in range(0, batch.num_rows, ROWS):
            yield from batch.slice(i, ROWS).to_pylist()


def _seeds(batches):
    """The tree of each distinct skeleton of a host, with the statistics of its nodes."""

    def seed(row) -> Node:
        nodes: list[Node] = []

        def grown(packed):
            node = Node(packed[0])
            node.pages = row["pages"]
            nodes.append(node)
            node.kids = [grown(k) for k in packed[1]]
            return node

        root = grown(json.loads(row["skeleton"]))
        for s in row["sums"] or []:
            nodes[s["node"]].chars, nodes[s["node"]].links = s["chars"], s["links"]
        for t in row["texts"] or []:
            nodes[t["node"]].texts[str(t["text"])] = t["n"]
        return root

    yield from _packed((row["host"], row["at"], seed(row)) for row in _rows(batches))


def _merge_trees(batches):
    """Trees sorted by (host, group) -> one per group; two are held at a time."""

    def groups():
        for (host, group), rows in groupby(_rows(batches), lambda row: (row["host"], row["group"])):
            yield host, group, reduce(merged, (Node.unpack(json.loads(row["tree"])) for row in rows))

    yield from _packed(groups())


def templates(pages: DataFrame) -> DataFrame:
    """Per host of ``pages`` (host, html): pages, keys (its distinct pages) and tree."""
    seen = materialize(pages.select("host", "html").mapInArrow(_observe, _PAGE), "page_trees")
    seen = seen.withColumn("at", F.xxhash64("skeleton"))
    hosts = materialize(seen.groupBy("host").agg(F.count("*").alias("host_pages"), F.count_distinct("page_key").alias("keys")), "page_hosts")
    each = seen.select("host", "at", "page_key", F.explode("nodes").alias("x")).select("host", "at", "page_key", "x.*")
    sums = each.groupBy("host", "at", "node").agg(F.sum("chars").alias("chars"), F.sum("links").alias("links"))
    sums = sums.groupBy("host", "at").agg(F.sort_array(F.collect_list(F.struct("node", "chars", "links"))).alias("sums"))
    # Texts that may be constant: of one host, no more than 1 / CONSTANT times a page's blocks.
    shared = each.select("host", "text", "page_key").distinct().groupBy("host", "text").agg(F.count("*").alias("n"))
    shared = shared.where(F.col("n") >= CONSTANT_PAGES).join(hosts, "host").where(F.col("n") >= CONSTANT * F.col("keys")).select("host", "text")
    places = each.join(shared, ["host", "text"], "left_semi").select("host", "at", "node", "text", "page_key").distinct()
    places = places.groupBy("host", "at", "node", "text").agg(F.count("*").alias("n"))
    texts = places.groupBy("host", "at").agg(F.sort_array(F.collect_list(F.struct("node", "text", "n"))).alias("texts"))
    distinct = seen.groupBy("host", "at").agg(F.min("skeleton").alias("skeleton"), F.count("*").alias("pages"))
    rows = distinct.join(sums, ["host", "at"], "left").join(texts, ["host", "at"], "left")
    level = materialize(rows.mapInArrow(_seeds, "host string, at long, tree string"), "host_trees")
    most = level.groupBy("host").count().agg(F.max("count")).first()[0] or 0  # one number
    bits = max(0, math.ceil(math.log2(max(most, 1))) - FAN_BITS)
    while True:
        # a group has its bits of ``at`` in common; the merged tree keeps them, for the next step
        group = F.shiftleft(F.shiftrightunsigned("at", 64 - bits), 64 - bits) if bits else F.lit(0).cast("long")
        trees = level.select("host", group.alias("group"), "at", "tree").repartition("host", "group").sortWithinPartitions("host", "group", "at")
        level = materialize(trees.mapInArrow(_merge_trees, "host string, at long, tree string"), "host_trees")
        if not bits:
            return hosts.join(level.select("host", "tree"), "host")
        bits = max(0, bits - FAN_BITS)


def _extract(batches):
    """Pages sorted by (host, salt), before which comes their template's row."""
    template, keys = None, 0
    for batch in batches:
        for rows in (batch.slice(i, ROWS) for i in range(0, batch.num_rows, ROWS)):
            out = []
            for row in rows.to_pylist():
                if row["tree"] is not None:
                    template, keys = Node.unpack(json.loads(row["tree"])), row["keys"]
                else:
                    out.append((row["page_id"], row["url"], main_text(row["html"], template, keys)))
            if out:
                kinds = pa.int64(), pa.string(), pa.string()
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], ["page_id", "url", "text"])


def main_texts(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars.

    The text is the article: blocks of text in page order, white space inside as one space,
    character references decoded, joined by a space. Blocks are dropped that markup declares
    to be something else (menus, headers and footers of the page, sidebars, notices,
    adverts, forms, scripts, styles, comments of readers), that are constant over the host's
    pages, or that fill a slot of links outside an article. A null html is empty, an empty
    page has the empty text; a page without markup is all text. A null url or one without a
    host belongs to the host ''. Repeated rows are pages of their own, an empty table gives
    no rows, other columns are ignored. A page must fit its task, whatever its length."""
    pages = pick(pages, page_id="page_id", url="url", html="html")
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", host_of(F.col("url")).alias("host"), F.coalesce("html", F.lit("")).alias("html"))
    found = materialize(templates(pages), "templates")
    # Few hosts hold more than 1 / SHARES of the pages, SHARES at most. They are cut by salt.
    total = found.agg(F.sum("host_pages")).first()[0] or 0
    salts = F.ceil(F.col("host_pages") * SHARES / max(total, 1)).cast("int")
    large = found.where(F.col("host_pages") * SHARES > total).select("host", salts.alias("salts"))
    dealt = pages.join(F.broadcast(large), "host", "left").withColumn("salt", F.pmod(F.xxhash64("page_id", "html"), F.coalesce("salts", F.lit(1))).cast("int"))
    copies = found.select("host", "tree", "keys", F.explode(F.sequence(F.lit(0), F.when(F.col("host_pages") * SHARES > total, salts).otherwise(1) - 1)).alias("salt"))
    # A template goes before its pages, not beside each of them: its size has no bound.
    read = dealt.drop("salts").unionByName(copies, allowMissingColumns=True)
    read = read.repartition("host", "salt").sortWithinPartitions("host", "salt", F.col("tree").isNull())
    texts = read.select("page_id", "url", "html", "tree", "keys").mapInArrow(_extract, "page_id long, url string, text string")
    return texts.withColumn("n_chars", F.length("text").cast("long"))
