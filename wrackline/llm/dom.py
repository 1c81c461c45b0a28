"""Main body of raw HTML pages by wrapper induction on their DOM trees.

Method: of each host one page a url is taken, all of them. On how many urls each
text node (its path of tags and its text) stands is counted; the page with most
of the nodes that stand on at least ``CONSTANT_SHARE`` of the urls is the host's
centre. Its DOM tree is aligned with each other page by simple tree matching:
the roots' tags must agree, and the children are aligned in their order so that
the number of equal text nodes is greatest. Text nodes of the centre that agree
with at least ``CONSTANT_SHARE`` of all other pages are constant; pruned to these
and the elements above them, its tree is the host's template, all other places
are slots. Every page of the host is then aligned with this template: text nodes
that match it are boilerplate, those in slots are the body. A constant node that
the centre lacks is no part of the template.

Counts and votes are summed over all pages, in parts; what a host gathers is
bounded by a page: at most ``1/CONSTANT_SHARE`` times the mean number of nodes,
and a vote for each node of the centre. Centres and templates are joined with
the pages by host (broadcast while small, hot hosts split by Spark).

Defined results: a null or empty page has a null body; pages of a host with
fewer than two other distinct urls have no template and keep all their text
(``aligned`` false); repeated rows are treated each and count as one url;
elements nested deeper than ``MAX_DEPTH``, and rows of children of more than
``MAX_PAIRS`` pairs, are compared as wholes.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wrackline.session import staged

#: Share of a host's other pages that a constant node agrees with.
CONSTANT_SHARE = 0.5
MAX_DEPTH, MAX_PAIRS = 200, 1_000_000

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_SILENT = frozenset(("script", "style", "noscript", "template", "head"))
_INLINE = frozenset("a abbr b bdi bdo big cite code em font i kbd mark q s small span strong sub sup tt u var".split())
_TEXT = "#"


class Node:
    """An element (``text`` None) or a text node."""

    __slots__ = ("tag", "text", "children", "form")

    def __init__(self, tag: str, text: str | None = None, children: list[Node] | None = None):
        self.tag, self.text, self.children, self.form = tag, text, children if children is not None else [], 0

    def seal(self) -> Node:
        """Compute forms: equal for equal trees."""
        todo, order = [self], []
        while todo:
            node = todo.pop()
            order.append(node)
            todo += node.children
        for node in reversed(order):
            node.form = hash((node.tag, node.text, tuple(c.form for c in node.children)))
        return self

    def texts(self) -> Iterator[Node]:
        todo = [self]
        while todo:
            node = todo.pop()
            if node.text is not None:
                yield node
            todo += reversed(node.children)


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("html")
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        if tag in ("html", "body"):
            return
        node = Node(tag)
        self.open[-1].children.append(node)
        if tag not in _VOID:
            self.open.append(node)

    def handle_endtag(self, tag):
        at = next((k for k in range(len(self.open) - 1, 0, -1) if self.open[k].tag == tag), 0)
        if at:
            del self.open[at:]

    def handle_data(self, data):
        text = " ".join(data.split())
        if text and not any(n.tag in _SILENT for n in self.open):
            self.open[-1].children.append(Node(_TEXT, text))


def parse(page: str) -> Node:
    builder = _Builder()
    builder.feed(page)
    builder.close()
    return builder.root.seal()


def matched(a: Node, b: Node, depth: int = 0) -> tuple[float, list[Node]]:
    """(weight, text nodes of ``a`` that match) of the best alignment of two trees; elements alone weigh little."""
    if a.tag != b.tag or a.text != b.text:
        return 0.0, []
    if a.form == b.form:
        found = list(a.texts())
        return len(found) + 0.001, found
    left, right = a.children, b.children
    if not left or not right:
        return 0.001, []
    if depth >= MAX_DEPTH or len(left) * len(right) > MAX_PAIRS:
        return _wholes(left, right)
    score = [[0.0] * (len(right) + 1) for _ in range(len(left) + 1)]
    pairs: dict[tuple[int, int], list[Node]] = {}
    for i, x in enumerate(left):
        row, above = score[i + 1], score[i]
        for j, y in enumerate(right):
            best = above[j + 1] if above[j + 1] >= row[j] else row[j]
            if x.tag == y.tag:
                weight, found = matched(x, y, depth + 1)
                if weight and above[j] + weight > best:
                    best = above[j] + weight
                    pairs[i, j] = found
            row[j + 1] = best
    out: list[Node] = []
    i, j = len(left), len(right)
    while i and j:
        if (i - 1, j - 1) in pairs and score[i][j] > max(score[i - 1][j], score[i][j - 1]):
            out += pairs[i - 1, j - 1]
            i, j = i - 1, j - 1
        elif score[i - 1][j] >= score[i][j - 1]:
            i -= 1
        else:
            j -= 1
    return score[-1][-1] + 0.001, out


def _wholes(left: list[Node], right: list[Node]) -> tuple[float, list[Node]]:
    """Equal children in their order."""
    out, at = [], 0
    places: dict[int, list[int]] = {}
    for j, y in enumerate(right):
        places.setdefault(y.form, []).append(j)
    for x in left:
        to = next((j for j in places.get(x.form, ()) if j >= at), None)
        if to is not None:
            out += x.texts()
            at = to + 1
    return len(out) + 0.001, out


def places(page: str) -> list[int]:
    """A number for each different text node of a page, by its path of tags and its text."""
    out, todo = set(), [(parse(page), "")]
    while todo:
        node, path = todo.pop()
        if node.text is not None:
            out.add(int.from_bytes(blake2b(f"{path}\n{node.text}".encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True))
        todo += [(child, f"{path}/{node.tag}") for child in node.children]
    return sorted(out)


@lru_cache(maxsize=64)
def read_centre(page: str) -> tuple[Node, dict[int, int]]:
    """A page's tree, and the place of each of its text nodes among these."""
    root = parse(page)
    return root, {id(n): k for k, n in enumerate(root.texts())}


def agreed(centre: str, page: str) -> list[int]:
    """Places of the centre's text nodes that match a page."""
    root, at = read_centre(centre)
    return [at[id(n)] for n in matched(root, parse(page))[1]]


def template(centre: str, votes: dict[int, int], others: int) -> str:
    """The centre's tree as JSON, pruned to the text nodes that agree with enough of the other pages."""
    root, at = read_centre(centre)

    def pruned(node: Node, depth: int = 0):
        if node.text is not None:
            return [_TEXT, node.text] if votes.get(at[id(node)], 0) >= CONSTANT_SHARE * others else None
        kept = [c for c in (pruned(child, depth + 1) for child in node.children) if c] if depth < 2 * MAX_DEPTH else []
        return [node.tag, kept] if kept or not depth else None

    return json.dumps(pruned(root), ensure_ascii=False)


@lru_cache(maxsize=256)
def read_template(text: str) -> Node:
    def node(x) -> Node:
        return Node(_TEXT, x[1]) if x[0] == _TEXT else Node(x[0], None, [node(c) for c in x[1]])

    return node(json.loads(text)).seal()


def body(page: str, made: str | None) -> str:
    """The text of a page's slots, one line a block; a block with any text in a slot is kept whole."""
    root = parse(page)
    cut = {id(n) for n in matched(root, read_template(made))[1]} if made else set()
    lines: list[list[tuple[str, bool]]] = [[]]

    def walk(node: Node, depth: int) -> None:
        if node.text is not None:
            lines[-1].append((node.text, id(node) not in cut))
            return
        block = node.tag not in _INLINE
        if block:
            lines.append([])
        if depth < 4 * MAX_DEPTH:
            for child in node.children:
                walk(child, depth + 1)
        if block:
            lines.append([])

    walk(root, 0)
    return "\n".join(" ".join(text for text, _ in x) for x in lines if any(free for _, free in x))


def templates(pages: DataFrame) -> DataFrame:
    """(h, template) of each host of at least three urls, by all of them; ``pages`` has h, u and page."""

    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([places(t) for t in batch.column(2).to_pylist()], type=pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, found], names=["h", "u", "page", "x"])

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            votes = Counter((h, k) for h, page, centre in zip(*(c.to_pylist() for c in batch.columns)) for k in agreed(centre, page))
            yield pa.RecordBatch.from_arrays([pa.array([h for h, _ in votes], type=pa.int64()), pa.array([k for _, k in votes], type=pa.int32()), pa.array(list(votes.values()), type=pa.int64())], names=["h", "k", "v"])

    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [template(centre, {x["k"]: x["v"] for x in votes or []}, n - 1) for n, centre, votes in zip(*(c.to_pylist() for c in batch.columns[1:]))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, type=pa.string())], names=["h", "template"])

    one = pages.where("h IS NOT NULL AND u IS NOT NULL AND page <> ''").groupBy("h", "u").agg(F.min("page").alias("page"))
    urls = staged(one.mapInArrow(nodes, "h BIGINT, u BIGINT, page STRING, x ARRAY<BIGINT>"), "dom-pages")
    hosts = urls.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n >= 3")
    counted = urls.select("h", F.explode("x").alias("x")).groupBy("h", "x").agg(F.count(F.lit(1)).alias("c"))
    constant = counted.join(hosts, "h").where(F.col("c") >= CONSTANT_SHARE * F.col("n")).groupBy("h").agg(F.collect_list("x").alias("constant"))
    scored = urls.select("h", "u", "x").join(hosts, "h").join(constant, "h", "left").select("h", "n", "u", F.coalesce(F.size(F.array_intersect("x", "constant")), F.lit(0)).alias("s"))
    best = scored.groupBy("h", "n").agg(F.max(F.struct("s", "u"))["u"].alias("u"))
    centres = staged(urls.select("h", "u", "page").join(best, ["h", "u"]).select("h", "n", F.col("u").alias("at"), F.col("page").alias("centre")), "dom-centres")
    votes = urls.select("h", "u", "page").join(centres, "h").where("u <> at").select("h", "page", "centre").mapInArrow(vote, "h BIGINT, k INT, v BIGINT")
    summed = votes.groupBy("h", "k").agg(F.sum("v").alias("v")).groupBy("h").agg(F.collect_list(F.struct("k", "v")).alias("votes"))
    return centres.join(summed, "h", "left").select("h", "n", "centre", "votes").mapInArrow(prune, "h BIGINT, template STRING")


def page_bodies(df: DataFrame, key: str, host: str, url: str, page: str) -> DataFrame:
    """(key, aligned, body) of every row; ``page`` is HTML text."""
    pages = df.select(F.col(key), F.xxhash64(F.lower(F.col(host))).alias("h"), F.xxhash64(F.col(url)).alias("u"), F.col(page).cast("string").alias("page"), F.col(host).isNotNull().alias("_k"), F.col(url).isNotNull().alias("_l"))
    pages = pages.withColumns({"h": F.when(F.col("_k"), F.col("h")), "u": F.when(F.col("_l"), F.col("u"))}).drop("_k", "_l")
    made = staged(templates(pages), "dom-templates")
    schema = T.StructType([T.StructField(key, df.schema[key].dataType), T.StructField("aligned", T.BooleanType()), T.StructField("body", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, found = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            out = [body(t, f) if t else None for t, f in zip(texts, found)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([f is not None for f in found]), pa.array(out, type=pa.string())], names=schema.names)

    return pages.join(made, "h", "left").select(key, "page", "template").mapInArrow(run, schema)
