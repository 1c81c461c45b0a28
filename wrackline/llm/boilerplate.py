"""Main body of web pages whose text mixes it with boilerplate.

Method: wrapper induction. The text of a capture is all that is left of its
page, so the tree of a page is rebuilt from it: page > lines > items (an item is
a menu entry, a sentence, or a text between separators). With trees this flat,
simple tree matching of two same-host pages matches equal nodes, so instead of
aligning pairs of pages each node is counted once per page of its host: a node
on a fair share of a host's pages is constant there, all other slots vary.

* A node that is constant on most pages of a host is in that host's own
  template if it stands before or after all varying slots of the page, as menus
  and footers do and the byline of a site's only author does not.
* Nodes that are constant on hosts of several domains (with the site's own name
  masked) make the wrapper, which also serves hosts with few pages.
* Varying slots are content, unless they hang below a template node: the entries
  below a constant heading that is mostly followed by link-like lines (a
  sidebar), and the path before the title in a breadcrumb.

The wrapper is broadcast if it has at most ``MAX_WRAPPER`` items (counted);
beyond that each host gets the wrapper's items that occur on it by a shuffled
join, as it always gets its own template.

Lines are cut, and items counted and looked up, for whole Arrow batches at once.

Defined results: texts are split at ``\\n``, lines numbered from 1; empty lines
are never boilerplate; null and empty texts give no rows; a page whose host and
url are null is matched with the wrapper but adds nothing to it; repeated
captures of a url count once.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wrackline.llm.counting import slices
from wrackline.llm.garbled import Restorer
from wrackline.session import staged

#: A node is constant on a host if it is on so many of its urls, and on such a share of them.
MIN_URLS, HOST_SHARE = 3, 0.05
#: It is in the wrapper if that holds on hosts of so many domains.
MIN_DOMAINS = 3
#: It is in the host's own template if it is on so many of its urls, and on such a share of them.
OWN_URLS, OWN_SHARE = 6, 0.6
#: A wrapper of up to this many items is broadcast.
MAX_WRAPPER = 100_000
#: A constant line heads a sidebar if so many of its occurrences are followed by a link-like line.
HEADING_SHARE = 0.5
#: Link-like lines have so many characters; entries and teasers of a sidebar at most so many.
LINK_CHARS, ENTRY_CHARS, TEASER_CHARS = (8, 130), 190, 420
#: An item that a page repeats so often is its subject, not its template.
MAX_REPEATS = 4

#: Stands for the site's own name in items.
_SITE = "\ue000"
_BLANK = r"\s\x0b\x1c-\x1f\x{85}\pZ"
_SPLIT = rf"[|·•»›>/;:!?。！？…©\[\](){{}}]+|\.(?:[{_BLANK}]|$)|[{_BLANK}]{{2,}}|[{_BLANK}][-–—][{_BLANK}]"
_GAP = r"[^\pL\x{E000} ]"
_LETTERS = re.compile(r"[^\W\d_]+").findall
_DATE = re.compile(r"\d{1,4}\s?[./-]\s?\d{1,2}\s?[./-]\s?\d{1,4}|\d{4}年|\d{1,2}\.? [^\W\d_]+ \d{4}")
_CRUMB = re.compile(r"\s(?:>|»|/|›)\s")
_BULLET = re.compile(r"^\s*(?:([-–*•·»])|(\d+)[.)])\s+")
_TERMINAL = re.compile(r"[.!?。！？:;][\"”»“«’')\]]*\s*$")
_MORE = re.compile(r"(?:>>|…|\[…\]|\.\.\.)\s*$")
_NAME_END = re.compile(r"[.!?。)”»“][\"”»“]?\s+[^\W\d_]+\.\s*$")

BODY, TEMPLATE, CRUMB, SIDEBAR, EMPTY = range(5)


def cut_lines(texts: list[str]) -> tuple[pa.Array, np.ndarray]:
    """(all lines, number of the text of each)."""
    split = pc.split_pattern(pa.array(texts, type=pa.large_string()), "\n")
    return split.flatten(), np.repeat(np.arange(len(texts)), np.diff(split.offsets.to_numpy()))


def cut_items(lines: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(normalised items of lower-case lines, number of the line of each): words of letters, parted by blanks."""
    split = pc.split_pattern_regex(lines, _SPLIT)
    items = pc.utf8_trim(split.flatten(), " ")
    odd = pc.match_substring_regex(items, rf"{_GAP}|  ")
    words = pc.replace_substring_regex(pc.replace_substring_regex(items.filter(odd), f"{_GAP}+", " "), " {2,}", " ")
    items = pc.replace_with_mask(items, odd, pc.utf8_trim(words, " "))
    owner = np.repeat(np.arange(len(lines)), np.diff(split.offsets.to_numpy()))
    full = pc.greater(pc.binary_length(items), 0)
    return items.filter(full), owner[full.to_numpy(zero_copy_only=False)]


def masked(text: str, site: str) -> str:
    """The text in lower case, with the site's name, where it is a word, masked."""
    low = text.lower()
    if not site or site not in low:
        return low
    parts = low.split(site)
    out = [parts[0]]
    for before, after in zip(parts, parts[1:]):
        inside = (before[-1:] or (site if len(out) > 1 else " "))[-1:].isalpha() or after[:1].isalpha()
        out += (site if inside else _SITE, after)
    return "".join(out)


def flat(text: str) -> str:
    return "".join(_LETTERS(text.lower()))


def site_of(domain: str | None, url: str | None) -> str:
    """The site's name: the first label of the registered domain."""
    if domain:
        return domain.split(".")[0].lower()
    m = re.match(r"\w+://(?:[^/@]*@)?([^/:]+)", url or "")
    labels = m.group(1).lower().split(".") if m else []
    return labels[-2] if len(labels) > 1 else ""


def link_like(line: str) -> bool:
    """Short and without a sentence's end, as the entries of a list of links."""
    return LINK_CHARS[0] <= len(line) <= LINK_CHARS[1] and not _TERMINAL.search(line)


def _heads(lines: list[str], page: np.ndarray, single: np.ndarray, titles: list[str | None]) -> np.ndarray:
    """1 for each line of one item that a link-like line other than its page's title follows, else 0."""
    out = np.zeros(len(lines), dtype=np.int32)
    names: dict[int, str] = {}
    for k in np.flatnonzero(single[:-1] & (page[1:] == page[:-1])).tolist():
        after = lines[k + 1].strip()
        if link_like(after) and not _CRUMB.search(after) and len(_LETTERS(after)) > 2:
            at = int(page[k])
            name = names.get(at)
            if name is None:
                name = names[at] = flat(titles[at] or "")
            out[k] = not (name and name in flat(after))
    return out


def page_nodes(df: DataFrame, url: str, host: str, domain: str, text: str, title: str) -> tuple[DataFrame, DataFrame]:
    """((h, d, u, item, heads) of the nodes of every page, (h, n_pages) of every host)."""

    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 5):
            domains, urls, texts, titles = (batch.column(c).to_pylist() for c in range(3, 7))
            lines, page = cut_lines(texts)
            low, _ = cut_lines([masked(t, site_of(d, u)) for t, d, u in zip(texts, domains, urls)])
            items, owner = cut_items(low)
            heads = _heads(lines.to_pylist(), page, np.bincount(owner, minlength=len(lines)) == 1, titles)
            rows = pa.array(page[owner])
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(rows) for c in range(3)), items.cast(pa.string()), pa.array(heads[owner])], names=["h", "d", "u", "item", "heads"])

    from_url = F.nullif(F.regexp_extract(F.lower(F.col(url)), r"^\w+://([^/:]+)", 1), F.lit(""))
    pages = df.where(F.col(text).isNotNull()).select(host_key(host, url).alias("h"), F.xxhash64(F.coalesce(F.col(domain), from_url)).alias("d"), F.xxhash64(F.col(url)).alias("u"), F.coalesce(F.col(domain), from_url).alias("_d"), F.col(url).cast("string").alias("_url"), F.col(text).cast("string").alias("_text"), F.col(title).cast("string").alias("_title"))
    pages = pages.where("_d IS NOT NULL")
    return pages.mapInArrow(nodes, "h BIGINT, d BIGINT, u BIGINT, item STRING, heads INT"), pages.groupBy("h").agg(F.count_distinct("u").alias("n_pages"))


def host_key(host: str, url: str):
    """The hashed host of a page, taken from its url if need be."""
    from_url = F.nullif(F.regexp_extract(F.lower(F.col(url)), r"^\w+://([^/:]+)", 1), F.lit(""))
    return F.xxhash64(F.coalesce(F.lower(F.col(host)), from_url))


def induce(df: DataFrame, url: str, host: str, domain: str, text: str, title: str) -> tuple[dict[str, float], DataFrame]:
    """(wrapper: item -> share of its occurrences that head a list of links; (h, own) with the template of each host)."""
    found, n_pages = page_nodes(df, url, host, domain, text, title)
    per_url = found.groupBy("h", "item", "u").agg(F.max("heads").alias("heads"), F.min("d").alias("d"))
    per_host = per_url.groupBy("h", "item").agg(F.count(F.lit(1)).alias("n"), F.sum("heads").alias("heads"), F.min("d").alias("d"))
    constant = staged(per_host.where(F.col("n") >= MIN_URLS).join(n_pages, "h").where(F.col("n") >= HOST_SHARE * F.col("n_pages")), "constant-nodes")
    wide = constant.groupBy("item").agg(F.count_distinct("d").alias("n_domains"), (F.sum("heads") / F.sum("n")).alias("share")).where(F.col("n_domains") >= MIN_DOMAINS).select("item", "share")
    wide = staged(wide, "wrapper")
    own = constant.where((F.col("n") >= OWN_URLS) & (F.col("n") >= OWN_SHARE * F.col("n_pages"))).join(wide, "item", "left_anti").select("h", "item", (F.col("heads") / F.col("n")).alias("share"), F.lit(False).alias("wide"))
    items: dict[str, float] = {}
    if wide.count() <= MAX_WRAPPER:
        items = {r["item"]: r["share"] for r in wide.collect()}
    else:  # every host gets the items that occur on it
        own = own.unionByName(page_nodes(df, url, host, domain, text, title)[0].select("h", "item").distinct().join(wide.withColumn("wide", F.lit(True)), "item"))
    return items, staged(own.groupBy("h").agg(F.collect_list(F.struct("item", "share", "wide")).alias("own")), "host-templates")


class Wrapper:
    """Labels the lines of pages; picklable."""

    #: Templates of single hosts (h, own); stays in the driver.
    own: DataFrame | None = None

    def __init__(self, items: dict[str, float], restorer: Restorer | None = None):
        self.items, self.restorer = items, restorer
        self._start()

    def _start(self) -> None:
        self.sorted = sorted(self.items)
        self.share = np.array([self.items[i] for i in self.sorted])
        self.values = pa.array(self.sorted, type=pa.large_string())

    def __getstate__(self):
        return {"items": self.items, "restorer": self.restorer}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._start()

    def is_prefix(self, item: str, own: list[tuple[str, float, bool]] | None = None) -> bool:
        """Whether an item cut at its end begins a wrapper item."""
        at = bisect_left(self.sorted, item)
        return len(item) >= 4 and (at < len(self.sorted) and self.sorted[at].startswith(item) or any(wide and i.startswith(item) for i, _, wide in own or ()))

    def restored(self, texts: list[str]) -> list[str]:
        """The texts with their garbled lines restored."""
        mixed = [k for k, t in enumerate(texts) if not t.isascii()]
        if not self.restorer or not mixed:
            return texts
        lines, page = cut_lines([texts[k] for k in mixed])
        odd = np.flatnonzero(~pc.string_is_ascii(lines).to_numpy(zero_copy_only=False))
        coded = lines.take(pa.array(odd)).dictionary_encode()
        fixed = {k: done[0] for k, done in self.restorer.restore_lines(coded.dictionary).items()}
        out = list(texts)
        if fixed:
            code = coded.indices.to_numpy()
            hit = np.isin(code, np.fromiter(fixed, dtype=code.dtype))
            bounds = np.searchsorted(page, np.arange(len(mixed) + 1))
            for p in np.unique(page[odd[hit]]).tolist():
                own = lines.slice(bounds[p], bounds[p + 1] - bounds[p]).to_pylist()
                for at, c in zip(odd[hit & (page[odd] == p)].tolist(), code[hit & (page[odd] == p)].tolist()):
                    own[at - bounds[p]] = fixed[c]
                out[mixed[p]] = "\n".join(own)
        return out

    def label(self, text: str, site: str, title: str | None) -> tuple[list[str], list[int]]:
        """(lines, garbled ones restored; label of each line) of one page."""
        return next(self.label_batch([text], [site], [title]))

    def label_batch(self, texts: list[str], sites: list[str], titles: list[str | None], owns: list | None = None) -> Iterator[tuple[list[str], list[int]]]:
        """(lines, garbled ones restored; label of each line) of every page, as :meth:`label_arrays`."""
        if texts:
            lines, page, labels = self.label_arrays(texts, sites, titles, owns)
            bounds = np.searchsorted(page, np.arange(len(texts) + 1)).tolist()
            all_lines, all_labels = lines.to_pylist(), labels.tolist()
            for a, b in zip(bounds, bounds[1:]):
                yield all_lines[a:b], all_labels[a:b]

    def label_arrays(self, texts: list[str], sites: list[str], titles: list[str | None], owns: list | None = None) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """(lines of all pages, garbled ones restored; page of each line; label of each line); ``owns`` has (item, share, in the wrapper) of the pages' hosts."""
        texts = self.restored(texts)
        lines, page = cut_lines(texts)
        items, owner = cut_items(cut_lines([masked(t, s) for t, s in zip(texts, sites)])[0])
        index = pc.fill_null(pc.index_in(items, value_set=self.values), -1).to_numpy().astype(np.int64)
        size = pc.binary_length(items).to_numpy().astype(np.int64)
        share = np.where(index >= 0, self.share[index] if len(self.share) else 0.0, 0.0)
        in_wrapper = index >= 0
        if owns and any(owns):
            index = index.copy()
            names = {i: k for k, i in enumerate({i for own in owns for i, *_ in own or ()}, len(self.sorted))}
            at_page = np.searchsorted(page[owner], np.arange(len(texts) + 1))
            for p in (p for p, own in enumerate(owns) if own):
                known = {i: rest for i, *rest in owns[p]}
                for k, item in enumerate(items.slice(at_page[p], at_page[p + 1] - at_page[p]).to_pylist(), int(at_page[p])):
                    if item in known:
                        index[k], (share[k], in_wrapper[k]) = names[item], known[item]
        # an item that a page repeats is no template there
        seen = np.flatnonzero(index >= 0)
        _, back, many = np.unique(page[owner[seen]] << 32 | index[seen], return_inverse=True, return_counts=True)
        index[seen[many[back] >= MAX_REPEATS]] = -1
        n = len(lines)
        count = np.bincount(owner, minlength=n)
        first = np.searchsorted(owner, np.arange(n))
        total = np.bincount(owner, weights=size, minlength=n)
        hit = np.bincount(owner, weights=size * (index >= 0), minlength=n)
        hit_wrapper = np.bincount(owner, weights=size * ((index >= 0) & in_wrapper), minlength=n)
        known_first = np.zeros(n, dtype=bool)
        known_first[count > 0] = index[first[count > 0]] >= 0
        blank = pc.equal(pc.utf8_length(pc.utf8_trim_whitespace(lines)), 0).to_numpy(zero_copy_only=False)
        # a last line cut within an item
        bounds = np.searchsorted(page, np.arange(len(texts) + 1))
        for k in (bounds[1:] - 1).tolist():
            last = first[k] + count[k] - 1
            if count[k] and index[last] < 0 and (count[k] == 1 or hit[k]) and self.is_prefix(items[int(last)].as_py(), owns[page[k]] if owns else None):
                hit[k] += size[last]
                hit_wrapper[k] += size[last]
        labels = np.where(blank, EMPTY, np.where((count > 0) & (hit >= 0.9 * total), TEMPLATE, BODY))
        if owns and any(owns):
            only_own = (labels == TEMPLATE) & (hit_wrapper < 0.9 * total)
            for p in np.unique(page[only_own]).tolist():
                a, b = bounds[p], bounds[p + 1]
                slots = np.flatnonzero(labels[a:b] == BODY)
                if len(slots):
                    between = slice(a + slots[0], a + slots[-1])
                    labels[between][only_own[between]] = BODY
        heading = (labels == TEMPLATE) & (count == 1)
        heading[heading] = share[first[heading]] >= HEADING_SHARE
        crumb = (labels == BODY) & (count > 1) & known_first
        all_lines = lines.to_pylist()
        has_template = np.bincount(page, weights=labels == TEMPLATE, minlength=len(texts)).tolist()
        crumbs = np.bincount(page, weights=crumb, minlength=len(texts)).tolist()
        headings = np.bincount(page, weights=heading, minlength=len(texts)).tolist()
        if self.restorer:
            asked = [p for p, title in enumerate(titles) if title and not title.isascii() and (crumbs[p] or headings[p])]
            titles = list(titles)
            for p, done in zip(asked, self.restorer.restore_batch([titles[p] for p in asked])):
                titles[p] = done[0] if done else titles[p]
        for p in (p for p, asked in enumerate(has_template) if asked or crumbs[p]):
            a, b = int(bounds[p]), int(bounds[p + 1])
            own_lines, own_labels = all_lines[a:b], labels[a:b].tolist()
            if crumbs[p] or headings[p]:
                name = flat(titles[p] or "")
                for k in (np.flatnonzero(crumb[a:b])).tolist() if crumbs[p] else ():
                    path = _CRUMB.split(own_lines[k])
                    if len(path) >= 2 and _LETTERS(path[0]) and items[int(first[a + k])].as_py() == _words(path[0], sites[p]):
                        own_labels[k] = CRUMB
                        if not name and len(flat(path[-1])) > 8:
                            name = flat(path[-1])
                if headings[p]:
                    _sidebars(own_lines, heading[a:b].tolist(), own_labels, name)
            if has_template[p]:
                _dates(own_lines, own_labels)
            labels[a:b] = own_labels
        return lines, page, labels


def _words(text: str, site: str) -> str:
    return " ".join(_SITE if w == site else w for w in _LETTERS(text.lower()))


def _sidebars(lines: list[str], heading: list[bool], labels: list[int], name: str) -> None:
    k = 0
    while k < len(lines):
        if not heading[k] or labels[k] != TEMPLATE:
            k += 1
            continue
        style, j, entries = None, k + 1, 0
        while j < len(lines) and labels[j] == BODY:
            line = lines[j].strip()
            if len(name) > 8 and flat(line) == name:
                break
            mark = _BULLET.match(line)
            kind = "n" if mark and mark.group(2) else mark.group(1) if mark else ""
            more = _MORE.search(line) or _NAME_END.search(line)
            if more and len(line) < TEASER_CHARS and entries and not mark:
                labels[j] = SIDEBAR
            elif len(line) <= ENTRY_CHARS and not _TERMINAL.search(line) and (style is None or kind == style) and not line[:1].islower() and _body_word(line, mark):
                style = kind
                labels[j] = SIDEBAR
                entries += 1
            else:
                break
            j += 1
        k = max(j, k + 1)


def _dates(lines: list[str], labels: list[int]) -> None:
    """A constant line with a date belongs to the page if the page's body still follows it."""
    first, any_body = -1, False
    for k, label in enumerate(labels):
        if label == BODY:
            if not any_body:
                first, any_body = k, True
            if len(lines[k]) > 60:
                first = k
                break
    for k in range(max(first, 0)):
        if labels[k] == TEMPLATE and _DATE.search(lines[k]):
            labels[k] = BODY


def _body_word(line: str, mark: re.Match | None) -> bool:
    rest = line[mark.end() :] if mark else line
    return bool(rest) and not rest[0].islower()


def wrapper_for(df: DataFrame, restorer: Restorer | None = None) -> Wrapper:
    items, own = induce(df, "url", "host", "domain", "content", "title")
    wrapper = Wrapper(items, restorer)
    wrapper.own = own
    return wrapper


def labelled(batch: pa.RecordBatch, wrapper: Wrapper) -> tuple[list[int], pa.Array, np.ndarray, np.ndarray]:
    """(rows of the pages with text in a batch of :func:`label_input`; their lines, page and label of each line)."""
    domains, urls, texts, titles, owns = (batch.column(c).to_pylist() for c in range(1, 6))
    at = [k for k, t in enumerate(texts) if t]
    pairs = [[(o["item"], o["share"], o["wide"]) for o in owns[k]] if owns[k] else None for k in at]
    return at, *wrapper.label_arrays([texts[k] for k in at], [site_of(domains[k], urls[k]) for k in at], [titles[k] for k in at], pairs)


def label_input(df: DataFrame, key: str, wrapper: Wrapper) -> DataFrame:
    """(key, domain, url, content, title, own) of the pages with content; ``own`` is the template of the page's host.

    Spark broadcasts the templates while they are small and else splits hot hosts in the join.
    """
    pages = df.where(F.col("content").isNotNull())
    columns = [F.col(c).cast("string").alias(c) for c in ("domain", "url", "content", "title")]
    if wrapper.own is None:
        return pages.select(key, *columns, F.lit(None).cast("array<struct<item:string,share:double,wide:boolean>>").alias("own"))
    return pages.select(key, *columns, host_key("host", "url").alias("h")).join(wrapper.own, "h", "left").select(key, "domain", "url", "content", "title", "own")


def boilerplate_lines(df: DataFrame, key: str, wrapper: Wrapper) -> DataFrame:
    """(key, line_no) of the lines outside the main body; ``df`` has url, host, domain, content and title."""
    shared = df.sparkSession.sparkContext.broadcast(wrapper)
    schema = T.StructType([T.StructField(key, df.schema[key].dataType), T.StructField("line_no", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 3):
            rows, _, page, labels = labelled(batch, shared.value)
            found = np.flatnonzero(np.isin(labels, (TEMPLATE, CRUMB, SIDEBAR)))
            first = np.searchsorted(page, page[found])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(np.array(rows, dtype=np.int64)[page[found]])), pa.array((found - first + 1).astype(np.int32))], names=schema.names)

    return label_input(df, key, wrapper).mapInArrow(run, schema)


def bodies(df: DataFrame, key: str, wrapper: Wrapper) -> DataFrame:
    """(key, body): the lines of the main body of each page with content, as they stand there."""
    shared = df.sparkSession.sparkContext.broadcast(wrapper)
    schema = T.StructType([T.StructField(key, df.schema[key].dataType), T.StructField("body", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 3):
            out = batch.column(3).to_pylist()
            rows, _, page, labels = labelled(batch, shared.value)
            kept = np.isin(labels, (BODY, EMPTY)).tolist()
            bounds = np.searchsorted(page, np.arange(len(rows) + 1)).tolist()
            for k, a, b in zip(rows, bounds, bounds[1:]):
                out[k] = "\n".join(line for line, own in zip(out[k].split("\n"), kept[a:b]) if own)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, type=pa.string())], names=schema.names)

    return label_input(df, key, wrapper).mapInArrow(run, schema)
