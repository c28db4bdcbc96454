"""Main text of web pages by wrappers: union-free regular expressions over a host's pages.

Pages of one host come from few templates.  Their token streams (tags and texts) are aligned with
one another, and every mismatch generalises the expression so far, the wrapper:

* texts that differ become a slot;
* a tag that one page has and another lacks becomes optional;
* tags that come back within their parent become a repeated group; what lies between two of its
  rounds is optional in it.

A wrapper has no alternatives (union-free), one entry for each kind of tag in a parent, and merging
is associative, so pages fold into partial wrappers where they are read, and partial wrappers merge
in a tree of bounded fan-in: a host with a third of all pages is no hot group.  Wrappers also count
the text and the linked text of every place in the template over all pages of the host.

The wrapper then tells the article from the rest: an article element if the template has one, else
the place that holds most of the text that is no link and differs between pages.  Menus, headers,
footers, sidebars, notices, adverts, forms and comments go by their element or class.  Each page is
read through its host's wrapper.
"""

from __future__ import annotations

import hashlib
import html as entities
import json
import re
from collections.abc import Iterator
from difflib import SequenceMatcher

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import written

#: partial wrappers that merge in one step; hosts that a task holds before it passes them on
FAN_IN = 32
HOSTS = 2048
#: nesting that wrappers follow; deeper text stays with the element at that depth
DEPTH = 200
#: pages from which a text that never differs is taken for a part of the template
CONSTANT_PAGES = 8
#: share of the text that the article's place holds, and of linked text from which a list is a menu
MOST = 0.8
LINKED = 0.5

# fixed values of HTML: element classes by name
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea noscript template iframe xmp noembed noframes".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q "
             "rp rt ruby s samp small span strike strong sub sup time tt u var wbr img br".split())
CLOSES_P = set("address article aside blockquote center details dialog dir div dl fieldset "
               "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol "
               "p pre section summary table ul".split())
IMPLIED = {"li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th",
           "th": "td th", "option": "option", "thead": "thead tbody tfoot tr td th",
           "tbody": "thead tbody tfoot tr td th", "tfoot": "thead tbody tfoot tr td th"}
IMPLIED = {k: frozenset(v.split()) for k, v in IMPLIED.items()}
SCOPES = set("table ul ol dl menu article section div body html td th".split())
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
KNOWN = CLOSES_P | VOID | INLINE | set("html head body li dt dd tr td th thead tbody tfoot "
                                       "caption option select button svg".split())
# fixed values of the rule: elements, roles and name parts that are no article
NO_ARTICLE = set("head nav footer aside form button select svg menu dialog object canvas audio video "
                 "map fieldset input".split())
NO_ROLES = set("navigation banner contentinfo complementary search dialog alertdialog alert "
               "menu menubar toolbar".split())
NO_NAMES = set("ad ads adv advert adverts advertisement adsense adbox banner sponsor sponsored promo "
               "promotion sidebar aside menu nav navbar navigation breadcrumb breadcrumbs masthead "
               "topbar footer cookie cookies consent gdpr notice notices alert popup modal overlay "
               "newsletter subscribe subscription signup login comment comments disqus reply "
               "replies respond share sharing social related recommended recommendations widget "
               "toolbar pagination pager copyright skip search".split())
HEADER_NAMES = {"header", "top"}
ARTICLE_NAMES = set("article post entry content story main articlebody".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|(?P<tag></?[a-zA-Z][^\s/>]*)"
    r"(?P<rest>(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+(?:>|\Z))"
    r"|(?P<text>(?:[^<]++|<(?![!?]|/?[a-zA-Z]))++)", re.S)
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)|\b(hidden)\b""")
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


# -- pages as trees -------------------------------------------------------------------------

class Node:
    """An element that structures the page; children are nodes and texts (text, linked)."""

    __slots__ = ("tag", "role", "children", "block", "key")

    def __init__(self, tag: str, role: str = "", block: bool = True):
        self.tag, self.role, self.block = tag, role, block
        self.children: list = []
        self.key = tag + role


def _role(tag: str, rest: str) -> str:
    """'-' for what is no article by its element, role or names, '+' for what is, '^' for
    headers, else ''."""
    if tag in NO_ARTICLE:
        return "-"
    if tag in ("html", "body"):
        return ""
    names: set[str] = set()
    if "=" in rest or "hidden" in rest:
        for name, value, hidden in _ATTRIBUTE.findall(rest):
            name, value = name.lower(), value.strip("\"'")
            if hidden or name == "aria-hidden" and value == "true" \
                    or name == "style" and "display:none" in value.replace(" ", ""):
                return "-"
            if name in ("class", "id"):
                names.update(p.lower() for p in _PARTS.findall(value))
            elif name == "role":
                if value.lower() in NO_ROLES:
                    return "-"
                if value.lower() == "main":
                    return "+"
            elif name == "itemprop" and value.lower() == "articlebody":
                return "+"
    if tag in ("article", "main"):
        return "-" if names & {"comment", "comments", "reply", "related"} else "+"
    if names & NO_NAMES:
        return "-"
    if tag == "header" or names & HEADER_NAMES:
        return "^"
    return "+" if tag in ("div", "section", "td") and names & ARTICLE_NAMES else ""


def parse(source: str) -> Node:
    """The page's elements, as browsers nest them in the cases that matter for blocks of text."""
    root = Node("#page")
    stack = [root]
    linked, at, end = False, 0, len(source)
    deep = 0                                 # open elements below DEPTH
    while at < end:
        m = _TOKEN.match(source, at)
        at = m.end()
        text = m.group("text")
        if text is not None:
            stack[-1].children.append((text, linked))
            continue
        tag = m.group("tag")
        if tag is None:
            continue
        if tag[1] == "/":
            tag = tag[2:].lower()
            if tag == "a":
                linked = False
            if deep and tag not in INLINE and tag not in VOID:
                deep -= 1
                continue
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
                if tag in INLINE and stack[i].block:
                    break
            continue
        tag, rest = tag[1:].lower(), m.group("rest")
        if tag in RAW:
            close = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(source, at)
            at = close.end() if close else end
            continue
        if tag == "br" or tag == "wbr" or tag == "img":
            if tag == "br":
                stack[-1].children.append((" ", linked))
            continue
        if tag in INLINE:
            if tag == "a":
                linked = True
            if _role(tag, rest) == "-" and not rest.rstrip(">").endswith("/") and len(stack) < DEPTH:
                node = Node(tag, "-", False)
                stack[-1].children.append(node)
                stack.append(node)
            continue
        linked = False
        if tag in CLOSES_P:
            _close(stack, {"p"})
            if tag in HEADINGS and stack[-1].tag in HEADINGS:
                stack.pop()
        elif tag in IMPLIED:
            _close(stack, IMPLIED[tag])
        if tag not in KNOWN:
            tag = "x"                        # elements that HTML does not know
        node = Node(tag, _role(tag, rest))
        stack[-1].children.append(node)
        if tag in VOID:
            continue
        if len(stack) < DEPTH:
            stack.append(node)
        else:
            deep += 1
    return root


def _close(stack: list[Node], tags) -> None:
    """Ends the open element of one of the tags and what is open in it, within its scope."""
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag in tags:
            first = i
            while first > 1 and stack[first - 1].tag in tags:
                first -= 1
            del stack[first:]
            return
        if stack[i].tag in SCOPES:
            return


# -- wrappers -------------------------------------------------------------------------------

class Wrapper:
    """One place of a template.

    ``n`` elements seen here, ``within`` elements of the parent that have it (fewer than the
    parent's: optional), ``pages`` the pages.  ``text`` is None without text, a hash while every
    text was the same, and 0 for a slot.  ``chars`` and ``linked`` count text of this place
    itself.  ``order`` lists the groups of children (kinds, repeated) in the order of the template.
    """

    __slots__ = ("n", "within", "pages", "text", "chars", "linked", "order", "kinds")

    def __init__(self):
        self.n = self.within = self.pages = self.chars = self.linked = 0
        self.text: int | None = None
        self.order: list[tuple[tuple[str, ...], bool]] = []
        self.kinds: dict[str, Wrapper] = {}

    def dump(self) -> list:
        return [self.n, self.within, self.pages, self.text, self.chars, self.linked,
                self.order, {k: w.dump() for k, w in self.kinds.items()}]

    @classmethod
    def load(cls, x: list) -> Wrapper:
        w = cls()
        w.n, w.within, w.pages, w.text, w.chars, w.linked = x[:6]
        w.order = [(tuple(k), r) for k, r in x[6]]
        w.kinds = {k: cls.load(c) for k, c in x[7].items()}
        return w


def key_of(node: Node) -> str:
    """The kind of an element among its siblings; containers without a name also go by what they
    hold (paragraphs, lists, tables, other containers, text)."""
    if node.role or node.tag not in ("div", "section", "center", "x"):
        return node.key
    held = set()
    for c in node.children:
        if type(c) is tuple:
            if c[0].strip():
                held.add("t")
        elif c.tag == "p" or c.tag in HEADINGS:
            held.add("p")
        elif c.tag in ("ul", "ol", "dl"):
            held.add("l")
        elif c.tag in ("div", "section", "center", "x"):
            held.add("d")
        elif c.tag == "table":
            held.add("b")
    return f"{node.key}[{''.join(sorted(held))}]"


def groups(kinds: list[str]) -> list[tuple[tuple[str, ...], bool]]:
    """Kinds in order to groups: what lies from a kind's first to its last place is one repeated
    group."""
    last = {k: i for i, k in enumerate(kinds)}
    out, at = [], 0
    while at < len(kinds):
        end = last[kinds[at]]
        i = at
        while i <= end:
            end = max(end, last[kinds[i]])
            i += 1
        out.append((tuple(dict.fromkeys(kinds[at:end + 1])), end > at))
        at = end + 1
    return out


def _aligned(a: list[tuple[tuple[str, ...], bool]], b: list[tuple[tuple[str, ...], bool]]):
    """The order that both follow: matches stay, what one lacks goes between (and is optional),
    what they have in another order makes a repeated group."""
    if a == b:
        return a
    x, y = ([k for kinds, again in s for k in kinds * (1 + again)] for s in (a, b))
    out = []
    for what, i, j, k, l in SequenceMatcher(None, x, y, autojunk=False).get_opcodes():
        out += x[i:j] if what == "equal" else x[i:j] + y[k:l]
    return groups(out)


def merge(a: Wrapper, b: Wrapper) -> Wrapper:
    """``a`` generalised so that it also reads what ``b`` reads."""
    a.n += b.n
    a.within += b.within
    a.pages += b.pages
    a.chars += b.chars
    a.linked += b.linked
    if b.text is not None:
        a.text = b.text if a.text is None or a.text == b.text else 0
    a.order = _aligned(a.order, b.order)
    for k, w in b.kinds.items():
        mine = a.kinds.get(k)
        a.kinds[k] = w if mine is None else merge(mine, w)
    return a


def fold(node: Node) -> Wrapper:
    """The wrapper of one page: elements of a kind under one parent are aligned."""
    w = Wrapper()
    w.n = w.within = w.pages = 1
    if node.role == "-":
        return w                             # what is no article is no further aligned
    kinds, text = [], []
    for c in node.children:
        if type(c) is tuple:
            s = " ".join(entities.unescape(c[0]).split())
            if s:
                text.append(s)
                w.chars += len(s)
                w.linked += len(s) if c[1] else 0
                if not kinds or kinds[-1] != "#":
                    kinds.append("#")
            continue
        k = key_of(c)
        kinds.append(k)
        one = fold(c)
        mine = w.kinds.get(k)
        if mine is None:
            w.kinds[k] = one
        else:
            merge(mine, one)
            mine.within = mine.pages = 1
    if text:
        w.text = hash_text(" ".join(text))
    w.order = groups(kinds)
    return w


def hash_text(s: str) -> int:
    digest = hashlib.blake2b(s.encode("utf-8", "replace"), digest_size=7).digest()
    return int.from_bytes(digest, "big") | 1


def expression(w: Wrapper, kind: str = "#page") -> str:
    """The wrapper as a regular expression over tags; # is text that differs."""
    def one(k: str) -> str:
        if k == "#":
            return "#" if w.text == 0 else "text"
        c = w.kinds[k]
        s = f"<{k}>{'' if k.endswith('-') else expression(c, k)}</{k}>"
        return f"({s})?" if c.within < w.n else s

    return "".join(f"({''.join(map(one, kinds))})+" if again else one(kinds[0])
                   for kinds, again in w.order)


# -- the article's place --------------------------------------------------------------------

class Plan:
    """What to do at a place: ``region`` starts the article, ``drop`` is none of it."""

    __slots__ = ("region", "drop", "kinds")

    def __init__(self):
        self.region = self.drop = False
        self.kinds: dict[str, Plan] = {}


def _weights(w: Wrapper, kind: str, out: dict[int, tuple[int, int]]) -> tuple[int, int]:
    """(characters, linked characters) at and below each place that is no dropped one."""
    chars, linked = w.chars, w.linked
    for k, c in w.kinds.items():
        if not k.endswith("-"):
            a, b = _weights(c, k, out)
            chars, linked = chars + a, linked + b
    out[id(w)] = chars, linked
    return chars, linked


def plan(wrapper: Wrapper) -> Plan:
    """Where the article is: article elements; else main; else a place named so that holds half of
    the text; else the deepest place that holds MOST of the text that is no link."""
    weights: dict[int, tuple[int, int]] = {}
    _weights(wrapper, "#page", weights)
    plain = lambda w: weights[id(w)][0] - weights[id(w)][1]
    out = Plan()

    def outline(w: Wrapper, p: Plan, inside: bool) -> None:
        for k, c in w.kinds.items():
            q = p.kinds[k] = Plan()
            q.drop = k.endswith("-") or k.endswith("^") and not (inside and _has_heading(c))
            if not q.drop:
                outline(c, q, inside or k.startswith("article"))

    outline(wrapper, out, False)

    def topmost(w: Wrapper, p: Plan, wanted) -> list[tuple[Wrapper, Plan]]:
        found = []
        for k, c in w.kinds.items():
            q = p.kinds[k]
            if q.drop:
                continue
            found += [(c, q)] if wanted(k) else topmost(c, q, wanted)
        return found

    for wanted in (lambda k: k.startswith("article"), lambda k: k.startswith("main"),
                   lambda k: k.endswith("+")):
        found = [(c, q) for c, q in topmost(wrapper, out, wanted) if weights[id(c)][0]]
        if wanted("div+"):
            found = [(c, q) for c, q in found if 2 * plain(c) >= plain(wrapper)]
        if found:
            for _, q in found:
                q.region = True
            return out
    at, p = wrapper, out
    while True:
        best = max(((plain(c), k) for k, c in at.kinds.items()
                    if not p.kinds[k].drop and not k.startswith(("p", "li", "tr", "td"))
                    and k not in HEADINGS), default=(0, ""))
        if not best[0] or best[0] < MOST * plain(at):
            break
        at, p = at.kinds[best[1]], p.kinds[best[1]]
    p.region = True
    # without an article element, menus and the template's own texts go by what the wrapper saw
    slots = any(c.text == 0 for c in _below(at))

    def clean(w: Wrapper, p: Plan) -> None:
        for k, c in w.kinds.items():
            q = p.kinds[k]
            chars, linked = weights.get(id(c), (0, 0))
            constant = slots and c.pages >= CONSTANT_PAGES and not any(
                x.text == 0 for x in _below(c))
            if chars and (linked > LINKED * chars or constant):
                q.drop = True
            elif not q.drop:
                clean(c, q)

    clean(at, p)
    return out


def _below(w: Wrapper) -> Iterator[Wrapper]:
    yield w
    for k, c in w.kinds.items():
        if not k.endswith("-"):
            yield from _below(c)


def _has_heading(w: Wrapper) -> bool:
    return any(k in HEADINGS or not k.endswith("-") and _has_heading(c) for k, c in w.kinds.items())


def blocks(page: Node, p: Plan) -> list[str]:
    """Texts of the article's blocks in page order."""
    out: list[str] = []
    held: list[str] = []

    def flush() -> None:
        s = " ".join("".join(held).split())
        held.clear()
        if s:
            out.append(s)

    def read(node: Node, p: Plan | None, inside: bool) -> None:
        if node.block:
            flush()
        for c in node.children:
            if type(c) is tuple:
                if inside:
                    held.append(entities.unescape(c[0]))
                continue
            q = p.kinds.get(key_of(c)) if p is not None else None
            if c.role == "-" or q is not None and q.drop:
                if c.block:
                    flush()
            else:
                read(c, q, inside or q is not None and q.region)
        if node.block:
            flush()

    read(page, p, p.region)
    return out


def main_text(source: str | None, host_plan: Plan | None = None) -> str:
    """The article of one page, read with its host's plan; with its own where that finds none."""
    if not source:
        return ""
    page = parse(source)
    found = blocks(page, host_plan) if host_plan is not None else []
    if not found:
        found = blocks(page, plan(fold(page)))
    return "\n".join(found)


# -- on Spark -------------------------------------------------------------------------------

def host_of(url: Column) -> Column:
    """Host of a URL in lower case, without user and port; '' for null or none."""
    return F.coalesce(F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1),
                      F.lit(""))


WRAPPERS = "host string, part int, wrapper string"


def _batch(rows: list[tuple[str, int, Wrapper]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int32()),
         pa.array([json.dumps(r[2].dump(), separators=(",", ":")) for r in rows], pa.string())],
        names=["host", "part", "wrapper"])


def _fold_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (host, html) to partial wrappers."""
    part = TaskContext.get().partitionId()
    held: dict[str, Wrapper] = {}
    for batch in batches:
        for host, page in zip(batch.column(0), batch.column(1)):
            host, page = host.as_py(), page.as_py()
            if not page:
                continue
            one = fold(parse(page))
            held[host] = merge(held[host], one) if host in held else one
        if len(held) > HOSTS:
            yield _batch([(h, part, w) for h, w in held.items()])
            held = {}
    yield _batch([(h, part, w) for h, w in held.items()])


def _merge_group(table: pa.Table) -> pa.Table:
    whole = None
    for s in table.column("wrapper"):
        one = Wrapper.load(json.loads(s.as_py()))
        whole = one if whole is None else merge(whole, one)
    host = table.column("host")[0].as_py()
    return pa.Table.from_batches([_batch([(host, table.column("part")[0].as_py(), whole)])])


def wrappers(pages: DataFrame, *, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, wrapper) of every host, from all its pages; ``Wrapper.load(json.loads(wrapper))``."""
    spark = pages.sparkSession
    rows = pages.select(host_of(F.col(url_col)).alias("host"),
                        F.col(html_col).cast("string").alias("html"))
    partial = written(spark, rows.mapInArrow(_fold_pages, WRAPPERS), "page-wrappers")
    width = (partial.agg(F.max("part")).first()[0] or 0) + 1
    while True:
        partial = partial.withColumn("part", F.expr(f"part div {FAN_IN}").cast("int")) \
            .groupBy("host", "part").applyInArrow(_merge_group, WRAPPERS)
        width = -(-width // FAN_IN)
        if width <= 1:
            return partial.select("host", "wrapper")


def _read_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (host, wrapper, html, ...) to (..., text, n_chars)."""
    plans: dict[str, Plan] = {}
    for batch in batches:
        texts = []
        for host, wrapper, page in zip(*(batch.column(i) for i in range(3))):
            p, host = None, host.as_py()
            if wrapper.is_valid:
                p = plans.get(host)
                if p is None:
                    if len(plans) > HOSTS:
                        plans.clear()
                    p = plans[host] = plan(Wrapper.load(json.loads(wrapper.as_py())))
            texts.append(main_text(page.as_py(), p))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[3:], pa.array(texts, pa.string()),
             pa.array([len(t) for t in texts], pa.int64())],
            names=[*batch.schema.names[3:], "text", "n_chars"])


def extract(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """id, url, text, n_chars of every page.

    Blocks of text are joined by one line feed, white space inside a block is one space, character
    references are decoded.  A null or empty page gives an empty text, as does one without text.
    Pages without a host (null or odd urls) share the host ''.  Rows that repeat count each.
    Wrappers read whole pages.  Other columns are not read.  An empty table gives no rows.
    """
    spark = pages.sparkSession
    learnt = written(spark, wrappers(pages, url_col=url_col, html_col=html_col), "host-wrappers")
    rows = pages.select(host_of(F.col(url_col)).alias("host"),
                        F.col(html_col).cast("string").alias("html"),
                        F.col(id_col).alias("id"), F.col(url_col).alias("at"))
    types = dict(rows.dtypes)
    return rows.join(learnt, "host", "left").select("host", "wrapper", "html", "id", "at") \
        .mapInArrow(_read_pages, f"id {types['id']}, at {types['at']}, text string, n_chars bigint") \
        .select(F.col("id").alias(id_col), F.col("at").alias(url_col), "text", "n_chars")


def op13_main_text(spark, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
