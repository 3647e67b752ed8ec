"""Main text of web pages by template deduction from equivalence classes.

A page is a sequence of tokens: block-level tags and text nodes, each with the role its path of open block
elements gives it.  Over the pages of a host every token has an occurrence vector, how often it occurs in each
page; tokens with equal vectors form an equivalence class.  Classes that are frequent (``SUPPORT`` pages or
more), large (``SIZE`` tokens or more) are candidates; the class that occurs once in each page is the frame.  A second pass
over the pages keeps the candidates whose tokens come in one order (once, or as one tuple again and again) on nine
pages of ten and lie in one gap of the frame; they are the host's template.  What lies between template tokens are
the slots; the page's text is what fills the slots of the article.

Vectors are never gathered: a token's vector is known by the exclusive-or of a hash of (page, count) over the
host's pages, which workers add up before anything is shuffled, so a host with a third of all pages is no more
work for one task than another.  Text nodes are in a template only if half of the host's pages have them, so a
template is as large as the pages' common structure, however many pages there are.  Pages on hosts with fewer
than ``SUPPORT`` pages have no template; their elements are taken as they are.

Names tell slots apart: the article's are those inside the template's ``article`` or ``main`` element; where there is
none, all slots in page order.  Menus, headers, footers, sidebars, forms, scripts, styles and elements named as
notices, adverts or comments are never the article, but a form or a name around an article does not exclude it where
the page has no other.  Blocks that are text of the template alone are left out, unless template text is more than a
third of the page's slots: then the page is a copy of others.

Text: character references are decoded, white space inside a block becomes one space, blocks without text are
left out, the others are joined by a line break in page order.

Defined results: null or empty html has the empty text; a null address has the empty host; rows with equal ids
are extracted one by one; broken markup is read as far as it goes; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape
from itertools import accumulate

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._spark import cut, slices, small_batches
from .url_filter import address

SUPPORT, SIZE = 3, 3
#: Templates up to this many tokens in all are broadcast; larger ones are joined by host.
BROADCAST_ROWS = 500_000

_MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>", re.S)
_NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style title textarea noscript template svg iframe select button".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup "
    "html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
_NEVER = frozenset("head nav footer aside form menu dialog".split())
_OTHER = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|notices?|alert|popup|modal|comments?|replies|respond|disqus|sidebar|side|menu|nav\w*|breadcrumbs?|"
    r"header|masthead|footer|share|sharing|social|related|recommended|widget|subscribe|newsletter|login|search)(?:$|[\s_-])",
    re.I,
)
_ARTICLE = frozenset(("article", "main"))
_HARD = _NEVER - {"form"}
#: What an open element of the same kind ends.
_ENDS = {"li": "li", "dt": "dd", "dd": "dt", "tr": "tr", "td": "td", "th": "th"}


@dataclass(slots=True)
class Node:
    name: str
    role: int
    never: bool
    article: bool
    #: ``never`` but for names and forms around the article
    inner: bool


@dataclass(slots=True)
class Token:
    """A tag or a text node.  ``inside``: the open elements, outermost first; text nodes carry their text."""

    role: int
    tag: str
    text: str | None
    inside: tuple[Node, ...]


def read(html: str) -> list[Token]:
    out: list[Token] = []
    stack: list[Node] = []
    at, end = 0, len(html)

    def text(piece: str) -> None:
        if piece:
            out.append(Token(_role("#" + piece, stack), "#", piece, tuple(stack)))

    while at < end:
        m = _MARKUP.search(html, at)
        if not m:
            text(html[at:])
            break
        text(html[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        name, closing = m[2].lower(), bool(m[1])
        if name == "br":
            out.append(Token(0, "br", " ", tuple(stack)))
        elif name in _RAW and not closing:
            if not m[3].rstrip().endswith("/"):
                stop = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(html, at)
                at = stop.end() if stop else end
            out.append(Token(_role(name, stack), name, None, tuple(stack)))
        elif name in _VOID or name not in _BLOCK:
            continue
        elif closing:
            depth = next((k for k in range(len(stack) - 1, -1, -1) if stack[k].name == name), -1)
            if depth >= 0:
                del stack[depth:]
            out.append(Token(_role("/" + name, stack), "/" + name, None, tuple(stack)))
        else:
            if stack and stack[-1].name == "p" or stack and name in _ENDS and stack[-1].name in (name, _ENDS[name]):
                stack.pop()
            named = " ".join(x.strip("\"'") for x in _NAMED.findall(m[3])) if m[3] else ""
            role = _role(f"{name} {named}", stack)
            article = name in _ARTICLE or bool(stack and stack[-1].article)
            never = name in _NEVER or name == "header" and not article or bool(named and _OTHER.search(named)) and name not in ("html", "body", *_ARTICLE)
            out.append(Token(role, name, None, tuple(stack)))
            outer = stack[-1] if stack else None
            begins = article and not (outer and outer.article)
            hard = outer and (any(n.name in _HARD for n in stack) if begins else outer.inner)
            stack.append(Node(name, role, never or bool(outer and outer.never), article, never or bool(hard)))
    return out


def _role(token: str, stack: list[Node]) -> int:
    """A token's role by its name and path: odd for text nodes, even for tags."""
    return xxhash.xxh64_intdigest(token, stack[-1].role if stack else 0) >> 2 << 1 | token.startswith("#")


def blocks(tokens: list[Token], wanted: set[int]) -> list[str]:
    """Text of the tokens at the wanted places, block by block."""
    out: list[str] = []
    held: list[str] = []
    for k, t in enumerate(tokens):
        if t.text is None:
            out.append(" ".join(unescape("".join(held)).split()))
            held = []
        elif k in wanted or t.tag == "br":
            held.append(t.text)
    out.append(" ".join(unescape("".join(held)).split()))
    return [b for b in out if b]


def _sequences(tokens: list[Token], template: dict[int, tuple[int, float]]) -> dict[int, list[int]]:
    """Each class's tokens in page order."""
    found: dict[int, list[int]] = {}
    for t in tokens:
        if t.role in template:
            found.setdefault(template[t.role][0], []).append(t.role)
    return found


def _in_order(sequence: list[int], template: dict[int, tuple[int, float]]) -> bool:
    """Is the sequence one tuple, in the template's order, once or again and again?"""
    tuple_ = sorted(set(sequence), key=lambda r: (template[r][1], r))
    return sequence == tuple_ * (len(sequence) // len(tuple_))


def extract(html: str | None, template: dict[int, tuple[int, float]]) -> str:
    """``template``: the class and the mean place of each token of the host's template."""
    if not html:
        return ""
    tokens = read(html)
    ordered = {c for c, sequence in _sequences(tokens, template).items() if _in_order(sequence, template)}
    known = {r for r, (c, _) in template.items() if c in ordered}
    texts = [(k, t) for k, t in enumerate(tokens) if t.text is not None and t.tag == "#" and t.inside]
    free = [(k, t) for k, t in texts if not t.inside[-1].never]
    article = [(k, t) for k, t in free if any(n.name in _ARTICLE and (n.role in known or not known) for n in t.inside)]
    if not article:
        article = [(k, t) for k, t in free if t.inside[-1].article]
    if not any(t.text.strip() for _, t in article):
        # an article that a form or the name of an element around it would exclude
        article = [(k, t) for k, t in texts if t.inside[-1].article and not t.inside[-1].inner] or article
    slots = article if any(t.text.strip() for _, t in article) else free
    # a block that the template says itself is no slot; a page with more than a third of such text is a copy of others
    block = list(accumulate(t.text is None for t in tokens))
    said = {block[k] for k, t in slots if t.text.strip()} - {block[k] for k, t in slots if t.text.strip() and t.role not in known}
    own = [(k, t) for k, t in slots if block[k] not in said]
    if 3 * sum(len(t.text.strip()) for _, t in slots if t.role in known) > sum(len(t.text.strip()) for _, t in slots):
        own = slots
    return "\n".join(blocks(tokens, {k for k, _ in own}))


def templates(pages: DataFrame) -> DataFrame:
    """``host``, ``role``, ``class``, ``place`` of each template token.  ``pages``: row, host, html."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html"):
                sums: dict[tuple[str, int], list] = {}
                rows = zip(part.column("row").to_pylist(), part.column("host").to_pylist(), part.column("html").to_pylist(), strict=True)
                for row, host, html in rows:
                    tokens = [t for t in read(html or "") if t.role]
                    count = Counter(t.role for t in tokens)
                    first = {t.role: k for k, t in reversed(list(enumerate(tokens)))}
                    for role, n in count.items():
                        mark = xxhash.xxh64_intdigest(f"{row} {n}") >> 1
                        s = sums.setdefault((host, role), [0, 0, 0.0, 0])
                        s[0] ^= mark
                        s[1] += 1
                        s[2] += first[role]
                        s[3] += n
                if sums:
                    keys, values = zip(*sums.items(), strict=True)
                    hosts, roles = zip(*keys, strict=True)
                    marks, counts, places, times = zip(*values, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), *(pa.array(x, pa.int64()) for x in (roles, marks, counts)), pa.array(places, pa.float64()), pa.array(times, pa.int64())], ["host", "role", "mark", "pages", "places", "times"])

    tokens = pages.mapInArrow(run, "host string, role long, mark long, pages long, places double, times long")
    vectors = tokens.groupBy("host", "role").agg(F.bit_xor("mark").alias("class"), F.sum("pages").alias("pages"), F.sum("places").alias("places"), F.sum("times").alias("times")).where(F.col("pages") >= SUPPORT)
    vectors = cut(vectors)  # it is used twice
    whole = vectors.where("role % 2 = 0").groupBy("host").agg(F.max("pages").alias("host_pages"))
    vectors = vectors.join(whole, "host").where("role % 2 = 0 or 2 * pages >= host_pages")
    vectors = vectors.withColumn("frame", F.expr("pages = host_pages and times = pages"))
    large = vectors.groupBy("host", "class", "pages", "frame").agg(F.count("*").alias("size"), F.collect_list(F.struct("role", (F.col("places") / F.col("pages")).alias("place"))).alias("members")).where(F.col("size") >= SIZE)
    found = cut(large.select("host", "class", "pages", "frame", F.explode("members").alias("m")).select("host", F.col("m.role").alias("role"), "class", F.col("m.place").alias("place"), "pages", "frame"))
    return found.join(_valid(pages, found), ["host", "class"], "left_semi").select("host", "role", "class", "place")


class _Templates:
    """Each host's template: a broadcast table while there are at most ``BROADCAST_ROWS`` tokens, beyond that a column joined to the pages."""

    def __init__(self, found: DataFrame) -> None:
        columns = [F.col(c) for c in ("role", "class", "place", *(["frame"] if "frame" in found.columns else []))]
        self.small = found.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
        if self.small:
            of_host: dict[str, list[tuple]] = {}
            for r in found.select("host", F.struct(*columns).alias("m")).collect():
                of_host.setdefault(r.host, []).append(tuple(r.m))
            self.shared = found.sparkSession.sparkContext.broadcast(of_host)
        else:
            self.shared = None
            self.by_host = cut(found.groupBy("host").agg(F.collect_list(F.struct(*columns)).alias("template")))

    def to(self, pages: DataFrame) -> DataFrame:
        """``pages`` with a column ``template``, null where the table is broadcast."""
        if self.small:
            return pages.withColumn("template", F.lit(None).cast("array<struct<role:long,class:long,place:double,frame:boolean>>"))
        return pages.join(self.by_host, "host", "left")


def _reader(shared):
    """A function that gives the rows of a host's template (role, class, place, frame), of the broadcast table or else of the page's column; each is read once."""
    known: dict[str, list[tuple]] = {}

    def read_one(host: str, members) -> list[tuple]:
        if host not in known:
            known[host] = shared.value.get(host, []) if shared is not None else [tuple(m.values()) for m in members.as_py() or []]
        return known[host]

    return read_one


def _valid(pages: DataFrame, found: DataFrame) -> DataFrame:
    """``host``, ``class`` of the classes in order on nine pages of ten, and in one gap of the frame on all of those."""

    known = _Templates(found)
    shared = known.shared

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        template_of = _reader(shared)
        of_host: dict[str, tuple[dict, set]] = {}
        for batch in batches:
            for part in slices(batch, "html"):
                seen: dict[tuple[str, int], list[int]] = {}
                for host, html, members in zip(part.column("host").to_pylist(), part.column("html").to_pylist(), part.column("template"), strict=True):
                    if host not in of_host:
                        ms = template_of(host, members)
                        of_host[host] = {r: (c, p) for r, c, p, _ in ms}, {r for r, _, _, frame in ms if frame}
                    template, frame = of_host[host]
                    tokens = read(html or "")
                    sequences = _sequences(tokens, template)
                    ordered = {c for c, sequence in sequences.items() if _in_order(sequence, template)}
                    gaps: dict[int, list[int]] = {}
                    gap = 0
                    for t in tokens:
                        if t.role in frame:
                            gap += 1
                        elif t.role in template:
                            gaps.setdefault(template[t.role][0], []).append(gap)
                    framed = all(template[r][0] in ordered for r in frame)
                    for c in sequences:
                        s = seen.setdefault((host, c), [0, 0, 1 << 31, -1])
                        s[0] += 1
                        s[1] += c not in ordered
                        if c in ordered and c in gaps and framed:
                            s[2], s[3] = min(s[2], *gaps[c]), max(s[3], *gaps[c])
                if seen:
                    hosts, classes = zip(*seen, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(classes, pa.int64()), *(pa.array(x, pa.int64()) for x in zip(*seen.values(), strict=True))], ["host", "class", "pages", "bad", "low", "high"])

    rows = known.to(pages).select("host", "html", "template")
    sums = rows.mapInArrow(run, "host string, class long, pages long, bad long, low long, high long").groupBy("host", "class").agg(F.sum("pages").alias("pages"), F.sum("bad").alias("bad"), F.min("low").alias("low"), F.max("high").alias("high"))
    return sums.where("10 * bad <= pages and low >= high").select("host", "class")


def extract_pages(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of each row."""
    small_batches(pages.sparkSession)
    host, _ = address(F.col(url).cast("string"))
    rows = pages.select(F.col(key).cast("long").alias("id"), F.col(url).cast("string").alias("url"), host.alias("host"), F.col(html).cast("string").alias("html"))
    found = templates(rows.select(F.monotonically_increasing_id().alias("row"), "host", "html"))
    known = _Templates(found)
    shared = known.shared

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        template_of = _reader(shared)
        of_host: dict[str, dict] = {}
        for batch in batches:
            for part in slices(batch, "html"):
                texts = []
                for h, page, members in zip(part.column("host").to_pylist(), part.column("html").to_pylist(), part.column("template"), strict=True):
                    if h not in of_host:
                        of_host[h] = {m[0]: (m[1], m[2]) for m in template_of(h, members)}
                    texts.append(extract(page, of_host[h]))
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return known.to(rows).select("id", "url", "host", "html", "template").mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op4_html_text(spark, sf_dir: str) -> DataFrame:
    return extract_pages(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))
