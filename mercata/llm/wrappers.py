"""Main text of web pages by wrappers inferred per host.

Pages of one host share a template.  A wrapper is a union-free regular expression over its elements and texts: an element
that some pages lack is optional, one that stands several times in its parent is repeated, a text that differs
between pages is a slot.  Its parts are block elements and the runs of text between them.  Pages show steps from part to
part; the steps of all pages of a host, which Spark adds up in any order, give the contents of its elements
(``expressions.content``), and counts of texts per path say which of them are fixed.

Every page is matched with its host's wrapper, part by part.  Slots outside furniture are its text; texts that the wrapper holds fixed, and
repeated lists that are links on the host's pages, are the template's where the page's part matches.  What doesn't match is kept.
"""

from __future__ import annotations

import html
import json
import re
import zlib
from hashlib import blake2b
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercata.llm.expressions import CONTENT, EDGE, TEXT, Wrapper, content
from mercata.llm.support import stored

SALTS = 16   # parts into which a host's pages are dealt where wrappers don't fit a broadcast
HALF = 0.5   # share of a host's articles that must show a text or a list for it to be the template's
SHOWN = 0.1  # share of a host's articles, two at least, that must show an element for it to be a part of the expression

RAW = "script|style|noscript|template|textarea|svg|iframe|object|title|select|math"
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-z][^\s/>]*)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(?P<end2>/?)(?P<name2>[a-z][^\s/>]*)(?P<rest2>[^>]*)(?:>|\Z)",
    re.IGNORECASE | re.DOTALL,
)
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.IGNORECASE)
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "div", "dl", "dt",
    "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hr", "html",
    "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th",
    "thead", "tr", "ul",
}
#: Elements that an opening tag closes when they are still open.
CLOSES = {
    "p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"},
}
STRONG = {"head", "nav", "aside", "footer", "button", "menu", "dialog", "label"}
FORMS = {"form", "fieldset"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "alert", "dialog", "menu", "menubar"}
#: Class names and ids that hint at furniture, and words that may stand beside one in such a name ("cookie-bar", "related-posts").
HINT = re.compile(
    r"ads?|advert\w*|sponsor\w*|promos?|promotion|banners?|cookies?|consent|gdpr|notices?|alerts?|popups?|modal|overlay|menus?|nav|navbar|"
    r"navigation|breadcrumbs?|sidebars?|side|widgets?|footer|masthead|header|topbar|comments?|discussion|disqus|replies|respond|share|sharing|"
    r"social|related|recommend\w*|newsletter|subscribe|signup|login|search|pagination|pager|skip|toolbar", re.IGNORECASE,
)
BESIDE = set(
    "area areas bar block box bottom btn button buttons container content entry form group inner item items left link links list "
    "main page panel post posts primary right secondary section site slot thread top unit wrap wrapper".split()
)
#: Of these, what is never the main text, though article elements may lie in it.
TALK = re.compile(r"comments?|discussion|disqus|replies|respond|related|recommend\w*", re.IGNORECASE)
ARTICLES = {"article", "main"}


HEADERS = [["post", "header"], ["entry", "header"], ["main", "header"], ["content", "header"]]  # of an article, not of a site


def hints(names: str) -> list[str]:
    """The parts of the first class name or id that, as a whole, names furniture: each of its parts a hint, or beside one."""
    for name in names.split():
        parts = [p for p in re.split(r"[-_]+|(?<=[a-z])(?=[A-Z])", re.sub(r"\d+", "", name)) if p]
        found = [bool(HINT.fullmatch(p)) for p in parts]
        if any(found) and all(f or p.lower() in BESIDE for f, p in zip(found, parts)) and [p.lower() for p in parts] not in HEADERS:
            return parts
    return []


class Element:
    """An open element; ``path`` is a digest of the symbols from the root down, the same for repeated siblings."""

    __slots__ = (
        "name", "symbol", "strong", "form", "hinted", "talk", "article", "link", "path", "block", "parent", "key", "last", "words", "links",
        "bound",
    )

    def __init__(self, name: str, rest: str, above: Element | None):
        found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(rest)} if rest and "=" in rest or "hidden" in rest else {}
        label = " ".join(re.sub(r"\d+", "", found.get("class", "")).split()[:3]) or re.sub(r"\d+", "", found.get("id", ""))
        self.name = name
        self.symbol = f"{name}.{label}" if label else name
        hint = name not in ("html", "body", "article", "main") and (hints(found.get("class", "")) or hints(found.get("id", "")))
        self.hinted = (above.hinted if above else ()) + ((self,) if hint else ())
        self.talk = bool(hint and any(map(TALK.fullmatch, hint))) or bool(above and above.talk)
        self.article = not self.talk and (name in ARTICLES or bool(above and above.article))
        strong = name in STRONG or found.get("role", "").lower() in ROLES or "hidden" in found or name == "header" and not self.article
        self.strong = strong or bool(above and above.strong)
        self.form = name in FORMS or bool(above and above.form)
        self.link = name == "a" or bool(above and above.link)
        self.path = blake2b((above.path if above else b"") + self.symbol.encode(), digest_size=8).digest()
        self.parent = above.block if above else None
        self.block = self if name in BLOCK else self.parent
        if self.block is self:
            self.key = int.from_bytes(self.path, "big", signed=True)
            self.last, self.words, self.links, self.bound = EDGE, 0, 0, True  # of its parts so far; whether it matches the wrapper


def tokens(page: str):
    """(kind, value, element) of a page: "open", "close" and "text", with the element around a text.  Raw
    elements, comments and declarations vanish; missing end tags are supplied."""
    stack: list[Element] = []
    at = 0

    def close(count):
        for _ in range(count):
            gone = stack.pop()
            yield "close", gone.name, gone

    for m in TOKEN.finditer(page):
        if m.start() > at:
            yield "text", page[at:m.start()], stack[-1] if stack else None
        at = m.end()
        name = m["name"] or m["name2"]
        if not name:
            continue
        name = name.lower()
        if m["end"] or m["end2"]:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth].name == name:
                    yield from close(len(stack) - depth)
                    break
            continue
        rest = m["rest"] or m["rest2"] or ""
        over = CLOSES.get(name, {"p"} if name in BLOCK else ())
        depth = len(stack)
        while depth and stack[depth - 1].name not in BLOCK:
            depth -= 1
        while depth and stack[depth - 1].name in over:
            yield from close(len(stack) - depth + 1)
            depth = len(stack)
            while depth and stack[depth - 1].name not in BLOCK:
                depth -= 1
        element = Element(name, rest, stack[-1] if stack else None)
        yield "open", element.symbol, element
        if name not in VOID and not rest.endswith("/"):
            stack.append(element)
    if at < len(page):
        yield "text", page[at:], stack[-1] if stack else None
    yield from close(len(stack))


class Block(NamedTuple):
    """A run of text between two block elements, without furniture that tags or roles name."""

    text: str
    path: int
    words: int
    links: int     # words inside links
    weak: bool     # inside an element whose class or id hints at furniture
    form: bool
    article: bool
    bound: bool    # whether it matches the wrapper


def blocks(page: str | None, wrapper: Wrapper | None = None, steps: set | None = None, prose: set[int] | None = None) -> list[Block]:
    """The blocks of a page.  Class names are weak evidence: where no article or main element stands outside hinted
    elements, the hints around those that there are don't count.

    The page's parts are matched with the wrapper.  What stands in elements that tags or roles name as furniture is no part.  ``steps`` takes
    (path, part before, part after, its symbol); ``prose`` the paths of elements with more than half of their words outside links."""
    out: list[tuple[str, Element | None, Element, int, int, bool]] = []
    root = Element("html", "", None)
    root.key = 0
    current: list[tuple[str, Element | None]] = []
    around: dict[int, Element] = {}  # hinted elements around articles
    free = False              # whether an article stands outside them

    def step(place: Element, after: int, symbol: str) -> bool:
        if steps is not None:
            steps.add((place.key, place.last, after, symbol))
        bound = wrapper is not None and place.bound and wrapper.allows(place.key, place.last, after)
        place.last = after
        return bound

    def leave(place: Element) -> None:
        step(place, EDGE, "")
        if place.words > 2 * place.links and prose is not None:
            prose.add(place.key)

    def flush() -> None:
        text = " ".join(html.unescape("".join(t for t, _ in current)).split())
        if text:
            element = next((e for t, e in current if t.strip()), None)
            links = sum(len(html.unescape(t).split()) for t, e in current if e is not None and e.link)
            place = element.block if element is not None and element.block is not None else root
            words = len(text.split())
            place.words += words
            place.links += links
            out.append((text, element, place, words, links, step(place, TEXT, "#")))
        current.clear()

    for kind, value, element in tokens(page or ""):
        if kind == "text":
            if element is None or not element.strong:
                current.append((value, element))
            continue
        if kind == "open" and element.name in ARTICLES and element.article and not element.strong:
            around.update((id(e), e) for e in element.hinted)
            free = free or not element.hinted
        if element.name in BLOCK:
            flush()
            place = element.parent or root
            if kind == "open" and not place.strong:
                element.bound = step(place, element.key, element.symbol)
            elif kind == "close" and not element.strong:
                leave(element)
                place.words += element.words
                place.links += element.links
        elif element.name in VOID:
            current.append((" ", element))
    flush()
    leave(root)
    lifted = {} if free else around
    return [
        Block(text, 0, words, links, False, False, False, bound) if element is None else Block(
            text, place.key, words, links,
            element.talk or any(id(e) not in lifted for e in element.hinted), element.form, element.article, bound,
        )
        for text, element, place, words, links, bound in out
    ]


def digest(text: str) -> int:
    return int.from_bytes(blake2b(text.encode(), digest_size=8).digest(), "big", signed=True)


def read(found: list[Block], wrapper: Wrapper | None = None) -> list[str]:
    """The texts of a page's slots: furniture, and fixed texts and lists of links of parts that match, are left out."""
    for allowed in ("", "weak", "form"):  # hints, then forms, count only as long as something is left without them
        kept = [
            b for b in found
            if (not b.weak or allowed) and (not b.form or allowed == "form")
            and not (b.bound and (b.path, digest(b.text)) in wrapper.fixed)
        ]
        if kept:
            break
    inside = [b for b in kept if b.article]
    if inside and 2 * sum(b.words for b in inside) >= sum(b.words - b.links for b in kept):
        return [b.text for b in inside]
    prose = [b.text for b in kept if not (b.bound and b.path in wrapper.lists) and 2 * b.links <= b.words]
    return prose or [b.text for b in kept]


def text_of(page: str | None, wrapper: Wrapper | None = None) -> str:
    return "\n\n".join(read(blocks(page, wrapper), wrapper))


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


STEPS = "array<struct<path: long, before: long, after: long, symbol: string, prose: boolean>>"


def wrapper_parts(pages: DataFrame) -> DataFrame:
    """What every different page shows to its host's wrapper: (host, article, path, text, words, links) of every block, and once a page
    (host, article, path, steps) without a text.  ``article`` is the digest of the page's
    longest block: near copies of a page share it and count as one.  ``path`` is then a digest of the page's steps; a task writes steps
    out for the first page that makes them."""
    names = ["host", "article", "path", "text", "words", "links", "steps"]
    kind = pa.list_(pa.struct([
        ("path", pa.int64()), ("before", pa.int64()), ("after", pa.int64()), ("symbol", pa.string()), ("prose", pa.bool_()),
    ]))
    kinds = [pa.string(), *[pa.int64()] * 5, kind]

    def run(batches):
        made = set()
        for batch in batches:
            out = []
            for host, page in zip(*(c.to_pylist() for c in batch.columns)):
                steps, prose = set(), set()
                found = blocks(page, steps=steps, prose=prose)
                if found:
                    article = digest(max(found, key=lambda b: (b.words, b.text)).text)
                    out += [(host, article, b.path, digest(b.text), b.words, b.links, None) for b in found]
                    shape = [(*step, step[0] in prose) for step in sorted(steps)]
                    name = digest(repr(shape))
                    if len(made) > 100_000:
                        made.clear()
                    out.append((host, article, name, None, None, None, None if (host, name) in made else [
                        dict(zip(("path", "before", "after", "symbol", "prose"), step)) for step in shape
                    ]))
                    made.add((host, name))
                if len(out) > 50_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    rows = pages.filter("html is not null").select(host_of(F.col("url")).alias("host"), "html")
    return rows.mapInArrow(run, f"host string, article long, path long, text long, words long, links long, steps {STEPS}")


def host_contents(shapes: DataFrame, hosts: DataFrame) -> DataFrame:
    """(host, path, prose, content, symbols): the content of every element that two articles, and a tenth of the host's, show; an article
    counts once for every set of steps that its copies make.

    So an expression has no more parts than ten times those of an average page.  What fewer show is no part: fixed texts and
    lists need more, and a page's steps around it are open.
    """
    counts = shapes.select("host", "article", "path").distinct().groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"))
    first = shapes.filter("steps is not null").select("host", "path", "steps").dropDuplicates(["host", "path"])
    shapes = stored(first.join(counts, ["host", "path"]).select("host", "n", "steps"), "wrapper-shapes")
    shown = (F.col("n") >= 2) & (F.col("n") >= F.col("articles") * SHOWN)
    parts = shapes.select("host", "n", F.explode(F.array_distinct("steps.after")).alias("part")).groupBy("host", "part").agg(F.sum("n").alias("n"))
    parts = stored(parts.join(hosts, "host").filter(shown | F.col("part").isin(EDGE, TEXT)).select("host", "part"), "wrapper-elements")
    steps = shapes.select("host", "n", F.explode("steps").alias("s")).select("host", "n", "s.*")
    steps = steps.groupBy("host", "path", "before", "after", "symbol").agg(F.sum("n").alias("n"), F.max("prose").alias("prose"))
    for column in ("path", "before", "after"):
        steps = steps.join(parts.withColumnRenamed("part", column), ["host", column], "left_semi")
    chain = F.udf(lambda steps: content(steps), CONTENT)
    found = steps.groupBy("host", "path").agg(
        F.max("prose").alias("prose"), F.collect_list(F.struct("before", "after", "n")).alias("steps"),
        F.collect_set(F.struct("after", "symbol")).alias("symbols"),
    )
    return found.select("host", "path", "prose", chain("steps").alias("content"), "symbols")


def host_wrappers(pages: DataFrame) -> DataFrame:
    """(host, articles, fixed, lists, parts, symbols, packed): what the template of each host repeats, from all its pages.

    ``parts`` is the union-free regular expression: by path, the content of every element, as a chain of factors that may be optional or
    repeated.  A text is fixed where at least two articles, and half of the host's, show it at one path; a path is a list of links where at
    least half of its words on such a share of articles are links.  Both show on half of a host's articles, so there
    are no more of them than twice the blocks of an average page.  Where a path shows more texts than fixed ones, it has a slot.
    ``symbols`` names the parts; ``packed`` is the wrapper in few bytes, for the rows of pages.
    """
    raw = stored(wrapper_parts(pages), "wrapper-pages")
    each = raw.filter("text is not null").groupBy("host", "article", "path", "text").agg(
        F.max("words").alias("words"), F.max("links").alias("links")
    )
    each = stored(each, "wrapper-parts")
    hosts = each.select("host", "article").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("articles"))
    hosts = stored(hosts, "wrapper-hosts")
    shown = (F.col("n") >= 2) & (F.col("n") >= F.col("articles") * HALF)
    texts = each.groupBy("host", "path", "text").agg(F.count(F.lit(1)).alias("n"))  # a text of an article's longest block shows once
    fixed = texts.filter("n >= 2").join(hosts, "host").filter(shown).groupBy("host").agg(
        F.collect_list(F.struct("path", "text")).alias("fixed")
    )
    paths = each.groupBy("host", "path", "article").agg(F.sum("words").alias("words"), F.sum("links").alias("links"))
    paths = paths.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("words").alias("words"), F.sum("links").alias("links"))
    lists = paths.filter("n >= 2 and 2 * links >= words").join(hosts, "host").filter(shown).groupBy("host").agg(
        F.collect_list("path").alias("lists")
    )
    slots = texts.groupBy("host", "path").agg(F.count(F.lit(1)).alias("texts"))
    parts = host_contents(raw.filter("text is null"), hosts).join(slots, ["host", "path"], "left").groupBy("host").agg(
        F.collect_list(F.struct("path", "prose", "texts", "content")).alias("parts"), F.flatten(F.collect_list("symbols")).alias("symbols"),
    )
    found = hosts.join(fixed, "host", "left").join(lists, "host", "left").join(parts, "host", "left")
    pack = F.udf(lambda *columns: packed(*([r.asDict(True) if hasattr(r, "asDict") else r for r in c or []] for c in columns)), "binary")
    return stored(found.withColumn("packed", pack("fixed", "lists", "parts")), "wrappers")


def packed(fixed: list[dict], lists: list[int], parts: list[dict]) -> bytes:
    return zlib.compress(json.dumps([[[f["path"], f["text"]] for f in fixed], lists, parts]).encode())


def unpacked(wrapper: bytes | None) -> Wrapper:
    fixed, lists, parts = json.loads(zlib.decompress(wrapper)) if wrapper else ([], [], [])
    return Wrapper(parts, set(map(tuple, fixed)), lists)


def extract(pages: DataFrame) -> DataFrame:
    """Main text of every page (page_id, url, html): page_id, url, text, n_chars.

    A null or empty html, and a page without words outside its furniture, gives an empty text.  Null urls form a host;
    repeated rows are read one by one; pages of any length are read whole, in time that grows with their length; an empty table
    gives no rows; other columns are ignored."""
    salt = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    wrappers = host_wrappers(pages).select(F.col("host").alias("_host"), F.col("packed").alias("_wrapper"), salt.alias("_salt"))
    rows = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("_host")).withColumn(
        "_salt", F.pmod(F.xxhash64("url", "html"), F.lit(SALTS)).cast("int")
    )
    joined = rows.join(wrappers, ["_host", "_salt"], "left").select("page_id", "url", "html", "_host", "_wrapper")

    def run(batches):
        for batch in batches:
            found, known = [], {}
            for i, (page, host) in enumerate(zip(batch.column("html").to_pylist(), batch.column("_host").to_pylist())):
                if host not in known:
                    known[host] = unpacked(batch.column("_wrapper")[i].as_py())
                found.append(text_of(page, known[host]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(found, pa.string()), pa.array(map(len, found), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    kind = pages.schema["page_id"].dataType.simpleString()
    return joined.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
