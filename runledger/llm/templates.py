"""Main text of web pages by deducing the template of each host.

1. Every page becomes a list of tokens: its block elements, named by a hash of
   their path of elements and classes, and its texts, by path and hash.
2. Over all pages of a host, each token (a page itself is one too) gets its occurrence vector, kept as a
   signature: pages and occurrences, and two commutative sums of a hash of
   (page, count).  Tokens of a host with equal vectors are an equivalence
   class.  The vectors are aggregates by (host, token), combined before they
   are shuffled, so a host with a third of all pages is a key of sums only.
3. A class is valid if it holds at least CLASS_SIZE element tokens on at
   least CLASS_PAGES pages; it is nested if its elements' parents belong to a
   valid class that occurs on all its pages.  Nested classes form the
   template; texts on every page of a host with CLASS_PAGES pages or more
   belong to it too.
4. Regions (an ``article`` or ``main`` element, else the containers that hold
   the blocks) whose start is a template token are slots of the template.  Per
   host the slots of articles are the main ones; without any, every slot with
   text that differs between pages and mostly isn't links, in any layout of
   the host (if there is none, the slot with the most text).
5. Extraction takes the blocks in the main slots of a page, without what is
   beside the text.  A block outside the template belongs to the slot around it.
   A page without text there (of a host of one page, or another layout) is
   held against its own regions.

Beside the text is what stands below menus, headers, footers, asides and forms
by element, or below elements whose class, id or role says so.  A name says so
if one of its parts is a word for it and the others are words for layout
(``comment-list``, not ``social-history`` or ``has-sidebar``).  Words alone
don't decide: they don't count on html and body, on what holds the page's only
main article, or, without articles, on what holds WRAPPER of the page's text.
Inside an article words that also name ordinary parts (discussion, related,
notice ...) count only with evidence: replies or a form inside, mostly links,
or the same text on every page of the host.  Headings in an article's own header are
its text, the rest of that header isn't.

Defined results: null or empty html gives the empty text; null urls make one
host; repeated rows keep their rows; character references are decoded once;
slots of equal text are all main ones; a text of any length is read whole, in
time that follows its length; an empty table gives no rows; columns besides id,
url and html are ignored.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runledger.llm.common import small_batches, stored

CLASS_SIZE, CLASS_PAGES, LINK_SHARE, WRAPPER = 2, 2, 0.5, 0.8

#: Element names by role, and words in class, id or role that name what isn't main text.
BLOCKS = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset
h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody td
tfoot th thead title tr ul""".split())
SINGLE = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea iframe object svg math canvas audio video button".split())
ASIDE = frozenset("nav header footer aside form head title select menu dialog search fieldset option legend".split())
ASIDE_WORDS = frozenset("""ad ads advert adverts advertisement advertising sponsor sponsored banner sidebar nav navbar navigation breadcrumb
breadcrumbs cookie cookies consent gdpr newsletter subscribe subscription signup login share sharing comment comments disqus respond popup
modal overlay toolbar pagination pager contentinfo complementary""".split())
DOUBTFUL_WORDS = frozenset("menu notice promo promotion social related recommended recommendations discussion replies widget widgets alert".split())
LAYOUT_WORDS = frozenset("""area bar block body bottom box button buttons card col column container content footer form group header inner item items
left link links list main outer panel right row section side title top wrap wrapper""".split())
REPLY_WORDS = frozenset("comment comments reply replies respond disqus".split())
TOP_WORDS = frozenset("header footer masthead topbar".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
MAIN = frozenset("article main".split())
#: Elements that are regions of their own outside the main ones.
CONTAINERS = frozenset("body center div section td".split())
#: An opened element ends an open one of the same row, but not beyond the third's elements.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
        "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}

#: A quoted value may hold any character; a quote that doesn't follow = is an ordinary one.
TAG = re.compile(r"""<(?:(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+')?|["'])*+)>|!--|[!?][^>]*>)""")
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
WORD, NAME = re.compile(r"[a-z]+"), re.compile(r"\S+")
END_OF = {name: re.compile(rf"</{name}\s*>", re.I) for name in RAW}


class Element:
    """An open block element: its path (hash) and region, what its names say, and what the whole page says of it."""
    __slots__ = ("name", "parent", "path", "region", "inside", "main", "by_name", "by_word", "doubtful", "reply", "answered", "chars", "links", "void", "aside",
                 "cut", "top", "heading", "unsure", "kept")

    def __init__(self, name: str, attributes: str, parent: Element | None):
        names = [WORD.findall(n) for m in NAMES.finditer(attributes) for n in NAME.findall((m[1] or m[2] or m[3] or "").lower())] if attributes else []
        words = [w for n in names for w in n]
        self.name, self.parent = name, parent
        self.path = _hash(parent.path, name, *words) if parent else 0
        main = name in MAIN or (name == "div" and "main" in words and 'role="main"' in attributes)
        above = bool(parent and parent.inside)
        self.inside, self.main = above or main, main and not above
        self.region = self.path if not parent or self.main or (name in CONTAINERS and not above) else parent.region
        self.by_name = name in ASIDE
        says = [n for n in names if n and all(w in ASIDE_WORDS or w in DOUBTFUL_WORDS or w in LAYOUT_WORDS for w in n)] if name not in ("html", "body") else []
        self.by_word = any(not ASIDE_WORDS.isdisjoint(n) for n in says) or (not self.inside and name not in ("html", "body") and not TOP_WORDS.isdisjoint(words))
        self.doubtful = any(not DOUBTFUL_WORDS.isdisjoint(n) for n in says)
        self.reply = name == "form" or not REPLY_WORDS.isdisjoint(words)
        self.chars = self.links = 0
        self.void = self.answered = False


def judge(elements: list[Element], blocks: list[tuple[Element, str, int]]) -> None:
    """Say of every element whether its own text is beside the main text (``aside``) or perhaps so (``unsure``); parents come before children."""
    for e, text, links in blocks:
        e.chars += len(text)
        e.links += links
    for e in reversed(elements):
        if e.parent:
            e.parent.chars += e.chars
            e.parent.links += e.links
            e.parent.answered |= e.reply or e.answered
    mains = [e for e in elements if e.main and not e.by_word and not e.doubtful]
    for e in elements:
        e.aside = bool(e.parent and e.parent.aside) or e.by_word or (e.doubtful and not e.inside) or (e.by_name and not e.inside)
    if mains and all(e.aside for e in mains):
        at: Element | None = max(mains, key=lambda e: e.chars)  # the first of equal ones
        while at:
            at.void, at = True, at.parent
    total = elements[0].chars
    for e in elements:
        above = e.parent
        void = e.void or (not mains and total > 0 and e.chars >= WRAPPER * total)
        top = e.name == "header" and bool(above and above.inside)
        word = not void and (e.by_word or (e.doubtful and (not e.inside or e.answered or e.links > LINK_SHARE * e.chars)))
        e.cut = bool(above and above.cut) or word or (e.by_name and not top)
        e.top = top or bool(above and above.top)
        e.heading = e.name in HEADINGS or bool(above and above.heading)
        e.aside = e.cut or (e.top and not e.heading)
        e.unsure = bool(above and above.unsure) or (e.doubtful and e.inside and not void)


def _hash(*parts) -> int:
    return _signed(xxhash.xxh64_intdigest("\x1f".join(map(str, parts)), 0))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def parse(html: str) -> tuple[dict[tuple[int, int], int], list[tuple[Element, str, int]], list[Element]]:
    """Counts of (path, parent's path), blocks of text (element, text, characters of links), and the elements, judged."""
    root = Element("", "", None)
    stack, paths, blocks, elements = [root], defaultdict(int), [], [root]
    buffer: list[str] = []
    link = linked = 0

    def flush() -> None:
        nonlocal linked
        if buffer:
            text = "".join(buffer)
            text = " ".join((unescape(text) if "&" in text else text).split())
            if text:
                blocks.append((stack[-1], text, min(linked, len(text))))
            buffer.clear()
        linked = 0

    at, size = 0, len(html)
    while at < size:
        m = TAG.search(html, at)
        text = html[at:m.start() if m else size]
        if text:
            buffer.append(text)
            if link:
                linked += len(text)
        if not m:
            break
        at = m.end()
        name = m[2]
        if name is None:
            if m[0] == "<!--":
                end = html.find("-->", at)
                at = size if end < 0 else end + 3
            continue
        name = name.lower()
        if name in BLOCKS:
            flush()
            if m[1]:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].name == name:
                        del stack[i:]
                        break
                continue
            if stack[-1].name == "p":
                stack.pop()
            same, stop = ENDS.get(name, ((), ()))
            for i in range(len(stack) - 1, 0, -1) if same else ():
                if stack[i].name in stop:
                    break
                if stack[i].name in same:
                    del stack[i:]
                    break
            element = Element(name, m[3], stack[-1])
            elements.append(element)
            paths[element.path, stack[-1].path] += 1
            if name not in SINGLE and not m[3].endswith("/"):
                stack.append(element)
        elif m[1]:
            if name == "a":
                link = 0
        elif name in RAW:
            if not m[3].endswith("/"):
                end = END_OF[name].search(html, at)
                at = end.end() if end else size if name in ("script", "style") else at
        elif name == "br":
            buffer.append(" ")
        elif name == "a":
            link = 1
    flush()
    judge(elements, blocks)
    return paths, blocks, elements


HOST = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)"
#: A token is a page (no path), an element (path and parent) or a text (path, region and hash).
#: Of a text: 0 main, 1 beside the main text, 2 perhaps beside it.
TOKEN = "host string, path long, parent long, region long, text long, state int, named boolean"
TOKENS = f"{TOKEN}, pages long, n long, mark long, sum long, chars long, links long"
KEY = [c.split()[0] for c in TOKEN.split(", ")]
_TYPES = [pa.string(), *[pa.int64()] * 4, pa.int32(), pa.bool_(), *[pa.int64()] * 6]


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences of the tokens of each batch, combined by host and token."""
    for b in batches:
        total: dict[tuple, list] = {}

        def add(key: tuple, page: int, count: int, chars: int, links: int) -> None:
            h = _hash(page, count)
            row = total.get(key)
            if row is None:
                total[key] = [1, count, h, h & 0xFFFFF, chars, links]
            else:
                row[0] += 1
                row[1] += count
                row[2] ^= h
                row[3] += h & 0xFFFFF
                row[4] += chars
                row[5] += links

        for page_id, host, html in zip(*[c.to_pylist() for c in b.columns]):
            paths, blocks, _ = parse(html)
            page = _hash(page_id, html)
            add((host, None, None, None, None, 0, False), page, 1, 0, 0)
            texts: dict[tuple, list] = defaultdict(lambda: [0, 0, 0])
            for element, text, links in blocks:
                own = texts[element.path, None, element.region, _hash(text), 1 if element.aside else 2 if element.unsure else 0, element.inside]
                own[0] += 1
                own[1] += len(text)
                own[2] += links
            for (path, parent), n in paths.items():
                add((host, path, parent, None, None, 0, False), page, n, 0, 0)
            for key, (n, chars, links) in texts.items():
                add((host, *key), page, n, chars, links)
        if total:
            rows = [(*k, *v) for k, v in total.items()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], [c.split()[0] for c in TOKENS.split(", ")])


def _keyed(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    host = F.lower(F.coalesce(F.regexp_extract(F.col(url_col).cast("string"), HOST, 1), F.lit("")))
    return pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), host.alias("host"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"))


def deduce(keyed: DataFrame) -> DataFrame:
    """(host, named, regions, others, fixed): whether the host's template has article slots, its main slots and its other
    slots outside articles, and the doubtful texts that all of its pages share.  The arrays hold template tokens."""
    seen = keyed.select("id", "host", "html").mapInArrow(_tokens, TOKENS)
    tokens = stored(seen.groupBy(*KEY).agg(*[F.sum(c).alias(c) for c in ("pages", "n", "sum", "chars", "links")], F.bit_xor("mark").alias("mark")), "tokens")
    # a page is a token as well: what stands once on every page is in its class
    elements, vector = tokens.where("text is null"), ["host", "pages", "n", "mark", "sum"]
    classes = elements.groupBy(*vector).agg(F.count(F.lit(1)).alias("size")).where((F.col("size") >= CLASS_SIZE) & (F.col("pages") >= CLASS_PAGES))
    valid = stored(elements.where("path is not null").join(classes, vector).select("host", "path", "parent", "pages"), "classes")
    above = valid.select("host", F.col("path").alias("parent"), F.col("pages").alias("above"))
    nested = valid.join(above, ["host", "parent"], "left").where("parent = 0 or pages <= above")
    # summed by region and page count first, so that few rows of a host meet on the host alone
    hosts = tokens.where("path is null").select("host", F.col("pages").alias("of"))
    texts = tokens.where("text is not null and state <> 1").groupBy("host", "region", "named", "pages").agg(F.sum("chars").alias("chars"), F.sum("links").alias("links"))
    fixed = (F.col("pages") == F.col("of")) & (F.col("of") >= CLASS_PAGES)
    regions = texts.join(hosts, "host").groupBy("host", "region", "named").agg(
        F.sum("chars").alias("chars"), F.sum("links").alias("links"), F.sum(F.when(fixed, 0).otherwise(F.col("chars"))).alias("free"))
    slots = regions.join(nested.select("host", F.col("path").alias("region")).distinct(), ["host", "region"])
    prose = F.col("links") <= LINK_SHARE * F.col("chars")
    good = ~F.col("named") & prose & (F.col("free") > 0)
    chosen = slots.groupBy("host").agg(
        F.max("named").alias("named"), F.collect_set(F.when(good, F.col("region"))).alias("good"), F.collect_set(F.when(~F.col("named"), F.col("region"))).alias("every"),
        F.max_by(F.when(~F.col("named"), F.col("region")), F.struct(~F.col("named"), prose, "chars", "region")).alias("most"))
    regions = F.when(F.size("good") > 0, F.col("good")).when(F.col("most").isNotNull(), F.array("most")).otherwise(F.expr("cast(array() as array<long>)"))
    chosen = chosen.select("host", "named", regions.alias("regions"), F.array_except("every", regions).alias("others"))
    doubtful = tokens.where("state = 2").groupBy("host", "text").agg(F.max("pages").alias("pages")).join(hosts, "host").where(fixed)
    doubtful = doubtful.groupBy("host").agg(F.collect_set("text").alias("fixed"))
    return stored(chosen.join(doubtful, "host", "full"), "slots")


def _chosen(parsed: tuple, named: bool, regions: list[int], others: list[int], fixed: list[int]) -> list[str]:
    """Texts of the main slots; of a page that has none there, of its own regions."""
    _, blocks, elements = parsed
    fixed = set(fixed)
    free = [(e, t, n) for e, t, n in blocks if not e.aside and not (e.unsure and fixed and _hash(t) in fixed)]
    articles = [t for e, t, _ in free if e.inside]
    if articles and (named or not regions):
        return articles
    good, bad = set(regions), set(others)
    for e in elements:  # by the innermost slot around it
        e.kept = e.path in good if e.path == e.region and (e.path in good or e.path in bad) else bool(e.parent and e.parent.kept)
    own = [t for e, t, _ in free if e.kept]
    if own or not free:
        return own
    if articles:
        return articles
    total: dict[int, list[int]] = defaultdict(lambda: [0, 0])
    for e, t, n in free:
        total[e.region][0] += len(t)
        total[e.region][1] += n
    prose = {r for r, (chars, links) in total.items() if links <= LINK_SHARE * chars} or {max(total, key=lambda r: (total[r][0], r))}
    return [t for e, t, _ in free if e.region in prose]


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per page: id, url, text."""
    small_batches(pages.sparkSession)
    keyed = _keyed(pages, id_col, url_col, html_col)
    slots = deduce(keyed)
    lists = [F.coalesce(c, F.expr("cast(array() as array<long>)")).alias(c) for c in ("regions", "others", "fixed")]
    joined = keyed.join(slots, "host", "left").select("id", "url", "html", F.coalesce("named", F.lit(False)).alias("named"), *lists)
    schema = joined.select("id", "url", F.lit("").alias("text")).schema

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [" ".join(_chosen(parse(html), *slots)) for html, *slots in zip(*[c.to_pylist() for c in b.columns[2:]])]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string())], ["id", "url", "text"])

    return joined.mapInArrow(extract, schema)
