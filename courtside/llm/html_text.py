"""Main text of web pages, with templates of the site removed.

Every element of a page is a subtree, hashed from the leaves up over its tag,
its text and the hashes of what it holds. Spark counts on how many pages of a
host, of different content, each hash occurs; a subtree that recurs on many is
part of the site's template and is deleted with what it holds. Elements that are
boilerplate by their tag, role or class are deleted too. Nothing else is: an
article is a hint only. What stands in one counts once for all copies of it. Its
blocks go only if they recur in a good share of the host's articles,
paragraphs and headings if they do in most, and items, cells and captions
only with the whole list, table or figure they belong to.
"""

from __future__ import annotations

import html as entities
import re

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtside.llm.common import each_text, stored_copy

# A subtree is a template from so many pages of a host on, whatever the host's size.
MIN_PAGES = 10
# On a host with few pages it is one on this share of them, from so many on.
FEW_PAGES = 4
FEW_SHARE = 0.5
# Inside an article, blocks are templates from MIN_PAGES different articles on that
# are this share of the host's; paragraphs and headings from so many, and this share.
ARTICLE_SHARE = 0.5
MIN_PROSE_PAGES = 20
PROSE_SHARE = 0.8
# Templates sent along, of some ten bytes each.
MAX_SENT = 200_000

# Kinds of elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q ruby rb rp rt s samp small span strike strong sub sup time tt u var wbr img".split()
)
BOILERPLATE = frozenset(
    "nav header footer aside form script style noscript template menu dialog button select input textarea iframe svg canvas object head title".split()
)
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre".split())
# Parts of a list, table or figure: no templates by themselves inside an article, and cells nowhere.
PARTS = frozenset("li td th tr thead tbody tfoot caption colgroup dt dd figcaption".split())
CELLS = frozenset("td th tr thead tbody tfoot caption colgroup".split())
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
# An element closes an open one of these by itself, up to the boundary.
CLOSES_SAME = {"li": ("li", frozenset("ul ol menu".split())), "dt": ("dt dd", frozenset(["dl"])), "dd": ("dt dd", frozenset(["dl"]))}
CLOSES_SAME |= {"tr": ("tr td th", frozenset(["table"])), "td": ("td th", frozenset("tr table".split())), "th": ("td th", frozenset("tr table".split()))}
CLOSES_SAME |= {"option": ("option", frozenset(["select"]))}
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar form".split())
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus "
    "menu modal nav navbar navigation newsletter notice popup promo promoted promotion related share sharing sidebar signup social sponsor "
    "sponsored subscribe subscription toolbar widget".split()
)
ENDS = frozenset(["header", "footer"])
OF_SITE = frozenset("site page global main top bottom masthead".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_ATTRIBUTE = re.compile(r"([a-zA-Z_:][-a-zA-Z0-9_:.]*)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_HOST = re.compile(r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", re.I)


def host_of(url: str | None) -> str:
    """The host of a URL in lower case, without port; empty if there is none."""
    m = _HOST.match((url or "").strip())
    return m[1].lower() if m else ""


def _is_boilerplate(tag: str, attributes: str, in_article: bool) -> bool:
    if tag in BOILERPLATE:
        return not (tag == "header" and in_article and "class" not in attributes)
    if not attributes.strip():
        return False
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "role" and value in ROLES:
            return True
        if name == "style" and re.search(r"display\s*:\s*none", value):
            return True
        if name in ("class", "id") and tag not in ("body", "html", "article", "main") and any(map(_names_boilerplate, value.split())):
            return True
    return False


def _names_boilerplate(name: str) -> bool:
    """Whether a class or id names boilerplate; the header of an article or a section does not."""
    parts = set(re.split(r"[^a-z0-9]+", name)) - {""}
    return bool(parts & NAMES) or bool(parts & ENDS and parts <= ENDS | OF_SITE)


class Element:
    __slots__ = ("tag", "attributes", "parent", "boilerplate", "in_article", "prose", "holds", "key")

    def __init__(self, tag, attributes, parent, boilerplate, in_article, prose):
        self.tag, self.attributes, self.parent = tag, attributes, parent
        self.boilerplate, self.in_article, self.prose = boilerplate, in_article, prose
        self.holds: list[str | Element] = []  # text and elements, in order
        self.key: int | None = None


class Page:
    """The elements of a page and its text chunks, in page order."""

    def __init__(self, source: str | None):
        self.source = source or ""
        self.elements: list[Element] = []
        self.chunks: list[tuple[Element | None, str, bool]] = []  # element, text, whether a break stands before it
        self.open: dict[str, int] = {}  # number of open elements by name
        self._parse()
        self._listed: list[tuple[int, Element]] | None = None

    def _open(self, tag: str, attributes: str, top: Element | None) -> Element:
        in_article = tag in ("article", "main") or (top is not None and top.in_article)
        boilerplate = (top is not None and top.boilerplate) or _is_boilerplate(tag, attributes, in_article)
        prose = in_article and (tag in PROSE or (top is not None and top.prose))
        element = Element(tag, attributes, top, boilerplate, in_article, prose)
        self.elements.append(element)
        if top is not None:
            top.holds.append(element)
        return element

    def _shut(self, top: Element, last: Element) -> Element | None:
        """The element around ``last``, with all from ``top`` up to it closed."""
        while True:
            self.open[top.tag] -= 1
            if top is last:
                return top.parent
            top = top.parent

    def _add(self, element: Element | None, text: str, broken: bool) -> None:
        self.chunks.append((element, text, broken))
        if element is not None:
            element.holds.append(text)

    def _parse(self) -> None:
        source, at, top, broken = self.source, 0, None, True
        position = 0
        while position < len(source):
            m = _TOKEN.search(source, position)
            text_end = m.start() if m else len(source)
            if text_end > at:
                self._add(top, source[at:text_end], broken)
                broken = False
            if not m:
                break
            at = position = m.end()
            tag = (m[2] or "").lower()
            if not tag:
                continue
            if m[1]:
                if self.open.get(tag):
                    found = top
                    while found.tag != tag:
                        found = found.parent
                    top = self._shut(top, found)
            else:
                if tag in CLOSES_P:
                    top = self._close(top, ("p",), frozenset("article main body td th li div section".split()))
                if tag in CLOSES_SAME:
                    names, boundary = CLOSES_SAME[tag]
                    top = self._close(top, names.split(), boundary)
                element = self._open(tag, m[3], top)
                if tag in VOID or m[3].endswith("/"):
                    pass
                elif tag in RAW:
                    end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(source, m.end())
                    stop = end.start() if end else len(source)
                    if tag in ("script", "style"):
                        element.holds.append(source[m.end() : stop])
                    elif stop > m.end():
                        self._add(element, source[m.end() : stop], True)
                    at = position = end.end() if end else len(source)
                else:
                    top = element
                    self.open[tag] = self.open.get(tag, 0) + 1
            broken = broken or tag not in INLINE

    def _close(self, top: Element | None, names, boundary: frozenset) -> Element | None:
        """``top`` after the nearest open element of these names is closed, if no boundary is nearer."""
        if not any(self.open.get(n) for n in names):
            return top
        found = top
        while found is not None and found.tag not in names:
            if found.tag in boundary:
                return top
            found = found.parent
        return top if found is None else self._shut(top, found)

    def subtrees(self) -> list[tuple[int, Element]]:
        """(hash, element) of every element that may be a template: blocks but for what holds the page, and parts of what goes as a whole.

        Hashes are put together from the leaves up, each from the hashes right
        below it. The two lowest bits tell whether an element stands in an
        article, and whether it is prose there or an article.
        """
        if self._listed is not None:
            return self._listed
        self._listed = []
        digests: dict[int, bytes] = {}
        for e in reversed(self.elements):  # what an element holds comes after it
            mixed = xxhash.xxh3_64(f"{e.tag} {' '.join(e.attributes.split())}".encode("utf-8", "surrogatepass"))
            for held in e.holds:
                if isinstance(held, str):
                    text = " ".join(held.split())
                    if text:
                        mixed.update(b"\0" + text.encode("utf-8", "surrogatepass"))
                else:
                    mixed.update(b"\1" + digests.pop(id(held)))
            digests[id(e)] = mixed.digest()
            e.key = (mixed.intdigest() & ~3 | 2 * e.in_article | (e.prose or e.tag == "article")) - (1 << 63)
            if not (e.tag in INLINE or e.tag in VOID or e.tag in ("html", "head", "body", "main") or e.tag in (PARTS if e.in_article else CELLS)):
                self._listed.append((e.key, e))
        return self._listed

    def evidence(self) -> tuple[int, int | None, list[int], list[int]]:
        """Hashes of the page's text outside boilerplate and of its articles, if any; the keys outside articles, and those inside one.

        Copies count as one page: of the whole text for what stands outside
        articles, of the articles for what stands in them.
        """
        found = self.subtrees()
        digest = lambda t: xxhash.xxh3_64_intdigest(t.encode("utf-8", "surrogatepass")) - (1 << 63)
        articles = [e.key for e in self.elements if e.tag in ("article", "main") and not (e.parent is not None and e.parent.in_article)]
        outside, inside = (sorted({key for key, e in found if e.in_article == where}) for where in (False, True))
        return digest(self.text(frozenset())), digest(repr(articles)) if articles else None, outside, inside

    def text(self, templates: frozenset | None = None) -> str:
        """Text outside boilerplate and templates. Where templates were not looked for (None), of the articles only, if the page has one."""
        goes = {id(e) for key, e in self.subtrees() if key in templates} if templates else ()
        hinted = templates is None and any(e.tag in ("article", "main") and not e.boilerplate for e in self.elements)
        deleted: dict[int, bool] = {}

        def gone(e: Element | None) -> bool:
            path = []
            while e is not None and id(e) not in deleted:
                path.append(e)
                e = e.parent
            state = deleted[id(e)] if e is not None else False
            for x in reversed(path):
                state = deleted[id(x)] = state or x.boilerplate or id(x) in goes
            return state

        parts, pending = [], True
        for element, raw, broken in self.chunks:
            pending = pending or broken
            if gone(element) or (hinted and not (element is not None and element.in_article)):
                pending = True
                continue
            parts.append((" " if pending else "") + entities.unescape(raw))
            pending = False
        return " ".join("".join(parts).split())


def _described(digest, url, source):
    return digest, host_of(url), *Page(source).evidence()


def described(pages: DataFrame) -> DataFrame:
    """(digest, host, content, articles, keys, inside) of every different page, stored: each page is parsed once for it."""
    digest = F.xxhash64(F.coalesce("url", F.lit("")), F.coalesce("html", F.lit("")))
    rows = pages.select(digest.alias("digest"), "url", "html")
    schema = "digest long, host string, content long, articles long, keys array<long>, inside array<long>"
    return stored_copy(each_text(rows, _described, ["digest", "url", "html"], schema).distinct(), "subtrees")


def site_templates(found: DataFrame, min_pages: int = MIN_PAGES, few_share: float = FEW_SHARE) -> DataFrame:
    """(host, key) of ``described`` pages: subtrees that recur on many pages of a host with different content.

    A host's pages are counted by content first, so no task holds a host. Outside
    articles a subtree recurs from ``min_pages`` pages on, or on ``few_share`` of
    a host's pages. Inside, it takes so many articles that are
    ``ARTICLE_SHARE`` of the host's, and for prose ``MIN_PROSE_PAGES`` that are
    ``PROSE_SHARE`` of them.
    """
    sizes = found.select("host", "content").distinct().groupBy("host").agg(F.count("*").alias("n_pages"))
    articles = found.where("articles is not null").select("host", "articles").distinct().groupBy("host").agg(F.count("*").alias("n_articles"))
    sizes = sizes.join(articles, "host", "left")
    seen = lambda key: F.struct(F.col("content" if key == "keys" else "articles").alias("content"), F.col(key).alias("keys"))
    seen = found.select("host", F.explode(F.array(seen("keys"), seen("inside"))).alias("s")).select("host", "s.content", F.explode("s.keys").alias("key"))
    counts = seen.distinct().groupBy("host", "key").agg(F.count("*").alias("n"))
    prose, inside = F.col("key").bitwiseAND(1) == 1, F.col("key").bitwiseAND(2) == 2
    part = lambda least, share: (F.col("n") >= least) & (F.col("n") >= share * F.col("n_articles"))
    in_article = F.when(prose, part(max(min_pages, MIN_PROSE_PAGES), PROSE_SHARE)).otherwise(part(min_pages, ARTICLE_SHARE))
    outside = (F.col("n") >= min_pages) | (F.col("n") >= few_share * F.col("n_pages"))
    many = counts.where(F.col("n") >= FEW_PAGES).join(sizes, "host").where(F.when(inside, in_article).otherwise(outside))
    return stored_copy(many.select("host", "key"), "templates")


def main_text(pages: DataFrame, min_pages: int = MIN_PAGES, few_share: float = FEW_SHARE, max_sent: int = MAX_SENT) -> DataFrame:
    """page_id, url, text, n_chars, n_template of every row of ``pages`` (page_id, url, html, any others).

    ``n_template`` is the number of template subtrees found on the page. NULL
    html is an empty page with empty text; pages without a host are one host;
    repeated rows give repeated results, and copies count once as evidence of a
    template. Up to ``max_sent`` templates are sent to the tasks by host; with
    more of them each page's own are joined to it.
    """
    found = described(pages)
    templates = site_templates(found, min_pages, few_share)
    schema = "page_id long, url string, text string, n_chars long, n_template long"
    rows = templates.limit(max_sent + 1).collect()
    if len(rows) <= max_sent:
        by_host: dict[str, set[int]] = {}
        for r in rows:
            by_host.setdefault(r["host"], set()).add(r["key"])
        sent = pages.sparkSession.sparkContext.broadcast(by_host)
        return each_text(pages, lambda i, url, source: _text_row(i, url, source, sent.value.get(host_of(url))), ["page_id", "url", "html"], schema)
    own = found.select("digest", "host", F.explode(F.concat("keys", "inside")).alias("key")).join(templates, ["host", "key"])
    own = own.groupBy(F.col("digest").alias("_digest")).agg(F.collect_set("key").alias("keys"))
    digest = F.xxhash64(F.coalesce("url", F.lit("")), F.coalesce("html", F.lit("")))
    joined = pages.select("page_id", "url", "html", digest.alias("digest")).join(own, F.col("digest") == F.col("_digest"), "left")
    return each_text(joined, _text_row, ["page_id", "url", "html", "keys"], schema)


def _text_row(page_id, url, source, keys):
    page, keys = Page(source), frozenset(keys or ())
    text = page.text(keys)
    return page_id, url, text, len(text), len(keys & {key for key, _ in page.subtrees()}) if keys else 0
