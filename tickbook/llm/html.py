"""Main text of web pages by consensus host paths.

Every page is scanned into a light tree; blocks of text (paragraphs, list
items, headings, table cells) score the containers around them by their length
without links, lowered for class names of menus, adverts and the like.  The
best container of a page, or the one around it if it is only a part of an
article, votes for its generalised tag-class path (digits dropped, classes
sorted).  Spark counts the votes per host, and every page is extracted again
below its host's winning path: all containers on that path, in page order.  A
page without that path, or with a teaser only on it, is extracted below its own.

Elements are left out by tag, role and attribute, and by class or id where the
whole name marks boilerplate (``_marked``); a page of which that would leave
next to nothing is read without names.
"""

from __future__ import annotations

import bisect
import html as entities
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T
from .urls import host_and_path

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
_ATTR = re.compile(r"([^\s=/\"'<>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style noscript template iframe textarea title xmp noembed noframes svg math".split())
_BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure "
                   "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre "
                   "section select summary table tbody td tfoot th thead tr ul".split())
_CONTAINER = frozenset("article div main section td center blockquote".split())
_SKIP = frozenset("nav aside footer form script style noscript template head menu button select dialog iframe svg "
                  "textarea object embed canvas audio video map math".split())
_CLOSES = {  # a start tag of the key ends an open element of the values, up to the nearest barrier
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"})}
_BARRIER = frozenset("article aside body div footer form header main nav section table td th ul ol dl".split())
# words that mark boilerplate in a class or id, with words that may stand beside them
_AD_WORD = re.compile(r"(?:ad|ads|advert\w*|sponsor\w*|promo\w*|newsletter|subscribe|signup|share|sharing|social|breadcrumb\w*|skip|hidden)$")
_BAD_WORD = re.compile(r"(?:ad|ads|advert\w*|banner|sponsor\w*|promo\w*|cookie\w*|consent|notice|notices|alert|popup|modal|"
                       r"newsletter|subscribe|signup|share|sharing|social|related|recommend\w*|sidebar|side|widget|breadcrumb\w*|"
                       r"menu|nav\w*|navigation|footer|comment|comments|commentlist|disqus|replies|respond|"
                       r"login|search|pager|pagination|toolbar|skip|hidden|legal|copyright)$")
_BESIDE = frozenset("area article articles bar block body bottom box button buttons col column container content desktop fixed form "
                    "global group header icon icons info inner item items left link links list main message mobile module outer page "
                    "panel post posts primary region right row secondary section site slot stories sub text thread title top unit "
                    "wrap wrapper zone".split())
_STATE = re.compile(r"(?:no|not|non|has|with|without|is|js|hide|show|hides|shows)$")     # first words that tell of something else
_WORDS = re.compile(r"[a-z]+")
_TEXT_TAG = frozenset("p span h1 h2 h3 h4 h5 h6 a abbr b cite code dfn em font i mark pre q s small strong sub sup u".split())
_WITH_ID = frozenset("aside center div footer header ol section table td ul".split())
_ARTICLE_IN_FORM = re.compile(r"<(?:article|main)\b", re.I)
FAIR_SHARE = 0.2        # of what the page's own best holds: the least for which the host's path counts
FEW = 140               # characters; a page left with fewer is read again without regard to class words
_BAD_ROLE = frozenset("navigation banner contentinfo complementary search form dialog alert".split())
_GOOD = re.compile(r"article|content|main|post|story|entry|text|body", re.I)
_HEADER = re.compile(r"(?:^|[-_ ])(?:header|masthead)(?:$|[-_ ])", re.I)
_HEADING = re.compile(r"h[1-6]$")
_KEEP = frozenset(("html", "body", "article", "main"))    # class names do not make these boilerplate
_PART = frozenset("section td center blockquote".split())  # may be parts of what is around them
_NOTHING, _ALL_BUT_HEADINGS, _ALL = 0, 1, 2               # what of an element is left out


class _Open:
    __slots__ = ("tag", "path", "skip", "node", "link", "named")

    def __init__(self, tag, path, skip, node, link=False, named=False):
        self.tag, self.path, self.skip, self.node = tag, path, skip, node
        self.link = link        # in a link
        self.named = named      # left out for its class or id, or inside such an element


def _marked(tag: str, attrs: dict[str, str]) -> bool:
    """Whether a class or id says that the element is no part of an article.

    A name counts if one of its words is a mark and all others only go beside marks, so
    'site-nav' and 'related-posts' do, 'share-price', 'search-algorithms' and
    'no-sidebar' do not.  Of an element within a text only marks of adverts
    and the like count; an id counts for parts of a page only."""
    names = attrs.get("class", "").lower().split()
    if tag in _WITH_ID:
        names += attrs.get("id", "").lower().split()
    marks = _AD_WORD if tag in _TEXT_TAG else _BAD_WORD
    for name in names:
        words = _WORDS.findall(name)
        if words and not _STATE.match(words[0]) and any(marks.match(w) for w in words) and all(
                w in _BESIDE or _BAD_WORD.match(w) for w in words):
            return True
    return False


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): entities.unescape(m[2] or m[3] or m[4] or "") for m in _ATTR.finditer(raw)}


def _label(tag: str, attrs: dict[str, str]) -> str:
    """Tag and classes with digits dropped."""
    names = sorted({re.sub(r"\d+", "", c.lower()) for c in attrs.get("class", "").split()} - {""})
    return ".".join([tag, *names])


class Page:
    """Containers (path, parent, score) and blocks (text, container) of one page.

    ``by_name``: leave out what classes and ids mark; else such containers only score less."""

    def __init__(self, source: str, by_name: bool = True):
        self.by_name = by_name
        self.named = 0                          # characters left out for a class or id
        self._forms: list[int] | None = None    # where forms end
        self._held: dict[int, bool] = {}        # by that place: whether an article is in the form
        self.paths: list[str] = ["/body"]       # the root, with or without its tags
        self.parents: list[int] = [-1]
        self.tags: list[str] = [""]
        self.plain: list[float] = [0.0]         # characters outside links, at any depth
        self.scores: list[float] = [0.0]
        self.blocks: list[tuple[int, str]] = []
        self._stack = [_Open("", "/body", _NOTHING, 0)]
        self._text: list[str] = []
        self._link = 0
        self._size = 0
        self._read(source)
        self._flush()
        self.last = list(range(len(self.paths)))    # a container's inner ones follow it, up to this one
        for i in range(len(self.paths) - 1, 0, -1):
            up = self.parents[i]
            self.plain[up] += self.plain[i]
            self.last[up] = max(self.last[up], self.last[i])

    def _flush(self):
        text = " ".join(entities.unescape("".join(self._text)).split()) if self._text else ""
        if text:
            node = self._stack[-1].node
            self.blocks.append((node, text))
            plain = max(0.0, len(text) - 2.0 * self._link)
            self.plain[node] += plain
            weight = min(plain, 2000.0) + (20.0 if plain > 80 else 0.0)
            share = 1.0
            while node >= 0 and share > 0.2:
                self.scores[node] += weight * share
                node, share = self.parents[node], share * 0.6
        self._text, self._link, self._size = [], 0, 0

    def _add(self, data: str):
        top = self._stack[-1]
        if data and top.skip == _NOTHING:
            self._text.append(data)
            if top.link:
                self._link += len(data.strip())
        elif data and top.named:
            self.named += len(data.strip())

    def _holds_article(self, source: str, at: int) -> bool:
        """Whether the form that starts before ``at`` holds an article or several paragraphs."""
        if self._forms is None:
            self._forms = [m.start() for m in re.finditer(r"</form\b", source, re.I)]
        k = bisect.bisect_left(self._forms, at)
        end = self._forms[k] if k < len(self._forms) else len(source)
        if end not in self._held:               # of forms in a form the outer one decides
            inside = source[at:end]
            self._held[end] = bool(_ARTICLE_IN_FORM.search(inside)) or len(re.findall(r"<p\b", inside, re.I)) >= 3
        return self._held[end]

    def _start(self, tag: str, raw: str, source: str, at: int):
        if tag == "br":
            self._add("\n")
            return
        if tag in _BLOCK:
            self._flush()
            self._end_open({"p"}, _BARRIER)
        if tag in _CLOSES:
            self._end_open(*_CLOSES[tag])
        if tag in _VOID:
            return
        top = self._stack[-1]
        attrs = _attributes(raw) if raw.strip() else {}
        names = f"{attrs.get('class', '')} {attrs.get('id', '')}".strip()
        marked = bool(names) and tag not in _KEEP and _marked(tag, attrs)
        bad = ((tag in _SKIP and not (tag == "form" and self._holds_article(source, at))) or (marked and self.by_name)
               or attrs.get("role", "").lower() in _BAD_ROLE or "hidden" in attrs or attrs.get("aria-hidden") == "true"
               or "display:none" in attrs.get("style", "").replace(" ", "").lower())
        if top.skip == _ALL or bad:
            skip = _ALL
        elif tag == "header" or (names and tag not in _KEEP and _HEADER.search(names)):
            skip = _ALL_BUT_HEADINGS
        elif _HEADING.match(tag) and any(o.tag in ("article", "main") for o in self._stack):
            skip = _NOTHING
        else:
            skip = top.skip
        path = top.path if tag in ("html", "body") else f"{top.path}/{_label(tag, attrs)}"
        node = top.node
        if tag in _CONTAINER and skip == _NOTHING:
            node = len(self.paths)
            self.paths.append(path)
            self.parents.append(top.node)
            self.tags.append(tag)
            self.plain.append(0.0)
            self.scores.append(-200.0 if marked else 200.0 if tag in ("article", "main") or (names and _GOOD.search(names)) else 0.0)
        self._stack.append(_Open(tag, path, skip, node, top.link or tag == "a", top.named or (marked and self.by_name)))

    def _end_open(self, tags, barrier):
        for i in range(len(self._stack) - 1, 0, -1):
            if self._stack[i].tag in tags:
                if any(o.tag in _BLOCK for o in self._stack[i:]):
                    self._flush()
                del self._stack[i:]
                return
            if self._stack[i].tag in barrier:
                return

    def _end(self, tag: str):
        if tag == "br":
            self._add("\n")
            return
        if tag in _BLOCK:
            self._flush()
        for i in range(len(self._stack) - 1, 0, -1):
            if self._stack[i].tag == tag:
                if any(o.tag in _BLOCK for o in self._stack[i:]):
                    self._flush()
                del self._stack[i:]
                return
            if tag not in _BLOCK and self._stack[i].tag in _BARRIER:
                return          # a stray inline end tag closes nothing outside its block

    def _read(self, source: str):
        at, n = 0, len(source)
        while at < n:
            m = _TAG.search(source, at)
            if not m:
                self._add(source[at:])
                return
            self._add(source[at:m.start()])
            at = m.end()
            tag = m[2] or m[5]
            if not tag:
                continue
            tag = tag.lower()
            if m[1] or m[4]:
                self._end(tag)
                continue
            raw = m[3] or m[6] or ""
            if tag in _RAW and not raw.endswith("/"):
                close = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I)
                e = close.search(source, at)
                at = e.end() if e else n        # unclosed: the rest belongs to it
                continue
            self._start(tag, raw, source, at)

    def best(self) -> int:
        """The container with the highest score (the first of equals), or the one
        around it that holds the whole article."""
        node = max(range(len(self.paths)), key=lambda i: (self.scores[i], -i))
        while (up := self._whole(node)) != node:
            node = up
        return node

    def _on(self, path: str | None) -> list[int]:
        """The containers on ``path`` that hold text, in page order."""
        return [i for i in range(len(self.paths)) if self.paths[i] == path and self.plain[i] > 0]

    def _whole(self, node: int) -> int:
        """The container of which ``node`` is only a part, or ``node``: the article
        around it; for a section, cell or quotation also the main element, or
        what is next around it and holds a paragraph more; for one of several
        containers on a path, the one that holds them all, unless that is the
        page (a cell's others may be another column of the layout)."""
        if node <= 0:
            return max(node, 0)
        tag, around = self.tags[node], []
        up = self.parents[node]
        while up > 0:
            around.append(up)
            up = self.parents[up]
        for i in around:
            if self.tags[i] == "article" or (tag in _PART and self.tags[i] == "main"):
                return i
        same = self._on(self.paths[node])
        if tag in _PART and (around or tag == "blockquote"):
            up = self.parents[node]
            if self.plain[up] - sum(self.plain[i] for i in same if up < i <= self.last[up]) > 80:
                return up
        if len(same) > 1 and tag != "td":
            for i in around:
                if i < same[0] and self.last[i] >= same[-1]:
                    return i
        return node

    def text(self, nodes: list[int]) -> str:
        inside: set[int] = set()
        for i in nodes:
            inside.update(range(i, self.last[i] + 1))
        return "\n\n".join(t for c, t in self.blocks if c in inside)

    def at(self, path: str | None) -> list[int]:
        """All containers on ``path``, if they hold a fair share of what the page's best one
        holds (a teaser does not); else those on the path of the best one."""
        found, best = self._on(path), self.best()
        if found and sum(self.plain[i] for i in found) >= FAIR_SHARE * self.plain[best]:
            return found
        return self._on(self.paths[best]) or [best]


def read_page(source: str) -> Page:
    """The page; read again without regard to class words where those leave next to nothing of it."""
    page = Page(source)
    if page.plain[0] < FEW < page.named:
        again = Page(source, by_name=False)
        if again.plain[0] > page.plain[0]:
            return again
    return page


def votes(pages: DataFrame) -> DataFrame:
    """host, path, score: the best container of every page that has text."""

    def run(batches):
        for b in batches:
            hosts, paths, scores = [], [], []
            for host, source in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                page = read_page(source or "")
                if page.blocks:
                    k = page.best()
                    hosts.append(host)
                    paths.append(page.paths[k])
                    scores.append(page.scores[k])
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(paths, pa.string()),
                                              pa.array(scores, pa.float64())], names=["host", "path", "score"])

    return pages.select("_host", "_html").mapInArrow(run, "host string, path string, score double")


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, path, text, n_chars (code points) for every row of ``pages``.

    A NULL or empty html, and one without text, gives an empty text and a NULL
    path.  Pages without a host vote and are extracted as the host ``''``;
    equal votes go to the higher summed score, then the smaller path.
    Repeated rows come back as often as they come in."""
    T.prepare(pages.sparkSession)
    host, _ = host_and_path(F.col("url").cast("string"))
    rows = pages.select("page_id", "url", host.alias("_host"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("_html"))
    best = (votes(rows).groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum(F.round("score", 3)).alias("s"))
            .groupBy("host").agg(F.max_by("path", F.struct("n", "s", F.expr("-length(path)"), "path")).alias("path")))
    best = T.stored(best, "host-paths")       # its size is known when the join is planned

    def run(batches):
        for b in batches:
            paths, texts = [], []
            for source, path in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                page = read_page(source or "")
                k = page.at(path)
                paths.append(page.paths[k[0]] if page.blocks else None)
                texts.append(page.text(k))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(paths, pa.string()), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "path", "text", "n_chars"])

    joined = rows.join(best, F.col("_host") == F.col("host"), "left").select("page_id", "url", "_html", "path")
    return joined.mapInArrow(run, "page_id bigint, url string, path string, text string, n_chars bigint")
