"""Main text of web pages by consensus host paths.

Method.  Every page is read into elements (a tolerant reader with HTML's rules
for raw text, void elements, implied ends and misnested ends).  Its containers
are scored: the characters of their blocks outside links, less those inside,
times a weight for elements that say they are the article (``_weight``); what
lies in menus, forms, adverts and the like counts for nothing; beside its main
part a container's lesser parts of other names are left out.  Each page votes
for the generalised path of its best container (tags with their classes from the
root down, digits replaced by 0), Spark adds the votes up per host, and every
page is read again with the winning path of its host: the element of that path
with the highest score is the article, or the page's own best container where no
element has that path.  So a page whose short article is outweighed by its
surroundings is still cut where its host's other pages are.

The text is that container's blocks in page order less boilerplate elements
(:func:`_verdict`), character references decoded, white space inside a block
(line breaks included) as one space, trimmed, joined by one newline.

Scale.  Votes are partial sums by (host, path) and one maximum a host, so a host
with a third of all pages is no hot group.  The winners go to the pages by a
broadcast while their bytes, which are checked, are below ``BROADCAST_BYTES``,
and else by a join that adaptive execution may split.

Edge cases.  Null and empty html, and pages without text, give the empty text.
Pages without a host (null or unreadable url) keep their own best container.
Rows are independent of their page_id; rows that repeat give rows each.  Ties go
to the path with the higher score in all, then to the smaller path text; in a
page to the deepest, then the first element.  An empty table gives no rows.  Input
columns called text or n_chars give way to the result's; others pass through.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textcore as T
from .common import saved, widened, without

RESULT = ("text", "n_chars")
#: Winning paths are broadcast up to so many bytes of text; beyond, they are joined.
BROADCAST_BYTES = 4 << 20
TEXT_BYTES = 1 << 21
#: A part of a container that holds this share of its text is its main part.
MAIN_SHARE = 0.7
_HOST = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)"

# Names fixed by HTML
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
_HEAD = frozenset("base basefont bgsound link meta title script style noscript noframes template".split())
_ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre search section summary table ul".split()
)
_BLOCK = _ENDS_P | frozenset("html body head caption tbody thead tfoot tr td th template option optgroup select".split())
_HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
_IMPLIED = {  # start tag -> (open elements that it ends, elements that shield them)
    "li": ({"li"}, {"ul", "ol", "menu", "dir", "td", "th", "table"}), "dt": ({"dt", "dd"}, {"dl", "td", "th", "table"}), "dd": ({"dt", "dd"}, {"dl", "td", "th", "table"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
    "thead": ({"thead", "tbody", "tfoot"}, {"table"}), "tbody": ({"thead", "tbody", "tfoot"}, {"table"}), "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}),
}
_SHIELD = frozenset("td th caption table template".split())
_TABLE = frozenset("table thead tbody tfoot tr td th caption".split())

# What is not the article
_NOT_TEXT = frozenset("head nav aside footer form noscript template object svg canvas button select dialog menu datalist video audio map".split())
_NOT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
_NOT_NAMES = frozenset(
    "ad ads adbox adsense adslot adunit advert adverts advertisement advertising sponsor sponsored promo promotion banner leaderboard skyscraper cookie cookies cookiebar cookiebanner cookienotice "
    "consent gdpr notice notices notification alert popup modal overlay sidebar sidebars menu menus mainmenu topmenu nav navbar navigation topnav subnav mainnav breadcrumb breadcrumbs "
    "comment comments disqus respond footer masthead share sharing social related recommended recommendations newsletter subscribe subscription signup login search widget widgets toolbar pagination pager skip".split()
)
_OWN_HEADER = frozenset("article entry post story".split())
_CONTAINER = frozenset("#root html body main article section div td center".split())
_CONTENT_NAMES = frozenset("article content post entry story text body main".split())

_TAG = re.compile(
    r"""<(?:!--(?:-?>|.*?(?:--!?>|\Z))|(/?)([A-Za-z][^\s/>]*)((?:[^"'>]+|"[^"]*"|'[^']*')*+)>|(/?)([A-Za-z][^\s/>]*)([^>]*)>|[!?/][^>]*>)""", re.S
)
_UNENDED = re.compile(r"<(?:[A-Za-z/?]|!)")
_CARE = re.compile(r"class|\bid\b|role|hidden|style|itemprop", re.I)
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`]+)))?""")
_NAME = re.compile(r"[a-z]+")
_DIGITS = re.compile(r"[0-9]+")
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_KEEP, _DROP, _DROP_UNLESS_ARTICLE, _HEADER = range(4)


def _attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, a, b, c in _ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), unescape(a or b or c))
    return found


def _verdict(tag: str, named: dict[str, str], names: set[str], in_article: bool) -> int:
    """Whether an element is boilerplate by what it is called.

    Forms and elements dropped for their names stay if an article (or, in a form,
    a main heading) turns up inside: they wrap the page.  A header inside an
    article is dropped but for its headings.
    """
    if "hidden" in named or named.get("aria-hidden") == "true" and tag not in ("html", "body") or _UNSEEN.search(named.get("style", "")):
        return _DROP
    if tag in _NOT_TEXT:
        return _DROP_UNLESS_ARTICLE if tag == "form" else _DROP
    if named.get("role", "").lower() in _NOT_ROLES:
        return _DROP_UNLESS_ARTICLE
    if tag == "header" or "header" in names and tag in ("div", "section"):
        return _HEADER if in_article or names & _OWN_HEADER else _DROP_UNLESS_ARTICLE
    if names & _NOT_NAMES and tag not in ("#root", "html", "body", "main", "article"):
        return _DROP_UNLESS_ARTICLE
    return _KEEP


def _weight(tag: str, named: dict[str, str], names: set[str]) -> int:
    """How much an element says that it is the article, in tenths."""
    if tag == "article" or "articlebody" in named.get("itemprop", "").lower():
        return 20
    if tag == "main" or named.get("role", "").lower() in ("main", "article"):
        return 16
    return 15 if tag not in ("#root", "html", "body") and names & _CONTENT_NAMES else 10


class Page:
    """The elements of a page in page order (so that a subtree is a range of numbers), and its blocks of text."""

    def __init__(self, html: str):
        self.tag, self.key, self.parent, self.last, self.own, self.weight = ["#root"], ["#root"], [-1], [0], [_KEEP], [10]
        self.blocks: list[tuple[int, list[tuple[int, str]]]] = []  # (block element, its runs of text with their elements)
        self._stack, self._runs, self._doubted = [0], [], []  # open elements; runs of the open block; open elements dropped unless an article turns up
        self._open: Counter[str] = Counter()
        self._read(html)
        while self._stack:
            self._close()
        self._judge()

    def _read(self, html: str) -> None:
        at, limit, lower = 0, html.rfind(">") + 1, None
        while at < limit and (m := _TAG.search(html, at, limit)):
            if m.start() > at:
                self._text(html[at : m.start()])
            at = m.end()
            end, tag, rest = m.group(1, 2, 3) if m.group(2) else m.group(4, 5, 6)
            if not tag:
                continue
            tag = tag.lower()
            if end:
                self._end(tag)
                continue
            if tag in _RAW:
                lower = lower if lower is not None else html.lower() if len(html.lower()) == len(html) else html
                close = lower.find(f"</{tag}", at)
                at = len(html) if close < 0 else close
                continue
            self._start(tag, rest)
        rest = html[at:]
        if rest:
            cut = _UNENDED.search(rest)
            self._text(rest[: cut.start()] if cut else rest)

    def _text(self, text: str) -> None:
        if self.tag[self._stack[-1]] == "head":
            if text.isspace():
                return
            self._close()
        self._runs.append((self._stack[-1], text))

    def _break(self) -> None:
        """A block ends here."""
        if self._runs:
            if any(not t.isspace() for _, t in self._runs):
                node = next(n for n in reversed(self._stack) if self.tag[n] in _BLOCK or n == 0)
                self.blocks.append((node, self._runs))
            self._runs = []

    def _close(self) -> None:
        node = self._stack[-1]
        if self.tag[node] in _BLOCK or node == 0:
            self._break()
        self._stack.pop()
        self._open[self.tag[node]] -= 1
        self.last[node] = len(self.tag) - 1
        if self._doubted and self._doubted[-1] == node:
            self._doubted.pop()

    def _pop_to(self, place: int) -> None:
        while len(self._stack) > place:
            self._close()

    def _start(self, tag: str, rest: str) -> None:
        stack, tags = self._stack, self.tag
        if tag in ("html", "body") and self._open[tag]:
            return
        if tags[stack[-1]] == "head" and tag not in _HEAD:
            self._close()
        if tag in _ENDS_P and self._open["p"]:
            for place in range(len(stack) - 1, 0, -1):
                name = tags[stack[place]]
                if name == "p":
                    self._pop_to(place)
                    break
                if name in _BLOCK:
                    break
        if tag in _HEADING and tags[stack[-1]] in _HEADING:
            self._close()
        if tag in _IMPLIED:
            ended, shield = _IMPLIED[tag]
            for place in range(len(stack) - 1 if any(self._open[x] for x in ended) else 0, 0, -1):
                name = tags[stack[place]]
                if name in ended:
                    self._pop_to(place)
                    break
                if name in shield:
                    break
        if tag in _BLOCK:
            self._break()
        if tag in _VOID:
            if tag == "br":
                self._runs.append((stack[-1], " "))
            return
        named = _attributes(rest) if rest and _CARE.search(rest) else {}
        names = set(_NAME.findall(f"{named.get('class', '')} {named.get('id', '')}".lower())) if named else set()
        classes = sorted({_DIGITS.sub("0", c) for c in named["class"].split()}) if named.get("class") else []
        if self._doubted and tag in ("article", "main", "h1"):
            for n in self._doubted:
                if tag != "h1" or tags[n] == "form":
                    self.own[n] = _KEEP
            self._doubted = [n for n in self._doubted if self.own[n]]
        tags.append(tag)
        self.key.append(".".join([tag, *classes]).replace("/", "_"))
        self.parent.append(stack[-1])
        self.last.append(0)
        self.own.append(_verdict(tag, named, names, self._open["article"] + self._open["main"] > 0))
        self.weight.append(_weight(tag, named, names))
        self._open[tag] += 1
        stack.append(len(tags) - 1)
        if self.own[-1] == _DROP_UNLESS_ARTICLE:
            self._doubted.append(stack[-1])

    def _end(self, tag: str) -> None:
        if tag in ("html", "body") or tag in _VOID:
            if tag == "br":
                self._runs.append((self._stack[-1], " "))
            return
        if not (any(self._open[h] for h in _HEADING) if tag in _HEADING else self._open[tag]):
            return
        block = tag in _BLOCK
        for place in range(len(self._stack) - 1, 0, -1):
            name = self.tag[self._stack[place]]
            if name == tag or tag in _HEADING and name in _HEADING:
                self._pop_to(place)
                return
            if name in _SHIELD and tag not in _TABLE or not block and name in _BLOCK:
                return

    def _judge(self) -> None:
        """What is dropped, and the score of every container."""
        n = len(self.tag)
        state, linked, mass, held = [_KEEP] * n, [False] * n, [0] * n, [0] * n
        self._held = held  # the nearest container of each element
        for i in range(n):
            above = state[self.parent[i]] if i else _KEEP
            if above == _HEADER and self.tag[i] in _HEADING:
                above = _KEEP
            state[i] = above or (_DROP if self.own[i] == _DROP_UNLESS_ARTICLE else self.own[i])
            linked[i] = self.tag[i] == "a" or i > 0 and linked[self.parent[i]]
            held[i] = i if self.tag[i] in _CONTAINER else held[self.parent[i]]
        self.dropped = state
        self._direct = set()  # containers with text of their own, beside that of containers in them
        for node, runs in self.blocks:
            size = 0
            for at, text in runs:
                if not state[at]:
                    size += -len(text) if linked[at] else len(text)
            mass[node] += max(0, size)
            if size > 0:
                self._direct.add(held[node])
        for i in range(n - 1, 0, -1):
            mass[self.parent[i]] += mass[i]
        self._mass = mass
        self.score = [mass[i] * self.weight[i] if self.tag[i] in _CONTAINER and not state[i] else 0 for i in range(n)]

    def _best(self, nodes) -> int:
        """The node of the highest score; of equal ones that with the longest chain of parents (the later of nested ones), then the first."""
        best = -1
        for i in nodes:
            if self.score[i] and (best < 0 or self.score[i] > self.score[best] or self.score[i] == self.score[best] and i <= self.last[best]):
                best = i
        return best

    def _article(self) -> int:
        """The container of the highest score, or the part of it beside which there are only lesser parts of other names.

        A container with text of its own, or with a heading or a like part outside its main part, is whole.
        """
        best = self._best(range(len(self.tag)))
        inner: dict[int, list[int]] = {}
        for i in range(1, len(self.tag)):
            if self.score[i]:
                inner.setdefault(self._held[self.parent[i]], []).append(i)
        titles = [i for i, tag in enumerate(self.tag) if tag == "h1" and not self.dropped[i]]
        while best in inner and best not in self._direct:
            part = self._best(inner[best])
            apart = lambda x: part <= x <= self.last[part] or not best <= x <= self.last[best]
            if self._mass[part] < MAIN_SHARE * self._mass[best] or not all(apart(t) for t in titles) or any(self.key[i] == self.key[part] for i in inner[best] if i != part):
                break
            if self.weight[part] < self.weight[best]:
                break
            best = part
        return best

    def path(self, node: int) -> str:
        keys = []
        while node > 0:
            keys.append(self.key[node])
            node = self.parent[node]
        return "/".join(reversed(keys))

    def _on(self, path: str) -> Iterator[int]:
        """The nodes of that path."""
        keys = path.split("/") if path else []
        held = [0] * len(self.tag)  # how much of the path the chain of parents down to a node is; -1 if it has left it
        for i in range(len(self.tag)):
            if i:
                above = held[self.parent[i]]
                held[i] = above + 1 if 0 <= above < len(keys) and keys[above] == self.key[i] else -1
            if held[i] == len(keys):
                yield i

    def vote(self) -> tuple[str, int] | None:
        """(path, score) of the best container."""
        best = self._article()
        return (self.path(best), self.score[best]) if best >= 0 else None

    def text(self, path: str | None) -> str:
        """The article in the element of that path, or in the best container."""
        best = -1
        if path is not None:
            best = self._best(self._on(path))
        if best < 0:
            best = self._article()
        if best < 0:
            return ""
        out = []
        for node, runs in self.blocks:
            if best <= node <= self.last[best]:
                block = " ".join("".join(unescape(t) for at, t in runs if not self.dropped[at]).split())
                if block:
                    out.append(block)
        return "\n".join(out)


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, path, score) of the pages of (host, html)."""
    for batch in batches:
        hosts, pages = batch.column(0), T.strings(batch.column(1))
        for a, b in T.slices(pages, TEXT_BYTES):
            out = [(h, *v) for h, html in zip(hosts.slice(a, b - a).to_pylist(), pages.slice(a, b - a).to_pylist()) if html and (v := Page(html).vote())]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], kind) for i, kind in enumerate((pa.string(), pa.string(), pa.int64()))], names=["host", "path", "score"])


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, path, pages, score): how many pages of a host vote for each path, for the winner of each host."""
    hosted = pages.select(F.lower(F.regexp_extract("url", _HOST, 1)).alias("host"), "html").where("host <> '' and html <> ''")
    votes = hosted.mapInArrow(_votes, "host string, path string, score long").groupBy("host", "path").agg(F.count("*").alias("pages"), F.sum("score").alias("score"))
    best = votes.groupBy("host").agg(F.min_by(F.struct("path", "pages", "score"), F.struct(-F.col("pages"), -F.col("score"), "path")).alias("best"))
    return best.select("host", "best.*")


def _texts(html: int, names: list[str]):
    """The rows with their texts; the page stands in column html, the path of its host after the kept columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pages, paths = T.strings(batch.column(html)), batch.column(len(names))
            for a, b in T.slices(pages, TEXT_BYTES):
                texts = [Page(h).text(p) if h else "" for h, p in zip(pages.slice(a, b - a).to_pylist(), paths.slice(a, b - a).to_pylist())]
                columns = [*(batch.column(i).slice(a, b - a) for i in range(len(names))), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=[*names, *RESULT])

    return run


def extract(pages: DataFrame) -> DataFrame:
    """The columns of pages(url, html, ...) with text and n_chars (its code points).

    The winning paths are worked out and written at once; the pages are read again when the result is.
    """
    winners = saved(host_paths(pages), "host_paths")
    size = winners.agg(F.sum(F.octet_length("host") + F.octet_length("path"))).first()[0] or 0
    mark = uuid.uuid4().hex  # no input column is called so
    host, path = f"host_{mark}", f"path_{mark}"
    named = winners.select(F.col("host").alias(host), F.col("path").alias(path))
    rows = without(pages, RESULT)
    html = [c.lower() for c in rows.columns].index("html")
    hosted = rows.withColumn(host, F.lower(F.regexp_extract("url", _HOST, 1))).join(F.broadcast(named) if size <= BROADCAST_BYTES else named, host, "left")
    return hosted.select(*[F.col(f"`{c}`") for c in rows.columns], path).mapInArrow(_texts(html, rows.columns), widened(rows, zip(RESULT, ("string", "long"))))


def op13_html_extract(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return extract(pages).select("page_id", "url", "text", "n_chars")
