"""HTML main-text extraction by consensus paths of each host.

Every page's containers are scored: text outside links, menus, adverts and the
like, times the share of such text in all the container holds, so that the
tightest container with the whole article scores best. The best few vote with
their generalised tag-class path (digits become ``#``); votes are summed per
host and path in Spark, and the host's winning path is joined back to its
pages. There the element on the winning path is extracted anew, without its
menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles
and reader comments; a page without that path, or with nothing under it, uses
its own best container.

Votes are combined map-side, one row per host and path and task, so a host
with a third of all pages costs no more than others; the join back carries the
hot host in as many tasks as adaptive skew splitting makes of it.

Classes mark what is not article: a class of marking words alone, or with words
that say nothing, firmly; a class in which another word stands too ("form-guide")
only where most of the block's text is in links. Parsing takes time in
proportion to the page: paths are compared by running checksums, hidden elements
are matched once, and each element knows its run of texts.

Text: character references are decoded, white space inside a block becomes one
space, blocks are trimmed and joined in page order by two line feeds.

Defined cases: null, empty and text-free html give an empty text; a null url
is a page without host, which uses its own best container; repeated rows and
ids are pages of their own; an empty table gives no rows; input columns other
than id, url and html are ignored; documents of any length are read whole.
"""

from __future__ import annotations

import html as entities
import re
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripkpi.llm.tables import bounded_batches, staged

VOTES = 3

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"                                                    # comment
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"       # tag
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>"                                     # tag with an open quote
    r"|<[!?][^>]*+>", re.S)
_ATTR = re.compile(r"""([a-zA-Z_:][-\w:.]*)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_DIGITS = re.compile(r"\d+")

RAW = frozenset("script style title textarea noscript iframe xmp noembed template".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section
summary table tbody td tfoot th thead tr ul""".split())
ENDS_P = BLOCKS - frozenset("td th tr tbody thead tfoot caption legend summary figcaption dd dt li body html".split())
CONTAINERS = frozenset("article main section div td body center table blockquote dd".split())
SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
        "th": ("td", "th"), "option": ("option",)}
SCOPE = frozenset("ul ol dl table div article section main aside nav body header footer form blockquote".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

#: Elements that are never part of an article, and roles that say the same.
DROP_TAGS = frozenset("nav footer aside form menu dialog button select svg object head".split())
DROP_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
#: Words of a class or id that mark something beside the article: whole words, and beginnings of words.
DROP_WORDS = frozenset("""ad ads adv advert nav menu menus rail share sharing social cookie cookies notice notices
reply replies respond form login search popup modal overlay promo promos banner related widget widgets pager alert
header masthead footer toolbar""".split())
DROP_STARTS = ("advert", "sponsor", "navig", "navbar", "breadcrumb", "sidebar", "comment", "disqus", "consent", "gdpr",
               "newsletter", "subscri", "signup", "paginat", "recommend", "copyright", "disclaimer", "notification",
               "toast", "footer", "masthead", "dropdown", "feedback")
#: Words that say nothing of the content: a class of marking words and these is a firm mark ("share-buttons", "ad-slot").
#: With any other word ("form-guide", "share-price") it is a weak one, which holds only for blocks that are mostly links.
PLAIN_WORDS = frozenset("""area bar bars block blocks body bottom box boxes btn button buttons card cards col column
container content desktop fixed floating global group header holder home icon icons id in inline inner item items js
left link links list lists main mobile module nav of on outer page panel post posts primary right row secondary
section site slot slots small sticky sub text the title top ui unit units view wrap wrapper x""".split())
HEADER_WORDS = frozenset({"header", "masthead", "banner"})
WEAK_LINKS = 0.5
#: Weights of container elements in the score.
BONUS = {"#": 0.6, "article": 1.5, "main": 1.2, "body": 0.6, "td": 0.8, "table": 0.8, "blockquote": 0.3, "dd": 0.3}


class Page:
    """Elements in document order (descendants follow their element) and the text between tags."""

    def __init__(self, source: str):
        self.tag, self.parent, self.end, self.step = ["#"], [-1], [0], [""]
        self.drop, self.head, self.soft, self.weak = [False], [False], [False], [False]
        self.path_sum, self.open_at, self.shut_at = [0], [0], [0]   # of each element: its path's checksum, its run of texts
        self.held: dict[str, int] = {}                              # how many open elements have a tag
        self.spans: dict[str, dict[int, int]] = {}                  # hidden elements: start -> end, by tag
        self.text: list[tuple[int, int, str, bool]] = []        # element, block, text, inside a link
        self.article_inside: set[int] = set()
        stack, at, block, links, n = [0], 0, 0, 0, len(source)
        low = None
        match = _TOKEN.search
        while at < n:
            m = match(source, at)
            end = m.start() if m else n
            if end > at:
                self.text.append((stack[-1], block, source[at:end], links > 0))
            if not m:
                break
            at = m.end()
            name = m[2] or m[5]
            if not name:
                continue
            name = name.lower()
            closing = m[1] or m[4]
            if name == "a":
                links = 0 if closing else 1
                continue
            if name == "br":
                self.text.append((stack[-1], block, " ", links > 0))
                continue
            if closing:
                if name in BLOCKS or name in DROP_TAGS:
                    block += 1
                    if self.held.get(name):
                        while True:
                            e = stack.pop()
                            self._shut(e)
                            if self.tag[e] == name:
                                break
                        if not stack:
                            stack = [0]
                        if name in SCOPE:
                            links = 0
                continue
            if name in RAW:
                low = low or source.lower()
                close = low.find("</" + name, at)
                at = n if close < 0 else (source.find(">", close) + 1 or n)
                continue
            if name not in BLOCKS and name not in DROP_TAGS:
                if name not in VOID and m[3] and "hidden" in m[3] and self._hidden(m[3]):
                    at = self._skip(source, name, m.start(), at)
                continue
            block += 1
            if name in VOID:
                continue
            if name in ENDS_P:
                self._close(stack, ("p",))
            if name in HEADINGS:
                self._close(stack, HEADINGS)
            if name in SAME:
                self._close(stack, SAME[name])
            self._open(stack, name, m[3] or m[6] or "")
            if (m[3] or "").endswith("/") and name in DROP_TAGS:
                self._shut(stack.pop())
        for e in stack:
            self._shut(e)
        self._judge()

    def _shut(self, e: int) -> None:
        self.end[e], self.shut_at[e] = len(self.tag), len(self.text)
        if e:
            self.held[self.tag[e]] -= 1

    @staticmethod
    def _hidden(attrs: str) -> bool:
        a = {k.lower(): (v or "").strip("\"'").lower() for k, v in _ATTR.findall(attrs)}
        return "hidden" in a or a.get("aria-hidden") == "true"

    def _skip(self, source: str, name: str, start: int, at: int) -> int:
        """End of a hidden inline element that starts at ``start``; its tags are matched once for the whole page."""
        if name not in self.spans:
            found, opened = {}, []
            for m in re.finditer(rf"<(/?){re.escape(name)}\b[^>]*>", source, re.I):
                if not m[1]:
                    opened.append(m.start())
                elif opened:
                    found[opened.pop()] = m.end()
            self.spans[name] = found
        return self.spans[name].get(start, at)

    def _close(self, stack: list[int], names) -> None:
        """End an open element of ``names``, unless one that opens a new scope stands between."""
        if not any(self.held.get(n) for n in names):
            return
        for k in range(len(stack) - 1, 0, -1):
            t = self.tag[stack[k]]
            if t in names:
                for e in stack[k:]:
                    self._shut(e)
                del stack[k:]
                return
            if t in SCOPE:
                return

    def _open(self, stack: list[int], name: str, attrs: str) -> None:
        e = len(self.tag)
        a = {k.lower(): v.strip("\"'") for k, v in _ATTR.findall(attrs)} if attrs.strip(" /") else {}
        names = [[w.lower() for w in _WORD.findall(c)] for c in f"{a.get('class', '')} {a.get('id', '')}".split()]
        marked = [w for c in names for w in c if _marks(w)]
        weak = bool(marked) and not any(any(map(_marks, c)) and all(_marks(w) or w in PLAIN_WORDS for w in c) for c in names)
        role = a.get("role", "").lower()
        style = a.get("style", "").replace(" ", "").lower() if "style" in a else ""
        hidden = "hidden" in a or a.get("aria-hidden") == "true" or "display:none" in style
        head = name == "header" or role == "banner" or (bool(marked) and not weak and all(w in HEADER_WORDS for w in marked))
        firm = name in DROP_TAGS or role in DROP_ROLES or hidden
        self.tag.append(name)
        self.parent.append(stack[-1])
        self.end.append(e + 1)
        names = sorted({_DIGITS.sub("#", c.lower()) for c in entities.unescape(a.get("class", "")).split()})
        self.step.append(".".join([name, *names]))
        self.path_sum.append(_path_sum(self.path_sum[stack[-1]], self.step[-1]) if name != "html" else self.path_sum[stack[-1]])
        self.open_at.append(len(self.text))
        self.shut_at.append(len(self.text))
        self.held[name] = self.held.get(name, 0) + 1
        self.drop.append(firm or head or (bool(marked) and name not in HEADINGS))
        self.head.append(head)
        self.soft.append(not firm and (bool(marked) or head))
        self.weak.append(not firm and not head and weak)
        if name in ("article", "main"):
            for up in reversed(stack):
                if up in self.article_inside:                 # and so are all above it
                    break
                self.article_inside.add(up)
        stack.append(e)

    def _judge(self) -> None:
        """Masses of text; marks by class alone don't hold for what has the page's article in it."""
        n = len(self.tag)
        own, own_link = [0] * n, [0] * n
        for e, _, t, link in self.text:
            size = len(t) if not t.isspace() else 0
            if link:
                own_link[e] += size
            else:
                own[e] += size
        every, linked = own[:], own_link[:]
        for e in range(n - 1, 0, -1):
            every[self.parent[e]] += every[e]
            linked[self.parent[e]] += linked[e]
        for e in range(1, n):
            if self.weak[e] and linked[e] <= WEAK_LINKS * (linked[e] + every[e]):
                self.drop[e] = False
            if self.soft[e] and self.drop[e] and (
                    (e in self.article_inside and not self._remark(e)) or every[e] > 0.7 * every[0]):
                self.drop[e] = False
        self.out = [False] * n
        for e in range(1, n):
            self.out[e] = self.out[self.parent[e]] or self.drop[e]
        good = [0 if self.out[e] else own[e] for e in range(n)]
        total = [own[e] + own_link[e] for e in range(n)]
        for e in range(n - 1, 0, -1):
            good[self.parent[e]] += good[e]
            total[self.parent[e]] += total[e]
        self.good, self.total = good, total

    def _remark(self, e: int) -> bool:
        """True where the articles inside are reader comments or teasers rather than the article."""
        return any(w.startswith(("comment", "repl", "respon", "related", "recommend", "disqus"))
                   for w in _WORD.findall(self.step[e].lower()))

    def path(self, e: int) -> str:
        steps = []
        while e > 0:
            if self.tag[e] != "html":
                steps.append(self.step[e])
            e = self.parent[e]
        return ">".join(reversed(steps))

    def score(self, e: int) -> float:
        if not self.good[e]:
            return 0.0
        return self.good[e] * (self.good[e] / self.total[e]) ** 2 * BONUS.get(self.tag[e], 1.0)

    def ranked(self, count: int = VOTES) -> list[tuple[float, int]]:
        """Best containers: (score, element), the first the page's own choice."""
        first = 1 if "body" in self.tag else 0                  # without a body, the whole page is a container
        found = [(self.score(e), -e) for e in range(first, len(self.tag))
                 if (self.tag[e] in CONTAINERS or not e) and not self.out[e]]
        found = sorted((f for f in found if f[0] > 0), reverse=True)[:count]
        return [(s, -e) for s, e in found]

    def extract(self, e: int) -> str:
        """The article's text under element e."""
        skip, texts = [False] * (self.end[e] - e), self.text[self.open_at[e]:self.shut_at[e]]
        for k in range(e + 1, self.end[e]):
            up = self.parent[k]
            above = skip[up - e]
            if above and self.tag[k] in HEADINGS and self._in_header(up, e):
                above = False                                     # an article's header keeps its headings
            skip[k - e] = above or self.drop[k]
        blocks: list[str] = []
        last, parts = -1, []
        for own, block, text, _ in texts:
            if skip[own - e]:
                continue
            if block != last:
                blocks.append("".join(parts))
                last, parts = block, []
            parts.append(entities.unescape(text))
        blocks.append("".join(parts))
        return "\n\n".join(b for b in (" ".join(x.split()) for x in blocks) if b)

    def _in_header(self, e: int, top: int) -> bool:
        """True if all that drops e, below ``top``, are headers."""
        seen = False
        while e != top:
            if self.drop[e]:
                if not self.head[e]:
                    return False
                seen = True
            e = self.parent[e]
        return seen


def _marks(word: str) -> bool:
    return word in DROP_WORDS or word.startswith(DROP_STARTS)


def _path_sum(above: int, step: str) -> int:
    """Checksum of a path from that of the path above it: equal paths have equal sums."""
    return zlib.crc32(step.encode(), zlib.crc32(b">", above))


def path_sum(path: str) -> int:
    total = 0
    for step in path.split(">") if path else []:
        total = _path_sum(total, step)
    return total


def host(url_col: str = "url"):
    """The url's host in lower case, without user and port; null where there is none."""
    found = F.regexp_extract(F.lower(F.trim(F.col(url_col).cast("string"))), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.when(found != "", found)


def votes(pages: DataFrame) -> DataFrame:
    """(host, path, votes, pages): the best containers' votes of each page, summed."""
    def cast(batches):
        for b in batches:
            rows = []
            for h, doc in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                page = Page(doc)
                best = page.ranked()
                rows += [(h, page.path(e), int(1000 * s / best[0][0])) for s, e in best]
            cols = list(zip(*rows)) if rows else [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(
                cols, (pa.string(), pa.string(), pa.int64()))], ["host", "path", "vote"])

    ballots = pages.where("host is not null and html is not null").select("host", "html").mapInArrow(
        cast, "host string, path string, vote long")
    return ballots.groupBy("host", "path").agg(F.sum("vote").alias("votes"), F.count("*").alias("pages"))


def winners(counted: DataFrame) -> DataFrame:
    """(host, path): each host's path with most votes, ties to the first in code point order."""
    return counted.groupBy("host").agg(F.min(F.struct(-F.col("votes"), "path")).alias("w")).select(
        F.col("host").alias("voted_host"), F.col("w.path").alias("path"))


def main_text(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per page: its main text and the text's length in code points."""
    bounded_batches(pages)
    src = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                       host(url_col).alias("host"), F.col(html_col).cast("string").alias("html"))
    # staged, so that its true size decides the join: without a broadcast the pages are dealt by host,
    # and a hot host's are split
    won = staged(winners(votes(src)), "html-paths")
    both = src.join(won, F.col("host") == F.col("voted_host"), "left").select("page_id", "url", "html", "path")

    def extract(batches):
        for b in batches:
            texts = [text_of(h, p) for h, p in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    return both.mapInArrow(extract, "page_id long, url string, text string, n_chars long")


def text_of(source: str | None, path: str | None) -> str:
    """Main text of one page, by the host's path or else the page's own best container."""
    if not source:
        return ""
    page = Page(source)
    if path is not None:
        wanted = path_sum(path)
        found = [e for e in range(len(page.tag)) if page.path_sum[e] == wanted and (page.tag[e] in CONTAINERS or not e)
                 and not page.out[e] and page.path(e) == path]
        if found:
            best = max(found, key=lambda e: (page.score(e), -e))
            # an article in several such elements: those beside the best whose own text outweighs links and the like
            beside = [e for e in found if e == best or page.parent[e] == page.parent[best] and 2 * page.good[e] > page.total[e]]
            text = "\n\n".join(t for t in map(page.extract, beside) if t)
            if text:
                return text
    best = page.ranked(1)
    return page.extract(best[0][1] if best else 0)
