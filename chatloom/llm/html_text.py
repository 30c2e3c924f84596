"""Main text of HTML pages by maximum-scoring subsequence.

A page is a row of tags and words. Words score positive and tags negative; how much, depends on the element and
is learned from labelled pages: those whose markup says where the article is. One linear scan finds the
contiguous region with the highest score. Elements that never belong to an article count nothing and give no text; one that
is marked so but holds the article, or most of what is left of the page, is kept.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.llm.tables import bounded, slices

# Names of HTML elements by their role.
RAW = ("script", "style", "noscript", "template", "textarea", "title", "iframe", "xmp", "noembed", "noframes")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
KNOWN = INLINE | VOID | frozenset("address article aside blockquote body caption center dd details dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split())
DROPPED = frozenset("nav aside footer form head menu dialog button select option optgroup datalist fieldset svg math canvas audio video object map search".split())
ARTICLES = ("article", "main")
#: Words in class, id or role that mark what isn't the article: as a whole name, first in one of such words and those of LAYOUT, or last behind words of WHERE.
MARKS = frozenset("ad ads adv advert adverts advertisement advertising adsense adbox sponsor sponsored promo promoted promotion banner cookie cookies consent gdpr popup modal overlay newsletter subscribe signup paywall sidebar rail aside widget menu nav navbar navigation breadcrumb breadcrumbs pagination pager toc skip footer contentinfo complementary search login comment comments commentlist disqus respond reply replies discussion related recommended recommendations share sharing social tags dialog outbrain taboola".split())
#: Those of them that say that readers write: what they mark is no wrapper of an article, however long it is.
READERS = frozenset("comment comments commentlist disqus respond reply replies discussion".split())
#: These mark it only outside the article itself.
OUTER_MARKS = frozenset("header masthead topbar toolbar alert notice notices".split())
LAYOUT = frozenset("area bar block box button buttons center container content form group inner item items left link links list main outer panel posts primary right row secondary section slot top bottom unit wrap wrapper".split())
WHERE = frozenset("article bottom cc global google left main page post primary reader right secondary site top user wp".split())
#: A new element of the first kind ends an open one of the second.
IMPLIED = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>" + "|".join(RAW) + r")\b[^>]*+>.*?(?:</(?P=raw)\s*+>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-z][^\s/>]*+)(?P<rest>(?>[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(?P<end2>/?)(?P<name2>[a-z][^\s/>]*+)(?P<rest2>[^>]*+)>|<[!?/][^>]*+>",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
WORD_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

#: Elements of prose: taken to be inside so many times for one time outside before anything is counted.
PROSE = INLINE | VOID | frozenset("p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre figure figcaption section table tbody thead tr td th center".split())
PRIOR = 19

#: Scores in words: what a tag costs at least and at most.
TAG_LEAST, TAG_MOST = 0.1, 4.0


class Page:
    """A page as parallel lists: text of each token or None for a tag, its element's name, and what is dropped."""

    def __init__(self, source: str):
        self.text: list[str | None] = []
        self.name: list[str] = []
        self.closes: list[bool] = []
        self.dropped: list[bool] = []
        self.held: list[int] = []  #: the innermost droppable element around each token, or -1
        self.drops: list[list[int]] = []  #: of each droppable element: first and last token, the one around it, and whether it can be kept: never (0), if it holds the article (1), or also by its words (2)
        closed: list[int] = []  #: droppable elements, inner ones first
        self.sections: list[tuple[int, int]] = []  #: first and last token of each article
        at = 0
        open_: list[tuple[str, bool, int]] = []
        n_open: Counter = Counter()  #: open elements by name, so that a stray end tag isn't searched for
        in_article, around = 0, -1

        def close(depth: int) -> None:
            nonlocal in_article, around
            while len(open_) > depth:
                name, drop, begin = open_.pop()
                n_open[name] -= 1
                if drop:
                    self.drops[around][1] = len(self.text)
                    closed.append(around)
                    around = self.drops[around][2]
                if name in ARTICLES:
                    in_article -= 1
                    self.sections.append((begin, len(self.text)))

        def add(text: str | None, name: str, closes: bool = False) -> None:
            self.text.append(text)
            self.name.append(name)
            self.closes.append(closes)
            self.held.append(around)

        # Behind the last ">" no tag can end, and only comments hide text.
        limit, m = source.rfind(">") + 1, None
        for m in TOKEN.finditer(source, 0, limit):
            if m.start() > at:
                add(source[at : m.start()], open_[-1][0] if open_ else "")
            at = m.end()
            name = (m["name"] or m["name2"] or "").lower()
            if not name:
                continue
            if m["end"] or m["end2"]:
                if n_open[name]:
                    add(None, name, True)
                    close(next(d for d in range(len(open_) - 1, -1, -1) if open_[d][0] == name))
                elif name not in INLINE:
                    add(None, name, True)
                continue
            rest = m["rest"] if m["rest"] is not None else m["rest2"]
            if name in VOID:
                add(None, name)
                continue
            if name in IMPLIED and open_ and open_[-1][0] in IMPLIED[name]:
                close(len(open_) - 1)
            elif name not in INLINE and any(o[0] == "p" for o in open_[-4:]):  # a block ends an open paragraph
                depth = next(d for d in range(len(open_) - 1, -1, -1) if open_[d][0] == "p")
                if all(o[0] in INLINE or o[0] == "p" for o in open_[depth:]):
                    close(depth)
            hidden = name not in ("html", "body", *ARTICLES) and len(rest) > 3 and bool(HIDDEN.search(rest))
            fixed = hidden or name in DROPPED and name != "form" or name == "header" and not in_article
            mark = self._marked(rest, in_article > 0 or name == "p") if len(rest) > 3 and name not in ("html", "body", *ARTICLES) else None
            drop = fixed or name == "form" or mark is not None
            if rest.rstrip().endswith("/") and name not in KNOWN:
                continue
            if drop:
                self.drops.append([len(self.text), 0, around, 0 if fixed else 1 if mark in READERS else 2])
                around = len(self.drops) - 1
            in_article += name in ARTICLES
            open_.append((name, drop, len(self.text)))
            n_open[name] += 1
            add(None, name)
        hidden = m is not None and m.end() == limit and self._unclosed(m)
        rest = "" if hidden else source[at:]
        comment = rest.find("<!--")
        if rest := rest[:comment] if comment >= 0 else rest:
            add(rest, open_[-1][0] if open_ else "")
        close(0)
        self._drop(closed)

    @staticmethod
    def _unclosed(m: re.Match[str]) -> bool:
        """Whether a comment or raw element goes on to the end of the page."""
        if m["raw"]:
            return re.search(rf"</{m['raw']}\s*>\Z", m[0], re.I) is None
        return m[0].startswith("<!--") and not m[0].endswith("-->")

    def _drop(self, closed: list[int]) -> None:
        """Decides on the droppable elements, those with most words first, of equal ones inner ones: one is kept if it holds the largest article, or, where no article lies beside it and readers didn't write it, more words than are left outside it."""
        gone = [True] * len(self.drops)
        if any(d[3] for d in self.drops):
            own = [0] * (len(self.drops) + 1)  # words under no inner drop; the last is of those under none at all
            for text, k in zip(self.text, self.held, strict=True):
                if text is not None:
                    own[k] += len(text.split())
            article = max(self.sections, key=lambda s: s[1] - s[0], default=None)
            heads = [i for i, name in enumerate(self.name) if name == "h1" and not self.closes[i]]
            around = [0] * len(self.drops)  # words in the droppable elements around each; outer ones come first
            for k, d in enumerate(self.drops):
                around[k] = around[d[2]] + own[d[2]] if d[2] >= 0 else 0
            for k in sorted(closed, key=lambda k: -own[k]):
                first, last, outer, can = self.drops[k]
                if not can or not own[k] or heads and bisect_right(heads, first) == bisect_left(heads, last):
                    continue
                beside = article and (article[1] <= first or last <= article[0])
                if can == 2 and not beside and own[k] > own[-1] + around[k] or article and first < article[0] and article[1] <= last:
                    gone[k] = False
                    own[outer] += own[k]
        for k, d in enumerate(self.drops):  # outer ones come first
            gone[k] = gone[k] or d[2] >= 0 and gone[d[2]]
        self.dropped = [k >= 0 and gone[k] for k in self.held]

    @staticmethod
    def _marked(rest: str, inside: bool) -> str | None:
        """The word in an element's class, id or role that says that it isn't the article."""
        for m in ATTRIBUTE.finditer(rest):
            for token in (m[1] or m[2] or m[3] or "").split():
                parts = [x.lower() for x in WORD_PARTS.findall(token) if len(x) > 1]  # sizes such as 300x250 say nothing
                marks = MARKS if inside else MARKS | OUTER_MARKS
                if parts and parts[0] in marks and all(x in MARKS or x in OUTER_MARKS or x in LAYOUT for x in parts):
                    return parts[0]
                if len(parts) > 1 and parts[-1] in MARKS and all(x in WHERE for x in parts[:-1]):
                    return parts[-1]
        return None

    def region_text(self, first: int, last: int) -> str:
        """Text of tokens first to before last: references decoded, one space for white space and between blocks."""
        parts: list[str] = []
        for i in range(first, last):
            text = self.text[i]
            if text is None:
                if self.name[i] not in INLINE:
                    parts.append(" ")
            elif not self.dropped[i]:
                parts.append(html.unescape(text) if "&" in text else text)
        return " ".join("".join(parts).split())


def kind(name: str) -> str:
    return name if name in KNOWN else "other"


def counted(page: Page) -> Counter:
    """Words and tags of each kind of element, inside and outside the labelled article; empty if there is no label."""
    found: Counter = Counter()
    if page.sections:
        first, last = max(page.sections, key=lambda s: s[1] - s[0])
        for i, (text, name) in enumerate(zip(page.text, page.name, strict=True)):
            inside = first < i < last
            if page.dropped[i]:
                continue
            if text is None:
                if name not in ARTICLES:
                    found["tag", kind(name), inside] += 1
            elif n := len(text.split()):
                found["word", kind(name), inside] += n
    return found


def learn_weights(pages: DataFrame, column: str = "html") -> dict[tuple[str, str], float]:
    """Scores of words and tags by element, from all labelled pages. At most a few hundred counts reach the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in slices(batches, column):
            for source in batch.column(0).to_pylist():
                total.update(counted(Page(source or "")))
        rows = [(*k, n) for k, n in total.items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.string(), pa.bool_(), pa.int64()))], ["what", "kind", "inside", "n"])

    counts = bounded(pages).select(column).mapInArrow(count, "what string, kind string, inside boolean, n long").groupBy("what", "kind", "inside").agg(F.sum("n").alias("n")).collect()
    n = {(r.what, r.kind, r.inside): r.n for r in counts}
    weights = {}
    for what in ("word", "tag"):
        for name in [*KNOWN, "other", ""]:
            seen, prior = n.get((what, name, True), 0), PRIOR if name in PROSE else 1
            share = (seen + prior) / (seen + n.get((what, name, False), 0) + prior + 1)
            weights[what, name] = share if what == "word" else -(TAG_LEAST + (TAG_MOST - TAG_LEAST) * (1 - share))
    return weights


def scores(page: Page, weights: dict[tuple[str, str], float]) -> list[float]:
    """The score of each token: of its words, or of a tag; what is dropped scores nothing."""
    return [0.0 if gone else weights["tag", kind(name)] if text is None else len(text.split()) * weights["word", kind(name)] for text, name, gone in zip(page.text, page.name, page.dropped, strict=True)]


def best_region(score: list[float]) -> tuple[int, int]:
    """First token and end of the contiguous region with the highest sum of scores; empty if none is above 0. One linear scan."""
    best = running = 0.0
    region, begin = (0, 0), 0
    for i, x in enumerate(score):
        if running <= 0:
            running, begin = 0.0, i
        running += x
        if running > best:
            best, region = running, (begin, i + 1)
    return region


def main_text(source: str | None, weights: dict[tuple[str, str], float]) -> str:
    page = Page(source or "")
    return page.region_text(*best_region(scores(page, weights)))


def extract(pages: DataFrame, weights: dict[tuple[str, str], float] | None = None, keys: tuple[str, ...] = ("page_id", "url"), column: str = "html") -> DataFrame:
    """The main text of every page: the keys, text, n_chars (code points).

    Null, empty and text-free pages give an empty text; null keys and repeated rows pass through; an empty table gives
    no rows. Other columns are not read. Broken markup is read as far as it goes: a tag without an end is closed with its parent.
    """
    scores = learn_weights(pages, column) if weights is None else weights
    types = dict(pages.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, column):
            texts = [main_text(source, scores) for source in batch.column(len(keys)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keys))), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], [*keys, "text", "n_chars"])

    return bounded(pages).select(*keys, column).mapInArrow(run, ", ".join(f"`{k}` {types[k]}" for k in keys) + ", text string, n_chars long")
