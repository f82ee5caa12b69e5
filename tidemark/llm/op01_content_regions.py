"""Main text of web pages by text-to-tag ratio: parser events, Gaussian smoothing, threshold clustering.

The parser's events are folded, as they come, into lines: runs of text between block tags, each with the number
of tags in it, the share of its text in links, and the region or marked element it stands in. A line's ratio is its
plain text per tag; lines of navigation, forms, notices, adverts, comments and the like, known by element, role or
the words of class and id, count nothing, unless what is marked holds the content. Ratios are smoothed over
neighbouring lines by a Gaussian, and a threshold that parts them best into two clusters chooses lines. Where a page
has articles or a main with a chosen line or a fifth of the text, the text is theirs, else that of the smallest
region of several lines that holds all chosen ones. Of that, all lines that count belong to the text, however short,
but for divisions and sections without a chosen line whose text is mostly links. Work grows with the length of a page, whatever its
depth. Pages are read in the tasks that hold them; nothing is shuffled.

Defined results: null, empty or tagless html gives the empty text or the plain text; broken or cut markup is read
as far as it goes; a page of any length is read whole; ids and urls may be null or repeated and stay as they are;
an empty table gives an empty result.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import by_batch, table

# Elements by their role on a page, and words of class, id or role that mark what is no content.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary "
    "table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset(
    "script style noscript template head title svg math iframe object embed applet canvas audio video map select "
    "datalist textarea option optgroup button".split()
)
AROUND = frozenset("nav footer header aside form menu dialog search fieldset".split())
REGIONS = frozenset("article main section div td th body html blockquote figure details".split())
CONTAINERS = frozenset("article main".split())
ROLES = frozenset(
    "navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog toolbar".split()
)
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner banners sponsor sponsored promo promoted promotion "
    "nav navbar navigation menu menus breadcrumb breadcrumbs crumbs pagination pager header masthead topbar footer "
    "colophon sidebar sidebars aside rail widget widgets related recommended recommendations more-stories comment "
    "comments commentlist disqus respond reply replies discussion feedback reviews cookie cookies consent gdpr "
    "notice notices disclaimer alert popup modal overlay lightbox newsletter subscribe subscription signup login "
    "register social share sharing sharebar follow toolbar search searchbox form copyright legal skip hidden "
    "tagcloud tags".split()
)
#: Divisions of a page that fall away as a whole if no line of theirs is chosen and most of their text is links.
DIVISIONS = frozenset("div section details".split())
LISTS = frozenset("ul ol table dl".split())
CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
WORDS = re.compile(r"[a-z]+(?:-[a-z]+)*|[a-z]+")
#: Parts of a class or id that say it has something or not, and that only hold what is named before them.
NEGATING = frozenset("has no not with without".split())
HOLDERS = frozenset(
    "area bar block body box container content group inner item items links list outer panel posts section slot stories "
    "unit wrap wrapper".split()
)
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
SPACE = re.compile(r"\s+")

SIGMA = 1.0


def unseen(attributes: dict[str, str | None]) -> bool:
    return (
        "hidden" in attributes
        or attributes.get("aria-hidden") == "true"
        or bool(HIDDEN.search(attributes.get("style") or ""))
    )


def marked(word: str) -> bool:
    """Whether a word of a class or id is a mark, or a compound of which a mark is the head."""
    if word in MARKS:
        return True
    parts = word.split("-")
    if NEGATING.intersection(parts):
        return False
    while len(parts) > 1 and parts[-1] in HOLDERS and parts[-1] not in MARKS:
        parts.pop()
    return parts[-1] in MARKS


def no_content(tag: str, attributes: dict[str, str | None]) -> bool:
    """Whether an element seems to stand around the content instead of being it."""
    if tag in AROUND or unseen(attributes):
        return True
    if (attributes.get("role") or "").lower() in ROLES:
        return True
    if tag in ("html", "body"):
        return False
    named = f"{attributes.get('class') or ''} {attributes.get('id') or ''}"
    return any(map(marked, WORDS.findall(CAMEL.sub("-", named).lower().replace("_", "-"))))


class Lines(HTMLParser):
    """Folds parser events into lines: (text, tags, characters in links, scope).

    Scopes are the elements that are regions or seem to be no content; each knows the one around it, which has a
    smaller number, so sums over scopes take one walk from the last to the first.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int, int]] = []
        self.open: list[tuple[str, bool, int]] = []  # tag, silent, scope
        self.places: dict[str, list[int]] = {}  # of each tag's open elements
        self.fences: list[int] = []  # places of open regions and lists, which an implied end doesn't pass
        self.parents: list[int] = [-1]  # of each scope
        self.kinds: list[str] = ["html"]
        self.marks: list[bool] = [False]  # whether it seems to be no content
        self.hidden: list[bool] = [False]  # whether it or one around it isn't shown
        self.text: list[str] = []
        self.tags = self.linked = 0

    def _state(self) -> tuple[str, bool, int]:
        return self.open[-1] if self.open else ("", False, 0)

    def _flush(self) -> None:
        _, silent, scope = self._state()
        text = SPACE.sub(" ", "".join(self.text)).strip()
        if text and not silent:
            self.lines.append((text, self.tags, self.linked, scope))
        self.text, self.tags, self.linked = [], 0, 0

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS:
            self._flush()
            if tag in ("p", "li", "dt", "dd", "tr", "td", "th", "option"):
                self._implied_end(tag)
        elif tag == "br":
            self.text.append(" ")
        self.tags += 1
        if tag in VOID:
            return
        _, silent, scope = self._state()
        attributes = dict(attrs)
        mark = no_content(tag, attributes)
        if mark or tag in REGIONS:
            self.parents.append(scope)
            self.kinds.append(tag)
            self.marks.append(mark)
            self.hidden.append(self.hidden[scope] or unseen(attributes))
            scope = len(self.parents) - 1
        self.places.setdefault(tag, []).append(len(self.open))
        if tag in REGIONS or tag in LISTS:
            self.fences.append(len(self.open))
        self.open.append((tag, silent or tag in SILENT, scope))

    def handle_startendtag(self, tag, attrs):
        if tag in VOID:
            self.handle_starttag(tag, attrs)
        elif tag in BLOCKS:
            self._flush()

    def _implied_end(self, tag: str) -> None:
        """A new paragraph, item or cell ends the open one, unless a region or list has opened since."""
        places = self.places.get(tag)
        if places and (not self.fences or places[-1] >= self.fences[-1]):
            self._close(places[-1])

    def _close(self, place: int) -> None:
        """Take an element and all in it off those that are open; each is taken once."""
        for tag, _, _ in self.open[place:]:
            self.places[tag].pop()
        while self.fences and self.fences[-1] >= place:
            self.fences.pop()
        del self.open[place:]

    def handle_endtag(self, tag):
        places = self.places.get(tag)
        if places:
            if tag in BLOCKS or any(t in BLOCKS for t, *_ in self.open[places[-1] :]):
                self._flush()
            self._close(places[-1])
        elif tag in BLOCKS:
            self._flush()
        self.tags += 1

    def handle_data(self, data):
        if not self._state()[1]:
            self.text.append(data)
            if self.places.get("a"):
                self.linked += len(data.strip())

    def result(self, html: str) -> list[tuple[str, int, int, int]]:
        """The lines that count."""
        cut = html.rfind("<")  # a page that ends inside a tag
        if cut > html.rfind(">") and re.match(r"[A-Za-z/!]", html[cut + 1 :]):
            html = html[:cut]
        self.feed(html)
        self.close()
        self._flush()
        holding = self._holding()
        outside = [False] * len(self.parents)
        for k, parent in enumerate(self.parents):
            outside[k] = (k > 0 and outside[parent]) or self.hidden[k] or (self.marks[k] and k not in holding)
        return [line for line in self.lines if not outside[line[3]]]

    def inherited(self, own: list[bool]) -> list[bool]:
        """For each scope, whether it or one around it is such."""
        found = list(own)
        for k in range(1, len(found)):
            found[k] = found[k] or found[self.parents[k]]
        return found

    def summed(self, own: list[float], past_marks: bool = True) -> list[float]:
        """For each scope, the sum over it and those in it, or only those with no mark in between."""
        total = list(own)
        for k in range(len(total) - 1, 0, -1):
            if past_marks or not self.marks[k]:
                total[self.parents[k]] += total[k]
        return total

    def _holding(self) -> set[int]:
        """Marked elements that hold the content: those that the articles and mains with the fewest marked elements
        around them stand in or are. An article needs text of its own for that, outside of marked elements in it, and a
        main a fifth of all its text. If there are none, those with more than half of the plain text of what is around
        them, of which less than a tenth is outside of marked elements."""
        own = [0.0] * len(self.parents)
        for text, _, linked, scope in self.lines:
            if not self.hidden[scope]:
                own[scope] += max(0, len(text) - linked)
        plain, bare = self.summed(own), self.summed(own, past_marks=False)
        depth = [0] * len(own)  # marked elements around it, itself included
        for k in range(len(own)):
            depth[k] = self.marks[k] + (depth[self.parents[k]] if k else 0)
        least = {"article": 0.0, "main": 0.2}
        held = [k for k, kind in enumerate(self.kinds) if kind in least and bare[k] > 0 and bare[k] >= least[kind] * plain[k]]
        if not held:
            kept, outer = {0}, [0] * len(own)  # outer: the marked element at or around it, else the page
            for k in range(1, len(own)):
                around = outer[self.parents[k]]
                outer[k] = k if self.marks[k] else around
                if self.marks[k] and around in kept and bare[around] < 0.1 * plain[around] < 0.2 * plain[k]:
                    kept.add(k)
            return kept
        fewest, around = min(depth[k] for k in held), set()
        for k in held:
            if depth[k] == fewest:
                while k > 0 and k not in around:
                    around.add(k)
                    k = self.parents[k]
        return {k for k in around if self.marks[k]}


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """The ratios under a Gaussian window; beyond the ends there is nothing."""
    reach = int(np.ceil(3 * sigma))
    window = np.exp(-np.square(np.arange(-reach, reach + 1)) / (2 * sigma**2))
    total = np.convolve(ratios, window)[reach : reach + len(ratios)]
    return total / np.convolve(np.ones(len(ratios)), window)[reach : reach + len(ratios)]


def threshold(values: np.ndarray) -> float:
    """The cut that parts the values into two clusters with the least spread inside them."""
    v = np.sort(values)
    if len(v) < 2 or v[0] == v[-1]:
        return float(v[0]) if len(v) else 0.0
    n = np.arange(1, len(v))
    low, total = np.cumsum(v)[:-1], v.sum()
    between = n * (len(v) - n) * np.square(low / n - (total - low) / (len(v) - n))
    between[v[1:] == v[:-1]] = -1
    return float(v[int(np.argmax(between)) + 1])


def main_text(html: str | None) -> list[str]:
    """The content lines of a page, in its order."""
    parser = Lines()
    lines = parser.result(html or "")
    if not lines:
        return []
    plain = np.array([max(0, len(text) - linked) for text, _, linked, _ in lines], float)
    ratios = np.log1p(plain / np.maximum(1, [tags for _, tags, *_ in lines]))
    values = smoothed(ratios)
    chosen = (values >= threshold(values)) & (plain > 0)
    if not chosen.any():
        chosen = plain == plain.max()

    n = len(parser.parents)
    length, linked, picked, count = ([0.0] * n for _ in range(4))
    for (text, _, in_links, scope), c in zip(lines, chosen, strict=True):
        length[scope] += len(text)
        linked[scope] += min(in_links, len(text))
        picked[scope] += bool(c)
        count[scope] += 1
    length, linked, picked, count = map(parser.summed, (length, linked, picked, count))

    # Without a chosen line, an article that is all links is none, and a division that is mostly links is no content.
    share = [1.0 if kind in CONTAINERS else 0.5 if kind in DIVISIONS else 2.0 for kind in parser.kinds]
    aside = [not picked[k] and linked[k] >= 0.9 * share[k] * length[k] for k in range(n)]
    home = [-1] * n  # the innermost article or main around each scope
    for k, kind in enumerate(parser.kinds):
        home[k] = k if kind in CONTAINERS and not aside[k] else home[parser.parents[k]] if k else -1
    at_home = np.array([home[line[3]] >= 0 for line in lines])
    if (at_home & chosen).any() or (at_home.any() and plain[at_home].sum() >= 0.2 * plain.sum()):
        inside = [h >= 0 for h in home]
    else:
        # The scopes that hold all chosen lines lie in each other, so the last opened is the smallest; one of a
        # single line is a paragraph, not a region of the page.
        smallest = max(k for k in range(n) if picked[k] == picked[0] and (k == 0 or count[k] > 1))
        inside = parser.inherited([k == smallest for k in range(n)])
    aside = parser.inherited(aside)
    return [
        text
        for text, _, in_links, scope in lines
        if inside[scope] and not aside[scope] and (in_links < 0.9 * len(text) or home[scope] >= 0)
    ]


def extract(
    pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html"
) -> DataFrame:
    """(id, url, text, n_chars) of each row."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = ["\n\n".join(main_text(h)) for h in batch.column(html_column).to_pylist()]
            return pa.RecordBatch.from_arrays(
                [
                    batch.column(id_column),
                    batch.column(url_column),
                    pa.array([t.encode("utf-8", "replace").decode() for t in found], pa.string()),
                    pa.array([len(t) for t in found], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

        return step

    wanted = pages.select(
        F.col(id_column).cast("long").alias(id_column),
        F.col(url_column).cast("string").alias(url_column),
        F.col(html_column).cast("string").alias(html_column),
    )
    return wanted.mapInArrow(by_batch(make), "page_id long, url string, text string, n_chars long")


def op1_content_regions(spark: SparkSession, folder: str) -> DataFrame:
    return extract(table(spark, folder, "pages"))
