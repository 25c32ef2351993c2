"""Main text of web pages as the maximum-scoring run of blocks.

A page is read as a sequence of words and tags. Every word scores above zero,
every tag below, by weights learned from labelled pages, which are the pages of
the table that mark their main text with an ``article`` or ``main`` element: a
word is worth the share of words in its kind of block that lie inside, a tag
costs by the share of its kind that lies outside, times a scale chosen for the
best words on those pages. One linear scan finds the contiguous run of blocks
with the largest sum. What never is main text (scripts, menus, forms, adverts,
reader comments, ...) has no words or tags to score: a run may pass over it, and
its text stays out.
"""

from __future__ import annotations

import html as references
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfscout.llm.common import text_of
from shelfscout.session import materialise

# Elements by what HTML makes of them.
VOID = frozenset("area base br col embed frame hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea iframe noembed noframes xmp".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p "
    "pre search section select summary table tbody td tfoot th thead tr ul".split()
)
# An open element ends where another of its row begins, up to the nearest element that holds it.
ENDS = {
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
}
# Elements that never hold main text, and those whose words stand for the main text itself.
NEVER = frozenset(
    "nav footer aside script style noscript template head title select button textarea iframe object canvas svg "
    "audio video map datalist noembed noframes menu dialog search xmp applet".split()
)
MARKERS = {"main": 1, "article": 2}
KNOWN = VOID | RAW | BLOCKS | NEVER | frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark math meter output picture "
    "progress q rp rt ruby s samp slot small span strike strong sub sup time tt u var".split()
)
# Words of class, id and role that name reader comments; that name other parts around the main
# text; and that tell a header of the text from a header of the page.
COMMENTS = frozenset("comment comments commentlist disqus respond replies reply discussion".split())
AROUND = frozenset(
    "ad ads adbox adsense advert advertisement adverts advertising advertorial sponsor sponsored promo promotion "
    "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager sidebar sidebars aside footer "
    "footnav masthead topbar toolbar banner notice notices cookie cookies consent gdpr alert popup modal overlay "
    "lightbox newsletter signup subscribe subscription login related recommended recommendations social share "
    "sharing shares widget widgets contentinfo complementary search searchbox skip skiplink copyright paywall "
    "outbrain taboola form hidden".split()
)
OF_TEXT = frozenset("article entry post story title content".split())
# Beside one of these a name says what an element lacks or stands next to.
ABOUT = frozenset("no has with without".split())

TAG_NAME = re.compile(r"/?([A-Za-z][^\s/>]*)")
# A tag's rest up to the bracket that ends it: one inside quotes does not.
TAG_REST = re.compile(r"""(?:[^"'>]++|"[^"]*+"|'[^']*+')*+>""")
NAMED = re.compile(r"""(?:^|[\s/"'])(class|id|role)\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++)""", re.I)
HIDDEN = re.compile(r"""(?:^|[\s/"'])(?:hidden(?=[\s=/>]|$)|aria-hidden\s*=\s*["']?true|style\s*=\s*["'][^"']*display\s*:\s*none)""", re.I)
HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")
NAME = re.compile(r"[a-z]+")
ENDING = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in sorted(RAW)}

# Scales tried, and the one taken where no page is labelled.
SCALES, DEFAULT_SCALE = (1.0, 2.0, 4.0, 8.0, 16.0, 32.0), 4.0


@dataclass
class Piece:
    """A block of text, and the tags between the block before it and this one."""

    kind: str  # element the block stands in, marked if all its words are linked
    tags: list[str]  # of the gap before
    words: list[str]
    inner: list[str] = field(default_factory=list)  # tags within the block
    within: int = 0  # markers it stands in, as bits
    marked: bool = False


class Reader:
    """Cuts one page into pieces. Elements nest as browsers would nest them, but for misnested inline tags."""

    def __init__(self) -> None:
        self.pieces: list[Piece] = []
        # Open elements: name, state before. A state: kind of block, barred how (0, 1 unless a marker
        # follows, 2 for good), markers around as bits, inside a link.
        self.open: list[tuple[str, tuple]] = []
        self.names: Counter[str] = Counter()
        self.state = ("", 0, 0, False)
        self.marks: list[str] = []  # tags since the last block that has words
        self.text: list[str] = []
        self.inner: list[str] = []
        self.linked = True

    def read(self, page: str) -> list[Piece]:
        at, size, careful = 0, len(page), True
        while at < size:
            start = page.find("<", at)
            if start < 0:
                self.word(page[at:])
                break
            after = page[start + 1 : start + 2]
            if after in ("!", "?"):
                self.word(page[at:start])
                ends = "-->" if page.startswith("<!--", start) else ">"
                end = page.find(ends, start + (2 if ends == "-->" else 1))
                at = size if end < 0 else end + len(ends)
                continue
            found = TAG_NAME.match(page, start + 1)
            if not found:
                if after == "/":  # browsers take </ before anything but a letter for a comment
                    self.word(page[at:start])
                    end = page.find(">", start)
                    at = size if end < 0 else end + 1
                else:
                    self.word(page[at : start + 1])
                    at = start + 1
                continue
            rest = TAG_REST.match(page, found.end()) if careful else None
            if rest is None:
                # A quote stays open up to the end of the page: from here on quotes mean nothing.
                careful = False
                end = page.find(">", found.end()) + 1
                if not end:
                    self.word(page[at:start])
                    break
            else:
                end = rest.end()
            self.word(page[at:start])
            name, at = found[1].lower(), end
            if after == "/":
                self.close(name)
                continue
            self.start(name, page[found.end() : end - 1])
            if name in RAW:
                ending = ENDING[name].search(page, at)
                self.close(name)
                at = page.find(">", ending.start()) + 1 or size if ending else size
        self.flush()
        # The main text is what articles hold; where there is none, what the main element holds.
        top = max((piece.within for piece in self.pieces), default=0)
        for piece in self.pieces:
            piece.marked = top > 0 and piece.within >= min(top, 2)
        return self.pieces

    def word(self, text: str) -> None:
        if text and not self.state[1]:
            self.text.append(text)
            if self.linked and not self.state[3] and text.strip():
                self.linked = False

    def flush(self) -> None:
        """Ends the block of text that is open, if any."""
        words = references.unescape("".join(self.text)).split() if self.text else []
        if words:
            kind, _, within, _ = self.state
            piece = Piece(kind + (" a" if self.linked else ""), self.marks, words, self.inner, within)
            self.pieces.append(piece)
            self.marks, self.inner = [], []
        else:
            self.marks += self.inner
            self.inner = []
        self.text, self.linked = [], True

    def tag(self, name: str, ends: bool, block: bool) -> None:
        if block:
            self.flush()
        if not self.state[1]:
            label = ("/" if ends else "") + (name if name in KNOWN else "other")
            (self.marks if block else self.inner).append(label)

    def start(self, name: str, attributes: str) -> None:
        block = name in BLOCKS
        if block:
            self.flush()
        if block and self.names["p"]:
            self.end_open("p", ("table", "button", "td", "th", "caption", "object"))
        for row, holders in [ENDS[name]] if name in ENDS else []:
            for other in row:
                if self.names[other]:
                    self.end_open(other, holders)
        if name == "br":
            self.text.append(" ")
        if name in VOID:
            self.tag(name, False, block)
            return
        kind, barred, within, linked = self.state
        self.open.append((name, self.state))
        self.names[name] += 1
        how = self.bar(name, attributes, within > 0)
        if name in MARKERS and barred < 2 and how < 2:
            barred = 0
            within |= MARKERS[name]
        self.state = (name if block else kind, max(barred, how), within, linked or name == "a")
        self.tag(name, False, block)

    def bar(self, name: str, attributes: str, inside: bool) -> int:
        """Whether an element is never main text: 2 for good, 1 unless it holds a marker."""
        if name in NEVER:
            return 2
        names: set[str] = set()
        if attributes:
            if "hidden" in attributes or "none" in attributes:
                if HIDDEN.search(attributes):
                    return 2
            for found in NAMED.finditer(attributes):
                names.update(NAME.findall(HUMP.sub(" ", found[2]).lower()))
        if name in ("html", "body", "main"):
            return 0
        if not names.isdisjoint(COMMENTS):
            return 2
        if name == "article":
            return 0
        if name == "form" or (names.isdisjoint(ABOUT) and not names.isdisjoint(AROUND)):
            return 1
        if name == "header" or "header" in names:
            return 0 if inside or not names.isdisjoint(OF_TEXT) else 1
        return 0

    def close(self, name: str) -> None:
        block = name in BLOCKS
        if not self.names[name]:
            if block or name == "br":
                self.tag(name, True, block)
                self.text.append(" ")
            return
        self.tag(name, True, block)
        self.pop_to(name)

    def end_open(self, name: str, holders: Iterable[str]) -> None:
        """Closes an open element unless one that holds it for good was opened since."""
        for other, _ in reversed(self.open):
            if other == name:
                self.flush()
                self.pop_to(name)
                return
            if other in holders:
                return

    def pop_to(self, name: str) -> None:
        while True:
            other, state = self.open.pop()
            self.names[other] -= 1
            self.state = state
            if other == name:
                return


def pieces_of(page: str) -> list[Piece]:
    return Reader().read(page)


@dataclass(frozen=True)
class Weights:
    """Shares of words inside by kind of block and of tags outside by name; the scale of a tag's cost."""

    words: dict[str, float]
    tags: dict[str, float]
    scale: float

    def scores(self, pieces: list[Piece]) -> tuple[list[float], list[float]]:
        """Of every block, and of the gap before it."""
        words, tags = self.words, self.tags
        blocks = [
            len(p.words) * words.get(p.kind, prior_of(p.kind)) - self.scale * sum(tags.get(t, TAG_PRIOR) for t in p.inner)
            for p in pieces
        ]
        gaps = [-self.scale * sum(tags.get(t, TAG_PRIOR) for t in p.tags) for p in pieces]
        return blocks, gaps


# Counted besides what the labelled pages hold, so that no share is 0 or 1: the share inside of words of
# unseen kinds and of unseen kinds that are all links, the share outside of unseen tags, and how often.
PRIOR, LINKED_PRIOR, TAG_PRIOR, PRIOR_COUNT = 0.9, 0.3, 0.05, 10


def prior_of(kind: str) -> float:
    return LINKED_PRIOR if kind.endswith(" a") else PRIOR


def best_run(blocks: list[float], gaps: list[float]) -> tuple[int, int]:
    """First block of the best-scoring run and the block after its last; of equal runs the one found first."""
    best, found, running, start = 0.0, (0, 0), 0.0, 0
    for i, (block, gap) in enumerate(zip(blocks, gaps, strict=True)):
        if running + gap > 0:
            running += gap + block
        else:
            running, start = block, i
        if running > best:
            best, found = running, (start, i + 1)
    return found


def main_text(pieces: list[Piece], weights: Weights) -> str:
    start, end = best_run(*weights.scores(pieces))
    return "\n\n".join(" ".join(piece.words) for piece in pieces[start:end])


def counts_of(pages: Iterable[str]) -> Counter[tuple[str, str, bool]]:
    """Words by kind of block and tags by name, inside and outside, of the labelled among the pages."""
    counts: Counter[tuple[str, str, bool]] = Counter()
    for page in pages:
        pieces = pieces_of(page)
        if not any(piece.marked for piece in pieces):
            continue
        before = False
        for piece in pieces:
            counts["word", piece.kind, piece.marked] += len(piece.words)
            for tag in piece.inner:
                counts["tag", tag, piece.marked] += 1
            # A gap is inside where both of its ends are; the marker's own tags never are.
            for tag in piece.tags:
                counts["tag", tag, before and piece.marked and tag.lstrip("/") not in MARKERS] += 1
            before = piece.marked
    return counts


def weights_of(counts: dict[tuple[str, str, bool], int], scale: float) -> Weights:
    def share(what: str, name: str, inside: bool, prior: float) -> float:
        here, there = counts.get((what, name, inside), 0), counts.get((what, name, not inside), 0)
        return (here + prior * PRIOR_COUNT) / (here + there + PRIOR_COUNT)

    names = {(what, name) for what, name, _ in counts}
    return Weights(
        {name: share("word", name, True, prior_of(name)) for what, name in names if what == "word"},
        {name: share("tag", name, False, TAG_PRIOR) for what, name in names if what == "tag"},
        scale,
    )


def misses_of(pages: Iterable[str], choices: list[Weights]) -> Counter[int]:
    """Words wrongly in or out of the run on the labelled pages, by choice of weights."""
    misses: Counter[int] = Counter()
    for page in pages:
        pieces = pieces_of(page)
        if not any(piece.marked for piece in pieces):
            continue
        for choice, weights in enumerate(choices):
            start, end = best_run(*weights.scores(pieces))
            for i, piece in enumerate(pieces):
                if (start <= i < end) != piece.marked:
                    misses[choice] += len(piece.words)
    return misses


def train(
    pages: DataFrame, id_col: str = "page_id", html_col: str = "html", most_pages: int = 4096
) -> Weights:
    """Weights from the labelled ones among about ``most_pages`` pages, drawn by a hash of id and content.

    Two passes over the sample: one counts words and tags inside and outside,
    one tries the scales. Both add up in Spark; what comes back is one number
    per kind of block or tag that HTML knows. Without a labelled page every kind
    has its prior weight.
    """
    total = pages.count()
    read = pages.select(text_of(html_col).alias("html"), F.col(f"`{id_col}`").alias("id"))
    drawn = F.pmod(F.xxhash64(F.col("id").cast("string"), "html"), F.lit(1 << 32)) < (most_pages << 32) // max(total, 1)
    sample = materialise(read.where(drawn).select("html"), "labelled-pages")

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[tuple[str, str, bool]] = Counter()
        for part in parts:
            found.update(counts_of(x.as_py() for x in part.column("html")))
        columns = list(zip(*found, strict=True)) or [(), (), ()]
        types = [pa.string(), pa.string(), pa.bool_()]
        arrays = [pa.array(column, kind) for column, kind in zip(columns, types, strict=True)]
        yield pa.record_batch([*arrays, pa.array(found.values(), pa.int64())], names=["what", "name", "inside", "number"])

    rows = sample.mapInArrow(count, "what string, name string, inside boolean, number long")
    summed = rows.groupBy("what", "name", "inside").agg(F.sum("number").alias("number")).collect()
    counts = {(row.what, row.name, row.inside): row.number for row in summed}
    if not counts:
        return weights_of({}, DEFAULT_SCALE)
    choices = [weights_of(counts, scale) for scale in SCALES]

    def judge(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[int] = Counter()
        for part in parts:
            found.update(misses_of((x.as_py() for x in part.column("html")), choices))
        yield pa.record_batch([pa.array(found.keys(), pa.int32()), pa.array(found.values(), pa.int64())], names=["choice", "misses"])

    judged = sample.mapInArrow(judge, "choice int, misses long").groupBy("choice").agg(F.sum("misses").alias("misses"))
    misses = {row.choice: row.misses for row in judged.collect()}
    # Of equally good scales the one nearest to the default, then the smaller.
    ratio = [max(scale / DEFAULT_SCALE, DEFAULT_SCALE / scale) for scale in SCALES]
    return choices[min(range(len(SCALES)), key=lambda i: (misses.get(i, 0), ratio[i], i))]


def extract(
    pages: DataFrame, weights: Weights, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """One row per input row: ``id``, ``url`` as they were, ``text`` and ``n_chars`` (its code points).

    The text is the blocks of the best run, white space within a block one space,
    joined by an empty line; character references are decoded. Null and empty
    pages, and pages without a word outside what never is main text, give the
    empty text. A page cut off anywhere is read as if its open elements ended
    there. Repeated rows and null ids are rows of their own; an empty table gives
    no rows; other columns are not read. A page is read whole, in time and memory
    proportional to its length.
    """
    read = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").alias("url"), text_of(html_col).alias("html"))
    kinds = dict(read.dtypes)

    def task(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts = [main_text(pieces_of(x.as_py()), weights) for x in part.column("html")]
            yield pa.record_batch(
                [part.column("id"), part.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["id", "url", "text", "n_chars"],
            )

    return read.mapInArrow(task, f"id {kinds['id']}, url {kinds['url']}, text string, n_chars long")
