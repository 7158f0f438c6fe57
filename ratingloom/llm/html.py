"""Main text of web pages by tag-path ratios.

A page becomes a row of text blocks, each with its root-to-leaf path of block tags. Per path, text
length, punctuation and link text are summed over the page and divided by the path's number of
blocks; both ratios are smoothed over neighbouring blocks, fused, and compared with a threshold
taken from the page. The page's own article mark is one more signal of the fusion. It is believed
where it holds most of the page's text: then blocks outside it count nothing, and the threshold falls
for the blocks inside by the share of the text that their container has, to zero at half of it. A
notice or teaser in a box of its own inside the mark so has to pass by its ratios, and a short list
or heading beside the article's paragraphs has not. Paths through menus, headers, footers, sidebars,
notices, adverts, forms, scripts, styles and reader comments, known by their tags or class names,
are never candidates. A class or id name counts whole, or as a compound that ends in what it names; a name drops nothing
that surrounds the page's only marked article or, on a page without a mark, most of its text.

Each page is one value of one task and pages never meet, so nothing is shuffled or collected.

Defined cases: a null or empty page, or one without visible text, gives an empty text; broken
markup (unclosed or crossing tags) is read as browsers do for paragraphs and lists; a page of equal
blocks keeps them all; repeated rows and rows without an id give one output row each.
"""

from __future__ import annotations

import re
import sys
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame

from ratingloom.llm.common import map_rows

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Kinds of tags, as the HTML standard has them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike"
    " strong sub sup time tt u var wbr".split()
)
HIDDEN = frozenset("head script style noscript template svg math iframe object canvas audio video select datalist textarea".split())
BOILERPLATE = frozenset("nav header footer aside form button menu dialog fieldset".split())
ARTICLE = frozenset("article main".split())
#: An opening tag ends what is open of these, up to the nearest enclosing container.
ENDS = {
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]),
    "th": frozenset(["td", "th"]),
    "option": frozenset(["option"]),
}
CONTAINERS = frozenset(
    "html body article main section div table ul ol dl nav aside header footer form blockquote figure fieldset".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: What sets a part of a page apart.
BOXES = frozenset("html body article main section div".split())
#: Class and id words of what is no article text.
HINTS = frozenset(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments cookie cookies disqus footer"
    " header menu modal nav navbar navigation newsletter notice notices pagination popup promo related share sharing"
    " sidebar social sponsor sponsored subscribe toolbar widget".split()
)

#: What a compound name may have beside a hint.
COMPANIONS = frozenset(
    "area articles bar block bottom box consent container content global left links list main menu page posts primary"
    " right secondary section site sticky text top wrapper".split()
)
#: Hints that name the element wherever they end a compound, whatever is before them.
NAMING = frozenset(
    "ads advert adverts advertisement breadcrumb breadcrumbs comments cookie cookies disqus navigation newsletter pagination"
    " popup sidebar sponsor sponsored".split()
)
ABOUT = frozenset("has is no with without".split())
#: Reader comments may be most of a page.
COMMENTS = frozenset("comment comments disqus".split())
#: What may stand in a head; anything else ends it.
IN_HEAD = frozenset("base link meta noscript script style template title".split())

_NAME_PARTS = re.compile(r"[a-z]+")
_PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？]")
SMOOTHING = np.array([0.25, 0.5, 0.25])
THRESHOLD, LINK_SHARE = 0.8, 0.5


class Block(NamedTuple):
    path: str
    text: str
    linked: int
    in_article: bool
    container: str
    leaf: str


def hinted(name: str) -> bool:
    """Whether a class or id name is one of what is no article text."""
    parts = _NAME_PARTS.findall(name)
    if not parts or HINTS.isdisjoint(parts) or parts[0] in ABOUT:
        return False
    return parts[-1] in NAMING or all(part in HINTS or part in COMPANIONS for part in parts)


class _Hint:
    """An element whose name says that it is no article text, and the text found in it."""

    def __init__(self, comments: bool):
        self.comments, self.said, self.around = comments, 0, 0


class _Blocks(HTMLParser):
    """Collects the visible text blocks of a page in page order."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, str, bool, _Hint | None]] = []  # tag, path step, boilerplate or hidden, named so
        self.text: list[str] = []
        self.linked = 0
        self.found: list[tuple[Block, list[_Hint]]] = []

    @property
    def blocks(self) -> list[Block]:
        """The blocks under no hint, but for hints that surround the article or most of an unmarked page."""
        marked = [(block, hints) for block, hints in self.found if block.in_article]
        total = sum(len(block.text) for block, _ in marked or self.found)
        if all(any(hint.around for hint in hints) for _, hints in marked):
            spared = lambda hint: 2 * (hint.around if marked else hint.said) > total and not hint.comments
        else:
            spared = lambda hint: False
        return [block for block, hints in self.found if all(map(spared, hints))]

    def _flush(self) -> None:
        said = " ".join("".join(self.text).split())
        self.text = []
        linked, self.linked = self.linked, 0
        if said and not any(off for _, _, off, _ in self.open):
            steps = [(tag, step) for tag, step, _, _ in self.open if tag not in INLINE]
            path = "/".join(step for _, step in steps)
            boxed = max((i + 1 for i, (tag, _) in enumerate(steps) if tag in BOXES), default=0)
            container = "/".join(step for _, step in steps[:boxed])
            mark = next((i for i, (tag, _, _, _) in enumerate(self.open) if tag in ARTICLE), -1)
            hints = [(i, hint) for i, (_, _, _, hint) in enumerate(self.open) if hint]
            for i, hint in hints:
                hint.said += len(said)
                hint.around += len(said) if i < mark else 0
            self.found.append((Block(path, said, linked, mark >= 0, container, steps[-1][0] if steps else ""), [hint for _, hint in hints]))

    def _close(self, at: int) -> None:
        if any(tag not in INLINE for tag, _, _, _ in self.open[at:]):
            self._flush()
        del self.open[at:]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag not in IN_HEAD:
            self._end_head()
        if tag in VOID:
            if tag in ("br", "hr"):
                self.text.append(" ")
            return
        values = dict(attrs)
        names = f"{values.get('class') or ''} {values.get('id') or ''} {values.get('role') or ''}".lower().split()
        off = tag in HIDDEN or (tag in BOILERPLATE and not (tag == "header" and self._inside())) or "hidden" in values
        named = [name for name in names if hinted(name)] if tag not in ("html", "body") else []
        hint = _Hint(any(not COMMENTS.isdisjoint(_NAME_PARTS.findall(name)) for name in named)) if named else None
        if tag not in INLINE:
            self._end_implied(tag)
            self._flush()
        elif off or hint:
            self._flush()
        step = tag if not values.get("class") else f"{tag}.{values['class']}"
        is_main = "main" if values.get("role") == "main" and tag not in ARTICLE else tag
        self.open.append((is_main, step, off, hint))

    def _inside(self) -> bool:
        return any(tag in ARTICLE for tag, _, _, _ in self.open)

    def _end_head(self) -> None:
        """What cannot stand in a head ends one that is still open."""
        if self.open and self.open[-1][0] == "head":
            self._close(len(self.open) - 1)

    def _end_implied(self, tag: str) -> None:
        """Browsers end a paragraph where a block begins, and a list item where the next begins."""
        ends = ENDS.get(tag, frozenset())
        for at in range(len(self.open) - 1, -1, -1):
            name = self.open[at][0]
            if name == "p" or name in ends:
                self._close(at)
                if name in ends:
                    return
            elif name in CONTAINERS:
                return

    def handle_endtag(self, tag: str) -> None:
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at][0] == tag or self.open[at][1].split(".")[0] == tag:
                if (self.open[at][2] or self.open[at][3]) and tag in INLINE:
                    self._flush()
                self._close(at)
                return

    def handle_data(self, data: str) -> None:
        if data.strip():
            self._end_head()
        self.text.append(data)
        if any(tag == "a" for tag, _, _, _ in self.open):
            self.linked += len(data.strip())

    def close(self) -> None:
        super().close()
        self._flush()


def page_blocks(html: str) -> list[Block]:
    parser = _Blocks()
    parser.feed(html)
    parser.close()
    return parser.blocks


def _smooth(values: np.ndarray) -> np.ndarray:
    padded = np.concatenate((values[:1], values, values[-1:]))
    return np.convolve(padded, SMOOTHING, "valid")


def _shares(blocks: list[Block], paths: list[str], said: np.ndarray) -> np.ndarray:
    """Per block the share of the page's text that its container has, given the text of the sorted paths."""
    upto = np.concatenate(([0.0], np.cumsum(said)))
    shares = {}
    for box in {b.container for b in blocks}:
        # All paths below a box lie together, and the box's own path apart from them.
        below = upto[bisect_left(paths, f"{box}0")] - upto[bisect_left(paths, f"{box}/")] if box else upto[-1]
        own = upto[bisect_right(paths, box)] - upto[bisect_left(paths, box)] if box else 0.0
        shares[box] = (below + own) / upto[-1]
    return np.array([shares[b.container] for b in blocks])


def content_mask(blocks: list[Block], threshold: float = THRESHOLD, link_share: float = LINK_SHARE) -> np.ndarray:
    """Which blocks are content."""
    paths, which = np.unique([b.path for b in blocks], return_inverse=True)
    size = np.array([len(b.text) for b in blocks], float)
    marks = np.array([len(_PUNCTUATION.findall(b.text)) for b in blocks], float)
    linked = np.array([min(b.linked, len(b.text)) for b in blocks], float)
    per_path = lambda values: np.bincount(which, values, len(paths))
    nodes = np.bincount(which, minlength=len(paths))
    mostly_links = (per_path(linked) > link_share * per_path(size))[which]
    text_ratio = _smooth(((per_path(size) - per_path(linked)) / nodes)[which])
    mark_ratio = _smooth((per_path(marks) / nodes)[which])
    fused = text_ratio * (1 + mark_ratio)
    in_article = np.array([b.in_article for b in blocks])
    signal = np.zeros(len(blocks))
    if 2 * (size - linked)[in_article].sum() > (size - linked).sum():
        fused = np.where(in_article, fused, 0.0)
        signal = in_article * np.minimum(1.0, 2 * _shares(blocks, paths.tolist(), per_path(size - linked)))
        # A title or heading in a box of its own goes with the text after it.
        for i in range(len(blocks) - 1, -1, -1):
            if blocks[i].in_article and blocks[i].leaf in HEADINGS:
                signal[i] = 1.0 if blocks[i].leaf == "h1" else max(signal[i : i + 2])
    # A path is judged as a whole, so a short paragraph stays with the long ones beside it.
    of_path = (per_path(fused) / nodes)[which]
    least = np.minimum(threshold * float(np.std(fused)), float(of_path.max())) * (1 - signal)
    return (of_path >= least) & ~mostly_links


def main_text(html: str | None) -> tuple[str, list[Block]]:
    """The content of a page as one line, and its blocks."""
    blocks = page_blocks(html) if html else []
    if not blocks:
        return "", []
    kept = [b for b, keep in zip(blocks, content_mask(blocks).tolist(), strict=True) if keep]
    return " ".join(b.text for b in kept), kept


def extract(df: DataFrame, html_col: str = "html", id_cols: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """(id_cols, text, n_chars, blocks): the main text of every page, its code points, and the kept
    blocks with their tag paths."""
    rows = df.select(*id_cols, html_col)
    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in id_cols)
    return map_rows(rows, _extractor, f"{kinds}, text string, n_chars bigint, blocks array<struct<path: string, text: string>>")


def _extractor() -> Callable[..., Iterator[tuple]]:
    def apply(*values: object) -> Iterator[tuple]:
        *ids, html = values
        text, kept = main_text(html)
        yield *ids, text, len(text), [{"path": b.path, "text": b.text} for b in kept]

    return apply
