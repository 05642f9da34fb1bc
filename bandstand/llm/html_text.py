"""Main text of web pages by block rules in two passes.

A page is cut into blocks at its block elements. The first pass decides blocks by themselves: parts that are never the
article (menus, forms, adverts and so on) and blocks full of links are out, longer blocks with enough stop words
are in, the rest stays open. In the second pass each open block takes the side of its nearest decided neighbour in the
same part of the page; without one, the part decides. A class or id word does not silence an element that holds nearly
all main text, and where no block is in, the open ones stay.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# Function words that running text is full of, by language.
STOP_WORDS = {
    "en": "the of and to in is it that for on with as are be by was this at from an or not but have has he she they we you a".split(),
    "de": "der die das und ist in den von zu mit sich des auf für nicht ein eine als auch es an dem im er sie wir so aus bei nach".split(),
    "fr": "le la les de des du un une et est en que qui dans pour par sur au aux ne pas ce il elle se plus avec son sa ou été être".split(),
    "es": "el la los las de del un una y es en que por para con se su al lo como más o pero sus le ha no era ser entre".split(),
    "it": "il lo la i gli le di del della un una e è in che per con si su da al non come più o ma sono nel alla".split(),
    "pt": "o a os as de do da um uma e é em que por para com se no na não mais como mas ao dos das seu sua ou ser".split(),
    "nl": "de het een en van in is dat op te zijn met voor niet aan er om ook als dan maar bij uit nog naar door over ze hij".split(),
}
_ALL_STOP_WORDS = {name: frozenset(words) for name, words in STOP_WORDS.items()}

_BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead tr ul".split()
)
_NOT_PUSHED = frozenset("p hr li dt dd option h1 h2 h3 h4 h5 h6 tr td th".split())
_RAW = frozenset("script style title noscript template textarea svg math iframe object canvas audio video".split())
_NEVER = frozenset("nav footer aside form button select menu dialog fieldset figcaption head".split())
_NEVER_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar toolbar form tablist".split())
_NEVER_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner menu nav navbar navigation breadcrumb breadcrumbs "
    "sidebar widget widgets footer header masthead comment comments reply replies disqus cookie cookies consent gdpr notice notices alert popup "
    "modal overlay share sharing social related recommended newsletter subscribe signup login search pagination pager toc copyright legal "
    "disclaimer form toolbar skip".split()
)
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^\"'>]++|\"[^\"]*+\"|'[^']*+')*+|[^>]*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_WORD = re.compile(r"[^\W\d_]+")
_NOTICE = re.compile(r"(?:copyright\W*)?\N{COPYRIGHT SIGN}", re.I)
IN, OUT, OPEN = 1, -1, 0


@dataclass(frozen=True)
class BlockRules:
    """Share of linked characters that rules a block out, code points and stop word share that let it in, and the
    length up to which a block with a copyright sign is out."""

    most_linked: float = 0.4
    least_chars: int = 60
    least_stop_share: float = 0.12
    notice_chars: int = 200


@dataclass
class Block:
    text: str
    linked: int
    never: bool
    article: bool
    part: int
    # Open elements that a class or id word takes for no main text, outer ones first.
    named: tuple | None = None  # the innermost named element and the chain around it, shared by its blocks


def _names(attributes: str) -> tuple[bool, bool]:
    """Whether the attributes say that the element is no main text, and whether its class or id has a word that says so."""
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)} if attributes.strip() else {}
    words = re.split(r"[^a-z0-9]+", re.sub(r"([a-z])([A-Z])", r"\1-\2", f"{found.get('class', '')} {found.get('id', '')}").lower())
    hidden = "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "").lower()
    return hidden or found.get("role", "").lower() in _NEVER_ROLES, not _NEVER_NAMES.isdisjoint(words)


def page_blocks(page: str) -> list[Block]:
    """Blocks of text in page order. Broken markup is read as far as it goes; an unfinished tag at the end is dropped."""
    blocks: list[Block] = []
    # Open elements: name, inside something that is never main text, inside an article, part of the page, named elements.
    stack: list[tuple[str, bool, bool, int, tuple | None]] = [("", False, False, 0, None)]
    opened: Counter[str] = Counter()
    parts, breaks, linked_depth, linked = 0, 0, 0, 0
    pieces: list[str] = []
    here = never_p = False

    def flush() -> None:
        nonlocal linked, pieces
        text = " ".join(html.unescape("".join(pieces)).split())
        if text:
            _, never, article, part, silent = stack[-1]
            blocks.append(Block(text, linked, never or never_p, article, part, silent))
        pieces, linked = [], 0

    at, end = 0, len(page)
    while at < end:
        tag = _TAG.search(page, at)
        text = page[at : tag.start() if tag else end]
        if text:
            pieces.append(text)
            if linked_depth:
                linked += len("".join(html.unescape(text).split()))
            if not text.isspace():
                breaks = 0
        if not tag:
            break
        at = tag.end()
        closing, name, attributes = tag[1], (tag[2] or "").lower(), tag[3] or ""
        if not name:
            continue
        if name in _RAW and not closing:
            if not attributes.endswith("/"):
                over = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
                at = over.end() if over else end
            continue
        if name == "a":
            linked_depth = 0 if closing else 1
        elif name == "br":
            breaks += 1
            pieces.append(" ")
            if breaks > 1:
                flush()
        elif name in _BLOCKS:
            flush()
            breaks = linked_depth = 0
            if closing:
                never_p = False
                # An end tag without its start tag closes nothing; the others take off what they walk.
                while opened[name]:
                    last = stack.pop()[0]
                    opened[last] -= 1
                    if last == name:
                        break
            else:
                here, named = _names(attributes)
                if name in _NOT_PUSHED:
                    never_p = here or named
                    continue
                never_p = False
                _, never, article, part, silent = stack[-1]
                starts = name in ("article", "main")
                if name == "header":
                    here = here or not article
                if starts and not (opened["article"] or opened["main"]):
                    never, silent = False, None
                never = never or here or name in _NEVER
                if named and name not in ("html", "body"):
                    silent = (tag.start(), silent)
                if name in ("article", "main", "section", "nav", "aside", "header", "footer", "form"):
                    parts += 1
                    part = parts
                opened[name] += 1
                stack.append((name, never, article or starts, part, silent))
    flush()
    return blocks


def _page_words(words: Counter[str]) -> frozenset[str] | None:
    """The stop words of the language that the page has most of; None if it has none of any."""
    counts = {name: sum(words[w] for w in known) for name, known in _ALL_STOP_WORDS.items()}
    best = max(counts, key=counts.get)
    return _ALL_STOP_WORDS[best] if counts[best] * 25 > words.total() else None


def _first_pass(blocks: list[Block], rules: BlockRules) -> list[int]:
    words = [[] if b.never else _WORD.findall(b.text.lower()) for b in blocks]
    stop_words = _page_words(Counter(chain.from_iterable(words)))
    side = []
    for b, own in zip(blocks, words):
        chars = len(b.text)
        if b.never or b.linked > rules.most_linked * chars:
            side.append(OUT)
        elif chars <= rules.notice_chars and (_NOTICE.match(b.text) if b.article else "\N{COPYRIGHT SIGN}" in b.text):
            side.append(OUT)
        elif chars < rules.least_chars or not own:
            side.append(OPEN)
        elif stop_words is None or sum(w in stop_words for w in own) >= rules.least_stop_share * len(own):
            side.append(IN)
        else:
            side.append(OPEN)
    # An article rules out what is outside it if it holds most of the text that is in, or that is open where none is in.
    kind = IN if IN in side else OPEN
    inside = sum(len(b.text) for b, s in zip(blocks, side) if s == kind and b.article)
    if 2 * inside > sum(len(b.text) for b, s in zip(blocks, side) if s == kind):
        side = [s if b.article else OUT for b, s in zip(blocks, side)]
    return side


def _heard(blocks: list[Block], rules: BlockRules) -> list[Block]:
    """The blocks, silenced by those named elements only that do not hold nearly all main text.

    An element is heard if it holds most of the page's text and what is in without it is less than a tenth of that.
    """
    around: dict[int, int | None] = {}
    held: Counter[int] = Counter()
    for b in blocks:
        element = b.named
        while element and element[0] not in around:
            at, outer = element
            around[at], element = outer and outer[0], outer
        if b.named and not b.never:
            held[b.named[0]] += len(b.text)
    inward = sorted(around)  # an element starts after those around it
    for k in reversed(inward):
        if around[k] is not None:
            held[around[k]] += held[k]
    total = sum(len(b.text) for b in blocks)
    heard: set[int] = set()

    def silenced() -> list[Block]:
        quiet: set[int] = set()
        for k in inward:
            if k not in heard or around[k] in quiet:
                quiet.add(k)
        return [replace(b, never=True) if b.named and b.named[0] in quiet else b for b in blocks]

    out = silenced()
    # Elements with most of the text lie in each other; outer ones come first, those that hold the same text together.
    for size in sorted({n for n in held.values() if 2 * n > total}, reverse=True):
        if sum(len(b.text) for b, s in zip(out, _first_pass(out, rules)) if s == IN) * 10 >= size:
            break
        heard.update(k for k, n in held.items() if n == size)
        out = silenced()
    return out


def classify(blocks: list[Block], rules: BlockRules = BlockRules()) -> list[bool]:
    """Which blocks are main text."""
    blocks = _heard(blocks, rules)
    side = _first_pass(blocks, rules)
    if IN not in side:
        return [s == OPEN for s in side]
    # Neighbours in the article are those of the article; elsewhere those of the same part of the page.
    part = [-1 if b.article else b.part for b in blocks]
    distance = [len(blocks) + 1] * len(blocks)
    out = side.copy()
    order = range(len(blocks))
    for walk in (order, reversed(order)):
        last: dict[int, int] = {}
        for k in walk:
            if blocks[k].never:
                continue
            if side[k] != OPEN:
                last[part[k]] = k
            elif part[k] in last:
                near = last[part[k]]
                # Of two neighbours at the same distance the one that is in decides.
                if (abs(near - k), -side[near]) < (distance[k], -out[k]):
                    distance[k], out[k] = abs(near - k), side[near]
    return [s == IN or (s == OPEN and b.article) for s, b in zip(out, blocks)]


def main_text(page: str | None, rules: BlockRules = BlockRules()) -> str:
    """The main blocks of a page, one per line; empty for a null page or one without main text."""
    blocks = page_blocks(page or "")
    return "\n".join(b.text for b, keep in zip(blocks, classify(blocks, rules)) if keep)


def extract_pages(pages: DataFrame, id_column: str, url_column: str, html_column: str, rules: BlockRules = BlockRules()) -> DataFrame:
    """Per row ``page_id, url, text, n_chars``; the whole page is read.

    A null page has an empty text; null ids and urls stay null; repeated rows are read one by one; an empty table
    gives an empty result; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                rows = batch.slice(lo, 256)
                texts = [main_text(page, rules_) for page in rows.column(2).to_pylist()]
                columns = [rows.column(0), rows.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])

    rules_ = rules
    picked = pages.select(
        F.col(id_column).cast("long").alias("page_id"), F.col(url_column).cast("string").alias("url"), F.col(html_column).cast("string").alias("html")
    )
    return picked.mapInArrow(run, "page_id long, url string, text string, n_chars long")
