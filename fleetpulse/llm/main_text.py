"""Main text of a page as its maximum-scoring contiguous region.

A page is read as a sequence of words and tags. Words score positive and tags negative, with
weights learned from labelled pages (those that mark their article) as log odds of lying inside
it. One linear scan finds the contiguous region whose weights sum to the most. Menus, headers,
footers, sidebars, notices, adverts, forms, scripts and reader comments have no words that count,
and are left out of the text where the region runs across them. Inside an article the name of an
element is a learned negative score of its words, and being inside one a learned bonus. Outside,
a name that may as well be that of a text's part lowers the score of each word.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.common import as_field, fields, map_batches

LABELLED_PAGES = 2000  # the weights are learned from about so many pages

LIGHT_TAG = -0.1  # tags score at most this; inside a marked article or a block's text no less

# Elements whose content is no markup, elements that begin and end a block of text,
# elements without content, elements that hold no main text, and words of a class, id or role
# that say the same.
RAW = frozenset("script style textarea title noscript template iframe svg math object canvas".split())
BLOCKS = frozenset(
    """address article aside blockquote body br button caption center dd details dialog div dl dt
    fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main
    menu nav ol option p pre section select summary table tbody td tfoot th thead tr ul""".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ASIDE = frozenset("nav header footer aside form menu button select dialog head".split())
ASIDE_WORD = re.compile(
    r"""(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|menu\w*|nav|navbar|navigation|breadcrumbs?|
    header|masthead|footer|sidebar\w*|widget|comments?|commentlist|discussion|disqus|repl(?:y|ies)|
    respond|cookies?|consent|notices?|alerts?|gdpr|popup|modal|overlay|subscri\w+|newsletter|
    signup|login|share|sharing|social|related|recommend\w*|pagination|pager|toolbar|
    complementary|contentinfo|search)""",
    re.X | re.I,
)
STEMS = ("advert", "sponsor", "menu", "sidebar", "subscri", "recommend")  # of names with any ending
# Of these words, the ones that also name wrappers around everything: an article inside still counts.
WRAPPER_WORD = re.compile(r"(?:sidebar\w*|widget|header|banner|nav|navbar|menu\w*|overlay|modal|search)", re.I)
# And the ones that also name parts of a text: their score decides. The last stands for the element
# ``header`` inside an article, which is no class, id or role.
UNSURE_WORD = re.compile(
    r"(?:related|search|share|sharing|social|discussion|notices?|alerts?|header|masthead|banner|own-header)", re.I
)
ARTICLE = frozenset(("article", "main"))
# Elements whose ids are often made from their heading or text.
FREE_ID = frozenset("h1 h2 h3 h4 h5 h6 p section article main li dt dd blockquote figure table tr td".split())
SURE_NAME, UNSURE_NAME = -4.0, -0.3  # scores of names that labelled pages do not have
UNSURE_OUTSIDE = 0.05  # what such a name leaves of a word's score outside an article

# Elements whose start ends an open one of these kinds, unless a container lies between.
CLOSES = {
    "p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"},
    "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
}
CONTAINERS = frozenset(
    "ul ol dl table article section div nav aside footer header form main body select".split()
)

_MARKUP = re.compile(
    r"""<!--.*?(?:-->|\Z) | <[!?][^>]*(?:>|\Z) | </(?=[^a-zA-Z])[^>]*(?:>|\Z) |
    <(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:=\s*+"[^"]*+"|=\s*+'[^']*+'|[^>])*+)(?:>|\Z)""",
    re.S | re.X,
)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?|"[^"]*"|'[^']*'""")
_NO_DISPLAY = re.compile(r"display\s*:\s*none", re.I)
_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")


@dataclass
class Block:
    """Text between two block boundaries, with what the scan needs to know of it."""

    text: str
    words: int
    link_words: int
    aside: bool
    in_article: bool
    tags: tuple[str, ...]  # met since the block before
    name: str = ""  # aside name of an element around it


NOT, WRAPPER, ASIDE_FOR_SURE = 0, 1, 2


def _attributes(rest: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for match in _ATTRIBUTE.finditer(rest):
        if match[1]:
            found.setdefault(match[1].lower(), next((g for g in match.groups()[1:] if g is not None), ""))
    return found


def _says_aside(rest: str, element: str = "div", inside: bool = False) -> tuple[int, str]:
    """How surely the attributes of an element say aside, and the name that says so."""
    if not rest.strip("/ \t\r\n"):
        return NOT, ""
    given = _attributes(rest)
    if (
        "hidden" in given
        or given.get("aria-hidden", "").strip().lower() == "true"
        or _NO_DISPLAY.search(given.get("style", ""))
    ):
        return ASIDE_FOR_SURE, ""
    said, name = NOT, ""
    for kind in ("class", "role") if inside or element in FREE_ID else ("class", "role", "id"):
        for part in _PARTS.findall(given.get(kind, "")):
            if ASIDE_WORD.fullmatch(part):
                said = max(said, WRAPPER if WRAPPER_WORD.fullmatch(part) else ASIDE_FOR_SURE)
                name = _surer(name, next((s for s in STEMS if part.lower().startswith(s)), part.lower()))
    return said, name


def _surer(outer: str, own: str) -> str:
    return own if own and (not outer or UNSURE_WORD.fullmatch(outer)) else outer


def blocks_of(page: str) -> list[Block]:
    """The blocks of a page in order. Unclosed, crossed and cut-off elements are put up with."""
    found: list[Block] = []
    # Element, how surely aside, whether inside an article, name, whether its words never count.
    stack: list[tuple[str, int, bool, str, bool]] = []
    pieces: list[tuple[str, bool]] = []
    tags: list[str] = []
    links = at = 0

    def state() -> tuple[int, bool, str, bool]:
        return stack[-1][1:] if stack else (NOT, False, "", False)

    def close_block() -> None:
        nonlocal pieces, tags
        text = html.unescape("".join(p for p, _ in pieces)).split()
        if text:
            linked = len(html.unescape(" ".join(p for p, link in pieces if link)).split())
            _, inside, named, out = state()
            words = len(text)
            found.append(Block(" ".join(text), words, min(linked, words), out, inside, tuple(tags), named))
            tags = []
        pieces = []

    while at < len(page):
        match = _MARKUP.search(page, at)
        if match is None:
            pieces.append((page[at:], links > 0))
            break
        if match.start() > at:
            pieces.append((page[at : match.start()], links > 0))
        at = match.end()
        if match["name"] is None:
            continue
        name, rest = match["name"].lower(), match["rest"]
        aside, inside, named, out = state()
        if not out and (inside or not named):
            tags.append(name)
        if match["end"]:
            if name in BLOCKS:
                close_block()
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == name:
                    del stack[depth:]
                    break
            links = sum(e[0] == "a" for e in stack)
            continue
        if name in RAW:
            close = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
            at = close.end() if close else len(page)
            continue
        if name in BLOCKS:
            close_block()
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] in CLOSES.get(name, ()):
                    del stack[depth:]
                elif stack[depth][0] in CONTAINERS:
                    break
        if name in VOID or rest.endswith("/"):
            continue
        own, own_name = NOT, ""
        if name in ASIDE and not (name == "header" and inside):
            own = ASIDE_FOR_SURE
        elif name not in ("html", "body"):
            own, own_name = _says_aside(rest, name, inside)
            if name == "header" and own == NOT:
                own_name = "own-header"
        if name in ARTICLE and own == NOT and aside < ASIDE_FOR_SURE:
            # An article inside a wrapper named like a sidebar counts, one among comments does not.
            named = named if inside else ""
            aside, inside, out = NOT, True, False
        elif inside and own_name:
            own = NOT  # its score decides
        elif own != NOT:
            out |= not UNSURE_WORD.fullmatch(own_name)
        stack.append((name, max(aside, own), inside, _surer(named, own_name), out))
        links += name == "a"
    close_block()
    return found


@dataclass(frozen=True)
class Weights:
    """Scores of words and tags. Tags not seen in labelled pages get ``other_tag``."""

    word: float = 1.0
    link_word: float = -0.5
    article_bonus: float = 1.0  # of a word inside an article
    tags: tuple[tuple[str, float], ...] = ()
    other_tag: float = -0.3
    names: tuple[tuple[str, float], ...] = ()  # of a word in an element so named


def _clip(value: float, low: float, high: float) -> float:
    return min(max(value, low), high)


def learn(counts: dict[tuple[str, bool], int]) -> Weights:
    """Log odds of lying inside the article, from counts of (kind, inside), by sign of the kind."""
    if not counts:
        return Weights()
    inside = sum(n for (_, i), n in counts.items() if i) + 1
    outside = sum(n for (_, i), n in counts.items() if not i) + 1
    kinds = {kind for kind, _ in counts}

    def odds(kind: str) -> float:
        return math.log((counts.get((kind, True), 0) + 1) / inside) - math.log(
            (counts.get((kind, False), 0) + 1) / outside
        )

    tags = {k[1:]: _clip(odds(k), -1.0, LIGHT_TAG) for k in kinds if k[0] == "<"}
    names = {
        k[1:]: _clip(odds(k), -2.0, -0.1) if UNSURE_WORD.fullmatch(k[1:]) else _clip(odds(k), -6.0, SURE_NAME)
        for k in kinds
        if k[0] == "@"
    }
    ratio = (counts.get(("word", True), 0) + 1) / (counts.get(("word", False), 0) + 1)
    return Weights(
        word=_clip(odds("word"), 0.5, 2.0),
        link_word=_clip(odds("link"), -2.0, 1.0) if "link" in kinds else -0.5,
        article_bonus=_clip(math.log(ratio), 0.0, 2.0),
        tags=tuple(sorted(tags.items())),
        names=tuple(sorted(names.items())),
    )


def count_kinds(page: str) -> Counter[tuple[str, bool]]:
    """(kind, inside the article) counts of a page that marks its article, else nothing.

    Kinds are the tags of ``BLOCKS``, all others as one, and the words of aside names by their stem:
    a fixed set. The score of another tag does not depend on its name.
    """
    counts: Counter[tuple[str, bool]] = Counter()
    blocks = blocks_of(page)
    if not any(b.in_article and not b.aside for b in blocks):
        return counts
    for b in blocks:
        inside = b.in_article and not b.aside
        if b.name:
            counts[f"@{b.name}", inside] += b.words
        elif not b.aside:  # words of asides never score
            counts["word", inside] += b.words - b.link_words
            counts["link", inside] += b.link_words
        for tag in b.tags:
            counts[f"<{tag}" if tag in BLOCKS else "<", inside] += 1
    return +counts


def best_region(scores: list[float]) -> tuple[int, int]:
    """Half-open bounds of the contiguous part with the largest sum; the first of equal ones."""
    best, bounds = 0.0, (0, 0)
    total, start = 0.0, 0
    for i, score in enumerate(scores):
        if total < 0:
            total, start = 0.0, i
        total += score
        if total > best:
            best, bounds = total, (start, i + 1)
    return bounds


def main_text(page: str | None, weights: Weights = Weights()) -> str:
    """The text of the best region, blocks joined by one space; empty if no word scores."""
    blocks = blocks_of(page or "")
    tag_weight, name_weight = dict(weights.tags), dict(weights.names)
    scores, owner = [], []
    for number, block in enumerate(blocks):
        for tag in block.tags:
            known = tag_weight.get(tag, weights.other_tag)
            light = block.in_article or tag not in BLOCKS  # marks within a text do not end a region
            scores.append(max(known, LIGHT_TAG) if light else known)
            owner.append(-1)
        if block.aside or block.in_article and not _kept(block, weights, name_weight):
            continue
        plain = weights.word + (weights.article_bonus if block.in_article else 0.0)
        linked = min(plain, weights.link_word) if not block.in_article else plain
        score = plain * (block.words - block.link_words) + linked * block.link_words
        if block.name and not block.in_article:
            score += name_weight.get(block.name, (UNSURE_OUTSIDE - 1) * weights.word) * block.words
            if score <= 0:
                continue
        scores.append(score)
        owner.append(number)
    first, last = best_region(scores)
    return " ".join(blocks[n].text for n in owner[first:last] if n >= 0)


def _kept(block: Block, weights: Weights, names: dict[str, float]) -> bool:
    """Whether the words of a named element inside an article score more than its name costs."""
    if not block.name:
        return True
    unseen = UNSURE_NAME if UNSURE_WORD.fullmatch(block.name) else SURE_NAME
    linked = min(weights.word, weights.link_word) * block.link_words
    return weights.word * (block.words - block.link_words) + linked + names.get(block.name, unseen) * block.words > 0


def learned_weights(pages: DataFrame, most: int = LABELLED_PAGES) -> Weights:
    """Weights from about ``most`` pages chosen by a hash of their text; all pages if fewer."""
    share = min(1.0, most / max(pages.count(), 1))
    bucket = F.pmod(F.xxhash64("html"), F.lit(1_000_000))
    sample = pages.select("html").where(bucket < math.ceil(share * 1_000_000))

    def rows(columns):
        total: Counter[tuple[str, bool]] = Counter()
        for page in columns["html"].to_pylist():
            total.update(count_kinds(page or ""))
        keys = list(total)
        return {
            "kind": [k for k, _ in keys],
            "inside": [i for _, i in keys],
            "n": [total[k] for k in keys],
        }

    counted = map_batches(sample, rows, fields("kind string", "inside boolean", "n bigint"))
    total = counted.groupBy("kind", "inside").agg(F.sum("n").alias("n"))  # kinds are a fixed set
    return learn({(r["kind"], r["inside"]): r["n"] for r in total.collect()})


def extract(pages: DataFrame, keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """One row per row of ``pages``: the ``keep`` columns, text and n_chars (code points).

    A null or empty page, and one without main text, has the empty text. Whole pages are read
    however long; repeated pages are extracted each; an empty table gives no rows. Columns named
    text or n_chars that are not in ``keep`` are not read.
    """
    weights = learned_weights(pages)

    def rows(columns):
        texts = [main_text(p, weights) for p in columns["_html"].to_pylist()]
        kept = {f"_{i}": columns[f"_{i}"] for i in range(len(keep))}
        return {**kept, "text": texts, "n_chars": list(map(len, texts))}

    slim = pages.select(*(F.col(c).alias(f"_{i}") for i, c in enumerate(keep)), F.col("html").alias("_html"))
    own = (as_field(pages, c, f"_{i}") for i, c in enumerate(keep))
    made = map_batches(slim, rows, fields(*own, "text string", "n_chars bigint"), most=200)
    return made.toDF(*keep, "text", "n_chars")
