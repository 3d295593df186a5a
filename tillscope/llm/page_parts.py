"""Web pages as blocks of words with the elements they stand in, and the best region of them."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape
from math import log
from typing import NamedTuple

# Element names of the HTML standard, by what they mean for text.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q s "
    "samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset(
    "head script style noscript template iframe object svg math canvas textarea select button "
    "form nav footer aside menu dialog".split()
)
RAW = frozenset("script style textarea title noscript iframe xmp".split())
PARAGRAPH_ENDS = frozenset(
    "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main "
    "nav ol p pre section table ul".split()
)
# Words in class, id and role that name parts which are not the article. They bar
# an element only if all of a name is made of them and of words for layout.
NOT_ARTICLE = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner "
    "nav navbar navigation menu menubar breadcrumb breadcrumbs header masthead footer sidebar aside "
    "cookie cookies consent notice notices notification alert popup modal overlay newsletter subscribe "
    "signup login form search share sharing social related recommended comment comments commentlist "
    "discussion reply replies respond disqus widget toolbar pagination pager copyright legal "
    "complementary contentinfo hidden".split()
)
# Of these, the ones that name what readers or advertisers wrote, however long it is.
OTHERS_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion "
    "related recommended comment comments commentlist discussion reply replies respond disqus".split()
)
# Words that say where or how a part is laid out, or whose it is, but not what it is.
LAYOUT = frozenset(
    "area block body bottom box column container content entry group holder inner item left list outer "
    "panel reader readers right section slot thread top unit user users wrap wrapper".split()
)
#: Names written as one word, such as ``adbox``.
_JOINED = {word + layout: word for word in sorted(NOT_ARTICLE) for layout in sorted(LAYOUT)}
ARTICLE = frozenset(["article", "main"])
#: A page or article of which less than this is left without a part had its name for another reason.
LEAST_LEFT = 0.1
# Of these, an article has its own: its heading.
HEADERS = frozenset(["header", "masthead"])
# Elements that say nothing about what they hold.
GENERIC = frozenset("html body div section table tbody tr td".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attributes>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<close2>/?)(?P<name2>[a-zA-Z][^\s/>]*+)(?P<attributes2>[^>]*+)(?:>|\Z)",
    re.DOTALL,
)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_WORDS = re.compile(r"[^\W_]+")
_QUOTED = re.compile(r"\"[^\"]*\"|'[^']*'")
_BLANKS = re.compile(r"\s+")


TAG_COST = 0.1
#: Log odds of a listed word that no learned page has.
UNLEARNED = -2.0


class Block(NamedTuple):
    """Text between two breaks, the number of tags before it and the names of where it stands."""

    text: str
    tags: float
    names: frozenset[str]
    barred: bool
    article: bool


class Part(NamedTuple):
    """An element with listed words in its names: these words, whether a name is all of them, and whose words it has."""

    listed: frozenset[str]
    whole: bool
    others: bool


def _element_names(name: str, attributes: str, in_article: bool) -> tuple[frozenset[str], bool, Part | None]:
    """Names an element goes by, whether it is barred as such, and what its names say against it."""
    given, listed, whole, others = set(), set(), False, False
    if "=" in attributes:
        for found in _NAMES.finditer(attributes):
            for token in next(g for g in found.groups() if g is not None).lower().split():
                parts = {_JOINED.get(word, word) for word in _WORDS.findall(token)}
                given |= parts
                bars = (parts & NOT_ARTICLE) - (HEADERS if in_article else set())
                listed |= bars
                if bars and all(word in bars or word in LAYOUT or word.isdigit() for word in parts):
                    whole, others = True, others or not bars.isdisjoint(OTHERS_WORDS)
    if name in ("body", "html") or (name in ARTICLE and not others):
        listed = set()
    part = Part(frozenset(f".{w}" for w in listed), whole, others) if listed else None
    barred = name in HIDDEN or (name == "header" and not in_article)
    if "hidden" in attributes and not barred:
        barred = "hidden" in re.split(r"[\s=/]+", _QUOTED.sub("", attributes))
    return frozenset([name, *(f".{w}" for w in given - listed)]), barred, part


def blocks(html: str) -> Iterator[Block]:
    """Blocks of a page in order. Broken, unclosed and cut-off markup is taken as browsers do.

    A part with a listed word among others in its name counts as if it had no such name if it holds half
    of the words in the page's articles, or, where none are marked, more than half of all words. A part
    barred by its whole name must besides hold a marked article, or leave hardly anything of the
    article or page without it; the latter does not do for comments and adverts where anything is left.
    """
    parts: list[Part] = []
    around: set[int] = set()
    found = list(_raw_blocks(html, parts, around))
    words, in_article = Counter[int](), Counter[int]()
    total = total_in_article = left = left_in_article = 0
    for block, inside, _ in found:
        n = len(block.text.split())
        own = n if block.article and not block.barred else 0
        total, total_in_article = total + n, total_in_article + own
        if not block.barred and not any(parts[k].whole for k in inside):
            left, left_in_article = left + n, left_in_article + own
        for k in inside:
            words[k] += n
            in_article[k] += own
    if total_in_article:
        most = [2 * in_article[k] >= total_in_article for k in range(len(parts))]
        left_share = left_in_article / total_in_article
    else:
        most = [2 * words[k] > total for k in range(len(parts))]
        left_share = left / max(total, 1)
    stands = []
    for k, part in enumerate(parts):
        needed = left_share == 0 if part.others else left_share < LEAST_LEFT
        stands.append(not (most[k] and (not part.whole or k in around or needed)))
    for block, inside, tags in found:
        held = [parts[k] for k in inside if stands[k]]
        yield block._replace(
            # Tags in barred parts are no more of the article than their words.
            tags=sum(n for at, n in tags.items() if not any(stands[k] and parts[k].whole for k in at)),
            names=block.names.union(*(part.listed for part in held)),
            barred=block.barred or any(part.whole for part in held),
        )


def _raw_blocks(
    html: str, known: list[Part], around: set[int]
) -> Iterator[tuple[Block, tuple[int, ...], dict[tuple[int, ...], int]]]:
    """Blocks, the numbers of the parts in ``known`` that hold them, and of those that hold their tags.

    Parts that hold a marked article go to ``around``.
    """
    stack: list[tuple[str, frozenset[str], bool, bool, tuple[int, ...]]] = []
    opened: Counter[str] = Counter()
    names: frozenset[str] = frozenset()
    barred = article = False
    inside: tuple[int, ...] = ()
    parts: list[str] = []
    tags: dict[tuple[int, ...], int] = {}
    at, size = 0, len(html)

    def flush() -> tuple[Block, tuple[int, ...], dict[tuple[int, ...], int]] | None:
        nonlocal tags
        text = _BLANKS.sub(" ", unescape("".join(parts))).strip()
        parts.clear()
        if not text:
            return None
        block = Block(text, 0, names, barred, article), inside, tags
        tags = {}
        return block

    while at < size:
        token = _TOKEN.search(html, at)
        if token is None:
            parts.append(html[at:])
            break
        parts.append(html[at : token.start()])
        at = token.end()
        name = token["name"] or token["name2"]
        if name is None:
            continue
        name = name.lower()
        if not barred:
            tags[inside] = tags.get(inside, 0) + 1
        closing = (token["close"] if token["name"] else token["close2"]) == "/"
        attributes = (token["attributes"] if token["name"] else token["attributes2"]) or ""
        if name not in INLINE and (block := flush()):
            yield block
        if closing:
            while opened[name]:
                # An element's end also ends what was left open in it.
                open_name, names, barred, article, inside = stack.pop()
                opened[open_name] -= 1
                if open_name == name:
                    break
            continue
        if name in PARAGRAPH_ENDS and opened["p"]:
            while stack and (stack[-1][0] == "p" or stack[-1][0] in INLINE):
                open_name, names, barred, article, inside = stack.pop()
                opened[open_name] -= 1
                if open_name == "p":
                    break
        if name in ("li", "option", "tr", "td", "th", "dt", "dd") and stack and stack[-1][0] == name:
            _, names, barred, article, inside = stack.pop()
            opened[name] -= 1
        if name in VOID or attributes.endswith("/"):
            continue
        if name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.IGNORECASE).search(html, at)
            at = end.end() if end else size
            continue
        own, bars, part = _element_names(name, attributes, article)
        stack.append((name, names, barred, article, inside))
        opened[name] += 1
        if part:
            known.append(part)
            inside = (*inside, len(known) - 1)
        # A comment that is marked as an article is none.
        if name in ARTICLE and not part and not article:
            around.update(inside)
            article = True
        names, barred = names | own, barred or bars
    if block := flush():
        yield block


class Weights:
    """Learned log odds of words by the elements around them, and the cost of a tag."""

    def __init__(self, inside: dict[str, float], outside: dict[str, float], tag_cost: float):
        total_in, total_out = sum(inside.values()) + 1.0, sum(outside.values()) + 1.0
        known = set(inside) | set(outside)
        self.odds = {
            n: log((inside.get(n, 0.0) + 1.0) / total_in) - log((outside.get(n, 0.0) + 1.0) / total_out)
            for n in known
        }
        self.tag_cost = tag_cost

    def word(self, block: Block) -> float:
        """Score of a word of the block: negative in parts that are none of the article.

        A barred part counts nothing: it is left out in any case, and an article goes on after it.
        """
        if block.barred:
            return 0.0
        odds = sum(
            self.odds.get(n, UNLEARNED if n[1:] in NOT_ARTICLE and n[0] == "." else 0.0)
            for n in block.names if n not in GENERIC
        )
        return max(-1.0, min(1.0, 0.25 + odds / 4.0))


def learn(pages: list[str]) -> Weights:
    """Weights from pages whose article is marked as such: the words in it against all others."""
    inside: dict[str, float] = {}
    outside: dict[str, float] = {}
    words_in = tags_in = 0
    for html in pages:
        for block in blocks(html):
            side = inside if block.article and not block.barred else outside
            n = len(block.text.split())
            if side is inside:
                words_in, tags_in = words_in + n, tags_in + block.tags
            for name in block.names:
                side[name] = side.get(name, 0.0) + n
    # The tags of an article use up at most a tenth of its words' scores, and a tag never more
    # than a small part of a word, so that short blocks at its ends stay.
    return Weights(inside, outside, min(TAG_COST, 0.1 * words_in / max(tags_in, 1)))


def main_text(html: str, weights: Weights) -> str:
    """The contiguous run of blocks with the largest sum of scores, without what is barred in it.

    Words score by the elements around them, every tag before a block costs. Of equal sums the
    first run counts, and the shortest from its start; a page without a positive sum has no text.
    """
    best, best_run = 0.0, (0, 0)
    total, start = 0.0, 0
    parts: list[tuple[str, bool]] = []
    for i, block in enumerate(blocks(html)):
        parts.append((block.text, block.barred))
        if block.barred:
            continue
        score = weights.word(block) * len(block.text.split())
        # Tags before the first block of a run lie outside it.
        total = total - weights.tag_cost * block.tags if total > 0 else 0.0
        if total <= 0:
            total, start = 0.0, i
        total += score
        if total > best:
            best, best_run = total, (start, i + 1)
    return " ".join(text for text, barred in parts[slice(*best_run)] if not barred)
