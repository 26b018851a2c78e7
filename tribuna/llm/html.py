"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags.  First pass: words, link density
and stop-word density class each block as good, bad or undecided; a block inside
page furniture (menus, headers, footers, sidebars, adverts, forms, comments) is
bad whatever it says.  Furniture is known by its tag, role or style, or by a
class or id word that is one of its names or a compound of such names only; what
a name says does not reach into an article.  Second pass: undecided short blocks take the label of
their nearest decided neighbours.  Good blocks are joined in page order.

Stop words are a few function words of several languages and, where these do
not know the long blocks of the page, the commonest words of those blocks, so no
language needs to be known.  In scripts that put no spaces between words every
letter counts as a word there, and two of them as one for the length of a block.

Cases: null and empty pages give an empty text; unclosed and misnested tags end
with their block; a page cut off in the middle of a tag loses that tag only; a
page of any length is read whole; repeated rows count each; an empty table gives
an empty result; further columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tribuna.llm.tokens import slices

#: Tags that end a block, tags whose content is no text, tags and names of page furniture.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset"
    " h1 h2 h3 h4 h5 h6 head header hr html iframe legend li main menu nav noscript ol option p pre section select summary table tbody td"
    " template textarea tfoot th thead title tr ul".split()
)
SILENT_TAGS = frozenset("script style noscript template title textarea select option iframe svg math object canvas head button datalist".split())
RAW_TAGS = frozenset("script style textarea title iframe noembed noframes xmp".split())
FURNITURE_TAGS = frozenset("nav footer aside form menu dialog fieldset".split())
FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog toolbar".split())
FURNITURE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist respond disqus consent"
    " cookie cookies copyright disclaimer footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices"
    " outbrain overlay pager pagination popup promo promoted promotion related replies reply share sharing shares sidebar signup site-header"
    " site-footer social sponsor sponsored sponsors subscribe subscription taboola toc toolbar topbar warning widget widgets".split()
)
#: Words that may stand beside names of furniture in a compound: main-nav, cookie-bar, related-posts.
FURNITURE_BESIDE = frozenset(
    "area articles bar block bottom box button buttons desktop form global item items link links list main mobile posts primary secondary"
    " section site slot top".split()
)
#: Furniture of these names holds article elements of its own.
OWN_ARTICLES = frozenset("comment comments commentlist disqus related replies reply respond".split())
HEAD_TAGS = frozenset("base basefont bgsound head link meta noframes noscript script style template title".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Function words of English, German, French, Spanish, Portuguese and Italian.
STOP_WORDS = frozenset(
    "a an and are as at be by for from has have he her his in is it its not of on or she that the their they this to was were which with you"
    " au auf aus avec bei che con da dans das de dei del della dem den der des di die do du e ein eine el elle em en er es est et für ist"
    " il la las le les lo los mais mit ne nicht no non nous o os ou para par pas per por pour que qui se sie sich sur um un una und une von"
    " vous y zu".split()
)

#: Rules: a block of this many words is long; links above this share make it bad; stop words below and above these shares decide.
LONG_WORDS = 12
MAX_LINK_SHARE = 0.33
FEW_STOPS = 0.05
MANY_STOPS = 0.15
#: A page's own stop words are to make up this share of the long blocks that they are taken from, twice what a good block needs.
OWN_SHARE = 2 * MANY_STOPS

#: A comment or declaration, the start of a tag, or text.
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)|([^<]+|<)", re.S)
SPECIAL = re.compile("[\"'>]")
ATTRIBUTE = re.compile(r"([^\s=/\"'<>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
SEAM = re.compile(r"[-:]+")
#: Thai, Lao, Burmese, Khmer, kana and Han letters: words have no spaces between them.
UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
LETTERS = re.compile(rf"[{UNSPACED}]|[^\W{UNSPACED}]+")
ALONE = re.compile(f"[{UNSPACED}]")

GOOD, BAD, OPEN = 1, -1, 0
#: Why an element is furniture: not at all, by its name, by the name of a list of comments or the like, by its tag, role or style.
NO, NAMED, LISTED, FIRM = 0, 1, 2, 3


def named(word: str) -> int:
    """Whether a class or id word is a name of furniture or a compound of such names and what stands beside them."""
    word = word.replace("_", "-")
    parts = {p for p in SEAM.split(word) if p}
    # A header of a part of the page has its title: that word alone makes no compound.
    if word in FURNITURE_NAMES or (parts <= FURNITURE_NAMES | FURNITURE_BESIDE and not parts.isdisjoint(FURNITURE_NAMES - {"header"})):
        return NAMED if parts.isdisjoint(OWN_ARTICLES) else LISTED
    return NO


def furniture(tag: str, attributes: str, inside_article: bool) -> int:
    """Whether an element is a part of the page that is not its article, and why."""
    if tag in FURNITURE_TAGS or (tag == "header" and not inside_article):
        return FIRM
    if not attributes.strip():
        return NO
    found = NO
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return FIRM
        if name == "role" and value in FURNITURE_ROLES:
            return FIRM
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return FIRM
        if name in ("class", "id") and tag not in ("body", "html", "article", "main"):
            found = max(found, *map(named, value.split()), NO)
    return found


class TagEnds:
    """Where tags end: at the first > outside of quotes.

    A tag that runs into a quote without end is no tag.  Quotes that lead there
    are remembered, so no part of a page is searched again for each tag before it.
    """

    def __init__(self, page: str):
        self.page = page
        self.doomed: set[int] = set()
        self.none_from = {'"': len(page), "'": len(page)}  # from here on there is no such quote
        self.special = (0, -1)  # the next special character (second) for all places from the first on

    def next_special(self, at: int) -> int:
        start, found = self.special
        if not start <= at <= found:
            m = SPECIAL.search(self.page, at)
            found = m.start() if m else len(self.page)
            self.special = (at, found)
        return found

    def find(self, at: int) -> tuple[int, int] | None:
        """End of the attributes and of the tag; both the page's where it is cut off in the tag."""
        page, passed = self.page, []
        while True:
            p = self.next_special(at)
            if p == len(page):
                return p, p
            c = page[p]
            if c == ">":
                return p, p + 1
            passed.append(p)
            close = -1 if p in self.doomed or p + 1 >= self.none_from[c] else page.find(c, p + 1)
            if close < 0:
                if p not in self.doomed:
                    self.none_from[c] = min(self.none_from[c], p + 1)
                self.doomed.update(passed)
                return None
            at = close + 1


class Open:
    """The open block-level and silent elements; inline ones play no part."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, int, bool]] = []  # tag, furniture, article
        self.count: Counter[str] = Counter()
        self.silent = 0

    @property
    def top(self) -> tuple[str, int, bool]:
        return self.stack[-1] if self.stack else ("", NO, False)

    def push(self, tag: str, bad: int, article: bool) -> None:
        self.stack.append((tag, bad, article))
        self.count[tag] += 1
        self.silent += tag in SILENT_TAGS

    def pop(self) -> str:
        tag = self.stack.pop()[0]
        self.count[tag] -= 1
        self.silent -= tag in SILENT_TAGS
        return tag

    def close(self, tag: str) -> None:
        """Ends the innermost element of this tag and all inside it."""
        if self.count[tag]:
            while self.pop() != tag:
                pass

    def close_outermost(self, tag: str) -> None:
        while self.count[tag]:
            self.pop()


def blocks(page: str) -> list[tuple[str, int, bool, bool]]:
    """Text, characters inside links, whether inside furniture, whether inside an article, of each block in page order."""
    out: list[tuple[str, int, bool, bool]] = []
    text: list[str] = []
    linked = 0
    elements, ends = Open(), TagEnds(page)
    link = 0

    def end() -> None:
        nonlocal linked
        if text:
            words = " ".join("".join(text).split())
            if words:
                _, bad, article = elements.top
                out.append((words, linked, bad != NO, article))
            text.clear()
        linked = 0

    def write(run: str) -> None:
        nonlocal linked
        if elements.top[0] == "head" and run.strip():  # text ends a head that is not closed
            elements.pop()
        if not elements.silent:
            run = entities.unescape(run)
            text.append(run)
            if link:
                linked += len("".join(run.split()))

    at, size = 0, len(page)
    while at < size:
        m = TOKEN.match(page, at)
        closing, tag, run = m.groups()
        if run is not None:
            at = m.end()
            write(run)
            continue
        if tag is None:
            at = m.end()
            continue
        found = ends.find(m.end())
        if found is None:  # no tag: its < is text
            at += 1
            write("<")
            continue
        attributes, at = page[m.end() : found[0]], found[1]
        tag = tag.lower()
        if closing:
            if tag in BLOCK_TAGS:
                end()
                link = 0
            elif tag == "a":
                link = 0
            elements.close(tag)
            continue
        if elements.silent and tag not in HEAD_TAGS and (tag == "body" or elements.top[0] == "head"):  # so does what cannot stand in one
            elements.close_outermost("head")
        if tag in RAW_TAGS and not attributes.endswith("/"):
            close = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = close.end() if close else size
            if tag in BLOCK_TAGS:
                end()
            continue
        if tag in BLOCK_TAGS:
            end()
            link = 0
            if tag in ("p", "li", "td", "th", "tr", "dd", "dt", "option"):  # these end their like when not closed
                for open_tag, _, _ in reversed(elements.stack):
                    if open_tag == tag:
                        elements.close(tag)
                        break
                    if open_tag in BLOCK_TAGS:
                        break
        elif tag == "br":
            text.append(" ")
        elif tag == "a":
            link = 1
        if tag in VOID_TAGS or attributes.endswith("/") or not (tag in BLOCK_TAGS or tag in SILENT_TAGS):
            continue
        _, bad, article = elements.top
        inside = tag in ("article", "main")
        if inside and (bad == NAMED or (bad == LISTED and not article)):
            bad = NO  # a name does not reach into an article
        elements.push(tag, max(bad, furniture(tag, attributes, article)), article or inside)
    end()
    return out


def length(words: list[str]) -> float:
    """Words of a block; two letters of a script without spaces are one."""
    return len(words) - sum(ALONE.match(w) is not None for w in words) / 2


def stop_share(words: Sequence[str], stops: frozenset[str] | set[str]) -> float:
    return sum(w in stops for w in words) / len(words)


def stop_words(long_blocks: list[list[str]]) -> frozenset[str] | set[str]:
    """STOP_WORDS, and the commonest words of the long blocks that these do not know.

    Common is what stands in many different blocks.  Words of equally many
    blocks are taken together, the commonest first, until they make up OWN_SHARE.
    Words of a single block count only where the known blocks are not the greater
    part of the page: a text too short to repeat its words is then judged by its
    length and links alone.
    """
    different = dict.fromkeys(map(tuple, long_blocks))
    texts = [t for t in different if stop_share(t, STOP_WORDS) < MANY_STOPS]
    if not texts:
        return STOP_WORDS
    blocks_of = Counter(w for t in texts for w in set(t))
    every = sum(map(len, texts))
    least = 1 if 2 * every >= sum(map(len, different)) else 2
    times = Counter(w for t in texts for w in t)
    own, covered = set(STOP_WORDS), sum(n for w, n in times.items() if w in STOP_WORDS)
    for level in sorted({n for n in blocks_of.values() if n >= least}, reverse=True):
        if covered >= OWN_SHARE * every:
            break
        new = [w for w, n in blocks_of.items() if n == level and w not in own]
        own.update(new)
        covered += sum(times[w] for w in new)
    return own


def classify(page_blocks: list[tuple[str, int, bool, bool]]) -> list[int]:
    """First pass: words, links and stop words.

    In a page with an article element, what stands outside of it is bad, and
    what the densities would call bad inside it is undecided: the second pass
    settles it by the article's decided blocks.
    """
    has_article = any(a for _, _, _, a in page_blocks)
    words = [[w.lower() for w in LETTERS.findall(t)] for t, _, _, _ in page_blocks]
    sizes = [length(w) for w in words]
    much_linked = [linked > MAX_LINK_SHARE * (len(t) - t.count(" ")) for t, linked, _, _ in page_blocks]
    stops = stop_words([w for w, n, links, (_, _, bad, article) in zip(words, sizes, much_linked, page_blocks)
                        if n >= LONG_WORDS and not links and not bad and (article or not has_article)])
    labels = []
    for own, n, links, (_, _, bad, article) in zip(words, sizes, much_linked, page_blocks):
        if bad or (has_article and not article):
            labels.append(BAD)
        elif links:
            labels.append(OPEN if article and n < LONG_WORDS else BAD)
        elif n < LONG_WORDS:
            labels.append(OPEN)
        else:
            share = stop_share(own, stops)
            labels.append(GOOD if share >= MANY_STOPS else OPEN if article or share >= FEW_STOPS else BAD)
    return labels


def settle(page_blocks: list[tuple[str, int, bool, bool]], labels: list[int]) -> list[int]:
    """Second pass: an undecided block takes the label of its nearest decided neighbour, on either side.

    Neighbours are the blocks on the same side of the article's border, without
    furniture.  At equal distance a block without links is good; with no
    neighbour at all the article decides.
    """

    def nearest(order: range) -> list[tuple[int, int]]:
        last: dict[bool, tuple[int, int] | None] = {True: None, False: None}
        seen = {}
        for i in order:
            _, _, bad, article = page_blocks[i]
            found = last[article]
            seen[i] = (abs(i - found[0]), found[1]) if found else (len(labels), OPEN)
            if labels[i] != OPEN and not bad:
                last[article] = (i, labels[i])
        return [seen[i] for i in range(len(labels))]

    before, after = nearest(range(len(labels))), nearest(range(len(labels) - 1, -1, -1))
    out = []
    for (_, linked, _, article), label, (d, x), (e, y) in zip(page_blocks, labels, before, after):
        if label == OPEN:
            label = x if d < e or x == y else y if e < d else BAD if linked else GOOD
            label = label or (GOOD if article else BAD)
        out.append(label)
    return out


def main_text(page: str | None) -> str:
    """The page's article, a block per line."""
    if not page:
        return ""
    found = blocks(page)
    labels = settle(found, classify(found))
    return "\n".join(t for (t, _, _, _), label in zip(found, labels) if label == GOOD)


def extract_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows in slices(batch, "html"):
            texts = [main_text(p) for p in rows.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [rows.column("page_id"), rows.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per page: its main text and the code points of it."""
    slim = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), F.coalesce(F.col(html), F.lit("")).alias("html")
    )
    return slim.mapInArrow(extract_batches, "page_id long, url string, text string, n_chars long")
