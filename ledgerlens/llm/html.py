"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags. The first pass decides blocks by link density, length, stop-word
density and by what encloses them (menus, headers, footers, asides, forms, comments and elements whose class, id or
role says so never hold the article). Blocks that stay ambiguous, the short ones above all, take in the second pass
the label of the nearest decided neighbour in their own section; with none, an article's blocks are text and others
are not.

Classes and ids bar by whole tokens whose parts all say so (site-footer, but not no-sidebar or entry-header). They don't
bar what they can't mean: what encloses an article, or most of the good text where there is a word for layout only.
A page without an article in whose long blocks the known stop words are too rare is in another language; there
length and link density decide alone.

Defined results: null or empty html: empty text. Pages without a text block: empty text. Cut-off markup is read as
far as it goes. Character references are decoded and white space in a block becomes one space; nothing is capped.
Repeated rows give repeated results; other columns are ignored.
"""

from __future__ import annotations

import html as _html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Frequent function words of the languages at hand.
STOP_WORDS = frozenset(
    "the of and to in a is that for it as was with be by on not he his but at are this have from or had an they which one you were all her she there would their we him been has when who will no more if out so said what up its about than into them can only other"
    " der die und das in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um am sind noch wie einem über so zum war haben nur oder aber vor zur bis mehr durch man"
    " de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il sont avec son aux d l mais comme ou si leur y dont elle nous sa fait"
    " el y los del las por con para una su al lo como más pero sus este ya entre porque cuando muy sin sobre también me hasta hay donde quien desde todo nos durante".split()
)
#: Elements by what they do to the text.
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead title tr ul".split())
BOILERPLATE = frozenset("nav footer aside form menu dialog select button fieldset noscript iframe object".split())
SILENT = frozenset("script style template svg math head canvas textarea".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_OTHERS = r"ads?|advert[a-z]*|comments?|consent|cookies?|disqus|gdpr|login|newsletter|notices?|popup|promo[a-z]*|related|share|sharing|signup|social|sponsor[a-z]*|subscribe"
_LAYOUT = r"banner|breadcrumbs?|footer|header|masthead|menu|modal|nav[a-z]*|sidebar|skip|toolbar|widget"
_PLACES = r"area|articles|bar|block|bottom|box|buttons|container|form|global|icons|inner|items?|left|links?|list|main|page|posts|primary|right|secondary|section|site|slot|top|unit|wrap|wrapper|[0-9]+"
MARKS = re.compile(rf"(?<!\S)(?:(?:{_PLACES})[-_]+)*(?:{_OTHERS}|{_LAYOUT})(?:[-_]+(?:{_OTHERS}|{_LAYOUT}|{_PLACES}))*(?!\S)", re.I)
OTHERS = re.compile(rf"(?<![a-z])(?:{_OTHERS})(?![a-z])", re.I)  # what isn't the author's, against mere layout
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu".split())

_PIECE = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"<]*\"|'[^'<]*')*)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)(?:>|\Z)", re.S)
_RAW_END = {t: re.compile(rf"</{t}\s*>|\Z", re.I) for t in ("script", "style", "textarea", "template", "svg", "math", "title")}
_NAMED = re.compile(r"""\b(class|id|role|hidden|aria-hidden)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_WORD = re.compile(r"[^\W\d_]+")


@dataclass(slots=True)
class Block:
    text: str
    linked: int  # characters inside links
    barred: bool  # inside boilerplate
    marks: tuple[tuple[int, bool], ...]  # enclosing elements barred by class or id: number, whether a word of OTHERS
    section: int  # number of the enclosing article, 0 for none
    heading: bool


def _barred(tag: str, attributes: str, in_article: bool) -> tuple[bool, str]:
    """Whether an element is boilerplate for certain, and what its class or id says of it."""
    if tag in BOILERPLATE or tag == "header" and not in_article:
        return True, ""
    said = ""
    for name, value in _NAMED.findall(attributes) if attributes else ():
        value = value.strip("\"'")
        if name.lower() == "role" and value.lower() in ROLES or name.lower() == "aria-hidden" and value.lower() == "true":
            return True, ""
        if name.lower() in ("class", "id") and tag not in ("html", "body", "article", "main", "header"):
            said += "".join(f" {m[0]}" for m in MARKS.finditer(value))
    return False, said


def blocks(page: str) -> list[Block]:
    """The page's text blocks in order."""
    return _appeal(*_cut(page))


def _cut(page: str) -> tuple[list[Block], dict[int, tuple[tuple[int, bool], ...]]]:
    """The page's text blocks in order, and for each article the marked elements around it."""
    found: list[Block] = []
    parts: list[tuple[str, bool]] = []
    stack: list[tuple[str, bool, bool, int]] = []  # tag, barred, article, marks outside it
    marks: tuple[tuple[int, bool], ...] = ()
    around: dict[int, tuple[tuple[int, bool], ...]] = {}
    marked = 0
    barred = articles = links = section = 0
    heading = False
    breaks = 0

    def flush() -> None:
        nonlocal parts
        text = " ".join(_html.unescape("".join(p for p, _ in parts)).split())
        if text:
            linked = len(" ".join(_html.unescape("".join(p for p, in_link in parts if in_link)).split()))
            found.append(Block(text, linked, barred > 0, marks, section if articles else 0, heading))
        parts = []

    def close(upto: int) -> None:
        nonlocal barred, articles, links, marks
        while len(stack) > upto:
            tag, was_barred, was_article, outside = stack.pop()
            marks = marks[:outside]
            barred -= was_barred
            articles -= was_article
            links -= tag == "a"

    at = 0
    while at < len(page):
        m = _PIECE.search(page, at)
        if not m:
            parts.append((page[at:], links > 0))
            break
        if m.start() > at:
            parts.append((page[at : m.start()], links > 0))
            if breaks and page[at : m.start()].strip():
                breaks = 0
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        ending, attributes = bool(m[1] or m[4]), m[3] or m[6] or ""
        if tag == "br":
            breaks += 1
            parts.append((" ", links > 0))
            if breaks > 1:
                flush()
            continue
        if tag in BLOCK or tag in SILENT or tag in BOILERPLATE:
            flush()
            breaks = 0
        if ending:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    close(i)
                    break
                if stack[i][0] in ("article", "body", "main", "div", "section", "td") and tag not in ("article", "body", "main", "html", "div", "section", "table", "nav", "aside", "footer", "header", "form", "ul", "ol"):
                    break  # a stray end tag doesn't leave its container
            heading = False if re.fullmatch(r"h[1-6]", tag) else heading
            continue
        if tag in _RAW_END and tag != "title":
            at = _RAW_END[tag].search(page, at).end()
            continue
        if tag == "title":
            at = _RAW_END[tag].search(page, at).end()
            continue
        if tag == "body" or tag == "head":  # an unclosed head ends here
            close(next((i for i, x in enumerate(stack) if x[0] == "head"), len(stack)))
        if tag == "head":
            continue
        if tag in VOID or attributes.endswith("/") and tag not in BLOCK:
            continue
        if tag in ("p", "li", "dt", "dd", "td", "th", "tr", "option") or re.fullmatch(r"h[1-6]", tag):
            for i in range(len(stack) - 1, -1, -1):  # implied end tags
                if stack[i][0] in ("ul", "ol", "dl", "table", "div", "article", "section", "main", "body", "aside", "nav", "form", "blockquote", "footer", "header"):
                    break
                if stack[i][0] == tag or stack[i][0] == "p":
                    close(i)
                    break
        heading = bool(re.fullmatch(r"h[1-6]", tag)) or heading and tag not in BLOCK
        article = tag in ("article", "main")
        if article:
            section = section + (articles == 0)
            around.setdefault(section, marks)
        now, said = _barred(tag, attributes, articles > 0)
        stack.append((tag, now, article, len(marks)))
        if said:
            marked += 1
            marks += ((marked, OTHERS.search(said) is not None),)
        barred += now
        articles += article
        links += tag == "a"
    flush()
    return found, around


GOOD, BAD, UNSURE = 1, -1, 0


def _appeal(found: list[Block], around: dict[int, tuple[tuple[int, bool], ...]]) -> list[Block]:
    """found with blocks barred by the marks that stand."""
    if not any(b.marks for b in found):
        return found
    neutral = foreign(found)
    good = [0 if b.barred or _alone(b, neutral=neutral) != GOOD else len(b.text) for b in found]
    by_section: dict[int, int] = {}
    for b, n in zip(found, good, strict=True):
        by_section[b.section] = by_section.get(b.section, 0) + n
    free = any(n and not b.marks for b, n in zip(found, good, strict=True))
    lifted = {i for k, outer in around.items() if not free or not any(others for _, others in outer) for i, _ in outer if by_section.get(k)}
    main = max((k for k in by_section if k and by_section[k] and all(i in lifted for i, _ in around[k])), key=by_section.__getitem__, default=0)
    total, inside = 0, {}
    for b, n in zip(found, good, strict=True):
        if n and b.section == main and not any(others and i not in lifted for i, others in b.marks):
            total += n
            for i, _ in b.marks:
                inside[i] = inside.get(i, 0) + n
    lifted |= {i for i, n in inside.items() if 2 * n > total}
    for b in found:
        b.barred = b.barred or any(i not in lifted for i, _ in b.marks)
    return found


def _density(text: str) -> tuple[int, int]:
    """(stop words, words) of a text."""
    words = _WORD.findall(text.lower())
    return sum(w in STOP_WORDS for w in words), len(words)


def foreign(found: list[Block], short: int = 70, stop_low: float = 0.12, max_link: float = 0.5) -> bool:
    """Is a page in a language whose stop words aren't known?"""
    if any(b.section for b in found):
        return False
    counts = [_density(b.text) for b in found if not b.barred and len(b.text) >= short and b.linked <= max_link * len(b.text)]
    return bool(counts) and sum(s for s, _ in counts) < stop_low * sum(n for _, n in counts)


def _alone(b: Block, short: int = 70, stop_low: float = 0.12, stop_high: float = 0.25, max_link: float = 0.5, neutral: bool = False) -> int:
    """A block's label by itself, the first pass; neutral: whatever its words."""
    if b.barred:
        return BAD
    if b.linked > max_link * len(b.text):
        return UNSURE if b.section else BAD
    if len(b.text) < short:
        return UNSURE
    if neutral:
        return GOOD
    stops, words = _density(b.text)
    density = stops / max(words, 1)
    if density >= stop_high or b.section and density >= stop_low:
        return GOOD
    return BAD if density < stop_low and not b.section and words >= 5 else UNSURE


def classify(found: list[Block], short: int = 70, stop_low: float = 0.12, stop_high: float = 0.25, max_link: float = 0.5) -> list[bool]:
    """True for the article's blocks: pass 1 by the block alone, pass 2 by its neighbours."""
    neutral = foreign(found, short, stop_low, max_link)
    first = [_alone(b, short, stop_low, stop_high, max_link, neutral) for b in found]
    out = []
    before, after = _nearest(found, first), _nearest(found[::-1], first[::-1])[::-1]
    for b, label, prev, nxt in zip(found, first, before, after, strict=True):
        if label == UNSURE:
            (d1, l1), (d2, l2) = prev, nxt
            if b.section:
                near = [x for x in ((d1, l1), (d2, l2)) if x[1] != UNSURE]
                label = min(near, key=lambda x: (x[0], -x[1]))[1] if near else GOOD
            elif l1 == l2 and l1 != UNSURE:
                label = l1
            elif b.heading and l2 == GOOD:
                label = GOOD
            elif l1 != UNSURE and l2 != UNSURE:
                label = l1 if d1 < d2 else l2 if d2 < d1 else BAD
            else:
                label = BAD  # the page's edges count as boilerplate
        out.append(label == GOOD)
    return out


def _nearest(found: list[Block], labels: list[int]) -> list[tuple[int, int]]:
    """For each block, distance and label of the nearest decided block before it, in the same section."""
    last: dict[int, tuple[int, int]] = {}
    out = []
    for i, (b, label) in enumerate(zip(found, labels, strict=True)):
        at, what = last.get(b.section, (i, UNSURE))
        out.append((i - at, what))
        if label != UNSURE and not (b.section and label == BAD):
            last[b.section] = (i, label)
    return out


def extract(page: str | None) -> str:
    """The article's text, its blocks joined by newlines."""
    if not page:
        return ""
    found = blocks(page)
    return "\n".join(b.text for b, keep in zip(found, classify(found), strict=True) if keep)


def op3(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every page."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [extract(h) for h in batch["html"]]
            yield pd.DataFrame({"page_id": batch["page_id"], "url": batch["url"], "text": texts, "n_chars": [len(t) for t in texts]})

    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return rows.mapInPandas(run, "page_id long, url string, text string, n_chars long")
