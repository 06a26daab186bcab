"""Main text of web pages: block rules in two passes."""

from __future__ import annotations

import html
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!?(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^<>"']|"[^"]*"|'[^']*')*|[^<>]*)>|<[?!][^>]*>|</?[A-Za-z][^<>]*\Z""", re.DOTALL)
ATTRIBUTE = re.compile(r"""\b(class|id|role|style|hidden|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.IGNORECASE)
SPACE = re.compile(r"\s+")
PART = re.compile(r"[A-Z]?[a-z0-9]+|[A-Z0-9]+")
WORDS = re.compile(r"[^\W\d_]+")

#: Elements whose content is no text of the page.
RAW = frozenset("script style noscript template textarea title svg iframe object select option button head math audio video canvas".split())
END = {tag: re.compile(rf"</{tag}\b[^>]*>", re.IGNORECASE) for tag in RAW}
#: Elements that begin and end a block.
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that hold no main text, and words in class, id and role that say so.
BOILER_TAGS = frozenset("nav aside footer form menu dialog fieldset search".split())
BOILER_WORDS = frozenset(
    """ad ads advert advertisement adverts advertising sponsor sponsored promo promotion banner menu nav navbar navigation breadcrumb breadcrumbs sidebar
    footer masthead topbar toolbar comment comments disqus reply replies notice notices cookie cookies consent gdpr popup modal overlay newsletter subscribe
    subscription signup login share sharing social related recommended widget copyright disclaimer pagination pager contentinfo complementary dialog alert search form""".split()
)
#: Words that hold for everything inside, even for an article element.
FIRM = frozenset("comment comments disqus reply replies ad ads advert advertisement sponsored related recommended nav aside footer form menu hidden".split())

#: Frequent function words of some languages (fixed values).
STOP_WORDS = frozenset(
    """the of and to in a is that for it as was with be by on not he i this are or his from at which but have an had they you were their one all we can her has there been if more when will would who so no
    der die das und ist in den von zu mit sich des auf für nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um am sind noch wie einem über so zum war haben nur oder aber vor zur bis mehr durch man dem im
    le la les de des et un une est que qui dans en du pour au par sur ne pas plus se ce il elle avec son sa ses ou mais on nous vous leur être ont aux cette
    el los las y que del se un una por con no su para es al lo como más o pero sus le ha me si sin sobre este ya entre cuando todo esta ser son dos también fue había era muy hasta desde está
    il di che e per non una sono con del da si come anche più o ma nel alla della os as do da em um uma para com não mais dos como mas ao het een van ik te dat niet zijn op aan met voor""".split()
)

SHORT, LONG, STOP_LOW, STOP_HIGH, LINKS = 70, 200, 0.1, 0.2, 0.33
#: Most links of a good block beside an article.
FEW_LINKS = 0.1
#: The share of a page's longer text that must reach STOP_LOW for its language to count as one with a list.
LISTED = 0.25
#: Scripts in which a character says about as much as WIDTH letters.
WIDE, WIDTH = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uac00-\ud7af\uf900-\ufaff\U00020000-\U0003ffff]"), 3
LATIN = re.compile("[a-z\u00df-\u024f]")


class Block:
    __slots__ = ("article", "boiler", "heading", "label", "linked", "listed", "text")

    def __init__(self, text: str, linked: int, article: bool, boiler: bool, heading: bool, listed: bool):
        self.text, self.linked, self.article, self.boiler, self.heading, self.listed, self.label = text, linked, article, boiler, heading, listed, ""


def hints(tag: str, attributes: str) -> set[str]:
    """Why an element is none of the main text."""
    found = {tag} & BOILER_TAGS
    if attributes and tag not in ("html", "body", "main"):
        for m in ATTRIBUTE.finditer(attributes):
            name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and "display:none" in value.replace(" ", "").lower():
                found.add("hidden")
            elif name in ("class", "id", "role"):
                found |= {p.lower() for p in PART.findall(value)} & BOILER_WORDS
    return found


def blocks_of(page: str) -> list[Block]:
    """Blocks in page order, with decoded text and single spaces."""
    out: list[Block] = []
    stack: list[tuple[str, bool, frozenset[str]]] = []  # tag, inside an article, reasons against it
    parts: list[str] = []
    open_: Counter[str] = Counter()  # of stack
    ends: dict[str, re.Match | None] = {}  # the next end of elements in RAW
    linked, in_link, at, n = 0, 0, 0, len(page)

    def close() -> None:
        nonlocal linked
        text = SPACE.sub(" ", html.unescape("".join(parts))).strip()
        if text:
            _, article, against = stack[-1] if stack else ("", False, frozenset())
            tags = [t for t, _, _ in stack[-3:]]
            out.append(Block(text, linked, article, bool(against), bool(tags) and tags[-1][0] == "h" and tags[-1][1:].isdigit(), "li" in tags or "td" in tags))
        parts.clear()
        linked = 0

    def said(text: str) -> None:
        nonlocal linked
        if text:
            parts.append(text)
            if in_link:
                linked += len(html.unescape(text).strip())

    while at < n:
        m = TOKEN.search(page, at)
        if not m:
            said(page[at:])
            break
        said(page[at : m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag or m[0][1] == "!":
            continue
        if m[1]:
            if tag == "a":
                in_link = max(0, in_link - 1)
            elif tag in BLOCK:
                close()
                for i in range(len(stack) - 1, -1, -1) if open_[tag] else ():
                    if stack[i][0] == tag:
                        open_.subtract(t for t, _, _ in stack[i:])
                        del stack[i:]
                        break
                    if tag in ("p", "li") and stack[i][0] not in ("p", "li"):
                        break  # a stray end
        elif tag in RAW:
            if tag not in ends or ends[tag] and ends[tag].start() < at:  # an end is searched for once, or not found once
                ends[tag] = END[tag].search(page, at)
            end = ends[tag] if not m[3].endswith("/") else None
            if tag == "head":
                continue  # its own content is in other such elements
            at = end.end() if end else at if m[3].endswith("/") or tag in ("option", "button", "select") else n
        elif tag == "br":
            said(" ")
        elif tag == "a":
            in_link = 1
        elif tag in BLOCK:
            close()
            in_link = 0
            if tag in VOID:
                continue
            if stack and (stack[-1][0] == "p" or stack[-1][0] == tag and tag in ("li", "td", "th", "tr", "dt", "dd")):
                open_[stack.pop()[0]] -= 1  # ends with the next block
            _, article, against = stack[-1] if stack else ("", False, frozenset())
            own = hints(tag, m[3])
            if tag in ("article", "main"):
                article, against = True, against & FIRM
            elif tag == "header" and not article:
                own.add("header")
            elif tag in ("h1", "p") and article:
                own -= {"banner", "notice", "notices"}
            stack.append((tag, article, against | own))
            open_[tag] += 1
    close()
    return out


def stop_density(text: str) -> float:
    ws = WORDS.findall(text.lower())
    return sum(w in STOP_WORDS for w in ws) / len(ws) if ws else 0.0


def length(text: str) -> int:
    """Characters, where those of wide scripts count WIDTH times."""
    return len(text) if text.isascii() else len(text) + (WIDTH - 1) * len(WIDE.findall(text))


def latin(text: str) -> bool:
    """Whether most letters are Latin: stop words say nothing about others."""
    return text.isascii() or 2 * len(LATIN.findall(text.lower())) >= sum(map(len, WORDS.findall(text)))


def extract(page: str | None) -> str:
    """The main text: its blocks in page order, joined by line feeds.

    First pass: a block in a menu, footer, form, advert and the like, or full of links, is bad; a long block with many
    stop words is good, one with few is bad; others are ambiguous. Stop words are known for some languages in Latin script:
    a block in another script, or on a page of whose longer text less than LISTED reaches STOP_LOW, is decided by links and
    length alone, so that long lists of keywords pass there. Second pass: each ambiguous block takes the label of its
    nearest decided neighbours outside of menus and the like, in the same part of the page (in or out of the article); if
    they differ it is bad outside of an article, unless it heads a good block; where nothing is decided (a page of short
    blocks) it is good if it has few links.

    An article mark is a prior for both passes. Inside, few stop words aren't held against a block (lists, code and
    names are text there), and an ambiguous one is bad only if it is full of links or short, and between bad ones. Outside
    of the articles of a page, only long blocks with many stop words and nearly no links are good and ambiguous ones only
    between two good ones, unless the first pass finds more good text there than the articles hold (teasers): then the rules
    of an unmarked page hold there. A notice or advert inside an article that isn't labelled and has few links stays."""
    if not page:
        return ""
    blocks = blocks_of(page)
    densities = [stop_density(b.text) for b in blocks]
    longer = [(len(b.text), d) for b, d in zip(blocks, densities, strict=True) if not b.boiler and len(b.text) >= SHORT and b.linked <= LINKS * len(b.text)]
    known = sum(n for n, d in longer if d >= STOP_LOW) >= LISTED * sum(n for n, _ in longer)
    inside = outside = 0
    strict = []  # good outside of an article that the mark of the page is to be trusted for
    for b, density in zip(blocks, densities, strict=True):
        links = b.linked / len(b.text)
        firm = False
        if b.boiler or links > LINKS and (b.listed or not b.article) or not b.article and "\N{COPYRIGHT SIGN}" in b.text:
            b.label = "bad"
        elif len(b.text) >= SHORT and (density >= STOP_HIGH or len(b.text) > LONG and density >= STOP_LOW):
            b.label, firm = "good", len(b.text) >= LONG and density >= STOP_HIGH
        elif not (known and latin(b.text)):
            if length(b.text) >= SHORT and links <= LINKS:
                b.label, firm = "good", length(b.text) >= LONG
        elif len(b.text) >= LONG and density < STOP_LOW and not b.article:
            b.label = "bad"
        strict.append(firm and links <= FEW_LINKS)
        if b.article:
            inside += len(b.text) * (b.label != "bad")
        else:
            outside += len(b.text) * (b.label == "good")
    held = inside >= max(outside, 1)
    if held:
        for b, firm in zip(blocks, strict, strict=True):
            if not b.article and not firm:
                b.label = "bad" if length(b.text) >= SHORT else b.label
    decided = [b.label for b in blocks]

    def nearest(order) -> list[str]:
        """For each block the label of the latest decided one before it in that order, outside of menus and the like and in
        the same part of the page: one sweep, however many blocks are undecided."""
        last, out = {True: "", False: ""}, [""] * len(blocks)
        for i in order:
            out[i] = last[blocks[i].article]
            if decided[i] and not blocks[i].boiler:
                last[blocks[i].article] = decided[i]
        return out

    forth, back = nearest(range(len(blocks))), nearest(range(len(blocks) - 1, -1, -1))
    for i, b in enumerate(blocks):
        if not decided[i]:
            before, after = forth[i], back[i]
            found = {before, after} - {""}
            if b.article:
                b.label = "bad" if before == after == "bad" and len(b.text) < SHORT or found == {"bad"} and b.linked > LINKS * len(b.text) else "good"
            elif held:
                b.label = "good" if before == after == "good" or b.heading and after == "good" else "bad"
            else:
                none = "good" if b.linked <= LINKS * len(b.text) else "bad"
                b.label = none if not found else found.pop() if len(found) == 1 else after if b.heading else "bad"
    return "\n".join(b.text for b in blocks if b.label == "good")


def main_text(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text, n_chars (code points). One pass, no shuffle.

    Nulls: a null html is empty and yields an empty text; null ids and urls are kept. Broken markup is read as far as it
    goes: unclosed elements end with their container. Repeated rows each yield a row. An empty table yields no rows."""

    def work(batches):
        for b in batches:
            texts = [extract(h.as_py()) for h in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html").mapInArrow(work, "page_id long, url string, text string, n_chars long")
