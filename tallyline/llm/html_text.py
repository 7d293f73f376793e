"""Main text of web pages by two passes of block rules.

The page is cut into blocks at block-level tags. The first pass judges each
block by its length, its share of link text and its share of stop words: good,
bad, near good or short. The second settles the undecided ones: each takes the
label of its nearest decided neighbours, where the edge of an article counts as
a bad neighbour and a heading looks ahead only.

Within an article links do not decide alone: a paragraph may be a link as a whole.
Only two or more blocks in a row that are nothing but links are a menu there. A
page on which no block has stop words to speak of is in a language that none are
listed for; on it, sentences take their place: long blocks with the marks that end
sentences. Characters of scripts that write words in one or two count as several.

What markup declares not to be text (scripts, styles, forms, menus, page
headers and footers, asides, hidden parts, and containers that call themselves
an advert, a notice or reader comments) is left out before the rules apply. A
container calls itself so by a whole class, id or role, all hyphen parts of which
say so; one that holds an article or the main part is left out only if hidden.
Missing and stray end tags are tolerated.

Null or empty html has the text ''. Whole pages are judged, of any length. One
row comes out for each row in; other columns are kept, but a column called like
a result is replaced.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

SHORT_CHARS = 70
LONG_CHARS = 200
MAX_LINK_SHARE = 0.3
STOP_LOW = 0.15
STOP_HIGH = 0.25
#: How many letters of an alphabet a CJK character stands for.
DENSE = 3

# Frequent function words of the languages that are judged by them.
STOP_WORDS = frozenset(
    """
    a about after all an and are as at be been but by can for from had has have he her his i if in into is it its more
    no not of on one or our out she so such than that the their them then there they this to up was we were what when
    which who will with would you
    au aux avec ce ces dans de des du elle en est et il ils je la le les leur lui mais ne nous on ou par pas pour qu que
    qui sa se ses son sur un une vous
    al como con del el ella ellos era es esta este ha hay las lo los más me mi muy o para pero por se si sin su sus
    también y ya
    aber als am auch auf aus bei bin bis das dass dem den der die doch ein eine einem einen einer es für hat ich ihr im
    ist mit nach nicht noch nur oder sein sich sie sind und uns unter vom von vor war wenn wie wir zu zum zur über
    """.split()
)

# Elements whose content is never text of the page.
SILENT = "script|style|noscript|template|iframe|svg|canvas|textarea|select|button|object|title"
# Elements that hold menus, page furniture or input.
FURNITURE = frozenset("nav header footer aside form menu dialog fieldset".split())
# Elements that hold the page's subject.
SUBJECT = frozenset("article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Elements that begin a block.
BLOCKS = (
    frozenset(
        """address blockquote body caption center dd details div dl dt figcaption figure hr html li ol p pre section summary
        table tbody td tfoot th thead tr ul""".split()
    )
    | FURNITURE
    | SUBJECT
    | HEADINGS
)
NESTED = frozenset("div section ul ol table dl details figure blockquote".split()) | FURNITURE | SUBJECT
# Words in a class, id or role that declare a container not to be the subject.
NOT_SUBJECT = frozenset(
    """ad ads adv advert advertisement advertising adverts alert banner breadcrumb breadcrumbs byline comment commentlist
    comments complementary consent contentinfo cookie cookies dialog disqus footer gdpr login masthead menu modal nav
    navbar navigation newsletter notice notices notification pagination paywall popup privacy promo promoted promotion
    related replies reply respond search share sharing sidebar signup skip social sponsor sponsored subscribe subscription
    toolbar tracking warning widget""".split()
)

TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<silent>{SILENT})\b[^>]*>.*?(?:</(?P=silent)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:\"[^\"<]*\"|'[^'<]*'|[^'\">])*+)>"
    r"|<[!?/a-zA-Z][^>]*(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
NOT_DISPLAYED = re.compile(r"(?:^|;)\s*display\s*:\s*none\b")
PART = re.compile(r"[^a-z0-9]+")
WORD = re.compile(r"[^\W\d_]+")

#: Marks that end sentences, followed by a space where the script has spaces.
SENTENCE = re.compile(r"[.!?…؟۔।॥։።](?=[\s\"'»”’)\]]|\Z)|[。！？｡]")
CJK = re.compile(r"[\u2E80-\u9FFF\uAC00-\uD7AF\uF900-\uFAFF\uFF66-\uFF9F\U00020000-\U0003FFFF]")

GOOD, BAD, NEAR, SHORT = "good", "bad", "near", "short"


class Block:
    __slots__ = ("text", "linked", "subject", "heading")

    def __init__(self, text: str, linked: int, subject: int, heading: bool):
        self.text, self.linked, self.subject, self.heading = text, linked, subject, heading


#: Why a container is left out.
DECLARED, HIDDEN = 1, 2


def left_out(attrs: str) -> int:
    """Whether its attributes say that a container is hidden, or declare it not to be the subject."""
    why = 0
    for name, *values in ATTRIBUTE.findall(attrs):
        name, value = name.lower(), "".join(values).lower()
        if name == "hidden":
            hidden = not value.strip().startswith("until")
        elif name == "aria-hidden":
            hidden = value.strip() == "true"
        else:
            hidden = name == "style" and bool(NOT_DISPLAYED.search(value))
        if hidden:
            return HIDDEN
        if name in ("class", "id", "role"):
            for token in value.split():
                parts = {p for p in PART.split(token) if p}
                if parts and parts <= NOT_SUBJECT:
                    why = DECLARED
    return why


def blocks_of(html: str) -> list[Block]:
    """The page's blocks in order, without furniture. ``subject`` numbers the article a block is in, 0 outside."""
    out: list[Block] = []
    stack: list[tuple[str, int, int]] = []  # open containers: name, why left out, article
    pieces: list[str] = []
    links: list[str] = []
    state = {"in_link": False, "heading": False, "articles": 0}

    def flush() -> None:
        text = " ".join(unescape("".join(pieces)).split())
        if text:
            linked = len(" ".join(unescape("".join(links)).split()))
            out.append(Block(text, linked, stack[-1][2] if stack else 0, state["heading"]))
        pieces.clear()
        links.clear()
        state["in_link"] = False

    def take(text: str) -> None:
        if text and not (stack and stack[-1][1]):
            pieces.append(text)
            if state["in_link"]:
                links.append(text)

    at = 0
    for m in TOKEN.finditer(html):
        take(html[at : m.start()])
        at = m.end()
        tag = m["tag"]
        if not tag:
            continue
        tag, end = tag.lower(), bool(m["end"])
        if tag == "a":
            state["in_link"] = not end
        elif tag == "br":
            take(" ")
        elif tag in BLOCKS:
            flush()
            state["heading"] = tag in HEADINGS and not end
            if tag not in NESTED:
                continue
            if end:
                if any(name == tag for name, _, _ in stack):
                    while stack.pop()[0] != tag:
                        pass
                continue
            attrs = m["attrs"]
            declared = left_out(attrs) if attrs else 0
            if tag in SUBJECT and not declared:
                # An end tag is missing if furniture seems to hold the subject.
                while stack and stack[-1][0] in FURNITURE:
                    stack.pop()
            out_of, article = (stack[-1][1], stack[-1][2]) if stack else (0, 0)
            if tag in SUBJECT and not declared and not article and out_of == DECLARED:
                out_of = 0
            if tag in SUBJECT and not declared and not out_of:
                if not article:
                    state["articles"] += 1
                    article = state["articles"]
            elif tag in FURNITURE and not (tag == "header" and article):
                declared = max(declared, DECLARED)
            if not attrs.endswith("/"):
                stack.append((tag, max(out_of, declared), article))
    take(html[at:])
    flush()
    return out


def stop_share(text: str) -> float:
    words = WORD.findall(text.lower())
    return sum(w in STOP_WORDS for w in words) / len(words) if words else 0.0


def judge(block: Block, foreign: bool = False) -> str:
    """The first pass: what a block is by itself. ``foreign``: its language has no stop words here."""
    n = len(block.text)
    if not block.subject and (block.linked > MAX_LINK_SHARE * n or "\N{COPYRIGHT SIGN}" in block.text):
        return BAD
    if foreign:
        n += (DENSE - 1) * len(CJK.findall(block.text))
    if n < SHORT_CHARS:
        return BAD if block.linked and not block.subject else SHORT
    if foreign and not block.subject:
        return BAD if not SENTENCE.search(block.text) else GOOD if n > LONG_CHARS else NEAR
    stops = stop_share(block.text)
    if stops >= STOP_HIGH:
        return GOOD if n > LONG_CHARS else NEAR
    if stops >= STOP_LOW:
        return NEAR
    # Other languages have other function words: within an article length decides.
    return NEAR if block.subject and n > LONG_CHARS else SHORT if block.subject else BAD


def main_text(html: str | None) -> str:
    if not html:
        return ""
    blocks = blocks_of(html)
    # Links and lines too short for a sentence say nothing on the language.
    foreign = not any(
        stop_share(b.text) >= STOP_LOW for b in blocks if len(b.text) >= SHORT_CHARS and b.linked <= MAX_LINK_SHARE * len(b.text)
    )
    first = [judge(b, foreign) for b in blocks]
    linked = [bool(b.subject) and b.linked == len(b.text) for b in blocks]
    for i in range(1, len(blocks)):
        if linked[i - 1] and linked[i] and blocks[i - 1].subject == blocks[i].subject:
            first[i - 1] = first[i] = BAD
    # Where articles are marked, the rest of the page is not the subject.
    if any(b.subject and f != BAD for b, f in zip(blocks, first)):
        first = [f if b.subject else BAD for b, f in zip(blocks, first)]
    if GOOD not in first:
        # A short article: without long blocks the fuller ones decide, within an article the short ones too.
        best = NEAR if NEAR in first else SHORT if any(b.subject for b in blocks) else None
        first = [GOOD if f == best else f for f in first]
    before, after = [BAD] * len(blocks), [BAD] * len(blocks)
    for order, seen in ((range(len(blocks)), before), (range(len(blocks) - 1, -1, -1), after)):
        last, subject = BAD, 0
        for i in order:
            if blocks[i].subject != subject:
                last, subject = BAD, blocks[i].subject
            seen[i] = last
            if first[i] in (GOOD, BAD):
                last = first[i]
    kept = []
    for i, block in enumerate(blocks):
        label = first[i]
        if label in (NEAR, SHORT):
            if block.subject or label == NEAR or block.heading:
                near = (after[i],) if block.heading and after[i] == GOOD else (before[i], after[i])
                label = GOOD if GOOD in near else BAD
            else:
                label = GOOD if before[i] == after[i] == GOOD else BAD
        if label == GOOD:
            kept.append(block.text)
    return "\n\n".join(kept)


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` without the html, with ``text`` and ``n_chars`` (code points)."""
    kept = [f for f in pages.schema if f.name != html and f.name.lower() not in ("text", "n_chars")]
    schema = T.StructType([*kept, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    names = [f.name for f in kept]

    def run(batches):
        for batch in batches:
            texts = [main_text(x) for x in batch.column(html).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())],
                names=[*names, "text", "n_chars"],
            )

    return pages.select(*names, html).mapInArrow(run, schema)
