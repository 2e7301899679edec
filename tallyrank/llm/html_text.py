"""Main text of HTML pages by two passes of block rules.

A page is cut into blocks at block-level tags. The first pass decides each block by itself:
text in menus, footers, side bars, notices, adverts, forms or comments (by element, role or
class name) and blocks that are mostly links are out; long blocks with the share of stop
words that prose has are in. All others, short ones above all, stay undecided. The second
pass lets every undecided block inherit the label of its nearest decided neighbours in the
same part of the page, where cut-outs by element, role or class name inside an article do not
count. Inside an article element undecided blocks with no decided neighbour are in; outside
they are out if the page has an article or any block that is in. Prose outside articles stays in.

A name or a form is a reason, not a verdict. Names that tell a state (``no-sidebar``,
``comments-open``, ``ad-free``) are none. Where everything outside such elements holds no article
element, those around one are kept, and those with over half of the page's prose (names of
comments only with all of it); if no prose is left at all, all but comments are kept. An
article element ends an open ``nav``.

Defined results: a null or empty page has the empty text. Character references are decoded
in text, cut or unknown ones stay as written. An unclosed comment, script or tag runs to the
end of the page. Pages of any length are read whole; repeated rows are rows of the result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from html import unescape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyrank.llm.common import map_texts

MAX_LINK_SHARE = 0.4
LONG_CHARS = 70
MIN_STOP_SHARE = 0.2

# Common function words of English, German, French and Spanish.
STOP_WORDS = frozenset(
    """
    a an and are as at be been but by for from had has have he her his if in into is it its not
    of on or our she so than that the their them then there these they this to was we were
    which who will with you your
    aber als am auch auf aus bei bin bis das dem den der des die du ein eine einen einer er es
    für hat ich ihr im ist kein man mit nach nicht noch nur oder sein sich sie sind so um und
    von vor war wie wir zu zum zur über
    au aux avec ce ces dans de elle en est et eux il ils je la le les leur lui ma mais me
    même mes mon ne nous on ou par pas pour qu que qui sa se ses son sur ta te un une vous
    al como con del el ella ellos entre era esta este fue ha hay las lo los más mi muy no o
    para pero por porque se sin sobre su sus también una uno y ya
    """.split()
)

_RAW = frozenset("script style textarea title xmp".split())
_SKIPPED = frozenset(
    "head noscript template svg math iframe object canvas video audio button select "
    "datalist dialog".split()
)
_OUT = frozenset("nav footer aside menu".split())
_ARTICLE = frozenset("article main".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main "
    "menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
# Elements whose end tag may be left out do not hold others open.
_LOOSE = frozenset("p li dt dd td th tr option h1 h2 h3 h4 h5 h6".split())
_OUT_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alert alertdialog menu menubar "
    "toolbar form".split()
)
_OUT_NAMES = frozenset(
    "ad adbox ads adsense adslot adv advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment "
    "comments consent cookie cookiebar cookies disclaimer disqus footer gdpr masthead menu menus modal nav navbar "
    "navigation newsletter notice notices notification outbrain overlay pagination popup promo "
    "promoted promotion recommended related remark remarks replies reply respond share sharing "
    "sidebar signup social sponsor sponsored subscribe subscription taboola toolbar topbar "
    "widget".split()
)

_COMMENT_NAMES = frozenset("comment comments disqus remark remarks replies reply respond".split())
# Names that begin or end like this tell a state of the page or of an element, not what it is.
_STATE = re.compile(
    r"(?:no|not|non|has|have|had|with|without|is|hide|hides|show|shows|enable|disable)[-_]"
    r"|.*[-_](?:open|opened|closed|free|enabled|disabled|on|off|none|hidden|visible|active|inactive)$",
    re.I,
)

_OUT_ENDINGS = ("sidebar", "footer", "navbar", "navigation", "comments", "banner")
# Beside one of these names, a header is that of an article.
_CONTENT_NAMES = frozenset("article body content entry main post story text".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)"
    r"(?P<attributes>(?:\"[^\"]*\"|'[^']*'|[^'\">])*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(
    r"(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?",
    re.I | re.S,
)
_NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_WORDS = re.compile(r"[^\W\d_]+")


@dataclass
class Block:
    text: str
    link_chars: int
    out: bool  # inside an element that is not part of any article
    article: int  # number of the article element around it, 0 if none
    heading: bool
    cuts: tuple[int, ...] = ()  # numbers of the elements around it that names or forms put out
    label: str = ""


@dataclass
class Cut:
    """An element that its name puts out, or a form."""

    kind: str  # name, comment or form
    article: int  # the article around it
    holds_article: bool = False
    prose: int = 0
    kept: bool = False


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(raw)}


def _out_by(name: str, raw: str, in_article: bool) -> str:
    """What puts an element out: ``element`` (its kind or role), ``name``, ``comment``, ``form``."""
    if name in _OUT or (name == "header" and not in_article):
        return "element"
    if name == "form":
        return "form"
    if not raw or name in ("html", "body"):
        return ""
    given = _attributes(raw)
    if given.get("role", "").lower() in _OUT_ROLES or "hidden" in given:
        return "element"
    if given.get("aria-hidden", "").lower() == "true":
        return "element"
    if name in _ARTICLE:
        return ""
    names = f"{given.get('class', '')} {given.get('id', '')}".split()
    parts = {p.lower() for n in names if not _STATE.match(n) for p in _NAME_PARTS.findall(n)}
    if parts & _COMMENT_NAMES or any(p.endswith("comments") for p in parts):
        return "comment"
    if "header" in parts and not in_article and not parts & _CONTENT_NAMES:
        return "name"
    return "name" if any(p in _OUT_NAMES or p.endswith(_OUT_ENDINGS) for p in parts) else ""


def blocks_of(page: str) -> tuple[list[Block], list[Cut]]:
    blocks: list[Block] = []
    made: list[Cut] = []
    pieces: list[str] = []
    # name, and what held before it: skipped, out, article, cuts
    stack: list[tuple[str, bool, bool, int, tuple[int, ...]]] = []
    cuts: tuple[int, ...] = ()
    skipped = out = False
    article = articles = links = link_chars = 0
    heading = False
    at = 0

    def flush() -> None:
        nonlocal link_chars
        text = " ".join(unescape("".join(pieces)).split())
        pieces.clear()
        if text:
            blocks.append(Block(text, link_chars, out, article, heading, cuts))
        link_chars = 0

    def say(text: str) -> None:
        nonlocal link_chars
        if text and not skipped:
            pieces.append(text)
            if links:
                link_chars += len(" ".join(unescape(text).split()))

    while True:
        found = _TOKEN.search(page, at)
        if found is None:
            say(page[at:])
            break
        say(page[at : found.start()])
        at = found.end()
        name = (found["name"] or "").lower()
        if not name:
            continue
        if found["close"]:
            if name == "a":
                links = max(0, links - 1)
            if name in _BLOCK:
                flush()
                links = 0
                heading = False
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), -1)
            if depth >= 0:
                flush()
                _, skipped, out, article, cuts = stack[depth]
                del stack[depth:]
            continue
        if name in _RAW:
            end = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if name == "a":
            links += 1
        elif name == "br":
            say(" ")
        if name in _BLOCK:
            flush()
            links = 0
            heading = name[0] == "h" and name[1:].isdigit()
        if name in _VOID or found["attributes"].endswith("/"):
            continue
        if name in _ARTICLE:
            menu = next((i for i, open_ in enumerate(stack) if open_[0] == "nav"), -1)
            if menu >= 0:
                _, skipped, out, article, cuts = stack[menu]
                del stack[menu:]
        out_by = _out_by(name, found["attributes"], article > 0)
        keeps = name in _SKIPPED or out_by or (name in _BLOCK and name not in _LOOSE)
        if keeps:
            if out_by or name in _SKIPPED:
                flush()
            stack.append((name, skipped, out, article, cuts))
            skipped = skipped or name in _SKIPPED
            if out_by == "element":
                out = True
            elif out_by:
                made.append(Cut(out_by, article))
                cuts = (*cuts, len(made) - 1)
            if name in _ARTICLE and not out and not article:
                articles += 1
                article = articles
                for i in cuts:
                    made[i].holds_article = True
    flush()
    return blocks, made


def _is_prose(block: Block) -> bool:
    if len(block.text) < LONG_CHARS or block.link_chars > MAX_LINK_SHARE * len(block.text):
        return False
    words = _WORDS.findall(block.text.lower())
    return bool(words) and sum(w in STOP_WORDS for w in words) >= MIN_STOP_SHARE * len(words)


def _without_cuts(blocks: list[Block], cuts: list[Cut]) -> list[Block]:
    """Decides which names and forms count, and leaves forms that do out altogether."""
    if not cuts:
        return blocks
    if not any(b.article and not b.cuts and not b.out for b in blocks):
        total = 0
        for b in blocks:
            size = len(b.text) if not b.out and _is_prose(b) else 0
            total += size
            for i in b.cuts:
                cuts[i].prose += size
        for cut in cuts:
            if cut.kind == "comment":
                cut.kept = 0 < total == cut.prose
            else:
                cut.kept = cut.holds_article or 2 * cut.prose > total
        if total and not any(_is_prose(b) and not b.out and all(cuts[i].kept for i in b.cuts) for b in blocks):
            for cut in cuts:
                cut.kept = cut.kept or cut.kind != "comment"
    left = []
    for b in blocks:
        gone = [cuts[i] for i in b.cuts if not cuts[i].kept]
        if any(cut.kind == "form" for cut in gone):
            continue
        if gone:
            b.out, b.article = True, gone[0].article
        left.append(b)
    return left


def _first_pass(block: Block) -> str:
    if block.out or block.link_chars > MAX_LINK_SHARE * len(block.text):
        return "out"
    return "in" if _is_prose(block) else ""


def _tells(block: Block) -> bool:
    """Whether neighbours inherit its label: a cut-out in an article says nothing about them."""
    return bool(block.label) and not (block.out and block.article)


def _second_pass(blocks: list[Block]) -> None:
    has_article = any(b.article and b.label != "out" for b in blocks)
    some_in = has_article or any(b.label == "in" for b in blocks)
    before: list[int | None] = []
    last: dict[int, int] = {}  # by article: the nearest decided block so far
    for i, b in enumerate(blocks):
        before.append(last.get(b.article))
        if _tells(b):
            last[b.article] = i
    following: dict[int, int] = {}
    inherited: dict[int, str] = {}
    for i in range(len(blocks) - 1, -1, -1):
        b = blocks[i]
        if _tells(b):
            following[b.article] = i
        if b.label:
            continue
        left, right = before[i], following.get(b.article)
        near = [j for j in (left, right) if j is not None]
        if b.heading and right is not None:
            inherited[i] = blocks[right].label
        elif near:
            # The nearer neighbour decides; at equal distance either may let the block in.
            least = min(abs(i - j) for j in near)
            labels = {blocks[j].label for j in near if abs(i - j) == least}
            inherited[i] = "in" if "in" in labels else "out"
        else:
            inherited[i] = "in" if b.article or not some_in else "out"
    for i, label in inherited.items():
        blocks[i].label = label
    if not some_in and all(b.label == "out" for b in blocks):
        for b in blocks:  # a page of short lines only: all that no rule put out
            if not b.out and b.link_chars <= MAX_LINK_SHARE * len(b.text):
                b.label = "in"


def main_text(page: str | None) -> str:
    blocks = _without_cuts(*blocks_of(page or ""))
    for block in blocks:
        block.label = _first_pass(block)
    _second_pass(blocks)
    return "\n\n".join(b.text for b in blocks if b.label == "in")


def extract(
    pages: DataFrame, html_col: str = "html", keep: list[str] | None = None
) -> DataFrame:
    """The columns ``keep`` (default: all) and the main text as ``text``, its length ``n_chars``.

    Columns of ``pages`` with these two names are replaced.
    """
    keep = [c for c in keep or pages.columns if c not in ("text", "n_chars")]

    def make():
        return lambda raw: (main_text((raw or b"").decode("utf-8", "replace")),)

    texts = map_texts(pages, html_col, make, [T.StructField("text", T.StringType())], keep)
    return texts.withColumn("n_chars", F.length("text").cast("long"))
