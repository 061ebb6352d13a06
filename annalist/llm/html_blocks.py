"""Flat text blocks of a web page.

A page is read tag by tag, without building a tree: of the open elements only what matters for their text is kept. A block is the
text between two block-level tags. Malformed pages are read like a browser does where it matters for blocks: an open
paragraph or list item ends where the next begins, an end tag without a start is ignored, a script that never ends takes the rest.
"""

from __future__ import annotations

import re
from functools import lru_cache
from html import unescape
from typing import NamedTuple

# Names of elements, and words that class, id and role of page parts are made of.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: their text is no text of the page; the first ones hold no tags either
RAW_TAGS = frozenset("script style title textarea xmp iframe noembed noframes".split())
HIDDEN_TAGS = RAW_TAGS | frozenset("template noscript svg canvas object audio video select button datalist map".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
FRAME_TAGS = frozenset("nav footer aside form menu dialog".split())
CONTENT_TAGS = frozenset("article main".split())
FRAME_WORDS = re.compile(
    "ads?|adv|advert.*|adsense|adslot|banner.*|sponsor.*|promo|promos|promoted|promotion|sidebar.*|rail|widgets?|menus?|"
    "navs?|navbar|navigation|breadcrumbs?|footer|footnav|masthead|topbar|toolbar|cookies?|cookiebar|consent|gdpr|privacy|notices?|"
    "alerts?|popups?|modal|overlay|newsletters?|subscribe|subscription|signup|login|search|searchform|share|sharing|shares|"
    "social|follow|related|recommend.*|teasers?|comments?|commentlist|disqus.*|respond|reply|replies|discussion|copyright|"
    "legal|pagination|pager|skip|outbrain|taboola|complementary|contentinfo|alertdialog|dialog|paywall"
)
HEAD_WORDS = frozenset("header head".split())
CONTENT_WORDS = frozenset("article articlebody content entry post story main blogpost".split())
NEGATIONS = frozenset("has no with without".split())
#: an element that starts ends an open one of these, up to one of those
ENDED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dd": ({"dd", "dt"}, {"dl"}),
    "dt": ({"dd", "dt"}, {"dl"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr"}, {"table"}),
}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*\"[^\"]*\"|=\s*'[^']*'|=)*+)>|<[!?/][^>]*(?:>|\Z)", re.S
)
_UNFINISHED = re.compile(r"<[a-zA-Z/][^<>]*\Z")
_ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORD = re.compile(r"[A-Z]?[a-z0-9]+|[A-Z]+(?![a-z])")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for name in RAW_TAGS}


class Block(NamedTuple):
    text: str
    words: int
    link_words: int
    in_content: bool
    in_frame: bool
    frame_name: bool
    content_name: bool
    heading: bool
    item: bool


class _Open(NamedTuple):
    """An open element with what it and those around it say."""

    name: str
    block: bool
    link: bool
    hidden: bool
    in_content: bool
    in_frame: bool
    frame_name: bool
    content_name: bool
    heading: bool
    item: bool


_PAGE = _Open("", True, False, False, False, False, False, False, False, False)


@lru_cache(4096)
def named(attributes: str) -> tuple[bool, bool, bool]:
    """Whether class, id and role name a part of the frame, the head, or the content."""
    frame = head = content = False
    for _, *values in _ATTRIBUTE.findall(attributes):
        words = [w.lower() for w in _WORD.findall("".join(values))]
        for before, word in zip(["", *words], words, strict=False):
            if before not in NEGATIONS:
                frame = frame or FRAME_WORDS.fullmatch(word) is not None
                head = head or word in HEAD_WORDS
                content = content or word in CONTENT_WORDS
    return frame, head, content


def _opened(name: str, attributes: str, around: _Open) -> _Open:
    frame, head, content = named(attributes) if attributes and name not in ("html", "body") else (False, False, False)
    inside = around.in_content or around.content_name
    heads = (name == "header" or head) and not inside
    return _Open(
        name,
        name in BLOCK_TAGS,
        around.link or name == "a",
        around.hidden or name in HIDDEN_TAGS,
        around.in_content or name in CONTENT_TAGS,
        around.in_frame or name in FRAME_TAGS or heads and name == "header",
        around.frame_name or frame or heads and head,
        around.content_name or content,
        around.heading or name in HEADINGS,
        around.item or name in ("li", "dd", "dt"),
    )


def _close_before(stack: list[_Open], name: str) -> None:
    """End the paragraph or item that a starting block-level element ends."""
    for at in range(len(stack) - 1, 0, -1):
        if stack[at].name == "p":
            del stack[at:]
            break
        if stack[at].block:
            break
    if name in ENDED_BY:
        ended, up_to = ENDED_BY[name]
        for at in range(len(stack) - 1, 0, -1):
            if stack[at].name in ended:
                del stack[at:]
                return
            if stack[at].name in up_to:
                return


def _close(stack: list[_Open], name: str) -> None:
    """End the innermost open element of the name; an inline one never ends a block-level one."""
    inline = name not in BLOCK_TAGS and name not in HIDDEN_TAGS
    for at in range(len(stack) - 1, 0, -1):
        if stack[at].name == name:
            del stack[at:]
            return
        if inline and stack[at].block:
            return


def blocks_of(page: str | None) -> list[Block]:
    """The page's blocks in order; none for null or a page without text."""
    out: list[Block] = []
    if not page:
        return out
    stack, parts, at, size = [_PAGE], [], 0, len(page)

    def flush() -> None:
        if parts:
            text = " ".join("".join(t for t, _ in parts).split())
            if text:
                linked = sum(len(t.split()) for t, link in parts if link)
                top = stack[-1]
                out.append(Block(text, text.count(" ") + 1, linked, *top[4:]))
            parts.clear()

    while at < size:
        tag = _TOKEN.search(page, at)
        end = tag.start() if tag else size
        if end > at and not stack[-1].hidden:
            text = page[at:end] if tag else _UNFINISHED.sub("", page[at:end])
            parts.append((unescape(text) if "&" in text else text, stack[-1].link))
        if tag is None:
            break
        at = tag.end()
        if tag[2] is None:
            continue
        name = tag[2].lower()
        if tag[1]:
            if name == "br":
                parts.append((" ", False))
            if name in BLOCK_TAGS:
                flush()
            _close(stack, name)
            continue
        if name == "br":
            parts.append((" ", False))
            continue
        if name in BLOCK_TAGS:
            flush()
            _close_before(stack, name)
        elif name == "a":
            _close(stack, "a")
        if name in VOID_TAGS:
            continue
        if name in RAW_TAGS:
            closed = _RAW_END[name].search(page, at)
            at = closed.end() if closed else size
            continue
        if not (name == "svg" and tag[3].endswith("/")):
            stack.append(_opened(name, tag[3], stack[-1]))
    flush()
    return out
