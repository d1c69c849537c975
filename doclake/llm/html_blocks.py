"""A web page as its sequence of leaf blocks: text, and the path of tags (with class and id words) it stands in."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

# Element names of the HTML standard.
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr "
    "math maction merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub "
    "msubsup msup mtable mtd mtext mtr munder munderover semantics".split()
)
_CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 "
    "h6 header hgroup hr main menu nav ol p pre search section table ul".split()
)
_SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_SCOPES = frozenset("ul ol dl table menu select article section div body".split())
_RAW = "script|style|noscript|template|textarea|iframe|select|object|noembed|noframes|xmp|annotation|annotation-xml"
# Start tags that end an open <svg>, as in browsers; what stands in its parts of HTML does not.
_LEAVES_SVG = (
    "b|big|blockquote|body|br|center|code|dd|div|dl|dt|em|embed|h[1-6]|head|hr|i|img|li|listing|menu|meta|nobr|ol|p|pre|ruby|s|small|"
    "span|strong|strike|sub|sup|table|tt|u|ul|var|article|aside|footer|header|main|nav|section"
)
# A name ends at white space, "/" or ">"; attributes are names with values, and a quote inside an unquoted value, or one that
# is never closed, is a character like any other.
_ENDS = r"(?=[\s/>])"
_ATTRS = r"""(?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]++)?+)?+)*+"""
_SVG_PARTS = "|".join(rf"<{name}{_ENDS}{_ATTRS}(?<!/)>.*?</{name}\s*>" for name in ("foreignobject", "desc", "title"))
_SVG = (
    rf"<svg{_ENDS}{_ATTRS}(?:(?<=/)>|>(?:[^<]++|{_SVG_PARTS}"
    rf"|<(?!/svg[\s/>]|(?:{_LEAVES_SVG})[\s/>]))*+(?:</svg[^>]*+>)?)"
)
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|{_SVG}|<(?P<raw>{_RAW}){_ENDS}{_ATTRS}>.*?(?:</(?P=raw){_ENDS}[^>]*+(?:>|\Z)|\Z)"
    rf"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>{_ATTRS})(?:>|\Z)|<[!?/][^>]*(?:>|\Z)|(?P<text>[^<]+|<)",
    re.S | re.I,
)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
_WORDS = re.compile(r"[a-z]+|[0-9]+")


@dataclass
class Block:
    """One leaf block. ``linked``: the characters of its text that stand in links."""

    path: tuple[str, ...]
    text: str
    linked: int


def blocks(page: str) -> list[Block]:
    """The page's blocks with text, in order.

    Character references are decoded, white space in a block is one space; comments, scripts, styles, embedded objects and
    the choices of forms are no text. Missing end tags are put in as browsers do, stray ones are passed over.
    """
    found: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    texts: list[str] = []
    linked = 0
    path: tuple[str, ...] = ()

    def end() -> None:
        nonlocal texts, linked, path
        if texts:
            text = " ".join("".join(texts).split())
            if text:
                found.append(Block(path, text, min(linked, len(text))))
        texts, linked, path = [], 0, ()

    for m in _TOKEN.finditer(page):
        text = m["text"]
        if m["tag"] and not m[0].endswith(">"):  # the page ends before the tag does: text
            text = m[0]
        if text is not None:
            text = html.unescape(text)
            if not path and not text.isspace():
                path = tuple(w for _, words in stack for w in words)
            if any(t == "a" for t, _ in stack):
                linked += len(text)
            texts.append(text)
            continue
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "br":
            texts.append(" ")
            continue
        if tag not in _INLINE:
            end()
        if m["close"]:
            at = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
            if at is not None:
                del stack[at:]
            continue
        if tag in _VOID:
            continue
        closing = {"p"} if tag in _CLOSES_P else _SIBLINGS.get(tag)
        if closing:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in closing:
                    del stack[i:]
                    break
                if stack[i][0] in _SCOPES:
                    break
        words = [tag]
        for name in _NAMES.finditer(m["attrs"]):
            words += ["." + w for w in _WORDS.findall((name[1] or name[2] or name[3] or "").lower())]
        if not m["attrs"].rstrip().endswith("/") or tag in ("a", "p", "div", "span", "li"):
            stack.append((tag, tuple(words)))
    end()
    return found
