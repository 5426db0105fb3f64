"""HTML as a flat run of tags and texts, with the containers each stands in."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

_ATTRIBUTES = r"""(?:[^>"']|"[^"]*"|'[^']*')*"""
_RAW = "script|style|noscript|template|textarea|iframe|svg|select|button"
_PIECE = re.compile(
    rf"(?P<skip><!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z))"
    rf"|<(?P<raw>{_RAW})\b{_ATTRIBUTES}>.*?(?:</(?P=raw)\s*>|\Z)"
    rf"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>{_ATTRIBUTES}(?:>|\Z)|[^>]*(?:>|\Z))"
    rf"|(?P<text>[^<]+|<)",
    re.S | re.I,
)
_NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

CONTAINERS = frozenset(
    "html head body main article section div nav header footer aside ul ol dl table form figure dialog menu details".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr math mi mn mo mrow mtext msub msup msubsup mfrac msqrt mover munder".split()
)
CONTENT = frozenset(("article", "main"))
WHOLE = CONTENT | {"html", "body"}  # never boilerplate by what they are called
LISTS = frozenset("ul ol dl table figure menu details".split())
BOILERPLATE = frozenset("head nav footer aside form dialog".split())
OUTER = frozenset("header menu".split())  # boilerplate outside an article
BOILERPLATE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar footer comment comments disqus respond cookie cookies consent notice notices popup modal "
    "newsletter subscribe share sharing social related recommended widget toolbar pagination pager login search masthead".split()
)

# What follows one of these in a class, as in has-sidebar, is not what the element is.
MODIFIERS = frozenset("has no non not with without hide hides hidden show shows is".split())


@dataclass(slots=True)
class Piece:
    """A tag or a text. ``path`` names the open containers, ``cut`` says that one of them is boilerplate."""

    kind: str  # open, close or text
    name: str  # of the tag, or the raw text
    path: str
    cut: bool
    role: str = field(default="")


def _names(rest: str) -> list[str]:
    return [w.lower() for value in _NAMED.findall(rest) for w in _PARTS.findall(value)]


def _called_boilerplate(rest: str) -> bool:
    """Whether a class, id or role says that the element is boilerplate, words behind a modifier left out."""
    for value in _NAMED.findall(rest):
        for token in value.strip("\"'").split():
            for word in map(str.lower, _PARTS.findall(token)):
                if word in MODIFIERS:
                    break
                if word in BOILERPLATE_NAMES:
                    return True
    return False


def pieces(page: str) -> Iterator[Piece]:
    """The tags and texts of a page, comments, scripts and styles left out.

    Only containers are kept open, and an end tag closes up to its own start, so paragraphs and inline
    markup that is never closed does no harm.
    """
    stack: list[tuple[str, str, bool]] = []  # tag, path below it, boilerplate
    for m in _PIECE.finditer(page):
        kind = m.lastgroup
        path, cut = (stack[-1][1], stack[-1][2]) if stack else ("", False)
        if m["text"] is not None:
            yield Piece("text", m["text"], path, cut)
        elif m["name"] is not None:
            name = m["name"].lower()
            if m["close"]:
                if name in CONTAINERS:
                    at = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
                    if at is None:
                        continue
                    del stack[at:]
                    path, cut = (stack[-1][1], stack[-1][2]) if stack else ("", False)
                yield Piece("close", name, path, cut, f"{path}</{name}>")
                continue
            if name not in CONTAINERS:
                yield Piece("open", name, path, cut, f"{path}<{name}>")
                continue
            said = _names(m["rest"])
            label = "".join(f".{w}" for w in said[:3])
            inside = any(t in CONTENT for t, _, _ in stack)
            own = name in BOILERPLATE or (name in OUTER and not inside) or (name not in WHOLE and _called_boilerplate(m["rest"]))
            yield Piece("open", name, path, cut or own, f"{path}<{name}{label}>")
            if not m["rest"].rstrip(">").endswith("/"):
                stack.append((name, f"{path}/{name}{label}", cut or own))
        elif kind == "raw":
            yield Piece("open", m["raw"].lower(), path, True, f"{path}<{m['raw'].lower()}>")


def clean(text: str) -> str:
    """References decoded, white space as single spaces, trimmed."""
    return " ".join(html.unescape(text).split())
