"""Blocks of text of a web page, each with the zone it stands in."""

from __future__ import annotations

import html
import re

# What html elements are.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead "
    "title tr ul".split())
SILENT = frozenset("script style noscript template iframe object svg math canvas select textarea head title button audio video".split())
RAW = frozenset("script style textarea title iframe noscript".split())
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CHROME = frozenset("nav header footer aside form menu dialog".split())
MAIN = frozenset("article main".split())
#: Words that mark comments, whose articles are no main text.
COMMENT_NAMES = frozenset("comment comments commentlist reply replies disqus respond".split())
#: Words in class, id or role that mark what is not the article.
CHROME_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion popup modal overlay cookie cookies "
    "consent gdpr notice notices alert breadcrumb breadcrumbs menu menus nav navbar navigation topbar toolbar sidebar sidebars side "
    "widget widgets footer foot footnotes header masthead comment comments commentlist reply replies disqus respond share sharing social "
    "related recommended newsletter subscribe subscription signup login search pagination pager skip copyright legal disclaimer "
    "contentinfo complementary".split())

_tag = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*(?=>|\Z)|[^>]*)(?:>|\Z)", re.S)
_attribute = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_may_hide = re.compile("hidden|display", re.I)  # only then is it worth a closer look
_no_display = re.compile(r"(?:^|;)\s*display\s*:\s*none", re.I)
_space = re.compile(r"\s+")
_words = re.compile(r"[^a-z]+")
_layout = re.compile(r"\b(?:has|with|no|without)[-_]\w+")
_raw_end = {t: re.compile(rf"</{t}\b[^>]*(?:>|\Z)", re.I) for t in RAW}
# ends that html leaves out: the elements that a new one closes
_implied = {"p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"},
            "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"}}
_closes_p = BLOCKS - {"body", "html", "head", "title", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "dd", "dt", "li"}


def _attributes(raw: str) -> dict[str, str]:
    """Attributes by name in lower case; the first of a name counts."""
    found: dict[str, str] = {}
    for m in _attribute.finditer(raw):
        found.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    return found


def _is_hidden(attributes: dict[str, str]) -> bool:
    return ("hidden" in attributes or attributes.get("aria-hidden", "").strip().lower() == "true"
            or bool(_no_display.search(attributes.get("style", ""))))


def _zone(tag: str, attributes: str, here: str) -> str:
    """The zone inside an element that stands in zone ``here``.  ``soft`` is
    chrome by a form or by a name, in which an article is still an article."""
    if here == "silent" or tag in SILENT:
        return "silent"
    named = "=" in attributes and tag not in ("html", "body")
    known = _attributes(attributes) if named or (attributes and _may_hide.search(attributes)) else {}
    if known and _is_hidden(known):
        return "silent"
    if here == "chrome":
        return here  # an article inside a menu or among comments is part of that
    if tag in CHROME and tag != "form" and not (tag == "header" and here == "main"):
        return "chrome"
    words = {w for n in ("class", "id", "role") if n in known for w in _words.split(_layout.sub(" ", known[n].lower()))} if named else ()
    if words and not COMMENT_NAMES.isdisjoint(words):
        return "chrome"
    if tag in MAIN:
        return "main"
    return "soft" if tag == "form" or (words and not CHROME_NAMES.isdisjoint(words)) else here


def blocks(page: str) -> list[tuple[str, str]]:
    """``(zone, text)`` of every block with text, in page order; the zone is
    ``main`` (article or main), ``chrome`` or empty.

    Character references are decoded, white space inside a block becomes one
    space, blocks are trimmed.  Markup that is not closed ends where html says
    that it does, or with the page.
    """
    out: list[tuple[str, str]] = []
    stack: list[tuple[str, str]] = []  # open elements and the zone inside
    parts: list[str] = []
    zone, at = "", 0

    def flush() -> None:
        if parts:
            if zone != "silent" and (text := _space.sub(" ", html.unescape("".join(parts))).strip()):
                out.append(("chrome" if zone == "soft" else zone, text))
            parts.clear()

    while True:
        m = _tag.search(page, at)
        if m is None:
            parts.append(page[at:])
            break
        parts.append(page[at:m.start()])
        at = m.end()
        if m[2] is None:
            if m[0].startswith("<![CDATA["):
                parts.append(html.escape(m[0][9:-3], quote=False))
            continue
        tag, closing = m[2].lower(), m[1]
        if closing:
            if tag in BLOCKS:
                flush()
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    if zone != (stack[k - 1][1] if k else ""):
                        flush()
                    del stack[k:]
                    break
                if stack[k][0] in ("td", "th", "table", "article", "main", "nav", "aside", "footer", "header", "form") and tag not in BLOCKS:
                    break  # a stray end inside a container closes nothing outside it
        else:
            if tag == "br":
                parts.append(" ")
                continue
            if tag in BLOCKS:
                flush()
            if tag in EMPTY:
                continue
            if tag in _implied or tag in _closes_p:
                ends = _implied.get(tag, {"p"})
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] in ends:
                        del stack[k:]
                        break
                    if stack[k][0] in BLOCKS:
                        break
            here = stack[-1][1] if stack else ""
            if tag in RAW:  # nothing in it is markup; it ends at its own end tag
                end = _raw_end[tag].search(page, at)
                at = end.end() if end else len(page)
                continue
            if (m[3] or "").rstrip().endswith("/") and tag not in BLOCKS:
                continue
            new = _zone(tag, m[3] or "", here)
            if new != here:
                flush()
            stack.append((tag, new))
        zone = stack[-1][1] if stack else ""
    flush()
    return out
