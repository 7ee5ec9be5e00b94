"""A forgiving reader of HTML: elements with their style paths, and text blocks in page order."""

from __future__ import annotations

import html
import re

import xxhash

# Fixed by the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var".split())
CLOSES = {
    "p": frozenset(
        "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
    ),
    "li": frozenset({"li"}),
    "dt": frozenset({"dt", "dd"}),
    "dd": frozenset({"dt", "dd"}),
    "option": frozenset({"option", "optgroup"}),
    "tr": frozenset({"tr", "tbody", "tfoot"}),
    "td": frozenset({"td", "th", "tr", "tbody", "tfoot"}),
    "th": frozenset({"td", "th", "tr", "tbody", "tfoot"}),
}
SCOPE = frozenset("table td th ul ol dl body html div article section main button".split())

# Parts of a page that are never its main text: elements, ARIA roles, and words in class or id.
PART_TAGS = frozenset("head nav footer aside form script style noscript template iframe button select textarea svg canvas object dialog menu".split())
PART_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar toolbar".split())
PART_WORDS = frozenset(
    "ad ads advert adverts advertisement adsense sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs "
    "sidebar aside footer comment comments disqus reply replies cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe "
    "social share sharing related recommended recommendations toolbar pagination pager login signup search masthead topbar".split()
)

# A class that says what a wrapper has or lacks does not make the wrapper that part.
ABOUT_WORDS = frozenset("has have with no without open closed enabled".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|textarea|title|noscript|template|iframe)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>(?:.*?</\1\s*>|.*\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*>",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role|style|hidden|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_MARKED = re.compile(r"class|id|role|style|hidden", re.I)
_TARGET = re.compile(r"\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORD = re.compile(r"[a-z]+")


class Element:
    __slots__ = ("tag", "style", "parent", "path", "part", "main", "children", "blocks", "text_chars", "link_chars", "links", "target")

    def __init__(self, tag: str, style: str, parent: int, path: int, part: bool, main: bool):
        self.tag, self.style, self.parent, self.path, self.part, self.main = tag, style, parent, path, part, main
        self.children: list[str] = []
        self.text_chars = self.link_chars = self.links = 0
        self.target = ""


class Reader:
    """Reads pages; remembers how attributes and paths translate."""

    def __init__(self):
        self.styles: dict[tuple[str, str], tuple[str, bool, bool]] = {}
        self.paths: dict[tuple[int, str], int] = {}

    def style(self, tag: str, attributes: str) -> tuple[str, bool, bool]:
        """Presentation of an element (tag and class words without digits), whether it is never main text, and whether it is a header."""
        if not _MARKED.search(attributes):
            return tag, tag in PART_TAGS, tag == "header"
        known = self.styles.get((tag, attributes))
        if known:
            return known
        words: list[str] = []
        part, header = tag in PART_TAGS, tag == "header"
        for name, *values in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), next((x for x in values if x), "")
            if name in ("class", "id"):
                for group in value.split():
                    own = _WORD.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", " ", group).lower())
                    words += own if name == "class" else ()
                    if tag not in ("body", "html", "main") and ABOUT_WORDS.isdisjoint(own):
                        part |= not PART_WORDS.isdisjoint(own)
                        header |= "header" in own
            elif name == "role":
                part |= value.strip().lower() in PART_ROLES
            elif name == "style":
                part |= bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I))
            else:
                part |= name == "hidden" or value.lower() == "true"
        known = (".".join([tag, *sorted(set(words))]), part, header)
        if len(self.styles) < 50_000:
            self.styles[(tag, attributes)] = known
        return known

    def path(self, parent: int, style: str) -> int:
        known = self.paths.get((parent, style))
        if known is None:
            known = xxhash.xxh64_intdigest(f"{parent}/{style}") - (1 << 63)
            if len(self.paths) < 200_000:
                self.paths[(parent, style)] = known
        return known

    def read(self, page: str) -> tuple[list[Element], list[tuple[int, str]]]:
        """Elements in page order (0 is the root) and blocks (element, text): white space collapsed, none empty."""
        root = Element("", "", -1, 0, False, False)
        opened: dict[str, int] = {}
        elements, stack, blocks = [root], [0], []
        pieces: list[str] = []
        owner = 0  # the block element whose text is being gathered

        def flush() -> None:
            if pieces:
                text = " ".join(html.unescape("".join(pieces)).split())
                pieces.clear()
                if text:
                    blocks.append((owner, text))

        def leave(k: int) -> None:
            """Close the k-th open element and all within it."""
            for number in stack[k:]:
                opened[elements[number].tag] -= 1
            del stack[k:]

        def block_owner() -> int:
            for k in reversed(stack):
                if elements[k].tag not in INLINE:
                    return k
            return 0

        def add_text(text: str) -> None:
            nonlocal owner
            if not pieces:
                if text.isspace():
                    return
                owner = block_owner()
            pieces.append(text)
            n = len(text)
            top = elements[stack[-1]]
            top.text_chars += n
            if top.tag == "a" or any(elements[k].tag == "a" for k in stack[-4:]):
                top.link_chars += n

        at = 0
        for token in _TOKEN.finditer(page):
            if token.start() > at:
                add_text(page[at : token.start()])
            at = token.end()
            raw, close, name, attributes = token.group(1), token.group(2), token.group(3), token.group(4)
            if name is None:
                close, name, attributes = token.group(5), token.group(6), token.group(7)
            if raw is not None or name is None:
                if raw is not None and raw.lower() in ("textarea", "title", "iframe"):
                    flush()
                continue
            tag = name.lower()
            if close:
                if tag not in INLINE:
                    flush()
                # Without an open element of this name there is nothing to look for.
                for k in range(len(stack) - 1, 0, -1) if opened.get(tag) else ():
                    if elements[stack[k]].tag == tag:
                        leave(k)
                        break
                    if tag in INLINE and elements[stack[k]].tag not in INLINE:
                        break
                continue
            if tag not in INLINE:
                flush()
                if tag in VOID:
                    continue
                # An open p, li or cell ends where another begins, with the inline elements in it.
                for k in range(len(stack) - 1, 0, -1):
                    other = elements[stack[k]].tag
                    if other in CLOSES and tag in CLOSES[other]:
                        leave(k)
                        break
                    if other not in INLINE and (other in SCOPE or other in CLOSES):
                        break
            elif tag in VOID:
                continue
            style, part, header = self.style(tag, attributes)
            above = elements[stack[-1]]
            main = tag in ("article", "main") and not part
            # The header of an article holds its title; any other is the site's.
            part = part or header and not (above.main or main)
            element = Element(tag, style, stack[-1], self.path(above.path, style), part or above.part, main or above.main)
            if tag not in INLINE:
                above.children.append(style)
            if tag == "a":
                element.links = 1
                target = _TARGET.search(attributes)
                element.target = next((x for x in target.groups() if x), "") if target else ""
            stack.append(len(elements))
            opened[tag] = opened.get(tag, 0) + 1
            elements.append(element)
        if at < len(page):
            add_text(page[at:])
        flush()
        for k in range(len(elements) - 1, 0, -1):
            own, above = elements[k], elements[elements[k].parent]
            above.text_chars += own.text_chars
            above.link_chars += own.link_chars
            above.links += own.links
        return elements, blocks
