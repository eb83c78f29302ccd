"""A tree of what an HTML page shows: scanner, style rules and tree builder, each in one pass.

The scanner reads every character once, with the tag, comment and raw-text states of HTML. The builder has HTML's
insertion modes: an element carries the mode that holds inside it, so that popping elements restores the mode. Implied
tags, scopes and foster parenting are as in HTML. Scopes are looked up in lists of stack positions, not by walking the
stack, so deep nesting costs nothing extra.

Formatting elements (b, i, a, ...) have no layout of their own, so where HTML opens them again in the next block, the
builder only keeps count of those in the list of active ones that hide what they hold.

Simplified: html, head and body are one element; a script that comments out its own end tag ends there all the same;
style rules count for selectors of an element, a class, an id, or an element with one of these, outside of at-rules.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

#: Fixed by HTML: elements without content, and those whose content is text up to their end tag.
VOID = frozenset("area base basefont bgsound br col embed frame hr img input keygen link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
#: Fixed by HTML: elements that are not shown, and MathML and SVG elements that are not.
UNSEEN = frozenset("head title script style template noscript datalist iframe audio video canvas noembed noframes area base link meta param source track rp".split())
UNSEEN_FOREIGN = frozenset("annotation annotation-xml title desc defs metadata style script symbol clippath mask pattern marker lineargradient radialgradient filter".split())
#: Fixed by HTML: blocks.
LISTS = frozenset("ul ol menu dir".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CELLS = frozenset(("td", "th"))
_GROUPS = frozenset(("tbody", "thead", "tfoot"))
_TABLE_CONTEXT = frozenset(("table", "tbody", "thead", "tfoot", "tr"))
BLOCKS = LISTS | HEADINGS | frozenset(
    "p dl table blockquote pre figure fieldset hr xmp listing plaintext address article aside center details dialog dd div dt figcaption footer form header hgroup legend li main nav search section summary optgroup".split()
)
_ENDS_PARAGRAPH = BLOCKS - frozenset(("optgroup", "legend"))
FORMATTING = frozenset("a b big code em font i nobr s small strike strong tt u".split())
_MARKED = frozenset("applet marquee object".split())
VERBATIM = frozenset("pre listing xmp textarea plaintext".split())
_TABLE_STARTS = frozenset("caption col colgroup tbody td tfoot th thead tr".split())
#: Fixed by HTML: at which elements scopes end, and which elements stop an end tag of another one.
_SCOPE = frozenset("applet caption table td th marquee object template".split())
_SPECIAL = BLOCKS | CELLS | _GROUPS | _SCOPE | frozenset("area base basefont bgsound body br button col colgroup embed frame frameset head html iframe img input keygen link meta noembed noframes noscript param script select source style summary textarea title tr track wbr".split())
_SPECIAL_BUT_PLAIN = _SPECIAL - frozenset(("address", "div", "p"))
#: Fixed by HTML: tags that end SVG and MathML, and elements there that hold HTML.
_BREAKOUT = LISTS | HEADINGS | frozenset("b big blockquote body br center code dd div dl dt em embed head hr i img li listing meta nobr p pre ruby s small span strong strike sub sup table tt u var".split())
_HTML_POINTS = frozenset("foreignobject desc title mi mo mn ms mtext".split())
_POINT_LISTED = ("#scope", "#button", "#list", "#special", "#plain")

_NAME = re.compile(r"[^\t\n\f />]++")
_BLANK = re.compile(r"[\t\n\f /]*+")
_ATTRIBUTE_NAME = re.compile(r"=?[^\t\n\f />=]*+")
_EQUALS = re.compile(r"[\t\n\f ]*+=[\t\n\f ]*+")
_UNQUOTED = re.compile(r"[^\t\n\f >]*+")
_COMMENT_END = re.compile(r"--!?>")
_LONG_REFERENCE = re.compile(r"&#(?:0*+([0-9]{8,}+)|[xX]0*+([0-9a-fA-F]{7,}+));?")
_ZEROS = re.compile(r"(&#[xX]?)0++(?=[0-9a-fA-F])")
_WHITE = " \t\n\f\r"


def references(text: str) -> str:
    """Text with character references resolved; numbers beyond Unicode become the replacement character."""
    if "&" not in text:
        return text
    if "&#" in text:
        text = _LONG_REFERENCE.sub("�", _ZEROS.sub(r"\1", text))
    return unescape(text)


Token = tuple[str, str, dict[str, str] | None, bool]


def tokens(html: str) -> Iterator[Token]:
    """("text" | "raw" | "start" | "end", text or name, attributes, self-closing). A tag that the page ends in is dropped."""
    html = html.replace("\r\n", "\n").replace("\r", "\n").replace("\x00", "")
    at, size = 0, len(html)
    ends: dict[str, re.Pattern[str]] = {}
    foreign: list[str] = []  # open svg, math and foreignObject, as far as the scanner must know
    opened: Counter[str] = Counter()
    while at < size:
        tag = html.find("<", at)
        if tag < 0:
            yield "text", html[at:], None, False
            return
        if tag > at:
            yield "text", html[at:tag], None, False
        following = html[tag + 1 : tag + 2]
        closing = following == "/"
        name_at = tag + 1 + closing
        letter = html[name_at : name_at + 1]
        if not (letter.isascii() and letter.isalpha()):
            if following == "!" or following == "?" or (closing and letter):
                at = _markup_end(html, tag, bool(foreign) and foreign[-1] != "foreignobject")
                if html.startswith("<![CDATA[", tag) and foreign and foreign[-1] != "foreignobject":
                    yield "raw", html[tag + 9 : at - 3 if html.endswith("]]>", tag + 9, at) else at], None, False
            else:
                yield "text", "<", None, False
                at = tag + 1
            continue
        name_end = _NAME.match(html, name_at).end()
        name = html[name_at:name_end].lower()
        found = _attributes(html, name_end)
        if found is None:
            return
        attributes, self_closing, at = found
        if closing:
            while opened[name]:
                last = foreign.pop()
                opened[last] -= 1
                if last == name:
                    break
            yield "end", name, None, False
            continue
        yield "start", name, attributes, self_closing
        inside = bool(foreign) and foreign[-1] != "foreignobject"
        if name in ("svg", "math") or (name == "foreignobject" and inside):
            if not self_closing:
                foreign.append(name)
                opened[name] += 1
        elif name == "plaintext" and not inside:
            yield "raw", html[at:], None, False
            return
        elif name in RAW and not inside:
            end = ends.get(name) or ends.setdefault(name, re.compile(rf"</{name}(?=[\t\n\f />])", re.I))
            close = end.search(html, at)
            content = html[at : close.start() if close else size]
            if content:
                yield "raw", references(content) if name in ("textarea", "title") else content, None, False
            yield "end", name, None, False
            if close is None:
                return
            rest = _attributes(html, close.end())
            if rest is None:
                return
            at = rest[2]


def _markup_end(html: str, at: int, foreign: bool) -> int:
    """Where a comment, declaration or other markup that begins at a place has ended."""
    if html.startswith("<!--", at):
        if html.startswith(("<!-->", "<!--->"), at):
            return html.index(">", at) + 1
        end = _COMMENT_END.search(html, at + 4)
        return end.end() if end else len(html)
    if foreign and html.startswith("<![CDATA[", at):
        end_at = html.find("]]>", at)
        return end_at + 3 if end_at >= 0 else len(html)
    end_at = html.find(">", at + 2)
    return end_at + 1 if end_at >= 0 else len(html)


def _attributes(html: str, at: int) -> tuple[dict[str, str], bool, int] | None:
    """The attributes of a tag from behind its name, whether it closes itself, and where it has ended; None if the page ends before."""
    found: dict[str, str] = {}
    size = len(html)
    while True:
        begin = at
        at = _BLANK.match(html, at).end()
        if at >= size:
            return None
        if html[at] == ">":
            return found, at > begin and html[at - 1] == "/", at + 1
        end = _ATTRIBUTE_NAME.match(html, at).end()
        name, value, at = html[at:end].lower(), "", end
        equals = _EQUALS.match(html, at)
        if equals is not None:
            at = equals.end()
            quote = html[at : at + 1]
            if quote == '"' or quote == "'":
                end = html.find(quote, at + 1)
                if end < 0:
                    return None
                value, at = html[at + 1 : end], end + 1
            else:
                end = _UNQUOTED.match(html, at).end()
                value, at = html[at:end], end
        found.setdefault(name, value)


# style

_DECLARATION = re.compile(r"(display|visibility)\s*+:\s*+([a-z-]++)\s*+(!\s*+important)?", re.I)
_CSS_COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.S)
_SELECTOR = re.compile(r"([a-z][a-z0-9]*+|\*)?([.#][\w-]++)?", re.I)
Style = dict[str, tuple[tuple[int, int, int], str]]  # property: (weight, value)


def _declared(block: str, weight: int, order: int) -> Style:
    style: Style = {}
    for part in block.split(";"):
        m = _DECLARATION.match(part.strip())
        if m is not None:
            _prefer(style, {m[1].lower(): ((int(m[3] is not None), weight, order), m[2].lower())})
    return style


def _prefer(style: Style, other: Style) -> None:
    """Takes over what weighs at least as much."""
    for key, value in other.items():
        if key not in style or value[0] >= style[key][0]:
            style[key] = value


class Rules:
    """The display and visibility that a page's style elements give to elements, classes and ids."""

    def __init__(self, sheets: list[str]):
        self.by: dict[tuple[str, str], Style] = {}
        order = 0
        for sheet in sheets:
            for selectors, block in _blocks(_CSS_COMMENT.sub(" ", sheet)):
                order += 1
                if "display" not in block.lower() and "visibility" not in block.lower():
                    continue
                for selector in selectors.split(","):
                    m = _SELECTOR.fullmatch(selector.strip())
                    if m is None or not m[0]:
                        continue
                    tag, mark = (m[1] or "*").lower(), m[2] or ""
                    weight = (tag != "*") + {"": 0, ".": 10, "#": 100}[mark[:1]]
                    _prefer(self.by.setdefault((tag, mark), {}), _declared(block, weight, order))

    def of(self, tag: str, attributes: dict[str, str]) -> tuple[str | None, str | None]:
        """display and visibility of an element, where anything says so."""
        style: Style = {}
        if self.by:
            marks = ["", *("." + c for c in attributes.get("class", "").split()), *(["#" + attributes["id"]] if "id" in attributes else [])]
            for mark in marks:
                for key in (("*", mark), (tag, mark)):
                    if key in self.by:
                        _prefer(style, self.by[key])
        if "style" in attributes:
            _prefer(style, _declared(references(attributes["style"]), 1000, 0))
        display = style["display"][1] if "display" in style else "none" if "hidden" in attributes else None
        return display, style["visibility"][1] if "visibility" in style else None


def _blocks(css: str) -> Iterator[tuple[str, str]]:
    """Selectors and declarations of the rules outside of at-rules."""
    at = 0
    while (brace := css.find("{", at)) >= 0:
        head = css[at:brace].rpartition(";")[2].strip()
        if head.startswith("@"):
            depth, at = 1, brace + 1
            for m in re.compile(r"[{}]").finditer(css, at):
                depth += 1 if m[0] == "{" else -1
                if depth == 0:
                    at = m.end()
                    break
            else:
                return
            continue
        end = css.find("}", brace)
        end = len(css) if end < 0 else end
        yield head, css[brace + 1 : end]
        at = end + 1


# tree


class Node:
    """An element. children are nodes and (text, verbatim) pairs; what is not displayed has none."""

    __slots__ = ("tag", "attributes", "children", "mode", "foreign", "shown", "visible", "verbatim", "silent", "block", "within", "in_item", "closed", "above")

    def __init__(self, tag: str, attributes: dict[str, str], above: Node | None):
        self.tag, self.attributes, self.children, self.above = tag, attributes, [], above
        self.mode = above.mode if above else "body"
        self.foreign = ""
        self.shown, self.visible = (above.shown, above.visible) if above else (True, True)
        self.verbatim = (above.verbatim if above else False) or tag in VERBATIM
        self.silent = above.silent if above else False
        self.block = tag in BLOCKS
        self.within = above.within if above else None  # the list or cell around it
        self.in_item = above.in_item if above else False  # in a list item, with no table in between
        self.closed = False


_MODES = {"table": "table", "tbody": "rows", "thead": "rows", "tfoot": "rows", "tr": "row", "td": "cell", "th": "cell", "caption": "caption", "colgroup": "columns", "select": "select", "template": "body"}
#: The lists of stack positions that a tag is in, besides its own.
_LISTED: dict[str, tuple[str, ...]] = {
    tag: tuple(
        name
        for name, tags in (
            ("#scope", _SCOPE), ("#button", _SCOPE | {"button"}), ("#list", _SCOPE | {"ol", "ul"}), ("#table", frozenset(("table", "template"))), ("#special", _SPECIAL), ("#plain", _SPECIAL_BUT_PLAIN), ("#heading", HEADINGS),
        )
        if tag in tags
    )
    for tag in _SPECIAL
}


class Builder:
    """Builds the tree of one page. Elements nest to any depth without recursion."""

    def __init__(self, rules: Rules):
        self.rules = rules
        self.root = Node("body", {}, None)
        self.stack = [self.root]
        self.at: dict[str, list[int]] = {}
        self.active: list[dict[str, list[Node]]] = [{}]  # formatting elements that are not ended, by tag, since each marker
        self.hiding = [0]  # how many of those hide what they hold
        self.open_foreign: Counter[str] = Counter()
        self.fostering = False
        self.skip_newline = False

    # stack

    def last(self, name: str) -> int:
        found = self.at.get(name)
        return found[-1] if found else -1

    def in_scope(self, tag: str, scope: str = "#scope") -> bool:
        """Whether an element with the tag is open, and none that ends the scope above it."""
        return (at := self.last(tag)) > 0 and at >= self.last(scope)

    def push(self, tag: str, attributes: dict[str, str]) -> Node:
        node = self.insert(tag, attributes)
        position = len(self.stack)
        self.stack.append(node)
        self.at.setdefault(tag, []).append(position)
        for name in _LISTED.get(tag, ()):
            self.at.setdefault(name, []).append(position)
        return node

    def pop(self) -> Node:
        node = self.stack.pop()
        if not node.foreign:
            if not node.closed:
                self.at[node.tag].pop()
            for name in _LISTED.get(node.tag, ()):
                self.at[name].pop()
        else:
            self.open_foreign[node.tag] -= 1
            if node.tag in _HTML_POINTS:
                for name in _POINT_LISTED:
                    self.at[name].pop()
        return node

    def pop_to(self, position: int) -> None:
        """Pops everything from a stack position on."""
        while len(self.stack) > max(1, position):
            self.pop()

    def clear_to(self, tags: frozenset[str]) -> None:
        while len(self.stack) > 1 and self.stack[-1].tag not in tags:
            self.pop()

    # tree

    def insert(self, tag: str, attributes: dict[str, str], foreign: str = "") -> Node:
        """A new element in the tree, not on the stack."""
        current = self.stack[-1]
        fostered = self.fostering and current.tag in _TABLE_CONTEXT and not current.foreign
        above = self._foster_parent() if fostered else current
        node = Node(tag, attributes, above)
        if fostered:
            node.mode = current.mode
        node.mode = _MODES.get(tag, node.mode)
        node.foreign = foreign
        display, visibility = self.rules.of(tag, attributes) if attributes or self.rules.by else (None, None)
        if foreign:
            unseen = tag in UNSEEN_FOREIGN
            node.silent = above.silent if foreign == "math" else tag not in ("text", "foreignobject") and (tag == "svg" or above.silent)
            node.block = tag == "text"
        else:
            unseen = tag in UNSEEN or (tag == "dialog" and "open" not in attributes)
            if tag in LISTS or tag in CELLS or tag == "table":
                node.within = node
            if above.tag == "li":
                node.in_item = True
            elif tag == "table":
                node.in_item = False
        if display == "none" or (unseen and (display is None or not foreign and tag != "dialog")):
            node.shown = False
        elif display is not None and tag not in _TABLE_CONTEXT and tag not in CELLS and tag != "caption":
            node.block = not display.startswith(("inline", "contents"))
        if visibility is not None:
            node.visible = visibility not in ("hidden", "collapse")
        if node.shown:
            self._put(node, above, fostered)
        return node

    def _foster_parent(self) -> Node:
        table = self.stack[self.last("table")] if self.last("table") > 0 else self.stack[0]
        return table.above or self.root

    def _put(self, child: Node | tuple[str, bool], above: Node, fostered: bool) -> None:
        if not above.shown:
            return
        if fostered and above.children:  # before the open table, which is the last child
            above.children.insert(len(above.children) - 1, child)
        else:
            above.children.append(child)

    def add_text(self, text: str) -> None:
        current = self.stack[-1]
        fostered = self.fostering and current.tag in _TABLE_CONTEXT and not current.foreign
        above = self._foster_parent() if fostered else current
        if text and above.shown and above.visible and not above.silent and not self.hiding[-1]:
            self._put((text, above.verbatim), above, fostered)

    # active formatting elements

    def activate(self, tag: str, node: Node) -> None:
        self.active[-1].setdefault(tag, []).append(node)
        self.hiding[-1] += not (node.shown and node.visible)

    def mark(self) -> None:
        self.active.append({})
        self.hiding.append(0)

    def clear_to_mark(self) -> None:
        self.active.pop()
        self.hiding.pop()
        if not self.active:
            self.mark()

    def end_formatting(self, tag: str) -> None:
        """Ends the last active element of a tag; blocks that were opened inside it stay open."""
        nodes = self.active[-1].get(tag)
        if not nodes:
            self.end_other(tag)
            return
        node = nodes.pop()
        self.hiding[-1] -= not (node.shown and node.visible)
        at = self.last(tag)
        if at < 0 or self.stack[at] is not node:
            return
        if at > self.last("#special"):
            self.pop_to(at)
        else:
            node.closed = True
            self.at[tag].pop()
            self._open_again(node, at)

    def _open_again(self, node: Node, at: int) -> None:
        """What hid through the ended element is shown from now on, in those blocks that stay open."""
        if node.shown and node.visible or not (node.above and node.above.shown and node.above.visible):
            return
        above = node.above
        for k in range(at + 1, len(self.stack)):
            old = self.stack[k]
            if old.foreign:
                return
            renewed = Node(old.tag, old.attributes, above)
            renewed.mode, renewed.closed, renewed.block, renewed.in_item = old.mode, old.closed, old.block, old.in_item
            renewed.within = renewed if old.within is old else above.within
            display, visibility = self.rules.of(old.tag, old.attributes)
            if display == "none" or old.tag in UNSEEN or visibility in ("hidden", "collapse"):
                return
            above.children.append(renewed)
            self.stack[k] = above = renewed

    # tokens

    def build(self, found: list[Token]) -> Node:
        for kind, name, attributes, self_closing in found:
            if self.skip_newline:
                self.skip_newline = False
                if kind in ("text", "raw") and name.startswith("\n"):
                    name = name[1:]
            if kind == "text":
                self.text(references(name))
            elif kind == "raw":
                self.add_text(name)
            else:
                current = self.stack[-1]
                if current.foreign and not self._holds_html(current, name, kind):
                    self._foreign(kind, name, attributes, self_closing)
                elif kind == "start":
                    self.start(name, attributes, self_closing)
                else:
                    self.end(name)
        return self.root

    def text(self, text: str) -> None:
        current = self.stack[-1]
        if current.mode in ("table", "rows", "row", "columns") and current.tag in _TABLE_CONTEXT | {"colgroup"} and not current.foreign:
            if not text.strip(_WHITE):
                return
            if current.tag == "colgroup":
                self.pop()
            self.fostering = True
            self.add_text(text)
            self.fostering = False
        else:
            self.add_text(text)

    def start(self, name: str, attributes: dict[str, str], self_closing: bool) -> None:
        """A start tag, in the mode that holds; after popping what a tag ends, it is taken up again."""
        while True:
            mode = self.stack[-1].mode
            if mode in ("cell", "caption") and name in _TABLE_STARTS:
                if not self._close_cell():
                    return
            elif mode == "select" and self._in_select(name, attributes):
                return
            elif mode == "row" and name in _TABLE_STARTS:
                self.clear_to(frozenset(("tr", "template")))
                if name in CELLS:
                    self.push(name, attributes)
                    self.mark()
                    return
                self.pop()
            elif mode == "rows" and name in _TABLE_STARTS:
                self.clear_to(_GROUPS | {"template"})
                if name == "tr":
                    self.push(name, attributes)
                    return
                if name in CELLS:
                    self.push("tr", {})
                else:
                    self.pop()
            elif mode == "columns":
                if name == "col":
                    return
                self.pop()
            elif mode in ("table", "rows", "row") and name == "table":
                if self.last("table") < self.last("#table"):
                    return
                self.pop_to(self.last("table"))
            elif mode == "table" and name in _TABLE_STARTS:
                self.clear_to(frozenset(("table", "template")))
                if name in CELLS or name == "tr":
                    self.push("tbody", {})
                elif name == "col":
                    self.push("colgroup", {})
                else:
                    self.push(name, attributes)
                    if name == "caption":
                        self.mark()
                    return
            elif mode in ("table", "rows", "row") and name not in ("script", "style", "template"):
                self.fostering = self.stack[-1].tag in _TABLE_CONTEXT
                self.start_in_body(name, attributes, self_closing)
                self.fostering = False
                return
            elif mode != "select":
                if name not in _TABLE_STARTS:
                    self.start_in_body(name, attributes, self_closing)
                return

    def _close_cell(self) -> bool:
        """Ends the open cell or caption; whether there was one."""
        at = max(self.last("td"), self.last("th"), self.last("caption"))
        if at <= self.last("#table"):
            return False
        self.pop_to(at)
        self.clear_to_mark()
        return True

    def _in_select(self, name: str, attributes: dict[str, str]) -> bool:
        """A start tag in a select; False if the select was ended and the tag is to be taken up again."""
        if name in ("option", "optgroup", "hr"):
            if self.stack[-1].tag == "option":
                self.pop()
            if name != "option" and self.stack[-1].tag == "optgroup":
                self.pop()
            if name != "hr":
                self.push(name, attributes)
            return True
        if name in ("input", "keygen", "textarea", "select", "table") or name in _TABLE_STARTS:
            self.pop_to(self.last("select"))
            return name == "select"
        if name in ("script", "template", "style"):
            self.push(name, attributes)
        return True

    def start_in_body(self, name: str, attributes: dict[str, str], self_closing: bool) -> None:
        if name in ("html", "body", "head", "frameset", "frame"):
            if name == "body" and len(self.stack) == 1 and not self.root.children:
                display, visibility = self.rules.of(name, attributes)
                self.root.shown = display != "none"
                self.root.visible = visibility not in ("hidden", "collapse")
            return
        if name in _ENDS_PARAGRAPH and self.in_scope("p", "#button"):
            self.pop_to(self.last("p"))
        if name in HEADINGS:
            if self.stack[-1].tag in HEADINGS:
                self.pop()
        elif name == "li":
            if self.last("li") >= max(self.last("#plain"), 1):
                self.pop_to(self.last("li"))
        elif name in ("dd", "dt"):
            at = max(self.last("dd"), self.last("dt"))
            if at >= max(self.last("#plain"), 1):
                self.pop_to(at)
        elif name == "button":
            if self.in_scope("button"):
                self.pop_to(self.last("button"))
        elif name in ("option", "optgroup"):
            if self.stack[-1].tag == "option":
                self.pop()
        elif name in ("rt", "rp", "rb", "rtc"):
            while self.stack[-1].tag in ("rt", "rp", "rb"):
                self.pop()
        elif name in ("a", "nobr"):
            if self.active[-1].get(name):
                self.end_formatting(name)
        elif name in ("svg", "math"):
            self._push_foreign(name, attributes, name, self_closing)
            return
        if name in VOID or name == "image":
            self.insert(name, attributes)
            return
        node = self.push(name, attributes)
        if name in FORMATTING:
            self.activate(name, node)
        elif name in _MARKED:
            self.mark()
        self.skip_newline = name in ("pre", "listing", "textarea")

    def end(self, name: str) -> None:
        """An end tag, in the mode that holds."""
        mode = self.stack[-1].mode
        if name == "template":
            if self.last("template") > 0:
                self.pop_to(self.last("template"))
        elif mode == "select" and name not in ("script", "style"):
            if name == "select" or name == "table" or name in _TABLE_STARTS:
                self.pop_to(self.last("select"))
                if name != "select":
                    self.end(name)
            elif name in ("option", "optgroup"):
                if name == "optgroup" and self.stack[-1].tag == "option" and self.stack[-2].tag == "optgroup":
                    self.pop()
                if self.stack[-1].tag == name:
                    self.pop()
        elif name in CELLS or name == "caption":
            if self.last(name) > self.last("#table"):
                self._close_cell()
        elif name == "tr" or name in _GROUPS or name == "table":
            at = self.last(name)
            if at > 0 and at >= self.last("#table"):
                if max(self.last("td"), self.last("th"), self.last("caption")) > at:
                    self._close_cell()
                self.pop_to(at)
        elif name in ("html", "body", "head", "col"):
            return  # what follows still belongs to the body
        elif name == "colgroup":
            if mode == "columns":
                self.pop()
        else:
            self.end_in_body(name)

    def end_in_body(self, name: str) -> None:
        if name == "br":
            self.start("br", {}, False)
        elif name == "p":
            if not self.in_scope("p", "#button"):
                self.start("p", {}, False)
            if self.in_scope("p", "#button"):
                self.pop_to(self.last("p"))
        elif name in FORMATTING:
            self.end_formatting(name)
        elif name in HEADINGS:
            if self.in_scope("#heading"):
                self.pop_to(self.last("#heading"))
        elif name in _MARKED:
            if self.in_scope(name):
                self.pop_to(self.last(name))
                self.clear_to_mark()
        elif name == "li":
            if self.in_scope("li", "#list"):
                self.pop_to(self.last("li"))
        elif name in BLOCKS or name == "button":
            if self.in_scope(name):
                self.pop_to(self.last(name))
        else:
            self.end_other(name)

    def end_other(self, name: str) -> None:
        """Ends the innermost element of a tag, unless a block or the like was opened inside it."""
        at = self.last(name)
        if at > 0 and at >= self.last("#special"):
            self.pop_to(at)

    # SVG and MathML

    def _holds_html(self, node: Node, name: str, kind: str) -> bool:
        return kind == "start" and node.tag in _HTML_POINTS and name not in ("mglyph", "malignmark") and (node.foreign == "svg") == (node.tag in ("foreignobject", "desc", "title"))

    def _push_foreign(self, name: str, attributes: dict[str, str], foreign: str, self_closing: bool) -> None:
        node = self.insert(name, attributes, foreign)
        if not self_closing:
            self.stack.append(node)
            self.open_foreign[name] += 1
            if name in _HTML_POINTS:
                for listed in _POINT_LISTED:
                    self.at.setdefault(listed, []).append(len(self.stack) - 1)

    def _foreign(self, kind: str, name: str, attributes: dict[str, str] | None, self_closing: bool) -> None:
        if kind == "start":
            if name in _BREAKOUT or (name == "font" and attributes and not attributes.keys().isdisjoint(("color", "face", "size"))):
                while self.stack[-1].foreign and self.stack[-1].tag not in _HTML_POINTS:
                    self.pop()
                self.start(name, attributes or {}, self_closing)
            else:
                self._push_foreign(name, attributes or {}, self.stack[-1].foreign, self_closing)
            return
        if name in ("p", "br"):
            while self.stack[-1].foreign and self.stack[-1].tag not in _HTML_POINTS:
                self.pop()
            self.end(name)
            return
        if self.stack[-1].tag == name:  # the usual case
            self.pop()
            return
        if not self.open_foreign[name] and self.last(name) < 0:
            return
        k = len(self.stack) - 1
        while self.stack[k].foreign and self.stack[k].tag != name:
            k -= 1
        if self.stack[k].foreign:
            self.pop_to(k)
        elif self.last(name) > 0:
            self.pop_to(k + 1)
            self.end(name)


def tree(html: str) -> Node:
    """The tree of a page's body."""
    found = list(tokens(html))
    sheets = [text for (kind, name, *_), (after, text, *_) in zip(found, found[1:], strict=False) if kind == "start" and name == "style" and after == "raw"]
    return Builder(Rules(sheets)).build(found)
