"""HTML pages to markdown: one reading of the tags, with the open elements on a stack.

It runs as an Arrow function, one page at a time, in time and memory in proportion to the page. Elements that are never closed,
closed twice or closed in the wrong order do no harm: a block ends the inline elements that are still open in it, and those then leave no mark.
"""

from __future__ import annotations

import html as escapes
import os
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Each alternative stops at the next angle bracket or at a fixed end, so a page is read once.
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][A-Za-z0-9]*)([^<>]*)>|<[^<>]*>", re.S)
_ATTRIBUTE = re.compile(r"""(?<![\w:-])([\w:-]++)\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++))""")
_ESCAPE = re.compile(r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,30});")
_ENDS = {tag: re.compile(rf"</{tag}\s*+>", re.I) for tag in ("script", "style")}
_BLANKS = re.compile("[ \t\r\n]+")
# Blanks and line ends that the tidying at the end must leave alone, and back.
_GUARD, _FREE = str.maketrans(" \n", "\x02\x03"), str.maketrans("\x02\x03", " \n")
_DROP = str.maketrans("", "", "\x02\x03")

# What stands around the text of inline elements, and elements that begin and end a paragraph.
INLINE = {"b": "**", "strong": "**", "i": "*", "em": "*", "code": "`", "a": None}
BLOCKS = frozenset("p div section header footer main aside nav figure figcaption address dl form fieldset details summary".split())
HEADINGS = frozenset(f"h{n}" for n in range(1, 7))
LISTS = frozenset(("ul", "ol"))
# Lists and quotations deeper than this are not indented further.
DEEPEST = 32


def _decoded(text: str) -> str:
    return _ESCAPE.sub(lambda m: escapes.unescape(m[0]).replace("\xa0", " "), text) if "&" in text else text


class _Writer:
    """The markdown so far, and what is open."""

    def __init__(self):
        self.out: list[str] = []
        self.breaks = 0  # line ends due before the next text
        self.fresh = True  # at the start of a line, but for marks
        self.blocks: list[list] = []  # [tag, what its further lines begin with, next number]
        self.prefixes: list[str] = []
        self.prefix = self.last_prefix = ""
        self.inline: list[list] = []  # [tag, place of its opening mark or None, address]
        self.placed = 0  # inline elements whose opening mark has its place
        self.open = Counter()  # of inline elements and blocks by tag
        self.pre: list[str] | None = None
        self.tables = 0
        self.cells = self.rows = 0
        self.cell = False

    # Text and line ends

    def line_end(self, n: int) -> None:
        if self.cell:
            self.text(" ")
        elif self.out and not (self.fresh and not self.breaks):
            self.breaks = max(self.breaks, n)

    def flush(self) -> None:
        """Write the line ends that are due, and what the line begins with."""
        if self.breaks:
            between = os.path.commonprefix((self.prefix, self.last_prefix)).rstrip("\x02")
            self.out.append("\n" + (between + "\n") * (self.breaks - 1) + self.prefix)
            self.breaks, self.fresh = 0, True
        elif not self.out and self.prefix:
            self.out.append(self.prefix)
        self.last_prefix = self.prefix

    def mark(self, text: str) -> None:
        """Marks that begin a line or cell; text after them does not start with a blank."""
        self.flush()
        self.out.append(text)
        self.fresh = True

    def text(self, text: str) -> None:
        if self.pre is not None:
            self.pre.append(text)
            return
        text = _BLANKS.sub(" ", _decoded(text))
        if self.tables and not self.cell and text == " ":
            return
        if self.fresh or self.breaks:
            text = text.lstrip(" ")
        if not text:
            return
        self.flush()
        for element in self.inline[self.placed :]:
            element[1] = len(self.out)
            self.out.append("")
        self.placed = len(self.inline)
        self.out.append(text.replace("|", "\\|") if self.cell else text)
        self.fresh = False

    # Inline elements

    def drop_inline(self) -> None:
        for element in self.inline:
            self.open[element[0]] -= 1
        self.inline.clear()
        self.placed = 0

    def start_inline(self, tag: str, attributes: str) -> None:
        address = _attribute(attributes, "href") if tag == "a" else None
        self.inline.append([tag, None, address])
        self.open[tag] += 1

    def end_inline(self, tag: str) -> None:
        while self.open[tag]:
            name, place, address = self.inline.pop()
            self.placed = min(self.placed, len(self.inline))
            self.open[name] -= 1
            if name == tag:
                if place is not None and (tag != "a" or address):
                    self.out[place] = INLINE[tag] or "["
                    self.out.append(INLINE[tag] or f"]({address})")
                return

    # Blocks

    def push(self, tag: str, prefix: str, number: int = 0) -> None:
        self.blocks.append([tag, prefix, number])
        self.open[tag] += 1
        if len(self.blocks) <= DEEPEST:
            self.prefix += prefix

    def pop(self) -> str:
        tag, prefix, _ = self.blocks.pop()
        self.open[tag] -= 1
        if len(self.blocks) < DEEPEST and prefix:
            self.prefix = self.prefix[: -len(prefix)]
        return tag

    def start_item(self) -> None:
        while self.blocks and self.blocks[-1][0] not in LISTS and self.open["li"]:
            self.pop()
        around = self.blocks[-1] if self.blocks and self.blocks[-1][0] in LISTS else None
        mark = "* "
        if around and around[0] == "ol":
            mark = f"{around[2]}. "
            around[2] += 1
        # An item's own line begins as the list's lines do; its further ones are indented.
        if self.breaks == 0 and not self.out:
            self.flush()
        self.breaks = max(self.breaks, 1) if self.out and not (self.fresh and not self.breaks) else self.breaks
        self.mark(mark)
        self.push("li", "\x02" * len(mark))

    def end_block(self, tag: str) -> None:
        while self.open[tag]:
            if self.pop() == tag:
                break

    def start(self, tag: str, attributes: str) -> None:
        if self.pre is not None:
            if tag == "br":
                self.pre.append("\n")
            return
        if tag in INLINE:
            return self.start_inline(tag, attributes)
        if tag == "br":
            if self.cell:
                self.text(" ")
            elif self.out:
                self.breaks = min(2, self.breaks + 1)
            return
        if tag == "img":
            source = _attribute(attributes, "src")
            if source:
                self.text(f"![{_attribute(attributes, 'alt') or ''}]({source})")
            return
        if tag == "table" or self.tables and tag in ("tr", "td", "th"):
            return self.table_part(tag)
        if self.cell:
            if tag in BLOCKS or tag in LISTS or tag in ("li", "pre", "blockquote", "hr") or tag in HEADINGS:
                self.text(" ")
            return
        if tag in BLOCKS or tag in HEADINGS or tag in LISTS or tag in ("li", "pre", "blockquote", "hr", "dt", "dd"):
            self.drop_inline()
        if tag in BLOCKS:
            self.line_end(2)
        elif tag in HEADINGS:
            self.line_end(2)
            self.mark("#" * int(tag[1]) + " ")
        elif tag in LISTS:
            self.line_end(1 if self.open["li"] else 2)
            first = _attribute(attributes, "start") if tag == "ol" else None
            self.push(tag, "", int(first) if first and re.fullmatch(r"[0-9]{1,9}", first) else 1)
        elif tag == "li":
            self.start_item()
        elif tag == "blockquote":
            self.line_end(2)
            self.push(tag, ">\x02")
        elif tag == "pre":
            self.line_end(2)
            self.pre = []
        elif tag == "hr":
            self.line_end(2)
            self.mark("---")
            self.fresh = False
            self.line_end(2)
        elif tag in ("dt", "dd"):
            self.line_end(1)

    def end(self, tag: str) -> None:
        if self.pre is not None:
            if tag == "pre":
                self.end_pre()
            return
        if tag in INLINE:
            return self.end_inline(tag)
        if tag == "table" or self.tables and tag in ("tr", "td", "th"):
            return self.table_end(tag)
        if self.cell:
            if tag in BLOCKS or tag in HEADINGS or tag == "li":
                self.text(" ")
            return
        if tag in BLOCKS or tag in HEADINGS:
            self.drop_inline()
            self.fresh = False
            self.line_end(2)
        elif tag in LISTS or tag in ("li", "blockquote"):
            self.drop_inline()
            self.end_block(tag)
            self.fresh = False
            self.line_end(1 if tag == "li" or self.open["li"] else 2)

    def end_pre(self) -> None:
        """Code as it stands, in a fence longer than any in it."""
        code = _decoded("".join(self.pre)).replace("\r\n", "\n").replace("\r", "\n").strip("\n").rstrip()
        self.pre = None
        if not code:
            return
        fence = "`" * max(3, 1 + max(map(len, re.findall("`+", code)), default=0))
        self.flush()
        lines = [fence, *code.translate(_GUARD).split("\x03"), fence]
        self.out.append(("\x03" + self.prefix).join(lines))
        self.fresh = False
        self.line_end(2)

    # Tables; one inside a cell is read as the cell's text

    def table_part(self, tag: str) -> None:
        self.drop_inline()
        if tag == "table":
            if not self.tables:
                self.line_end(2)
                self.rows = 0
            self.tables += 1
        elif self.tables > 1:
            if self.cell:
                self.text(" ")
        elif tag == "tr":
            self.end_row()
        else:
            self.cell = False
            if not self.cells:
                self.fresh = False
                self.line_end(1 if self.rows else 2)
            self.mark(("" if self.cells == 0 else " ") + "| ")
            self.cells += 1
            self.cell = True

    def end_row(self) -> None:
        self.cell = False
        if self.cells:
            self.out.append(" |")
            if not self.rows:
                self.out.append("\n" + self.prefix + "|" + " --- |" * self.cells)
            self.rows += 1
        self.cells, self.fresh = 0, False

    def table_end(self, tag: str) -> None:
        self.drop_inline()
        if tag == "table":
            if self.tables:
                self.tables -= 1
                if not self.tables:
                    self.end_row()
                    self.line_end(2)
                elif self.cell:
                    self.text(" ")
        elif self.tables == 1:
            if tag == "tr":
                self.end_row()
            else:
                self.cell = False

    def finish(self) -> str:
        if self.pre is not None:
            self.end_pre()
        if self.tables:
            self.end_row()
        text = re.sub(" {2,}", " ", "".join(self.out)).replace(" \n", "\n").replace("\n ", "\n")
        return re.sub("\n{3,}", "\n\n", text).strip(" \t\r\n").translate(_FREE)



def _attribute(attributes: str, name: str) -> str | None:
    """The value of the first attribute of this name, decoded."""
    for found in _ATTRIBUTE.finditer(attributes):
        if found[1].lower() == name:
            return _decoded(found[2] or found[3] or found[4] or "").strip()
    return None


def to_markdown(html: str) -> str:
    """One page; see ``html_to_markdown``."""
    html, writer, at = html.translate(_DROP), _Writer(), 0
    while at < len(html):
        token = _TOKEN.search(html, at)
        if token is None:
            writer.text(html[at:])
            break
        if token.start() > at:
            writer.text(html[at : token.start()])
        at = token.end()
        tag = (token[2] or "").lower()
        if token[1]:
            writer.end(tag)
        elif tag in _ENDS:
            end = _ENDS[tag].search(html, at)
            at = end.end() if end else len(html)
        elif tag:
            writer.start(tag, token[3])
    return writer.finish()


def html_to_markdown(html: Column) -> Column:
    """Markdown of a page or a part of one; NULL stays NULL, a page without text is empty.

    ``#`` headings, ``*`` and numbered items indented by their lists, ``>`` quotations, fenced ``pre`` whose lines and blanks stay, tables
    with their first row as header, links, images, emphasis and code, whatever attributes the tags carry. Inline
    elements that hold no text, or a block, leave no mark; scripts, styles and comments go; other tags are dropped and their text stays.
    Characters U+0002 and U+0003 are dropped.
    """

    return _converter(None)(html)


def article_markdown(html: Column) -> Column:
    """The first ``<article>`` as markdown, those nested in it included; NULL when the page has none."""
    return _converter("article")(html)


def _converter(element: str | None):
    @F.arrow_udf("string")
    def convert(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for pages in batches:
            parts = (first_inner(page, element) if element and page is not None else page for page in pages.to_pylist())
            yield pa.array((None if part is None else to_markdown(part) for part in parts), pa.string())

    # Not deterministic, so that a later filter on the text does not convert pages again.
    return convert.asNondeterministic()


def first_inner(page: str, tag: str) -> str | None:
    """What the first element of a kind holds, nested ones of its kind included; one never closed reaches to the end."""
    start = re.search(rf"<{tag}(?:\s[^<>]*+)?>", page, re.I)
    if start is None:
        return None
    depth = 1
    for edge in re.compile(rf"<(/?){tag}[\s>]", re.I).finditer(page, start.end()):
        depth += -1 if edge[1] else 1
        if not depth:
            return page[start.end() : edge.start()]
    return page[start.end() :]
