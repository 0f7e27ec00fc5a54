"""Visible text of HTML pages, laid out as a reader sees it.

A page is read tag by tag into a tree (implied end tags, void elements, stray end tags), elements that do not show
are left out, and the rest is rendered: blocks begin on new lines, paragraphs and headings stand apart by an empty line,
list items carry their bullet or number and are indented by depth, preformatted text keeps its white space, and the cells
of a table row are aligned in columns. No text is cut: a cell wider than ``ALIGN`` only doesn't widen its column.

All walks are loops with their own stack, so deep nesting and long pages do not matter. Spark splits the pages; a task
holds one Arrow batch of them.
"""

from __future__ import annotations

import re
from html import unescape
from unicodedata import east_asian_width

import pyarrow as pa
from pyspark.sql import DataFrame

ALIGN = 60

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = frozenset("head script style template title meta link iframe object svg canvas audio video datalist rp noembed noframes base param source track".split())
APART = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure hr fieldset menu dir".split())
BLOCK = APART | frozenset(
    "html body div section article aside header footer nav main address li dt dd form details summary dialog center legend figcaption hgroup search "
    "option optgroup caption tr".split()
)
LISTS = frozenset("ul ol menu dir".split())
CLOSES_P = (BLOCK - frozenset("html body option optgroup caption tr legend".split())) | {"xmp"}
# an opening tag ends open elements of these kinds, unless one of the fences stands between
ENDS = {
    "li": (frozenset({"li"}), LISTS),
    "dt": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "dd": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "option": (frozenset({"option"}), frozenset({"select", "datalist", "optgroup"})),
    "optgroup": (frozenset({"option", "optgroup"}), frozenset({"select"})),
    "td": (frozenset({"td", "th"}), frozenset({"tr", "table"})),
    "th": (frozenset({"td", "th"}), frozenset({"tr", "table"})),
    "tr": (frozenset({"td", "th", "tr", "caption", "colgroup"}), frozenset({"table"})),
    "thead": (frozenset({"td", "th", "tr", "thead", "tbody", "tfoot", "caption", "colgroup"}), frozenset({"table"})),
    "rt": (frozenset({"rt", "rp"}), frozenset({"ruby"})),
    "rp": (frozenset({"rt", "rp"}), frozenset({"ruby"})),
}
ENDS["tbody"] = ENDS["tfoot"] = ENDS["colgroup"] = ENDS["caption"] = ENDS["thead"]
# an end tag does not reach beyond these
FENCES = frozenset("table td th caption template button".split())

TAG = re.compile(
    r"""<!--(?:.*?--!?>|.*\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*>""", re.S
)
ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
# style sheets: comments, what ends a part of a sheet (strings do not), selectors without combinators
COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)|<!--|-->", re.S)
MARK = re.compile(r""""(?:\\.|[^"\\\n])*+"?|'(?:\\.|[^'\\\n])*+'?|\\.|[{};]""", re.S)
COMMA = re.compile(r",(?![^()]*\))")
COMPOUND = re.compile(r"(?:\*|[a-zA-Z][\w-]*)?(?:[.#](?:[\w-]|\\.)+)*")
NAME = re.compile(r"[.#]?(?:[\w-]|\\.)+")
DECLARED = re.compile(r"(display|visibility)\s*:\s*([a-z-]+)(?:\s+[a-z-]+)*\s*(!\s*important)?\s*", re.I)
WITHIN = re.compile(r"\(\s*(min-|max-)?(width|height)\s*:\s*([\d.]+)(px|r?em)?\s*\)")
BETWEEN = re.compile(r"\(\s*(?:([\d.]+)(px|r?em)?\s*([<>]=?)\s*)?(width|height)\s*(?:([<>]=?)\s*([\d.]+)(px|r?em)?\s*)?\)")
VALUES = {
    "display": frozenset(
        "none block inline inline-block flex inline-flex grid inline-grid flow flow-root contents list-item ruby run-in math table inline-table table-row "
        "table-cell table-caption table-column table-column-group table-row-group table-header-group table-footer-group initial inherit unset -webkit-box".split()
    ),
    "visibility": frozenset("visible hidden collapse initial inherit unset".split()),
}
# The screen that pages are read on, in CSS pixels, and what media queries ask of it
SCREEN = {"width": 1280.0, "height": 800.0}
MEDIA = {"screen": True, "all": True} | dict.fromkeys(
    "(orientation:landscape) (prefers-color-scheme:light) (prefers-reduced-motion:no-preference) (hover:hover) (any-hover:hover) (hover) (pointer:fine) "
    "(any-pointer:fine) (scripting:none) (color) (width) (height)".split(), True
) | dict.fromkeys(
    "(orientation:portrait) (prefers-color-scheme:dark) (prefers-reduced-motion:reduce) (prefers-reduced-motion) (hover:none) (any-hover:none) "
    "(pointer:coarse) (pointer:none) (scripting:enabled) (monochrome)".split(), False
)
SPACE = re.compile(r"[ \t\n\r\f\v]+")


class Element:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: dict[str, str]):
        self.tag, self.attributes, self.children = tag, attributes, []


def _attributes(raw: str) -> dict[str, str]:
    if not raw or raw.isspace():
        return {}
    out: dict[str, str] = {}
    for name, a, b, c in ATTRIBUTE.findall(raw):
        out.setdefault(name.lower(), unescape(a or b or c))
    return out


def tree(html: str) -> Element:
    """The elements and texts of a page; strings are texts with their entities resolved."""
    root = Element("#root", {})
    path = [root]
    at, size = 0, len(html)
    while at < size:
        match = TAG.search(html, at)
        if match is None:
            path[-1].children.append(unescape(html[at:]))
            break
        if match.start() > at:
            path[-1].children.append(unescape(html[at : match.start()]))
        at = match.end()
        tag = match[2] or match[5]
        if tag is None:
            continue
        tag = tag.lower()
        if match[1] or match[4]:
            _end(path, tag)
            continue
        attributes = _attributes(match[3] if match[2] else match[6])
        _make_room(path, tag)
        element = Element(tag, attributes)
        path[-1].children.append(element)
        if tag in VOID:
            continue
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(html, at)
            stop = close.start() if close else size
            text = html[at:stop]
            element.children.append(unescape(text) if tag in ("textarea", "title") else text)
            at = close.end() if close else size
            continue
        path.append(element)
    return root


def _make_room(path: list[Element], tag: str) -> None:
    if tag in CLOSES_P:
        _end_kinds(path, frozenset({"p"}), FENCES)
    if tag in ENDS:
        kinds, fences = ENDS[tag]
        while _end_kinds(path, kinds, fences):
            pass


def _end_kinds(path: list[Element], kinds: frozenset, fences: frozenset) -> bool:
    for i in range(len(path) - 1, 0, -1):
        if path[i].tag in kinds:
            del path[i:]
            return True
        if path[i].tag in fences:
            return False
    return False


def _end(path: list[Element], tag: str) -> None:
    if tag == "br":
        path[-1].children.append(Element("br", {}))
        return
    fences = FENCES if tag not in FENCES and tag not in ("tr", "tbody", "thead", "tfoot") else frozenset({"table"})
    for i in range(len(path) - 1, 0, -1):
        if path[i].tag == tag:
            if tag not in ("html", "body"):  # what follows them still belongs to the page
                del path[i:]
            return
        if path[i].tag in fences:
            return


# ---- what shows ----------------------------------------------------------------------------------------------------------


def _pixels(number: str, unit: str | None) -> float:
    try:
        return float(number) * (16 if unit in ("em", "rem") else 1)
    except ValueError:
        return float("nan")


def _holds(part: str) -> bool | None:
    """Whether a media type or feature holds on the screen; None: not known."""
    if (known := MEDIA.get(SPACE.sub("", part))) is not None:
        return known
    if m := WITHIN.fullmatch(part):
        have, asked = SCREEN[m[2]], _pixels(m[3], m[4])
        return have >= asked if m[1] == "min-" else have <= asked if m[1] else have == asked
    if m := BETWEEN.fullmatch(part):
        less = {"<": float.__lt__, "<=": float.__le__, ">": float.__gt__, ">=": float.__ge__}
        have = SCREEN[m[4]]
        return (not m[3] or less[m[3]](_pixels(m[1], m[2]), have)) and (not m[5] or less[m[5]](have, _pixels(m[6], m[7])))
    return False if re.fullmatch(r"[a-z-]+", part) else None


def on_screen(media: str) -> bool:
    """Whether a list of media queries applies to the screen. A query that asks what is not known does not apply."""
    if not media.strip():
        return True
    for one in COMMENT.sub(" ", media).lower().split(","):
        words = re.sub(r"^\s*only\s", "", one).strip()
        refused = re.match(r"not\s", words)
        found = [_holds(part.strip()) for part in re.split(r"\sand(?=[\s(])|(?<=\))and(?=[\s(])", words[refused.end() :] if refused else words)]
        if None not in found and all(found) != bool(refused):
            return True
    return False


def _applies(rule: str) -> bool:
    """Whether the rules in the block of an at-rule apply."""
    name, _, condition = rule[1:].replace("(", " (", 1).partition(" ")
    name = name.strip().lower()
    if name == "media":
        return on_screen(condition)
    return name == "layer" or (name == "supports" and not condition.strip().lower().startswith("not"))


def _rules(css: str):
    """(selectors, declarations) of each style rule that applies, in order. Rules nested in a style rule are left out."""
    css = COMMENT.sub(" ", css)
    opened: list = []  # True: rules that apply, False: what is skipped, a list: the declarations of a rule
    begin = 0
    for mark in MARK.finditer(css):
        if mark[0] not in ("{", "}", ";"):
            continue
        text, inside = css[begin : mark.start()].strip(), opened[-1] if opened else True
        if mark[0] == ";" and inside is True and not text.startswith("@"):
            continue
        begin = mark.end()
        if mark[0] == "{":
            if inside is True:
                opened.append(_applies(SPACE.sub(" ", text)) if text.startswith("@") else [text])
            else:
                opened.append(False)
            continue
        if isinstance(inside, list):
            inside.append(text)
        if mark[0] == "}" and opened:
            opened.pop()
            if isinstance(inside, list):
                yield inside[0], inside[1:]
    for rule in opened:  # the end of a sheet closes what is open
        if isinstance(rule, list):
            yield rule[0], [*rule[1:], *([css[begin:].strip()] if rule is opened[-1] else [])]


def _declared(parts: list[str]) -> dict[str, tuple[bool, str]]:
    """display and visibility as (important, value)."""
    out: dict[str, tuple[bool, str]] = {}
    for part in parts:
        m = DECLARED.fullmatch(part.strip())
        if m and m[2].lower() in VALUES[m[1].lower()]:
            name, found = m[1].lower(), (bool(m[3]), m[2].lower())
            if found[0] or not out.get(name, found)[0]:
                out[name] = found
    return out


class Styles:
    """What the style sheets of a page, in order, and style attributes declare of an element.

    Selectors of tags, classes and ids without combinators count; important, style attribute, specificity and order decide.
    """

    def __init__(self, root: Element):
        self.rules: dict[str, list[tuple]] = {}
        self.known: dict[tuple, dict[str, tuple]] = {}
        number, todo = 0, [root]
        while todo:
            element = todo.pop()
            a = element.attributes
            if element.tag == "style" and element.children and on_screen(a.get("media", "")) and a.get("type", "").strip().lower() in ("", "text/css"):
                for selectors, body in _rules("".join(c for c in element.children if isinstance(c, str))):
                    declared = _declared(body)
                    for selector in map(str.strip, COMMA.split(selectors) if declared else ()):
                        if selector and COMPOUND.fullmatch(selector):
                            self._add(selector, declared, number)
                            number += 1
            if element.tag != "template":
                todo += [c for c in reversed(element.children) if not isinstance(c, str)]

    def _add(self, selector: str, declared: dict, number: int) -> None:
        names = [re.sub(r"\\(.)", r"\1", n if n[0] in ".#" else n.lower()) for n in NAME.findall(selector)]
        weight = (sum(n[0] == "#" for n in names), sum(n[0] == "." for n in names), sum(n[0] not in ".#" for n in names))
        found = {name: ((important, False, weight, number), value) for name, (important, value) in declared.items()}
        self.rules.setdefault(min(names, default="*"), []).append((frozenset(names), found))

    def of(self, element: Element) -> dict[str, str]:
        """The values of display and visibility that are declared."""
        a = element.attributes
        won: dict[str, tuple] = {}
        if self.rules:
            key = (element.tag, a.get("class"), a.get("id"))
            if key not in self.known:
                names = _names(element)
                for name in (*names, "*"):
                    for wanted, found in self.rules.get(name, ()):
                        if wanted <= names:
                            for what, one in found.items():
                                won[what] = max(won.get(what, one), one)
                self.known[key] = won
            won = dict(self.known[key])
        if "style" in a:
            for what, (important, value) in _declared(COMMENT.sub(" ", a["style"]).split(";")).items():
                one = ((important, True, (0, 0, 0), 0), value)
                won[what] = max(won.get(what, one), one)
        return {what: value for what, (_, value) in won.items()}


def _names(element: Element) -> set[str]:
    own = {element.tag}
    if "class" in element.attributes:
        own |= {f".{c}" for c in element.attributes["class"].split()}
    if "id" in element.attributes:
        own.add(f"#{element.attributes['id']}")
    return own


def _shown(element: Element, display: str | None) -> bool:
    """``display``: what is declared of the element, which goes before the attribute ``hidden``."""
    a = element.attributes
    if element.tag in HIDDEN:
        return False
    if display:
        return display != "none"
    return not ("hidden" in a and a["hidden"].lower() != "until-found") and (element.tag != "dialog" or "open" in a)


# ---- layout ------------------------------------------------------------------------------------------------------------------


class Page:
    """Lines of one flow (the page, or a table cell)."""

    def __init__(self):
        self.lines: list[str] = []
        self.line: list[str] = []
        self.gap = 0  # 1: a new line is due, 2: an empty line is due
        self.space = False
        self.indent = ""
        self.bullet = ""

    def text(self, text: str) -> None:
        words = SPACE.sub(" ", text)
        if not words:
            return
        if words == " ":
            self.space = True
            return
        if words[0] == " ":
            self.space, words = True, words[1:]
        trailing = words[-1] == " "
        self._begin()
        self.line.append((" " if self.space and self.line and not self.line[-1].endswith(("\n", " ")) else "") + (words[:-1] if trailing else words))
        self.space = trailing

    def raw(self, text: str) -> None:
        """Preformatted text."""
        parts = text.split("\n")
        for i, part in enumerate(parts):
            if i:
                self._begin()
                self.break_line()
            if part:
                self._begin()
                self.line.append(part)

    def _begin(self) -> None:
        self.flush()
        if not self.line:
            self.space = False
            self.line.append((self.indent[: -len(self.bullet)] + self.bullet) if self.bullet else self.indent)
            self.bullet = ""

    def flush(self) -> None:
        """Does the due line ends."""
        if not self.gap:
            return
        if self.line:
            self.break_line()
        if self.gap == 2 and self.lines and self.lines[-1]:
            self.lines.append("")
        self.gap = 0

    def break_line(self) -> None:
        self.lines.append("".join(self.line).rstrip(" \t"))
        self.line, self.space = [], False

    def br(self) -> None:
        self.flush()
        self.break_line()

    def apart(self, gap: int) -> None:
        self.gap = max(self.gap, gap)

    def table(self, rows: list[str]) -> None:
        self.flush()
        if self.line:
            self.break_line()
        for row in rows:
            self._begin()
            self.line.append(row)
            self.break_line()

    def done(self) -> list[str]:
        if self.line:
            self.break_line()
        lines = [x if x.strip() else "" for x in self.lines]
        while lines and not lines[0]:
            lines.pop(0)
        while lines and not lines[-1]:
            lines.pop()
        return lines


def _width(text: str) -> int:
    return len(text) if text.isascii() else sum(2 if east_asian_width(c) in "WF" else 1 for c in text)


def _span(element: Element, name: str, most: int) -> int:
    value = element.attributes.get(name, "1").strip()
    return min(max(int(value), 1), most) if value.isascii() and value.isdigit() and len(value) < 9 else 1


def table_lines(rows: list[list[tuple[list[str], int, int]]], align: int = ALIGN) -> list[str]:
    """Rows of cells (lines, column span, row span) as lines with aligned columns."""
    grid: list[dict[int, list[str]]] = []
    taken: dict[int, int] = {}  # column -> rows that a cell above still covers
    for row in rows:
        placed, column = {}, 0
        covered = {c: n for c, n in taken.items() if n > 0}
        taken = {c: n - 1 for c, n in covered.items()}
        for lines, across, down in row:
            while covered.get(column):
                column += 1
            placed[column] = lines
            if down > 1:
                taken.update({column + j: down - 1 for j in range(across)})
            column += across
        grid.append(placed)
    used = sorted({c for row in grid for c, lines in row.items() if lines})
    widths = {c: max((w for row in grid for line in row.get(c, ()) if (w := _width(line)) <= align), default=0) for c in used}
    out = []
    for row in grid:
        height = max((len(lines) for lines in row.values()), default=0)
        for i in range(height):
            cells = [(row[c][i] if c in row and i < len(row[c]) else "") for c in used]
            out.append("  ".join(cell + " " * max(0, widths[c] - _width(cell)) for c, cell in zip(used, cells)).rstrip())
    return out


class _Table:
    def __init__(self):
        self.rows: list[list] = []
        self.caption: list[str] = []


def render(root: Element) -> str:
    styles = Styles(root)
    flows, tables, lists = [Page()], [], []
    # (element, next child, visible, preformatted, what to do at the end)
    stack: list[list] = [[root, 0, True, False, None]]
    while stack:
        top = stack[-1]
        element, at, visible, pre, after = top
        page = flows[-1]
        if at == len(element.children):
            stack.pop()
            if after:
                after()
            continue
        top[1] += 1
        child = element.children[at]
        closed = element.tag == "details" and "open" not in element.attributes
        if isinstance(child, str):
            if visible and not closed and (not tables or tables[-1][1] != len(flows) or child.strip()):
                page.raw(child.removeprefix("\n") if at == 0 and element.tag == "pre" else child) if pre else page.text(child)
            continue
        style = styles.of(child)
        if not _shown(child, style.get("display")):
            continue
        tag = child.tag
        if closed and tag != "summary":
            continue
        own = style.get("visibility", "inherit")
        seen = visible if own in ("inherit", "unset") else own in ("visible", "initial")
        if tag == "br":
            if seen:
                page.br()
            continue
        if tag == "input":
            if seen and child.attributes.get("type", "").lower() in ("submit", "button", "reset") and child.attributes.get("value"):
                page.text(child.attributes["value"])
            continue
        stack.append([child, 0, seen, pre or tag in ("pre", "textarea", "xmp"), _enter(child, element, flows, tables, lists)])
    return "\n".join(flows[0].done())


def _enter(child: Element, parent: Element, flows: list[Page], tables: list, lists: list):
    """Begins an element's layout; returns what ends it."""
    page, tag = flows[-1], child.tag
    gap = 2 if tag in APART else 1 if tag in BLOCK else 0
    if tag in LISTS and lists and lists[-1][0] is page:
        gap = 1  # a list within a list
    if tag == "table":
        page.apart(2)
        tables.append((_Table(), len(flows)))

        def end_table():
            found, _ = tables.pop()
            page.table(found.caption + table_lines(found.rows))
            page.apart(2)

        return end_table
    if tables and tables[-1][1] == len(flows):
        found = tables[-1][0]
        if tag == "tr":
            found.rows.append([])
            return None
        if tag in ("td", "th", "caption"):
            own = Page()
            flows.append(own)

            def end_cell():
                flows.pop()
                lines = own.done()
                if tag == "caption":
                    found.caption += lines
                else:
                    if not found.rows:
                        found.rows.append([])
                    found.rows[-1].append((lines, _span(child, "colspan", 1000), _span(child, "rowspan", 65534)))

            return end_cell
    page.apart(gap)
    before = page.indent
    if tag in LISTS:
        start = child.attributes.get("start", "").strip()
        step = -1 if "reversed" in child.attributes else 1
        first = int(start) if re.fullmatch(r"-?\d{1,9}", start) else (sum(1 for c in child.children if not isinstance(c, str) and c.tag == "li") if step < 0 else 1)
        lists.append([page, first if tag == "ol" else None, step])
    elif tag == "li":
        own = lists[-1] if lists and lists[-1][0] is page else [page, None, 1]
        value = child.attributes.get("value", "").strip()
        if own[1] is not None and re.fullmatch(r"-?\d{1,9}", value):
            own[1] = int(value)
        page.flush()
        page.bullet = "- " if own[1] is None else f"{own[1]}. "
        page.indent = before + " " * len(page.bullet)
        if own[1] is not None:
            own[1] += own[2]
    elif tag in ("dd", "blockquote"):
        page.flush()
        page.indent = before + "  "

    def end():
        if tag in LISTS:
            lists.pop()
        if tag == "li" and page.bullet:  # an item without text
            page.bullet = ""
        page.apart(gap)
        if page.indent != before:
            page.flush()
            page.indent = before

    return end if gap or tag in LISTS or page.indent != before else None


def visible_text(html: str | None) -> str:
    """The visible text of a page; a missing or empty page has none."""
    return render(tree(html)) if html else ""


def extract_text(pages: DataFrame, *, page_id: str = "page_id", html: str = "html") -> DataFrame:
    """One row per page row: ``page_id``, text, n_chars. Missing pages give an empty text; repeated rows repeat."""
    kind = pages.schema[page_id].dataType.simpleString()

    def run(batches):
        for batch in batches:
            texts = [visible_text(x.as_py()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[page_id, "text", "n_chars"]
            )

    return pages.select(page_id, html).mapInArrow(run, f"`{page_id}` {kind}, text string, n_chars long")
