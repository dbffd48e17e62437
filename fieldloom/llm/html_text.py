"""Visible text of HTML pages, laid out as a page would be.

A tree builder reads tags, supplies the end tags that HTML leaves out and ignores those that fit nothing; it gives balanced events, so
nesting of any depth needs no recursion. A renderer drops what is not visible (scripts, the head, `hidden`, `display: none` and
`visibility: hidden` of the element or of the rule in a style sheet that wins, closed details, ...) and lays out the rest: blocks on lines
of their own, paragraphs, headings, lists and tables set off by an empty line, list items with their marks and hanging indents,
preformatted text as it is, table cells in columns that are aligned, spans included.

Defined cases: null html gives null text, empty html the empty text; unclosed tags, comments and quotes end where the page ends; all
options of a choice are shown; list numbers may be zero, below it, letters or Roman, and count down; columns are padded to at most WIDEST, longer cells push the rest of their own line on, so the text
grows with the page and nothing is cut. Repeated rows give the same text. Other columns are kept, one named like the output is
replaced. An empty table gives an empty one.
"""

from __future__ import annotations

import html as entities
import re
import unicodedata
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import with_columns

WIDEST = 80

# Fixed values of the HTML standard: elements without content, with raw text, of blocks, without visible content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr legend li listing main menu nav ol optgroup option p pre search section summary table ul xmp".split())
SPACED = frozenset("blockquote dl figure h1 h2 h3 h4 h5 h6 hr listing menu ol p pre table ul xmp".split())
CLOSES_P = (BLOCK - {"body", "legend", "optgroup", "option"}) | {"plaintext"}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
UNSEEN = frozenset("head script style title template noscript iframe object audio video canvas noembed noframes datalist col colgroup area map param rp".split())
IN_HEAD = frozenset("base link meta script style title template noscript head html".split())
TABLE_PARTS = frozenset("caption colgroup tbody thead tfoot tr td th".split())
#: Looking for an open element ends here, unless the tag is a part of a table itself.
BORDER = frozenset("table td th caption html template button object".split())

TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:-->|--!>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<([a-zA-Z][^\s/>]*)((?:[^>\"'=]|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+|[\"'])*+)(?:>|\Z)",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(\"[^\"]*\"?|'[^']*'?|[^\s>]+))?")
SPACE = re.compile(r"[ \t\n\r\f]+")

# Drawings and formulas have parts that are not shown, and end where these tags of a page begin.
FOREIGN = frozenset({"svg", "math"})
UNSHOWN = frozenset("defs desc metadata symbol marker clippath mask pattern lineargradient radialgradient filter annotation annotation-xml mphantom".split())
BREAKS_OUT = frozenset("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split())
HTML_INSIDE = frozenset("foreignobject desc title annotation-xml mi mo mn ms mtext".split())
#: A tag that closes itself, which holds in drawings and formulas; at the end of a value without quotes the slash belongs to it.
CLOSED = re.compile(r"(?<!=)(?:^|[\s\"'])/\Z|\A[^=]*/\Z|\s[^\s=\"']+/\Z")

# Style sheets: the screen that conditions are tried on, and the values of the properties that count here.
SCREEN = {"width": 1280.0, "height": 800.0, "orientation": "landscape", "prefers-color-scheme": "light", "prefers-reduced-motion": "no-preference", "hover": "hover", "any-hover": "hover", "pointer": "fine", "any-pointer": "fine", "scripting": "none"}
COMMON = "inherit initial unset revert revert-layer"
VALUES = {
    "display": frozenset(f"{COMMON} none contents block inline inline-block flow-root flex inline-flex grid inline-grid list-item run-in table inline-table table-row table-cell table-caption table-column table-column-group table-row-group table-header-group table-footer-group ruby ruby-base ruby-text -webkit-box -webkit-flex -webkit-inline-box -ms-flexbox -ms-grid math".split()),
    "visibility": frozenset(f"{COMMON} visible hidden collapse".split()),
    "white-space": frozenset(f"{COMMON} normal nowrap pre pre-wrap pre-line break-spaces".split()),
}
#: Values of `display` that make no block of an element, and what white space values keep: all, line ends, or nothing.
IN_LINE = frozenset("inline inline-block inline-flex inline-grid inline-table -webkit-inline-box contents run-in ruby ruby-base ruby-text math initial unset".split())
KEEPS = {"pre": "all", "pre-wrap": "all", "break-spaces": "all", "pre-line": "lines", "normal": "", "nowrap": "", "initial": ""}
CONTROLS = frozenset("button select meter progress".split())
COMMENT, CSS = re.compile(r"/\*.*?(?:\*/|\Z)", re.DOTALL), re.compile(r"\"(?:[^\"\\\n]|\\.)*+\"?|'(?:[^'\\\n]|\\.)*+'?|\\.|[{};]", re.DOTALL)
DECLARED = re.compile(r"\s*(display|visibility|white-space)\s*:\s*([a-z-]+)(?:\s+[a-z-]+)?\s*(!\s*important)?\s*", re.I)
_IDENT = r"(?:[\w-]|[^\x00-\x7f]|\\[0-9a-fA-F]{1,6}\s?|\\.)++"
SIMPLE = re.compile(rf"(\*)|([#.]?)({_IDENT})|\[\s*([\w-]+)\s*(?:([~|^$*]?=)\s*(\"[^\"]*\"|'[^']*'|[^\]\s]+)\s*[is]?\s*)?\]", re.I)
COMBINED = re.compile(r"\s*(>)\s*|\s+")
FEATURE = re.compile(r"(min-|max-)?([a-z-]+)\s*(?:(:|>=|<=|>|<|=)\s*(.+))?")
LENGTH = re.compile(r"([0-9.]+)\s*(px|em|rem|)")


def _name(written: str) -> str:
    """A name of a style sheet without its escapes."""
    return re.sub(r"\\(?:([0-9a-fA-F]{1,6})\s?|(.))", lambda m: m[2] or (chr(int(m[1], 16)) if int(m[1], 16) < 0x110000 else ""), written) if "\\" in written else written


def _feature(text: str) -> bool:
    """Whether the screen has a feature, as in `min-width: 600px` or `width >= 600px`; false for what is not known."""
    m = FEATURE.fullmatch(text.strip())
    if not m or m[2] not in SCREEN:
        return False
    have = SCREEN[m[2]]
    if m[3] is None:
        return have != "none"
    if isinstance(have, str):
        return m[3] == ":" and have == m[4].strip()
    size = LENGTH.fullmatch(m[4].strip())
    if not size or size[1].count(".") > 1 or size[1] == ".":
        return False
    want = float(size[1]) * (16 if size[2] in ("em", "rem") else 1)
    sign = ">=" if m[1] == "min-" else "<=" if m[1] == "max-" else m[3]
    return {">=": have >= want, "<=": have <= want, ">": have > want, "<": have < want}.get(sign, have == want)


def on_screen(media: str) -> bool:
    """Whether a list of media queries holds for the screen."""
    if not media.strip():
        return True
    for query in media.lower().split(","):
        words = re.findall(r"\([^()]*\)|[^\s()]+", query)
        turned = words[:1] == ["not"]
        words = words[1:] if words[:1] in (["not"], ["only"]) else words
        either = [[]]
        for w in words:
            if w == "or":
                either.append([])
            elif w != "and":
                either[-1].append(_feature(w[1:-1]) if w[0] == "(" else w in ("screen", "all"))
        if bool(words) and any(map(all, either)) != turned:
            return True
    return False


def declared(text: str) -> tuple[str, str, bool] | None:
    """(property, value, whether it is important) of a declaration that counts here."""
    m = DECLARED.fullmatch(text)
    return (m[1].lower(), m[2].lower(), bool(m[3])) if m and m[2].lower() in VALUES[m[1].lower()] else None


def selector(text: str) -> tuple[tuple[int, int, int], list[tuple[str, list[tuple]]]] | None:
    """(specificity, parts) of a selector; a part is what stands before it (`>` or nothing for any depth) and its conditions. None for
    selectors with what is not read here."""
    text, at, before = text.strip(), 0, ""
    parts: list[tuple[str, list[tuple]]] = [("", [])]
    ids = names = tags = 0
    if not text:
        return None
    while at < len(text):
        if m := SIMPLE.match(text, at):
            if m[1]:
                parts[-1][1].append(("*", "", "", ""))
            elif m[4]:
                value = m[6] or ""
                parts[-1][1].append(("[", m[4].lower(), m[5] or "", _name(value[1:-1] if value[:1] in ("'", '"') else value)))
                names += 1
            elif m[2]:
                parts[-1][1].append((m[2], _name(m[3]), "", ""))
                ids, names = ids + (m[2] == "#"), names + (m[2] == ".")
            elif parts[-1][1]:
                return None
            else:
                parts[-1][1].append(("", m[3].lower(), "", ""))
                tags += 1
        elif (m := COMBINED.match(text, at)) and parts[-1][1]:
            before = m[1] or ""
            parts.append((before, []))
        else:
            return None
        at = m.end()
    return ((ids, names, tags), parts) if parts[-1][1] else None


def _meets(condition: tuple, tag: str, a: dict[str, str], classes: list[str]) -> bool:
    kind, name, sign, value = condition
    if kind == "*":
        return True
    if kind != "[":
        return tag == name if not kind else name in classes if kind == "." else a.get("id") == name
    have = a.get(name)
    if have is None or not sign:
        return have is not None
    if sign == "=":
        return have == value
    if sign == "|=":
        return have == value or have.startswith(value + "-")
    if not value:
        return False
    return value in have.split() if sign == "~=" else have.startswith(value) if sign == "^=" else have.endswith(value) if sign == "$=" else value in have


class Styles:
    """Rules on `display`, `visibility` and `white-space`. Each part of a selector has a bit; an element's bits say which parts it, with what is around
    it, meets, so an element costs the same at any depth."""

    def __init__(self) -> None:
        self.parts: dict[tuple[str, str], list[tuple[int, int, str, list[tuple]]]] = {}  # by one condition: bit, the bit before, how, conditions
        self.ends: dict[int, list[tuple]] = {}  # by a selector's last bit: property, weight, value
        self.bits = self.rules = 0

    def __bool__(self) -> bool:
        return bool(self.ends)

    def add(self, written: str, found: list[tuple[str, str, bool]]) -> None:
        for text in written.split(","):
            if read := selector(text):
                last = 0
                for how, conditions in read[1]:
                    bit, self.bits = 1 << self.bits, self.bits + 1
                    key = next((c for k in ("#", ".", "") for c in conditions if c[0] == k), ("*", "", "", ""))
                    self.parts.setdefault(key[:2], []).append((bit, last, how, conditions))
                    last = bit
                self.ends[last] = [(prop, (important, False, read[0], self.rules + i), value) for i, (prop, value, important) in enumerate(found)]
        self.rules += len(found)

    def read(self, css: str) -> None:
        css = COMMENT.sub(" ", css).replace("<!--", " ").replace("-->", " ")
        blocks: list[tuple[bool, str, list]] = []  # of open blocks: whether it applies, its selectors, its declarations
        start = 0

        def note(end: int) -> None:
            if blocks and blocks[-1][0] and blocks[-1][1] and (d := declared(css[start:end])):
                blocks[-1][2].append(d)

        def done() -> None:
            _, selectors, found = blocks.pop()
            if found:
                self.add(selectors, found)

        for m in CSS.finditer(css):
            if m[0] == "{":
                head = css[start : m.start()].strip()
                live, outer = (blocks[-1][0], blocks[-1][1]) if blocks else (True, "")
                if head.startswith("@"):
                    name, _, rest = head[1:].replace("(", " (", 1).partition(" ")
                    name = name.lower()
                    ok = on_screen(rest) if name == "media" else name == "layer" or (name == "supports" and not rest.strip().lower().startswith("not"))
                    blocks.append((live and ok, outer, []))
                else:
                    blocks.append((live and not outer, head, []))
            elif m[0] == "}":
                note(m.start())
                if blocks:
                    done()
            elif m[0] == ";":
                note(m.start())
            else:
                continue
            start = m.end()
        note(len(css))
        while blocks:
            done()

    def meets(self, tag: str, a: dict[str, str], around: tuple[int, int]) -> tuple[int, int]:
        """(bits met by the element or one around it, bits met by the element); `around`: those of its parent."""
        classes, own = a.get("class", "").split(), 0
        keys = [("*", ""), ("", tag), ("#", a.get("id", "")), *((".", c) for c in dict.fromkeys(classes))]
        for key in keys:
            for bit, last, how, conditions in self.parts.get(key, ()):
                if (not last or last & around[1 if how else 0]) and all(_meets(c, tag, a, classes) for c in conditions):
                    own |= bit
        return around[0] | own, own

    def won(self, own: int, style: str) -> dict[str, str]:
        """The values of the properties by the rules that an element meets and its own style."""
        best: dict[str, tuple] = {}
        found = []
        while own:
            bit = own & -own
            own ^= bit
            found += self.ends.get(bit, ())
        for i, d in enumerate(map(declared, style.split(";")) if style else ()):
            if d:
                found.append((d[0], (d[2], True, (0, 0, 0), i), d[1]))
        for prop, weight, value in found:
            if prop not in best or weight > best[prop][0]:
                best[prop] = (weight, value)
        return {p: v for p, (_, v) in best.items()}


def attributes(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(text):
        value = m[2] or ""
        if value[:1] in ("'", '"'):
            value = value[1:-1] if len(value) > 1 and value[-1] == value[0] else value[1:]
        out.setdefault(m[1].lower(), entities.unescape(value))
    return out


class Tree:
    """Balanced events of a page: ("open", tag, attributes as written), ("text", text), ("close", tag)."""

    def __init__(self) -> None:
        self.open: list[str] = []
        self.count: Counter[str] = Counter()  # of open elements by tag
        self.out: list[tuple] = []
        self.styles = Styles()

    def _pop(self, depth: int) -> None:
        while len(self.open) > depth:
            tag = self.open.pop()
            self.count[tag] -= 1
            self.out.append(("close", tag))

    def _push(self, tag: str) -> None:
        self.open.append(tag)
        self.count[tag] += 1

    def _find(self, tags: frozenset | set, borders: frozenset) -> int:
        if not any(self.count[t] for t in tags):
            return -1
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i] in tags:
                return i
            if self.open[i] in borders:
                break
        return -1

    def _close_open(self, tags: frozenset | set, borders: frozenset) -> None:
        at = self._find(tags, borders)
        if at >= 0:
            self._pop(at)

    def start(self, tag: str, written: str) -> None:
        if self.count["head"] and tag not in IN_HEAD:
            self._close_open({"head"}, frozenset())
        if tag in BREAKS_OUT:
            self._close_open(FOREIGN, HTML_INSIDE)
        if tag in ("html", "body", "head") and self.count[tag]:
            return
        if tag in CLOSES_P:
            self._close_open({"p"}, BORDER)
        if tag == "li":
            self._close_open({"li"}, BORDER | {"ul", "ol", "menu", "dir"})
        elif tag in ("dt", "dd"):
            self._close_open({"dt", "dd"}, BORDER | {"dl"})
        elif tag in HEADINGS and self.open and self.open[-1] in HEADINGS:
            self._pop(len(self.open) - 1)
        elif tag in ("option", "optgroup"):
            self._close_open({"option"} if tag == "option" else {"option", "optgroup"}, BORDER | {"select"})
        elif tag in ("td", "th"):
            self._close_open({"td", "th", "caption"}, frozenset({"table"}))
            if self._find({"tr"}, frozenset({"table"})) < 0 and self.count["table"]:
                self.out.append(("open", "tr", ""))
                self._push("tr")
        elif tag == "tr":
            self._close_open({"tr"}, frozenset({"table"}))
            self._close_open({"caption"}, frozenset({"table"}))
        elif tag in ("tbody", "thead", "tfoot", "caption", "colgroup"):
            self._close_open({"tbody", "thead", "tfoot"}, frozenset({"table"}))
            self._close_open({"tr"}, frozenset({"table"}))
            self._close_open({"caption", "colgroup"}, frozenset({"table"}))
        elif tag in ("rt", "rp"):
            self._close_open({"rt", "rp"}, BORDER | {"ruby"})
        if tag in TABLE_PARTS and not self.count["table"]:
            return  # a part of a table outside of one has no box
        self.out.append(("open", tag, written))
        if tag in VOID or ((self.count["svg"] or self.count["math"] or tag in FOREIGN) and written.endswith("/") and CLOSED.search(written)):
            self.out.append(("close", tag))
        else:
            self._push(tag)

    def end(self, tag: str) -> None:
        if tag == "br":
            self.start("br", "")
        elif tag in HEADINGS:
            at = self._find(HEADINGS, BORDER)
            if at >= 0:
                self._pop(at)
        elif tag in ("body", "html"):
            pass  # what follows still belongs to the body
        elif tag not in VOID:
            at = self._find({tag}, frozenset({"table"}) - {tag} if tag in TABLE_PARTS else frozenset() if tag == "table" else BORDER - {tag})
            if at >= 0:
                self._pop(at)
            elif tag == "p":
                self.start("p", "")
                self._pop(len(self.open) - 1)

    def text(self, text: str) -> None:
        if self.count["head"] and text.strip():
            self._close_open({"head"}, frozenset())
        self.out.append(("text", text))

    def read(self, page: str) -> list[tuple]:
        at, n = 0, len(page)
        while at < n:
            m = TOKEN.search(page, at)
            if m is None:
                self.text(entities.unescape(page[at:]))
                break
            if m.start() > at:
                self.text(entities.unescape(page[at : m.start()]))
            at = m.end()
            if m[2]:
                tag = m[2].lower()
                self.start(tag, m[3])
                if tag in RAW and self.open and self.open[-1] == tag:
                    stop = re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
                    body, at = page[at : stop.start() if stop else n], stop.end() if stop else n
                    if tag == "style" and on_screen(attributes(m[3]).get("media", "")):
                        self.styles.read(body)
                    self.out.append(("text", entities.unescape(body) if tag in ("textarea", "title") else body))
                    self._pop(len(self.open) - 1)
            elif m[1]:
                self.end(m[1].lower())
            elif m[0].startswith("<![CDATA["):
                self.text(m[0][9:].removesuffix("]]>"))
        self._pop(0)
        return self.out


class Flow:
    """Lines of one block context: the page or a table cell."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line: list[str] = []
        self.gap = 0
        self.prefix: list[str] = []
        self.mark: tuple[int, str] | None = None  # goes before the next line, in place of the prefix at that depth
        self.space = True  # the line ends in white space, or is empty

    def add(self, text: str) -> None:
        text = SPACE.sub(" ", text)
        if self.space:
            text = text.lstrip(" ")
        if text:
            self.line.append(text)
            self.space = text[-1] == " "

    def put(self, line: str) -> None:
        """A finished line, white space kept."""
        prefix = list(self.prefix)
        if self.mark is not None:
            prefix[self.mark[0]], self.mark = self.mark[1], None
        if self.gap > 1 and self.lines and line:
            self.lines.append("")
        self.gap = 1
        self.lines.append(("".join(prefix) + line).rstrip(" "))

    def flush(self) -> None:
        if self.line:
            text = "".join(self.line).rstrip(" ")
            self.line = []
            if text:
                self.put(text)
        self.space = True

    def block(self, gap: int) -> None:
        self.flush()
        self.gap = max(self.gap, gap)

    def newline(self) -> None:
        if self.line:
            self.flush()
        elif self.lines and self.lines[-1]:
            self.gap = max(self.gap, 2)


class Table:
    def __init__(self) -> None:
        self.rows: list[list[tuple[list[str], int, int]]] = []
        self.captions: list[str] = []

    def layout(self) -> list[str]:
        """Cells in columns; cells over several rows stand in the first of them."""
        grid: list[list[tuple[int, int, list[str]]]] = []
        busy: dict[int, int] = {}  # column: rows that it is still taken for
        for row in self.rows:
            placed, at, taken = [], 0, {c: r - 1 for c, r in busy.items() if r > 1}
            free = {c for c, r in busy.items() if r > 0}
            for lines, wide, high in row:
                while at in free:
                    at += 1
                placed.append((at, wide, lines))
                if high > 1:
                    taken.update(dict.fromkeys(range(at, at + wide), high - 1 + 1))
                at += wide
            busy = {c: r for c, r in taken.items() if r > 0}
            grid.append(placed)
        widths: dict[int, int] = {}
        for wide_ones in (False, True):
            for placed in grid:
                for at, wide, lines in placed:
                    need = min(WIDEST, max(map(shown, lines), default=0))
                    if wide == 1 and not wide_ones:
                        widths[at] = max(widths.get(at, 0), need)
                    elif wide > 1 and wide_ones:
                        have = sum(widths.get(c, 0) for c in range(at, at + wide)) + 2 * (wide - 1)
                        if need > have:
                            widths[at + wide - 1] = widths.get(at + wide - 1, 0) + need - have
        columns = sorted({c for placed in grid for at, wide, _ in placed for c in (at, at + wide)} | set(widths))
        start, x = {}, 0
        last = 0
        for c in columns:
            x += 2 * (c - last) if c else 0
            start[c], last = x, c
            x += widths.get(c, 0)
        out = []
        for placed in grid:
            for i in range(max((len(lines) for _, _, lines in placed), default=0)):
                line = ""
                for at, _, lines in placed:
                    if i < len(lines) and lines[i]:
                        line += " " * max(start[at] - shown(line), 2 if line else 0) + lines[i]
                out.append(line)
        return out


def shown(text: str) -> int:
    """Columns that a text takes on a screen."""
    return len(text) if text.isascii() else sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text)


def _span(text: str, most: int) -> int:
    """How many columns or rows a cell takes; `most` is the bound that HTML sets."""
    m = re.match(r"\s*\+?0*([0-9]*)", text)
    return max(1, min(most, int(m[1][:9] or 0)))


def _whole(text: str) -> int | None:
    """The whole number that a text begins with, within 32 bits as browsers have it."""
    m = re.match(r"\s*([+-]?)0*([0-9]*)", text)
    if not m[2] and not re.match(r"\s*[+-]?0", text):
        return None
    n = int(m[2] or 0) if len(m[2]) <= 10 else 1 << 31
    return (-n if m[1] == "-" else n) if n < 1 << 31 else None


def _letters(n: int) -> str:
    """a, b, ..., z, aa, ab, ..."""
    out = ""
    while n > 0:
        n, r = divmod(n - 1, 26)
        out = chr(97 + r) + out
    return out


def _roman(n: int) -> str:
    out = ""
    # fixed values: Roman numerals
    for size, sign in ((1000, "m"), (900, "cm"), (500, "d"), (400, "cd"), (100, "c"), (90, "xc"), (50, "l"), (40, "xl"), (10, "x"), (9, "ix"), (5, "v"), (4, "iv"), (1, "i")):
        out += sign * (n // size)
        n %= size
    return out


def mark_of(kind: str, n: int) -> str:
    """The mark of a list item: `kind` is the list's type (1, a, A, i or I); numbers beyond what it can write are written in digits."""
    if kind in ("a", "A") and n > 0:
        text = _letters(n)
    elif kind in ("i", "I") and 0 < n < 4000:
        text = _roman(n)
    else:
        return f"{n}. "
    return (text.upper() if kind.isupper() else text) + ". "


class Renderer:
    def __init__(self, styles: Styles, without: tuple[str, ...] = ()) -> None:
        """`without`: the elements around all others whose tags the page leaves out."""
        self.styles = styles
        self.met = [(0, 0)]  # of each open element
        for tag in without:
            self.met[0] = styles.meets(tag, {}, self.met[0])
        self.drawn = 0  # open elements of drawings and formulas
        self.flows, self.tables = [Flow()], []
        self.lists: list[list] = []  # of each open list: its next number or None, the step to the one after it, its type
        self.items = 0  # of the list that begins
        self.stack: list[tuple[str, bool, int, str, str]] = []  # tag, whether its text is seen, prefixes that it has added, its box, what white space it keeps
        self.skip = 0

    def _won(self, a: dict[str, str], own: int) -> dict[str, str]:
        style = a.get("style", "")
        won = self.styles.won(own, style) if own or style else {}
        if self.drawn:  # attributes of drawings are the weakest rules
            won = {k: a[k].strip().lower() for k in VALUES if k in a} | won
        return won

    def _box(self, tag: str, display: str | None) -> str:
        """What an element is in its line: `block`, `cell` (set off by a space) or nothing of its own. Parts of tables have their own layout."""
        if tag == "table" or tag in TABLE_PARTS or self.drawn:
            return ""
        if display is None or display in ("inherit", "revert", "revert-layer"):
            return "block" if tag in BLOCK else "cell" if tag in CONTROLS else ""
        if display in IN_LINE:
            return "cell" if tag in CONTROLS else ""
        return "cell" if display == "table-cell" else "block"

    def _keeps(self, tag: str, value: str | None) -> str:
        around = self.stack[-1][4] if self.stack else ""
        return KEEPS[value] if value in KEEPS else "all" if tag in ("pre", "listing", "xmp", "textarea") and value in (None, "revert", "revert-layer") else around

    def _seen(self, tag: str, a: dict[str, str], won: dict[str, str]) -> bool | None:
        """None: no box at all. False: no text of its own. True: text is seen."""
        around = self.stack[-1][1] if self.stack else True
        display, visibility = won.get("display"), won.get("visibility", "inherit")
        if display == "none" or (tag == "input" and a.get("type", "").lower() == "hidden"):
            return None
        if ("hidden" in a or (tag == "dialog" and "open" not in a)) and display in (None, "revert", "revert-layer"):
            return None
        return visibility in ("visible", "initial") or (visibility not in ("hidden", "collapse") and around)

    def start(self, tag: str, written: str) -> None:
        if self.skip:
            self.skip += 1
            return
        a = attributes(written) if written and (self.styles or self.drawn or "=" in written or "hidden" in written or "open" in written or "reversed" in written.lower()) else {}
        met = self.styles.meets(tag, a, self.met[-1]) if self.styles else (0, 0)
        won = self._won(a, met[1]) if a or met[1] else {}
        seen = self._seen(tag, a, won) if a or met[1] else self.stack[-1][1] if self.stack else True
        closed = bool(self.stack) and self.stack[-1][0] == "details" and tag != "summary"
        if tag in UNSEEN or seen is None or closed or (self.drawn and tag in UNSHOWN):
            self.skip = 1
            return
        flow, added = self.flows[-1], 0
        box, keeps = self._box(tag, won.get("display")), self._keeps(tag, won.get("white-space"))
        if box == "cell" and seen:
            flow.add(" ")
        elif box == "block" and tag not in BLOCK:
            flow.block(1)
        if tag == "br":
            if seen:
                flow.newline()
        elif tag == "table":
            flow.block(2)
            self.tables.append(Table())
        elif tag in ("td", "th", "caption"):
            self.flows.append(Flow())
            if tag != "caption":
                if not self.tables[-1].rows:
                    self.tables[-1].rows.append([])
                self.tables[-1].rows[-1].append(([], _span(a.get("colspan", ""), 1000), _span(a.get("rowspan", ""), 65534)))
        elif tag == "tr":
            self.tables[-1].rows.append([])
        elif tag in BLOCK:
            if box:
                flow.block(2 if tag in SPACED and not (tag in ("ul", "ol", "menu") and self.lists) else 1)
            if tag in ("ul", "ol", "menu", "dir"):
                first, down = _whole(a.get("start", "")), tag == "ol" and "reversed" in a
                self.lists.append([(first if first is not None else self.items if down else 1) if tag == "ol" else None, -1 if down else 1, a.get("type", "1")])
            elif tag == "li":
                mark = "- "
                if self.lists and self.lists[-1][0] is not None:
                    given = _whole(a.get("value", ""))
                    value = given if given is not None else self.lists[-1][0]
                    mark, self.lists[-1][0] = mark_of(a.get("type", self.lists[-1][2]), value), value + self.lists[-1][1]
                if box and won.get("display", "list-item") in ("list-item", "inherit", "revert", "revert-layer"):
                    flow.prefix.append(" " * len(mark))
                    flow.mark, added = (len(flow.prefix) - 1, mark), 1
            elif tag in ("blockquote", "dd", "figure") and box:
                flow.prefix.append("  ")
                added = 1
        elif tag == "input" and a.get("type", "text").lower() in ("text", "search", "submit", "button", "reset", "email", "url", "tel", "number") and seen:
            flow.add(f" {a.get('value', '')} " if a.get("value") else "")
        elif tag == "q" and seen:
            flow.add("“")
        elif self.drawn and tag == "text":
            flow.add(" ")
        if self.drawn or tag in FOREIGN:
            self.drawn += 1
        self.met.append(met)
        self.stack.append((("details" if tag == "details" and "open" not in a else tag if tag != "details" else "details open"), bool(seen), added, box, keeps))

    def end(self, tag: str) -> None:
        if self.skip:
            self.skip -= 1
            return
        _, seen, added, box, _ = self.stack.pop()
        self.met.pop()
        if self.drawn:
            self.drawn -= 1
        flow = self.flows[-1]
        if tag in ("td", "th"):
            flow.flush()
            self.flows.pop()
            cell = self.tables[-1].rows[-1]
            cell[-1] = (flow.lines, *cell[-1][1:])
        elif tag == "caption":
            flow.flush()
            self.flows.pop()
            self.tables[-1].captions += flow.lines
        elif tag == "table":
            done = self.tables.pop()
            flow.flush()
            flow.gap = max(flow.gap, 2 if flow.lines else 0)
            for line in [*done.captions, *done.layout()]:
                flow.put(line)
            flow.block(2)
        elif tag in BLOCK:
            if box:
                flow.block(2 if tag in SPACED and not (tag in ("ul", "ol", "menu") and len(self.lists) > 1) else 1)
            if tag in ("ul", "ol", "menu", "dir") and self.lists:
                self.lists.pop()
            for _ in range(added):
                flow.prefix.pop()
                if flow.mark is not None and flow.mark[0] >= len(flow.prefix):
                    flow.mark = None
        elif tag == "textarea":
            flow.add(" ")
        elif tag == "q" and seen:
            flow.add("”")
        elif self.drawn and tag == "text":
            flow.add(" ")
        if box == "cell" and seen:
            flow.add(" ")
        elif box == "block" and tag not in BLOCK:
            flow.block(1)

    def text(self, text: str) -> None:
        if self.skip or (self.stack and not self.stack[-1][1]):
            return
        if self.stack and self.stack[-1][0] == "details" and text.strip():
            return
        flow = self.flows[-1]
        keeps = self.stack[-1][4] if self.stack else ""
        if keeps == "lines":
            for i, part in enumerate(text.replace("\r\n", "\n").replace("\r", "\n").split("\n")):
                if i:
                    flow.newline()
                flow.add(part)
        elif keeps:
            parts = text.replace("\r\n", "\n").replace("\r", "\n").split("\n")
            for i, part in enumerate(parts):
                if i:
                    if flow.line or (flow.lines and i < len(parts)):
                        flow.put("".join(flow.line))
                    flow.line = []
                if part:
                    flow.line.append(part)
                    flow.space = False
        else:
            flow.add(text)


def reversed_items(events: list[tuple]) -> dict[int, int]:
    """How many items each list has that counts down, by the place where it begins."""
    found = {i: 0 for i, e in enumerate(events) if e[0] == "open" and e[1] == "ol" and "reversed" in e[2].lower()}
    if found:
        open_lists: list[int] = []
        for i, e in enumerate(events):
            if e[0] != "text" and e[1] in ("ul", "ol", "menu", "dir"):
                open_lists.append(i) if e[0] == "open" else open_lists.pop()
            elif e[0] == "open" and e[1] == "li" and open_lists and open_lists[-1] in found:
                found[open_lists[-1]] += 1
    return found


def render(page: str | None) -> str | None:
    """The visible text of a page."""
    if page is None:
        return None
    tree = Tree()
    events = tree.read(page)
    tags = {e[1] for e in events if e[0] == "open"} if tree.styles else ()
    r = Renderer(tree.styles, tuple(t for t in ("html", "body") if t not in tags) if tree.styles else ())
    items = reversed_items(events)
    for i, e in enumerate(events):
        if e[0] == "text":
            r.text(e[1])
        elif e[0] == "open":
            r.items = items.get(i, 0)
            r.start(e[1], e[2])
        else:
            r.end(e[1])
    r.flows[0].flush()
    lines = r.flows[0].lines
    while lines and not lines[-1]:
        lines.pop()
    return "\n".join(lines)


def extract(pages: DataFrame, html: str = "html", out: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds `out`, the visible text of each page."""

    def make():
        return lambda part: {out: pa.array([render(x) for x in part.column(html).to_pylist()], pa.string())}

    return with_columns(pages, html, [(out, T.StringType())], make, keep)
