"""One page's two readings as Python values, parsed once and shared by all page rules."""

from __future__ import annotations

import functools
import re
from collections.abc import Callable
from dataclasses import dataclass, field
from difflib import SequenceMatcher
from functools import cached_property

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from sheafline.functions.text import PAGE_MARKER
from sheafline.functions.unicode import REMEMBERED, all_plain, folded, fuzzy, plain, plain_cells, unnamed

_PIPE = re.compile(r"\\.|\||[^\\|]+|\\", re.DOTALL)
_SEPARATOR = re.compile(r":?-{3,}:?")
_MARKER = re.compile(PAGE_MARKER)
_BLOCKS = {tag: re.compile(rf"\[\[{tag}\b([^\]]*)\]\](.*?)\[\[/{tag}\]\]", re.I | re.S) for tag in ("VISUAL_TABLE", "VISUAL_ROW", "TEXT_BLOCK")}
_INDEXED = re.compile(r"(?m)^\s*(\d+)=(.*)$")
#: How the lines ``n=value`` of a row begin that is in order.
IN_ORDER = [f"{n}=" for n in range(1, 100)]
_KIND = re.compile(r"\bkind=([^\s\]]+)", re.I)

def _split(content: str) -> list[str]:
    if "\\" not in content:
        return [c.strip() for c in content.split("|")]
    cells = [""]
    for token in _PIPE.findall(content):
        if token == "|":
            cells.append("")
        else:
            cells[-1] += token
    return [c.strip() for c in cells]


def strict_cells(line: str) -> list[str]:
    s = line.strip()
    return _split(s[1:-1]) if s.startswith("|") and s.endswith("|") else []


def lenient_cells(line: str) -> list[str]:
    s = line.strip()
    if not s.startswith("|"):
        return []
    return _split(s[1:-1] if s.endswith("|") and not s.endswith("\\|") else s[1:])


def separator(cells: list[str]) -> bool:
    return bool(cells) and all(_SEPARATOR.fullmatch(c) for c in cells)


def blocks(value: str, tag: str) -> list[tuple[str, str]]:
    """(attributes, body) of each tag that is closed, whatever its case. Texts in ASCII are cut at the tags' places, others are left to the pattern."""
    if not value.isascii():
        return _BLOCKS[tag].findall(value)
    upper, start, end = value.upper(), f"[[{tag}", f"[[/{tag}]]"
    out: list[tuple[str, str]] = []
    first = upper.find(start)
    while first >= 0:
        at = first + len(start)
        shut = value.find("]", at)
        named = value[at : at + 1].isalnum() or value[at : at + 1] == "_"
        if not named and value.startswith("]]", shut):
            stop = upper.find(end, shut + 2)
            if stop < 0:
                break
            out.append((value[at:shut], value[shut + 2 : stop]))
            at = stop + len(end)
        first = upper.find(start, at)
    return out


def indexed(body: str) -> list[str]:
    """The values of lines ``n=value`` by their numbers. Rows in order, as most are, need no pattern."""
    rows = body.strip("\n").split("\n")
    if len(rows) < 10 and all(map(str.startswith, rows, IN_ORDER)):
        return [x[2:].strip() for x in rows]
    found = _INDEXED.findall(body)
    found.sort(key=lambda x: int(x[0]))
    return [v.strip() for _, v in found]


@functools.lru_cache(maxsize=20_000)
def _kind(attrs: str) -> str:
    found = _KIND.search(attrs)
    return found[1].lower() if found else "data"


def kind_of(attrs: str) -> str:
    return _kind(attrs) if len(attrs) <= REMEMBERED else _kind.__wrapped__(attrs)


class Heading:
    """A header's plain names and what is found in them, each looked for once; headers recur from page to page."""

    def __init__(self, header: tuple[str, ...]) -> None:
        self.names = plain_cells(list(header))
        self.line, self.folded = " | ".join(self.names), folded("|".join(self.names))
        self.blanks = [n for n, c in enumerate(header, 1) if unnamed(c) is not None]
        self.known: dict[tuple[str, int], tuple[object, object]] = {}

    def of[T](self, what: str, key: object, f: Callable[[], T]) -> T:
        """``f()``, remembered for an object that is not made anew for each page."""
        known = self.known.get((what, id(key)))
        if known is None:
            known = self.known[what, id(key)] = (key, f())
        return known[1]

    def first(self, pattern: re.Pattern) -> int | None:
        """The place of the first name that a pattern is found in."""
        return self.of("first", pattern, lambda: next((i for i, name in enumerate(self.names) if pattern.search(name)), None))

    def headed(self, pattern: re.Pattern) -> bool:
        """Whether a pattern is found in the names as one line."""
        return self.of("headed", pattern, lambda: pattern.search(self.line) is not None)


_known_heading = functools.lru_cache(maxsize=20_000)(Heading)


def heading_of(header: list[str]) -> Heading:
    names = tuple(header)
    return _known_heading(names) if sum(map(len, names)) <= REMEMBERED else Heading(names)


#: Pages that a task holds at once as Python objects, whatever the size of Spark's batches.
AT_ONCE = 500


def by_text(returns: str, kind: pa.DataType, f: Callable[..., object], *columns: Column) -> Column:
    """``f`` of each row's values as a column: one Arrow call for a batch of rows."""

    @F.arrow_udf(returns)
    def called(*arrays: pa.Array) -> pa.Array:
        starts = range(0, len(arrays[0]), AT_ONCE)
        parts = [pa.array([f(*x) for x in zip(*(a.slice(at, AT_ONCE).to_pylist() for a in arrays), strict=True)], kind) for at in starts]
        return pa.concat_arrays(parts) if parts else pa.array([], kind)

    # "nondeterministic" keeps the optimiser from evaluating it again in filters and generators above
    return called.asNondeterministic()(*columns)


@dataclass
class Table:
    page: int
    line: int
    header: list[str]
    rows: list[list[str]]

    @cached_property
    def heading(self) -> Heading:
        return heading_of(self.header)

    @property
    def names(self) -> list[str]:
        return self.heading.names

    @cached_property
    def joined(self) -> str:
        """All cells below the header as they came."""
        return "|".join(["|".join(r) for r in self.rows])

    @cached_property
    def plain_rows(self) -> list[list[str]]:
        return self.rows if all_plain(self.joined) else [plain_cells(r) for r in self.rows]

    @cached_property
    def folded_rows(self) -> str:
        """All plain cells below the header as one folded text. No pattern for cells matches beyond the pipes between them."""
        return folded(self.joined if self.plain_rows is self.rows else "|".join("|".join(r) for r in self.plain_rows))

    def headed(self, pattern: re.Pattern) -> bool:
        """Whether a pattern is found in the header as one line."""
        return self.heading.headed(pattern)

    def column(self, pattern: re.Pattern) -> int | None:
        """The first header that matches."""
        return self.heading.first(pattern)


@dataclass
class AuditTable:
    rows: list[tuple[str, list[str]]]

    @cached_property
    def header(self) -> list[str]:
        return next((cells for kind, cells in self.rows if kind == "header"), [])

    @cached_property
    def data(self) -> list[list[str]]:
        return [cells for kind, cells in self.rows if kind not in ("header", "continuation", "note")]

    @cached_property
    def plain_rows(self) -> list[list[str]]:
        rows = [cells for _, cells in self.rows]
        return rows if all_plain("|".join(["|".join(r) for r in rows])) else [plain_cells(r) for r in rows]

    @cached_property
    def folded_rows(self) -> str:
        """As in :class:`Table`, header included."""
        return folded("|".join(["|".join(r) for r in self.plain_rows]))


@functools.lru_cache(maxsize=50_000)
def header_score(a: str, b: str) -> float:
    """Similarity of two normalised headers: their ratio, and 0.4 times the share of common words."""
    one, two = set(a.split()), set(b.split())
    return SequenceMatcher(None, a, b).ratio() + 0.4 * (len(one & two) / len(one | two) if one or two else 0.0)


@dataclass
class Page:
    """Markdown and independent audit text of a page."""

    markdown: str
    audit: str = ""
    number: int = 0
    lines: list[str] = field(init=False)

    def __post_init__(self) -> None:
        self.lines = self.markdown.splitlines()

    @cached_property
    def plain_lines(self) -> list[str]:
        return [p for p in map(plain, self.lines) if p]

    @cached_property
    def numbers(self) -> list[int]:
        """The page that each line lies on, by the markers so far."""
        out, page = [], 0
        for line in self.lines:
            found = _MARKER.match(line) if "<!--" in line else None
            page = int(found[1]) if found else page
            out.append(page)
        return out

    @cached_property
    def cells(self) -> list[list[str]]:
        """The strict cells of each line."""
        rows = self.lines if "\\" in self.markdown else ()
        # without escapes a row is cut at its pipes
        return [strict_cells(x) for x in rows] or [[c.strip() for c in s[1:-1].split("|")] if (s := x.strip())[:1] == "|" == s[-1:] else [] for x in self.lines]

    def scan(self, skip_ragged: bool) -> list[Table]:
        out, at, cells = [], 0, self.cells
        while at < len(cells):
            width = len(cells[at])
            if not (width and at + 1 < len(cells) and len(cells[at + 1]) == width and separator(cells[at + 1])):
                at += 1
                continue
            end = at + 2
            while end < len(cells) and cells[end] and (skip_ragged or len(cells[end]) == width):
                end += 1
            out.append(Table(self.numbers[at], at + 1, cells[at], [r for r in cells[at + 2 : end] if len(r) == width]))
            at = end
        return out

    def structure(self, pages: int | None) -> tuple[list[int], bool, list[int]]:
        """Page markers, whether they are 1 to ``pages`` in order, and the lines of table rows that are not as wide as their header."""
        found = (_MARKER.match(line) for line in self.lines if "<!--" in line)
        markers, bad, width, rule_line = [int(m[1]) for m in found if m], [], 0, -1
        for i, cells in enumerate(self.cells):
            after = self.cells[i + 1] if i + 1 < len(self.cells) else []
            if not cells:
                width = 0
            elif not width:
                if separator(after):
                    width, rule_line = len(cells), i + 1
                    bad += [i + 1] if len(after) != width else []
            elif len(cells) != width and i != rule_line:
                bad.append(i + 1)
        return markers, markers == list(range(1, (pages or 0) + 1)), bad

    @cached_property
    def tables(self) -> list[Table]:
        return self.scan(skip_ragged=False)

    @cached_property
    def piped(self) -> list[tuple[int, list[list[str]]]]:
        """Runs of lines that start with a pipe: (index of the first, lenient cells of each)."""
        out: list[tuple[int, list[list[str]]]] = []
        escaped = "\\" in self.markdown
        for i, line in enumerate(self.lines):
            if "|" in line and line.lstrip().startswith("|"):
                # without escapes both splitters cut a row alike that both pipes stand around
                cells = lenient_cells(line) if escaped or not self.cells[i] else self.cells[i]
                if out and out[-1][0] + len(out[-1][1]) == i:
                    out[-1][1].append(cells)
                else:
                    out.append((i, [cells]))
        return out

    @cached_property
    def audit_tables(self) -> list[AuditTable]:
        return [AuditTable([(kind_of(attrs), indexed(body)) for attrs, body in blocks(table, "VISUAL_ROW")]) for _, table in blocks(self.audit, "VISUAL_TABLE")]

    @cached_property
    def text_blocks(self) -> list[tuple[str, str]]:
        return [(attrs, body.strip()) for attrs, body in blocks(self.audit, "TEXT_BLOCK")]

    @cached_property
    def pairs(self) -> list[tuple[AuditTable, Table]]:
        """Audit tables in order, each with the best remaining Markdown table by similarity of headers (0.25 at least; the earlier of equals)."""
        free, out = dict(enumerate(self.tables)), []
        signs = {i: fuzzy(" | ".join(t.header)) for i, t in free.items()}
        for audit in self.audit_tables:
            sign = fuzzy(" | ".join(audit.header))
            score, best = max(((header_score(sign, signs[i]), -i) for i in free), default=(0.0, 0))
            if free and score >= 0.25:
                out.append((audit, free.pop(-best)))
        return out
