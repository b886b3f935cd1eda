"""The lexical rules in plain Python, for operators that need Unicode decomposition or similarity ratios.

They run inside Arrow operators; the JVM versions are in :mod:`sheafline.functions.text`.
"""

from __future__ import annotations

import functools
import json
import re
import unicodedata
from collections.abc import Callable, Iterator
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from sheafline.functions import text as t

_BREAK = re.compile(r"<br\s*/?>", re.I)
_MONEY = re.compile(t.MONETARY.replace("(?iu)", ""), re.I)
_LABEL = re.compile(t.FINANCIAL_LABEL.replace("(?iu)", ""), re.I)
_UNNAMED = re.compile(r"\[SANS_ENTETE_(\d+)\]", re.I)
_OTHERS = re.compile(r"[^a-z0-9]+")
_NUMBER = re.compile(r"[+−-]?\d[\d\s.,'’]*")


#: Values up to this many characters (cells, headers) are remembered, 20,000 of them; longer texts never are.
REMEMBERED = 200


def remembered[T](f: Callable[[str], T]) -> Callable[[str | None], T]:
    """``f`` with a memory for short values; null counts as ''."""
    known = functools.lru_cache(maxsize=20_000)(f)

    @functools.wraps(f)
    def of(value: str | None) -> str:
        v = value or ""
        return known(v) if len(v) <= REMEMBERED else f(v)

    return of


def _without_breaks(value: str) -> str:
    return _BREAK.sub(" ", value) if "<" in value else value


def _without_marks(value: str) -> str:
    return value.replace("*", "").replace("_", "").replace("`", "")


def plain(value: str | None) -> str:
    v = value or ""
    marked = "<" in v or "*" in v or "_" in v or "`" in v
    return " ".join((_without_marks(_without_breaks(v)) if marked else v).split())


#: What no cell holds that is plain already: marks, breaks, white space other than blanks.
_ODD = re.compile("[<*_`" + t.SPACES.replace(" ", "") + "]")


def plain_cells(cells: list[str]) -> list[str]:
    """:func:`plain` of a row's cells, which have no white space around them; most rows are plain as they are."""
    joined = "|".join(cells)
    return list(map(plain, cells)) if "  " in joined or _ODD.search(joined) else cells


def all_plain(cells: str) -> bool:
    """Whether :func:`plain` leaves all cells in a joined text as they are. May say no where it does: the cells are asked one by one then."""
    return cells.isprintable() and not ("  " in cells or "<" in cells or "*" in cells or "_" in cells or "`" in cells)


#: Letters outside ASCII that patterns without case take for one inside.
_FOLDED = {"\u017f": "s", "\u0131": "i", "\u0130": "i", "\u212a": "k"}


def folded(value: str) -> str:
    """In lower case, as patterns that ignore case compare letters."""
    for letter, plain_letter in _FOLDED.items() if not value.isascii() else ():
        if letter in value:
            value = value.replace(letter, plain_letter)
    return value.lower()


@functools.cache
def caseless(pattern: re.Pattern) -> Callable[[str], re.Match | None]:
    """The search of a pattern that ignores case, to be called with :func:`folded` text, where it finds something in the same
    texts: without the flag an alternation is searched several times as fast. For patterns without classes in capitals."""
    if re.search(r"\\[A-Z]", pattern.pattern):
        raise ValueError(pattern.pattern)
    return re.compile(pattern.pattern.lower(), pattern.flags & ~re.I).search


class Needled:
    """A pattern that ignores case, to be looked for in :func:`folded` text where one of its needles is: each of its alternatives holds one. Looking for a few words takes a tenth of a search."""

    def __init__(self, pattern: re.Pattern, *needles: str) -> None:
        self.search, self.needles = caseless(pattern), needles

    def __call__(self, text: str) -> bool:
        return any(map(text.__contains__, self.needles)) and self.search(text) is not None


@remembered
def fuzzy(value: str) -> str:
    low = plain(value).lower()
    if not low.isascii():
        low = "".join(c for c in unicodedata.normalize("NFKD", low) if not unicodedata.combining(c))
    return _OTHERS.sub(" ", low).strip()


def alike(a: str, b: str, least: float) -> bool:
    """Whether the similarity ratio is ``least`` or more; its cheap upper bounds are asked first."""
    m = SequenceMatcher(None, a, b)
    return m.real_quick_ratio() >= least and m.quick_ratio() >= least and m.ratio() >= least


def unix_lines(value: str) -> str:
    return value.replace("\r\n", "\n").replace("\r", "\n") if "\r" in value else value


_FENCE = re.compile(t.FENCE)


def without_fence(value: str) -> tuple[str, bool]:
    """(text without one enclosing code fence, whether there was one); the last line need only start like the first."""
    body = value.strip("\n")
    rows = body.splitlines() if "```" in body or "~~~" in body else []
    opened = _FENCE.match(rows[0]) if len(rows) > 1 else None
    if not opened or not rows[-1].strip().startswith(opened[1]):
        return body, False
    return "\n".join(rows[1:-1]).strip("\n"), True


def decimal(value: str | None) -> float | None:
    found = _NUMBER.search(plain(value))
    if not found:
        return None
    token = found[0].translate({0x2212: "-", 32: None, 39: None, 0x2019: None}).strip()
    marks = [c for c in token if c in ",."]
    if {",", "."} <= set(marks):
        token = token.replace("." if marks[-1] == "," else ",", "")
    try:
        return float(token.replace(",", "."))
    except ValueError:
        return None


def unnamed(cell: str) -> int | None:
    """The number of a placeholder header, else None."""
    found = _UNNAMED.fullmatch(cell.strip()) if "[" in cell else None
    return int(found[1]) if found else None


def monetary(value: str | None) -> bool:
    v = _without_breaks(value or "").strip()
    # an amount begins with a digit, a sign or a bracket, which most cells do not
    return bool(v) and (v[0] in "+−-(" or v[0].isdecimal()) and "%" not in v and bool(_MONEY.fullmatch(v))


@remembered
def financial_label(value: str) -> bool:
    v = _without_marks(_without_breaks(value)).strip()
    return bool(v and _LABEL.search(v))


def fuzzy_normalize_exact(c: Column | str) -> Column:
    """Compatibility decomposition included: ligatures, superscripts, full-width letters."""

    @F.pandas_udf("string")
    def normalized(values: pd.Series) -> pd.Series:
        return values.map(fuzzy)

    return normalized(t.text(c))


def content_text(value: object) -> str:
    """Text of a content value: a string, an object's text or else its content, or a list's non-blank parts joined by blank lines, however deep: lists that are still open are kept on a stack."""
    open_: list[tuple[Iterator[object], list[str]]] = [(iter([value]), [])]
    while True:
        items, parts = open_[-1]
        for item in items:
            while isinstance(item, dict):
                item = item["text"] if isinstance(item.get("text"), str) else item.get("content")
            if isinstance(item, list):
                open_.append((iter(item), []))
                break
            if isinstance(item, str):
                parts.append(item)
        else:
            open_.pop()
            if not open_:
                return "".join(parts)
            open_[-1][1].append("\n\n".join(x for x in parts if x.strip()))


_TOKEN = re.compile(r'\s*("(?:[^"\\]|\\.)*"|\[+|\]+|[{},:]|[^\s\[\]{},:"]+)')


def deep_json(value: str) -> object:
    """A JSON value nested deeper than the standard parser goes; only its brackets are followed here, every string and number is read by that parser."""
    top: list = []
    open_: list[list] = [top]  # lists as they are, objects as names and values by turns
    kinds, at = [], 0
    for m in _TOKEN.finditer(value):
        if m.start() != at:
            break
        at, token = m.end(), m[1]
        if token[0] in "[{":
            open_.extend([] for _ in token)
            kinds.extend(token)
        elif token[0] in "]}":
            for end in token:
                if not kinds or "[{".index(kinds.pop()) != "]}".index(end):
                    raise ValueError("brackets do not match")
                done = open_.pop()
                open_[-1].append(done if end == "]" else dict(zip(done[::2], done[1::2], strict=True)))
        elif token not in ",:":
            open_[-1].append(json.loads(token))
    if value[at:].strip() or kinds or len(top) != 1:
        raise ValueError("no JSON value")
    return top[0]


def json_text(c: Column | str) -> Column:
    """Text of a JSON content value (see :func:`content_text`), nested to any depth; text that is no JSON, and null, give ''."""

    def of(value: str) -> str:
        try:
            return content_text(json.loads(value))
        except RecursionError:
            return content_text(deep_json(value))
        except ValueError:
            return ""

    def safe(value: str) -> str:
        try:
            return of(value)
        except (ValueError, TypeError):  # brackets without sense, or names that are none
            return ""

    @F.pandas_udf("string")
    def extracted(values: pd.Series) -> pd.Series:
        return values.map(safe)

    return extracted(t.text(c))
