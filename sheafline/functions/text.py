"""Lexical rules as Column expressions: everything stays inside the JVM.

White space means Unicode white space plus the four information separators, and a line
ends at any Unicode line boundary, as in Python's str methods; :func:`strip` and :func:`lines` define both once.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values of the formats handled here -------------------------------------------
WS = r"[\s\u001c-\u001f]"
#: The characters that WS matches.
SPACES = "\t\n\u000b\f\r\u001c\u001d\u001e\u001f \u0085\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
LINE_END = r"\r\n|[\n\r\u000b\u000c\u001c\u001d\u001e\u0085  ]"
SECTIONS = ["issuer", "customer", "shipping", "document", "line_items", "taxes", "totals", "payment", "annotations", "legal", "other"]
SOURCES = ["printed", "handwritten", "stamp"]
SECTION_ALIASES = {
    "logo": "issuer", "logo_text": "issuer", "supplier": "issuer", "supplier_identity": "issuer", "supplier_address": "issuer", "supplier_contact": "issuer",
    "supplier_legal": "legal", "customer_identity": "customer", "customer_address": "customer", "customer_contact": "customer", "customer_legal": "customer",
    "billing_address": "customer", "shipping_address": "shipping", "shipping_details": "shipping", "shipping_contact": "shipping", "invoice_title": "document",
    "invoice_details": "document", "document_meta": "document", "line_items_note": "line_items", "line_items_footer": "line_items", "tax_summary": "taxes",
    "totals_summary": "totals", "payment_terms": "payment", "bank_details": "payment", "payment_table": "payment", "delivery_confirmation": "annotations",
    "stamp_signature": "annotations", "notes": "annotations", "annotation": "annotations", "legal_terms": "legal", "marketing_badge": "legal",
    "isolated_value": "other", "other_table": "other", "unknown": "other",
}
FINANCIAL_LABEL = (
    r"(?iu)(?:^|\b)(?:total|subtotal|sous[- ]?total|net(?:\s+à?\s*payer)?|solde|balance(?:\s+due)?|amount\s+due|gross\s+total|total\s+due|contribution|levy|redevance|"
    r"éco[- ]?(?:contribution|participation)|eco[- ]?(?:contribution|participation)|remise|discount|escompte|acompte|deposit|frais|fees?|port|shipping|freight|"
    r"consigne|retenue|withholding|timbre|stamp|arrondi|rounding|octroi(?:\s+de\s+mer)?|octroi\s+r[eé]gional|\bomr?\b|droits?|dut(?:y|ies)|taxe(?:s)?)(?:\b|$)"
)
MONETARY = r"(?iu)^[+−-]?\(?\s*\d[\d\s.,'’]*\s*(?:€|EUR|USD|GBP|CHF|CAD|AUD|JPY|CNY|RMB|£|\$)?\s*\)?$"
UNNAMED = r"(?i)^\[SANS_ENTETE_\d+\]$"
ATTRIBUTE = r"([A-Za-z_][A-Za-z0-9_]*)=(?:\"([^\"]*)\"|'([^']*)'|([^\s]+))"
FENCE = r"^\s*(`{3,}|~{3,})(?:[A-Za-z0-9_.+-]+)?\s*$"
PAGE_MARKER = r"(?i)^\s*<!--\s*PAGE\s+(\d+)\s*-->\s*$"
MODEL_PAGE = r"(?i)^\s*\[\[(?:PDF_)?PAGE(?:\s+\d+)?\]\]\s*$"
MAP_COMMENT = r"(?im)^\s*<!--\s*(?:TRACK_MAP|GRID_MAP|ROW_MAP|SPECIAL_ROW_MAP)\b.*?-->\s*$"
GLOBAL_FAILURE = "invalid api key|authentication failed|permission denied|http 401|http 403|http 404|model not found|endpoint qwen invalide|workspace"
ACCENTED, PLAIN = "àâäáãåçéèêëíìîïñóòôöõúùûüýÿ", "aaaaaaceeeeiiiinooooouuuuyy"
# ------------------------------------------------------------------------------------------


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f(value)`` with the value computed once, however often ``f`` mentions it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def text(c: Column | str) -> Column:
    """The value as string, null as ''."""
    return F.coalesce(_col(c).cast("string"), F.lit(""))


def strip(c: Column | str) -> Column:
    return F.btrim(_col(c), F.lit(SPACES))


def lines(c: Column | str) -> Column:
    """array<string>: the text's lines; no empty last one."""
    return let(F.split(_col(c), LINE_END, -1), lambda parts: F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts))


def unix_lines(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), r"\r\n|\r", "\n")


def breaks_to_spaces(c: Column | str) -> Column:
    return let(text(c), lambda v: F.when(F.contains(v, F.lit("<")), F.regexp_replace(v, r"(?i)<br\s*/?>", " ")).otherwise(v))


def plain_cell(c: Column | str) -> Column:
    """Line breaks to spaces, emphasis marks dropped, white space collapsed and trimmed."""
    spaced = F.translate(breaks_to_spaces(c), SPACES + "*_`", " " * len(SPACES))
    return F.btrim(F.regexp_replace(spaced, " {2,}", " "))


def fuzzy_normalize(c: Column | str) -> Column:
    """Plain cell in lower case without accents (Latin letters); runs of anything else are one space.

    Letters that decompose in other ways (ligatures, superscripts) need :func:`sheafline.functions.unicode.fuzzy_normalize_exact`.
    """
    bare = F.regexp_replace(F.translate(F.lower(plain_cell(c)), ACCENTED, PLAIN), r"\p{Mn}", "")
    return strip(F.regexp_replace(bare, "[^a-z0-9]+", " "))


def parse_decimal(c: Column | str) -> Column:
    """double: the first number in a cell; null if there is none or it is ambiguous.

    A lone comma is the decimal mark; with both marks the last one is; parentheses do not negate.
    """
    token = F.regexp_replace(F.translate(F.regexp_extract(plain_cell(c), r"(?U)[+−-]?\d[\d\s.,'’]*", 0), "−", "-"), r"[ '’]", "")

    def number(t: Column) -> Column:
        last = F.regexp_extract(t, r"([.,])[^.,]*$", 1)
        both = F.when(last == ",", F.translate(F.replace(t, F.lit("."), F.lit("")), ",", ".")).otherwise(F.replace(t, F.lit(","), F.lit("")))
        return strip(F.when(F.contains(t, F.lit(",")) & F.contains(t, F.lit(".")), both).otherwise(F.translate(t, ",", ".")))

    return let(let(token, number), lambda n: F.when(n.rlike(r"^[+-]?\d+\.?\d*$"), n.try_cast("double")))


def is_monetary(c: Column | str) -> Column:
    money = MONETARY.replace("(?iu)", "(?iuU)")
    return let(strip(breaks_to_spaces(c)), lambda v: (v != "") & ~F.contains(v, F.lit("%")) & ~v.rlike(UNNAMED) & v.rlike(money))


def is_financial_label(c: Column | str) -> Column:
    label = FINANCIAL_LABEL.replace("(?iu)", "(?iuU)")
    return let(strip(F.regexp_replace(breaks_to_spaces(c), r"[*_`]+", "")), lambda v: (v != "") & v.rlike(label))


def is_number_or_amount(c: Column | str) -> Column:
    return strip(text(c)).rlike(r"(?iuU)^[-+−]?\(?\d[\d\s.,']*\)?\s*(?:€|EUR|USD|CHF|GBP|£|\$)?$")


def is_percent(c: Column | str) -> Column:
    return strip(text(c)).rlike(r"(?U)^[-+−]?\d+(?:[,.]\d+)?\s*%$")


def parse_attributes(c: Column | str) -> Column:
    """map<string,string> of a ``k=v`` bag, keys in lower case; the last of equal keys wins."""
    found = F.regexp_extract_all(text(c), F.lit(ATTRIBUTE), F.lit(0))
    # an attribute as found: its name has no "=", and quotes stand around its value or, without a second one, belong to it
    quoted = lambda v: F.exists(F.array(F.lit('"'), F.lit("'")), lambda q: (F.length(v) > 1) & F.startswith(v, q) & F.endswith(v, q))
    bare = lambda v: F.when(quoted(v), F.substring(v, F.lit(2), F.length(v) - 2)).otherwise(v)
    value = lambda x, name: let(F.substring(x, F.length(name) + 2, F.length(x)), bare)
    pairs = F.transform(found, lambda x: let(F.substring_index(x, "=", 1), lambda name: F.struct(F.lower(name).alias("k"), value(x, name).alias("v"))))
    return let(pairs, lambda pair: F.map_from_entries(F.filter(pair, lambda p, i: ~F.exists(F.slice(pair, i + 2, F.size(pair)), lambda q: q["k"] == p["k"]))))


def strip_outer_fence(c: Column | str) -> Column:
    """struct<value, removed>: without one enclosing code fence; the last line need only start like the first."""

    def opened(body: Column, rows: Column) -> Column:
        mark = F.regexp_extract(F.get(rows, F.lit(0)), FENCE, 1)
        closes = (F.size(rows) >= 2) & (mark != "") & F.startswith(strip(F.element_at(rows, -1)), mark)
        inner = F.regexp_replace(F.array_join(F.slice(rows, 2, F.greatest(F.size(rows) - 2, F.lit(0))), "\n"), r"\A\n+|\n+\z", "")
        return let(F.coalesce(closes, F.lit(False)), lambda done: F.struct(F.when(done, inner).otherwise(body).alias("value"), done.alias("removed")))

    return let(F.regexp_replace(text(c), r"\A\n+|\n+\z", ""), lambda body: let(F.when(F.contains(body, F.lit("```")) | F.contains(body, F.lit("~~~")), lines(body)).otherwise(F.array().cast("array<string>")), lambda rows: opened(body, rows)))


def strip_triple_backticks(c: Column | str) -> Column:
    t = strip(text(c))
    inner = F.regexp_replace(F.regexp_replace(t, r"\A```[a-zA-Z0-9_-]*\n?", ""), r"\n?```\n?\z", "")
    return F.regexp_replace(F.when(F.startswith(t, F.lit("```")), inner).otherwise(t), r"\A\n+|\n+\z", "")


def strip_appendix(c: Column | str) -> Column:
    """Without the raw-text appendix and what follows it."""
    heading = r"(?imU)^##\s+Annexe\s*-\s*OCR\s+brut\s*$"
    before = F.element_at(F.split(text(c), heading, 2), 1)
    return F.when(text(c).rlike(heading), F.regexp_replace(before, rf"(?U){WS}+\z", "")).otherwise(strip(text(c)))


def normalize_placeholders(c: Column | str) -> Column:
    return F.regexp_replace(text(c), r"<SANS_ENTETE_(\d+)>", "[SANS_ENTETE_$1]")


def normalize_markdown_tokens(c: Column | str) -> Column:
    v = F.replace(normalize_placeholders(c), F.lit("<BR>"), F.lit("<br>"))
    return F.replace(F.replace(v, F.lit("<EMPTY>"), F.lit("")), F.lit("<TAB>"), F.lit("    "))


def strip_model_page_tokens(c: Column | str) -> Column:
    return strip(F.array_join(F.filter(lines(text(c)), lambda x: ~x.rlike(MODEL_PAGE)), "\n"))


def sanitize_canonical(c: Column | str) -> Column:
    """struct<value, changes>: line ends, fence, page markers and token aliases made uniform."""

    def cleaned(fenced: Column, changed: Column) -> Column:
        rows = lines(fenced["value"])
        kept = F.filter(rows, lambda x: ~x.rlike(MODEL_PAGE) & ~x.rlike(PAGE_MARKER))
        joined = F.regexp_replace(F.array_join(kept, "\n"), r"\A\n+|\n+\z", "")
        return F.struct(joined.alias("joined"), (F.size(rows) - F.size(kept)).alias("dropped"), fenced["removed"].alias("fence"), changed.alias("ends"))

    def aliased(v: Column) -> Column:
        out = normalize_placeholders(v)
        for alias in ("[TRONQUÉ]", "[TRONQUEE]", "[TRONQUÉE]"):
            out = F.replace(out, F.lit(alias), F.lit("[TRONQUE]"))
        return out

    def reported(r: Column, value: Column) -> Column:
        counts = {"line_endings": r["ends"], "outer_fence": r["fence"], "model_page_markers": r["dropped"], "token_aliases": value != r["joined"]}
        return F.struct(value.alias("value"), counted(counts).alias("changes"))

    raw = text(c)
    done = let(unix_lines(raw), lambda unix: let(strip_outer_fence(unix), lambda f: cleaned(f, unix != raw)))
    return let(done, lambda r: let(aliased(r["joined"]), lambda v: reported(r, v)))


def counted(counts: dict[str, Column]) -> Column:
    """map<string,int> of the counts (true is 1) that are not zero."""
    entries = F.array(*[F.struct(F.lit(k).alias("key"), v.cast("int").alias("value")) for k, v in counts.items()])
    return F.map_from_entries(F.filter(entries, lambda e: e["value"] > 0))


@functools.lru_cache(maxsize=1)
def _alias_pairs() -> tuple[str, ...]:
    return tuple(x for kv in SECTION_ALIASES.items() for x in kv)


def normalize_section(c: Column | str) -> Column:
    """struct<section, valid>: aliases resolved; anything unknown is 'other'."""
    aliases = F.create_map(*[F.lit(x) for x in _alias_pairs()])
    section = let(F.lower(strip(text(c))), lambda raw: F.coalesce(F.try_element_at(aliases, raw), raw))
    return let(section, lambda s: F.struct(F.when(s.isin(SECTIONS), s).otherwise("other").alias("section"), s.isin(SECTIONS).alias("valid")))


def normalize_source(c: Column | str) -> Column:
    """struct<source, valid>: anything unknown is 'printed'."""
    raw = F.lower(strip(text(c)))
    return F.struct(F.when(raw.isin(SOURCES), raw).otherwise("printed").alias("source"), raw.isin(SOURCES).alias("valid"))


def derive_status(c: Column | str) -> Column:
    unreadable, cut = F.contains(text(c), F.lit("[ILLISIBLE]")), F.contains(text(c), F.lit("[TRONQUE]"))
    return F.when(unreadable & cut, "uncertain_truncated").when(unreadable, "uncertain").when(cut, "truncated").otherwise("readable")


_TOKEN = r"\[(?:ILLISIBLE|TRONQUÉ|SANS_ENTETE_\d+)\]"


def _escape_piece(c: Column) -> Column:
    v = F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    return F.regexp_replace(v, r"([\\`*_\[\]#~|])", r"\\$1")


def escape_literal(c: Column | str) -> Column:
    """HTML and Markdown escapes everywhere but in the display tokens."""
    v = F.replace(text(c), F.lit("[TRONQUE]"), F.lit("[TRONQUÉ]"))
    gaps, tokens = F.split(v, _TOKEN, -1), F.regexp_extract_all(v, F.lit(_TOKEN), F.lit(0))
    return F.array_join(F.flatten(F.zip_with(F.transform(gaps, _escape_piece), tokens, lambda g, t: F.array(g, F.coalesce(t, F.lit(""))))), "")


def escape_cell(c: Column | str) -> Column:
    v = F.replace(text(c), F.lit("[TRONQUE]"), F.lit("[TRONQUÉ]"))
    return F.when(v == "<EMPTY>", "").otherwise(F.array_join(F.transform(F.split(v, r"<BR>|\n", -1), escape_literal), "<br>"))


def escape_block_line(c: Column | str) -> Column:
    """Like a cell, and list markers and rules at a line's start lose their meaning."""

    def piece(x: Column) -> Column:
        v = F.regexp_replace(escape_literal(x), r"(?U)\A(\s*)([-+])(?=\s)", r"$1\\$2")
        v = F.regexp_replace(v, r"(?U)\A(\s*)(\d+)([.)])(?=\s)", r"$1$2\\$3")
        return F.when(v.rlike(r"(?U)\A\s*-{3,}\s*\z"), F.regexp_replace(v, r"(?U)\A(\s*)-", r"$1\\-")).otherwise(v)

    return F.array_join(F.transform(F.split(text(c), "<BR>", -1), piece), "<br>")


def longest_backtick_run(c: Column | str) -> Column:
    return F.coalesce(F.array_max(F.transform(F.regexp_extract_all(text(c), F.lit("`+"), F.lit(0)), F.length)), F.lit(0))


def code_fence(c: Column | str) -> Column:
    return F.repeat(F.lit("`"), F.greatest(F.lit(4), longest_backtick_run(c) + 1))


def shorten(c: Column | str, most: int = 150_000) -> Column:
    """struct<value, shortened>: head and tail halves around a note when longer than ``most``."""
    v, half = text(c), max(1, most // 2)
    note = F.concat(F.lit("\n\n[... THINKING TRONQUÉ POUR L'ANNEXE ; longueur originale="), F.length(v).cast("string"), F.lit(" caractères ...]\n\n"))
    long = F.length(v) > most
    return F.struct(F.when(long, F.concat(F.left(v, F.lit(half)), note, F.right(v, F.lit(half)))).otherwise(v).alias("value"), long.alias("shortened"))


#: A fence line and all up to the next line that begins with the same mark, or the end.
_FENCED = r"(?ms)^[^\S\n]*(```|~~~)(?:[^\n]*\z|[^\n]*\n(?:.*?^[^\S\n]*\1[^\n]*$|.*\z))"


def outside_fences(c: Column | str) -> Column:
    """array<struct<line, inside, fence>>: each line with whether a code fence encloses it (a fence of ``` or ~~~ closes only itself).

    Fenced stretches are cut out by one pattern from left to right and the lines of either kind put together again in turn.
    """
    row = lambda x, inside, fence: F.struct(x.alias("line"), inside.alias("inside"), fence.alias("fence"))

    def of_gap(gap: Column, first: Column, last: Column) -> Column:
        # what stands between two fenced stretches begins and ends with a line break that belongs to neither
        bare = F.when(first, gap).otherwise(F.substring(gap, F.lit(2), F.length(gap)))
        bare = F.when(last, bare).otherwise(F.left(bare, F.greatest(F.length(bare) - 1, F.lit(0))))
        some = F.when((gap == "") | (~first & ~last & (gap == "\n")), F.array().cast("array<string>")).otherwise(F.split(bare, "\n", -1))
        return F.transform(some, lambda x: row(x, F.lit(False), F.lit(False)))

    def of_block(block: Column) -> Column:
        mark = F.regexp_extract(block, r"^[^\S\n]*(```|~~~)", 1)
        inner = F.split(block, "\n", -1)
        return F.transform(inner, lambda x, i: row(x, i > 0, F.regexp_extract(x, r"^\s*(```|~~~)", 1) != "")) if mark is not None else inner

    def joined(v: Column, gaps: Column, blocks: Column) -> Column:
        n = F.size(gaps)
        each = F.transform(gaps, lambda g, i: F.concat(of_gap(g, i == 0, i == n - 1), F.when(i < n - 1, of_block(F.get(blocks, i))).otherwise(F.array().cast("array<struct<line:string,inside:boolean,fence:boolean>>"))))
        return F.when(v == "", F.array().cast("array<struct<line:string,inside:boolean,fence:boolean>>")).otherwise(F.flatten(each))

    v = F.array_join(lines(text(c)), "\n")
    return let(v, lambda v: let(F.split(v, _FENCED, -1), lambda gaps: let(F.regexp_extract_all(v, F.lit(_FENCED), F.lit(0)), lambda blocks: joined(v, gaps, blocks))))


def strip_page_markers_outside_fences(c: Column | str) -> Column:
    kept = F.filter(outside_fences(c), lambda r: r["fence"] | r["inside"] | ~r["line"].rlike(PAGE_MARKER))
    return strip(F.array_join(F.transform(kept, lambda r: r["line"]), "\n"))


def page_markers_outside_fences(c: Column | str) -> Column:
    found = F.filter(outside_fences(c), lambda r: ~r["fence"] & ~r["inside"] & r["line"].rlike(PAGE_MARKER))
    return F.transform(found, lambda r: F.regexp_extract(r["line"], PAGE_MARKER, 1).cast("int"))


def page_markers(c: Column | str) -> Column:
    """array<int>: page numbers in the order of their marker lines."""
    return F.transform(F.filter(lines(text(c)), lambda x: x.rlike(PAGE_MARKER)), lambda x: F.regexp_extract(x, PAGE_MARKER, 1).cast("int"))


def json_text_to_depth(c: Column | str, depth: int) -> Column:
    """Text of a JSON content value: a string, an object's text or content, or a list's non-blank parts joined by blank lines.

    For values known to be nested ``depth`` deep at most: what lies deeper gives ''. :func:`sheafline.functions.unicode.json_text` follows any depth.
    """
    v = _col(c)
    if depth < 0:
        return F.lit("")
    quoted = F.from_json(F.concat(F.lit('{"x":'), v, F.lit("}")), "x string")["x"]
    items = F.from_json(v, "array<string>")
    t, kind = F.get_json_object(v, "$.text"), F.substring(F.ltrim(v), 1, 1)
    parts = F.filter(F.transform(items, lambda x: F.when(F.ltrim(x).rlike(r"^[\[{]"), json_text_to_depth(x, depth - 1)).otherwise(x)), lambda x: strip(x) != "")
    inner = F.get_json_object(v, "$.content")
    of_object = F.coalesce(t, F.when(F.ltrim(inner).rlike(r"^[\[{]"), json_text_to_depth(inner, depth - 1)).otherwise(inner), F.lit(""))
    return F.coalesce(F.when(kind == "[", F.array_join(parts, "\n\n")).when(kind == "{", of_object).when(kind == '"', quoted), F.lit(""))


def object_key(uri: Column | str) -> Column:
    """The object path of a store URI or local path; null if there is none."""
    u = _col(uri)
    key = F.when(F.startswith(u, F.lit("gs://")), F.regexp_extract(u, r"(?s)\Ags://[^/]*/(.*)\z", 1)).otherwise(F.regexp_replace(u, r"\A/+", ""))
    return F.when(key != "", key)


def derived_uri(uri: Column | str, bucket: str, folder: str, suffix: str) -> Column:
    """Sibling object of an input: without 'in/' and extension, in ``folder`` of the fixed bucket."""
    base = F.regexp_replace(F.regexp_replace(object_key(uri), r"\Ain/", ""), r"(?s)\.[^.]*\z", "")
    return F.concat(F.lit(f"gs://{bucket}/{folder}/"), base, F.lit(suffix))


def canonical_uri(uri: Column | str, bucket: str) -> Column:
    return F.concat(F.lit(f"gs://{bucket}/"), object_key(uri))


def sha256_text(c: Column | str) -> Column:
    return F.sha2(text(c).cast("binary"), 256)


def is_global_failure(message: Column | str) -> Column:
    return F.lower(text(message)).rlike(GLOBAL_FAILURE)
