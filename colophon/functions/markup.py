"""Column expressions for XML text: entities, leftover tags, markup, element names."""

from __future__ import annotations

from collections.abc import Iterable
from html.entities import name2codepoint

from pyspark.sql import Column, functions as F


def latin_entities() -> dict[str, str]:
    """Named entities of the format: the Latin-1 letters, times, micro and reg."""
    return {
        name: chr(code)
        for name, code in name2codepoint.items()
        if (192 <= code <= 255 and name != "divide") or name in ("micro", "reg")
    }


def decode_entities(col: Column) -> Column:
    """Replace named Latin-1 entities by their characters; ``&amp;`` and the other entities
    that XML itself defines stay for the parser. Work grows with the ``&`` in a text only."""
    chars = F.create_map(*[F.lit(x) for pair in latin_entities().items() for x in pair])

    def decoded(piece: Column) -> Column:
        name = F.substring_index(piece, ";", 1)
        char = F.when(F.contains(piece, F.lit(";")), F.try_element_at(chars, name))
        rest = F.substr(piece, F.length(name) + F.lit(2))
        return F.coalesce(F.concat(char, rest), F.concat(F.lit("&"), piece))

    pieces = F.split(col, "&")
    after_first = F.slice(pieces, F.lit(2), F.size(pieces))
    return F.when(
        F.contains(col, F.lit("&")),
        F.concat(pieces[0], F.array_join(F.transform(after_first, decoded), "")),
    ).otherwise(col)


def strip_element(col: Column, names: Iterable[str]) -> Column:
    """Remove the named elements' own tags, whatever attributes they have."""
    return F.regexp_replace(col, rf"</?(?:{'|'.join(names)})\b[^>]*>", "")


def strip_markup(col: Column) -> Column:
    """Plain text: all tags removed."""
    return F.regexp_replace(col, r"<[^>]*>", "")


def element_names(col: Column) -> Column:
    """Names of all start tags in the text, in order."""
    return F.regexp_extract_all(col, F.lit(r"<([A-Za-z][\w-]*)"), F.lit(1))


def child_counts(record: Column) -> Column:
    """How often each element occurs as a direct child of a record, as a map. A child is a start tag of
    depth 1, whatever it holds itself: start tags go one deeper, end tags come back, empty ones stay."""
    tags = F.regexp_extract_all(record, F.lit(r"""</?[A-Za-z](?:[^>"']|"[^"]*"|'[^']*')*>"""), F.lit(0))
    start = F.struct(F.lit(0).alias("depth"), F.create_map().cast("map<string,int>").alias("seen"))

    def step(state: Column, tag: Column) -> Column:
        begins, empty = ~tag.startswith("</"), tag.endswith("/>")
        name = F.regexp_extract(tag, r"^<([A-Za-z][\w-]*)", 1)
        counted = F.map_concat(
            F.map_filter(state["seen"], lambda k, _: k != name),
            F.create_map(name, F.coalesce(F.try_element_at(state["seen"], name), F.lit(0)) + 1))
        return F.struct(
            (state["depth"] + F.when(empty, 0).when(begins, 1).otherwise(-1)).alias("depth"),
            F.when(begins & (state["depth"] == 1), counted).otherwise(state["seen"]).alias("seen"))

    return F.aggregate(tags, start, step, lambda state: state["seen"])


def predefined_entities(col: Column) -> Column:
    """Resolve what XML itself defines: five names and numbers. ``&amp;`` goes last, so that what
    it stands for is not read again."""
    number = r"(?s)^#(x[0-9A-Fa-f]{1,6}|[0-9]{1,7});.*$"

    def resolved(piece: Column) -> Column:
        digits = F.regexp_extract(piece, number, 1)
        code = F.when(digits.startswith("x"), F.conv(F.substr(digits, F.lit(2)), 16, 10)).otherwise(
            digits).try_cast("int")
        # Encoded as UTF-32, as chr() only knows Latin-1.
        char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        rest = F.substr(piece, F.locate(";", piece) + 1)
        return F.when((digits != "") & (code <= 0x10FFFF), F.concat(char, rest)).otherwise(
            F.concat(F.lit("&"), piece))

    pieces = F.split(col, "&")
    numbers = F.concat(pieces[0], F.array_join(F.transform(
        F.slice(pieces, F.lit(2), F.size(pieces)), resolved), ""))
    text = F.when(F.contains(col, F.lit("&#")), numbers).otherwise(col)
    for name, char in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("apos", "'"), ("amp", "&")):
        text = F.replace(text, F.lit(f"&{name};"), F.lit(char))
    return text


def attribute(col: Column, element: str, name: str) -> Column:
    """Attribute of the last such element in the text, in quotes of either kind; null if it has
    none."""
    start_tag = F.try_element_at(F.regexp_extract_all(
        col, F.lit(rf"""<{element}\b(?:[^>"']|"[^"]*"|'[^']*')*>"""), F.lit(0)), F.lit(-1))
    quoted = F.regexp_extract(start_tag, rf"""\s{name}\s*=\s*("[^"]*"|'[^']*')""", 1)
    return F.nullif(F.substr(quoted, F.lit(2), F.length(quoted) - 2), F.lit(""))
