"""Text clean-up for table cells and column names."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's ``str.strip`` also removes the non-breaking space; ``trim`` does not.
_EDGE_BLANK = "^[\\s\\u00a0]+|[\\s\\u00a0]+$"

# All named character references of the HTML standard that end with a semicolon.
_NAMED_REFERENCES = {name[:-1]: char for name, char in html5.items() if name.endswith(";")}
# Replaced as plain strings; none of their characters can be part of a reference.
_USUAL = ["nbsp", "lt", "gt", "quot", "apos", "minus", "ndash", "mdash"]


def strip_blank(c: Column) -> Column:
    return F.regexp_replace(c, _EDGE_BLANK, "")


def _code_point(digits: Column, base: int) -> Column:
    number = F.conv(digits, base, 16)
    return F.decode(F.unhex(F.lpad(number, 8, "0")), "UTF-32")


def decode_entities(c: Column) -> Column:
    """Character references, numeric and named, to characters, each once.

    The usual ones are replaced as they stand.  Only a text with others is cut at each
    ``&``; a piece that begins with a reference loses it and gains the character, any other
    piece gets its ``&`` back.
    """
    # one literal, folded into a map before the query runs; thousands would slow its planning
    names = F.from_json(F.lit(json.dumps(_NAMED_REFERENCES)), "map<string,string>")

    def piece(part: Column) -> Column:
        dec = F.regexp_extract(part, "^#([0-9]{1,7});", 1)
        hexa = F.regexp_extract(part, "^#[xX]([0-9a-fA-F]{1,6});", 1)
        name = F.regexp_extract(part, "^([A-Za-z][A-Za-z0-9]*);", 1)
        rest = F.regexp_replace(part, "^[#A-Za-z0-9]+;", "")
        char = F.when(name == "amp", "&").when(name != "", F.try_element_at(names, name))
        return (
            F.when(dec != "", F.concat(_code_point(dec, 10), rest))
            .when(hexa != "", F.concat(_code_point(hexa, 16), rest))
            .when(char.isNotNull(), F.concat(char, rest))
            .otherwise(F.concat(F.lit("&"), part))
        )

    def others(text: Column) -> Column:
        parts = F.split(text, "&", -1)
        rest = F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0)))
        decoded = F.concat(F.element_at(parts, 1), F.array_join(F.transform(rest, piece), ""))
        plain = F.replace(text, F.lit("&amp;"), F.lit("&"))
        left = F.replace(text, F.lit("&amp;"), F.lit(""))
        return F.when(left.contains("&"), decoded).otherwise(plain)

    usual = c
    for name in _USUAL:
        usual = F.replace(usual, F.lit(f"&{name};"), F.lit(_NAMED_REFERENCES[name]))
    # a lambda's argument is worked out once, however often it is named
    return F.get(F.transform(F.array(usual), others), F.lit(0))


def normalise_name(c: Column | str) -> Column:
    """Line item to column name: ``OPM %`` is ``opm_percent``, ``Sales +`` is ``sales``.

    Non-breaking spaces count as spaces, and underscores that only stand for a
    blank before a dropped sign go too.
    """
    text = F.col(c) if isinstance(c, str) else c
    text = F.translate(F.lower(strip_blank(text)), " \u00a0+", "__")
    text = F.replace(text, F.lit("%"), F.lit("percent"))
    return F.regexp_replace(text, "_+$", "")
