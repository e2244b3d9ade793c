"""Decoding of HTML character references as one native expression."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from toneflow.functions import bind

# Frequent names stand first: a map lookup walks the keys in order.
FREQUENT = ("amp;", "quot;", "nbsp;", "lt;", "gt;", "apos;", "rsquo;", "lsquo;", "rdquo;",
            "ldquo;", "mdash;", "ndash;", "hellip;", "copy;", "reg;", "middot;", "euro;")

# A reference, a run of text without ampersands, or a lone ampersand.
NUMBER = r"&#(?:[0-9]+|[xX][0-9a-fA-F]+);?"
NAME = r"&[^\t\n\f <&#;]{1,32};?"
PIECES = rf"{NUMBER}|{NAME}|[^&]+|&"


def _names() -> Column:
    ordered = {name: html5[name] for name in FREQUENT} | html5
    return F.from_json(F.lit(json.dumps(ordered)), "map<string,string>")


def _legacy_prefix() -> str:
    """Names that count without a semicolon, longest first."""
    bare = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
    return "^&(" + "|".join(bare) + ")"


def _windows_1252() -> str:
    """Characters that code points 128 to 159 stand for: Windows-1252 where it has one."""
    return "".join(
        bytes([code]).decode("cp1252", errors="ignore") or chr(code) for code in range(0x80, 0xA0))


def _character(code: Column) -> Column:
    """Text of a code point; decimal input so that any digit count fits."""
    point = code.try_cast("int")
    utf32 = F.unhex(F.lpad(F.hex(point), 8, "0"))
    low = F.substr(F.lit(_windows_1252()), point - 0x7F, F.lit(1))
    replacement = F.lit("�")
    nothing = (
        point.between(0x1, 0x8) | (point == 0xB) | point.between(0xE, 0x1F) | (point == 0x7F)
        | point.between(0xFDD0, 0xFDEF) | (point.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE)
    )
    return (
        F.when(code.isNull() | (code > 0x10FFFF) | (code == 0), replacement)
        .when(code.between(0xD800, 0xDFFF), replacement)
        .when(code.between(0x80, 0x9F), low)
        .when(nothing, F.lit(""))
        .otherwise(F.decode(utf32, "UTF-32"))
    )


def _decode_number(piece: Column) -> Column:
    digits = F.regexp_extract(piece, r"^&#(?:[xX])?0*([0-9a-fA-F]*)", 1)
    is_hex = F.substring(piece, 3, 1).isin("x", "X")
    base16 = F.conv(F.when(F.length(digits) > 8, "FFFFFFFF").otherwise(digits), 16, 10)
    base10 = F.when(F.length(digits) > 10, "4294967295").otherwise(digits)
    code = F.when(digits == "", F.lit("0")).when(is_hex, base16).otherwise(base10).cast("bigint")
    return bind(code, _character)


def _decode_name(piece: Column, names: Column) -> Column:
    whole = F.try_element_at(names, F.substr(piece, F.lit(2)))
    prefix = F.regexp_extract(piece, _legacy_prefix(), 1)
    by_prefix = F.concat(F.try_element_at(names, prefix), F.substr(piece, F.length(prefix) + 2))
    return F.when(whole.isNotNull(), whole).when(prefix != "", by_prefix).otherwise(piece)


def unescape(text: Column) -> Column:
    """Replace character references in one pass (``&amp;lt;`` becomes ``&lt;``).

    Covers every HTML5 name, the old names without a semicolon, and decimal
    and hexadecimal references.  Text without an ampersand is left alone.
    """
    def decode(piece: Column, names: Column) -> Column:
        return (
            F.when(~F.startswith(piece, F.lit("&")), piece)
            .when(F.rlike(piece, F.lit(f"^{NUMBER}$")), _decode_number(piece))
            .when(F.length(piece) > 1, _decode_name(piece, names))
            .otherwise(piece)
        )

    def decoded(value: Column) -> Column:
        pieces = F.regexp_extract_all(value, F.lit(PIECES), F.lit(0))
        whole = bind(_names(), lambda names: F.array_join(
            F.transform(pieces, lambda piece: decode(piece, names)), ""))
        return F.when(F.contains(value, F.lit("&")), whole).otherwise(value)

    return bind(text, decoded)
