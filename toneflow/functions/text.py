"""Text cleaning, keys, tagging and tokens."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from toneflow.functions import bind
from toneflow.functions.html import unescape

# Whitespace in the Unicode sense, spelled out because Java's \s is ASCII only.
SPACE = r"[\s\p{Z}\x1c-\x1f\x85]"

# Wire-service prefixes that are dropped wherever they occur.
WIRE_PREFIXES = (r"\(Reuters\) ?- ?", r"\(Bloomberg\) ?--? ?")

# Typographic quotes and their plain forms.
CURLY_QUOTES, PLAIN_QUOTES = "’‘“”", "''\"\""

WORD = r"[A-Za-z']+"


def _only_with(mark: str, text: Column, changed: Column) -> Column:
    """``changed`` where ``mark`` occurs; a substring search is cheaper than a pattern."""
    return F.when(F.contains(text, F.lit(mark)), changed).otherwise(text)


def strip_tags(text: Column) -> Column:
    return bind(text, lambda t: _only_with("<", t, F.regexp_replace(t, r"<[^>]+>", " ")))


def straighten_quotes(text: Column) -> Column:
    for curly, plain in zip(CURLY_QUOTES, PLAIN_QUOTES):
        text = F.replace(text, F.lit(curly), F.lit(plain))
    return text


def drop_wire_prefixes(text: Column) -> Column:
    def dropped(value: Column) -> Column:
        for prefix in WIRE_PREFIXES:
            value = F.regexp_replace(value, f"(?iu){prefix}", "")
        return value

    return bind(text, lambda t: _only_with("(", t, dropped(t)))


def collapse_space(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, f"{SPACE}+", " "))


def strip_space(text: Column) -> Column:
    """Trim all Unicode whitespace, not just blanks."""
    return F.regexp_replace(text, rf"\A{SPACE}+|{SPACE}+\z", "")


def clean_text(text: Column) -> Column:
    """Entities, tags, quotes, wire prefixes and whitespace, in this order."""
    return collapse_space(drop_wire_prefixes(straighten_quotes(strip_tags(unescape(text)))))


def join_fields(*fields: Column) -> Column:
    """Blank-separated concatenation that skips null and empty parts."""
    return F.concat_ws(" ", *[F.nullif(f, F.lit("")) for f in fields])


def labelling_text(title: Column, description: Column) -> Column:
    """Text given to the labeller; two missing fields leave a single full stop."""
    empty = F.lit("")
    return strip_space(F.concat(F.coalesce(title, empty), F.lit(". "), F.coalesce(description, empty)))


def scoring_text(title: Column, description: Column) -> Column:
    """Text given to a model; empty when there is nothing to score."""
    empty = F.lit("")
    return strip_space(F.concat_ws(" ", F.coalesce(title, empty), F.coalesce(description, empty)))


def or_default(value: Column, default: str = "") -> Column:
    return F.coalesce(value, F.lit(default))


def article_key(title: Column, source: Column, published: Column) -> Column:
    """SHA-256 over normalised title, source and calendar day."""
    base = F.concat_ws(
        "|",
        strip_space(F.lower(or_default(title))),
        F.lower(or_default(source, "unknown")),
        F.substring(or_default(published), 1, 10),
    )
    return F.sha2(base, 256)


def whole_words(text: Column) -> Column:
    """Lower-case runs of letters and digits in any script."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def tag_tickers(text: Column, tickers: Sequence[str] | Column, words_only: bool = False) -> Column:
    """Those of ``tickers`` that occur in ``text``, regardless of case.

    Plain containment by default; ``words_only`` asks for a match between
    word boundaries, which short symbols need.
    """
    wanted = tickers if isinstance(tickers, Column) else F.array(*[F.lit(t) for t in tickers])
    wanted = F.filter(wanted, lambda t: t.isNotNull())
    if words_only:
        return bind(whole_words(text), lambda ws: F.filter(wanted, lambda t: F.array_contains(ws, F.lower(t))))
    return bind(F.lower(text), lambda low: F.filter(wanted, lambda t: F.contains(low, F.lower(t))))


def tokens(text: Column) -> Column:
    """Lower-case runs of Latin letters and apostrophes."""
    found = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    return F.transform(found, lambda w: F.lower(w))


def shorten(text: Column, width: int = 100) -> Column:
    """First ``width`` characters for display, with dots when cut."""
    return F.when(F.length(text) > width, F.concat(F.substring(text, 1, width), F.lit("..."))) \
        .otherwise(text)


def query_terms(company: str, ticker: str = "", keywords: Sequence[str] = ()) -> list[str]:
    """Distinct search terms of a request: company, ticker, stripped keywords."""
    terms = [company, *([ticker] if ticker else []), *(k.strip() for k in keywords if k.strip())]
    return list(dict.fromkeys(terms))


def mentions_any(terms: Sequence[str] | Column, *fields: Column) -> Column:
    """True when one of the terms occurs in the joined fields, regardless of case."""
    wanted = terms if isinstance(terms, Column) else F.array(*[F.lit(t) for t in terms])
    return bind(F.lower(join_fields(*fields)),
                lambda low: F.exists(wanted, lambda t: F.contains(low, F.lower(t))))
