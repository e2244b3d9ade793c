"""Landed feed pages to article table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from toneflow.functions import dates, text
from toneflow.operators import articles
from toneflow.operators.language import detect_language
from toneflow.schemas import Request


ARTICLE_COLUMNS = ("request", "hash", "source", "title", "description", "content",
                   "published_at", "url", "language", "tickers", "raw")


def title() -> Column:
    return text.or_default(F.col("raw.title"))


def source() -> Column:
    return text.or_default(F.col("raw.source.name"), "unknown")


def stamp() -> Column:
    return text.or_default(F.col("raw.publishedAt"))


def with_key(raw: DataFrame) -> DataFrame:
    """Add the article key; the payload stays in ``raw``, so rows stay narrow.

    Pages without a request belong to the request with an empty name.
    """
    return raw.withColumns({"request": F.coalesce("request", F.lit("")),
                            "hash": text.article_key(title(), source(), stamp())})


def with_fields(df: DataFrame) -> DataFrame:
    """Unpack the payload, with defaults for what may be missing."""
    return df.withColumns({
        "title": title(),
        "source": source(),
        "description": F.col("raw.description"),
        "content": F.col("raw.content"),
        "url": F.col("raw.url"),
    })


def in_detected_language(df: DataFrame, profile: DataFrame, language: str = "en") -> DataFrame:
    """Keep articles whose title and description are in ``language``.

    ``df`` has one row per request and key and is still dealt out by them after
    deduplication, as are the languages found, so the payload is not shuffled
    again.
    """
    small = text.join_fields(title(), F.col("raw.description"))
    keys = ["request", "hash"]
    return df.join(detect_language(df, keys, small, profile).where(F.col("language") == language), keys)


def with_tickers(df: DataFrame, tickers: Sequence[str] | Column | None = None,
                 words_only: bool = False) -> DataFrame:
    """Tag from the cleaned text; by default only the requested ticker is looked for.

    The stored fields stay raw.
    """
    wanted = F.array("request") if tickers is None else tickers
    whole = text.join_fields(F.col("title"), F.col("description"), F.col("content"))
    return df.withColumn("tickers", text.tag_tickers(text.clean_text(whole), wanted, words_only))


def with_time(df: DataFrame) -> DataFrame:
    """Parse the publish time; rows without one are dropped."""
    return articles.with_parsed_time(df.withColumn("_stamp", stamp()), "_stamp").drop("_stamp")


def accept(df: DataFrame, profile: DataFrame, language: str = "en") -> DataFrame:
    """Language and timestamp filters, in this order after deduplication."""
    return with_time(in_detected_language(df, profile, language))


def ingest(raw: DataFrame, profile: DataFrame, language: str = "en", max_articles: int | None = None,
           tickers: Sequence[str] | None = None) -> DataFrame:
    """Articles of all requests in one job.

    Duplicates are removed before the filters, so a rejected first copy also
    removes the later ones.  All accepted articles are kept unless
    ``max_articles`` limits their number per request.
    """
    arrival = ["page_no", "pos"]
    unique = articles.first_arrivals(with_key(raw), ["request", "hash"], arrival)
    accepted = accept(unique, profile, language)
    if max_articles is not None:
        accepted = articles.first_accepted(accepted, max_articles, arrival)
    return with_tickers(with_fields(accepted), tickers).select(*ARTICLE_COLUMNS)


def ingest_request(raw: DataFrame, request: Request, profile: DataFrame) -> DataFrame:
    """Articles of one request: its pages, its time window, its search terms.

    Window bounds are inclusive; articles whose time does not parse are left to
    the later filter.
    """
    pages = raw.where(F.col("request") == request.ticker)
    published = dates.parse_iso(stamp())
    for bound, outside in ((request.from_date, published.__lt__), (request.to_date, published.__gt__)):
        if bound is not None:
            pages = pages.where(~F.coalesce(outside(F.lit(bound).cast("timestamp")), F.lit(False)))
    terms = text.query_terms(request.company, request.ticker, request.keywords)
    fields = [F.col(f"raw.{f}") for f in ("title", "description", "content")]
    return ingest(pages.where(text.mentions_any(terms, *fields)), profile,
                  request.language, request.max_articles)
