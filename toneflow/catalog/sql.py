"""SQL fragments shared by the reference queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"[\s\p{Z}\x1c-\x1f\x85]+"


def r6(column: Column | str, places: int = 6) -> Column:
    """Rounded for comparison; adding zero turns -0.0 into 0.0."""
    column = F.col(column) if isinstance(column, str) else column
    return F.bround(column, places) + F.lit(0.0)


def rounded(columns: Sequence[str], places: int = 6) -> str:
    return ", ".join(f"round_even({c}, {places}) + 0.0 AS {c}" for c in columns)


def quoted(words: Sequence[str]) -> str:
    return ", ".join(f"'{w}'" for w in words)


EVENTS = """ev AS (
  SELECT CAST(event_id AS VARCHAR) AS hash, ts AS published_at, 'U' || user_id AS ticker,
         CASE WHEN event_type IN ('purchase', 'signup') THEN 'positive'
              WHEN event_type = 'error' THEN 'negative' ELSE 'neutral' END AS weak_label,
         value, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k
  FROM events)"""

ORDERS = """ev AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS hash, o_orderdate AS published_at,
         o_orderpriority AS ticker,
         CASE o_orderstatus WHEN 'F' THEN 'positive' WHEN 'O' THEN 'negative'
              ELSE 'neutral' END AS weak_label
  FROM orders)"""

SCORE = """CAST(CASE weak_label WHEN 'negative' THEN -1 WHEN 'positive' THEN 1 ELSE 0 END AS DOUBLE)"""

_DAILY = f"""daily AS (
  SELECT CAST(published_at AS DATE) AS date, ticker, avg({SCORE}) AS mean_score,
         avg(CAST(weak_label = 'positive' AS INT)) AS pct_pos,
         avg(CAST(weak_label = 'negative' AS INT)) AS pct_neg,
         count(*) AS article_count,
         CASE WHEN count(*) > 1 THEN stddev_pop({SCORE}) ELSE 0.0 END AS tone_volatility
  FROM ev GROUP BY 1, 2)"""


def daily(base: str = EVENTS) -> str:
    return f"{base}, {_DAILY}"


def trend(window: int, base: str = EVENTS) -> str:
    frame = f"PARTITION BY ticker ORDER BY date ROWS BETWEEN {window - 1} PRECEDING AND CURRENT ROW"
    return f"""{daily(base)}, framed AS (
  SELECT *, avg(mean_score) OVER ({frame}) AS rolling_mean,
         stddev_pop(mean_score) OVER ({frame}) AS sd, count(*) OVER ({frame}) AS n_frame
  FROM daily), trend AS (
  SELECT *, CASE WHEN n_frame >= 2 THEN (mean_score - rolling_mean) / (sd + 1e-6) END AS rolling_z
  FROM framed)"""


DAILY_COLUMNS = "date, ticker, article_count, " + rounded(
    ("mean_score", "pct_pos", "pct_neg", "tone_volatility"))
TREND_COLUMNS = DAILY_COLUMNS + ", " + rounded(("rolling_mean", "rolling_z"))


def alerts(threshold: float) -> str:
    return f"""SELECT date, ticker,
  CASE WHEN rolling_z > 0 THEN 'spike_positive' ELSE 'spike_negative' END AS alert_type,
  round_even(rolling_z, 6) + 0.0 AS z_value FROM trend WHERE abs(rolling_z) >= {threshold}"""


WIDE = f"""{EVENTS}, wide AS (
  SELECT CAST(hash AS BIGINT) AS row_id, weak_label AS true_label,
    CASE WHEN k % 5 = 0 THEN 'neutral' ELSE weak_label END AS a_prediction,
    round(0.5 + k / 200.0, 6) AS a_confidence,
    CASE WHEN k % 3 = 0 THEN 'positive' WHEN k % 7 = 0 THEN 'negative' ELSE weak_label END
      AS b_prediction,
    round(0.4 + k / 250.0, 6) AS b_confidence,
    CASE WHEN k % 2 = 0 THEN 'neutral' WHEN k % 13 = 1 THEN 'love'
         WHEN k % 11 = 0 THEN 'negative' ELSE weak_label END AS c_prediction,
    round(0.3 + k / 300.0, 6) AS c_confidence
  FROM ev), long AS (
  SELECT row_id, 'a' AS model, true_label, a_prediction AS pred, a_confidence AS confidence FROM wide
  UNION ALL SELECT row_id, 'b', true_label, b_prediction, b_confidence FROM wide
  UNION ALL SELECT row_id, 'c', true_label, c_prediction, c_confidence FROM wide)"""

SCORES = f"""{WIDE}, sides AS (
  SELECT model, true_label AS label, 1 AS support, 0 AS predicted,
         CAST(pred = true_label AS INT) AS hit FROM long
  UNION ALL SELECT model, pred, 0, 1, 0 FROM long), scores AS (
  SELECT model, label,
    CASE WHEN sum(predicted) = 0 THEN 0.0 ELSE sum(hit) / sum(predicted) END AS precision,
    CASE WHEN sum(support) = 0 THEN 0.0 ELSE sum(hit) / sum(support) END AS recall,
    2.0 * sum(hit) / (sum(predicted) + sum(support)) AS f1,
    CAST(sum(support) AS BIGINT) AS support
  FROM sides GROUP BY 1, 2)"""

GOLD = """gold AS (
  SELECT doc_id, CASE WHEN toxic = 1 THEN 'negative' WHEN quality = 1 THEN 'positive'
                      ELSE 'neutral' END AS label FROM labels)"""

RAW = rf"""raw AS (
  SELECT doc_id, 'R' || (length(text) % 3) AS request, doc_id // 100 AS page_no, lang AS source,
         regexp_extract(text, '^([^.]*)', 1) AS title,
         CASE WHEN doc_id % 7 <> 0 THEN regexp_extract(text, '^[^.]*\.([^.]*)', 1) END AS description,
         text AS content, 'http://news.example/' || doc_id AS url,
         CASE WHEN doc_id % 50 = 7 THEN 'not a date' ELSE
           '2024-01-' || lpad(CAST(length(text) % 28 + 1 AS VARCHAR), 2, '0') || 'T'
           || lpad(CAST(doc_id % 24 AS VARCHAR), 2, '0') || ':00:00Z' END AS published
  FROM documents), keyed AS (
  SELECT *, sha256(regexp_replace(lower(title), '\A{SPACE}|{SPACE}\z', '', 'g') || '|'
                   || lower(source) || '|' || substr(published, 1, 10)) AS hash,
         CASE WHEN published <> 'not a date' THEN
           strptime(published, '%Y-%m-%dT%H:%M:%SZ') END AS published_at
  FROM raw), firsts AS (
  SELECT * FROM keyed
  QUALIFY row_number() OVER (PARTITION BY request, hash ORDER BY doc_id) = 1)"""


def unescape(expr: str) -> str:
    """Enough for the entities of the test tables; the ampersand comes last."""
    for name, char in (("&quot;", '"'), ("&middot;", "·"), ("&copy;", "©")):
        expr = f"replace({expr}, '{name}', '{char}')"
    return f"regexp_replace({expr}, '&amp;?', '&', 'g')"


def strip_tags(expr: str) -> str:
    return f"regexp_replace({expr}, '<[^>]+>', ' ', 'g')"


def plain_quotes(expr: str) -> str:
    return f"translate({expr}, '’‘“”', '''''\"\"')"


def drop_prefixes(expr: str) -> str:
    expr = rf"regexp_replace({expr}, '(?i)\(Reuters\) ?- ?', '', 'g')"
    return rf"regexp_replace({expr}, '(?i)\(Bloomberg\) ?--? ?', '', 'g')"


def collapse(expr: str) -> str:
    return f"trim(regexp_replace({expr}, '{SPACE}', ' ', 'g'))"


def clean(expr: str) -> str:
    return collapse(drop_prefixes(plain_quotes(strip_tags(unescape(expr)))))


def hits(expr: str, words: Sequence[str]) -> str:
    """Number of lower-case Latin tokens of ``expr`` that are listed."""
    tokens = f"list_transform(regexp_extract_all({expr}, '[A-Za-z'']+'), lambda w: lower(w))"
    return f"len(list_filter({tokens}, lambda w: list_contains([{quoted(words)}], w)))"


def lexicon_score(expr: str, positive: Sequence[str], negative: Sequence[str]) -> str:
    p, n = hits(expr, positive), hits(expr, negative)
    return f"CASE WHEN {p} + {n} = 0 THEN 0.0 ELSE ({p} - {n}) / CAST({p} + {n} AS DOUBLE) END"


def label_of(score: str) -> str:
    return (f"CASE WHEN {score} > 0.2 THEN 'positive' WHEN {score} < -0.2 THEN 'negative' "
            "ELSE 'neutral' END")


def grams(source: str, keys: str, expr: str) -> str:
    """Words and trigrams of a text, one row each."""
    return rf"""SELECT {keys}, unnest(list_concat(list_transform(w, lambda x: '=' || x),
    list_transform(list_filter(range(1, len(c) - 1), lambda i: c[i + 1] <> ' '), lambda i: c[i] || c[i + 1] || c[i + 2]))) AS gram
  FROM (SELECT {keys}, w, regexp_extract_all(' ' || array_to_string(w, ' ') || ' ', '.') AS c
    FROM (SELECT {keys}, regexp_extract_all(lower({expr}), '\p{{L}}+') AS w FROM {source}))"""


def profile(where: str = "TRUE") -> str:
    """Weights of all grams of the documents, or of some."""
    return f"""counted AS (
  SELECT lang AS code, gram, count(*) AS n FROM ({grams(f"(SELECT * FROM documents WHERE {where})", "lang", "text")}) GROUP BY ALL),
totals AS (SELECT code, sum(n) AS total, (SELECT count(DISTINCT gram) FROM counted) AS v FROM counted GROUP BY code),
profile AS (
  SELECT g.gram, code, coalesce(n, 0) AS n, CAST(round(1000 * ln((coalesce(n, 0) + 0.5) / (total + 0.5 * v))) AS BIGINT) AS weight
  FROM (SELECT DISTINCT gram FROM counted) g CROSS JOIN totals LEFT JOIN counted USING (gram, code))"""


def detect(source: str, keys: str, expr: str) -> str:
    """Body of a table (keys, language) by the highest sum of weights; ties in code order."""
    return f"""SELECT {keys}, coalesce(code, 'unknown') AS language FROM {source} LEFT JOIN (
    SELECT {keys}, code FROM (
      SELECT {keys}, code, sum(weight) AS score FROM ({grams(source, keys, expr)}) JOIN profile USING (gram) GROUP BY ALL)
    QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY score DESC, code) = 1) USING ({keys})"""
