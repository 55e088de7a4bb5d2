"""Quality rules: a table of thresholds compiled into one projection.

Every measure is a column expression over built-in functions, every rule a row (measure, least,
most); ``verdict`` joins them into one condition. Nothing is shuffled and no Python runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD_BREAK
from .stopwords import ALL

#: measure, least, most (None: no bound). Ratios are per word, or per line for lines.
THRESHOLDS: list[tuple[str, float | None, float | None]] = [
    ("n_words", 10, None),
    ("mean_word_chars", 2.0, 15.0),
    ("symbol_ratio", None, 0.10),
    ("stop_word_ratio", 0.05, None),
    ("capital_word_ratio", None, 0.50),
    ("dup_line_ratio", None, 0.50),
]
WINDOW = 5


def _split(df: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    df = df.withColumn("_t", text).withColumn("_words", F.array_remove(F.split("_t", WORD_BREAK), ""))
    lines = F.filter(F.split("_t", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return df.withColumn("_lines", lines)


def _repeats(df: DataFrame) -> DataFrame:
    """Words inside windows of five that occur twice or more.

    Windows are compared by 64-bit hashes. Sorted by (hash, position), a window is repeated if a
    neighbour has its hash; repeated windows' positions then cover up to five words each.
    """
    n = F.size("_words")
    windows = F.when(n >= WINDOW, F.expr(
        "transform(sequence(0, size(_words) - 5), i -> xxhash64(get(_words, i), get(_words, i + 1),"
        " get(_words, i + 2), get(_words, i + 3), get(_words, i + 4)))"))
    df = df.withColumn("_win", windows)
    some = F.size(F.array_distinct("_win")) < F.size("_win")
    df = df.withColumn("_sorted", F.when(some, F.expr("sort_array(transform(_win, (h, i) -> struct(h, i)))")))
    df = df.withColumn("_at", F.expr(
        "sort_array(transform(filter(_sorted, (x, j) -> coalesce(x.h = get(_sorted, j - 1).h, false)"
        " or coalesce(x.h = get(_sorted, j + 1).h, false)), x -> x.i))"))
    return df.withColumn("n_repeat_words", F.coalesce(F.expr(
        "aggregate(transform(_at, (p, j) -> least(5, coalesce(get(_at, j + 1) - p, 5))), 0L, (s, x) -> s + x)"), F.lit(0)).cast("long"))


def measured(docs: DataFrame, stop_words: list[str] = ALL) -> DataFrame:
    """All columns of docs with the measures the rules use. Null texts count as empty."""
    df = _repeats(_split(docs))
    n = F.size("_words").cast("long")
    some, lines = F.greatest(n, F.lit(1)), F.size("_lines")
    plain = F.filter(F.split(F.lower("_t"), r"[^\p{L}]+"), lambda w: w.isin(*stop_words))
    return df.withColumns({
        "n_words": n,
        "word_chars": F.length(F.array_join("_words", "")).cast("long"),
        "n_symbols": F.regexp_count("_t", F.lit(r"[#*$%&|<>]")).cast("long"),
        "n_dup_lines": (lines - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_stop_words": F.size(plain).cast("long"),
        "n_capital_words": F.regexp_count("_t", F.lit(r"\p{Lu}{2,}")).cast("long"),
    }).withColumns({
        "mean_word_chars": F.col("word_chars") / some,
        "symbol_ratio": F.col("n_symbols") / some,
        "stop_word_ratio": F.col("n_stop_words") / some,
        "capital_word_ratio": F.col("n_capital_words") / some,
        "dup_line_ratio": F.col("n_dup_lines") / F.greatest(lines, F.lit(1)),
    }).drop("_t", "_words", "_lines", "_win", "_sorted", "_at")


def verdict(thresholds: list[tuple[str, float | None, float | None]] = THRESHOLDS) -> Column:
    """True where all measures lie within their bounds."""
    passed = F.lit(True)
    for name, least, most in thresholds:
        if least is not None:
            passed = passed & (F.col(name) >= least)
        if most is not None:
            passed = passed & (F.col(name) <= most)
    return passed


def judge(docs: DataFrame, thresholds=THRESHOLDS, stop_words: list[str] = ALL) -> DataFrame:
    """Documents with measures, ``base_failed`` and ``kept``.

    A null, empty or blank text fails; rows that repeat are judged each; extra columns stay and
    the measures take the place of columns with their names. An empty table gives no row.
    """
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return measured(docs, stop_words).withColumn("base_failed", failed).withColumn("kept", ~failed & verdict(thresholds))


def oracle(stop_words: list[str] = ALL) -> str:
    """The contract's columns in DuckDB SQL."""
    listed = ", ".join(f"'{w}'" for w in stop_words)
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
         len(list_filter(regexp_extract_all(lower(t), '\p{{L}}+'), lambda x: list_contains([{listed}], x))) AS stops,
         len(regexp_extract_all(t, '\p{{Lu}}{{2,}}')) AS caps
  FROM d),
win AS (
  SELECT doc_id, i, array_to_string(list_slice(words, i, i + 4), ' ') AS h
  FROM w, unnest(range(1, len(words) - 3)) AS r(i) WHERE len(words) >= 5),
rep AS (
  SELECT doc_id, i, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, 5) AS gap
  FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, h) AS n FROM win) WHERE n > 1),
cov AS (SELECT doc_id, sum(least(5, gap)) AS n_repeat_words FROM rep GROUP BY doc_id),
m AS (
  SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, len(lines) AS n_lines, stops, caps
  FROM w LEFT JOIN cov USING (doc_id)),
f AS (SELECT *, greatest(n_words, 1) AS k, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND n_words >= 10 AND word_chars / k >= 2 AND word_chars / k <= 15
       AND n_symbols / k <= 0.1 AND stops / k >= 0.05 AND caps / k <= 0.5
       AND n_dup_lines / greatest(n_lines, 1) <= 0.5 AS kept
FROM f"""
