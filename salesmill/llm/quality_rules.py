"""Quality rules: a table of thresholds compiled into Spark expressions.

Every measure and every rule is a built-in expression over one text, so the whole table is one
chain of projections in a single stage: no user function, no shuffle, nothing kept between rows.

Words are runs of characters other than space and U+0009..U+000D. A null or blank text has no word:
all measures are 0 and it fails the base rules. Repeated rows are measured alike, each on its own.
Text length is unbounded; memory is a few arrays of one text's words.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmill.llm.common import BLANKS

WINDOW = 8

# Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "the of and to in a is that it for on was be with as by this are at an from or "
    "le la les de des du et en un une que qui pour dans par sur est pas "
    "der die das und von zu den dem im ein eine einen ist nicht mit sich "
    "el los las y del no se para con como una al lo su por"
).split()


@dataclass(frozen=True)
class Rule:
    """A document passes if ``low <= measure <= high``; a bound that is None does not count."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None


#: The base rules decide first; ``RULES`` are asked of what passes them.
BASE = (
    Rule("length", "n_words", low=20),
    Rule("repeated_windows", "repeat_percent", high=30),
)
RULES = (
    Rule("word_length", "mean_word_length", low=2.5, high=12),
    Rule("symbols", "symbols_per_word", high=0.1),
    Rule("stop_words", "stop_word_share", low=0.02),
    Rule("repeated_lines", "duplicate_line_share", high=0.5),
)


def words(text: Column) -> Column:
    """The words of a text as an array; empty for a null or blank text."""
    inner = F.btrim(text, F.lit(BLANKS))
    return F.when(F.length(inner) > 0, F.split(inner, "[ \\x09-\\x0D]+")).otherwise(
        F.array().cast("array<string>")
    )


def with_repeat_words(df: DataFrame, hashes: str, name: str, window: int = WINDOW) -> DataFrame:
    """Add how many words lie in a window whose words occur as a window more than once.

    Windows are compared by a 64-bit hash within one text. Each step is a column of its own, so that
    no lambda computes an array again for each element; only texts with a repeat are sorted.
    """
    n = F.size(hashes)
    width = F.lit(window)
    windows = F.when(
        n >= window,
        F.transform(
            F.sequence(F.lit(1), n - (window - 1)),
            lambda i: F.xxhash64(F.slice(F.col(hashes), i, width)),
        ),
    )
    twice = F.size(F.array_distinct("_windows")) < F.size("_windows")
    order = F.when(
        twice,
        F.sort_array(
            F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        ),
    )

    def neighbour(i: Column) -> Column:
        return F.coalesce(F.get(F.col("_order"), i)["h"], F.lit(None).cast("long"))

    own = F.transform(
        "_order",
        lambda x, i: F.when(
            x["h"].eqNullSafe(neighbour(i - 1)) | x["h"].eqNullSafe(neighbour(i + 1)), x["i"]
        ),
    )
    covered = F.aggregate(
        "_starts",
        F.struct(F.lit(-window).alias("last"), F.lit(0).alias("total")),
        lambda seen, i: F.struct(
            i.alias("last"),
            (seen["total"] + F.least(width, i - seen["last"])).alias("total"),
        ),
        lambda seen: seen["total"],
    )
    return (
        df.withColumn("_windows", windows)
        .withColumn("_order", order)
        .withColumn("_starts", F.sort_array(F.array_compact(own)))
        .withColumn(name, F.coalesce(covered, F.lit(0)).cast("long"))
        .drop("_windows", "_order", "_starts")
    )


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``row`` (the whole input row) with the counts and ratios that the rules ask for."""
    row = docs.select(F.struct("*").alias("row"))
    value = F.coalesce(F.col("row").getField(text), F.lit(""))
    split = row.select(
        "row",
        words(value).alias("words"),
        F.filter(
            F.split(value, "\n", -1), lambda line: F.btrim(line, F.lit(BLANKS)) != ""
        ).alias("lines"),
        F.regexp_count(value, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
    )
    counted = split.select(
        "row",
        F.size("words").cast("long").alias("n_words"),
        F.aggregate("words", F.lit(0).cast("long"), lambda n, w: n + F.length(w)).alias(
            "word_chars"
        ),
        "n_symbols",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("words", lambda w: F.lower(w).isin(STOP_WORDS))).alias("n_stop_words"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
    )
    repeats = with_repeat_words(counted, "hashes", "n_repeat_words")

    def per(total: str, of: str) -> Column:
        return F.coalesce(F.try_divide(F.col(total).cast("double"), F.col(of)), F.lit(0.0))

    return repeats.select(
        "row", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_stop_words",
        "n_repeat_words",
        (per("n_repeat_words", "n_words") * 100).alias("repeat_percent"),
        per("word_chars", "n_words").alias("mean_word_length"),
        per("n_symbols", "n_words").alias("symbols_per_word"),
        per("n_stop_words", "n_words").alias("stop_word_share"),
        per("n_dup_lines", "n_lines").alias("duplicate_line_share"),
    )


def passes(rules: tuple[Rule, ...]) -> Column:
    """The rules as one condition."""
    parts = [F.lit(True)]
    for rule in rules:
        if rule.measure == "repeat_percent":  # whole numbers, so that the limit itself is exact
            parts.append(100 * F.col("n_repeat_words") <= rule.high * F.col("n_words"))
            continue
        if rule.low is not None:
            parts.append(F.col(rule.measure) >= rule.low)
        if rule.high is not None:
            parts.append(F.col(rule.measure) <= rule.high)
    condition = parts[0]
    for part in parts[1:]:
        condition = condition & part
    return condition


def judge(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``measures`` with ``base_failed`` and ``kept``."""
    judged = measures(docs, text).withColumn("base_failed", ~passes(BASE))
    return judged.withColumn("kept", ~F.col("base_failed") & passes(rules))


def keep(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` that pass, with their columns as they are.

    The condition asks for a number that Spark gives out row by row, so that it stays behind the
    measures. Moved before them it would hold each of them in full, arrays inside lambdas included.
    """
    judged = judge(docs, text, rules).withColumn("at", F.monotonically_increasing_id())
    return judged.where(F.col("kept") & (F.col("at") >= 0)).select("row.*")


# Fixed values shared with the expressions above.
_BLANK_CLASS = "[ \\x09-\\x0D]"
_STOP_SQL = ", ".join(f"'{w}'" for w in STOP_WORDS)

SQL = f"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS row_no FROM documents
), split AS (
  SELECT row_no, doc_id, t,
         list_filter(regexp_split_to_array(t, '{_BLANK_CLASS}+'), lambda w: w <> '') AS words,
         list_filter(string_split(t, chr(10)),
                     lambda l: regexp_matches(l, '[^ \\x09-\\x0D]')) AS lines
  FROM texts
), windows AS (
  SELECT row_no, i AS pos, array_to_string(words[i:i + {WINDOW - 1}], ' ') AS win
  FROM (SELECT row_no, words, unnest(range(1, len(words) - {WINDOW - 2})) AS i
        FROM split WHERE len(words) >= {WINDOW})
), twice AS (
  SELECT row_no, win FROM windows GROUP BY row_no, win HAVING count(*) > 1
), covered AS (
  SELECT row_no, count(DISTINCT pos + k) AS n_repeat_words
  FROM windows JOIN twice USING (row_no, win), range(0, {WINDOW}) AS r(k)
  GROUP BY row_no
), counted AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(words, lambda w: length(w))), 0) AS BIGINT)
           AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT)
           AS n_symbols,
         CAST(len(lines) AS BIGINT) AS n_lines,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         len(list_filter(words, lambda w: lower(w) IN ({_STOP_SQL}))) AS n_stop_words,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM split LEFT JOIN covered USING (row_no)
), based AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counted
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed
       AND word_chars / n_words BETWEEN 2.5 AND 12
       AND n_symbols / n_words <= 0.1
       AND n_stop_words / n_words >= 0.02
       AND (n_lines = 0 OR n_dup_lines / n_lines <= 0.5) AS kept
FROM based
"""
