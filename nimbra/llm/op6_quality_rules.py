"""Quality rules as a short-circuit cascade, in DataFrame functions alone.

Every rule is a condition that rejects a document. On a sample of stated size each
rule's cost (seconds beyond a plain scan) and the share that it rejects are measured;
rules run in descending order of rejection per cost, and the first that holds ends
the work on a document. The order changes the time taken, never a verdict.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from nimbra.llm.common import WORD_SPACE, materialize, table

# --- values fixed by the contract of the operator ---
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50

# --- values of the cascade ---
#: Expected rows of the sample on which the rules are measured.
SAMPLE_ROWS = 2000
MOST_SYMBOLS_PER_WORD = 0.1
MOST_CAPITALS_SHARE = 0.3
MOST_MARKS_PER_WORD = 0.5
MOST_DUPLICATE_LINES_SHARE = 0.6
WORD_LENGTHS = (2.0, 15.0)

SPACE_CHARACTERS = " \t\n\x0b\f\r"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _without(column: Column, characters: str) -> Column:
    return F.translate(column, characters, "")


def _count_of(column: Column, characters: str) -> Column:
    return (F.length(column) - F.length(_without(column, characters))).cast("long")


def words(text: Column) -> Column:
    """The words of a text, in order."""
    return F.array_remove(F.split(text, WORD_SPACE), "")


def n_dup_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda line: F.length(_without(line, SPACE_CHARACTERS)) > 0)
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def n_repeat_words(words_col: str) -> Column:
    """Words in windows of three that occur twice or more, from a column of words.

    Windows are sorted by a 64-bit hash; neighbours of one hash are compared word by
    word. Positions of repeated windows, in order, cover 3 words each less what the
    next one overlaps.
    """
    w = F.col(words_col)
    at = lambda array, i: F.get(array, i)
    windows = F.slice(
        F.transform(
            w,
            lambda word, i: F.struct(
                F.xxhash64(word, at(w, i + 1), at(w, i + 2)).alias("h"), i.alias("i")
            ),
        ),
        1,
        F.greatest(F.size(w) - 2, F.lit(0)),
    )

    def same(a: Column, b: Column) -> Column:
        words_equal = F.lit(True)
        for k in range(3):
            words_equal = words_equal & (at(w, a["i"] + k) == at(w, b["i"] + k))
        return (a["h"] == b["h"]) & words_equal

    def positions(ordered: Column) -> Column:
        found = F.transform(
            ordered,
            lambda x, j: F.when(
                F.coalesce(same(x, at(ordered, j + 1)), F.lit(False))
                | F.coalesce(same(x, at(ordered, F.when(j > 0, j - 1))), F.lit(False)),
                x["i"],
            ),
        )
        return F.sort_array(F.array_compact(found))

    def covered(places: Column) -> Column:
        steps = F.transform(places, lambda p, j: F.coalesce(F.least(at(places, j + 1) - p, F.lit(3)), F.lit(3)))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, x: total + x)

    # a one-element array names a value that the next step reads many times
    ordered = F.transform(F.array(F.sort_array(windows)), positions)
    return F.coalesce(F.get(F.transform(ordered, covered), F.lit(0)), F.lit(0).cast("long"))


def with_words(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds ``__text`` (null: empty) and ``__words``."""
    return docs.withColumn("__text", F.coalesce(F.col(text_col), F.lit(""))).withColumn("__words", words(F.col("__text")))


def base_rules() -> dict[str, Column]:
    n = F.size("__words")
    return {
        "few_words": n < LEAST_WORDS,
        "repeated_windows": 100 * n_repeat_words("__words") > MOST_REPEATED_PERCENT * n,
    }


def more_rules() -> dict[str, Column]:
    text, n = F.col("__text"), F.greatest(F.size("__words"), F.lit(1))
    chars = F.length(_without(text, SPACE_CHARACTERS))
    lines = F.greatest(F.size(F.split(text, "\n")), F.lit(1))
    return {
        "symbols": _count_of(text, SYMBOLS) > MOST_SYMBOLS_PER_WORD * n,
        "capitals": _count_of(text, CAPITALS) > MOST_CAPITALS_SHARE * chars,
        "marks": _count_of(text, "!?") > MOST_MARKS_PER_WORD * n,
        "duplicate_lines": n_dup_lines(text) > MOST_DUPLICATE_LINES_SHARE * lines,
        "word_lengths": ~(chars / n).between(*WORD_LENGTHS),
    }


def cascade_order(docs: DataFrame, rules: dict[str, Column], text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[str]:
    """The names of the rules by descending rejection per second on a sample of
    ``sample_rows`` expected rows (all rows, if fewer); by name where these are equal."""
    rows = docs.count()
    if not rows:
        return sorted(rules)
    sample = docs.select(text_col).sample(min(1.0, sample_rows / rows), seed=6)
    sample = with_words(materialize(sample.repartition(2), "quality-sample"), text_col)

    def measured(rejects: Column) -> tuple[float, int]:
        took, count = [], 0
        for _ in range(2):
            began = time.perf_counter()
            # the row number keeps the rule in a projection of its own, above the words
            judged = sample.select(rejects.alias("rejects"), F.monotonically_increasing_id().alias("row"))
            count = judged.agg(F.count_if((F.col("row") >= 0) & F.col("rejects"))).first()[0]
            took.append(time.perf_counter() - began)
        return min(took), count

    scan, _ = measured(F.size("__words") < 0)
    order = {}
    for name, rejects in rules.items():
        seconds, rejected = measured(rejects)
        order[name] = -rejected / max(seconds - scan, 0.001)
    return sorted(rules, key=lambda name: (order[name], name))


def kept(rules: dict[str, Column], order: list[str]) -> Column:
    """False from the first rule that rejects; the later ones are not evaluated."""
    verdict = F
    for name in order:
        verdict = verdict.when(F.coalesce(rules[name], F.lit(False)), False)
    return verdict.otherwise(True) if order else F.lit(True)


def filter_documents(docs: DataFrame, text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, with their columns. A null or empty text
    has no words and is rejected as too short."""
    rules = base_rules() | more_rules()
    order = cascade_order(docs, rules, text_col, sample_rows)
    # in one column, so that no name of theirs can be that of a column made here
    whole = F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("__whole")
    # The row number keeps the filter above the projection that makes the words: pushed
    # below it, the rules would split the text anew for every word.
    judged = with_words(docs.select(whole, F.col(text_col).alias("text")), "text").select(
        "__whole", kept(rules, order).alias("__kept"), F.monotonically_increasing_id().alias("__row")
    )
    return judged.where(F.col("__kept") & (F.col("__row") >= 0)).select(
        *[F.col("__whole")[name].alias(name) for name in docs.columns]
    )


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Counts and verdict of every row: id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept. Repeated rows and null ids are judged like others;
    null text counts as empty (no words, base_failed)."""
    text = F.col("__text")
    plain = docs.select(F.col(id_col).alias(id_col), F.col(text_col).alias("text"))
    more = more_rules()
    order = cascade_order(plain, more, "text", sample_rows)
    counted = with_words(plain).select(
        id_col,
        F.size("__words").cast("long").alias("n_words"),
        F.length(_without(text, SPACE_CHARACTERS)).cast("long").alias("word_chars"),
        _count_of(text, SYMBOLS).alias("n_symbols"),
        n_dup_lines(text).alias("n_dup_lines"),
        n_repeat_words("__words").alias("n_repeat_words"),
        kept(more, order).alias("__kept"),
        F.monotonically_increasing_id().alias("__row"),
    ).where("__row >= 0")  # so that a filter on the result stays above the words, too
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    )
    return counted.withColumn("base_failed", failed).select(
        id_col,
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & F.col("__kept")).alias("kept"),
    )


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return filter_documents(docs)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measures(table(spark, sf_dir, "documents"))


#: A word's characters stand between two of these; chr() keeps the pattern readable in SQL.
ORACLE = r"""
WITH d AS (
  SELECT doc_id, COALESCE(text, '') AS t, row_number() OVER () AS r,
         list_filter(regexp_split_to_array(COALESCE(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), zipped AS (
  SELECT r, generate_subscripts(w, 1) AS i, UNNEST(list_zip(w, w[2:], w[3:])) AS z FROM d
), named AS (
  SELECT r, i, z[1] || ' ' || z[2] || ' ' || z[3] AS s FROM zipped WHERE z[3] IS NOT NULL
), repeated AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, s) AS c FROM named) WHERE c > 1
), covered AS (
  SELECT r, count(DISTINCT i + k) AS n
  FROM repeated, (VALUES (0), (1), (2)) AS o(k) GROUP BY r
), lines AS (
  SELECT r, count(*) - count(DISTINCT line) AS n
  FROM (SELECT r, UNNEST(string_split(t, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r
), m AS (
  SELECT d.r, doc_id, t, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(COALESCE(lines.n, 0) AS BIGINT) AS n_dup_lines,
         CAST(COALESCE(covered.n, 0) AS BIGINT) AS n_repeat_words,
         length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS capitals,
         length(t) - length(regexp_replace(t, '[!?]', '', 'g')) AS marks,
         len(string_split(t, chr(10))) AS n_lines
  FROM d LEFT JOIN lines USING (r) LEFT JOIN covered USING (r)
), b AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, greatest(n_words, 1) AS n FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (
         n_symbols > 0.1 * n OR capitals > 0.3 * word_chars OR marks > 0.5 * n
         OR n_dup_lines > 0.6 * n_lines OR word_chars < 2 * n OR word_chars > 15 * n) AS kept
FROM b
"""
