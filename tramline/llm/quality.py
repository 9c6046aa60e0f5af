"""Quality rules as a short-circuit cascade, cheapest rejection first (native)."""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.llm.common import BLANKS, text_or_empty, words

SYMBOLS = "#*$%&|<>"
CAPITALS = "A-Z"
NOT_BLANK = r"^\x20\x09-\x0D"
WINDOW = 8
# Rows from which cost and selectivity are estimated. They only order the rules.
SAMPLE_ROWS = 400


def _count(text: Column, characters: str) -> Column:
    """Code points of the text that the character class holds."""
    others = characters[1:] if characters.startswith("^") else f"^{characters}"
    return F.length(F.regexp_replace(text, f"[{others}]+", ""))


def _repeat_words(tokens: Column, size: int) -> Column:
    """Words inside windows of ``size`` words that occur twice or more, the first one included.

    ``size`` is a power of two. Hashes tell texts without repeats; only the others compare the windows themselves. Everything
    happens inside the row, in time n log n of its own words.
    """

    def paired(step: int):
        def both(h: Column) -> Column:
            count = F.size(h) - step
            first, second = F.slice(h, F.lit(1), count), F.slice(h, F.lit(1 + step), count)
            return F.zip_with(first, second, lambda a, b: F.xxhash64(a, b))

        return both

    def repeats(t: Column) -> Column:
        hashes, step = F.transform(t, lambda word: F.xxhash64(word)), 1
        while step < size:  # hashes of 2, 4, 8 words, each from two neighbours
            hashes, step = _let(hashes, paired(step)), 2 * step
        return _let(hashes, lambda v: F.size(F.array_distinct(v)) < F.size(v))

    def starts(t: Column) -> Column:
        """Places of the repeated windows, in order; equal windows are neighbours once sorted."""
        pairs = F.sort_array(
            F.transform(
                F.sequence(F.lit(0), F.size(t) - size),
                lambda i: F.struct(F.concat_ws(" ", F.slice(t, i + 1, size)).alias("w"), i.alias("p")),
            )
        )

        def same(s: Column, j: Column, k: Column) -> Column:
            return F.coalesce(F.get(s, j)["w"] == F.get(s, k)["w"], F.lit(False))

        def repeated(s: Column) -> Column:
            places = F.sequence(F.lit(0), F.size(s) - 1)
            found = F.filter(places, lambda j: same(s, j, j - 1) | same(s, j, j + 1))
            return F.sort_array(F.transform(found, lambda j: F.get(s, j)["p"]))

        return _let(pairs, repeated)

    def covered(p: Column) -> Column:
        steps = F.sequence(F.lit(0), F.size(p) - 1)
        step = lambda total, j: total + F.least(F.lit(size), F.coalesce(F.get(p, j + 1) - F.get(p, j), F.lit(size)))
        return F.when(F.size(p) > 0, F.aggregate(steps, F.lit(0), step)).otherwise(0)

    def of(t: Column) -> Column:
        return F.when(F.when(F.size(t) > size, repeats(t)).otherwise(False), _let(starts(t), covered)).otherwise(0)

    # Bound once: an expression named inside a lambda would be computed again for each element.
    return _let(tokens, of)


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def metrics(docs: DataFrame) -> DataFrame:
    """doc_id and the counts the rules look at, one row per row of ``docs``.

    A null or empty text has no words and zero counts. Repeated rows and a null doc_id are kept as
    they are. Other columns are left out, so their names cannot clash.
    """
    text = F.col("text")
    split = docs.select("doc_id", text_or_empty(docs["text"]).alias("text")).select(
        "doc_id",
        "text",
        words(text).alias("words"),
        F.filter(F.split(text, "\n", -1), lambda line: F.length(F.btrim(line, F.lit(BLANKS))) > 0).alias("lines"),
    )
    return split.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        _count(text, NOT_BLANK).cast("long").alias("word_chars"),
        _count(text, SYMBOLS).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _count(text, CAPITALS).cast("long").alias("n_capitals"),
        _repeat_words(F.col("words"), WINDOW).cast("long").alias("n_repeat_words"),
    )


@dataclass(frozen=True)
class Rule:
    """A name and a condition on the text that rejects a document."""

    name: str
    rejects: Column


def base_rules() -> list[Rule]:
    tokens = words(F.col("text"))
    return [
        Rule("few_words", F.size(tokens) < 20),
        Rule("repeated_words", 100 * _repeat_words(tokens, WINDOW) > 30 * F.size(tokens)),
    ]


def default_rules() -> list[Rule]:
    """Base rules and four more; all compare whole numbers, so no rounding decides."""
    text = F.col("text")
    tokens = words(text)
    chars = _count(text, NOT_BLANK)
    lines = F.filter(F.split(text, "\n", -1), lambda line: F.length(F.btrim(line, F.lit(BLANKS))) > 0)
    return [
        *base_rules(),
        Rule("symbols", 10 * _count(text, SYMBOLS) > F.size(tokens)),
        Rule("repeated_lines", 10 * (F.size(lines) - F.size(F.array_distinct(lines))) > 4 * F.size(lines)),
        Rule("word_length", (chars < 2 * F.size(tokens)) | (chars > 12 * F.size(tokens))),
        Rule("capitals", 2 * _count(text, CAPITALS) > chars),
    ]


def order_rules(docs: DataFrame, rules: Sequence[Rule], sample_rows: int = SAMPLE_ROWS) -> list[tuple[Rule, float, float]]:
    """Rules with cost in seconds and share rejected, by rejection per cost, highest first.

    Both are measured on ``sample_rows`` rows, a fixed bound whatever the size of the input: they
    only decide the order, never the verdict. Rules of an empty sample keep their order.
    """
    # Collecting a limit reads only as many partitions as it needs; as a step of a plan it would read all.
    texts = docs.select(text_or_empty(docs["text"]).alias("text")).limit(sample_rows).collect()
    sample = docs.sparkSession.createDataFrame(texts, "text string").persist()
    try:
        rows, measured = sample.count(), []
        for rule in rules:
            took, share = float("inf"), 0.0
            for _ in range(2):  # the first run compiles
                start = time.perf_counter()
                rejected = sample.agg(F.sum(F.when(rule.rejects, 1).otherwise(0)).alias("n")).first()["n"]
                took = min(took, time.perf_counter() - start)
                share = (rejected or 0) / max(rows, 1)
            measured.append((rule, took, share))
    finally:
        sample.unpersist()
    return sorted(measured, key=lambda m: -m[2] / m[1])


def cascade(docs: DataFrame, rules: Sequence[Rule], name: str = "rejected_by") -> DataFrame:
    """``docs`` with the first of ``rules`` that rejects each row, or null for a row to keep.

    One CASE expression: a rule is evaluated only for rows that all earlier ones passed. A null
    text is judged as an empty one.
    """
    if not rules:
        return docs.withColumn(name, F.lit(None).cast("string"))
    verdict = None
    for rule in rules:
        verdict = F.when(rule.rejects, rule.name) if verdict is None else verdict.when(rule.rejects, rule.name)
    return docs.withColumn("text", text_or_empty(docs["text"])).withColumn(name, verdict)


def keep_good(docs: DataFrame, rules: Sequence[Rule] | None = None) -> DataFrame:
    """Rows of ``docs`` that no rule rejects, with the columns they came with."""
    ordered = [rule for rule, _, _ in order_rules(docs, rules if rules is not None else default_rules())]
    kept = cascade(docs.withColumn("__original", docs["text"]), ordered, "__rejected").filter("__rejected IS NULL")
    return kept.withColumn("text", F.col("__original")).select(docs.columns)


# The default rules over columns of ``metrics``, for callers that want the counts as well.
METRIC_RULES = {
    "few_words": "n_words < 20",
    "repeated_words": "100 * n_repeat_words > 30 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "repeated_lines": "10 * n_dup_lines > 4 * n_lines",
    "word_length": "word_chars < 2 * n_words OR word_chars > 12 * n_words",
    "capitals": "2 * n_capitals > word_chars",
}


def op10_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Counts of every document and the cascade's verdict on it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    order = [rule.name for rule, _, _ in order_rules(docs, default_rules())]
    # The counts are asked for anyway, so the cascade runs over them and nothing is counted twice.
    counted = metrics(docs)
    verdict = cascade(
        counted.withColumn("text", F.lit("")), [Rule(n, F.expr(METRIC_RULES[n])) for n in order], "rejected_by"
    )
    base = F.expr(f"({METRIC_RULES['few_words']}) OR ({METRIC_RULES['repeated_words']})")
    return verdict.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base.alias("base_failed"),
        F.col("rejected_by").isNull().alias("kept"),
    )


OP10_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT r, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
    list_filter(string_split(text, chr(10)), lambda x: regexp_replace(x, '[\x20\x09-\x0D]+', '', 'g') <> '') AS ls
  FROM d
), x AS (
  SELECT r, unnest(ws) AS w, generate_subscripts(ws, 1) AS p FROM w
), e AS (
  SELECT r, p, lead(w, 7) OVER o IS NOT NULL AS whole, concat_ws(' ', w, lead(w, 1) OVER o, lead(w, 2) OVER o,
    lead(w, 3) OVER o, lead(w, 4) OVER o, lead(w, 5) OVER o, lead(w, 6) OVER o, lead(w, 7) OVER o) AS v
  FROM x WINDOW o AS (PARTITION BY r ORDER BY p)
), g AS (
  SELECT r, p, count(*) OVER (PARTITION BY r, v) AS c FROM e WHERE whole
), f AS (
  SELECT r, p, lead(p) OVER (PARTITION BY r ORDER BY p) AS q FROM g WHERE c > 1
), n AS (
  SELECT r, sum(least(8, coalesce(q - p, 8))) AS n FROM f GROUP BY r
), m AS (
  SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS BIGINT) AS n_capitals,
    CAST(len(ls) AS BIGINT) AS n_lines,
    CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n.n, 0) AS BIGINT) AS n_repeat_words
  FROM d JOIN w USING (r) LEFT JOIN n USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words OR 10 * n_symbols > n_words
    OR 10 * n_dup_lines > 4 * n_lines OR word_chars < 2 * n_words OR word_chars > 12 * n_words
    OR 2 * n_capitals > word_chars) AS kept
FROM m
"""
