"""Quality rules as a short-circuit cascade.

A rule is a feature of a text and the values that reject it.  On a sample of the
texts each rule's feature is timed by itself, and the rules that each text
fails are noted as a bit set.  Rules are then ordered by rejection per cost: first
the rule that rejects most of the sample per second, then the one that does so
among the texts left, and so on (rules reject alike texts, so what a rule rejects by
itself would mislead).  A feature is computed only for texts that all rules before
it let pass; it is null for others.  Whether a text is kept does not depend on
the order, so a differently timed sample changes the work, not the result.

All is DataFrame functions: windows of words are hashed within the row, and a
text's words never leave it.  Eight-word windows are told apart by 64-bit hashes of
their words.

Defined results: null text counts as empty and fails for want of words; empty and blank
texts too; null doc_id is kept; repeated rows each give a row; a text at a limit
passes; an empty table or sample leaves the rules as they are declared; columns
beside doc_id and text are not looked at.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hindcast.llm.common import durable

#: Fixed value: characters that part words.
SPACE = "\t\n\x0b\f\r "
BLANKS = r"[\x20\x09-\x0D]+"
#: Words in a window, fewest words, and the share of repeated words in percent.
WINDOW, FEWEST, REPEATED = 8, 20, 30
#: Limits of the rules that are added: symbols and repeated lines a hundred words, letters a word, share of words with a letter.
SYMBOLS, LINES, LETTERS, LEAST_LETTERED = 10, 10, 25, 50
#: Rows of the sample (about), and how often a rule is timed.
SAMPLE, TIMES = 2_000, 3


class Rule(NamedTuple):
    """A feature of the columns text and words, and when its value rejects; the value stands in a column of the feature's name."""

    feature: str
    value: Callable[[Column, Column], Column]
    rejects: Callable[[Column, Column], Column]


def words_of(text: Column) -> Column:
    """Runs of other characters than blanks."""
    trimmed = F.btrim(text, F.lit(SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANKS))


def n_dup_lines(text: Column, words: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(SPACE)) != "")
    # A text of one line has none; else the lines are looked at.
    return F.when(F.contains(text, F.lit("\n")), F.size(lines) - F.size(F.array_distinct(lines))).otherwise(0).cast("long")


def n_repeat_words(text: Column, words: Column) -> Column:
    """Words in windows of WINDOW words that stand twice or more in the text, the first included."""
    count = F.size(words) - WINDOW + 1
    places = F.sequence(F.lit(1), count)

    def covered(hashes: Column) -> Column:
        """Length of the union of the windows whose hash recurs: sorted by hash, equal ones stand beside each other."""
        ordered = F.array_sort(F.arrays_zip(hashes.alias("h"), places.alias("at")))
        return F.aggregate(F.array(ordered), F.lit(0), lambda a, s: a + _union(F.array_sort(_again(s))))

    hashes = F.transform(places, lambda i: F.xxhash64(F.slice(words, i, WINDOW)))
    # A lambda's argument is computed once, however often it is used.
    found = F.aggregate(F.array(hashes), F.lit(0), lambda a, h: F.when(F.size(F.array_distinct(h)) == F.size(h), a).otherwise(covered(h)))
    return F.when(count > 1, found).otherwise(0).cast("long")


def _again(s: Column) -> Column:
    """Places of the windows (h, at), sorted by h, that have an equal neighbour."""
    last = F.size(s) - 1
    kept = F.filter(s, lambda x, i: ((i > 0) & (s[F.greatest(i - 1, F.lit(0))]["h"] == x["h"])) | ((i < last) & (s[F.least(i + 1, last)]["h"] == x["h"])))
    return F.transform(kept, lambda x: x["at"])


def _union(starts: Column) -> Column:
    """Words under windows that begin at these sorted places."""
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    step = lambda a, at: F.struct((a["n"] + F.least(F.lit(WINDOW), at + WINDOW - a["end"])).alias("n"), (at + WINDOW).alias("end"))
    return F.aggregate(starts, zero, step, lambda a: a["n"])


#: The base rules, then the added ones; each value is a long.
RULES = [
    Rule("n_words", lambda text, words: F.size(words).cast("long"), lambda v, words: v < FEWEST),
    Rule("n_repeat_words", n_repeat_words, lambda v, words: 100 * v > REPEATED * F.size(words)),
    Rule("n_symbols", lambda text, words: F.length(F.regexp_replace(text, r"[^#*$%&|<>]++", "")).cast("long"), lambda v, words: 100 * v > SYMBOLS * F.size(words)),
    Rule("n_dup_lines", n_dup_lines, lambda v, words: 100 * v > LINES * F.size(words)),
    Rule("word_chars", lambda text, words: F.length(F.array_join(words, "")).cast("long"), lambda v, words: v > LETTERS * F.size(words)),
    Rule("n_lettered", lambda text, words: F.size(F.filter(words, lambda w: w.rlike(r"\p{L}"))).cast("long"), lambda v, words: 100 * v < LEAST_LETTERED * F.size(words)),
]


def prepared(docs: DataFrame) -> DataFrame:
    """(doc_id, text, words) with null texts as empty."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), words_of(text).alias("words"))


def estimate(sample: DataFrame, rules: Sequence[Rule] = RULES, times: int = TIMES) -> tuple[list[float], dict[int, int]]:
    """Seconds that each rule takes on the sample (at best), and texts by the set of rules they fail (bit k: rule k).

    The sample is (text, words), bounded and durable.
    """
    text, words = F.col("text"), F.col("words")

    def seconds(value: Column) -> float:
        began = time.perf_counter()
        sample.agg(F.sum(value)).collect()
        return time.perf_counter() - began

    none = min(seconds(F.size("words") + F.length("text")) for _ in range(times + 1))
    cost = [max(none / 100, min(seconds(r.value(text, words)) for _ in range(times + 1)) - none) for r in rules]
    fails = sum((F.when(r.rejects(r.value(text, words), words), 1 << k).otherwise(0) for k, r in enumerate(rules)), F.lit(0))
    return cost, {r["fails"]: r["n"] for r in sample.groupBy(fails.alias("fails")).agg(F.count(F.lit(1)).alias("n")).collect()}


def by_rejection_per_cost(cost: Sequence[float], fails: dict[int, int]) -> list[int]:
    """Greedy order of rules: most texts rejected of those still there, per second; of equal ones the cheaper, then the earlier."""
    order, left = [], list(range(len(cost)))
    while left:
        rejected = {k: sum(n for bits, n in fails.items() if bits >> k & 1) for k in left}
        k = min(left, key=lambda k: (-rejected[k] / cost[k], cost[k], k))
        order.append(k)
        left.remove(k)
        fails = {bits: n for bits, n in fails.items() if not bits >> k & 1}
    return order


def plan(docs: DataFrame, rules: Sequence[Rule] = RULES, sample: int = SAMPLE) -> list[Rule]:
    """The rules in the order that a sample of about `sample` rows of docs asks for."""
    rows = docs.count()
    if rows == 0:
        return list(rules)
    some = durable(prepared(docs.sample(min(1.0, sample / rows), seed=11)).select("text", "words"))
    cost, fails = estimate(some, rules)
    return [rules[k] for k in by_rejection_per_cost(cost, fails)]


def cascade(docs: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Prepared docs with each rule's feature, null once a rule before has rejected, and kept."""
    text, words, alive = F.col("text"), F.col("words"), "__alive"
    out = docs.withColumn(alive, F.lit(True))
    for r in rules:
        out = out.withColumn(r.feature, F.when(F.col(alive), r.value(text, words)))
        out = out.withColumn(alive, F.col(alive) & ~F.coalesce(r.rejects(F.col(r.feature), words), F.lit(False)))
    return out.withColumnRenamed(alive, "kept")


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = cascade(prepared(docs), plan(docs))
    # The report shows every feature: those that the cascade skipped are made up for.
    out = out.select("doc_id", "kept", F.size("words").cast("long").alias("n_words"), *[
        F.coalesce(r.feature, r.value(F.col("text"), F.col("words"))).alias(r.feature) for r in RULES if r.feature != "n_words"])
    failed = (F.col("n_words") < FEWEST) | (100 * F.col("n_repeat_words") > REPEATED * F.col("n_words"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), "kept", "n_lettered")


OP11_SQL = r"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
places AS (SELECT r, unnest(range(1, len(w) - 6)) AS p, unnest(list_transform(range(1, len(w) - 6), lambda i: array_to_string(w[i:i + 7], ' '))) AS g FROM t WHERE len(w) >= 8),
again AS (SELECT r, p FROM (SELECT r, p, count(*) OVER (PARTITION BY r, g) AS c FROM places) WHERE c > 1),
covered AS (SELECT r, count(DISTINCT q) AS n FROM (SELECT r, unnest(range(p, p + 8)) AS q FROM again) GROUP BY r),
features AS (
  SELECT r, doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines, len(list_filter(w, lambda x: regexp_matches(x, '\p{L}'))) AS n_lettered
  FROM t),
counted AS (SELECT doc_id, n_words, word_chars, n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words, n_lettered FROM features LEFT JOIN covered USING (r))
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
  n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words OR 100 * n_symbols > 10 * n_words OR 100 * n_dup_lines > 10 * n_words OR word_chars > 25 * n_words OR 100 * n_lettered < 50 * n_words) AS kept,
  n_lettered::BIGINT AS n_lettered
FROM counted
"""
