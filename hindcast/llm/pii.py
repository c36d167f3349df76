"""PII: base patterns, and bootstrapped contextual extraction.

E-mail addresses, IP addresses, card and phone numbers are found by fixed
patterns.  They seed a bootstrap, together with values that stand assigned to the
name of a secret (`password=...`) and access keys of a documented form.  The one to
three words left of an identifier, those right of it, and its form (kinds of
characters, length) are its lexical patterns.  Spark scores the graph of patterns
and distinct values in rounds: a pattern is believed as far as the values it
surrounds are, seeds or values found in a round before; a form counts beside a believed
context only; and only patterns with enough
such values and a belief of `sure` count, and a value is believed by its best left,
right and form pattern (noisy or).  So a value found by one context can bring in
the next context.  What reaches `trust` is reported at all its places as kind "id"
unless a base span overlaps it.  Copies of a document are no further evidence.

All of it is DataFrame functions.  A match's place comes from the lengths of the
pieces between the matches, so one expression gives all places in a text.  The
patterns use possessive repeats, which neither recurse nor backtrack on long
runs.

Defined results: null text counts as empty and has no spans; a null doc_id is
kept; repeated rows each give a row; the patterns of a value that tie count alike; an empty table gives no rows; other columns are not
looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hindcast.llm.common import durable

#: Fixed values: (kind, cheap test, pattern).  A match that could begin inside a run of its own first
#: characters is tried at the run's start, or where the match before it ended, only: elsewhere it fails alike.
KINDS = [
    ("email", "@", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    ("ip", r"[0-9]\.[0-9]", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"),
    ("card", r"[0-9][ -]?[0-9]", r"[0-9](?:[ -]?[0-9])++"),
    ("phone", r"\+[0-9]", r"\+[0-9][ ().0-9-]+[0-9]"),
]
BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
#: Runs of at least five letters, digits, "_" and "-" with a digit.
CANDIDATE = r"(?<![A-Za-z0-9_-])(?=[A-Za-z_-]*+[0-9])[A-Za-z0-9_-]{5,}+"
#: Seeds among the candidates, by what stands before them and by their documented form.
ASSIGNED = r"(?i)(?<![a-z0-9])(?:password|passwd|pwd|secret|token|api[_ -]?key|access[_ -]?key)[\"']?\s?[=:]\s?[\"']?$"
FORM = r"^AKIA[0-9A-Z]{16}$"
#: Characters looked at on each side, and words of them in a pattern.
NEAR, WORDS = 64, 3


def _luhn(digits: Column) -> Column:
    back = F.split(F.reverse(digits), "")
    one = F.transform(back, lambda d, i: d.try_cast("int") * (1 + i % 2))
    return F.aggregate(one, F.lit(0), lambda s, d: s + F.when(d > 9, d - 9).otherwise(F.coalesce(d, F.lit(0)))) % 10 == 0


def _good(kind: str, m: Column) -> Column:
    digits = F.regexp_replace(m, "[^0-9]", "")
    if kind == "ip":
        return m.rlike(rf"^{BYTE}(?:\.{BYTE}){{3}}$")
    if kind == "card":
        return F.when(F.length(digits).between(16, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(8, 15)
    if kind == "id":  # a number of a card's length is a card or, if it fails its test, none
        return ~m.rlike(r"^[0-9]{16,19}$")
    return F.lit(True)


SPAN = "array<struct<start:int,end:int>>"
#: Matches whose lengths are added up at once.
RUN = 64
#: Code points of a text's chunks, and of the longest span that is taken from one: cutting a piece out of a text costs its whole length.
CHUNK, LONGEST = 4096, 1024


def _let(value: Column, body) -> Column:
    """body of a value that is computed once, however often it is used."""
    return F.transform(F.array(value), body)[0]


def _sum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0), lambda x, y: x + y)


def _places(pieces: Column, matches: Column) -> Column:
    """(start, end, match) of the matches between pieces.

    A place is the sum of all lengths before: of whole runs of RUN matches, from sums of runs, then within its own run; so the
    work for n matches is RUN * n and a (n / RUN) ** 2 that stays small for any text.
    """
    steps = F.transform(F.arrays_zip(pieces.alias("p"), matches.alias("m")), lambda x: F.length(x["p"]) + F.coalesce(F.length(x["m"]), F.lit(0)))

    def placed(a: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(0), F.floor((F.size(a) - 1) / RUN).cast("int")), lambda r: _sum(F.slice(a, r * RUN + 1, RUN)))

        def of_runs(sums: Column) -> Column:
            begins = F.transform(sums, lambda _, r: _sum(F.slice(sums, 1, r)))

            def of_begins(at: Column) -> Column:
                def one(m: Column, i: Column) -> Column:
                    begin = at[F.floor(i / RUN).cast("int")] + _sum(F.slice(a, i - i % RUN + 1, i % RUN + 1)) - F.length(m)
                    return F.struct(begin.alias("start"), (begin + F.length(m)).alias("end"), m.alias("match"))

                return F.transform(matches, one)

            return _let(begins, of_begins)

        return _let(runs, of_runs)

    return _let(steps, placed)


def _spans(text: Column, kind: str, test: str, pattern: str) -> Column:
    """[start, end) in code points of the matches that are good; matches are leftmost and don't overlap."""
    none = F.expr("array()").cast(SPAN)

    def kept(matches: Column) -> Column:
        found = F.filter(_places(F.split(text, pattern, -1), matches), lambda x: _good(kind, x["match"]))
        spans = F.transform(found, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))
        return F.when(F.size(matches) > 0, spans).otherwise(none)

    return F.when(text.rlike(test), _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), kept)).otherwise(none)


def _apart(candidates: Column, known: Column) -> Column:
    """The candidates that overlap none of the known spans; both stand in order and overlap nothing of their own.

    In the order of known starts and candidates' ends, what stands before a candidate besides other candidates are the known
    spans that begin before its end; only the last of these can reach it.
    """
    ends = F.transform(candidates, lambda c, i: F.struct(c["end"].alias("at"), F.lit(0).alias("known"), i.alias("n")))
    starts = F.transform(known, lambda k, i: F.struct(k["start"].alias("at"), F.lit(1).alias("known"), i.alias("n")))

    def free(x: Column, p: Column) -> Column:
        before = p - x["n"]
        return (x["known"] == 0) & F.when(before > 0, known[before - 1]["end"] <= candidates[x["n"]]["start"]).otherwise(True)

    left = F.transform(F.filter(F.array_sort(F.concat(ends, starts)), free), lambda x: candidates[x["n"]])
    return F.when((F.size(candidates) > 0) & (F.size(known) > 0), left).otherwise(candidates)


def _form(value: Column) -> Column:
    """Kinds of characters and length (exact for digits, else by doublings)."""
    size = F.length(value)
    kinds = [(r"^[0-9]+$", "digits", size), (r"^[0-9a-f]+$", "hex", None), (r"^[0-9a-z]+$", "lower", None), (r"^[0-9A-Z]+$", "upper", None), (r"^[0-9a-zA-Z]+$", "mixed", None)]
    out = F.concat(F.lit("other:"), F.floor(F.log2(size)).cast("string"))
    for pattern, name, exact in reversed(kinds):
        out = F.when(value.rlike(pattern), F.concat(F.lit(f"{name}:"), (F.floor(F.log2(size)) if exact is None else exact).cast("string"))).otherwise(out)
    return out


def _words(side: str, words: Column, cut: Column, gap: Column) -> list[Column]:
    """Patterns of the first one to WORDS words; a word that the limit of NEAR may have cut is not used."""
    out = []
    for k in range(1, WORDS + 1):
        whole = F.when(cut, F.size(words) > k).otherwise(F.size(words) >= k) & (words[0] != "")
        out.append(F.when(whole, F.concat(F.lit(side), gap, F.array_join(F.slice(words, 1, k), " "))))
    return out


def _patterns(before: Column, after: Column, form: Column, cut: Column) -> Column:
    """The lexical patterns of a span, each with its kind, L, R or F, first; words left of it come nearest first."""
    trimmed = lambda s: F.split(F.regexp_replace(F.lower(s), r"^\s+|\s+$", ""), r"\s+")
    gap = lambda s, at: F.when(s.rlike(at), " ").otherwise("")
    left = _words("L", F.reverse(trimmed(before)), cut, gap(before, r"\s$"))
    right = _words("R", trimmed(after), F.length(after) == NEAR, gap(after, r"^\s"))
    return F.array_compact(F.array(F.concat(F.lit("F"), form), *left, *right))


def score_values(graph: DataFrame, *, rounds: int = 4, trust: float = 0.6, support: int = 3, sure: float = 0.3) -> DataFrame:
    """(value, score) of graph (value, seed, pattern), distinct rows: values that reach trust; seeds have 1.

    A value needs a believed context: its form alone is shared by what is no identifier.  In each round a pattern's belief is the sum of the scores of its values over their number plus one, if
    that sum is `support` and the belief `sure` at least; else none.
    """
    seeds = durable(graph.where("seed").select("value").distinct().withColumn("score", F.lit(1.0)))
    scores = seeds
    for _ in range(rounds):
        belief = graph.join(scores, "value", "left").groupBy("pattern").agg(F.sum(F.coalesce("score", F.lit(0.0))).alias("mass"), F.count(F.lit(1)).alias("n"))
        belief = belief.withColumn("belief", F.col("mass") / (F.col("n") + 1)).where((F.col("mass") >= support) & (F.col("belief") >= sure)).select("pattern", "belief")
        best = graph.where("not seed").join(belief, "pattern").groupBy("value")
        best = best.agg(*[F.coalesce(F.max(F.when(F.col("pattern").startswith(k), F.col("belief"))), F.lit(0.0)).alias(k) for k in "LRF"])
        found = best.where("L > 0 or R > 0").select("value", (1 - (1 - F.col("L")) * (1 - F.col("R")) * (1 - F.col("F"))).alias("score")).where(F.col("score") >= trust)
        scores = durable(seeds.union(found.join(seeds, "value", "left_anti")))
    return scores


def find_pii(docs: DataFrame, *, rounds: int = 4, trust: float = 0.6, support: int = 3, sure: float = 0.3, seeded: Column | None = None) -> DataFrame:
    """One row per row of docs: doc_id, email, ip, card, phone, id: arrays of (start, end).

    seeded, a condition on docs, says whose assigned values may be seeds (all, if it is not given): what
    the patterns find of the others' tells how well they find.
    """
    text = F.col("text")
    may = F.lit(True) if seeded is None else F.coalesce(seeded, F.lit(False))
    base = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"), may.alias("may")).select(
        "doc_id", F.monotonically_increasing_id().alias("row"), "text", "may",
        *[_spans(text, *k).alias(k[0]) for k in KINDS], _spans(text, "id", "[0-9]", CANDIDATE).alias("candidates"))
    known = F.concat(*[k[0] for k in KINDS])

    def item(certain: bool):
        def of(s: Column) -> Column:
            chunk = F.floor(s["start"] / CHUNK).cast("int")
            near, at = F.col("chunks")[chunk], s["start"] - F.greatest(F.lit(0), chunk * CHUNK - NEAR)
            size = s["end"] - s["start"]
            long = size > LONGEST
            value = F.when(long, F.substring(text, s["start"] + 1, size)).otherwise(F.substring(near, at + 1, size))
            before = F.substring(near, F.greatest(F.lit(1), at - NEAR + 1), F.least(at, F.lit(NEAR)))
            seed = F.lit(True) if certain else F.col("may") & (before.rlike(ASSIGNED) | value.rlike(FORM))
            after = F.when(long, F.substring(text, s["end"] + 1, F.lit(NEAR))).otherwise(F.substring(near, at + size + 1, F.lit(NEAR)))
            return F.struct(s["start"], s["end"], F.lit(certain).alias("base"), seed.alias("seed"), F.xxhash64(value).alias("value"), _form(value).alias("form"), before.alias("before"), after.alias("after"))

        return of

    for kind, *_ in KINDS:
        base = base.withColumn("candidates", _apart(F.col("candidates"), F.col(kind)))
    chunk = lambda i: F.substring(text, F.greatest(F.lit(1), i * CHUNK - NEAR + 1), F.lit(CHUNK + LONGEST + 2 * NEAR))
    base = durable(
        base.withColumn("chunks", F.transform(F.sequence(F.lit(0), F.floor(F.length(text) / CHUNK).cast("int")), chunk))
        .withColumn("items", F.concat(F.transform(known, item(True)), F.transform("candidates", item(False))))
        .drop("text", "chunks", "candidates", "may"))
    items = base.select("row", F.explode("items").alias("i")).select("row", "i.*")
    graph = items.select("value", "seed", F.explode(_patterns(F.col("before"), F.col("after"), F.col("form"), F.col("start") > NEAR)).alias("pattern"))
    graph = graph.groupBy("value", "pattern").agg(F.bool_or("seed").alias("seed"))
    certain = graph.groupBy("value").agg(F.bool_or("seed").alias("seed"))  # a seed at one place is one at all
    graph = durable(graph.drop("seed").join(certain, "value"))
    scores = score_values(graph, rounds=rounds, trust=trust, support=support, sure=sure)
    found = items.where("not base").select("row", "start", "end", "value").join(scores.select("value"), "value", "left_semi")
    found = found.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("id"))
    out = base.select("row", "doc_id", *[k[0] for k in KINDS]).join(found, "row", "left")
    return out.select("doc_id", *[k[0] for k in KINDS], F.coalesce("id", F.expr("array()").cast(SPAN)).alias("id"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(spark.read.parquet(f"{sf_dir}/documents.parquet"))

    def label(kind: str):
        return lambda s: F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string"))

    def named(*kinds: str) -> Column:
        return F.array_join(F.concat(*[F.transform(k, label(k)) for k in kinds]), ",")

    kinds = [k[0] for k in KINDS]
    return found.select("doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in kinds],
                        F.sha2(named(*kinds), 256).alias("base_sha256"), named(*kinds, "id").alias("spans"),
                        F.size("id").cast("long").alias("n_id"), sum((F.size(k) for k in [*kinds, "id"]), F.lit(0)).cast("long").alias("n_spans"))
