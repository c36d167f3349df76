"""Line dedup: winnowing over line hashes.

A run is a series of consecutive non-blank lines (blank lines inside it belong
to it) with at least `min_words` words.  A line goes if some run that holds it
also stands at an earlier place: in a document with a smaller id, or earlier in
the same one without overlap.  The first place of each run stays.

It is enough to look at the runs that can't be shortened: from each line the
shortest run forward, and to each line the shortest run backward (extending a
match by a line on either side is matching the next such run).  Of each run the
line with the least hash is its fingerprint; two equal runs choose the same one,
so a fingerprint chosen at one place only rules out all runs around it.  Places
of repeated fingerprints are joined with the first place of theirs whose run is
the same both ways, by a hash of its lines; so a fingerprint that stands in very
many documents never meets itself pair by pair.  Overlapping matches are merged
into spans before they are cut out.  Only hashes and places are shuffled, and
each text once, to its spans.  Repeats with fewer words than `min_words` stay.

Defined results: null text stays null and has no lines; an empty or blank text
stays as it is; rows with null doc_id are passed on unchanged and match
nothing; equal rows count once and all get the same result; of equal runs in
one document the first stays; an empty table gives no rows.  Columns beside
doc_id and text are carried through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hindcast.llm.common import durable

MIN_WORDS = 50
DOC = ["__doc", "__version"]


def _runs(docs: DataFrame, min_words: int) -> DataFrame:
    """(doc, version, start, end, fingerprint, its place, two content hashes) of every run that can't be shortened."""
    lines = (
        docs.where("doc_id is not null and text is not null")
        .select(F.col("doc_id").alias("__doc"), F.xxhash64("text").alias("__version"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))
        .select(*DOC, "pos", F.xxhash64("line").alias("h"), F.regexp_count("line", F.lit(r"\S+")).cast("long").alias("words"))
        .where("words > 0")
        .repartition(*DOC)
        .dropDuplicates([*DOC, "pos"])
    )
    order = Window.partitionBy(*DOC).orderBy("pos")
    lines = lines.withColumn("upto", F.sum("words").over(order)).withColumn("before", F.col("upto") - F.col("words"))
    item = F.struct("h", (-F.col("pos")).alias("back"))
    forward = Window.partitionBy(*DOC).orderBy("before").rangeBetween(0, min_words - 1)
    backward = Window.partitionBy(*DOC).orderBy("upto").rangeBetween(1 - min_words, 0)

    def run(w, start: Column, end: Column) -> Column:
        return F.struct(start.alias("start"), end.alias("end"), F.sum("words").over(w).alias("words"), F.collect_list(item).over(w).alias("items"))

    runs = lines.select(*DOC, run(forward, F.col("pos"), F.max("pos").over(forward)).alias("f"), run(backward, F.min("pos").over(backward), F.col("pos")).alias("b"))
    both = F.when((F.col("f.start") == F.col("b.start")) & (F.col("f.end") == F.col("b.end")), F.array("f")).otherwise(F.array("f", "b"))
    runs = runs.select(*DOC, F.explode(both).alias("r")).where(F.col("r.words") >= min_words)
    hashes, least = F.col("r.items.h"), F.array_min("r.items")
    return runs.select(
        *DOC, "r.start", "r.end", least["h"].alias("fp"), (-least["back"]).alias("at"),
        F.xxhash64(hashes).alias("k1"), F.hash(hashes).alias("k2"))


def repeated_spans(docs: DataFrame, *, min_words: int = MIN_WORDS) -> DataFrame:
    """(__doc, __version, spans): disjoint [start, end] line spans, from 0, that repeat earlier runs."""
    runs = durable(_runs(docs, min_words))
    shared = runs.select("fp", *DOC, "at").distinct().groupBy("fp").count().where("count > 1").select("fp")
    runs, same = runs.join(shared, "fp", "left_semi"), ["fp", "k1", "k2"]
    # Only runs that stand twice at least are looked up; written first, so that the join can split a hot one.
    first = durable(runs.groupBy(same).agg(F.min(F.struct("__doc", "__version", "start", "end")).alias("p"), F.count(F.lit(1)).alias("places")).where("places > 1").drop("places"))
    other = (F.col("__doc") != F.col("p.__doc")) | (F.col("__version") != F.col("p.__version"))
    later = runs.join(first, same).where(other | (F.col("start") > F.col("p.end"))).select(*DOC, "start", "end")
    order = Window.partitionBy(*DOC).orderBy("start", "end")
    seen = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    later = later.withColumn("opens", F.coalesce((F.col("start") > seen).cast("int"), F.lit(1)))
    later = later.withColumn("span", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    spans = later.groupBy(*DOC, "span").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return spans.groupBy(*DOC).agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("__spans"))


def line_dedup(docs: DataFrame, *, min_words: int = MIN_WORDS) -> DataFrame:
    """docs with lines_removed, spans_removed ("first-last" line numbers, comma-joined) and text without those lines."""
    spans = repeated_spans(docs, min_words=min_words)
    rows = docs.select(F.struct(*docs.columns).alias("d"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("version"))
    joined = rows.join(spans, (F.col("id") == F.col("__doc")) & (F.col("version") == F.col("__version")), "left")
    gone = F.coalesce("__spans", F.expr("array()").cast("array<struct<start:int,end:int>>"))
    kept = F.filter(F.split("d.text", "\n"), lambda _, i: ~F.exists(gone, lambda s: i.between(s["start"], s["end"])))
    n = F.aggregate(gone, F.lit(0), lambda n, s: n + s["end"] - s["start"] + 1)
    named = F.array_join(F.transform(gone, lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string"))), ",")
    done = joined.select("d", F.struct(
        F.when(F.col("__spans").isNull(), F.col("d.text")).otherwise(F.array_join(kept, "\n")).alias("text"),
        n.cast("long").alias("lines_removed"), named.alias("spans_removed")).alias("out"))
    return done.select(*[F.col(f"d.`{c}`").alias(c) for c in docs.columns if c != "text"], "out.*")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return line_dedup(docs).select("doc_id", "lines_removed", "text")


OP1_SQL = f"""
WITH l AS (
  SELECT doc_id, CAST(i AS BIGINT) AS pos, parts[i + 1] AS line, CAST(len(regexp_extract_all(parts[i + 1], '[^ \\t\\n\\x0B\\f\\r]+')) AS BIGINT) AS words
  FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents WHERE text IS NOT NULL) d, unnest(range(len(parts))) u(i)),
c AS (SELECT *, sum(words) OVER (PARTITION BY doc_id ORDER BY pos) AS upto FROM l WHERE words > 0),
b AS (SELECT *, CAST(upto - words AS BIGINT) AS before, CAST(upto AS BIGINT) AS upto2 FROM c),
r AS (
  SELECT doc_id, pos AS s, max(pos) OVER f AS e, sum(words) OVER f AS w, list(line) OVER f AS lines FROM b
  WINDOW f AS (PARTITION BY doc_id ORDER BY before RANGE BETWEEN CURRENT ROW AND {MIN_WORDS - 1} FOLLOWING)
  UNION
  SELECT doc_id, min(pos) OVER g, pos, sum(words) OVER g, list(line) OVER g FROM b
  WINDOW g AS (PARTITION BY doc_id ORDER BY upto2 RANGE BETWEEN {MIN_WORDS - 1} PRECEDING AND CURRENT ROW)),
f AS (SELECT lines, min((doc_id, s, e)) AS p FROM r WHERE w >= {MIN_WORDS} GROUP BY lines),
later AS (
  SELECT DISTINCT r.doc_id, unnest(range(r.s, r.e + 1)) AS pos FROM r JOIN f USING (lines)
  WHERE r.doc_id <> f.p[1] OR r.s > f.p[3]),
gone AS (SELECT doc_id, list(pos) AS gone FROM later GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(len(gone), 0) AS BIGINT) AS lines_removed,
  CASE WHEN gone IS NULL THEN text ELSE array_to_string(list_transform(list_filter(range(len(string_split(text, chr(10)))), lambda i: NOT list_contains(gone, i)), lambda i: string_split(text, chr(10))[i + 1]), chr(10)) END AS text
FROM documents d LEFT JOIN gone USING (doc_id)
"""
