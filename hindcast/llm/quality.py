"""Quality classifier: perplexities under two interpolated modified Kneser-Ney models.

One model is over pairs of subword pieces (see pieces): it grows with the
trusted text, tells the order of words, and spells out every script.  The other
is over symbols of a fixed alphabet of SYMBOLS kinds (small letters,
accents by their letter, capitals as one kind, digits, blanks, the usual
punctuation, the rest), in n-grams of ORDER.  It is trained on all trusted text.
N-gram counts are summed in shards by n-gram; continuation counts, discounts
from counts of counts, and context sums are joins and aggregates of the sharded
tables.  The table of probabilities has SYMBOLS ** ORDER entries whatever the
corpus is (16 MB), so it is broadcast, and scoring a text is a table lookup per
symbol, without a shuffle of texts or of their n-grams.

A text is rejected if either perplexity, or the share of its symbols that
repeats what stood shortly before, is above a quantile of the trusted texts of its
language by more than a margin, or if the bits that the piece before saves fall
below the lower quantile: that figure falls when words stand in wrong order,
whatever the words are.  The margin widens for short texts, whose
figures scatter, with the root of their length.

Defined results: null or empty text has perplexity null and is rejected; a null
or unknown lang is judged by the quantile over all trusted texts; without trusted
text nothing is rejected (perplexity is null); a null doc_id is kept; repeated
rows are scored once each; an empty table gives no rows; other columns are not
looked at.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hindcast.llm import pieces
from hindcast.llm.common import durable, text_rows

ORDER = 4
PUNCTUATION = ".,;:!?'\"()-/"
#: 0 begins a text; then blank, line end, small letters, accented letter, capital, digit, punctuation, the rest.
SYMBOLS = 3 + 26 + 3 + len(PUNCTUATION) + 1
QUANTILE = 0.99
MARGIN = 1.15
#: Bits a piece that the gain from order scatters by, times the root of the number of pieces; bits below the quantile that are let pass.
SCATTER, SHORT_OF = 2.0, 0.05
#: Ids of trusted documents that may be broadcast (8 bytes each); more of them are shuffled.
BROADCAST_IDS = 2_000_000


def _symbol(c: str) -> int:
    if c == "\n":
        return 2
    if c.isspace():
        return 1
    if "a" <= c <= "z":
        return 3 + ord(c) - ord("a")
    if c in PUNCTUATION:
        return 32 + PUNCTUATION.index(c)
    if c.isdigit():
        return 31
    if c.isupper():
        return 30
    if c.isalpha() and len(unicodedata.normalize("NFD", c)) > 1:
        return 29
    return SYMBOLS - 1


def symbol_table() -> np.ndarray:
    """Symbols of the code points of the basic plane; what lies beyond is the rest."""
    return np.array([_symbol(chr(c)) for c in range(0x3000)], dtype=np.uint8)


def symbols(text: str, table: np.ndarray) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    out = np.full(len(points), SYMBOLS - 1, dtype=np.uint8)
    low = points < len(table)
    out[low] = table[points[low]]
    return out


def grams(s: np.ndarray) -> np.ndarray:
    """Codes of the n-grams that end at each symbol; the text begins with symbol 0."""
    s = np.concatenate([np.zeros(ORDER - 1, dtype=np.uint8), s])
    n = len(s) - ORDER + 1
    code = s[:n].astype(np.int32)  # SYMBOLS ** ORDER codes
    for k in range(1, ORDER):
        code *= SYMBOLS
        code += s[k : k + n]
    return code


def repeated(s: np.ndarray) -> float:
    """The largest share of symbols that equal the one some 2 to 40 places before."""
    return max((np.count_nonzero(s[k:] == s[:-k]) / (len(s) - k) for k in range(2, min(41, len(s)))), default=0.0)


def count_grams(trusted: DataFrame) -> DataFrame:
    """(gram, n) over all trusted text, summed by n-gram."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, counts = symbol_table(), np.zeros(SYMBOLS**ORDER, dtype=np.int64)
        for b in text_rows(batches):
            found = [grams(symbols(t, table)) for t in b.column(0).to_pylist() if t]
            if found:
                codes, n = np.unique(np.concatenate(found), return_counts=True)
                counts[codes] += n
        codes = np.flatnonzero(counts)
        for at in range(0, len(codes), 100_000):
            some = codes[at : at + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], names=["gram", "n"])

    return trusted.select("text").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def _order_tables(counts: DataFrame, order: int) -> tuple[DataFrame, DataFrame]:
    """(gram, share) and (context, back): discounted shares and back-off weights of one order."""
    tallies = {r["n"]: r["c"] for r in counts.where("n <= 4").groupBy("n").agg(F.count(F.lit(1)).alias("c")).collect()}
    n1, n2, n3, n4 = (tallies.get(k, 0) for k in (1, 2, 3, 4))
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    d = [min(k, max(0.05, k - (k + 1) * y * b / a)) if a else 0.5 for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
    discount = F.when(F.col("n") == 1, d[0]).when(F.col("n") == 2, d[1]).otherwise(d[2])
    rows = counts.withColumn("context", F.expr(f"gram div {SYMBOLS}")).withColumn("d", discount)
    sums = rows.groupBy("context").agg(F.sum("n").alias("total"), F.sum("d").alias("held"))
    shares = rows.join(sums, "context").select("gram", ((F.col("n") - F.col("d")) / F.col("total")).alias("share"))
    return shares, sums.select("context", (F.col("held") / F.col("total")).alias("back"))


def fit(trusted: DataFrame) -> np.ndarray | None:
    """Log2 probabilities of each symbol after each context of ORDER - 1 symbols, as one table; None without text."""
    counts = durable(count_grams(trusted))
    if counts.isEmpty():
        return None
    levels = []
    for order in range(ORDER, 0, -1):
        levels.append([t.toArrow() for t in _order_tables(counts, order)])  # SYMBOLS ** order rows at most, 16 bytes each
        if order > 1:  # how many symbols each shorter n-gram follows
            counts = durable(counts.groupBy((F.col("gram") % SYMBOLS ** (order - 1)).alias("gram")).agg(F.count(F.lit(1)).alias("n")))
    p = np.full(SYMBOLS, 1.0 / SYMBOLS)
    for k, (shares, backs) in enumerate(reversed(levels)):
        back = np.ones(SYMBOLS**k)
        back[backs["context"].to_numpy()] = backs["back"].to_numpy()
        p = (back.reshape(SYMBOLS if k else 1, -1, 1) * p.reshape(-1, SYMBOLS)).ravel()
        p[shares["gram"].to_numpy()] += shares["share"].to_numpy()
    return np.log2(p, out=p).astype(np.float32)


def perplexities(docs: DataFrame, model: np.ndarray | None) -> DataFrame:
    """docs with perplexity and repeats (0 to 1) in place of text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")
    kept = [f for f in docs.schema.fields if f.name != "text"]
    schema = T.StructType([*kept, T.StructField("perplexity", T.DoubleType()), T.StructField("repeats", T.DoubleType()), T.StructField("n_symbols", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, logs = symbol_table(), shared.value
        for b in text_rows(batches):
            out, again, texts = [], [], b.column(at).to_pylist()
            sizes = [len(t or "") for t in texts]
            for t in texts:
                if not t or logs is None:
                    out.append(None)
                    again.append(None)
                    continue
                s = symbols(t, table)
                out.append(float(2.0 ** -logs[grams(s)].mean(dtype=np.float64)))
                again.append(repeated(s))
            yield pa.RecordBatch.from_arrays([*(c for k, c in enumerate(b.columns) if k != at), pa.array(out, pa.float64()), pa.array(again, pa.float64()), pa.array(sizes, pa.int64())], names=schema.names)

    return docs.mapInArrow(run, schema)


def judge(docs: DataFrame, labels: DataFrame, *, quantile: float = QUANTILE, margin: float = MARGIN) -> DataFrame:
    """doc_id and lang of docs with perplexity, repeats, threshold, piece_perplexity, piece_threshold and keep."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    trusted = labels.where("quality = 1 and doc_id is not null").select(F.col("doc_id").cast("long")).distinct()
    docs = docs.select(F.col("doc_id").cast("long"), "text", "lang")
    trusted = durable(trusted)
    n_trusted = trusted.count()
    ids = F.broadcast(trusted) if n_trusted <= BROADCAST_IDS else trusted
    model = fit(docs.join(ids, "doc_id", "left_semi"))
    keyed = docs.withColumn("key", F.xxhash64("doc_id", "text"))
    with_flag = trusted.withColumn("trusted", F.lit(True))
    with_flag = F.broadcast(with_flag) if n_trusted <= BROADCAST_IDS else with_flag
    flagged = keyed.join(with_flag, "doc_id", "left").fillna(False, ["trusted"])
    buckets = pieces.buckets_for(docs)
    known = pieces.fit(keyed.join(ids, "doc_id", "left_semi"), path, buckets)
    priced = pieces.bits(flagged, known, path, buckets) if known else keyed.select("key", F.lit(0.0).alias("bits"), F.lit(0.0).alias("alone"), F.lit(0).alias("pieces")).where("false")
    good = perplexities(keyed, model).join(priced, "key", "left").withColumn("piece_perplexity", F.pow(F.lit(2.0), F.col("bits") / F.col("pieces")))
    good = good.withColumn("order_gain", (F.col("alone") - F.col("bits")) / F.col("pieces"))
    good = good.withColumn("widened", F.col("order_gain") + SCATTER / F.sqrt("pieces"))
    good = durable(good)
    q = F.percentile_approx("perplexity", quantile, 10_000).alias("p"), F.percentile_approx("repeats", quantile, 10_000).alias("r"), F.percentile_approx("piece_perplexity", quantile, 10_000).alias("w"), F.percentile_approx("widened", 1 - quantile, 10_000).alias("g")
    scored = good.join(trusted, "doc_id", "left_semi")
    per_lang = scored.groupBy("lang").agg(*q).where("lang is not null")
    overall = scored.agg(*(x.alias(n) for x, n in zip(q, ("all_p", "all_r", "all_w", "all_g"))))
    out = good.join(F.broadcast(per_lang), "lang", "left").crossJoin(F.broadcast(overall))  # a row per language; one row
    limit, again = F.coalesce("p", "all_p") * margin, F.coalesce("r", "all_r") * margin
    slack = 3 / F.sqrt(F.greatest("n_symbols", F.lit(1)))
    limit, again = limit * (1 + slack), again * (1 + 2 * slack)
    order = F.coalesce("w", "all_w") * margin * (1 + 3 / F.sqrt(F.greatest("pieces", F.lit(1))))
    keep = F.when(limit.isNull(), True).otherwise(F.coalesce((F.col("perplexity") <= limit) & (F.col("repeats") <= again) & F.coalesce((F.col("piece_perplexity") <= order) & (F.col("widened") >= F.coalesce("g", "all_g") - SHORT_OF), F.lit(True)), F.lit(False)))
    return out.select("doc_id", "lang", "perplexity", "repeats", limit.alias("threshold"), "piece_perplexity", order.alias("piece_threshold"), "order_gain", keep.alias("keep"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = judge(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return found.select("doc_id", F.round("perplexity", 4).alias("perplexity"), F.round("repeats", 4).alias("repeats"), F.round("threshold", 4).alias("threshold"),
                        F.round("piece_perplexity", 4).alias("piece_perplexity"), F.round("piece_threshold", 4).alias("piece_threshold"), F.round("order_gain", 4).alias("order_gain"), "keep")
