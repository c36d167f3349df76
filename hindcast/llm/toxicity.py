"""Toxicity: distance-weighted votes of the nearest labelled examples.

Documents are TF-IDF vectors over terms (words and their beginnings) that tell
toxic from other labelled documents: those that lean to toxic ones by a likelihood
ratio that chance would give less than once among all terms seen.  IDF is over all
documents.  The k nearest examples by cosine are found
exactly in a block-max index: examples stand in blocks, each term's largest
weight in each block bounds what a block can score, and blocks are read from the
highest bound down until no bound beats the k-th best.  The votes are weighted
by cosine; leave-one-out votes of the examples themselves, in Spark, turn them
into calibrated scores.

The examples are a bounded sample of the labelled rows (`most_examples` of each
class, by a hash of the id); each class counts with the weight that the sample
took from it.  The index holds their telling terms, a few per example, and is
broadcast.

Defined results: null or empty texts, and texts without any telling term, score
the calibrated rate of such examples; without labels of both classes all score
the share of toxic labels (0 without labels); a null doc_id is scored and not
held out; repeated rows each give a row; repeated labels of one id count once,
toxic if any is; ties between examples go by their order in the index; an empty
table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hindcast.llm.common import durable, fold, text_rows

WORD = re.compile(r"\w+")
#: Beginnings of words that are terms too, so that inflected forms share one.
BEGINNINGS = (4, 5, 6)
BLOCK = 64
BINS = 20
#: Cosine that the overall rate counts for in a vote, so that weak neighbours say little.
PRIOR = 0.2


def terms_of(word: str) -> list[str]:
    return [word, *(f"{word[:n]}~" for n in BEGINNINGS if len(word) > n)]


def code(term: str) -> int:
    raw = term.encode()
    return zlib.crc32(raw) << 31 | zlib.adler32(raw) >> 1


class Terms:
    """Counts the telling terms of texts; what each word contributes is cached per worker."""

    def __init__(self, codes: np.ndarray | None) -> None:
        self.place = None if codes is None else {int(c): k for k, c in enumerate(codes)}
        self.known: dict[str, tuple[int, ...]] = {}

    def __call__(self, text: str | None) -> Counter:
        known, place = self.known, self.place
        if len(known) > 300_000:
            known.clear()
        out: Counter = Counter()
        for word, times in Counter(WORD.findall((text or "").lower())).items():
            ids = known.get(word)
            if ids is None:
                codes = [code(t) for t in terms_of(word)]
                ids = known[word] = tuple(codes) if place is None else tuple(place[c] for c in codes if c in place)
            for k in ids:
                out[k] += times
        return out


class BlockMaxIndex:
    """Unit vectors of examples in blocks, with each term's largest weight per block."""

    def __init__(self, codes: np.ndarray, idf: np.ndarray, rows: list[tuple[int, int, float, dict[int, int]]]) -> None:
        self.codes, self.idf = codes, idf
        rows = sorted(rows, key=lambda r: (sorted(r[3].items(), key=lambda x: -self.idf[x[0]])[:3], r[0]))
        self.ids = np.array([r[0] for r in rows], dtype=np.int64)
        self.toxic = np.array([r[1] for r in rows], dtype=np.float64)
        self.weight = np.array([r[2] for r in rows], dtype=np.float64)
        self.starts = np.zeros(len(rows) + 1, dtype=np.int64)
        terms, values = [], []
        for k, r in enumerate(rows):
            t, v = self.vector(r[3])
            terms.append(t)
            values.append(v)
            self.starts[k + 1] = self.starts[k] + len(t)
        self.terms = np.concatenate([*terms, np.zeros(0, np.int64)]).astype(np.int64)
        self.values = np.concatenate([*values, np.zeros(0)])
        blocks = -(-len(rows) // BLOCK)
        self.bound = np.zeros((len(codes), blocks), dtype=np.float32)
        block = np.repeat(np.arange(len(rows)) // BLOCK, np.diff(self.starts))
        np.maximum.at(self.bound, (self.terms, block), np.nextafter(self.values.astype(np.float32), np.float32(2)))

    @classmethod
    def of(cls, arrays: dict | None) -> BlockMaxIndex | None:
        """An index from the arrays of another: broadcasts carry arrays, not classes."""
        if arrays is None:
            return None
        out = object.__new__(cls)
        out.__dict__.update(arrays)
        return out

    def vector(self, counts: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
        t = np.array(sorted(counts), dtype=np.int64)
        v = (1 + np.log(np.array([counts[k] for k in t.tolist()], dtype=np.float64))) * self.idf[t] if len(t) else np.zeros(0)
        norm = np.sqrt((v * v).sum())
        return t, v / norm if norm else v

    def nearest(self, counts: dict[int, int], k: int, without: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(examples, cosines) of the k nearest with a positive cosine, best first; exact."""
        t, v = self.vector(counts)
        query = np.zeros(len(self.codes))
        query[t] = v
        bound = v @ self.bound[t].astype(np.float64)
        best, cosines = np.zeros(0, np.int64), np.zeros(0)
        for b in np.argsort(-bound, kind="stable"):
            if bound[b] <= 0 or (len(best) == k and bound[b] < cosines[-1]):
                break
            first, last = b * BLOCK, min(len(self.ids), (b + 1) * BLOCK)
            lo, hi = self.starts[first], self.starts[last]
            score = np.add.reduceat(np.append(self.values[lo:hi] * query[self.terms[lo:hi]], 0.0), self.starts[first:last] - lo)
            if without is not None:
                score[self.ids[first:last] == without] = 0
            best, cosines = np.append(best, np.arange(first, last)), np.append(cosines, score)
            order = np.lexsort((best, -cosines))[:k]
            order = order[cosines[order] > 1e-9]
            best, cosines = best[order], cosines[order]
        return best, cosines

    def vote(self, counts: dict[int, int], k: int, prior: float, without: int | None = None) -> tuple[float, np.ndarray, np.ndarray]:
        best, cosines = self.nearest(counts, k, without)
        w = cosines * cosines * self.weight[best] / max(self.weight.max(), 1e-9) if len(best) else cosines
        return float((w @ self.toxic[best] + PRIOR * prior) / (w.sum() + PRIOR)), best, cosines


def _examples(docs: DataFrame, labels: DataFrame, most_examples: int) -> tuple[DataFrame, dict[int, float]]:
    """(doc_id, text, toxic) of the sampled examples, and the weight of each class."""
    known = labels.select("doc_id", "toxic").where("doc_id is not null and toxic is not null").where(fold() != 2)
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen, weights = None, {}
    totals = {int(r["toxic"]): r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    for kind in (0, 1):
        some = known.where(F.col("toxic") == kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_examples)
        weights[kind] = totals.get(kind, 0) / max(1, min(most_examples, totals.get(kind, 0)))
        chosen = some if chosen is None else chosen.union(some)
    rows = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(chosen), "doc_id")  # 2 * most_examples ids
    return rows.select("doc_id", "text", F.col("toxic").cast("int")), weights


def fit(docs: DataFrame, labels: DataFrame, *, most_examples: int = 10_000, k: int = 15) -> dict:
    """The model: index, prior, and the calibrated rates of vote bins and of examples without telling terms."""
    examples, class_weight = _examples(docs, labels, most_examples)
    examples = durable(examples)
    sizes = {int(r["toxic"]): r["n"] for r in examples.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(sizes.get(c, 0) * class_weight[c] for c in (0, 1))
    prior = sizes.get(1, 0) * class_weight[1] / total if total else 0.0
    model = {"index": None, "prior": prior, "k": k, "rates": None, "empty": prior}
    if len(sizes) < 2:
        return model

    def presence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, toxic, every = Terms(None), Counter(), Counter()
        for b in text_rows(batches):
            for text, label in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                found = terms(text).keys()
                every.update(found)
                if label:
                    toxic.update(found)
        if every:
            codes = np.fromiter(every, dtype=np.int64, count=len(every))
            for at in range(0, len(codes), 50_000):
                some = codes[at : at + 50_000].tolist()
                yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array([toxic[c] for c in some], pa.int64()), pa.array([every[c] for c in some], pa.int64())], names=["term", "toxic", "n"])

    spread = examples.repartition(24, "doc_id")
    counts = spread.mapInArrow(presence, "term long, toxic long, n long").groupBy("term").agg(F.sum("toxic").alias("t"), F.sum("n").alias("n"))
    T, N = sizes[1], sizes[0] + sizes[1]
    share = T / N
    plain = lambda a, e: F.when(a > 0, a * F.log(a / e)).otherwise(0.0)
    t, n = F.col("t"), F.col("n")
    gain = 2 * (plain(t, n * share) + plain(n - t, n * (1 - share)))
    counts = durable(counts)
    chance = 2 * np.log(max(2, counts.count()))
    codes = np.sort(counts.where(t > n * min(0.95, 2 * share)).where(gain > chance).select("term").toPandas()["term"].to_numpy(np.int64))  # terms of the sample

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, seen = Terms(codes), np.zeros(len(codes) + 1, dtype=np.int64)
        for b in text_rows(batches):
            for text in b.column(0).to_pylist():
                seen[[*terms(text), len(codes)]] += 1
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(seen), pa.int64()), pa.array(seen[seen > 0])], names=["place", "n"])

    spans = docs.select("text").mapInArrow(frequencies, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).toPandas()
    seen = np.zeros(len(codes) + 1)
    seen[spans["place"].to_numpy(np.int64)] = spans["n"].to_numpy()
    idf = np.log((seen[-1] + 1) / np.maximum(seen[:-1], 1))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms(codes)
        for b in text_rows(batches):
            found = [terms(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array([sorted(c) for c in found], pa.list_(pa.int32())), pa.array([[c[x] for x in sorted(c)] for c in found], pa.list_(pa.int32()))],
                names=["doc_id", "toxic", "terms", "times"])

    vector = durable(spread.mapInArrow(vectors, "doc_id long, toxic int, terms array<int>, times array<int>"))
    rows = [(r["doc_id"], r["toxic"], class_weight[r["toxic"]], dict(zip(map(int, r["terms"]), map(int, r["times"]))))
            for r in vector.where("size(terms) > 0").orderBy("doc_id").toPandas().to_dict("records")]  # the bounded sample
    bare = {int(r["toxic"]): r["n"] * class_weight[r["toxic"]] for r in vector.where("size(terms) = 0").groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    model["empty"] = (bare.get(1, 0) + prior) / (sum(bare.values()) + 1)
    if not rows:
        return model
    index = model["index"] = BlockMaxIndex(codes, idf, rows)
    shared = docs.sparkSession.sparkContext.broadcast(index.__dict__)

    def leave_one_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = BlockMaxIndex.of(shared.value)
        for b in batches:
            votes = [index.vote(dict(zip(t, c)), k, prior, d)[0] for d, t, c in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array([min(BINS - 1, int(v * BINS)) for v in votes], pa.int32()), b.column(1)], names=["bin", "toxic"])

    bins = vector.where("size(terms) > 0").repartition(24).mapInArrow(leave_one_out, "bin int, toxic int").groupBy("bin", "toxic").agg(F.count(F.lit(1)).alias("n")).collect()
    sums = np.zeros((BINS, 2))
    for r in bins:
        sums[r["bin"], r["toxic"]] = r["n"] * class_weight[r["toxic"]]
    model["rates"] = _monotone(sums, prior)
    return model


def _monotone(sums: np.ndarray, prior: float) -> np.ndarray:
    """Non-decreasing toxic rates of vote bins: neighbouring bins that fall are pooled; empty ones get their middle."""
    pools: list[list[float]] = []
    for b, (clean, toxic) in enumerate(sums):
        middle = (b + 0.5) / BINS
        pools.append([toxic + middle, clean + toxic + 1, 1])
        while len(pools) > 1 and pools[-2][0] / pools[-2][1] > pools[-1][0] / pools[-1][1]:
            last = pools.pop()
            pools[-1] = [x + y for x, y in zip(pools[-1], last)]
    return np.concatenate([np.full(int(p[2]), p[0] / p[1]) for p in pools])


def score_documents(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, score, neighbours (array of (doc_id, cosine, toxic)), the evidence."""
    shared, prior, k = docs.sparkSession.sparkContext.broadcast(model["index"] and model["index"].__dict__), model["prior"], model["k"]
    rates, empty = model["rates"], float(model["empty"])
    part = pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("toxic", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = BlockMaxIndex.of(shared.value)
        terms = Terms(index.codes) if index else None
        for b in text_rows(batches):
            scores, near = [], []
            for text in b.column(1).to_pylist():
                counts = terms(text) if terms else None
                if not counts:
                    scores.append(empty)
                    near.append([])
                    continue
                raw, best, cosines = index.vote(counts, k, prior)
                scores.append(float(rates[min(BINS - 1, int(raw * BINS))]))
                near.append([{"doc_id": int(index.ids[e]), "cosine": float(c), "toxic": int(index.toxic[e])} for e, c in zip(best, cosines)])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores, pa.float64()), pa.array(near, part)], names=["doc_id", "score", "neighbours"])

    schema = "doc_id long, score double, neighbours array<struct<doc_id:long,cosine:double,toxic:int>>"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = score_documents(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return found.select("doc_id", F.coalesce(fold() == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "neighbours")
