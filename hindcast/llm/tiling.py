"""Benchmark decontamination: greedy string tiling.

Texts become lower-case words.  Every run of `least` words of a benchmark item
is a seed; documents and items that share seeds are joined on them, and a pair
is tiled only if its seeds could reach the coverage asked for.  Tiling finds
maximal matches of unmarked words by running Karp-Rabin hashes, marks the
longest first without overlap, and goes on with shorter ones down to `least`
words, so reordered passages are still covered.

The seeds of a document pass a bitmap of the benchmark's seeds (2^BITS bits,
whatever the benchmark's size) before they are shuffled.

Defined results: null or blank texts match nothing; an item shorter than
`least` words is one seed of all its words and found as such; equal items are reported under each
item_id; equal rows of one doc_id are reported once; rows with a null id are
left out, having nothing to report them by; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hindcast.llm.common import WordHashes, durable, shingles, text_rows

LEAST = 4
COVERAGE = 0.6
BITS = 20
WORD = re.compile(r"\w+")
#: Pairs of ids that may be broadcast (16 bytes each); more of them are shuffled.
BROADCAST_PAIRS = 1_000_000


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def _matches(a: list, b: list, free_a: list[bool], free_b: list[bool], n: int) -> list[tuple[int, int, int]]:
    """Maximal matches (length, place in a, place in b) of at least n unmarked words, by running hashes."""
    base, mod = 1_000_003, (1 << 61) - 1
    top = pow(base, n - 1, mod)

    def windows(x: list, free: list[bool]) -> Iterator[tuple[int, int]]:
        h = run = 0
        for i, w in enumerate(x):
            if not free[i]:
                h = run = 0
                continue
            if run >= n:
                h -= x[i - n] * top
                run -= 1
            h = (h * base + w) % mod
            run += 1
            if run == n:
                yield i - n + 1, h

    places: dict[int, list[int]] = {}
    for i, h in windows(a, free_a):
        places.setdefault(h, []).append(i)
    found = []
    for j, h in windows(b, free_b):
        for i in places.get(h, ()):
            if i and j and free_a[i - 1] and free_b[j - 1] and a[i - 1] == b[j - 1]:
                continue  # part of a match that began before
            k = 0
            while i + k < len(a) and j + k < len(b) and free_a[i + k] and free_b[j + k] and a[i + k] == b[j + k]:
                k += 1
            if k >= n:
                found.append((k, i, j))
    return found


def tiles(a: list, b: list, least: int = LEAST) -> list[tuple[int, int, int]]:
    """Non-overlapping matches of a and b (lists of integers), longest first: (length, place in a, place in b)."""
    free_a, free_b, out = [True] * len(a), [True] * len(b), []
    n = max(least, min(len(a), len(b)) // 2)
    while True:
        found = _matches(a, b, free_a, free_b, n) if n <= min(len(a), len(b)) else []
        cut = False
        for k, i, j in sorted(found, key=lambda m: (-m[0], m[1], m[2])):
            if all(free_a[i : i + k]) and all(free_b[j : j + k]):
                free_a[i : i + k] = [False] * k
                free_b[j : j + k] = [False] * k
                out.append((k, i, j))
            else:
                cut = True  # what is left of it may be long enough
        if cut and any(k >= n for k, _, _ in found):
            continue
        if n == least:
            return sorted(out, key=lambda m: (-m[0], m[1], m[2]))
        n = max(least, n // 2)


def _seed_rows(frame: DataFrame, id_column: str, lengths: list[int], bitmap: np.ndarray | None) -> DataFrame:
    """(id, seed, times, words): distinct seeds of each text.

    Without a bitmap (for items) a text shorter than the one length is one seed;
    with it (for documents) all runs of these lengths are taken that it holds.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes_of = WordHashes()
        for b in text_rows(batches):
            ids, words = b.column(0).to_pylist(), [words_of(t) for t in b.column(1).to_pylist()]
            hashes = hashes_of([w.encode() for ws in words for w in ws])
            at, out = 0, []
            for doc, ws in zip(ids, words, strict=True):
                own = hashes[at : at + len(ws)]
                at += len(ws)
                seeds = [shingles(own, n) for n in lengths if bitmap is None or n <= len(ws)]
                seeds = np.concatenate([*seeds, hashes[:0]])
                if bitmap is not None:
                    seeds = seeds[bitmap[seeds & np.uint64(len(bitmap) - 1)]]
                if len(seeds):
                    seeds, times = np.unique(seeds, return_counts=True)
                    out.append((np.full(len(seeds), doc), seeds.view(np.int64), times, np.full(len(seeds), len(ws))))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in zip(*out)], names=["id", "seed", "times", "words"])

    rows = frame.select(F.col(id_column).cast("long"), "text").where(f"{id_column} is not null and text is not null")
    return rows.mapInArrow(run, "id long, seed long, times long, words long")


def contaminated(docs: DataFrame, benchmark: DataFrame, *, least: int = LEAST, coverage: float = COVERAGE) -> DataFrame:
    """(doc_id, item_id, item_words, covered_words, coverage, tiles) of pairs whose tiles cover the share asked for.

    tiles is an array of (length, item_at, doc_at), in words, longest first.
    """
    seeds = durable(_seed_rows(benchmark, "item_id", [least], None))
    bits = seeds.select(F.expr(f"seed & {(1 << BITS) - 1}").alias("bit")).distinct().toPandas()["bit"].to_numpy()
    bitmap = np.zeros(1 << BITS, dtype=bool)  # 1 MB at most, as are the distinct bits
    bitmap[bits] = True
    short = [r["words"] for r in seeds.where(F.col("words") < least).select("words").distinct().collect()]
    hits = _seed_rows(docs, "doc_id", [least, *sorted(short)], bitmap).select(F.col("id").alias("doc"), "seed").distinct()
    pairs = hits.join(seeds.withColumnRenamed("id", "item"), "seed").groupBy("doc", "item").agg(F.sum("times").alias("n"), F.max("words").alias("words"))
    # A tile of t words holds t - least + 1 of the item's seeds, so that many are needed for the coverage.
    # An item shorter than that is one seed.
    pairs = durable(pairs.where(F.col("n") * F.least(F.lit(least), F.col("words")) >= F.lit(coverage) * F.col("words")).select("doc", "item"))
    items = benchmark.select(F.col("item_id").cast("long").alias("item"), F.col("text").alias("item_text")).dropDuplicates(["item", "item_text"])
    small = (lambda x: F.broadcast(x)) if pairs.count() <= BROADCAST_PAIRS else (lambda x: x)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc"), "text").where("text is not null")
    texts = texts.join(small(pairs), "doc").join(items, "item").select("doc", "item", "text", "item_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_rows(batches, 64):
            rows = []
            for doc, item, text, item_text in zip(*(c.to_pylist() for c in b.columns)):
                a, d = words_of(item_text), words_of(text)
                number = {w: k + 1 for k, w in enumerate(dict.fromkeys(a))}
                found = tiles([number[w] for w in a], [number.get(w, 0) or -1 - k for k, w in enumerate(d)], min(least, len(a)))
                covered = sum(k for k, _, _ in found)
                rows.append((doc, item, len(a), covered, covered / len(a), [dict(zip(("length", "item_at", "doc_at"), x)) for x in found]))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), ARROW)], schema=ARROW)

    part = pa.list_(pa.struct([(x, pa.int32()) for x in ("length", "item_at", "doc_at")]))
    ARROW = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("item_words", pa.int64()), ("covered_words", pa.int64()), ("coverage", pa.float64()), ("tiles", part)])
    schema = "doc_id long, item_id long, item_words long, covered_words long, coverage double, tiles array<struct<length:int,item_at:int,doc_at:int>>"
    tiled = texts.mapInArrow(run, schema).where(F.col("coverage") >= coverage)
    best = F.max_by(F.struct("item_words", "covered_words", "coverage", "tiles"), F.struct("coverage", "item_words"))
    return tiled.groupBy("doc_id", "item_id").agg(best.alias("b")).select("doc_id", "item_id", "b.*")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contaminated(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    spans = F.transform("tiles", lambda t: F.concat_ws(":", *[t[x].cast("string") for x in ("item_at", "doc_at", "length")]))
    return found.select("doc_id", "item_id", "item_words", "covered_words", F.round("coverage", 6).alias("coverage"), F.array_join(spans, ",").alias("tiles"))
