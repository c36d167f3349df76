"""Word order: a Kneser-Ney model over pairs of subword pieces of all trusted text.

Texts are cut into pieces by a byte-level BPE vocabulary of fewer than PIECES
pieces, so every script is spelt out.  What the corpus adds are pairs of pieces:
their number grows with the corpus and is bounded by nothing but PIECES ** 2.

A task sums the pairs of LOT pieces at a time and deals them by pair to buckets,
as sorted arrays; there are as many buckets as the text has BUCKET_BYTES.  A bucket
holds all places of its pairs, so it counts a pair over all trusted text exactly and
prices it at once: texts, pairs and counts never return to the documents, only sums
per document do, lot by lot.  Figures of single pieces (continuations, context sums,
back-off weights) are PIECES long whatever the corpus is, and are broadcast.  So are
the counts of hot pairs, each at least one in HOT of all pairs of trusted text, so
there are HOT at most: they are priced where they are met, and no bucket gets one.

A trusted document is scored without its own pairs: its count of a pair is taken
from the pair's count and context sum, and a pair only it has is no continuation.
Otherwise rare pairs would be known in trusted documents and unknown in others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hindcast.llm.common import durable, give_back, text_rows
from hindcast.llm.packing import Ids, same_ids

#: Above all ids of the vocabulary; the last begins a text.
PIECES = 1 << 16
#: Above all codes of figures of pieces.
PAIR = 1 << 40
#: Buckets at least, and bytes of text that each further one is for.
BUCKETS, BUCKET_BYTES = 48, 1 << 25
HOT = 1 << 16
#: Pieces, and documents, whose pairs are summed at once by a task.
LOT, LOT_DOCS = 2_000_000, 60_000
SUMS = pa.schema([("lot", pa.int64()), ("keys", pa.list_(pa.int64())), ("pieces", pa.list_(pa.int32())), ("sums", pa.binary())])
PARTS = "bucket int, lot long, keys array<long>, pieces array<int>, trusted binary, pairs binary, docs binary, times binary, sums binary"


def pairs_of(ids: bytes) -> np.ndarray:
    """Codes of the pairs (piece before, piece), the first after the begin of the text."""
    s = np.frombuffer(ids, dtype="<u4").astype(np.uint32)
    return np.concatenate([np.full(1, PIECES - 1, np.uint32), s[:-1]])[: len(s)] << np.uint32(16) | s


def bucket_of(pairs: np.ndarray, buckets: int) -> np.ndarray:
    code = (pairs * np.uint32(0x9E3779B1)).astype(np.uint64)
    code *= np.uint64(buckets)
    code >>= np.uint64(32)
    return code.astype(np.uint16 if buckets <= 1 << 16 else np.uint32)


def buckets_for(docs: DataFrame) -> int:
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(BUCKETS, -(-size // BUCKET_BYTES))


def _packed(a: np.ndarray) -> bytes:
    """The bytes of a, all lowest ones first, compressed."""
    a = np.ascontiguousarray(a)
    return np.uint32(len(a)).tobytes() + pa.compress(a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes(), codec="zstd", asbytes=True)


def _unpacked(b: bytes, kind: str) -> np.ndarray:
    n, size = int(np.frombuffer(b[:4], np.uint32)[0]), np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(b[4:], n * size, codec="zstd", asbytes=True), np.uint8).reshape(size, n)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _document_sums(model: dict, pairs: np.ndarray, counts: np.ndarray, own: np.ndarray, docs: np.ndarray, times: np.ndarray) -> bytes:
    """The packed bits of each document's pairs: after the piece before, and by themselves."""
    size = int(docs.max()) + 1 if len(docs) else 0
    return _packed(np.concatenate([np.bincount(docs, x * times, size) for x in costs(model, pairs, counts, own)]).astype(np.float32))


def deal(docs: DataFrame, path: str, buckets: int, *, merged: bool = False, shared: Broadcast | None = None) -> DataFrame:
    """PARTS of docs (key, text, trusted): the pairs of a lot that fall into a bucket, with documents and counts.

    A row without pairs holds the lot's keys, numbers of pieces and, if a model
    is shared, what hot pairs come to.  If merged, a lot is taken as one document.
    """
    fast = same_ids(docs.sparkSession, path)

    def lot(number: int, keys: list[int], trusted: list[bool], pairs: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32 | number
        if merged:
            keys, trusted, pairs = keys[:1], trusted[:1], [np.concatenate(pairs)]
        sizes = [len(p) for p in pairs]
        code = np.concatenate(pairs).astype(np.uint64)
        pairs.clear()
        code <<= np.uint64(16)
        code |= np.repeat(np.arange(len(keys), dtype=np.uint16), sizes)
        code.sort()
        first = np.flatnonzero(np.append(True, code[1:] != code[:-1])).astype(np.int32)
        code, times = code[first], np.diff(np.append(first, np.int32(len(code))))
        times = times.astype(np.uint32)
        doc = code.astype(np.uint16)
        code >>= np.uint64(16)
        pair = code.astype(np.uint32)
        del code, first
        flags, rows = np.packbits(np.array(trusted, dtype=bool)).tobytes(), []
        if not merged:
            sums = None
            if shared:
                hot, counts = shared.value["hot"], shared.value["hot_counts"]
                at = np.minimum(np.searchsorted(hot, pair), max(0, len(hot) - 1))
                met = hot[at] == pair if len(hot) else np.zeros(len(pair), dtype=bool)
                own = np.where(np.array(trusted, dtype=bool)[doc[met]], times[met], np.uint32(0)).astype(np.int64)
                sums = _document_sums(shared.value, pair[met], counts[at[met]], own, doc[met], times[met])
                pair, doc, times = pair[~met], doc[~met], times[~met]
            rows.append((number % buckets, number, keys, sizes, flags, None, None, None, sums))
        bucket = bucket_of(pair, buckets)
        order = np.argsort(bucket, kind="stable").astype(np.int32)
        bucket = bucket[order]
        ends = np.flatnonzero(np.append(bucket[1:] != bucket[:-1], True)) + 1 if len(bucket) else []
        for begin, end in zip([0, *ends], ends):
            at = order[begin:end]
            some = pair[at]
            rows.append((int(bucket[begin]), number, None, None, flags, _packed(np.diff(some, prepend=np.uint32(0))), _packed(doc[at]), _packed(times[at]), None))
            if len(rows) == 8:
                yield batch(rows)
                rows = []
        if rows:
            yield batch(rows)

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), *[pa.binary()] * 5)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["bucket", "lot", "keys", "pieces", "trusted", "pairs", "docs", "times", "sums"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, number, keys, trusted, pairs, n = Ids(path, fast), 0, [], [], [], 0
        for b in text_rows(batches):
            texts = [t or "" for t in b.column(1).to_pylist()]
            for key, good, found in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), ids(texts)):
                if not found:
                    continue
                keys.append(key)
                trusted.append(good)
                pairs.append(pairs_of(found))
                n += len(pairs[-1])
                if n >= LOT or len(keys) == LOT_DOCS:
                    yield from lot(number, keys, trusted, pairs)
                    give_back()
                    number, keys, trusted, pairs, n = number + 1, [], [], [], 0
        if keys:
            yield from lot(number, keys, trusted, pairs)
        del ids
        give_back()

    return docs.select("key", "text", "trusted").mapInArrow(run, PARTS)


def _parts(table: pa.Table) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(row, pairs, trusted, docs, times) of each lot in a bucket."""
    for r in range(table.num_rows):
        flags, pairs, docs, times = (table.column(c)[r].as_py() for c in ("trusted", "pairs", "docs", "times"))
        if table.column("keys")[r].is_valid:
            continue
        doc = _unpacked(docs, "u2")
        good = np.unpackbits(np.frombuffer(flags, np.uint8)).astype(bool)[doc]
        yield r, np.cumsum(_unpacked(pairs, "u4"), dtype=np.uint32), good, doc, _unpacked(times, "u4").astype(np.int64)


def _counted(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """All trusted pairs of a bucket, sorted, and their counts; lots wait until they are as many pairs as are merged, so each is sorted a few times only."""
    pairs, counts, waiting, n = np.zeros(0, np.uint32), np.zeros(0, np.int64), [], 0

    def merged() -> tuple[np.ndarray, np.ndarray]:
        found, at = np.unique(np.concatenate([pairs, *(p for p, _ in waiting)]), return_inverse=True)
        return found, np.bincount(at, np.concatenate([counts, *(t for _, t in waiting)]), len(found)).astype(np.int64)

    for _, p, good, _, times in _parts(table):
        waiting.append((p[good], times[good]))
        n += len(waiting[-1][0])
        if n >= max(len(pairs), 1 << 18):
            pairs, counts = merged()
            waiting, n = [], 0
    return merged() if waiting else (pairs, counts)


def discounts(tallies: list[int]) -> np.ndarray:
    """Discounts of counts 0, 1, 2, 3 and more, from how many n-grams have counts 1, 2, 3, 4."""
    n1, n2, n3, n4 = tallies
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    return np.array([0.0, *(min(k, max(0.05, k - (k + 1) * y * b / a)) if a else 0.5 for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4)))])


def fit(trusted: DataFrame, path: str, buckets: int) -> dict | None:
    """Discounts, hot pairs, and per piece: context sum, back-off weight and continuations; None without trusted text."""

    def figures(table: pa.Table) -> pa.Table:
        pairs, counts = _counted(table)
        left, right, kind = pairs >> np.uint32(16), pairs & np.uint32(0xFFFF), np.minimum(counts, 4)
        out = [(left, kind, counts), (right, np.zeros(len(pairs), np.int64), np.ones(len(pairs), np.int64))]
        piece, kind, total = (np.concatenate(x) for x in zip(*out))
        code, at = np.unique(piece.astype(np.int64) * 8 + kind, return_inverse=True)
        n = np.bincount(at, minlength=len(code)).astype(np.int64)
        often = counts * HOT >= counts.sum()  # holds for hot pairs, and for some others
        return pa.table({"code": np.concatenate([code, pairs[often].astype(np.int64) + PAIR]), "n": np.concatenate([n, np.zeros(often.sum(), np.int64)]),
                         "total": np.concatenate([np.bincount(at, total, len(code)).astype(np.int64), counts[often]])})

    dealt = deal(trusted.withColumn("trusted", F.lit(True)), path, buckets, merged=True).groupBy("bucket")
    figured = durable(dealt.applyInArrow(figures, "code long, n long, total long"))
    found = figured.where(F.col("code") < PAIR).groupBy("code").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).toArrow()  # 5 * PIECES rows at most, 24 bytes each
    if not found.num_rows:
        return None
    code, n, total = (found[c].to_numpy() for c in ("code", "n", "total"))
    hot = figured.where((F.col("code") >= PAIR) & (F.col("total") * HOT >= int(total.sum()))).orderBy("code").toArrow()  # HOT rows at most
    piece, kind = code // 8, code % 8
    of = lambda k: np.bincount(piece[kind == k], n[kind == k], PIECES)
    kinds = [of(k) for k in range(5)]
    d = discounts([int(k.sum()) for k in kinds[1:]])
    context = kind > 0
    sums = np.bincount(piece[context], total[context], PIECES)
    held = kinds[1] * d[1] + kinds[2] * d[2] + (kinds[3] + kinds[4]) * d[3]
    return {"hot": (hot["code"].to_numpy() - PAIR).astype(np.uint32), "hot_counts": hot["total"].to_numpy(), "d": d, "sums": sums, "held": held, "follows": kinds[0], "d1": discounts([int((kinds[0] == k).sum()) for k in (1, 2, 3, 4)])}


def costs(model: dict, pairs: np.ndarray, counts: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bits that each pair's piece takes after the piece before, and by itself, when `own` of the pair's count is left out."""
    d, d1, left, right = model["d"], model["d1"], pairs >> np.uint32(16), pairs & np.uint32(0xFFFF)
    capped = lambda c: np.minimum(c, 3).astype(np.int64)
    follows = model["follows"]
    rest = d1[capped(follows)].sum()
    total = follows.sum()
    f = follows[right] - ((own > 0) & (counts == own))
    low = (f - d1[capped(f)]) / total + rest / total / PIECES
    c = counts - own
    context = model["sums"][left] - own
    held = model["held"][left] - d[capped(counts)] + d[capped(c)]
    safe = np.maximum(context, 1)
    p = np.where(context > 0, (c - d[capped(c)]) / safe + held / safe * low, low)
    return -np.log2(p), -np.log2(low)


def bits(docs: DataFrame, model: dict, path: str, buckets: int) -> DataFrame:
    """(key, bits, alone, pieces) of docs (key, text, trusted) with text: what all pieces take after the piece before, and by themselves, and their number.

    Documents of one key are the same text; their sums are added up on both sides.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def price(table: pa.Table) -> pa.Table:
        known, counts = _counted(table)
        heads = table.filter(pc.is_valid(table.column("keys")))
        out = [pa.table({"lot": heads.column("lot"), "keys": heads.column("keys"), "pieces": heads.column("pieces"), "sums": heads.column("sums")})]
        for r, pairs, good, doc, times in _parts(table):
            at = np.minimum(np.searchsorted(known, pairs), max(0, len(known) - 1))
            count = np.where(known[at] == pairs, counts[at], 0) if len(known) else np.zeros(len(pairs), np.int64)
            sums = _document_sums(shared.value, pairs, count, np.where(good, times, 0), doc, times)
            out.append(pa.table({"lot": pa.array([table.column("lot")[r].as_py()], pa.int64()), "keys": pa.nulls(1, pa.list_(pa.int64())),
                                 "pieces": pa.nulls(1, pa.list_(pa.int32())), "sums": pa.array([sums], pa.binary())}))
        return pa.concat_tables([t.cast(SUMS) for t in out])

    def total(table: pa.Table) -> pa.Table:
        keys, n, sums = [], [], np.zeros((2, 1 << 16))
        for k, p, s in zip(table.column("keys").to_pylist(), table.column("pieces").to_pylist(), table.column("sums").to_pylist()):
            if k is not None:
                keys, n = k, p
            if s is not None:
                part = _unpacked(s, "f4").reshape(2, -1)
                sums[:, : part.shape[1]] += part
        return pa.table({"key": pa.array(keys, pa.int64()), "bits": sums[0, : len(keys)], "alone": sums[1, : len(keys)], "pieces": pa.array(n, pa.int64())})

    priced = deal(docs, path, buckets, shared=shared).groupBy("bucket").applyInArrow(price, "lot long, keys array<long>, pieces array<int>, sums binary")
    each = priced.groupBy("lot").applyInArrow(total, "key long, bits double, alone double, pieces long")
    return each.groupBy("key").agg(F.sum("bits").alias("bits"), F.sum("alone").alias("alone"), F.sum("pieces").alias("pieces"))
