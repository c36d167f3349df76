"""N-gram Jaccard join: multiple-global-order filtering, then exact verification.

Two documents link when 100 * |A & B| >= percent * |A | B| over their sets of
distinct n-word shingles.  Under any one order of all shingles, two such sets
share a shingle among the first n - ceil(t * n) + 1 of each (their prefixes).
Two orders are used; a pair must share a prefix shingle under both before it is
verified.  Both put frequent shingles last, as a count sketch of fixed size over
all documents tells: one goes by the count, the other by a coarse class of it,
and each by another hash where those are equal.  What is left is checked by an
upper bound on the intersection (smaller counts per bucket of hashes, added up),
which costs a tenth of the bytes of the sets, and then on the sets themselves.

Links are needed up to what they connect, so the join goes in two rounds, over
one document of each set (copies of a set are one node throughout).
First each document is compared with its hub, of those it shares prefix shingles
with the one that shares most with others, and with its root, where following hubs
ends, as far as samples of both sets say that they are alike; the documents of one root are a family, and in a family one more is chosen by
the differences from the root.  What that links is merged; after that only pairs
across merged components can add anything, and all of those are compared.  Across families they come from shared
prefix shingles.  In a family nearly all would share the root's shingles, so there
the filter runs over what tells members from the root: two members that are
similar either both link with the root, or share enough of those tokens.

A document with many partners, on either side of a pair, has them dealt out in
lots; hot shingles are split by adaptive joins, which have no group to gather.

Sets are 64-bit hashes of shingles.  Defined results: without words or text a
set is empty and links with nothing; with fewer than n words the whole sequence
is the one shingle; rows with null doc_id are left out; a doc_id that comes more
than once links its texts as one node, and n_shingles is the largest; an empty
table gives no rows; no columns beside doc_id and text are looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hindcast.llm.common import WordHashes, components, durable, mix, shingles, text_rows

#: Counters of the frequency sketch (4 bytes each), whatever the input's size.
SKETCH = 1 << 20
CHUNK = 1 << 14
#: Buckets of the upper bound on an intersection.
BUCKETS = 512
#: Rows of (document, partner) that may be broadcast, 40 bytes each; more of them are shuffled.
BROADCAST_ROWS = 1_000_000
#: Partners that a document is compared with in one place, about.
LOT = 1 << 14
#: Ids of copies that may be broadcast (8 bytes each); more of them are shuffled.
BROADCAST_IDS = 2_000_000
#: Times that the way to the root is doubled: 2 ** JUMPS hubs at most are followed.
JUMPS = 3
#: Similarity with the root from which a document is compared inside the family.
NEAR = 0.2
#: Shingles in a set's sample, those of the smallest hashes, and the share of it that a document has in common with a hub on its way to the root.
SAMPLE, ALIKE = 32, 0.1
SECOND = np.uint64(0xA0761D6478BD642F)


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case."""
    return (text or "").encode().lower().split()


def sets_of(texts: list[str], n: int, hashes_of: WordHashes) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text; the batch's words are hashed and rolled in one go."""
    words = [words_of(t) for t in texts]
    flat = hashes_of([w for ws in words for w in ws])
    rolled = shingles(flat, n) if len(flat) >= n else flat[:0]
    at = 0
    for ws in words:
        if len(ws) >= n:
            s = np.sort(rolled[at : at + len(ws) - n + 1])
            yield s[np.append(True, s[1:] != s[:-1])]
        else:
            yield shingles(flat[at : at + len(ws)], n)
        at += len(ws)


def _over(docs: DataFrame, rows_of: Callable, schema: str, arrow: pa.Schema) -> DataFrame:
    """Runs rows_of(ids, texts, hashes_of) -> columns over (doc_id, text) in small batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes_of = WordHashes()
        for b in text_rows(batches):
            columns = rows_of(b.column(0).to_pylist(), b.column(1).to_pylist(), hashes_of)
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, arrow)], schema=arrow)

    return docs.mapInArrow(run, schema)


def _survey(docs: DataFrame, n: int) -> tuple[DataFrame, np.ndarray]:
    """(doc, n, s1, s2): set size and 128-bit signature of each set; and the sketch.

    The sketch counts, for each of SKETCH buckets, how many documents hold a
    shingle of it.  Both come from one pass; partial sketches are added up by
    chunks, and SKETCH counters in all reach the driver.
    """
    arrow = pa.schema([("doc", pa.int64()), ("n", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()), ("chunk", pa.int32()), ("counts", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes_of, counts = WordHashes(), np.zeros(SKETCH, dtype=np.int32)
        for b in text_rows(batches):
            sets = list(sets_of(b.column(1).to_pylist(), n, hashes_of))
            if len(flat := np.concatenate([*sets, np.zeros(0, np.uint64)])):
                buckets, times = np.unique((flat & np.uint64(SKETCH - 1)).astype(np.int64), return_counts=True)
                counts[buckets] += times.astype(np.int32)
            signed = [pa.array(np.array([xxhash.xxh3_64_intdigest(s.tobytes(), k) for s in sets], dtype=np.uint64).view(np.int64)) for k in (1, 2)]
            none = [pa.nulls(len(sets), t) for t in (pa.int32(), pa.binary())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(s) for s in sets], pa.int64()), *signed, *none], schema=arrow)
        chunks = [(k, pa.compress(c.tobytes(), codec="zstd", asbytes=True)) for k, c in enumerate(counts.reshape(-1, CHUNK)) if c.any()]  # sparse ones are small
        if chunks:
            none = [pa.nulls(len(chunks), pa.int64()) for _ in range(4)]
            yield pa.RecordBatch.from_arrays([*none, pa.array([c[0] for c in chunks], pa.int32()), pa.array([c[1] for c in chunks], pa.binary())], schema=arrow)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for b in batches:
            for chunk, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                c = np.frombuffer(pa.decompress(c, 4 * CHUNK, codec="zstd", asbytes=True), dtype=np.int32)
                totals[chunk] = totals.get(chunk, 0) + c.astype(np.int64)
        if totals:
            yield pa.RecordBatch.from_arrays([pa.array(list(totals), pa.int32()), pa.array([t.tobytes() for t in totals.values()], pa.binary())], names=["chunk", "counts"])

    found = durable(docs.mapInArrow(run, "doc long, n long, s1 long, s2 long, chunk int, counts binary"))
    parts = found.where("chunk is not null").select("chunk", "counts").repartition("chunk").mapInArrow(add, "chunk int, counts binary").toPandas()
    sketch = np.zeros((SKETCH // CHUNK, CHUNK), dtype=np.int64)
    for chunk, counts in zip(parts["chunk"], parts["counts"]):
        sketch[chunk] += np.frombuffer(counts, dtype=np.int64)
    return found.where("chunk is null").select("doc", "n", "s1", "s2"), sketch.ravel()


def frequency_class(sketch: np.ndarray) -> np.ndarray:
    """0 for buckets within chance of the mean, above that a class for each doubling."""
    mean = sketch.mean()
    usual = mean + 6 * np.sqrt(mean) + 1
    return np.where(sketch <= usual, 0, 1 + np.log2(np.maximum(sketch - mean, 1)).astype(np.int64)).astype(np.uint8)


def prefix_length(n: int, percent: int) -> int:
    return n - (percent * n + 99) // 100 + 1


def prefixes(s: np.ndarray, sketch: np.ndarray, classes: np.ndarray, percent: int) -> tuple[int, np.ndarray, np.ndarray]:
    """How much the set's first shingles are shared, and these under two orders: (count, hash) and (class of counts, another hash)."""
    k = prefix_length(len(s), percent)
    bucket = (s & np.uint64(SKETCH - 1)).astype(np.int64)
    counts = sketch[bucket].astype(np.uint64)
    one = np.argsort((counts << np.uint64(40)) | (mix(s) >> np.uint64(24)), kind="stable")[:k]
    two = (classes[bucket].astype(np.uint64) << np.uint64(58)) | (mix(s ^ SECOND) >> np.uint64(6))
    return int(counts[one].sum()), s[one], s[np.argsort(two, kind="stable")[:k]]


def sample(s: np.ndarray) -> np.ndarray:
    """The SAMPLE smallest hashes, 32 bits each: whatever is frequent, two sets share about as much of them as of all."""
    h = (mix(s ^ SECOND) >> np.uint64(32)).astype(np.uint32)
    return (np.partition(h, SAMPLE)[:SAMPLE] if len(h) > SAMPLE else h).view(np.int32)


def histogram(s: np.ndarray) -> np.ndarray:
    return np.minimum(np.bincount((s >> np.uint64(50)).astype(np.int64) % BUCKETS, minlength=BUCKETS), 65535).astype(np.uint16)


def may_link(x: np.ndarray, y: np.ndarray, n: int, m: int, percent: int) -> bool:
    """False only if sets of sizes n and m with these histograms can't be similar; full counters prove nothing."""
    both = int(np.minimum(x, y).sum()) if max(x.max(), y.max()) < 65535 else min(n, m)
    return 100 * both >= percent * (n + m - both)


def _side_by_side(pairs: DataFrame, docs: DataFrame, n: int, payload: Callable, judge: Callable, schema: str, arrow: pa.Schema) -> DataFrame:
    """judge(a, b, what a has, what b has) -> rows, for pairs (a, b); payload turns a set into an array to carry.

    Each pair brings b's array to a's place.  Sorted by a with a's own first, a
    task holds one array at a time however many partners it has.
    """
    pairs = durable(pairs)
    total = pairs.count()
    lots = F.lit(1 + total // LOT)  # what a document has of all pairs is dealt to that many places
    pairs = pairs.select("a", "b", F.pmod(F.xxhash64("b"), lots).cast("int").alias("lot_a"), F.pmod(F.xxhash64("a"), lots).cast("int").alias("lot_b"))
    rows = pairs.select(F.col("b").alias("doc"), F.col("lot_b").alias("part"), F.struct("a", F.col("lot_a").alias("lot"), F.lit(1).alias("role")).alias("to")).union(
        pairs.select("a", "lot_a").distinct().select(F.col("a").alias("doc"), F.col("lot_a").alias("part"), F.struct("a", F.col("lot_a").alias("lot"), F.lit(0).alias("role")).alias("to")))
    rows = rows.groupBy("doc", "part").agg(F.collect_list("to").alias("to"))  # about LOT at most
    if total <= BROADCAST_ROWS:
        rows = F.broadcast(rows)
    carried = pa.schema([("a", pa.int64()), ("lot", pa.int32()), ("role", pa.int32()), ("b", pa.int64()), ("kind", pa.string()), ("s", pa.binary())])

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes_of = WordHashes()
        for b in text_rows(batches, 128):
            out = []
            for doc, s, to in zip(b.column(0).to_pylist(), sets_of(b.column(1).to_pylist(), n, hashes_of), b.column(2).to_pylist()):
                s = payload(s)
                kind, s = s.dtype.str, s.tobytes()
                out += [(t["a"], t["lot"], t["role"], doc, kind, s) for t in to]
                if len(out) >= 512:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out), carried)], schema=carried)
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out), carried)], schema=carried)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, own, met, seen = None, {}, None, set()
        for batch in text_rows(batches, 512):
            found = []
            for a, lot, role, b, kind, s in zip(*(c.to_pylist() for c in batch.columns)):
                if met != (a, lot, role, b):
                    met, seen = (a, lot, role, b), set()
                if s in seen:
                    continue  # a repeated row
                seen.add(s)
                if role == 0:
                    at, own = (a, lot), {**(own if at == (a, lot) else {}), s: np.frombuffer(s, dtype=kind)}
                elif at == (a, lot):
                    other = np.frombuffer(s, dtype=kind)
                    found += [row for mine in own.values() for row in judge(a, b, mine, other)]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*found), arrow)], schema=arrow)

    sets = docs.join(rows, "doc").select("doc", "text", "to").mapInArrow(fetch, "a long, lot int, role int, b long, kind string, s binary")
    return sets.repartition("a", "lot").sortWithinPartitions("a", "lot", "role", "b").mapInArrow(compare, schema)


LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _possible(pairs: DataFrame, docs: DataFrame, n: int, percent: int) -> DataFrame:
    """Pairs that their sizes and histograms don't rule out."""

    def payload(s: np.ndarray) -> np.ndarray:
        return np.append(np.uint16([len(s) & 65535, len(s) >> 16]), histogram(s))

    def judge(a, b, x, y):
        n_x, n_y = (int(v[0]) + (int(v[1]) << 16) for v in (x, y))
        return [(a, b)] if may_link(x[2:], y[2:], n_x, n_y, percent) else []

    return _side_by_side(pairs, docs, n, payload, judge, "a long, b long", LINKS)


def _verified(pairs: DataFrame, docs: DataFrame, n: int, percent: int) -> DataFrame:
    """Pairs whose sets reach the similarity."""

    def judge(a, b, x, y):
        both = len(np.intersect1d(x, y, assume_unique=True))
        return [(a, b)] if 100 * both >= percent * (len(x) + len(y) - both) else []

    return _side_by_side(pairs, docs, n, lambda s: s, judge, "a long, b long", LINKS)


def _members(pairs: DataFrame, docs: DataFrame, n: int, percent: int) -> DataFrame:
    """(a, b, n, linked, tokens): how the set of b, n shingles, differs from its root a's, and if both are similar.

    A token is a shingle that b has and a lacks, or, marked, one that b lacks;
    tokens are null where less than NEAR is in common.
    """
    arrow = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64()), ("linked", pa.bool_()), ("tokens", pa.list_(pa.int64()))])

    def judge(a, b, x, y):
        both = len(np.intersect1d(x, y, assume_unique=True))
        union, tokens = len(x) + len(y) - both, None
        if both >= NEAR * union:
            more, less = np.setdiff1d(y, x, assume_unique=True), np.setdiff1d(x, y, assume_unique=True)
            tokens = np.concatenate([more, mix(less ^ SECOND)]).view(np.int64).tolist()
        return [(a, b, len(y), 100 * both >= percent * union, tokens)]

    return _side_by_side(pairs, docs, n, lambda s: s, judge, "a long, b long, n long, linked boolean, tokens array<long>", arrow)


def _differences(near: DataFrame, percent: int) -> DataFrame:
    """(hub, doc, n, d, linked, token, left, f) of the difference tokens of members, rarest of the family first, that a similar member may share the first of.

    Sets X and Y with dx and dy differences from one root, o of them in common,
    differ in dx + dy - 2 o places; they are similar just if that is at most
    c (|X| + |Y|), c = (1 - t) / (1 + t), t = percent / 100.  With f = d - c n that is
    o >= (fx + fy) / 2; and as o <= dy and t |Y| <= |X|, o >= fx - c |X| / t at least.
    f comes times 100 + percent; left is the number of tokens from this one on.
    """
    rows = near.select(F.col("a").alias("hub"), F.col("b").alias("doc"), "n", "linked", F.size("tokens").alias("d"), F.explode("tokens").alias("token"))
    counts = rows.groupBy("hub", "token").agg(F.count(F.lit(1)).alias("m"))
    rows = rows.join(counts, ["hub", "token"])
    rows = rows.withColumn("k", F.row_number().over(Window.partitionBy("hub", "doc").orderBy("m", "token")))
    rows = rows.withColumn("f", F.col("d") * (100 + percent) - F.col("n") * (100 - percent)).withColumn("left", F.col("d") - F.col("k") + 1)
    enough = F.col("left") * (100 + percent) * percent >= F.col("f") * percent - F.col("n") * (100 - percent) * 100
    return rows.where("m > 1").where(enough).select("hub", "doc", "n", "d", "linked", "token", "left", "f")


def jaccard_components(docs: DataFrame, *, n: int = 5, percent: int = 80) -> DataFrame:
    """One row per doc_id: doc_id, n_shingles, component_id (the smallest doc_id reachable by links)."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc"), "text").where("doc_id is not null")
    sizes, sketch = _survey(docs, n)
    shared_sketch = spark.sparkContext.broadcast((np.minimum(sketch, (1 << 24) - 1).astype(np.uint32), frequency_class(sketch)))

    def prefix_rows(ids, texts, hashes_of):
        kept = [(d, len(s), *prefixes(s, *shared_sketch.value, percent), sample(s)) for d, s in zip(ids, sets_of(texts, n, hashes_of), strict=True) if len(s) > 1]
        return [[x[0] for x in kept], [x[1] for x in kept], [x[2] for x in kept], [x[3].view(np.int64) for x in kept], [(x[4] >> np.uint64(32)).astype(np.uint32).view(np.int32) for x in kept], [x[5] for x in kept]]

    # Copies of a set stand for one node, the smallest doc_id; a set of one shingle links with its copies only.
    first = sizes.where("n > 0").groupBy("n", "s1", "s2").agg(F.min("doc").alias("node"))
    nodes = durable(sizes.where("n > 0").join(first, ["n", "s1", "s2"]).select("doc", "node").distinct())
    only = nodes.where("doc = node").select("doc")
    odd = durable(nodes.groupBy("doc").agg(F.bool_or(F.col("doc") == F.col("node")).alias("own"), F.min("node").alias("a"), F.max("node").alias("most")).where("not own or a <> most"))
    copies, several = odd.where("not own").select("doc"), odd.where("a <> most").select("doc", "a")
    few = copies.count() <= BROADCAST_IDS
    arrow = pa.schema([("doc", pa.int64()), ("n", pa.int64()), ("w", pa.int64()), ("p1", pa.list_(pa.int64())), ("p2", pa.list_(pa.int32())), ("sample", pa.list_(pa.int32()))])
    sets = _over(docs.join(F.broadcast(copies), "doc", "left_anti") if few else docs, prefix_rows, "doc long, n long, w long, p1 array<long>, p2 array<int>, sample array<int>", arrow)
    sets = durable(sets if few else sets.join(copies, "doc", "left_anti"))

    # A doc_id with several texts is one node: the nodes of its texts are linked.  It is in no family.
    links = several.join(nodes, "doc").select("a", F.col("node").alias("b")).where("a <> b")

    tokens = sets.select("doc", F.explode("p1").alias("token"))
    shared = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("token")
    rows = durable(tokens.join(shared, "token").join(sets.select("doc", "n", "w").distinct(), "doc"))

    def similar_sizes(x: str, y: str):
        return (F.col(x) * 100 >= F.col(y) * percent) & (F.col(y) * 100 >= F.col(x) * percent)

    def ordered(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    def filtered(pairs: DataFrame) -> DataFrame:
        """Of pairs (a, b), those that share a prefix shingle under the second order too."""
        a, b = (sets.select(F.col("doc").alias(x), F.col("p2").alias(f"p{x}")) for x in ("a", "b"))
        return pairs.join(a, "a").join(b, "b").where(F.arrays_overlap("pa", "pb")).select("a", "b").distinct()

    def told(pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) with may_link, what filtered tells, and alike, if they share ALIKE of the smaller sample at least; those with neither are left out."""
        a, b = (sets.select(F.col("doc").alias(x), F.col("p2").alias(f"p{x}"), F.col("sample").alias(f"s{x}")) for x in ("a", "b"))
        alike = F.size(F.array_intersect("sa", "sb")) >= ALIKE * F.least(F.size("sa"), F.size("sb"))
        both = pairs.join(a, "a").join(b, "b").select("a", "b", F.arrays_overlap("pa", "pb").alias("may_link"), alike.alias("alike")).where("may_link or alike")
        return both.groupBy("a", "b").agg(F.bool_or("may_link").alias("may_link"), F.bool_or("alike").alias("alike"))

    def verified(pairs: DataFrame) -> DataFrame:
        return durable(_verified(_possible(pairs, docs, n, percent).distinct(), docs, n, percent))

    # The hub of a prefix shingle is the document whose shingles are shared most; a document's hub is the one of most of its shingles.
    top = rows.groupBy("token").agg(F.max(F.struct("w", "doc")).alias("hub"))
    hubs = rows.join(top, "token").where("doc <> hub.doc").groupBy("doc", F.col("hub.doc").alias("hub")).agg(F.count(F.lit(1)).alias("shared"), F.max("hub.w").alias("w"))
    hubs = hubs.groupBy("doc").agg(F.max_by("hub", F.struct("shared", "w", "hub")).alias("b")).select(F.col("doc").alias("a"), "b")

    # Hubs met by chance have little else in common, and their number grows faster than the documents': no way to a root leads over them.
    hubs = durable(told(hubs))

    # A hub's shingles are shared more than those of what it is the hub of, so the way from hub to hub ends, at the root of a family.
    roots = hubs.where("alike").select("a", "b")
    for _ in range(JUMPS):
        roots = roots.join(roots.select(F.col("a").alias("b"), F.col("b").alias("further")), "b", "left").select("a", F.coalesce("further", "b").alias("b"))
    pairs = roots.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"))
    for c in ("a", "b"):
        pairs = pairs.join(several.select(F.col("doc").alias(c)), c, "left_anti")
    members = durable(_members(pairs, docs, n, percent))
    near = members.where("tokens is not null")
    family = near.select(F.col("b").alias("doc"), F.col("a").alias("family")).union(near.select(F.col("a").alias("doc"), F.col("a").alias("family"))).distinct()
    differs = durable(_differences(near, percent))

    # Inside a family, what does not link with the root is compared with the document nearest to the root that it shares most differences with.
    nearest = differs.groupBy("hub", "token").agg(F.min(F.struct("d", "doc")).alias("rep"), F.count(F.lit(1)).alias("m")).where("m > 1")
    inner = differs.where("not linked").join(nearest.select("hub", "token", F.col("rep.doc").alias("rep")), ["hub", "token"]).where("doc <> rep")
    inner = inner.groupBy("doc", "rep").agg(F.count(F.lit(1)).alias("shared")).groupBy("doc").agg(F.max_by("rep", F.struct("shared", -F.col("rep"))).alias("b"))
    tried = ordered(members.select("a", "b"))
    inner = durable(ordered(inner.select(F.col("doc").alias("a"), "b")).join(tried, ["a", "b"], "left_anti"))
    stars = durable(ordered(filtered(inner).union(hubs.where("may_link").select("a", "b"))).join(tried, ["a", "b"], "left_anti"))
    tried = tried.union(inner).union(stars).distinct()
    links = links.union(members.where("linked").select("a", "b")).union(verified(stars))

    part = only.join(components(spark, links).withColumnRenamed("id", "doc"), "doc", "left").join(family, "doc", "left")
    part = durable(part.select("doc", F.coalesce("component", "doc").alias("part"), F.coalesce("family", "doc").alias("family")))

    mixed = durable(rows.drop("w").join(part, "doc"))
    across = mixed.groupBy("token").agg(*[f(c).alias(f"{k}_{c}") for c in ("part", "family") for k, f in (("least", F.min), ("most", F.max))])
    mixed = mixed.join(across.where("least_part <> most_part and least_family <> most_family").select("token"), "token", "left_semi")

    def sides(df: DataFrame, on: list[str]) -> tuple[DataFrame, DataFrame]:
        return tuple(df.select(*on, *(F.col(c).alias(f"{c}_{k}") for c in df.columns if c not in on)) for k in ("x", "y"))

    x, y = sides(mixed, ["token"])
    rest = x.join(y, "token").where((F.col("doc_x") < F.col("doc_y")) & (F.col("part_x") != F.col("part_y")) & (F.col("family_x") != F.col("family_y")) & similar_sizes("n_x", "n_y"))
    rest = rest.select(F.col("doc_x").alias("a"), F.col("doc_y").alias("b")).distinct()

    # Members that need share no difference both link with the root, which has been seen to; else they share a first token
    # in the common order, and from there on both have as many left as they need to share.
    x, y = sides(differs.select("hub", "token", "doc", "n", "left", "f").join(part.select("doc", "part"), "doc"), ["hub", "token"])
    need = F.col("f_x") + F.col("f_y")
    inside = x.join(y, ["hub", "token"]).where((F.col("doc_x") < F.col("doc_y")) & (F.col("part_x") != F.col("part_y")) & (need > 0)
                                               & (F.least("left_x", "left_y") * 2 * (100 + percent) >= need) & similar_sizes("n_x", "n_y"))
    rest = rest.union(inside.select(F.col("doc_x").alias("a"), F.col("doc_y").alias("b"))).distinct().join(tried, ["a", "b"], "left_anti")
    linked = components(spark, part.select(F.col("doc").alias("a"), F.col("part").alias("b")).union(verified(filtered(rest))))
    out = sizes.groupBy("doc").agg(F.max("n").alias("n_shingles"))
    smallest = nodes.join(linked, nodes["node"] == linked["id"], "left").select("doc", F.coalesce("component", "node").alias("c"))
    smallest = smallest.groupBy("doc").agg(F.min("c").alias("c"))
    return out.join(smallest, "doc", "left").select(F.col("doc").alias("doc_id"), "n_shingles", F.coalesce("c", "doc").alias("component_id"))


def op6_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet"), n=4, percent=85)


OP6_SQL = r"""WITH RECURSIVE t AS (SELECT DISTINCT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS w FROM documents WHERE doc_id IS NOT NULL),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g FROM t, unnest(range(1, greatest(2, len(w) - 2))) u(i) WHERE len(w) > 0),
n AS (SELECT t.doc_id, count(g) AS n FROM t LEFT JOIN s USING (doc_id) GROUP BY 1),
e AS (SELECT x.doc_id AS a, y.doc_id AS b FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id JOIN n nx ON nx.doc_id = x.doc_id JOIN n ny ON ny.doc_id = y.doc_id
  GROUP BY x.doc_id, y.doc_id, nx.n, ny.n HAVING 100 * count(*) >= 85 * (nx.n + ny.n - count(*))),
r(doc_id, c) AS (SELECT doc_id, doc_id FROM n UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.doc_id)
SELECT n.doc_id, n.n AS n_shingles, min(c) AS component_id FROM n JOIN r ON r.doc_id = n.doc_id GROUP BY 1, 2
"""
