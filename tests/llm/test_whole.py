"""Cases that the text operators once left out: each failed before the change it came with."""

from __future__ import annotations

import collections
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from hindcast.llm import common, jaccard, language, licenses, line_dedup, ogg, packing, pieces, pii, quality, tiling, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def test_piece_costs_against_brute_force(spark):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = ["the cat sat on the mat", "the cat sat on a hat, the cat", "Привет, мир! Привет", "on the mat sat the dog"]
    rows = spark.createDataFrame([(k, t, k < 3) for k, t in enumerate(texts)], "key long, text string, trusted boolean")
    model = pieces.fit(rows.where("trusted"), path, 5)
    assert len(model["hot"]) > 0
    got = {r["key"]: (r["bits"], r["pieces"]) for r in pieces.bits(rows, model, path, 5).collect()}
    cold = model | {"hot": model["hot"][::2], "hot_counts": model["hot_counts"][::2]}  # what isn't hot goes by its bucket
    assert {r["key"]: (pytest.approx(r["bits"], rel=1e-6), r["pieces"]) for r in pieces.bits(rows, cold, path, 3).collect()} == got
    found = [pieces.pairs_of(x).tolist() for x in pieces.Ids(path)(texts)]
    counts = collections.Counter(p for f in found[:3] for p in f)
    tally = lambda c: pieces.discounts([sum(n == k for n in c.values()) for k in (1, 2, 3, 4)])
    follows = collections.Counter(p & 0xFFFF for p in counts)
    d, d1 = tally(counts), tally(follows)
    for k, f in enumerate(found):
        want = 0.0
        for p, times in collections.Counter(f).items():
            own, u, v = times if k < 3 else 0, p >> 16, p & 0xFFFF
            n = follows[v] - (own > 0 and counts[p] == own)
            low = (n - d1[min(n, 3)] + sum(d1[min(x, 3)] for x in follows.values()) / pieces.PIECES) / len(counts)
            rest = {q: c - (own if q == p else 0) for q, c in counts.items() if q >> 16 == u}
            total = sum(rest.values())
            c = rest.get(p, 0)
            want -= times * np.log2((c - d[min(c, 3)] + sum(d[min(x, 3)] for x in rest.values()) * low) / total if total else low)
        assert got[k] == (pytest.approx(want, rel=1e-5), len(f))


def test_quality_tells_word_order(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{x}.parquet") for x in ("documents", "labels"))
    rng = random.Random(3)
    words = [f"{a}{b}" for a in ("mor", "tel", "vin", "gar", "sol", "ped", "kan", "lur") for b in ("an", "eth", "ing", "os", "ula", "ed", "ir", "ap")]
    after = {w: rng.sample(words, 3) for w in words}

    def ordered(n):
        out = [rng.choice(words)]
        while len(out) < n:
            out.append(rng.choice(after[out[-1]]))
        return out

    texts = [ordered(300) for _ in range(120)]
    rows = [(10**9 + k, " ".join(t), "xx", "s", 1) for k, t in enumerate(texts)]
    rows += [(2 * 10**9 + k, " ".join(rng.sample(t, len(t))), "xx", "s", 1) for k, t in enumerate(texts[:40])]
    some = docs.select("doc_id", "text", "lang", "source", "n_chars").union(spark.createDataFrame(rows, DOCS))
    trusted = labels.union(spark.createDataFrame([(10**9 + k, 1, 0) for k in range(100)], labels.schema))
    out = {r["doc_id"]: r for r in quality.judge(some, trusted).collect()}
    assert sum(out[2 * 10**9 + k]["keep"] for k in range(40)) == 0
    assert sum(out[10**9 + k]["keep"] for k in range(100)) >= 97 and sum(out[10**9 + k]["keep"] for k in range(100, 120)) >= 19


def test_licenses_of_one_file_do_not_hide_each_other(spark):
    bsd, apache = (next(t for n, t, _ in licenses.TEMPLATES if n == name) for name in ("bsd", "apache-2.0"))
    near = bsd.replace("redistribution and use in", "redistribution or use of")
    every = ". ".join(t for _, t, _ in licenses.TEMPLATES)
    texts = [f"{bsd}. {apache}", near, every, *[apache] * 20, "no words of that kind"]
    rows = spark.createDataFrame([(k, t, "en", "s", 1) for k, t in enumerate(texts)], DOCS)
    out = {r["doc_id"]: r["labels"] for r in licenses.scan_licenses(rows).collect()}
    assert out[0] == ["apache-2.0", "bsd"] and out[1] == [] and out[3] == ["apache-2.0"] and out[23] == []
    assert set(out[2]) >= {n for n, _, _ in licenses.TEMPLATES}


def brute_licenses(texts: list[str], share: float) -> list[tuple[list[str], float]]:
    """Every template at every place where its key phrase stands, by the words of the text."""
    split = [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t)) for t in texts]
    content = lambda w: w not in licenses.FUNCTION_WORDS
    known = {w for _, t, _ in licenses.TEMPLATES for w in t.split() if content(w)} | {w for t, _ in licenses.BASE for w in t.split()}
    df = {w: sum(w in set(s) for s in split) for w in known}
    idf = {w: math.log((len(texts) + 1) / (n + 0.5)) if n else 0.0 for w, n in df.items()}
    out = []
    for s in split:
        labels, best = set(), 0.0
        for phrase, label in licenses.BASE:
            p = phrase.split()
            if any(s[i : i + len(p)] == p for i in range(len(s))):
                labels, best = labels | {label}, 1.0
        for label, text, key in licenses.TEMPLATES:
            t, k = text.split(), key.split()
            at = next(i for i in range(len(t)) if t[i : i + len(k)] == k)
            whole = sum(idf[w] for w in t if content(w))
            for i in range(len(s)):
                if s[i : i + len(k)] == k:
                    met = sum(idf[w] for j, w in enumerate(t) if content(w) and 0 <= i - at + j < len(s) and s[i - at + j] == w)
                    got = met / whole if whole > 0 else 1.0
                    if got >= share:
                        labels, best = labels | {label}, max(best, got)
        out.append((sorted(labels), min(1.0, best)))
    return out


def test_licenses_against_brute_force(spark):
    rng = random.Random(6)
    parts = [t.split() for _, t, _ in licenses.TEMPLATES] + [p.split() for p, _ in licenses.BASE]
    texts = [""]
    for _ in range(250):
        words = []
        for _ in range(rng.randrange(1, 6)):
            p = list(rng.choice(parts))
            for _ in range(rng.randrange(4)):  # words lost, added, exchanged; also inside key phrases
                at = rng.randrange(len(p))
                p[at : at + 1] = rng.choice([[], [p[at], "of"], ["and"], ["License"], [p[at].upper()]]) or p[at : at + 1][:0]
                p = p or ["the"]
            words += p[rng.randrange(3) :] + ["filler"] * rng.randrange(3)
        texts.append(", ".join(words))
    rows = spark.createDataFrame([(k, t, "en", "s", 1) for k, t in enumerate(texts)], DOCS)
    out = {r["doc_id"]: r for r in licenses.scan_licenses(rows).collect()}
    for k, (labels, score) in enumerate(brute_licenses(texts, 0.6)):
        assert out[k]["labels"] == labels and abs(out[k]["score"] - score) < 1e-9, texts[k]
    assert len({x for r in out.values() for x in r["labels"]}) > 12


def test_license_gaps_fit():
    assert max(len(p[6].split()) for p in licenses._postings()) < licenses.GAP and all(k.split()[0] not in licenses.FUNCTION_WORDS for _, _, k in licenses.TEMPLATES)


LABELS = "doc_id long, quality int, toxic int"


def test_texts_reach_python_in_bounded_batches(spark):
    """A worker and its executor hold 1 MB of rows at once, or one row more, whatever the texts' length; by itself Spark hands over 10,000 rows or 64 MB."""

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], names=["n", "bytes"])

    texts = spark.range(0, 3000, 1, 1).selectExpr("repeat('x', cast(if(id = 7, 3000000, 2000) as int)) AS text")
    found = common.durable(texts.mapInArrow(sizes, "n long, bytes long")).collect()
    assert sum(r["n"] for r in found) == 3000 and len(found) > 5
    assert sorted(r["bytes"] for r in found)[-2] < 1.1 * common.BATCH_BYTES and max(r["bytes"] for r in found) < 3_000_000 + 1.1 * common.BATCH_BYTES
    assert spark.conf.get(common.BATCH, None) is None
    spark.conf.set(common.BATCH, "200000")
    try:  # what the session says holds, and stays
        assert len(common.durable(texts.mapInArrow(sizes, "n long, bytes long")).collect()) > 25
        assert spark.conf.get(common.BATCH) == "200000"
    finally:
        spark.conf.unset(common.BATCH)


def test_what_the_drivers_jvm_freed_goes_back(spark):
    jvm = spark._jvm
    pid = jvm.java.lang.ProcessHandle.current().pid()

    def held():
        with open(f"/proc/{pid}/smaps_rollup") as f:
            return next(int(x.split()[1]) for x in f if x.startswith("Anonymous:")) / 1024

    common.durable(spark.range(1))  # what a first job takes
    allocator = jvm.io.netty.buffer.UnpooledByteBufAllocator.DEFAULT
    blocks = [allocator.directBuffer(100_000).writeZero(100_000) for _ in range(1500)]  # 143 MB in blocks that malloc does not map one by one
    before = held()
    for b in blocks[:-1]:  # the last keeps the heap from being cut at its end
        b.release()
    common.durable(spark.range(1))
    after = held()
    blocks[-1].release()
    assert after < before - 70


def test_the_drivers_garbage_is_collected_now_and_then(spark, monkeypatch):
    beans = spark._jvm.java.lang.management.ManagementFactory
    runs = lambda: sum(b.getCollectionCount() for b in beans.getGarbageCollectorMXBeans() if b.getName() == "G1 Old Generation")
    before = runs()
    monkeypatch.setattr(common, "COLLECT_S", 0)
    common.durable(spark.range(1))
    assert runs() > before
    monkeypatch.setattr(common, "COLLECT_S", 1e9)
    before = runs()
    common.durable(spark.range(1))
    assert runs() == before


def test_empty_tables(spark):
    import public_tokenizers

    docs, labels = spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)
    bench = spark.createDataFrame([], "item_id long, text string")
    assert line_dedup.line_dedup(docs).count() == 0 == quality.judge(docs, labels).count()
    assert language.predict(docs, language.fit(docs)).count() == 0 == toxicity.score_documents(docs, toxicity.fit(docs, labels)).count()
    assert ogg.from_media(ogg.to_media(docs)).count() == 0 == jaccard.jaccard_components(docs).count() == licenses.scan_licenses(docs).count() == pii.find_pii(docs).count()
    assert tiling.contaminated(docs, bench).count() == 0 == packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json")).count()


def test_pipeline_of_odd_tables(spark, tmp_path):
    """Null and repeated ids, null and empty texts, and columns of other names; then no rows at all."""
    text = " ".join(f"word{k % 31} of{k % 7} text{k % 11}" for k in range(60))
    rows = [(1, text), (1, text), (2, text), (None, text), (3, None), (4, ""), (5, " "), (6, text.upper() + " more"), (7, "one")]
    docs = spark.createDataFrame([(d, t, "en", "s", 1, 9) for d, t in rows], DOCS + ", token long")
    bench = spark.createDataFrame([(1, "nothing like that stands here at all"), (None, "x"), (2, None)], "item_id long, text string")
    for name, d in (("some", docs), ("none", docs.where("false"))):
        d.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.createDataFrame([(1, 1, 0), (2, None, None), (None, 1, 1)], LABELS).write.parquet(f"{tmp_path}/{name}/labels.parquet")
        bench.write.parquet(f"{tmp_path}/{name}/benchmark.parquet")
    kept = {r["doc_id"] for r in corpus_pipeline.run(spark, f"{tmp_path}/some").collect()}
    assert 1 in kept and None in kept and 2 not in kept and 6 not in kept
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0


def test_jaccard_families_against_brute_force(spark):
    """Two families of near copies of one text and of its half, and a doc_id with texts of both: links between them count too."""
    rng = random.Random(5)
    words = [f"w{k}" for k in range(900)]
    base = [rng.choice(words) for _ in range(80)]
    texts = []
    for k in range(160):
        t = list(base if k % 2 else base[:44])
        for _ in range(rng.randrange(0, 5)):
            at = rng.randrange(len(t))
            t[at : at + 1] = rng.choice([[], [rng.choice(words[:5])], [t[at], "plus"]])
        texts.append((k if k % 40 else 0, " ".join(t)))
    out = {r["doc_id"]: r["component_id"] for r in jaccard.jaccard_components(spark.createDataFrame([(d, t, "en", "s", 1) for d, t in texts], DOCS), n=4, percent=85).collect()}
    sets = [(d, {tuple(t.split()[i : i + 4]) for i in range(len(t.split()) - 3)}) for d, t in texts]
    root = {d: d for d, _ in texts}

    def find(x):
        return x if root[x] == x else find(root[x])

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if 100 * len(x & y) >= 85 * len(x | y) and find(a) != find(b):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    assert out == {d: find(d) for d in root} and len(set(out.values())) > 20
