"""The learned text operators: held-out accuracy, exact parts against brute force, and the pipeline."""

from __future__ import annotations

import collections
import itertools
import math
import random
import time
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from hindcast.llm import language, quality, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def data(spark):
    d = "/root/testdata/sf0.01"
    return spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")


def odd_rows(spark):
    return spark.createDataFrame([(1, None, None, None, 0), (2, "", "en", "s", 0), (3, "123 !!", "en", "s", 6), (None, "the end of it", "en", "s", 1), (4, "a" * 200_000, None, "s", 1)], DOCS).withColumns({"score": F.lit(1), "terms": F.lit(2)})


def random_crf(L=3, seed=0):
    rng = np.random.default_rng(seed)
    return language.Crf(rng.normal(size=(language.FEATURES, L)), rng.normal(size=(L, L)), rng.normal(size=L), {})


def test_forward_backward_by_enumeration():
    crf = random_crf()
    words = "ab cde f gh ijk".split()
    scores = crf.emissions(words)
    weight = collections.defaultdict(float)
    for ys in itertools.product(range(3), repeat=len(words)):
        s = crf.begin[ys[0]] + sum(scores[t, y] for t, y in enumerate(ys)) + sum(crf.moves[a, b] for a, b in zip(ys, ys[1:]))
        for t, y in enumerate(ys):
            weight[t, y] += math.exp(s)
    total = sum(weight[0, y] for y in range(3))
    got = crf.posteriors(scores, np.array([len(words)]))
    assert np.allclose(got, [[weight[t, y] / total for y in range(3)] for t in range(len(words))])


def test_blocks_give_what_whole_chains_give():
    crf = random_crf(4, 1)
    rng = np.random.default_rng(2)
    lengths = np.array([1, 31, 32, 33, 64, 65, 200, 1])
    scores = rng.normal(size=(lengths.sum(), 4)) * 3
    got = crf.posteriors(scores, lengths)
    at = 0
    for n in lengths:
        a = np.zeros((n, 4))
        b = np.zeros((n, 4))
        a[0] = crf.begin + scores[at]
        for t in range(1, n):
            a[t] = scores[at + t] + np.logaddexp.reduce(a[t - 1][:, None] + crf.moves, axis=0)
        for t in range(n - 2, -1, -1):
            b[t] = np.logaddexp.reduce(crf.moves + (scores[at + t + 1] + b[t + 1])[None, :], axis=1)
        g = np.exp(a + b - np.logaddexp.reduce(a + b, axis=1)[:, None])
        assert np.allclose(got[at : at + n], g)
        at += n


def test_language(spark, data):
    docs, _ = data
    model = language.fit(docs, per_language=60, epochs=1)
    out = language.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id")
    assert out.where("lang = lang_pred").count() >= 0.98 * out.count()
    odd = {r["doc_id"]: r for r in language.predict(odd_rows(spark), model, spans=True).collect()}
    assert [odd[k]["lang_pred"] for k in (1, 2, 3)] == ["und"] * 3 and odd[1]["score"] == 0 and odd[None]["lang_pred"] == "en"
    en, de = (docs.where(f"lang = '{x}'").orderBy("doc_id").first()["text"] for x in ("en", "de"))
    mixed = spark.createDataFrame([(1, " ".join(en.split()[:40]) + " " + " ".join(de.split()[:40]), None, None, 1)], DOCS)
    spans = language.predict(mixed, model, spans=True).first()["spans"]
    assert {s["lang"] for s in spans} >= {"en", "de"} and len(spans) < 12
    assert language.predict(docs.limit(1), language.fit(docs.where("false"))).first()["lang_pred"] == "und"


def test_block_max_index_is_exact():
    rng = np.random.default_rng(1)
    rows = [(k, int(k % 3 == 0), 1.0, {int(t): int(rng.integers(1, 4)) for t in rng.choice(30, rng.integers(1, 6), replace=False)}) for k in range(500)]
    index = toxicity.BlockMaxIndex(np.arange(30), rng.uniform(0.5, 3, 30), rows)
    dense = np.zeros((500, 30))
    for k in range(500):
        dense[k, index.terms[index.starts[k] : index.starts[k + 1]]] = index.values[index.starts[k] : index.starts[k + 1]]
    for _ in range(60):
        counts = {int(t): 1 for t in rng.choice(30, rng.integers(1, 5), replace=False)}
        t, v = index.vector(counts)
        cosines = np.sort(dense[:, t] @ v)[::-1]
        best, got = index.nearest(counts, 15)
        assert np.allclose(got, cosines[: len(got)]) and (len(got) == 15 or cosines[len(got)] < 1e-9)


def test_toxicity(spark, data):
    docs, labels = data
    model = toxicity.fit(docs, labels)
    out = toxicity.score_documents(docs, model).join(labels, "doc_id").toPandas()
    toxic, clean = out[out.toxic == 1], out[out.toxic == 0]
    assert (clean.score >= 0.3).mean() < 0.02 and (toxic.score >= 0.3).mean() > 0.5
    assert out.score.between(0, 1).all()
    odd = toxicity.score_documents(odd_rows(spark), model).collect()
    assert len(odd) == 5 and all(0 <= r["score"] <= 1 for r in odd)
    assert toxicity.score_documents(odd_rows(spark), toxicity.fit(docs, labels.where("false"))).where("score = 0").count() == 5


def brute_kneser_ney(texts, table):
    """The same model from dictionaries: interpolated, modified, with continuation counts below the top order."""
    grams = [tuple([0] * (quality.ORDER - 1) + quality.symbols(t, table).tolist()) for t in texts]
    counts = collections.Counter(g[k : k + quality.ORDER] for g in grams for k in range(len(g) - quality.ORDER + 1))
    levels = [counts]
    for _ in range(quality.ORDER - 1):
        levels.append(collections.Counter(g[1:] for g in levels[-1]))

    def discounts(c):
        n = collections.Counter(c.values())
        y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5
        return [min(k, max(0.05, k - (k + 1) * y * n[k + 1] / n[k])) if n[k] else 0.5 for k in (1, 2, 3)]

    tables = []
    for c in levels:
        d = discounts(c)
        total, held = collections.Counter(), collections.Counter()
        for g, n in c.items():
            total[g[:-1]] += n
            held[g[:-1]] += d[min(n, 3) - 1]
        tables.append((c, d, total, held))

    def p(g, level):
        if level == len(tables):
            return 1 / quality.SYMBOLS
        c, d, total, held = tables[level]
        h = g[:-1]
        if not total[h]:
            return p(g[1:], level + 1)
        n = c[g]
        return (n - d[min(n, 3) - 1] if n else 0) / total[h] + held[h] / total[h] * p(g[1:], level + 1)

    return lambda g: p(g, 0)


def test_kneser_ney_against_brute_force(spark):
    texts = ["Ab cab a, bac!\nAbé", "cab cab cab", "xyz 12 ab", "aab bba abc Abc"]
    model = quality.fit(spark.createDataFrame([(t,) for t in [*texts, None, ""]], "text string"))
    table = quality.symbol_table()
    p = brute_kneser_ney(texts, table)
    for t in [*texts, "never seen before?", "ab ab zz"]:
        s = [0] * (quality.ORDER - 1) + quality.symbols(t, table).tolist()
        want = [math.log2(p(tuple(s[k : k + quality.ORDER]))) for k in range(len(t))]
        assert np.allclose(model[quality.grams(quality.symbols(t, table))], want, atol=1e-4)
    sums = (2.0 ** model.reshape(-1, quality.SYMBOLS)).sum(axis=1)
    assert np.allclose(sums, 1, atol=1e-3)


def test_fit_holds_its_table_about_twice(spark):
    """The driver's Python at its peak, in tables of doubles (33 MB): it was 2.65 when lower orders were repeated and rows came as objects."""
    counts = spark.range(0, 150_000, 1, 4).select((F.col("id") * 27 + 1).alias("gram"), (F.col("id") % 5 + 1).alias("n"))
    before, quality.count_grams = quality.count_grams, lambda trusted: trusted
    try:
        quality.fit(counts)
        tracemalloc.start()
        assert len(quality.fit(counts)) == quality.SYMBOLS**quality.ORDER
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
        quality.count_grams = before
    assert peak < 2 * 8 * quality.SYMBOLS**quality.ORDER


def test_repeats_take_few_cpu_seconds(data):
    """The same shares as by means of 39 comparisons, which took most of the time that symbols did."""
    texts = [r["text"] for r in data[0].where("length(text) > 0").orderBy("doc_id").limit(400).collect()]
    table = quality.symbol_table()
    found = [quality.symbols(t, table) for t in [*texts, "a", "ab", "aba", "abab", "ab" * 5000]]
    means = lambda s: max((s[k:] == s[:-k]).mean() for k in range(2, min(41, len(s)))) if len(s) > 2 else 0.0
    took = {f: [] for f in (quality.repeated, means)}
    for _ in range(3):
        for f, spent in took.items():
            began = time.process_time()
            got = [f(s) for s in found]
            spent.append(time.process_time() - began)
            assert got == [means(s) for s in found]
    assert min(took[quality.repeated]) < 0.6 * min(took[means])
    padded = [0] * (quality.ORDER - 1) + found[0].tolist()
    assert quality.grams(found[0]).tolist() == [int(np.dot(padded[k : k + quality.ORDER], quality.SYMBOLS ** np.arange(quality.ORDER)[::-1])) for k in range(len(found[0]))]


def test_quality(spark, data):
    docs, labels = data
    out = quality.judge(docs, labels).join(labels, "doc_id").toPandas()
    assert (out[out.quality == 1].keep).mean() > 0.98
    assert (out[out.quality == 0].keep).mean() < 0.1
    none = quality.judge(odd_rows(spark), labels.where("false")).collect()
    assert len(none) == 5 and all(r["perplexity"] is None and r["keep"] for r in none)
    empty = {r["doc_id"]: r["keep"] for r in quality.judge(odd_rows(spark), spark.createDataFrame([(4, 1, 0)], "doc_id long, quality int, toxic int")).collect()}
    assert empty[1] is False and empty[2] is False


def test_pipeline(spark, data):
    import corpus_pipeline

    docs, labels = data
    sf = "/root/testdata/sf0.01"
    junk = {r["doc_id"] for r in labels.where("quality = 0").collect()}
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, kept = kept, stage(spark, kept, sf).cache()
        assert kept.columns == docs.columns and 0 < kept.count() <= before.count(), name
        if name == "quality classifier":
            assert len(junk & {r["doc_id"] for r in kept.select("doc_id").collect()}) <= 0.1 * len(junk)
    out = corpus_pipeline.STAGES[-1][1](spark, kept, sf)
    assert {r["doc_id"] for r in out.select("doc_id").distinct().collect()} == {r["doc_id"] for r in kept.select("doc_id").collect()}


def test_features_of_many_words_at_once():
    rng = random.Random(3)
    letters = "abcdefgh\u00e9\u00df\u0416\u65e5\u8a9e\U00010400"
    words = ["a", "ab", "abc", "abcd", "anananan", *{"".join(rng.choices(letters, k=rng.randrange(1, 14))) for _ in range(800)}]
    lexicon = {w: k % 16 for k, w in enumerate(words[::3])}
    weights = np.random.default_rng(3).normal(size=(language.FEATURES, 4))
    want = np.array([weights[[f for f in language.features_of(w, lexicon) if f >= 0]].sum(axis=0) for w in words])
    assert np.allclose(language.summed_features(words, lexicon, weights), want, atol=1e-12)
    assert language.summed_features([], lexicon, weights).shape == (0, 4)
