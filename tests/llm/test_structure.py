"""Quality rule cascade, conversation repair and whitening: brute force, other orders and cuts, odd tables."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from hindcast.llm import cascade, repair, whitening

DOCS = "doc_id long, text string, words int"
BLANK = re.compile(r"[^\x20\x09-\x0D]+")


# --- quality rules


def features(text: str | None) -> dict:
    text = text or ""
    words, lines = BLANK.findall(text), [x for x in text.split("\n") if BLANK.search(x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    again = {p for i, w in enumerate(windows) if windows.count(w) > 1 for p in range(i, i + 8)}
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(again)}


def odd_texts() -> list[str | None]:
    rng = random.Random(3)
    texts = [None, "", " \t\n", "one", "\x1c\x00 a b \U0001f600", "a\n\na\r\n a\na\n", "# $ % & | < > *" * 3, "x " * 40, " ".join(map(str, range(30)))]
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randrange(60))) for _ in range(60)]
    return texts + [" ".join(str(k % 9) for k in range(20)), "\n".join(["same line here"] * 9), "word " * 3000]


def test_features_against_brute_force(spark):
    texts = odd_texts()
    docs = spark.createDataFrame([(k, t, 7) for k, t in enumerate(texts)] + [(None, "x", 1), (3, "one", 1)], DOCS)
    out = cascade.cascade(cascade.prepared(docs), cascade.RULES[:1])
    rows = out.select("doc_id", "n_words", *[r.value(F.col("text"), F.col("words")).alias(r.feature) for r in cascade.RULES[1:]]).collect()
    assert len(rows) == len(texts) + 2
    for r in rows:
        if r["doc_id"] is not None:
            want = features(texts[r["doc_id"]])
            assert {k: r[k] for k in want} == want, texts[r["doc_id"]]


def test_verdict_does_not_depend_on_the_order(spark, small):
    docs = cascade.prepared(spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").union(spark.createDataFrame([(10**6 + k, t) for k, t in enumerate(odd_texts())], "doc_id long, text string")))
    want = None
    for order in (cascade.RULES, cascade.RULES[::-1], cascade.RULES[3:] + cascade.RULES[:3]):
        rows = cascade.cascade(docs, order).select("doc_id", "kept", *[r.feature for r in order]).collect()
        kept = {r["doc_id"]: r["kept"] for r in rows}
        assert want in (None, kept)
        want = kept
        # What is not needed is not computed, and what is computed rejects only as the last.
        for r in rows:
            seen = [r[x.feature] is not None for x in order]
            assert seen == sorted(seen, reverse=True) and (all(seen) or not r["kept"])
    assert {True, False} == set(want.values())


def test_order_by_rejection_per_cost():
    # Rule 2 rejects most, but all that rule 0 rejects too, and costs more.
    assert cascade.by_rejection_per_cost([1.0, 1.0, 3.0], {0: 90, 0b101: 10, 0b010: 4, 0b100: 1}) == [0, 1, 2]
    assert cascade.by_rejection_per_cost([5.0, 1.0], {}) == [1, 0]


def test_cascade_is_native(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    plan = cascade.cascade(cascade.prepared(docs), cascade.plan(docs))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Exchange", plan)


def test_sample_gives_costs_and_rejections(spark, small):
    docs = cascade.prepared(spark.read.parquet(f"{small}/documents.parquet")).cache()
    cost, fails = cascade.estimate(docs, times=1)
    assert len(cost) == len(cascade.RULES) and min(cost) > 0 and sum(fails.values()) == docs.count()
    assert cascade.plan(docs.where("false").select("doc_id", "text")) == cascade.RULES


# --- conversations


def brute(rows: list[tuple[str, bool, bool]]) -> tuple[int, str]:
    """Lightest repair by trying every series of edits that could be it: up to two rows added at each place."""
    best = None
    gaps = ["", "I", "II"]
    for edits in itertools.product("DKR", repeat=len(rows)):
        for added in itertools.product(gaps, repeat=len(rows) + 1):
            audit = "".join(a + e for a, e in zip(added, [*edits, ""]))
            cost, out, left, good = 0, "", iter(rows), True
            for e in audit:
                if e == "I":
                    cost, out = cost + 3, out + "?"
                    continue
                initial, gone, truncated = next(left)
                if e == "D":
                    cost += 4
                    continue
                good &= not gone
                cost += 3 * truncated + 3 * (e == "R")
                out += initial if e == "K" else "?"
            roles = re.fullmatch(r"(s?(([u?])([a?]))+)?", out)
            if good and roles and (best is None or (cost, audit) < best):
                best = cost, audit
    return best


def test_lightest_repair_against_all_edits():
    rng = random.Random(8)
    for _ in range(120):
        rows = []
        for _ in range(rng.randrange(4)):
            gone = rng.random() < 0.25
            rows.append((rng.choice("suax"), gone, not gone and rng.random() < 0.3))
        want = brute(rows)
        assert min(repair.lightest(rows, 0, repair.ENDS).values()) == want
        assert next(iter(repair.lightest(rows, 0, repair.ENDS, 1).values())) == want
        for size in (1, 2):
            parts = [rows[k : k + size] for k in range(0, len(rows), size)] or [[]]
            items = [{(a, b): i for a in range(4) for b, i in repair.lightest(p, a, range(4)).items()} for p in parts]
            way = repair.join_items(items)
            assert (way.cost, "".join(w.edits for w in way.steps())) == want


def expected(conv: list[tuple]) -> dict:
    """The contract, conversation by conversation, with the edits from one agenda over all rows."""
    out = {c: [] for c, *_ in conv}
    for c, turn, role, text in conv:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind:
            role, text = "user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            out[c] += [(turn, role, text)] * (2 if kind == 3 else 1)
    for c, rows in out.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, items, count = set(), [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        for _, role, text in rows:
            kept = text.strip(" \t\n\x0b\f\r")
            fault = "blank" if not kept else "duplicate" if (role, text) in seen else "truncated" if kept[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                count[fault] += 1
            items.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
        turns = [t for t, *_ in rows if t is not None]
        cost, audit = min(repair.lightest(items, 0, repair.ENDS).values())
        lines, state, left = [], "", iter(rows)
        for e in audit:
            _, role, text = (None, "", "") if e == "I" else next(left)
            if e == "D":
                continue
            if e != "K":
                role = "assistant" if state == "u" else "user"
            state = role[:1]
            lines.append(f"{role}:{text}")
        out[c] = {
            "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, **count, "illegal": sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(items, items[1:])),
            "cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest()}
    return out


def conversations() -> list[tuple]:
    rng, rows = random.Random(4), [(None, 1, "user", "Hi."), (None, None, None, None), (5, None, "user", "x."), (5, None, "user", "x."), (5, 1, "user", "x."), (6, 1, None, None)]
    rows += [(c, t, rng.choice(["user", "assistant", "system", "tool", None, ""]), rng.choice(["Yes.", "No!", "and", "", " \n", None, f"Text {t}?"])) for c in range(7, 40) for t in rng.sample(range(12), rng.randrange(1, 9))]
    # One conversation with most of the rows, many of them alike.
    return rows + [(99, t % 500, ("user", "assistant")[t % 2], "Yes." if t % 3 else f"{t} stands here.") for t in range(1500)]


@pytest.mark.parametrize("block", [3, repair.BLOCK])
def test_repair_against_the_contract(spark, block):
    rows = conversations()
    df = spark.createDataFrame([(*r, "extra") for r in rows], "conv_id long, turn long, role string, text string, audit string").repartition(5)
    out = repair.repair(repair.damage(df), block).collect()
    want = expected(rows)
    assert len(out) == len(want)
    for r in out:
        assert {k: r[k] for k in want[r["conv_id"]]} == want[r["conv_id"]], r["conv_id"]


def test_repair_of_no_rows(spark):
    assert repair.repair(repair.damage(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))).count() == 0


def test_repair_over_ranges(spark, small):
    """Ranges that cut a conversation give what one range gives."""
    conv = spark.read.parquet(f"{small}/conversations.parquet").limit(0).union(spark.createDataFrame(conversations(), "conv_id long, turn long, role string, text string"))
    some = []
    for n in ("1", "13"):
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", n)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        some.append(sorted(repair.repair(repair.damage(conv)).collect(), key=lambda r: (r[0] is not None, r[0] or 0)))
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert some[0] == some[1]


# --- whitening


@pytest.mark.parametrize("kind", ["random", "equal", "clustered", "low rank", "diagonal", "zero", "one"])
def test_spectral_against_lapack(kind):
    rng = np.random.default_rng(1)
    d = 1 if kind == "one" else 24
    q, _ = np.linalg.qr(rng.normal(size=(d, d)))
    e = {"random": rng.normal(size=d), "equal": np.full(d, 3.0), "clustered": np.repeat([5.0, 5.0 + 1e-9, 1.0, 0.5], d // 4 or 1)[:d], "low rank": np.r_[9.0, 4.0, np.zeros(max(0, d - 2))][:d],
         "diagonal": np.arange(d, dtype=float), "zero": np.zeros(d), "one": np.ones(d)}[kind]
    v = np.diag(e) if kind == "diagonal" else (q * e) @ q.T
    v = (v + v.T) / 2
    values, vectors = whitening.spectral(v)
    size = max(1.0, np.abs(e).max())
    assert np.allclose(values, np.sort(np.linalg.eigvalsh(v))[::-1], atol=1e-12 * size)
    assert np.allclose(vectors.T @ vectors, np.eye(d), atol=1e-12) and np.allclose(v @ vectors, vectors * values, atol=1e-11 * size)


def test_polar_factor():
    a = np.diag([3.0, -2.0, 1e-9, -4.0])
    assert np.allclose(whitening.polar(a), np.diag([1, -1, 1, -1]), atol=1e-12)


VECTORS = "vec_id long, embedding array<float>, x string, n int"


def test_whitening_against_numpy(spark):
    rng = np.random.default_rng(7)
    base = (rng.normal(size=(200, 6)) * [3, 1, 1, 0.5, 0.2, 0.1] + 1).astype(np.float32)
    rows = [(k, [float(c) for c in v], "x", 1) for k, v in enumerate(base)] + [(None, [float(c) for c in base[0]], "x", 1)] + [(3, [float(c) for c in base[3]], None, None)] * 2
    odd = [(900, None, "", 1), (901, [1.0, None, 0.0, 0.0, 0.0, 0.0], "", 1), (902, [float("nan")] * 6, "", 1), (903, [float("inf")] + [0.0] * 5, "", 1), (904, [], "", 1), (905, [1.0], "", 1)]
    vectors = whitening.integers(spark.createDataFrame(rows + odd, VECTORS))
    fitted = whitening.fit_whitening(vectors)
    out = whitening.whiten(vectors, fitted).collect()
    assert len(out) == 4 * len(rows)
    x = np.floor(256 * base.astype(float)).astype(int)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    values, axes = np.linalg.eigh(np.cov(fit.T, bias=True))
    values, axes = values[::-1], axes[:, ::-1]
    sign = np.sign(np.sum(axes[:, :4] * fitted.axes.T, axis=0))
    for r in out:
        v = x[0 if r["vec_id"] is None else r["vec_id"]]
        k = r["component"] - 1
        assert r["n"] == n and r["deviation"] == int(((n * v - sums) ** 2).sum())
        assert abs(r["whitened"] - sign[k] * ((v - sums / n) @ axes[:, k]) / np.sqrt(values[k])) < 1e-9
        assert abs(r["explained"] / (values[k] / values.sum()) - 1) < 1e-10 and r["identity_error"] < 1e-10


def test_whitening_of_odd_tables(spark):
    none = whitening.integers(spark.createDataFrame([], VECTORS))
    assert whitening.fit_whitening(none) is None and whitening.whiten(none, None).count() == 0
    alike = whitening.integers(spark.createDataFrame([(k, [0.5, 0.25], "x", 1) for k in range(5)], VECTORS))
    out = whitening.whiten(alike, whitening.fit_whitening(alike)).collect()
    assert len(out) == 10 and {(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in out} == {(1, 0, 0.0, 0.0, 0.0)}
    flat = whitening.integers(spark.createDataFrame([(k, [k / 8.0, k / 4.0, 1.0], "x", 1) for k in range(9)], VECTORS))
    out = whitening.whiten(flat, whitening.fit_whitening(flat)).collect()
    assert {r["whitened"] for r in out if r["component"] > 1} == {0.0} and max(r["identity_error"] for r in out) < 1e-10
