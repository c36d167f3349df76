"""The text operators against brute force on small tables, with nulls, empty and long texts, ties and repeats."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from hindcast.llm import common, jaccard, licenses, line_dedup, ogg, packing, pii, tiling

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def table(spark, texts, extra=False):
    """Documents numbered from 0, with a null text, an empty one, a repeated row and a null doc_id at the end."""
    rows = [(k, t, "en", "s", len(t)) for k, t in enumerate(texts)]
    n = len(rows)
    rows += [(n, None, None, None, None), (n + 1, "", None, "s", 0), rows[0], (None, texts[0], "en", "s", 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumns({c: F.lit(7) for c in ("pos", "h", "words", "token", "row", "start", "__spans")}) if extra else df


def prose(rng, n, words=("alpha", "beta", "gamma", "delta", "omega", "nu", "xi", "pi", "rho", "tau")):
    return " ".join(rng.choice(words) + str(rng.randrange(60)) for _ in range(n))


# Line dedup ------------------------------------------------------------------------------------------------------


def removed_lines(docs, least):
    """Lines of runs with at least `least` words that also stand earlier without overlap, by trying all runs."""
    lines = {d: [(k, x) for k, x in enumerate(t.split("\n")) if x.split()] for d, t in docs if t is not None}
    seen, gone = {}, collections.defaultdict(set)
    runs = []
    for d, ls in lines.items():
        for i in range(len(ls)):
            n = 0
            for j in range(i, len(ls)):
                n += len(ls[j][1].split())
                if n >= least:
                    runs.append((d, ls[i][0], ls[j][0], tuple(x for _, x in ls[i : j + 1])))
                if n >= 3 * least:
                    break  # longer runs are made of such ones
    for d, s, e, content in sorted(runs, key=lambda r: r[:3]):
        first = seen.setdefault(content, (d, s, e))
        if first[0] != d or s > first[2]:
            gone[d].update(range(s, e + 1))
    return gone


def test_line_dedup(spark):
    rng = random.Random(3)
    pool = [prose(rng, rng.randrange(1, 9)) for _ in range(12)] + ["", "  "]
    texts = ["\n".join(rng.choice(pool) for _ in range(rng.randrange(1, 25))) for _ in range(40)] + ["x\n" * 200, texts_long(rng)]
    out = {(r["doc_id"], r["text"]): r["lines_removed"] for r in line_dedup.line_dedup(table(spark, texts, True), min_words=10).collect()}
    gone = removed_lines(list(enumerate(texts)), 10)
    for k, t in enumerate(texts):
        kept = t if not gone[k] else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone[k])
        assert out[k, kept] == len(gone[k]), k
    n = len(texts)
    assert out[n, None] == 0 and out[n + 1, ""] == 0 and out[None, texts[0]] == 0


def texts_long(rng):
    return "\n".join(prose(rng, 5) for _ in range(3000))


def test_line_dedup_is_native(spark):
    plan = line_dedup.line_dedup(table(spark, ["a b"]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# Packing ---------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_ids_equal_the_tokenizer(spark, tokenizer):
    import public_tokenizers

    texts = ["", " a  b\n\n c ", "don't  STOP\t\n", "x" * 3000, "Ünïcode 一二三 ½ ٣ é", "a\x1cb\x85c d  e", "<|endoftext|> a", "a <|endoftext|> b", "<|endoftext|", "🙂🙂 ok", "\n \n\n  x", "a​b 'll's", "\ue000 a\U000e0fff b"]
    path = public_tokenizers.path("byte_bpe_50k.json")
    assert packing.same_ids(spark, path) and not packing.prove_same_ids(public_tokenizers.path("word_bpe_49k.json"))
    ids = packing.Ids(path, True)
    assert [np.frombuffer(x, "<u4").tolist() for x in ids(texts)] == [x.ids for x in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_merges_that_ranks_would_not_follow():
    letters = {x: k for k, x in enumerate("abc")}
    assert packing.canonical_merges(letters | {"ab": 3, "abc": 4}, [("a", "b"), ("ab", "c")])
    assert not packing.canonical_merges(letters | {"bc": 3, "ab": 4, "abc": 5}, [("b", "c"), ("a", "b"), ("ab", "c")])  # abc ends as a bc
    assert not packing.canonical_merges(letters | {"ab": 4, "abc": 3}, [("a", "b"), ("ab", "c")])  # ids fall
    assert not packing.canonical_merges(letters | {"ab": 3}, [("a", "b"), ("a", "b")])


@pytest.mark.parametrize("seed", range(20))
def test_windows_against_brute_force(seed):
    """Best fit into the open windows, the fullest filled and emitted when none fits."""
    rng, size, most = random.Random(seed), 16, 4
    lengths = [rng.randrange(1, 40) for _ in range(60)]
    got = []
    windows = packing.Windows(size, most, lambda pieces: got.append([(d, s, len(i) // 4) for d, s, i, _ in pieces]))
    for d, n in enumerate(lengths):
        windows.add(d, n, 0, bytes(4 * n))
    space, held, emitted, order = [], [], [], 0  # free space and pieces of the open windows, in order of opening
    for d, n in enumerate(lengths):
        at = 0
        while n - at >= size:
            emitted.append([(d, at, size)])
            at += size
        while at < n:
            left = n - at
            fits = [k for k in range(len(space)) if space[k] >= left]
            if fits:
                k, take = min(fits, key=lambda k: space[k]), left
            elif len(space) < most:
                space.append(size)
                held.append([])
                k, take = len(space) - 1, left
            else:
                k = min(range(len(space)), key=lambda k: space[k])
                take = space[k]
            held[k].append((d, at, take))
            space[k] -= take
            at += take
            if not space[k]:
                emitted.append(held.pop(k))
                space.pop(k)
    assert got == emitted and sorted(size - w[0] for w in windows.open) == sorted(space)


def test_packing_loses_nothing(spark, tokenizer):
    import public_tokenizers

    rng = random.Random(5)
    texts = [prose(rng, rng.choice([1, 10, 200, 900])) for _ in range(60)] + [prose(rng, 9000)]
    docs = table(spark, texts, True).repartition(7)
    out = packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), size=256, open_windows=4, fan_in=2).toPandas()
    want = [tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for t in [*texts, None, ""]]
    got = out[out.doc_id.notna()].sort_values(["doc_id", "start"])
    for d, ids in enumerate(want):
        rows = got[got.doc_id == d]
        whole = [np.frombuffer(bytes(x), "<u4").tolist() for x in rows["ids"]]
        if d:  # row 0 is there twice
            assert sum(whole, []) == ids and rows["start"].tolist() == np.cumsum([0, *map(len, whole[:-1])]).tolist()
        assert all(zlib.crc32(bytes(x)) == c for x, c in zip(rows["ids"], rows["ids_crc32"]))
        assert set(rows["doc_tokens"]) == {len(ids)}
    assert got[got.doc_id == 0]["length"].sum() == 2 * len(want[0])
    assert out[out.doc_id.isna()]["length"].sum() == len(want[0])
    sizes = out.groupby("sequence_id")["length"].sum()
    assert sizes.max() <= 256 and (sizes < 256).sum() <= 1
    places = out.sort_values(["sequence_id", "offset"]).groupby("sequence_id")
    assert all(g["offset"].tolist() == np.cumsum([0, *g["length"][:-1]]).tolist() for _, g in places)
    assert packing.pack_documents(docs.where("false"), public_tokenizers.path("byte_bpe_50k.json")).count() == 0


# Ogg -------------------------------------------------------------------------------------------------------------


def slow_checksum(page):
    crc = 0
    for b in page:
        crc ^= b << 24
        for _ in range(8):
            crc = (crc << 1 ^ 0x04C11DB7 if crc & 0x80000000 else crc << 1) & 0xFFFFFFFF
    return crc


@pytest.mark.parametrize("n", [0, 1, 63, 64, 255, 4096, 255 * 16, 70000, 200000])
def test_ogg_round_trip(n):
    text = "é" * (n // 2) + "x" * (n % 2)
    size, payload = ogg.padded(text)
    assert size == n and len(payload) % 64 == 0 and len(payload) >= max(64, n)
    data = ogg.write_ogg(payload)
    sound = ogg.read_ogg(data)
    assert sound.samples == payload and sound.seconds[-1] == len(payload) / ogg.RATE
    assert ogg.features(sound) == ogg.features(ogg.read_ogg(data))


def test_ogg_finds_damage():
    data = ogg.write_ogg(ogg.padded("some text" * 900)[1])
    assert ogg.page_checksum(data[:300]) == slow_checksum(data[:300])
    rng = random.Random(1)
    for _ in range(60):
        k = rng.randrange(len(data))
        with pytest.raises(ogg.OggError):
            ogg.read_ogg(data[:k] + bytes([data[k] ^ 1 << rng.randrange(8)]) + data[k + 1 :])
    for cut in (1, 27, 300, len(data) - 1):
        with pytest.raises(ogg.OggError):
            ogg.read_ogg(data[:cut])


def test_media_columns(spark):
    out = ogg.from_media(ogg.to_media(table(spark, ["abc", "abc", "d" * 100000], True))).collect()
    assert len(out) == 7
    by = {r["doc_id"]: r for r in out}
    assert by[0]["media"] == by[1]["media"] and by[0]["feature"] == by[1]["feature"]
    assert bytes(by[3]["payload"]) == bytes(64) and by[3]["n_bytes"] == 0
    bad = ogg.from_media(spark.createDataFrame([(1, 3, bytearray(b"OggS"))], "doc_id long, n_bytes long, media binary")).first()
    assert bad["payload"] is None and bad["feature"] is None


# Jaccard join ----------------------------------------------------------------------------------------------------


def brute_components(docs, n, percent):
    sets = {}
    for d, t in docs:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
        sets[d] = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in sets}


def test_jaccard_components(spark):
    rng = random.Random(11)
    texts = ["", "one", "One", "a b c", "A  b\tc", "a b c d"]
    for size in (6, 20, 60, 150):  # families of copies with ever more edits, the large one beyond jaccard.LARGE
        base = prose(rng, size).split()
        for _ in range(110 if size == 150 else 12):
            copy = list(base)
            for _ in range(rng.randrange(0, 7)):
                copy[rng.randrange(len(copy))] = f"edit{rng.randrange(40)}"
            texts.append(" ".join(copy))
    texts.append(prose(rng, 12000))
    docs = table(spark, texts, True)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(docs, n=4, percent=85).collect()}
    want = brute_components([*enumerate(texts), (len(texts), None), (len(texts) + 1, "")], 4, 85)
    assert got == want


def test_jaccard_passages_met_by_chance(spark, monkeypatch):
    """Texts that have one passage in common and little else are compared by their prefixes and samples, not set by set."""
    rng, pairs = random.Random(4), []
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    passages = [" ".join(word() for _ in range(8)) for _ in range(30)]
    texts = [" ".join([*(word() for _ in range(80)), rng.choice(passages), *(word() for _ in range(80))]) for _ in range(240)]
    texts += [t + " end" for t in texts[:20]]
    members = jaccard._members
    for name in ("SKETCH", "CHUNK"):  # as full as that of a large corpus, which tells no rare shingle from one met twice
        monkeypatch.setattr(jaccard, name, 1 << 8)
    monkeypatch.setattr(jaccard, "_members", lambda p, *rest: (pairs.append(p.count()), members(p, *rest))[1])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in jaccard.jaccard_components(docs, n=4, percent=85).collect()}
    assert got == {k: k - 240 if k >= 240 else k for k in range(260)}
    assert pairs[0] <= 60


def test_jaccard_empty(spark):
    assert jaccard.jaccard_components(table(spark, ["a"]).where("false")).count() == 0


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 90), (90, 95), (7, 7)], "a long, b long")
    got = {r["id"]: r["component"] for r in common.components(spark, edges).collect()}
    assert got == {**{k: 0 for k in range(41)}, 90: 90, 95: 90, 100: 90}


# Decontamination -------------------------------------------------------------------------------------------------


def brute_tiles(a, b, least):
    """Greedy string tiling by trying all pairs of places."""
    fa, fb, out = [True] * len(a), [True] * len(b), []
    while True:
        best = (0, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                k = 0
                while i + k < len(a) and j + k < len(b) and fa[i + k] and fb[j + k] and a[i + k] == b[j + k]:
                    k += 1
                if k > best[0]:
                    best = (k, i, j)
        k, i, j = best
        if k < least:
            return out
        fa[i : i + k] = [False] * k
        fb[j : j + k] = [False] * k
        out.append(best)


@pytest.mark.parametrize("seed", range(8))
def test_tiles(seed):
    rng = random.Random(seed)
    a = [rng.randrange(6) for _ in range(30)]
    b = [rng.randrange(6) for _ in range(20)] + a[10:25] + [rng.randrange(6) for _ in range(5)] + a[:12]
    got = tiling.tiles(a, b, 4)
    want = brute_tiles(a, b, 4)
    assert all(a[i : i + k] == b[j : j + k] for k, i, j in got)
    assert len({i + x for k, i, _ in got for x in range(k)}) == sum(k for k, _, _ in got) == len({j + x for k, _, j in got for x in range(k)})
    assert got[0][0] == want[0][0]
    assert abs(sum(k for k, _, _ in got) - sum(k for k, _, _ in want)) <= 4  # ties may be marked in another order


def test_contaminated(spark):
    rng = random.Random(2)
    item = prose(rng, 40).split()
    swapped = item[20:] + item[:20]
    texts = [prose(rng, 200), " ".join(prose(rng, 50).split() + item + prose(rng, 50).split()), "A, " + "; ".join(swapped).upper(), " ".join(item[:15]), "tiny item here", "w " * 5000]
    bench = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(item)), (3, "Tiny item"), (4, None), (5, "")], "item_id long, text string")
    out = tiling.contaminated(table(spark, texts, True), bench)
    got = {(r["doc_id"], r["item_id"]): r["covered_words"] for r in out.collect()}
    assert got == {(1, 1): 40, (1, 2): 40, (2, 1): 40, (2, 2): 40, (4, 3): 2}
    assert tiling.contaminated(table(spark, texts).where("false"), bench).count() == 0
    assert tiling.contaminated(table(spark, texts), bench.where("false")).count() == 0


# Licences --------------------------------------------------------------------------------------------------------


def test_licenses(spark):
    texts = ["Licensed under CC BY-NC 4.0. All rights reserved; ALL RIGHTS reserved", "released under the MIT License.", "gnu general public license, version 3", "ccé by", "cc by " * 3000,
             "license license license", "KK cc by"]
    rows = licenses.scan_licenses(table(spark, texts, True)).collect()
    out = {r["doc_id"]: r for r in rows}
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    lower = str.maketrans(licenses.UPPER, licenses.LOWER)
    for k, t in enumerate(texts):
        words = word.findall(t.translate(lower))
        places, names = [], set()
        for phrase, label in licenses.BASE:
            p = phrase.split()
            at = [i for i in range(len(words)) if words[i : i + len(p)] == p]
            places += at
            names |= {label} if at else set()
        assert out[k]["n_words"] == len(words) and sorted(out[k]["base_places"]) == sorted(places) and out[k]["base_labels"] == sorted(names), k
        assert set(out[k]["labels"]) >= names and 0 <= out[k]["score"] <= 1
    assert "cc-by-nc" in out[0]["labels"] and out[1]["labels"] == ["mit"] and out[5]["labels"] == []
    assert len(rows) == len(texts) + 4 and out[len(texts)]["n_words"] == 0
    assert licenses.scan_licenses(table(spark, texts).where("false")).count() == 0


# PII -------------------------------------------------------------------------------------------------------------

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def brute_pii(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


def test_pii_base(spark):
    rng = random.Random(4)
    bits = ["a.b@c.d", "@", ".", "x_y%z@q-r.s.t", "1.2.3.4", "300.1.1.1", "001.002.003.0004", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "4111-1111-1111-1112", "4111111111111111", "+1 (555) 010-9999", "+123", " ", "é🙂", "12", "-", "+", "a", "\n", "(5)", "a@b.c_d@e.f"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(1, 14))) for _ in range(300)] + ["a" * 100_000, "1" * 100_000, "1 " * 20_000, "1." * 20_000, "+1" + "-" * 50_000, "a@" * 20_000]
    out = {r["doc_id"]: r for r in pii.find_pii(table(spark, texts, True)).collect()}
    for k, t in enumerate(texts):
        assert [(kind, s["start"], s["end"]) for kind in PATTERNS for s in out[k][kind]] == brute_pii(t), t[:200]
    assert all(out[len(texts)][kind] == [] for kind in PATTERNS)


def test_pii_learns_contexts(spark):
    rng = random.Random(9)
    texts = [f"Prose goes on. Reach me at: user{k}@mail.example.com today, and {prose(rng, 5).replace('1', 'l')}" for k in range(40)]
    texts += [f"Prose goes on. Reach me at: QX{k}7731AB{k} today, and so on" for k in range(5)] + ["The build abcdef12345678 passed in lab seven"]
    out = {r["doc_id"]: r for r in pii.find_pii(table(spark, texts)).collect()}
    for k in range(40, 45):
        (s,) = out[k]["id"]
        assert texts[k][s["start"] : s["end"]] == f"QX{k - 40}7731AB{k - 40}"
    assert out[45]["id"] == []


def test_pii_second_hop(spark):
    """Identifiers found by the context of e-mails bring in their own second context, and that one others of another form."""
    texts = [f"reach me at: user{k}@mail.example.com today" for k in range(20)]
    texts += [f"reach me at: QX{k}7731AB today" for k in range(9)] + [f"then badge number QX{k}7731AB was seen" for k in range(9)]
    texts += ["then badge number 54t7 was none", "then badge number n-403-9b-c was none"]
    texts += ["lab 77 shows run12345 here"]
    out = {r["doc_id"]: r for r in pii.find_pii(table(spark, texts)).collect()}
    found = [[texts[k][s["start"] : s["end"]] for s in out[k]["id"]] for k in range(len(texts))]
    assert found[:20] == [[]] * 20 and found[20:29] == found[29:38] == [[f"QX{k}7731AB"] for k in range(9)]
    assert found[38:] == [[], ["n-403-9b-c"], []]


def brute_scores(graph, rounds, trust, support, sure):
    seeds = {v for v, seed, _ in graph if seed}
    scores = dict.fromkeys(seeds, 1.0)
    around = collections.defaultdict(set)
    for v, _, p in graph:
        around[p].add(v)
    for _ in range(rounds):
        belief = {p: sum(scores.get(v, 0) for v in vs) / (len(vs) + 1) for p, vs in around.items() if sum(scores.get(v, 0) for v in vs) >= support}
        new = dict.fromkeys(seeds, 1.0)
        for v in {v for v, _, _ in graph} - seeds:
            best = {kind: max((belief[p] for p in around if p[0] == kind and v in around[p] and belief.get(p, 0) >= sure), default=0) for kind in "LRF"}
            doubt = (1 - best["L"]) * (1 - best["R"]) * (1 - best["F"])
            if 1 - doubt >= trust and (best["L"] or best["R"]):
                new[v] = 1 - doubt
        scores = new
    return scores


@pytest.mark.parametrize("seed", range(3))
def test_pii_rounds_against_brute_force(spark, seed):
    rng = random.Random(seed)
    certain = set(range(12))
    graph = sorted({(v, v in certain, rng.choice("LRF") + str(min(rng.randrange(14), rng.randrange(14)))) for v in range(60) for _ in range(rng.randrange(1, 5))})
    rows = spark.createDataFrame(graph, "value long, seed boolean, pattern string")
    for rounds in (1, 3):
        got = {r["value"]: r["score"] for r in pii.score_values(rows, rounds=rounds, trust=0.4, support=2, sure=0.2).collect()}
        assert got == pytest.approx(brute_scores(graph, rounds, 0.4, 2, 0.2))
    assert len(got) > len(certain)


def test_pii_seeds_and_copies(spark):
    key = "AKIA" + "Q7" * 8
    texts = ['set token = "24be64439e3e49cf" now', f"use {key} there", "odd ab12cd34 thing"] + ["mail a1@b.cc odd ab12cd34 thing"] * 30
    out = {r["doc_id"]: [texts[r["doc_id"]][s["start"] : s["end"]] for s in r["id"]] for r in pii.find_pii(table(spark, texts)).where(f"doc_id < {len(texts)}").collect()}
    assert out[0] == ["24be64439e3e49cf"] and out[1] == [key] and out[2] == out[3] == []
    assert pii.find_pii(table(spark, texts).where("false")).count() == 0


def test_digest_of_pii(spark, small):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    for r in pii.op10_pii(spark, small).collect():
        want = ",".join(f"{k}:{s}:{e}" for k, s, e in brute_pii(docs[r["doc_id"]]))
        assert r["base_sha256"] == hashlib.sha256(want.encode()).hexdigest()
        assert r["spans"].startswith(want)


def test_pii_of_a_text_with_many_matches(spark):
    """Places over several runs of matches and chunks of text, long spans and spans at the edges of chunks."""
    rng = random.Random(4)
    words = []
    for k in range(2500):
        words.append(rng.choice([f"user{k}@host{k % 7}.example.org", f"10.{k % 256}.0.{k % 300}", f"+{10**9 + k}", f"key{k}x9", "é" * rng.randrange(9), f"token = \"{'ab1' * 700}{k}\"" if k % 400 == 7 else "of"]))
    text = " ".join(words)
    out = pii.find_pii(table(spark, [text])).where("doc_id = 0").first()
    email = [(m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    assert len(text) > 5 * pii.CHUNK and [tuple(x) for x in out["email"]] == email and len(email) > 3 * pii.RUN
    assert [tuple(x) for x in out["ip"]] == [(m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+){3}", text) if all(int(x) <= 255 for x in m[0].split("."))]
    assert {text[s["start"] : s["end"]] for s in out["id"]} >= {"ab1" * 700 + str(k) for k in range(7, 2500, 400) if f"ab1{k}\"" in text}


@pytest.mark.parametrize(("sf", "side", "least"), [("sf0.1", 0, 60), ("sf0.01", 1, 4)])
def test_pii_patterns_find_what_no_rule_has_seeded(spark, sf, side, least):
    """With the secrets of half of the documents as seeds, patterns find nine of ten of the others', and little else."""
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select("doc_id", "text").where("doc_id is not null and text is not null")
    planted = {}
    for r in docs.where("text rlike '(password|token|secret|key)[\"\\']?\\\\s?[=:]'").collect():
        for m in re.finditer(r"(?i)(?<![a-z0-9])(?:password|passwd|pwd|secret|token|api[_ -]?key|access[_ -]?key)[\"']?\s?[=:]\s?[\"']?([A-Za-z0-9_-]{5,})", r["text"]):
            if re.search("[0-9]", m[1]):
                planted.setdefault(m[1], set()).add(r["doc_id"])
    half = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == side
    kept = docs.select("doc_id", half.alias("half"), "text").where("half").select("doc_id").collect()
    seeded = {r["doc_id"] for r in kept}
    unseen = {v for v, ids in planted.items() if not ids & seeded}
    out = pii.find_pii(docs, seeded=half).where("size(id) > 0").join(docs.groupBy("doc_id").agg(F.first("text").alias("text")), "doc_id").collect()
    found = {r["text"][s["start"] : s["end"]] for r in out for s in r["id"]}
    assert len(unseen) >= least and len(found & unseen) >= 0.9 * len(unseen), (len(unseen), len(found & unseen))
    assert len(found & set(planted)) >= 0.9 * len(found), sorted(found - set(planted))[:20]


def test_native_plans(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    for df in (licenses.scan_licenses(docs), pii.find_pii(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Arrow|Pandas", plan)
