"""Language ID: a linear-chain conditional random field over the words of a text.

Each word's score for a language adds weights of its affixes, character n-grams,
itself and its entry in a lexicon; learned transitions link neighbouring words.
Forward-backward gives each word's posterior over languages, so code-switched
texts are labelled word by word; a text's language is the one with the largest
mean posterior.  Forward-backward runs on blocks of words: products of transfer
matrices carry messages across blocks exactly, and all blocks of a batch are
worked on together.

Training uses a bounded sample (`per_language` documents of each language, by a
hash of the id).  Its words are strung into chains that switch languages, so
that transitions are learnt from real changes.  Tasks train on their shards by
AdaGrad from common weights; the weights are averaged after each round.

Defined results: und and score 0 if a text is null or has no letter, or if there
is nothing to learn from; a null lang teaches nothing; a null doc_id is
predicted, not held out and never learnt from; repeated rows each give a row;
ties between languages go to the first in alphabetical order; an empty table
gives no rows; only doc_id, text and, for training, lang are looked at.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hindcast.llm.common import durable, fold, text_rows

WORD = re.compile(r"[^\W\d_]+")
#: Hashed feature weights per language.
FEATURES = 1 << 16
BLOCK = 32
CHAIN = 64
SHARDS = 8
CACHE_WORDS = 250_000
#: Words whose features are summed at once: their number and three characters of 18 bits make a key.
WORDS = 1 << 10


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def features_of(word: str, lexicon: dict[str, int]) -> list[int]:
    """Hashed features; the lexicon's comes first, -1 if there is none."""
    w = f"^{word}$"
    grams = {w, *(w[:n] for n in (2, 3, 4, 5)), *(w[-n:] + "<" for n in (2, 3, 4, 5))}
    grams.update(w[k : k + 2] + "2" for k in range(len(w) - 1))
    grams.update(w[k : k + 3] + "3" for k in range(len(w) - 2))
    entry = lexicon.get(word)
    first = -1 if entry is None else zlib.crc32(b"lexicon %d" % entry) % FEATURES
    return [first, *(zlib.crc32(g.encode()) % FEATURES for g in sorted(grams))]


def _table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, np.uint32(0xEDB88320), np.uint32(0)) ^ (t >> np.uint32(1))
    return t


CRC = _table()


def _fed(state: np.ndarray, byte: np.ndarray | int) -> np.ndarray:
    return CRC[(state ^ np.uint32(byte)) & np.uint32(255)] ^ (state >> np.uint32(8))


def _fed_point(state: np.ndarray, point: np.ndarray) -> np.ndarray:
    """CRC states after the UTF-8 bytes of one more character each."""
    out = _fed(state, point)
    wide = np.flatnonzero(point >= 0x80)
    if len(wide):
        p, s = point[wide], state[wide]
        s = _fed(s, np.where(p < 0x800, 0xC0 | p >> 6, np.where(p < 0x10000, 0xE0 | p >> 12, 0xF0 | p >> 18)).astype(np.uint32))
        for least, shift in ((0x10000, 12), (0x800, 6), (0, 0)):
            at = p >= least
            s[at] = _fed(s[at], 0x80 | p[at] >> np.uint32(shift) & np.uint32(63))
        out[wide] = s
    return out


def summed_features(words: list[str], lexicon: dict[str, int], weights: np.ndarray) -> np.ndarray:
    """The sum of weights of features_of each word, all words at once: n-grams share the checksums of their beginnings."""
    marked = [f"^{w}$" for w in words]
    points = np.frombuffer("".join(marked).encode("utf-32-le"), dtype=np.uint32)
    if not len(words) or points.max() >= 1 << 18:  # letters of planes yet without any
        lists = [features_of(w, lexicon) for w in words]
        return np.array([weights[[f for f in fs if f >= 0]].sum(axis=0) for fs in lists]).reshape(len(words), weights.shape[1])
    sizes = np.array([len(m) for m in marked])
    ends = np.cumsum(sizes)
    starts = ends - sizes
    of = lambda state: weights[((state ^ np.uint32(0xFFFFFFFF)) % np.uint32(FEATURES)).astype(np.int64)]
    fresh = lambda n: np.full(n, 0xFFFFFFFF, dtype=np.uint32)
    sums = weights[np.array([zlib.crc32(m.encode()) % FEATURES for m in marked])]
    entries = np.array([lexicon.get(w, -1) for w in words])
    at = np.flatnonzero(entries >= 0)
    kinds, place = np.unique(entries[at], return_inverse=True)
    sums[at] += weights[np.array([zlib.crc32(b"lexicon %d" % e) % FEATURES for e in kinds], dtype=np.int64)[place]]

    word, inside = np.repeat(np.arange(len(words)), sizes), np.arange(len(points)) - np.repeat(starts, sizes)
    state, code, first = fresh(len(points)), np.zeros(len(points), dtype=np.uint64), np.arange(len(points))
    for n in (1, 2, 3):  # n-grams that stand anywhere, each once a word
        keep = inside[first] + n <= sizes[word[first]]
        first, state, code = first[keep], state[keep], code[keep]
        p = points[first + n - 1]
        state, code = _fed_point(state, p), code << np.uint64(18) | p
        if n > 1:
            once = np.ones(len(first), dtype=bool)
            key = code | word[first].astype(np.uint64) << np.uint64(54)
            seen = np.sort(key)
            again = np.unique(seen[1:][seen[1:] == seen[:-1]])  # few
            if len(again):
                at = np.flatnonzero(np.isin(key, again))
                once[at] = False
                once[at[np.unique(key[at], return_index=True)[1]]] = True
            rows = of(_fed(state, ord(str(n)))) * once[:, None]
            sums += np.add.reduceat(rows, np.flatnonzero(np.append(True, np.diff(word[first]) > 0)))

    state, at = fresh(len(words)), np.arange(len(words))
    for n in range(1, 6):  # beginnings shorter than the word with its marks
        keep = sizes[at] > n
        at, state = at[keep], state[keep]
        state = _fed_point(state, points[starts[at] + n - 1])
        if n > 1:
            sums[at] += of(state)
    for n in range(2, 6):  # ends
        at = np.flatnonzero(sizes >= n)
        state = fresh(len(at))
        for k in range(n, 0, -1):
            state = _fed_point(state, points[ends[at] - k])
        sums[at] += of(_fed(state, ord("<")))
    return sums


class Crf:
    """Weights of features (FEATURES x L), transitions (L x L) and beginnings (L)."""

    def __init__(self, weights: np.ndarray, moves: np.ndarray, begin: np.ndarray, lexicon: dict[str, int]) -> None:
        self.weights, self.moves, self.begin, self.lexicon = weights, moves, begin, lexicon
        self.place: dict[str, int] = {}
        self.table = np.zeros((1024, weights.shape[1]))

    def emissions(self, words: list[str]) -> np.ndarray:
        """Word scores, from a table of the words met so far."""
        place = self.place
        if len(place) > CACHE_WORDS:
            place.clear()
        new = [w for w in dict.fromkeys(words) if w not in place]
        if new:
            sums = np.concatenate([summed_features(new[k : k + WORDS], self.lexicon, self.weights) for k in range(0, len(new), WORDS)])
            start = len(place)
            while start + len(new) > len(self.table):
                self.table = np.concatenate([self.table, np.zeros_like(self.table)])
            self.table[start : start + len(new)] = sums
            place.update(zip(new, range(start, start + len(new))))
        return self.table[np.fromiter(map(place.__getitem__, words), dtype=np.int64, count=len(words))]

    def posteriors(self, scores: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Each word's distribution over languages, for chains laid end to end (all lengths positive)."""
        L = scores.shape[1]
        e = np.exp(scores - scores.max(axis=1, keepdims=True))
        move, begin = np.exp(self.moves - self.moves.max()), np.exp(self.begin - self.begin.max())
        per = -(-lengths // BLOCK)
        first_block = np.concatenate([[0], np.cumsum(per)[:-1]])
        n = int(per.sum())
        first_word = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        chain = np.repeat(np.arange(len(lengths)), lengths)
        inside = np.arange(len(scores)) - first_word[chain]
        block, slot = first_block[chain] + inside // BLOCK, inside % BLOCK
        E = np.zeros((n, BLOCK, L))
        E[block, slot] = e
        used = np.zeros((n, BLOCK, 1), dtype=bool)
        used[block, slot] = True

        # Transfer matrix of each block: the product of its words' steps (beginnings are handled by a first row).
        product = np.broadcast_to(np.eye(L), (n, L, L)).copy()
        opens = np.zeros(n, dtype=bool)
        opens[first_block] = True
        for k in range(BLOCK):
            step = (product.reshape(-1, L) @ move).reshape(n, L, L) * E[:, k, None, :]
            if k == 0:
                step[opens] = begin * E[opens, 0, None, :]
            step /= np.maximum(step.sum(axis=(1, 2), keepdims=True), 1e-300)
            product = np.where(used[:, k, :, None], step, product)

        ahead, behind = np.full((n, L), 1.0 / L), np.full((n, L), 1.0 / L)  # messages into each block from its left and right
        for j in range(1, int(per.max())):
            at = first_block[per > j] + j
            m = np.einsum("bi,bij->bj", ahead[at - 1], product[at - 1])
            ahead[at] = m / m.sum(axis=1, keepdims=True)
        for j in range(int(per.max()) - 2, -1, -1):
            at = first_block[per > j + 1] + j
            m = np.einsum("bij,bj->bi", product[at + 1], behind[at + 1])
            behind[at] = m / m.sum(axis=1, keepdims=True)

        alpha = np.zeros((n, BLOCK, L))
        a = ahead
        for k in range(BLOCK):
            step = (a @ move) * E[:, k]
            if k == 0:
                step[opens] = begin * E[opens, 0]
            step /= np.maximum(step.sum(axis=1, keepdims=True), 1e-300)
            a = alpha[:, k] = np.where(used[:, k], step, a)
        beta = behind
        for k in range(BLOCK - 1, -1, -1):
            alpha[:, k] *= beta
            step = (E[:, k] * beta) @ move.T
            step /= np.maximum(step.sum(axis=1, keepdims=True), 1e-300)
            beta = np.where(used[:, k], step, beta)
        gamma = alpha[block, slot]
        return gamma / np.maximum(gamma.sum(axis=1, keepdims=True), 1e-300)

    def train(self, chains: list[tuple[list[str], np.ndarray]], epochs: int, rate: float, seed: int) -> None:
        """AdaGrad on chains of equal length: expected against true counts of features and transitions."""
        L, rng = self.weights.shape[1], np.random.default_rng(seed)
        known = {w: np.array(features_of(w, self.lexicon)) for w in {w for ws, _ in chains for w in ws}}
        sums, sums_m, sums_b = np.full(self.weights.shape, 1e-2), np.full((L, L), 1e-2), np.full(L, 1e-2)
        for _ in range(epochs):
            order = rng.permutation(len(chains))
            for at in range(0, len(order), 32):
                some = [chains[k] for k in order[at : at + 32]]
                lists = [known[w] for ws, _ in some for w in ws]
                sizes = np.array([len(x) for x in lists])
                flat = np.concatenate(lists)
                keep = flat >= 0
                keep &= ~((np.arange(len(flat)) == np.repeat(np.cumsum(sizes) - sizes, sizes)) & (rng.random(len(flat)) < 0.3))
                scores = np.add.reduceat(self.weights[flat] * keep[:, None], np.cumsum(sizes) - sizes).reshape(len(some), -1, L)
                truth = np.eye(L)[np.stack([y for _, y in some])]
                gamma, pairs = self._expected(scores)
                error = np.repeat((truth - gamma).reshape(-1, L), sizes, axis=0)[keep]
                ids, place = np.unique(flat[keep], return_inverse=True)
                g = np.stack([np.bincount(place, error[:, y], len(ids)) for y in range(L)], axis=1) / len(some)
                g -= 1e-4 * self.weights[ids]
                sums[ids] += g * g
                self.weights[ids] += rate * g / np.sqrt(sums[ids])
                true_pairs = np.einsum("bti,btj->ij", truth[:, :-1], truth[:, 1:])
                g = (true_pairs - pairs) / len(some) - 1e-3 * self.moves
                sums_m += g * g
                self.moves += rate * g / np.sqrt(sums_m)
                g = (truth[:, 0] - gamma[:, 0]).sum(axis=0) / len(some) - 1e-3 * self.begin
                sums_b += g * g
                self.begin += rate * g / np.sqrt(sums_b)

    def _expected(self, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Word posteriors and summed expected transitions of chains of equal length (B x T x L)."""
        B, T, L = scores.shape
        e = np.exp(scores - scores.max(axis=2, keepdims=True))
        move, begin = np.exp(self.moves), np.exp(self.begin)
        a, b = np.zeros((B, T, L)), np.ones((B, T, L))
        for t in range(T):
            step = (begin if t == 0 else a[:, t - 1] @ move) * e[:, t]
            a[:, t] = step / step.sum(axis=1, keepdims=True)
        for t in range(T - 2, -1, -1):
            step = (b[:, t + 1] * e[:, t + 1]) @ move.T
            b[:, t] = step / step.sum(axis=1, keepdims=True)
        gamma = a * b
        gamma /= gamma.sum(axis=2, keepdims=True)
        pairs = a[:, :-1, :, None] * move * (e[:, 1:] * b[:, 1:])[:, :, None, :]
        return gamma, (pairs / pairs.sum(axis=(2, 3), keepdims=True)).sum(axis=(0, 1))


def chains_of(docs: list[tuple[str, int]], seed: int) -> list[tuple[list[str], np.ndarray]]:
    """Chains of CHAIN words: pieces of 8 to CHAIN words of the documents, in random order, end to end."""
    rng, pieces = np.random.default_rng(seed), []
    for text, y in docs:
        words, at = words_of(text), 0
        while at < len(words):
            n = int(rng.integers(8, CHAIN + 1))
            pieces.append((words[at : at + n], y))
            at += n
    words, labels = [], []
    for k in rng.permutation(len(pieces)):
        words += pieces[k][0]
        labels += [pieces[k][1]] * len(pieces[k][0])
    return [(words[k : k + CHAIN], np.array(labels[k : k + CHAIN])) for k in range(0, len(words) - CHAIN + 1, CHAIN)]


def fit(docs: DataFrame, *, per_language: int = 400, lexicon_words: int = 50_000, lexicon_least: int = 3, rounds: int = 2, epochs: int = 2, rate: float = 0.2) -> dict:
    """Arrays of the model and its languages, learnt from (doc_id, text, lang) of documents that aren't held out.

    The lexicon has the `lexicon_words` most frequent words of the sample that it holds `lexicon_least` times.
    """
    known = docs.select(F.col("doc_id").cast("long"), "text", "lang").where("doc_id is not null and text is not null and lang is not null").where(fold() != 2)
    totals = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    ids = known.select("doc_id", "lang").join(F.broadcast(totals), "lang")  # a row per language
    likely = F.pmod(F.xxhash64("doc_id", F.lit(4)), F.lit(1 << 20)) * F.col("n") <= 2 * per_language * (1 << 20)
    best = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id", F.lit(4)), "doc_id"))
    ids = ids.where(likely).withColumn("best", best).where(F.col("best") <= per_language).select("doc_id", "lang").distinct()
    sample = durable(known.join(F.broadcast(ids), ["doc_id", "lang"]).select("doc_id", "text", "lang"))
    langs = sorted(r["lang"] for r in sample.select("lang").distinct().collect())
    model = {"langs": langs}
    if not langs:
        return model
    number = {x: k for k, x in enumerate(langs)}
    L = len(langs)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for b in batches:
            for text, lang in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                seen.update((w, lang) for w in words_of(text))
        if seen:
            w, y = zip(*seen)
            yield pa.RecordBatch.from_arrays([pa.array(w), pa.array(y), pa.array(seen.values(), pa.int64())], names=["word", "lang", "n"])

    spread = sample.repartition(SHARDS, "doc_id")
    per_word = spread.mapInArrow(count, "word string, lang string, n long").groupBy("word", "lang").agg(F.sum("n").alias("n"))
    per_word = per_word.groupBy("word").agg(F.sum("n").alias("n"), F.max("n").alias("most"), F.max_by("lang", F.struct("n", "lang")).alias("lang"))
    entries = per_word.where(F.col("n") >= lexicon_least).orderBy(F.desc("n"), "word").limit(lexicon_words).collect()
    lexicon = {r["word"]: number[r["lang"]] * 4 + min(3, int(4 * r["most"] / r["n"]) if r["most"] < r["n"] else 3) for r in entries}

    state = {"weights": np.zeros((FEATURES, L)), "moves": np.zeros((L, L)), "begin": np.zeros(L)}
    for step in range(rounds):
        shared = docs.sparkSession.sparkContext.broadcast(state | {"lexicon": lexicon})

        def train(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            s = shared.value
            crf = Crf(s["weights"].copy(), s["moves"].copy(), s["begin"].copy(), s["lexicon"])
            rows = rows.sort_values(["doc_id", "text"])
            crf.train(chains_of([(t, number[y]) for t, y in zip(rows["text"], rows["lang"])], int(key[0]) + 1), epochs, rate, int(key[0]))
            parts = {"weights": crf.weights, "moves": crf.moves, "begin": crf.begin}
            return pd.DataFrame({"name": list(parts), "data": [p.tobytes() for p in parts.values()]})

        shard = F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(SHARDS))
        parts = sample.groupBy(shard.alias("shard")).applyInPandas(train, "name string, data binary").collect()  # SHARDS sets of weights
        state = {k: np.mean([np.frombuffer(r["data"]).reshape(v.shape) for r in parts if r["name"] == k], axis=0) for k, v in state.items()}
    return model | state | {"lexicon": lexicon}


def predict(docs: DataFrame, model: dict, *, spans: bool = False) -> DataFrame:
    """doc_id, lang_pred, score and, if asked for, spans: runs of words with one language (lang, first_word, words)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = "doc_id long, lang_pred string, score double" + ", spans array<struct<lang:string,first_word:int,words:int>>" * spans
    part = pa.list_(pa.struct([("lang", pa.string()), ("first_word", pa.int32()), ("words", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        langs = m["langs"]
        crf = Crf(m["weights"], m["moves"], m["begin"], m["lexicon"]) if langs else None
        for b in text_rows(batches, 128):
            words = [words_of(t) if crf else [] for t in b.column(1).to_pylist()]
            lengths = np.array([len(w) for w in words], dtype=np.int64)
            full = np.flatnonzero(lengths)
            names, scores, runs = ["und"] * len(words), [0.0] * len(words), [[] for _ in words]
            if len(full):
                gamma = crf.posteriors(crf.emissions([w for k in full for w in words[k]]), lengths[full])
                starts = np.cumsum(lengths[full]) - lengths[full]
                mean = np.round(np.add.reduceat(gamma, starts) / lengths[full][:, None], 9)
                for k, row, at in zip(full, mean, starts):
                    names[k], scores[k] = langs[int(row.argmax())], min(1.0, float(row.max()))
                    if spans:
                        y = gamma[at : at + lengths[k]].argmax(axis=1)
                        cut = np.flatnonzero(np.append(True, y[1:] != y[:-1]))
                        runs[k] = [{"lang": langs[y[c]], "first_word": int(c), "words": int(n)} for c, n in zip(cut, np.diff(np.append(cut, len(y))))]
            columns = [b.column(0), pa.array(names), pa.array(scores, pa.float64())] + [pa.array(runs, part)] * spans
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "lang_pred", "score", "spans"][: len(columns)])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = predict(docs, fit(docs))
    return found.select("doc_id", F.coalesce(fold() == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")
