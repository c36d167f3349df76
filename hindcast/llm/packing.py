"""Packing: bounded-space online packing of tokenised documents into fixed windows.

Every partition keeps `open_windows` windows open.  A piece goes to the open
window with the least free space that still holds it (best fit); if none holds
it and no window may be opened, the fullest one is filled to the brim with the
head of the piece, emitted, and the tail is placed in turn.  What stays open at
the end of a partition is merged, `fan_in` partitions at a time, until one
window of the whole table is left partly filled.  No text is shuffled; only the
pieces of at most one open window per partition are.

Defined results: null or empty text is the end token alone; a null doc_id is
kept as null; repeated rows are packed once each; an empty table gives no rows;
a text of any length is cut into as many pieces as it needs.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
import zlib
from array import array
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hindcast.llm.common import durable, text_rows



def unassigned() -> str:
    """The code points of the basic plane without a fixed class, private and surrogate ones too, as ranges of a character class."""
    odd = [unicodedata.category(chr(c)) in {"Cn", "Cs", "Co"} for c in range(1 << 16)] + [False]
    ends = [c for c in range(len(odd)) if odd[c] != (c > 0 and odd[c - 1])]
    return "".join(f"\\u{a:04x}-\\u{b - 1:04x}" for a, b in zip(ends[::2], ends[1::2]))


#: Encoded text runs kept by one Python worker before the cache is emptied.
CACHE_RUNS = 200_000
#: A blank and what follows it, or white space: the tokenizer never merges across these bounds.
RUNS = re.compile(r" ?\S+|\s+(?!\S)|\s+")
#: Characters that Python and the tokenizer class differently as white space, and those that Unicode tables may differ on,
#: with all beyond the basic plane: texts with such go to the tokenizer as a whole.
ODD = re.compile("[\x1c-\x1f\x85" + unassigned() + "\U00010000-\U0010ffff]")


#: Fixed values of byte-level BPE: how texts are cut before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: itself if it can be printed, else one from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def tokenizer_of(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def added_tokens(path: str) -> list[str]:
    """What a text may hold that is a token of its own, special ones too."""
    with open(path, encoding="utf-8") as f:
        return [t["content"] for t in json.load(f).get("added_tokens", ())]


def rank_encoder(path: str) -> Callable[[str], list[int]]:
    """tiktoken on the vocabulary of a byte-level BPE file: it merges the pair with the lowest id first."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    letter, special = byte_letters(), {t["content"] for t in spec.get("added_tokens", ())}
    ranks = {bytes(letter[c] for c in t): k for t, k in spec["model"]["vocab"].items() if t not in special}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def canonical_merges(vocab: dict[str, int], merges: list[tuple[str, str]]) -> bool:
    """Whether merging by the lowest id gives what the list of merges gives, for every text.

    It does if ids rise along the list, and each token's letters, merged by all
    pairs listed before its own, end as the two parts of its own pair: then no
    other two neighbours ever spell a token when its turn comes.
    """
    rank = {m: k for k, m in enumerate(merges)}
    ids = [vocab.get(a + b, -1) for a, b in merges]
    if len(rank) < len(merges) or any(x >= y for x, y in zip(ids, ids[1:])) or (ids and ids[0] < 0):
        return False
    for k, (a, b) in enumerate(merges):
        parts = list(a + b)
        while len(parts) > 2:
            best = min(range(len(parts) - 1), key=lambda i: (rank.get((parts[i], parts[i + 1]), k), i))
            if rank.get((parts[best], parts[best + 1]), k) >= k:
                return False
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        if parts != [a, b]:
            return False
    return True


def prove_same_ids(path: str) -> bool:
    """Whether rank_encoder gives the ids of `tokenizers` for all text without ODD characters.

    The file must be a byte-level BPE without options that change merges, whose
    merges are canonical, and both must cut texts alike round every assigned
    character, beside letters, digits, signs and blanks.
    """
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, cut = spec["model"], spec.get("pre_tokenizer") or {}
    plain = model.get("type") == "BPE" and cut.get("type") == "ByteLevel" and not cut.get("add_prefix_space") and cut.get("use_regex", True)
    if not plain or spec.get("normalizer") or any(model.get(x) for x in ("dropout", "ignore_merges", "continuing_subword_prefix", "end_of_word_suffix")):
        return False
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    if not canonical_merges(model["vocab"], merges):
        return False
    tokenizer, fast = tokenizer_of(path), rank_encoder(path)
    points = [c for c in map(chr, range(sys.maxunicode + 1)) if unicodedata.category(c) not in {"Cn", "Cs", "Co"} and not ODD.match(c)]
    for k in range(0, len(points), 4096):
        texts = ["".join(f"a{c}a1{c}1 {c}!{c} {c}{c}\n" for c in points[j : j + 64]) for j in range(k, min(k + 4096, len(points)), 64)]
        if [fast(t) for t in texts] != [x.ids for x in tokenizer.encode_batch(texts, add_special_tokens=False)]:
            return False
    return True


_PROVED: dict[str, bool] = {}


def same_ids(spark: SparkSession, path: str) -> bool:
    """prove_same_ids of the file as executors see it; a task of five seconds, once per session."""
    if path not in _PROVED:

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for _ in batches:
                yield pa.RecordBatch.from_arrays([pa.array([prove_same_ids(path)])], names=["same"])

        _PROVED[path] = spark.range(0, 1, 1, 1).mapInArrow(run, "same boolean").first()["same"]
    return _PROVED[path]


class Ids:
    """Token ids of texts as little-endian unsigned 32-bit bytes, from runs encoded once per worker.

    The ids are those of `tokenizers` for the vocabulary file at path.  If fast,
    which same_ids must have told, runs are encoded by tiktoken with the
    same vocabulary, which merges short ones about three times as fast.
    """

    def __init__(self, path: str, fast: bool = False, most: int = CACHE_RUNS) -> None:
        self.most = most
        self.path, self.tokenizer = path, None  # loaded when the first text needs it
        self.known: dict[str, bytes] = {}
        self.fast, self.added = (rank_encoder(path) if fast else None), added_tokens(path)

    def slowly(self, texts: list[str]) -> list[bytes]:
        self.tokenizer = self.tokenizer or tokenizer_of(self.path)
        return [np.array(x.ids, dtype="<u4").tobytes() for x in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        if self.fast and sys.byteorder == "little" and array("I").itemsize == 4:
            return [array("I", self.fast(t)).tobytes() for t in texts]
        return self.slowly(texts)

    def __call__(self, texts: list[str]) -> Iterator[bytes]:
        if len(self.known) > self.most:
            self.known.clear()
        known = self.known
        runs = [None if ODD.search(t) or any(x in t for x in self.added) else RUNS.findall(t) for t in texts]
        new = [r for r in set(chain.from_iterable(rs for rs in runs if rs)) if r not in known]
        known.update(zip(new, self.encode(new), strict=True))
        for t, rs in zip(texts, runs, strict=True):
            yield self.slowly([t])[0] if rs is None else b"".join(map(known.__getitem__, rs))


class Windows:
    """The open windows of one partition; emit(pieces) gets each window that is closed."""

    def __init__(self, size: int, most: int, emit: Callable[[list], None]) -> None:
        self.size, self.most, self.emit, self.open = size, most, emit, []

    def add(self, doc_id, total: int, start: int, ids: bytes) -> None:
        left = len(ids) // 4
        at = 0
        while left:
            if left >= self.size:
                take, window = self.size, [0, []]
                self.open.append(window)
            else:
                fits = [w for w in self.open if self.size - w[0] >= left]
                if fits:
                    take, window = left, max(fits, key=lambda w: w[0])
                elif len(self.open) < self.most:
                    take, window = left, [0, []]
                    self.open.append(window)
                else:
                    window = max(self.open, key=lambda w: w[0])
                    take = self.size - window[0]
            window[1].append((doc_id, start + at, ids[4 * at : 4 * (at + take)], total))
            window[0] += take
            at, left = at + take, left - take
            if window[0] == self.size:
                self.open.remove(window)
                self.emit(window[1])

    def rest(self) -> list:
        """Merges the open windows by filling one after the other; returns the pieces of the last."""
        pieces = [p for w in self.open for p in w[1]]
        self.open, self.most = [], 1
        for doc_id, start, ids, total in pieces:
            self.add(doc_id, total, start, ids)
        return self.open[0][1] if self.open else []


SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary, part long"


class Out:
    """Rows of closed windows; part is null for them, and the partition's number for what is left over."""

    def __init__(self, first: int, with_ids: bool) -> None:
        self.next, self.with_ids, self.rows = first, with_ids, []

    def __call__(self, pieces: list, part: int | None = None) -> None:
        offset = 0
        for doc_id, start, ids, total in pieces:
            n = len(ids) // 4
            keep = ids if self.with_ids or part is not None else None
            self.rows.append((doc_id, start, n, zlib.crc32(ids), total, self.next, offset, keep, part))
            offset += n
        self.next += 1

    def take(self) -> list:
        rows, self.rows = self.rows, []
        return rows


COLUMNS = [x.split()[0] for x in SCHEMA.split(", ")]
ARROW = pa.schema([(c, pa.binary() if c == "ids" else pa.int64()) for c in COLUMNS])


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    *,
    size: int = 2048,
    end_id: int = 1,
    open_windows: int = 32,
    fan_in: int = 32,
    with_ids: bool = True,
    cache: int = CACHE_RUNS,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, if asked for, ids.

    cache is how many encoded runs a worker keeps, about 220 bytes each: more of them cost memory and save time.

    tokenizer_path must be readable on every executor; ids are little-endian
    unsigned 32-bit.  sequence_id is round * 2^56 + partition * 2^32 + number.
    """

    fast = same_ids(docs.sparkSession, tokenizer_path)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        ids_of, end = Ids(tokenizer_path, fast, cache), np.array([end_id], dtype="<u4").tobytes()
        out = Out(part << 32, with_ids)
        windows = Windows(size, open_windows, out)
        for b in text_rows(batches):
            texts = [t or "" for t in b.column(1).to_pylist()]
            for doc_id, ids in zip(b.column(0).to_pylist(), ids_of(texts), strict=True):
                ids += end
                windows.add(doc_id, len(ids) // 4, 0, ids)
            if rows := out.take():
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), ARROW)], schema=ARROW)
        out(windows.rest(), part)
        if rows := out.take():
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), ARROW)], schema=ARROW)

    def merge(step: int):
        def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            group = int(key[0])
            out = Out((step << 56) + (group << 32), with_ids)
            windows = Windows(size, 1, out)
            for r in rows.sort_values(["part", "offset"]).itertuples():
                windows.add(None if pd.isna(r.doc_id) else int(r.doc_id), int(r.doc_tokens), int(r.start), bytes(r.ids))
            out(windows.rest(), group)
            return pd.DataFrame(out.take(), columns=COLUMNS).astype({"doc_id": "Int64", "part": "Int64"})

        return run

    done = durable(docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(pack, SCHEMA))
    closed, step = done.where("part is null"), 0
    while (most := done.agg(F.max("part")).first()[0]) is not None and most > 0:
        step += 1
        left = done.where("part is not null")
        done = durable(left.groupBy(F.expr(f"part div {fan_in}")).applyInPandas(merge(step), SCHEMA))
        closed = closed.unionByName(done.where("part is null"))
    return closed.unionByName(done.where("part is not null")).drop("part", *([] if with_ids else ["ids"]))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), with_ids=False, cache=500_000)
