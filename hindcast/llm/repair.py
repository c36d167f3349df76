"""Conversation structure repair: lightest derivations by Knuth's agenda.

Rows are kept, given another role, deleted or added until the initials of the
roles read (s?(ua)+)?.  An item (from, i, to) says: the rows before i take the
grammar from one state to the other; its weight is (cost, audit), audit being
the edits' initials.  A deduction joins an item with an edit, or two items that
meet, and its weight is the sum of the costs and the audits one after the other.
Such functions are superior in (cost, audit): a further edit never makes a
weight less.  They are monotone: audits of one item's derivations that cost the same
are never each other's beginnings, since only added rows could make the
difference and they cost more.  So items leave the agenda in the order of their
weights, each for good, and the work ends when the goal item leaves it.

Spark sorts all rows by conversation and turn into ranges, so a long conversation
is spread over many tasks.  A conversation that lies in one task and has at most
`block` rows is repaired there.  Of others each block of rows gives the items
from each state to each; the items of a conversation's blocks are then joined by
the same agenda, and its rows go to their digest block by block, in a stream.  What
one task holds is a block's rows and one conversation's items, never its texts.
A turn's copies are found by a hash of role and text that is grouped by Spark.

Defined results: null conv_id is a conversation of its own; null role and text are one
space; rows of one turn stand in the order of role and text; null turns come first; equal
rows are copies; a conversation whose rows are all dropped has zeros, an empty
audit and the hash of nothing; initials other than s, u, a are never kept; texts are
taken whole; an empty table gives no rows.  Columns beside conv_id, turn, role and
text are not looked at.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from hindcast.llm.common import durable

#: Rows of a conversation that one agenda takes at once.
BLOCK = 128
#: Costs of the edits, and of a truncated row that stays.
RENAME, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: States are start, after s, after u, after a; the moves of (s?(ua)+)?, and where it may end.
MOVES = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
ENDS = (0, 3)
NAMES = {"u": "user", "a": "assistant"}
SPACE = "\t\n\x0b\x0c\r "

Item = tuple[int, str]


def lightest(rows: list[tuple[str, bool, bool]], start: int, ends: Iterable[int], most: int = len(MOVES)) -> dict[int, Item]:
    """(cost, audit) by end state of the lightest ways over rows (initial, must go, truncated) from a state; the first `most` goals."""
    n, final, ends = len(rows), set(), set(ends)
    agenda, best, goals = [(0, "", 0, start)], {(0, start): (0, "")}, {}

    def deduce(cost: int, audit: str, i: int, state: int) -> None:
        known = best.get((i, state))
        if known is None or (cost, audit) < known:
            best[i, state] = cost, audit
            heapq.heappush(agenda, (cost, audit, i, state))

    while agenda and len(goals) < min(most, len(ends)):
        cost, audit, i, state = heapq.heappop(agenda)
        if (i, state) in final:
            continue
        final.add((i, state))
        if i == n and state in ends:
            goals[state] = cost, audit
        for x in NAMES:
            if x in MOVES[state]:
                deduce(cost + INSERT, audit + "I", i, MOVES[state][x])
        if i == n:
            continue
        initial, gone, truncated = rows[i]
        deduce(cost + DELETE, audit + "D", i + 1, state)
        if not gone:
            stays = cost + TRUNCATED * truncated
            for x, to in MOVES[state].items():
                if x == initial:
                    deduce(stays, audit + "K", i + 1, to)
                if x in NAMES:
                    deduce(stays + RENAME, audit + "R", i + 1, to)
    return goals


class Way(NamedTuple):
    """A derivation over a conversation's first blocks; its audit is read back along `before`, so ways share their beginnings."""

    cost: int
    depth: int
    state: int
    edits: str
    before: Way | None

    def steps(self, down_to: Way | None = None) -> list[Way]:
        out, way = [], self
        while way is not down_to and way.before is not None:
            out.append(way)
            way = way.before
        return out[::-1]


def _less(a: Way, b: Way) -> bool:
    """Whether a is lighter than b, another way to the same item; audits are compared from where the ways part."""
    if a.cost != b.cost:
        return a.cost < b.cost
    x, y = a, b
    while x is not y and x.depth:
        x, y = x.before, y.before
    return "".join(w.edits for w in a.steps(x)) < "".join(w.edits for w in b.steps(x))


def join_items(blocks: list[dict[tuple[int, int], Item]]) -> Way:
    """The lightest way over a conversation's blocks.

    Items leave the agenda by cost and, as each block only adds to an audit, by the blocks they cover; of ways to one
    item that cost the same the lesser audit is kept.
    """
    root = Way(0, 0, 0, "", None)
    agenda, best, final = [(0, 0, 0)], {(0, 0): root}, set()
    while agenda:
        _, k, state = heapq.heappop(agenda)
        if (k, state) in final:
            continue
        final.add((k, state))
        way = best[k, state]
        if k == len(blocks):
            if state not in ENDS:
                continue
            rivals = [best[k, e] for e in ENDS if (k, e) in best and best[k, e].cost == way.cost]
            return min(rivals, key=lambda w: "".join(x.edits for x in w.steps()))
        for (a, b), (cost, edits) in blocks[k].items():
            if a == state:
                new = Way(way.cost + cost, k + 1, b, edits, way)
                if (k + 1, b) not in best or _less(new, best[k + 1, b]):
                    best[k + 1, b] = new
                    heapq.heappush(agenda, (new.cost, k + 1, b))
    raise AssertionError("every conversation can be repaired")


class Digest:
    """Running hash of repaired lines, edit by edit."""

    def __init__(self) -> None:
        self.sha, self.any = hashlib.sha256(), False

    def edit(self, audit: str, state: int, rows: Iterator[tuple[str, str]]) -> None:
        """Adds what the edits of audit make of the rows (role, text); rows are taken as they are needed."""
        for e in audit:
            role, text = ("", "") if e == "I" else next(rows)
            if e == "D":
                continue
            if e == "K":
                state = MOVES[state][role[:1]]
            else:
                x = next(x for x in MOVES[state] if x in NAMES)
                role, state = NAMES[x], MOVES[state][x]
            self.sha.update((("\n" if self.any else "") + role + ":" + text).encode())
            self.any = True


def damage(conv: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text, copies) after the fixed damage; a dropped row stays with 0 copies, without role and text."""
    id_, turn = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn"))
    kind = F.crc32(F.concat_ws(":", id_, turn).cast("binary")) % 20
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    return conv.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.when(kind == 0, None).when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 0, None).when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))


def _faults(rows: DataFrame) -> DataFrame:
    """Adds key (of role and text within the conversation), later (the same stood at an earlier turn), blank and truncated."""
    dropped = F.when(F.col("copies") == 0, F.struct("turn"))  # has a key of its own, so that such rows don't meet
    rows = rows.withColumn("key", F.md5(F.to_json(F.struct("conv_id", "role", "text", dropped.alias("dropped"))).cast("binary")))
    at = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    first = rows.where("copies > 0").groupBy("key").agg(F.min(at).alias("first"), F.max(at).alias("last")).where("not (first.turn <=> last.turn)").select("key", "first")
    trimmed = F.rtrim("text", F.lit(SPACE))
    return rows.join(first, "key", "left").select(
        "conv_id", "turn", "role", "text", "copies", "key", (F.col("first").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first.turn"))).alias("later"),
        (trimmed == "").alias("blank"), (~F.right(trimmed, F.lit(1)).isin(".", "!", "?")).alias("truncated"))


#: Figures of a block that add up; then what its neighbours need of it.
COUNTS = ["turns", "blank", "duplicate", "truncated", "illegal"]
LONG, TEXT = pa.int64(), pa.string()
FIELDS = pa.schema([
    ("part", pa.int32()), ("block", pa.int32()), ("conv_id", LONG), ("kind", TEXT), *[(c, LONG) for c in COUNTS], ("least", LONG), ("most", LONG), ("head", TEXT), ("tail", TEXT),
    ("items", pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("cost", LONG), ("audit", TEXT)]))), ("cost", LONG), ("audit", TEXT), ("repaired_sha256", TEXT),
    ("place", pa.int32()), ("role", TEXT), ("text", TEXT)])
JOINED = pa.schema([("conv_id", LONG), ("part", pa.int32()), ("block", pa.int32()), ("state", pa.int32()), ("edits", TEXT), *[(c, LONG) for c in [*COUNTS, "least", "most", "cost"]], ("audit", TEXT)])
DIGESTS = pa.schema([("conv_id", LONG), ("repaired_sha256", TEXT)])


class Block:
    """Consecutive rows of one conversation in one task."""

    def __init__(self, conv_id: int | None, last: tuple | None, key: str | None) -> None:
        self.conv_id, self.rows, self.last_turn, self.key = conv_id, [], last, key
        self.counts = dict.fromkeys(COUNTS, 0)
        self.least = self.most = None

    def add(self, turn: int | None, role: str, text: str, key: str, later: bool, blank: bool, truncated: bool) -> None:
        duplicate = not blank and (later or key == self.key)
        truncated = truncated and not blank and not duplicate
        self.key = key
        if turn is not None and (turn,) != self.last_turn:
            self.counts["turns"] += 1
            self.least, self.most = turn if self.least is None else self.least, turn
            self.last_turn = (turn,)
        initial = role[:1]
        if self.rows and self.rows[-1][0][0] + initial not in ("su", "ua", "au"):
            self.counts["illegal"] += 1
        for name, x in (("blank", blank), ("duplicate", duplicate), ("truncated", truncated)):
            self.counts[name] += x
        self.rows.append(((initial, blank or duplicate, truncated), role, text))

    def base(self, part: int, number: int, kind: str) -> dict:
        head, tail = (self.rows[0][0][0], self.rows[-1][0][0]) if self.rows else (None, None)
        return {"part": part, "block": number, "conv_id": self.conv_id, "kind": kind, **self.counts, "least": self.least, "most": self.most, "head": head, "tail": tail}

    def whole(self, part: int) -> Iterator[dict]:
        """The repaired conversation."""
        ((cost, audit),) = lightest([r[0] for r in self.rows], 0, ENDS, 1).values()
        digest = Digest()
        digest.edit(audit, 0, ((role, text) for _, role, text in self.rows))
        yield self.base(part, 0, "whole") | {"cost": cost, "audit": audit, "repaired_sha256": digest.sha.hexdigest()}

    def piece(self, part: int, number: int) -> Iterator[dict]:
        """The block's items, and its rows for the digest."""
        items = [{"a": a, "b": b, "cost": c, "audit": e} for a in range(4) for b, (c, e) in lightest([r[0] for r in self.rows], a, range(4)).items()]
        yield self.base(part, number, "block") | {"items": items}
        for place, (_, role, text) in enumerate(self.rows):
            yield {"part": part, "block": number, "conv_id": self.conv_id, "kind": "row", "place": place, "role": role, "text": text}


def _in_blocks(size: int):
    """For mapInArrow over sorted rows: whole conversations are repaired, others cut into blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, out, held = TaskContext.get().partitionId(), [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal out, held
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=FIELDS)
            out, held = [], 0

        def emit(rows: Iterator[dict]) -> Iterator[pa.RecordBatch]:
            nonlocal held
            for r in rows:
                out.append(r)
                held += 200 + len(r.get("text") or "")
                if held > 4_000_000:
                    yield from flush()

        now, number, first = None, 0, True
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                for r in batch.slice(at, 64).to_pylist():
                    if now is None or r["conv_id"] != now.conv_id:
                        if now is not None:
                            # The task's first conversation may have begun in the task before.
                            yield from emit(now.piece(part, number) if number or first else now.whole(part))
                            first = False
                        now, number = Block(r["conv_id"], None, None), 0
                    for _ in range(r["copies"]):
                        if len(now.rows) == size:
                            yield from emit(now.piece(part, number))
                            now, number = Block(now.conv_id, now.last_turn, now.key), number + 1
                        now.add(r["turn"], r["role"], r["text"], r["key"], r["later"], r["blank"], r["truncated"])
        if now is not None:  # and its last may go on in the next one
            yield from emit(now.piece(part, number))
        yield from flush()

    return run



def _join_blocks(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """One conversation's blocks, in order: its figures on the first row, and each block's chosen edits."""
    blocks = sorted(table.to_pylist(), key=lambda r: (r["part"], r["block"]))
    counts = {c: sum(b[c] for b in blocks) for c in COUNTS}
    tail = most = None
    for b in blocks:
        if b["head"] is not None:
            counts["illegal"] += tail is not None and tail + b["head"] not in ("su", "ua", "au")
            tail = b["tail"]
        if b["least"] is not None:
            # A turn that goes on in the next task was counted there again; blocks of one task know of each other.
            counts["turns"] -= most == b["least"]
            most = b["most"]
    way = join_items([{(i["a"], i["b"]): (i["cost"], i["audit"]) for i in b["items"]} for b in blocks])
    rows = [{"conv_id": b["conv_id"], "part": b["part"], "block": b["block"], "state": w.before.state, "edits": w.edits} for b, w in zip(blocks, way.steps(), strict=True)]
    rows[0] |= counts | {"least": min((b["least"] for b in blocks if b["least"] is not None), default=None), "most": most, "cost": way.cost, "audit": "".join(r["edits"] for r in rows)}
    return pa.Table.from_pylist(rows, schema=JOINED)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow over rows sorted by conversation, task, block and place; a block's edits stand on its first row."""
    ids, hashes = [], []

    group, digest, left = None, None, None

    def closed() -> None:
        if group is not None:
            digest.edit(left[0], left[1], iter(left[2]))
            ids.append(group[0])
            hashes.append(digest.sha.hexdigest())

    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            for r in batch.slice(at, 64).to_pylist():
                if group != (r["conv_id"],):
                    closed()
                    group, digest, left = (r["conv_id"],), Digest(), None
                if r["kind"] == "block":
                    if left is not None:
                        digest.edit(left[0], left[1], iter(left[2]))
                    left = [r["edits"], r["state"], []]
                else:
                    left[2].append((r["role"], r["text"]))
    closed()
    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(hashes, pa.string())], schema=DIGESTS)


def repair(conv: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per conversation of rows (conv_id, turn, role, text, copies): faults, cost, audit and the digest of the repaired lines."""
    rows = _faults(conv).repartitionByRange("conv_id", "turn", "role", "text").sortWithinPartitions("conv_id", "turn", "role", "text", "key")
    cut = durable(rows.mapInArrow(_in_blocks(block), from_arrow_schema(FIELDS)))
    figures = ["conv_id", *COUNTS, "least", "most", "cost", "audit"]
    whole = cut.where("kind = 'whole'").select(*figures, "repaired_sha256")
    pieces = cut.where("kind = 'block'").select("part", "block", "conv_id", *COUNTS, "least", "most", "head", "tail", "items")
    joined = durable(pieces.groupBy("conv_id").applyInArrow(_join_blocks, from_arrow_schema(JOINED)))
    heads = joined.select("conv_id", "part", "block", F.lit("block").alias("kind"), "state", "edits", F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"), F.lit(-1).alias("place"))
    lines = cut.where("kind = 'row'").select("conv_id", "part", "block", "kind", F.lit(None).cast("int").alias("state"), F.lit(None).cast("string").alias("edits"), "role", "text", "place")
    stream = heads.union(lines).repartition("conv_id").sortWithinPartitions("conv_id", "part", "block", "place")
    hashes = stream.mapInArrow(_digests, from_arrow_schema(DIGESTS)).withColumnRenamed("conv_id", "__id")
    # No more rows than conversations that lie in several tasks, or are longer than a block.
    long = joined.where("cost is not null").join(hashes, F.col("conv_id").eqNullSafe(F.col("__id"))).select(*figures, "repaired_sha256")
    gaps: Column = F.coalesce(F.col("most") - F.col("least") + 1 - F.col("turns"), F.lit(0)).cast("long")
    return whole.union(long).select("conv_id", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(damage(spark.read.parquet(f"{sf_dir}/conversations.parquet")))


OP12_SQL = r"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
dealt AS (
  SELECT conv_id, turn, role, text, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(k, ''), lambda c: ascii(c)::BIGINT)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::BIGINT) ELSE x // 2 END))) % 20 AS d
  FROM keyed),
damaged AS (
  SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN d = 1 THEN '' WHEN d = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(CASE WHEN d = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM dealt WHERE d <> 0),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again,
    trim(text, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ') AS core
  FROM damaged),
faults AS (
  SELECT conv_id, turn, role, text, i, role[1] AS x, core = '' AS blank, core <> '' AND again AS duplicate, core <> '' AND NOT again AND right(core, 1) NOT IN ('.', '!', '?') AS truncated,
    lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1] NOT IN ('su', 'ua', 'au') AS illegal
  FROM numbered),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(blank) AS blank, count_if(duplicate) AS duplicate, count_if(truncated) AS truncated,
    count_if(illegal) AS illegal, count(*) AS n
  FROM faults GROUP BY conv_id),
moves(a, x, b) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
added(a, b, cost, audit, lines) AS (
  SELECT a, a, 0, '', '' FROM range(4) r(a)
  UNION ALL SELECT a, b, 3, 'I', chr(10) || CASE x WHEN 'u' THEN 'user:' ELSE 'assistant:' END FROM moves WHERE x <> 's'
  UNION ALL VALUES (0, 3, 6, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'), (1, 3, 6, 'II', chr(10) || 'user:' || chr(10) || 'assistant:')),
edits AS (
  SELECT f.conv_id, i, r.a::INT AS a, r.a::INT AS b, 4 AS cost, 'D' AS audit, '' AS lines FROM faults f, range(4) r(a)
  UNION ALL
  SELECT f.conv_id, i, m.a, m.b, 3 * truncated::INT, 'K', chr(10) || role || ':' || text FROM faults f JOIN moves m ON m.x = f.x WHERE NOT blank AND NOT duplicate
  UNION ALL
  SELECT f.conv_id, i, m.a, m.b, 3 + 3 * truncated::INT, 'R', chr(10) || CASE m.x WHEN 'u' THEN 'user:' ELSE 'assistant:' END || text FROM faults f JOIN moves m ON m.x <> 's' WHERE NOT blank AND NOT duplicate),
ways AS (
  SELECT conv_id, 0::BIGINT AS i, 0 AS state, {'cost': 0, 'audit': '', 'lines': ''} AS w FROM counts
  UNION ALL
  SELECT ways.conv_id, edits.i, edits.b, min({'cost': w.cost + added.cost + edits.cost, 'audit': w.audit || added.audit || edits.audit, 'lines': w.lines || added.lines || edits.lines})
  FROM ways JOIN added ON added.a = ways.state JOIN edits ON edits.conv_id IS NOT DISTINCT FROM ways.conv_id AND edits.i = ways.i + 1 AND edits.a = added.b
  GROUP BY ways.conv_id, edits.i, edits.b),
goals AS (
  SELECT ways.conv_id, min({'cost': w.cost + added.cost, 'audit': w.audit || added.audit, 'lines': w.lines || added.lines}) AS w
  FROM ways JOIN counts ON counts.conv_id IS NOT DISTINCT FROM ways.conv_id AND counts.n = ways.i JOIN added ON added.a = ways.state WHERE added.b IN (0, 3) GROUP BY ways.conv_id)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, coalesce(w.cost, 0)::BIGINT AS cost, coalesce(w.audit, '') AS audit, sha256(coalesce(w.lines[2:], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN goals ON goals.conv_id IS NOT DISTINCT FROM c.conv_id
"""
