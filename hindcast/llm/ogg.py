"""Media columns: Ogg.

A text's bytes become unsigned 8-bit mono samples of one logical stream, muxed
with a small second stream that describes it, and are read back by a page
reader: capture pattern, version, page checksum (polynomial 0x04c11db7, not
reflected), sequence numbers, packets put together from lacing values across
pages, logical streams split by serial number, and times from granule
positions.  Everything is a function of one row, so nothing is shuffled.

Defined results: null text counts as empty, and empty text as 64 zero bytes; a
null doc_id is kept; repeated rows and equal texts give equal values; damaged
pages raise OggError in the reader and give a null row in read_ogg().
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hindcast.llm.common import text_rows

RATE = 8000
BLOCK = 64
PACKET = 4096
#: A page head: pattern, version, flags, granule, serial, number, checksum, lacing values; and its length.
HEAD, HEAD_BYTES = "<4sBBqIIIB", 27
CONTINUED, FIRST, LAST = 1, 2, 4
#: Bytes with their bits in opposite order; turns zlib's reflected checksum into Ogg's.
FLIPPED = bytes(int(f"{b:08b}"[::-1], 2) for b in range(256))


class OggError(ValueError):
    """The bytes are not a sound Ogg stream."""


def page_checksum(page: bytes) -> int:
    raw = zlib.crc32(page.translate(FLIPPED), 0xFFFFFFFF) ^ 0xFFFFFFFF
    return int.from_bytes(raw.to_bytes(4, "little").translate(FLIPPED), "big")


def _page(kind: int, granule: int, serial: int, number: int, lacing: bytes, body: bytes) -> bytes:
    rest = lacing + body
    page = struct.pack(HEAD, b"OggS", 0, kind, granule, serial, number, 0, len(lacing)) + rest
    return page[:22] + page_checksum(page).to_bytes(4, "little") + page[26:]


def _pages(serial: int, packets: list[tuple[bytes, int]]) -> list[bytes]:
    """Pages of one logical stream; a packet comes with its granule position.

    The first packet (the header) gets a page of its own.  A page carries the
    granule of the last packet that ends on it, or -1.
    """
    out, number, flags = [], 0, FIRST
    lacing, body, granule, opens = bytearray(), [], -1, False
    for k, (data, at) in enumerate(packets):
        whole, rest = divmod(len(data), 255)
        values = [255] * whole + [rest]
        start = 0
        for j, v in enumerate(values):
            lacing.append(v)
            body.append(data[start : start + v])
            start += v
            ends = j == len(values) - 1
            if ends:
                granule = at
            last = ends and k == len(packets) - 1
            if last or len(lacing) == 255 or (ends and k == 0):
                kind = flags | (CONTINUED if opens else 0) | (LAST if last else 0)
                out.append(_page(kind, granule, serial, number, bytes(lacing), b"".join(body)))
                number, flags, opens = number + 1, 0, not ends
                lacing, body, granule = bytearray(), [], -1
    return out


def write_ogg(payload: bytes, rate: int = RATE) -> bytes:
    """The payload as 8-bit samples; both serial numbers are derived from it."""
    serial = zlib.crc32(payload)
    note = b"samples=%d;crc=%08x" % (len(payload), serial)
    header = b"\x80pcm8" + struct.pack("<IIB", rate, len(payload), 1)
    packets = [(header, 0)]
    packets += [(payload[k : k + PACKET], min(k + PACKET, len(payload))) for k in range(0, len(payload), PACKET)]
    sound, text = _pages(serial, packets), _pages(serial ^ 0x5A5A5A5A, [(b"\x81note", 0), (note, len(payload))])
    out = [sound[0], text[0]]  # all first pages come before any other
    for k in range(1, max(len(sound), len(text))):
        out += sound[k : k + 1] + text[k : k + 1]
    return b"".join(out)


@dataclass
class Stream:
    packets: list[bytes] = field(default_factory=list)
    times: list[int] = field(default_factory=list)  # granule position at each packet's end, or -1
    part: list[bytes] = field(default_factory=list)
    pages: int = 0
    ended: bool = False


def read_pages(data: bytes) -> dict[int, Stream]:
    """Logical streams by serial number, in order of their first pages."""
    streams: dict[int, Stream] = {}
    at = 0
    while at < len(data):
        if len(data) - at < HEAD_BYTES:
            raise OggError("cut off in a page head")
        mark, version, kind, granule, serial, number, checksum, n = struct.unpack_from(HEAD, data, at)
        if mark != b"OggS" or version:
            raise OggError("no page here")
        body = at + HEAD_BYTES + n
        lacing = data[at + HEAD_BYTES : body]
        end = body + sum(lacing)
        if end > len(data):
            raise OggError("cut off in a page")
        if page_checksum(data[at : at + 22] + bytes(4) + data[at + 26 : end]) != checksum:
            raise OggError("page checksum differs")
        if bool(kind & FIRST) == (serial in streams):
            raise OggError("a stream must begin once")
        s = streams.setdefault(serial, Stream())
        if number != s.pages or s.ended or bool(kind & CONTINUED) != bool(s.part):
            raise OggError("pages are missing")
        whole = []
        for v in lacing:
            s.part.append(data[body : body + v])
            body += v
            if v < 255:
                whole.append(b"".join(s.part))
                s.part = []
        s.packets += whole
        s.times += [-1] * (len(whole) - 1) + [granule] * bool(whole)
        s.pages, s.ended, at = s.pages + 1, bool(kind & LAST), end
    if any(s.part or not s.ended for s in streams.values()):
        raise OggError("a stream does not end")
    return streams


@dataclass
class Sound:
    rate: int
    samples: bytes
    note: str
    seconds: list[float]  # time at the end of each packet of samples
    pages: int


def read_ogg(data: bytes) -> Sound:
    """Demultiplexes; packets inside a page get their times by counting back from the page's granule."""
    streams = read_pages(data)
    heads = {s.packets[0][:5]: s for s in streams.values()}
    if b"\x80pcm8" not in heads or b"\x81note" not in heads:
        raise OggError("streams are missing")
    s = heads[b"\x80pcm8"]
    rate, count, _ = struct.unpack("<IIB", s.packets[0][5:])
    ends, at = [0] * (len(s.packets) - 1), None
    for k in range(len(s.packets) - 1, 0, -1):
        at = s.times[k] if s.times[k] >= 0 else at - len(s.packets[k + 1])
        ends[k - 1] = at
    samples = b"".join(s.packets[1:])
    if len(samples) != count or ends[-1:] != [count]:
        raise OggError("samples are missing")
    return Sound(rate, samples, heads[b"\x81note"].packets[1].decode(), [e / rate for e in ends], sum(x.pages for x in streams.values()))


def features(sound: Sound) -> str:
    """Length, pages, packets, mean, deviation, zero crossings, entropy and the loudest block's time."""
    x = np.frombuffer(sound.samples, dtype=np.uint8)
    counts = np.bincount(x, minlength=256)
    share = counts[counts > 0] / len(x)
    entropy = max(0.0, -float(share @ np.log2(share)))
    y = x.astype(np.int32) - 128
    crossings = int(np.count_nonzero((y[1:] < 0) != (y[:-1] < 0)))
    power = np.add.reduceat(y * y, np.arange(0, len(y), BLOCK))
    loudest = int(power.argmax()) * BLOCK / sound.rate
    return (
        f"seconds={sound.seconds[-1]:.6f};pages={sound.pages};packets={len(sound.seconds)};mean={y.mean():.4f};"
        f"deviation={y.std():.4f};crossings={crossings};entropy={entropy:.4f};loudest={loudest:.6f}"
    )


def padded(text: str | None) -> tuple[int, bytes]:
    raw = (text or "").encode()
    return len(raw), raw + bytes(max(BLOCK, -(-len(raw) // BLOCK) * BLOCK) - len(raw))


def to_media(docs: DataFrame) -> DataFrame:
    """docs with text -> doc_id, n_bytes, media (Ogg bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_rows(batches):
            n, payloads = zip(*map(padded, b.column(1).to_pylist())) if b.num_rows else ((), ())
            media = [write_ogg(p) for p in payloads]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(media, pa.binary())], names=["doc_id", "n_bytes", "media"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_bytes long, media binary")


def from_media(media: DataFrame) -> DataFrame:
    """Reads stored Ogg bytes back: doc_id, n_bytes, media, payload, feature, seconds; nulls where they are damaged."""
    schema = "doc_id long, n_bytes long, media binary, payload binary, feature string, seconds double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_rows(batches):
            rows = []
            for data in b.column(2).to_pylist():
                try:
                    s = read_ogg(data or b"")
                    rows.append((s.samples, features(s), s.seconds[-1]))
                except OggError:
                    rows.append((None, None, None))
            p, f, s = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(p, pa.binary()), pa.array(f, pa.string()), pa.array(s, pa.float64())],
                names=["doc_id", "n_bytes", "media", "payload", "feature", "seconds"])

    return media.select(F.col("doc_id").cast("long"), F.col("n_bytes").cast("long"), "media").mapInArrow(run, schema)


def op5_ogg(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = from_media(to_media(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    tail = F.substring("payload", -BLOCK, BLOCK)
    return read.select(
        "doc_id",
        "n_bytes",
        F.length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(tail).alias("tail_crc32"),
        F.length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        "feature",
    )
