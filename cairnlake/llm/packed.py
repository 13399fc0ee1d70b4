"""Documents in packed parts, and sorted numpy arrays exchanged between parts and hash shards.

Three of the operators ask a question about every window, shingle or anchor of a corpus ("does it
occur elsewhere?"). One row for each would shuffle many times the text. Here a *part* is the
documents whose hash falls into one bucket (a few MB of text), and what a part sends to a *shard*
(a range of hash values) is one sorted, delta-coded, compressed array. The shard's answer goes back
to the part in the order in which it was asked. Parts and shards both grow in number with the
input, so no task grows; a part's rows never number more than the values they hold.

A part is a function of the documents alone, so a lost executor's part is made again as it was, and
no answer depends on the order in which blocks arrive.
"""

from __future__ import annotations

import math
import struct

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PART_BYTES = 4 << 20
#: Documents are packed when this much text has come in, and hashed in pieces of about CHUNK_BYTES.
FLUSH_BYTES = 24 << 20
CHUNK_BYTES = 1 << 20

PACKED = "part int, blob binary"
SENT = "shard int, part int, payload binary"

_LZ = {"options": pa.ipc.IpcWriteOptions(compression="zstd")}


# ---- documents in parts ----------------------------------------------------------------------


def text_bytes(docs: DataFrame, text: str) -> int:
    return docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0


def part_count(total_bytes: int, part_bytes: int = PART_BYTES) -> int:
    return max(1, math.ceil(total_bytes / part_bytes))


def packed_parts(docs: DataFrame, key: str, text: str, parts: int) -> DataFrame:
    """(part, blob): every row's key and whole text, compressed, shuffled once by part.

    A part may come as several blobs. Plans that use the result more than once share its shuffle.
    """
    bucket: Column = F.pmod(F.xxhash64(F.col(key), F.col(text)), F.lit(parts)).cast("int")
    rows = docs.select(bucket.alias("part"), F.col(key).alias("key"), F.col(text).alias("text"))
    # not fewer partitions than other shuffles have, or Spark would deal the texts out again
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.mapInArrow(_pack_rows, PACKED).repartition(max(parts, least), "part")


def _pack_rows(batches):
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= FLUSH_BYTES:
            yield from _blobs(held)
            held, size = [], 0
    if held:
        yield from _blobs(held)


def _blobs(batches):
    table = pa.Table.from_batches(batches)
    part = table.column("part").to_numpy()
    order = np.argsort(part, kind="stable")
    table = table.select(["key", "text"]).take(pa.array(order)).combine_chunks()
    ordered = part[order]
    cuts = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(ordered) else []
    parts, blobs = [], []
    for lo, hi in zip(cuts, [*cuts[1:], len(ordered)], strict=True):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema, **_LZ) as out:
            out.write_table(table.slice(lo, hi - lo))
        parts.append(int(ordered[lo]))
        blobs.append(sink.getvalue().to_pybytes())
        if len(parts) >= 256:
            yield _batch(parts, blobs)
            parts, blobs = [], []
    if parts:
        yield _batch(parts, blobs)


def _batch(parts, blobs):
    return pa.RecordBatch.from_arrays(
        [pa.array(parts, pa.int32()), pa.array(blobs, pa.binary())], ["part", "blob"]
    )


def unpacked(table: pa.Table) -> pa.Table:
    """The (key, text) rows of a part, in no particular order."""
    found = [
        pa.ipc.open_stream(blob.as_buffer()).read_all()
        for chunk in table.column("blob").chunks
        for blob in chunk
    ]
    return pa.concat_tables(found)


def chunks(column, size: int = CHUNK_BYTES):
    """(first row, bytes of the rows' texts end to end, where each begins and the last ends)."""
    base = 0
    for piece in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        if not len(piece):
            continue
        offsets = np.frombuffer(piece.buffers()[1], np.int32)[piece.offset : piece.offset + len(piece) + 1]
        offsets = offsets.astype(np.int64)
        buffer = piece.buffers()[2]
        data = np.frombuffer(buffer, np.uint8) if buffer is not None and buffer.size else np.zeros(0, np.uint8)
        lo = 0
        while lo < len(piece):
            hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, "right")) - 1)
            yield base + lo, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
            lo = hi
        base += len(piece)


# ---- hashes ----------------------------------------------------------------------------------

_MUL = 0x9E3779B97F4A7C15
_BASES = (0xD1342543DE82EF95, 0xA24BAED4963EE407, 0xF1357AEA2E62A9C5)
_TABLES: dict = {}


def mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64's finaliser: spreads a 64-bit value over all bits."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def byte_table() -> np.ndarray:
    if "bytes" not in _TABLES:
        _TABLES["bytes"] = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_MUL))
    return _TABLES["bytes"]


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64."""
    if base not in _TABLES or len(_TABLES[base][0]) < n:
        made = []
        for b in (base, pow(base, -1, 1 << 64)):
            x = np.full(max(n, 1 << 16), b, np.uint64)
            x[0] = 1
            made.append(np.multiply.accumulate(x))
        if n > 4 << 20:  # for one very long document
            return made[0], made[1]
        _TABLES[base] = tuple(made)
    return _TABLES[base]


def range_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, row: int = 0) -> np.ndarray:
    """A 64-bit hash of values[start:end] for every pair, from one running sum."""
    up, down = _powers(_BASES[row], len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts])


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of each word `[^\\x20\\x09-\\x0D]+`; each row's first word (and their number).

    The bytes tested are ASCII, so no character of several bytes is ever cut.
    """
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(bounds), np.int64)
    gap = _SPACE[data]
    before = np.empty(len(data) + 1, bool)
    before[1:] = gap
    before[0] = True
    edges = bounds[(bounds > 0) & (bounds < len(data))]
    fresh = before[:-1].copy()
    fresh[edges] = True
    starts = np.flatnonzero(~gap & fresh)
    after = np.empty(len(data), bool)
    after[:-1] = gap[1:]
    after[-1] = True
    after[edges - 1] = True
    ends = np.flatnonzero(~gap & after) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return range_hash(byte_table()[data], starts, ends)


# ---- arrays on their way ---------------------------------------------------------------------


def small(a: np.ndarray) -> np.ndarray:
    """The same values in the narrowest unsigned type."""
    most = int(a.max()) if len(a) else 0
    kind = np.uint8 if most < 1 << 8 else np.uint16 if most < 1 << 16 else np.uint32 if most < 1 << 32 else np.uint64
    return a.astype(kind)


def deltas(a: np.ndarray) -> np.ndarray:
    """A rising array as its first value and the steps."""
    out = a.copy()
    out[1:] -= a[:-1]
    return small(out)


def undelta(a: np.ndarray) -> np.ndarray:
    return np.cumsum(a, dtype=np.uint64)


def pack(*arrays: np.ndarray) -> bytes:
    """Unsigned arrays, byte plane by byte plane, compressed."""
    head = struct.pack(f"<B{len(arrays)}Q", len(arrays), *(len(a) << 4 | a.itemsize for a in arrays))
    body = b"".join(
        np.ascontiguousarray(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T).tobytes()
        for a in arrays
    )
    return head + zstandard.ZstdCompressor(level=1).compress(body)


def unpack(blob: bytes) -> list[np.ndarray]:
    n = blob[0]
    heads = struct.unpack_from(f"<{n}Q", blob, 1)
    body = zstandard.ZstdDecompressor().decompress(blob[1 + 8 * n :])
    out, at = [], 0
    for h in heads:
        count, width = h >> 4, h & 15
        planes = np.frombuffer(body, np.uint8, count * width, at).reshape(width, count)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(f"<u{width}"))
        at += count * width
    return out


def shard_of(h: np.ndarray, shards: int) -> np.ndarray:
    """Rising hash values fall into rising shards."""
    return ((h >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)


def cuts(ordered: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins, and the length."""
    if not len(ordered):
        return np.zeros(1, np.int64)
    return np.r_[0, np.flatnonzero(ordered[1:] != ordered[:-1]) + 1, len(ordered)]


def by_shard(ordered_shard: np.ndarray):
    at = cuts(ordered_shard)
    for lo, hi in zip(at[:-1], at[1:], strict=True):
        yield int(ordered_shard[lo]), slice(lo, hi)


def sent(part: int, payloads: dict[int, bytes]) -> pa.Table:
    return pa.table(
        {
            "shard": pa.array(list(payloads), pa.int32()),
            "part": pa.array([part] * len(payloads), pa.int32()),
            "payload": pa.array(list(payloads.values()), pa.binary()),
        }
    )


def answers(shard: int, payloads: dict[int, bytes]) -> pa.Table:
    return pa.table(
        {
            "shard": pa.array([shard] * len(payloads), pa.int32()),
            "part": pa.array(list(payloads), pa.int32()),
            "payload": pa.array(list(payloads.values()), pa.binary()),
        }
    )


def received(table: pa.Table, by: str) -> list[tuple[int, list[np.ndarray]]]:
    """The payloads of a group, in the order of `by` (the shard or the part)."""
    found = zip(table.column(by).to_pylist(), table.column("payload").to_pylist(), strict=True)
    return [(k, unpack(p)) for k, p in sorted(found, key=lambda x: x[0])]
