"""Operator 1. Repeated windows of words, found through a merged count-min sketch and removed.

Pass 1: every part counts its windows in a sketch of its own: ROWS rows of cells, one cell a row for
each window, saturating at 2 (all that "repeated" asks). Sketches are sharded by the window's hash
and go out sparse: the sorted cells that are not zero. Shards add them up, and answer each part with
one bit for each cell it sent: does the merged counter reach 2? A merged counter is never below the
true count, so a window with a zero bit in some row is surely unique.

Pass 2: the windows whose smallest counter reaches 2 (the repeated ones and a few percent of the
others) go to the shard of their hash, once for each part and fingerprint, and are grouped exactly
by a 96-bit fingerprint. Nothing repeated is lost, nothing merely estimated is removed.

Pass 3: parts learn which of their windows are repeated and drop the words these cover.

The number of cells follows the corpus' bytes, so the share of false candidates stays the same at
every size. A window found in a third of all documents is one value in each part.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnlake.llm import packed as P

WINDOW = 35
#: Rows of the sketch, cells in each row for each byte of text, and cells of a row in one shard.
ROWS = 2
CELLS_PER_BYTE = 0.6
SHARD_CELLS = 8 << 20

KEPT = "n_words long, n_removed long, kept string"


def drop_repeated_windows(
    docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW
) -> DataFrame:
    """One row (key, n_words, n_removed, kept) for each row of `docs`.

    Words are `[^\\x20\\x09-\\x0D]+`. A word goes when some window of `window` words that covers it
    also begins anywhere else, in its own document too; windows are judged on the input. `kept` holds
    the other words, joined by one space. Null or empty text: no words, kept ''. Texts shorter than a
    window lose nothing. Rows that repeat, with equal keys or null keys, count as documents of their
    own. Columns other than key and text are not read. An empty table gives an empty table.
    """
    size = P.text_bytes(docs, text)
    parts = P.part_count(size)
    cells = max(1024, math.ceil(size * CELLS_PER_BYTE))
    shards = math.ceil(cells / SHARD_CELLS)
    width = math.ceil(cells / shards)

    documents = P.packed_parts(docs, key, text, parts)
    by_part = documents.groupBy("part")

    def sketch(group, table):
        h = _windows(P.unpacked(table).column("text"), window)[0]
        rows = []
        for r in range(ROWS):
            cell = np.sort(_cells(h, r, shards, width))
            at = P.cuts(cell)
            unique = cell[at[:-1]] if len(cell) else cell
            rows.append((unique, np.diff(at) > 1 if len(cell) else np.zeros(0, bool)))
        out: dict[int, list] = {}
        for r, (cell, many) in enumerate(rows):
            for shard, s in P.by_shard(cell // np.uint64(width)):
                own = cell[s] - np.uint64(shard * width)
                out.setdefault(shard, [np.zeros(0, np.uint8)] * 2 * ROWS)
                out[shard][2 * r : 2 * r + 2] = [P.deltas(own), np.packbits(many[s])]
        return P.sent(group[0].as_py(), {k: P.pack(*v) for k, v in out.items()})

    def merge(group, table):
        held = P.received(table, "part")
        bits: dict[int, list] = {part: [] for part, _ in held}
        for r in range(ROWS):
            counter = np.zeros(width, np.uint8)
            own = []
            for part, arrays in held:
                cell = P.undelta(arrays[2 * r]).astype(np.int64)
                many = np.unpackbits(arrays[2 * r + 1], count=len(cell))
                counter[cell] = np.minimum(counter[cell] + 1 + many, 2)
                own.append((part, cell))
            for part, cell in own:
                bits[part].append(np.array([len(cell)], np.uint64))
                bits[part].append(np.packbits(counter[cell] >= 2))
        return P.answers(group[0].as_py(), {k: P.pack(*v) for k, v in bits.items()})

    def candidates(group, left, right):
        if not left.num_rows:
            return P.sent(0, {})
        h, second, _ = _windows(P.unpacked(left).column("text"), window, True)
        replies = P.received(right, "shard")
        maybe = np.ones(len(h), bool)
        for r in range(ROWS):
            bits = [np.unpackbits(a[2 * r + 1], count=int(a[2 * r][0])) for _, a in replies]
            bits = np.concatenate(bits).astype(bool) if bits else np.zeros(0, bool)
            cell = _cells(h, r, shards, width)
            order = np.argsort(cell)
            flags = np.empty(len(h), bool)
            flags[order] = np.repeat(bits, np.diff(P.cuts(cell[order]))) if len(h) else False
            maybe &= flags
        h, second = h[maybe], second[maybe]
        order = np.argsort(h)
        h, second = h[order], second[order]
        first = np.ones(len(h), bool)
        first[1:] = (h[1:] != h[:-1]) | (second[1:] != second[:-1])
        at = np.flatnonzero(first)
        many = np.diff(np.r_[at, len(h)]) > 1
        h, second = h[at], second[at]
        out = {
            shard: P.pack(P.deltas(h[s]), second[s], np.packbits(many[s]))
            for shard, s in P.by_shard(P.shard_of(h, shards))
        }
        return P.sent(group[0].as_py(), out)

    def count(group, table):
        held = [(p, P.undelta(a[0]), a[1], np.unpackbits(a[2], count=len(a[0]))) for p, a in P.received(table, "part")]
        h = np.concatenate([x[1] for x in held])
        second = np.concatenate([x[2] for x in held])
        times = np.concatenate([x[3] for x in held]).astype(np.int64) + 1
        order = np.lexsort((second, h))
        oh, os = h[order], second[order]
        first = np.ones(len(h), bool)
        first[1:] = (oh[1:] != oh[:-1]) | (os[1:] != os[:-1])
        at = np.flatnonzero(first)
        repeated = np.empty(len(h), bool)
        repeated[order] = np.repeat(np.add.reduceat(times[order], at) > 1, np.diff(np.r_[at, len(h)]))
        out, lo = {}, 0
        for part, own, _, _ in held:
            found = own[repeated[lo : lo + len(own)]]
            lo += len(own)
            if len(found):
                out[part] = P.pack(P.deltas(found))
        return P.answers(group[0].as_py(), out)

    def remove(group, left, right):
        if not left.num_rows:
            return out_schema.empty_table()
        known = [P.undelta(a[0]) for _, a in P.received(right, "shard")]
        rows = P.unpacked(left)
        return _removed(rows, np.concatenate(known) if known else np.zeros(0, np.uint64), window)

    kind = docs.schema[key].dataType.simpleString()
    out_schema = _arrow_schema(docs.select(F.col(key).alias("key")))
    seen = by_part.applyInArrow(sketch, P.SENT).groupBy("shard").applyInArrow(merge, P.SENT)
    maybe = by_part.cogroup(seen.groupBy("part")).applyInArrow(candidates, P.SENT)
    known = maybe.groupBy("shard").applyInArrow(count, P.SENT)
    kept = by_part.cogroup(known.groupBy("part")).applyInArrow(remove, f"key {kind}, {KEPT}")
    return kept.withColumnRenamed("key", key)


def _arrow_schema(keys: DataFrame) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    extra = [("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())]
    return pa.schema([*to_arrow_schema(keys.schema), *(pa.field(*x) for x in extra)])


def _cells(h: np.ndarray, row: int, shards: int, width: int) -> np.ndarray:
    cell = P.mix(h + np.uint64(0x632BE59BD9B4E019 * (row + 1) % 2**64))
    return P.shard_of(h, shards) * np.uint64(width) + (((cell >> np.uint64(32)) * np.uint64(width)) >> np.uint64(32))


def _chunk_windows(data, bounds, window, second=False):
    starts, ends, first = P.words(data, bounds)
    w = P.word_hashes(data, starts, ends)
    per_row = np.diff(first)
    left = np.repeat(first[1:], per_row) - np.arange(len(w))
    begin = np.flatnonzero(left >= window)
    h = P.range_hash(w, begin, begin + window, 1)
    other = (P.range_hash(P.mix(w), begin, begin + window, 2) >> np.uint64(32)).astype(np.uint32) if second else None
    return h, other, (starts, ends, first, begin)


def _windows(column, window, second=False):
    found = [_chunk_windows(data, bounds, window, second)[:2] for _, data, bounds in P.chunks(column)]
    h = np.concatenate([x[0] for x in found]) if found else np.zeros(0, np.uint64)
    other = np.concatenate([x[1] for x in found]) if second and found else np.zeros(0, np.uint32)
    return h, other, None


def _removed(rows: pa.Table, known: np.ndarray, window: int) -> pa.Table:
    """`known` is sorted, as shards are ranges of hash values."""
    n_words, n_removed, kept = [], [], []
    for _, data, bounds in P.chunks(rows.column("text")):
        h, _, (starts, ends, first, begin) = _chunk_windows(data, bounds, window)
        hit = begin[known[np.minimum(np.searchsorted(known, h), len(known) - 1)] == h] if len(known) else begin[:0]
        cover = np.zeros(len(starts) + 1, np.int32)
        np.add.at(cover, hit, 1)
        np.add.at(cover, hit + window, -1)
        stays = np.cumsum(cover[:-1]) == 0
        # a word that is not the last one kept of its row takes the byte behind it along, as a space
        before = np.r_[0, np.cumsum(stays)]
        total = before[first]
        row = np.repeat(np.arange(len(bounds) - 1), np.diff(first))
        gap = stays & (before[1:] < total[1:][row])
        mask = np.zeros(len(data) + 1, np.int8)
        mask[starts[stays]] += 1
        mask[ends[stays]] -= 1
        mask = np.cumsum(mask[:-1], dtype=np.int8).astype(bool)
        out = data.copy()
        out[ends[gap]] = 0x20
        mask[ends[gap]] = True
        at = np.r_[0, np.cumsum(mask)][bounds]
        n_words.append(np.diff(first))
        n_removed.append(np.diff(first) - np.diff(total))
        kept.append(
            pa.StringArray.from_buffers(len(at) - 1, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(out[mask]))
        )
    return pa.table(
        {
            "key": rows.column("key"),
            "n_words": pa.array(np.concatenate(n_words)),
            "n_removed": pa.array(np.concatenate(n_removed)),
            "kept": pa.chunked_array(kept, pa.string()),
        }
    )


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return drop_repeated_windows(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept"), 256).alias("kept_sha256")
    )
