"""Operator 6. Benchmark items inside documents, by size-partitioned MinHash and exact containment.

An item's shingles are few and a document's may be many, so their Jaccard similarity says little;
what counts is the item's share that the document holds. Under a random order of shingles, an item's
first shingle is in the document with just that probability. Items are partitioned by the size of
their shingle sets; each partition has its own number of MinHash functions (no more than its items'
size, so that small items are searched by all their shingles) and its own number of functions that
must hit, such that an item at the threshold is missed with a probability below MISS. Candidates are
verified by the exact share.

Items come in blocks of a bounded size, each broadcast and held against all documents in one pass
without a shuffle; a document is searched whole, whatever its length.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnlake.llm import packed as P

WORDS = 5
PERCENT = 75
FUNCTIONS = 32
MISS = 1e-6
#: Item text in a block.
BLOCK_BYTES = 16 << 20
_MARK_BITS = 20


def shingles(column, words: int):
    """(row, hash of a distinct shingle), by row; A-Z lower-cased, with fewer words all as one."""
    for lo, data, bounds in P.chunks(column):
        data = P.LOWER[data]
        starts, ends, first = P.words(data, bounds)
        w = P.word_hashes(data, starts, ends)
        many = np.diff(first)
        begin = np.flatnonzero(np.repeat(first[1:], many) - np.arange(len(w)) >= words)
        short = np.flatnonzero((many > 0) & (many < words))
        h = np.r_[P.range_hash(w, begin, begin + words, 1), P.range_hash(w, first[short], first[short + 1], 1)]
        row = np.r_[np.repeat(np.arange(len(many)), many)[begin], short]
        yield row + lo, h


def _distinct(row: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    return row[fresh], h[fresh]


def hits_needed(functions: int, share: float, miss: float) -> int:
    """The largest number of hits that a share of `share` falls short of with a probability below `miss`."""
    below = 0.0
    for k in range(functions + 1):
        below += math.comb(functions, k) * share**k * (1 - share) ** (functions - k)
        if below >= miss:
            return max(1, k)
    return functions


class Items:
    """The index of one block of items."""

    def __init__(self, texts: list[str], words: int, percent: int):
        found = [_distinct(r, h) for r, h in shingles(pa.chunked_array([pa.array(texts, pa.string())]), words)]
        row = np.concatenate([x[0] for x in found]) if found else np.zeros(0, np.int64)
        self.token = np.concatenate([x[1] for x in found]) if found else np.zeros(0, np.uint64)
        self.size = np.bincount(row, minlength=len(texts))
        self.first = np.r_[0, np.cumsum(self.size)]
        self.needed = np.zeros(len(texts), np.int64)
        self.wanted = -(-percent * self.size // 100)
        probe, owner = [], []
        for part in range(int(self.size.max(initial=0)).bit_length()):  # sizes from 2**part to below 2**(part+1)
            own = np.flatnonzero((self.size >> part) == 1)
            for item in own:
                token = self.token[self.first[item] : self.first[item + 1]]
                if len(token) <= FUNCTIONS:
                    chosen = token  # searched by all shingles: the count is exact
                    self.needed[item] = self.wanted[item]
                else:
                    seeds = P.mix(np.arange(1, FUNCTIONS + 1, dtype=np.uint64))
                    chosen = token[[int(np.argmin(P.mix(token ^ s))) for s in seeds]]
                    self.needed[item] = hits_needed(FUNCTIONS, percent / 100, MISS)
                probe.append(chosen)
                owner.append(np.full(len(chosen), item))
        probe = np.concatenate(probe) if probe else np.zeros(0, np.uint64)
        owner = np.concatenate(owner) if owner else np.zeros(0, np.int64)
        order = np.argsort(probe, kind="stable")
        at = P.cuts(probe[order])
        self.probe = probe[order][at[:-1]] if len(probe) else probe
        self.owner, self.owner_at = owner[order], at
        self.marks = np.zeros(1 << _MARK_BITS, bool)
        self.marks[(self.probe & np.uint64((1 << _MARK_BITS) - 1)).astype(np.int64)] = True

    def matches(self, row: np.ndarray, h: np.ndarray):
        """(row, item, shared shingles) of rows that hold enough of an item."""
        if not len(self.probe):
            return
        near = np.flatnonzero(self.marks[(h & np.uint64((1 << _MARK_BITS) - 1)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.probe, h[near]), len(self.probe) - 1)
        hit = self.probe[at] == h[near]
        if not hit.any():
            return
        r, at = np.unique(np.stack([row[near[hit]], at[hit]]), axis=1)  # a shingle of a row counts once
        many = np.diff(self.owner_at)[at]
        place = np.repeat(self.owner_at[at] - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
        pair, hits = np.unique(np.stack([np.repeat(r, many), self.owner[place]]), axis=1, return_counts=True)
        enough = hits >= self.needed[pair[1]]
        if not enough.any():
            return
        wanted = pair[:, enough]
        keep = np.isin(row, wanted[0])
        row, h = _distinct(row[keep], h[keep])
        for r, item in wanted.T.tolist():
            own = h[np.searchsorted(row, r) : np.searchsorted(row, r + 1)]
            token = self.token[self.first[item] : self.first[item + 1]]
            shared = int((own[np.minimum(np.searchsorted(own, token), len(own) - 1)] == token).sum())
            if shared >= self.wanted[item]:
                yield r, item, shared


def contained_items(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    words: int = WORDS,
    percent: int = PERCENT,
) -> DataFrame:
    """(key, item_key, n_item, n_shared): rows of `docs` that hold at least `percent` of an item's shingles.

    Shingles are distinct runs of `words` words, A-Z lower-cased; a text of fewer words is one shingle
    of them all, so an item that short is found only in a document of the same words. Null, empty or
    blank items and documents match nothing. Rows that repeat in either table give a row each. A null
    key is carried along. Other columns are not read. If either table is empty, so is the result.
    """
    spark = docs.sparkSession
    out = f"{key} {docs.schema[key].dataType.simpleString()}, {item_key} {items.schema[item_key].dataType.simpleString()}, n_item long, n_shared long"
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).where(F.col("text").isNotNull())
    wanted = items.select(F.col(item_key).alias("key"), F.col(item_text).alias("text"))
    wanted = wanted.where(F.col("text").isNotNull())
    blocks = max(1, math.ceil((wanted.agg(F.sum(F.octet_length("text"))).first()[0] or 0) / BLOCK_BYTES))

    def search(block: int) -> DataFrame:
        part = wanted.where(F.pmod(F.xxhash64("key", "text"), F.lit(blocks)) == block).toArrow()
        index = spark.sparkContext.broadcast((part.column("key").combine_chunks(), Items(part.column("text").to_pylist(), words, percent)))

        def matched(batches):
            keys, held = index.value
            for batch in batches:
                found = [m for row, h in shingles(batch.column("text"), words) for m in held.matches(row, h)]
                if found:
                    r, item, shared = (np.array(x) for x in zip(*found, strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("key").take(pa.array(r)), _flat(keys).take(pa.array(item)),
                            pa.array(held.size[item]), pa.array(shared),
                        ],
                        [key, item_key, "n_item", "n_shared"],
                    )

        return rows.mapInArrow(matched, out)

    result = search(0)
    for block in range(1, blocks):
        result = result.unionByName(search(block))
    return result


def _flat(keys):
    return keys if isinstance(keys, pa.Array) else pa.concat_arrays(keys.chunks)


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return contained_items(docs, items)


OP6_SQL = r"""
WITH texts AS (
  SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark
), worded AS (
  SELECT kind, id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS w
  FROM texts
), shingled AS (
  SELECT kind, id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN []
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)] END)) AS s
  FROM worded
), items AS (
  SELECT id, s, count(*) OVER (PARTITION BY id) AS n FROM shingled WHERE kind = 'b'
)
SELECT d.id AS doc_id, i.id AS item_id, any_value(i.n) AS n_item, count(*) AS n_shared
FROM shingled d JOIN items i ON d.s = i.s WHERE d.kind = 'd'
GROUP BY d.id, i.id HAVING 100 * count(*) >= 75 * any_value(i.n)
"""
