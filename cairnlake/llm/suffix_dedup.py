"""Operator 7. Byte strings of a given length that an earlier document has too, found with suffix arrays.

A corpus-wide suffix array would move many bytes for each byte of text, so the strings are first
brought together by content. Every string of LENGTH bytes has an *anchor*: the leftmost of its
SEED-byte pieces with the smallest hash. Equal strings have equal anchors at equal places, and the
strings of one anchor begin in a short run of places, so one *fragment* of at most
2 * LENGTH - SEED bytes holds them all.

Pass 1: parts send the anchors' fingerprints, sorted and delta-coded; shards answer which of them
several documents have. All others are settled: none of their strings occurs elsewhere.
Pass 2: fragments of the shared anchors go to shards by anchor, once for each part and content, with
the smallest document that has it. A shard builds suffix arrays of its distinct fragments, those of
an anchor in the same one, by induced sorting, and their permuted common prefixes; suffixes that
share LENGTH bytes are equal strings, and those of a larger document than the smallest in their
group are marked.
Pass 3: parts receive a bit for each string they sent, and cut the bytes which marked strings cover.

An anchor of more than HOT documents (a passage in a third of the corpus, with other text around it)
is split: each of its strings is a fragment of its own and goes to the shard of its content.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnlake.llm import packed as P
from cairnlake.llm.suffix_array import permuted_prefixes, suffix_array

LENGTH = 50
SEED = 24
#: Text for each shard, and the documents from which on an anchor is split.
SHARD_BYTES = 2 << 20
HOT = 4096
#: Text that is hashed at a time, so that its arrays stay in the processor's cache; fragments likewise.
CHUNK = 64 << 10
BLOCK = 8192
#: Bytes of different fragments in one suffix array.
SORTED_BYTES = 256 << 10
#: A fragment has at most 2 * (SEED + 31) - SEED bytes; so many words of 8 hold it.
WORDS = -(-(SEED + 62) // 8)
PAD = 8 * WORDS
#: Up to so many parts and shards are of the least size, further ones up to 4 and 8 times as large.
UNITS = 128
NO_KEY = np.iinfo(np.int64).max

KEPT = "n_bytes long, n_removed long, n_spans long, kept binary"


def drop_earlier_strings(
    docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, hot: int = HOT
) -> DataFrame:
    """One row (key, n_bytes, n_removed, n_spans, kept) for each row of `docs`; `key` is an integer.

    Texts are their UTF-8 bytes. A byte goes when a string of `length` bytes that covers it also
    begins in a row with a smaller key; strings are judged on the input and never cross rows.
    `n_spans` counts maximal runs of bytes cut, `kept` holds the others end to end (a character may
    be cut in two, hence binary). Null or empty text: no bytes. Rows with equal keys take nothing
    from each other; a null key counts as larger than all others. Columns other than key and text
    are not read. An empty table gives an empty table.
    """
    if not SEED < length <= SEED + 31:
        raise ValueError(f"length must be from {SEED + 1} to {SEED + 31}")
    size = P.text_bytes(docs, text)
    parts, shards = _units(P.part_count(size), 4), _units(math.ceil(size / SHARD_BYTES), 8)
    documents = P.packed_parts(docs.select(F.col(key).cast("long").alias(key), text), key, text, parts)
    by_part = documents.groupBy("part")

    def anchors(group, table):
        data, bounds = _text(P.unpacked(table).column("text"))
        f, row = [], []
        for lo, hi in _blocks(bounds):
            first, _, own = _runs(data[bounds[lo] : bounds[hi]], bounds[lo : hi + 1] - bounds[lo], length)
            f.append(own)
            row.append(np.searchsorted(bounds[lo : hi + 1], first + bounds[lo], "right") + (lo - 1))
        f = _one_a_row(_joined(f, np.uint64), _joined(row, np.int64), len(bounds) - 1)
        at = P.cuts(f)
        times, f = np.diff(at), f[at[:-1]] if len(f) else f
        out = {
            shard: P.pack(P.deltas(f[s]), P.small(times[s]))
            for shard, s in P.by_shard(P.shard_of(f << np.uint64(24), shards))
        }
        return P.sent(group[0].as_py(), out)

    def shared(group, table):
        held = [(p, P.undelta(a[0]), a[1].astype(np.int64)) for p, a in P.received(table, "part")]
        f = np.concatenate([x[1] for x in held])
        order = np.argsort(f, kind="stable")
        at = P.cuts(f[order])
        total = np.add.reduceat(np.concatenate([x[2] for x in held])[order], at[:-1])
        rows = np.empty(len(f), np.int64)
        rows[order] = np.repeat(total, np.diff(at))
        out, lo = {}, 0
        for part, own, _ in held:
            n = rows[lo : lo + len(own)]
            lo += len(own)
            if (n > 1).any():
                out[part] = P.pack(np.zeros(0, np.uint8), P.deltas(own[n > 1]), np.packbits(n[n > 1] > hot))
        return P.answers(group[0].as_py(), out)

    def fragments(group, left, right):
        if not left.num_rows:
            return P.sent(0, {})
        rows = P.unpacked(left)
        data, bounds = _text(rows.column("text"))
        found = _fragments(data, bounds, _keys(rows), *_known(right), length)
        route, least, sizes, at = found["route"], found["least"], found["size"], found["at"]
        out = {}
        for shard, s in P.by_shard(P.shard_of(route << np.uint64(24), shards)):
            own = _bytes(data, at[s], sizes[s])
            out[shard] = P.pack(sizes[s].astype(np.uint8), least[s].view(np.uint64), own, P.deltas(route[s]))
        return P.sent(group[0].as_py(), out)

    def match(group, table):
        held = P.received(table, "part")
        data = np.concatenate([*(a[2] for _, a in held), np.zeros(PAD, np.uint8)])
        masks = _matched(
            np.concatenate([a[0] for _, a in held]).astype(np.int64),
            np.concatenate([a[1] for _, a in held]).view(np.int64),
            data,
            np.concatenate([P.undelta(a[3]) for _, a in held]),
            length,
        )
        out, lo = {}, 0
        for part, a in held:
            out[part] = P.pack(np.ones(1, np.uint8), masks[lo : lo + len(a[0])])
            lo += len(a[0])
        return P.answers(group[0].as_py(), out)

    def remove(group, left, right):
        if not left.num_rows:
            return _SCHEMA.empty_table()
        rows = P.unpacked(left)
        masks = [a[1] for _, a in P.received(right, "shard") if len(a[0])]
        data, bounds = _text(rows.column("text"))
        found = _fragments(data, bounds, _keys(rows), *_known(right), length)
        mask = _joined(masks, np.uint32)[found["group"]]
        mask[found["doc"] > found["least"][found["group"]]] = 0xFFFFFFFF
        return _cut(rows.column("key"), data, bounds, found, mask, length)

    reply = by_part.applyInArrow(anchors, P.SENT).groupBy("shard").applyInArrow(shared, P.SENT)
    asked = by_part.cogroup(reply.groupBy("part")).applyInArrow(fragments, P.SENT)
    marks = asked.groupBy("shard").applyInArrow(match, P.SENT).unionByName(reply)
    kept = by_part.cogroup(marks.groupBy("part")).applyInArrow(remove, f"key long, {KEPT}")
    return kept.withColumnRenamed("key", key)


_SCHEMA = pa.schema(
    [("key", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())]
)


def _joined(arrays: list, kind) -> np.ndarray:
    return np.concatenate(arrays) if arrays else np.zeros(0, kind)


def _units(least: int, most: int) -> int:
    """How many parts or shards are made of `least` of the least size, each of at most `most` of these.

    Every part sends to every shard, so the messages grow with the square of their numbers: a larger
    table has larger ones as long as memory allows, and more of them from there on.
    """
    return max(1, min(least, max(UNITS, math.ceil(least / most))))


def _text(column) -> tuple[np.ndarray, np.ndarray]:
    """The rows' bytes end to end and PAD zeros; where each row begins and the last ends."""
    pieces, bounds, total = [], [np.zeros(1, np.int64)], 0
    for _, data, own in P.chunks(column, 1 << 60):
        pieces.append(data)
        bounds.append(total + own[1:])
        total += len(data)
    return np.concatenate([*pieces, np.zeros(PAD, np.uint8)]), np.concatenate(bounds)


def _keys(rows: pa.Table) -> np.ndarray:
    return rows.column("key").fill_null(NO_KEY).to_numpy().astype(np.int64)


def _blocks(bounds: np.ndarray):
    """Ranges of rows with CHUNK bytes at most, or one row."""
    lo = 0
    while lo < len(bounds) - 1:
        hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + CHUNK, "right")) - 1)
        yield lo, hi
        lo = hi


def _one_a_row(f: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """The fingerprints in order, each as often as rows have it."""
    if rows <= 1 << 24:
        both = np.sort(f << np.uint64(24) | row.astype(np.uint64))
        fresh = np.ones(len(both), bool)
        fresh[1:] = both[1:] != both[:-1]
        return both[fresh] >> np.uint64(24)
    order = np.lexsort((row, f))
    f, row = f[order], row[order]
    fresh = np.ones(len(f), bool)
    fresh[1:] = (f[1:] != f[:-1]) | (row[1:] != row[:-1])
    return f[fresh]


def _pieces(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """data[at:at+PAD] of each place, a row of bytes for each. PAD bytes follow the places."""
    every = np.ndarray(len(data) - PAD + 1, f"V{PAD}", data, strides=(1,))
    return every[at].view(np.uint8).reshape(-1, PAD)


def _bytes(data: np.ndarray, at: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """data[at:at+size] of all pairs, end to end."""
    return _pieces(data, at)[np.arange(PAD) < sizes[:, None]]


#: By a fragment's size: the bits of its words that are its own.
_OWN = np.where(np.arange(PAD) < np.arange(PAD + 1)[:, None], 255, 0).astype(np.uint8).view("<u8")
_HASHES = ((0xD1342543DE82EF95, 0xA24BAED4963EE407), (0x9E3779B97F4A7C15, 0xF1357AEA2E62A9C5))


def _content(data: np.ndarray, at: np.ndarray, sizes: np.ndarray, length: int) -> list[np.ndarray]:
    """Two 64-bit hashes of data[at:at+size] for every pair, over as many words as any fragment can have."""
    out = [np.empty(len(at), np.uint64) for _ in _HASHES]
    words = -(-(2 * length - SEED) // 8)
    for lo in range(0, len(at), BLOCK):
        size = sizes[lo : lo + BLOCK]
        piece = _pieces(data, at[lo : lo + BLOCK]).view("<u8")
        piece &= _OWN[size]
        piece = np.ascontiguousarray(piece[:, :words].T)
        for h, (first, by) in zip(out, _HASHES, strict=True):
            x = size.astype(np.uint64) * np.uint64(first)
            for word in piece:
                x ^= word
                x *= np.uint64(by)
                x ^= x >> np.uint64(32)
            h[lo : lo + BLOCK] = P.mix(x)
    return out


def _alike(route: np.ndarray, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order by rising route in which equal (route, h1, h2) are neighbours; which of it are new.

    It depends on the values alone: where 24 bits of h2 do not tell two contents of a route apart,
    all bits are sorted by.
    """
    order = np.argsort(route << np.uint64(24) | h2 >> np.uint64(40))
    for again in (False, True):
        if again:
            order = np.lexsort((h2, h1, route))
        a, b, c = route[order], h1[order], h2[order]
        same = (a[1:] == a[:-1]) & (c[1:] >> np.uint64(40) == c[:-1] >> np.uint64(40))
        equal = same & (b[1:] == b[:-1]) & (c[1:] == c[:-1])
        if (same == equal).all():
            break
    fresh = np.ones(len(order), bool)
    fresh[1:] = ~equal
    return order, fresh


def _known(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The anchors that several rows have, sorted, and whether they are split."""
    held = [a for _, a in P.received(table, "shard") if not len(a[0])]
    f = _joined([P.undelta(a[1]) for a in held], np.uint64)
    return f, _joined([np.unpackbits(a[2], count=len(a[1])).astype(bool) for a in held], bool)


def _places(known: np.ndarray):
    """A function that finds 40-bit values in the sorted `known`: (place, whether it is there) of each.

    It steps on from where values with the same upper bits begin, one step on average.
    """
    drop = np.uint64(40 - min(24, len(known).bit_length()))
    begin = np.searchsorted(known, np.arange(1 << (40 - int(drop)), dtype=np.uint64) << drop)
    ending = np.r_[known, np.iinfo(np.uint64).max]

    def places(f):
        at = begin[f >> drop]
        below = ending[at] < f
        while below.any():
            at += below
            below = ending[at] < f
        return at, ending[at] == f

    return places


def _runs(data: np.ndarray, bounds: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First place, number of places and anchor's fingerprint (40 bits) of each run of strings."""
    n = len(data)
    if n < length:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        # three words of 8 bytes, each spread by itself, make a piece
        word = np.ndarray(n - 7, "<u8", np.ascontiguousarray(data), strides=(1,)) * np.uint64(0xD1342543DE82EF95)
        spare = word >> np.uint64(32)
        word ^= spare
        m = n - SEED + 1
        h = word[:m].copy()
        for k, by in ((8, 0xA24BAED4963EE407), (16, 0xF1357AEA2E62A9C5)):
            np.multiply(word[k : k + m], np.uint64(by), out=spare[:m])
            h += spare[:m]
        np.right_shift(h, np.uint64(29), out=spare[:m])
        h ^= spare[:m]
        h *= np.uint64(0xBF58476D1CE4E5B9)
    least = h & np.uint64(0xFFFFFFFF00000000)
    least |= np.arange(m, dtype=np.uint64)
    span, width = length - SEED + 1, 1
    while width < span:  # by turns in two arrays
        step = min(width, span - width)
        least, spare = np.minimum(least[:-step], least[step:], out=spare[: len(least) - step]), least
        width += step
    anchor = least.astype(np.uint32)
    # a string that begins less than its length before a row's end is none
    ends = bounds[1:-1]
    none = (ends[:, None] - np.arange(1, length)).reshape(-1)
    anchor[none[(none >= 0) & (none < len(anchor))]] = 0xFFFFFFFF
    at = P.cuts(anchor)
    first, count = at[:-1], np.diff(at)
    own = anchor[first]
    some = own != 0xFFFFFFFF
    f = P.mix(h[own[some]] + np.uint64(0x632BE59BD9B4E019)) >> np.uint64(24)
    return first[some], count[some], f


def _fragments(
    data: np.ndarray, bounds: np.ndarray, keys: np.ndarray, known: np.ndarray, split: np.ndarray, length: int
) -> dict:
    """The fragments of a part's shared anchors.

    group, doc, start, count: of each fragment, by rising start; route (40 bits), least, size, at: of
    each group of equal ones, by rising route.
    """
    got: dict[str, list] = {k: [] for k in ("route", "h1", "h2", "doc", "start", "count")}
    place_of = _places(known)
    for lo, hi in _blocks(bounds) if len(known) else ():
        first, count, f = _runs(data[bounds[lo] : bounds[hi]], bounds[lo : hi + 1] - bounds[lo], length)
        at, hit = place_of(f)
        first, count, f, hot = first[hit] + bounds[lo], count[hit], f[hit], split[at[hit]]
        if hot.any():  # one fragment for each string
            times = np.where(hot, count, 1)
            place = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
            first, hot, f = np.repeat(first, times) + place, np.repeat(hot, times), np.repeat(f, times)
            count = np.where(hot, 1, np.repeat(count, times))
        h1, h2 = _content(data, first, count + length - 1, length)
        route = np.where(hot, h1 >> np.uint64(24), f)
        doc = keys[np.searchsorted(bounds[lo : hi + 1], first, "right") + (lo - 1)]
        for k, v in (("route", route), ("h1", h1), ("h2", h2), ("doc", doc), ("start", first), ("count", count)):
            got[k].append(v)
    out = {k: _joined(v, np.uint64 if k in ("route", "h1", "h2") else np.int64) for k, v in got.items()}
    order, fresh = _alike(out["route"], out.pop("h1"), out.pop("h2"))
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(fresh) - 1
    lead = order[fresh]
    least = np.minimum.reduceat(out["doc"][order], np.flatnonzero(fresh)) if len(order) else out["doc"]
    return {
        "group": group, "doc": out["doc"], "start": out["start"], "count": out["count"],
        "route": out["route"][lead], "least": least, "size": out["count"][lead] + length - 1, "at": out["start"][lead],
    }


def _matched(size: np.ndarray, doc: np.ndarray, data: np.ndarray, route: np.ndarray, length: int) -> np.ndarray:
    """For each fragment a bit for each of its strings: does a smaller document have it?

    Fragments that are equal in whole are one before they are sorted, and where an anchor has no other
    fragment left, its strings have nothing to be compared with. The others are sorted SORTED_BYTES
    at a time; those of an anchor stay together.
    """
    at = np.cumsum(size) - size
    order, fresh = _alike(route, *_content(data, at, size, length))
    lead = order[fresh]
    group = np.cumsum(fresh) - 1
    least = np.minimum.reduceat(doc[order], np.flatnonzero(fresh))
    begins = P.cuts(route[lead])
    contents = np.diff(begins)
    mask = np.zeros(len(lead), np.uint32)
    several = np.flatnonzero(np.repeat(contents > 1, contents))
    ends = np.cumsum(contents[contents > 1])  # of the anchors, in `several`
    sofar = np.cumsum(size[lead[several]])
    lo = 0
    while lo < len(several):
        full = np.searchsorted(sofar, (sofar[lo - 1] if lo else 0) + SORTED_BYTES)
        hi = int(ends[min(np.searchsorted(ends, full, "right"), len(ends) - 1)])
        own = several[lo:hi]
        mask[own] = _smaller_strings(size[lead[own]], at[lead[own]], least[own], data, length)
        lo = hi
    out = np.empty(len(size), np.uint32)
    out[order] = np.where(doc[order] > least[group], np.uint32(0xFFFFFFFF), mask[group])
    return out


def _smaller_strings(sizes, at, docs, data, length) -> np.ndarray:
    """For different fragments data[at:at+size]: which strings does one of a smaller document have?"""
    mask = np.zeros(len(sizes), np.uint32)
    begin = np.cumsum(sizes + 1) - sizes - 1
    rows = np.ones((len(sizes), PAD + 1), np.int32)
    rows[:, :PAD] = _pieces(data, at)
    rows[:, :PAD] += 2
    rows[np.arange(len(sizes)), sizes] = 1
    t = np.zeros(int(sizes.sum()) + len(sizes) + 1, np.int32)
    t[:-1] = rows[np.arange(PAD + 1) <= sizes[:, None]]
    del rows
    # symbols in use only, in their order: fewer buckets
    used = np.zeros(258, bool)
    used[t] = True
    t = (np.cumsum(used) - 1).astype(np.int32)[t]

    sa = suffix_array(t)
    shared = permuted_prefixes(t, sa, length)
    owner = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes + 1)
    offset = np.arange(len(t) - 1) - np.repeat(begin, sizes + 1)
    whole = np.zeros(len(t), bool)
    whole[:-1] = offset <= np.repeat(sizes - length, sizes + 1)
    ranks = np.flatnonzero(whole[sa])
    ranked = sa[ranks]
    # a string and the next one in order are equal if no suffix between them breaks the common prefix
    breaks = np.cumsum(shared[sa] < length)[ranks]
    first = P.cuts(breaks)
    own = docs[owner[ranked]]
    least = np.repeat(np.minimum.reduceat(own, first[:-1]), np.diff(first))
    hit = ranked[own > least]
    np.bitwise_or.at(mask, owner[hit], np.uint32(1) << offset[hit].astype(np.uint32))
    return mask


def _cut(keys, data: np.ndarray, bounds: np.ndarray, found: dict, mask: np.ndarray, length: int) -> pa.Table:
    n_removed, n_spans, kept = [], [], []
    start, count = found["start"], found["count"]
    for lo, hi in _blocks(bounds):
        base = bounds[lo]
        text, own = data[base : bounds[hi]], bounds[lo : hi + 1] - base
        s = slice(*np.searchsorted(start, (base, bounds[hi])))
        all_ = (np.uint64(1) << count[s].astype(np.uint64)) - np.uint64(1)
        bits = (mask[s] & all_).astype(np.uint32)
        whole = bits == all_
        some = ~whole & (bits > 0)
        # where marked strings begin, and where they end; no two runs share a place of either kind
        cover = np.zeros(len(text) + 1, np.int32)
        cover[start[s][whole] - base] += 1
        cover[start[s][whole] + count[s][whole] + length - 1 - base] -= 1
        single = np.unpackbits(bits[some].astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
        row, bit = np.nonzero(single)
        place = start[s][some][row] + bit - base
        cover[place] += 1
        cover[place + length] -= 1
        gone = np.cumsum(cover[:-1]) > 0
        begins = gone.copy()
        begins[1:] &= ~gone[:-1]
        edges = own[:-1][(own[:-1] < len(text)) & (np.diff(own) > 0)]
        begins[edges] = gone[edges]
        out = text[~gone]
        at = np.r_[0, np.cumsum(~gone)][own]
        n_removed.append(np.diff(own) - np.diff(at))
        n_spans.append(np.diff(np.r_[0, np.cumsum(begins)][own]))
        kept.append(
            pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(out)])
        )
    return pa.table(
        {
            "key": keys.cast(pa.int64()),
            "n_bytes": pa.array(np.diff(bounds)),
            "n_removed": pa.array(_joined(n_removed, np.int64)),
            "n_spans": pa.array(_joined(n_spans, np.int64)),
            "kept": pa.chunked_array(kept, pa.binary()),
        }
    ).combine_chunks()


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return drop_earlier_strings(docs).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2(F.col("kept"), 256).alias("kept_sha256")
    )
