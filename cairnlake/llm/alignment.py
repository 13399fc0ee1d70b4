"""Operator 12. Two tokenizers' tokens of the same texts, aligned at the byte offsets where both end.

A byte-level vocabulary (A) and a piece vocabulary (B) encode a space and the text. Where a token of
either ends, the text can be cut for both; between cuts lie the groups. They are found by dividing: the
middle one of an interval's A ends is looked up among the B ends by bisection, then its neighbours in
stretches that double, until the common end nearest to the middle is found. The interval is cut there
and both halves are divided alike; an interval without a common end inside is a group. Both vocabularies
begin a token at every word (see CUT), so an interval to begin with is a word, divided once for all its
places in a task's texts. All intervals of a block's new words take a step at a time, as arrays.

All A ids and B ids of a group are linked. How many documents link a pair is counted over the corpus:
texts are worked on in *parts* of a few MB, a part tells each of its pairs once with its number of
documents, and gets back the pair's count and whether it is the highest of its A id. So the shuffle
carries distinct pairs of parts, no pair has more than one row a part, and the links themselves stay in
the part's row, which is written once and read again for the answer.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cairnlake.llm import packed as P
from cairnlake.llm.shared import written
from cairnlake.llm.token_counts import byte_characters

#: Characters of text in a part, and in a block of texts that is worked on at once.
PART = 3 << 20
BLOCK = 1 << 20
#: Words remembered by a task, words given to the library at once, and links made at once.
REMEMBERED = 400_000
LUMP = 2000
LINKS = 2 << 20

#: A space between two characters that are none: both vocabularies begin a token there.
CUT = re.compile(r" (?=\S)(?<=\S )")
FAR = np.iinfo(np.int64).max

_PART = "part long, pairs array<bigint>, documents array<int>, keys array<{0}>, groups array<string>, blob binary"
_FOUND = "key {0}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"


class Vocabularies:
    """Both vocabularies, and the tokens of every word met so far."""

    def __init__(self, a: str, b: bytes):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        spec = json.loads(a)
        plain = spec["model"]["type"] == "BPE" and (spec["pre_tokenizer"] or {}).get("type") == "ByteLevel"
        if not plain or spec["pre_tokenizer"]["add_prefix_space"] or spec.get("normalizer"):
            raise ValueError("A is no plain byte-level vocabulary")
        self.a = Tokenizer.from_str(a)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b)
        self.a_bytes, self.b_bytes = byte_level(self.a), pieces(self.b)
        self.a_size, self.b_size = len(self.a_bytes), len(self.b_bytes)
        self.a_long = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_long = np.array([len(x) for x in self.b_bytes], np.int64)
        texts = [str(i).encode() for i in range(max(self.a_size, self.b_size))]
        #: each id as text, with the sign after it: within a group, then at its end
        self.shown = [t + s for s in (b",", b"|") for t in texts[: self.a_size]]
        self.shown += [t + s for s in (b",", b";") for t in texts[: self.b_size]]
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.wrong: set[int] = set()
        #: of each vocabulary: all words' ids end to end, and how many each word has
        self.ids = [np.zeros(0, np.int32)] * 2
        self.many = [np.zeros(0, np.int64)] * 2
        #: all words' groups end to end: how many A ids and B ids each has; and how many groups a word has
        self.sizes = [np.zeros(0, np.int32)] * 2
        self.groups = np.zeros(0, np.int64)

    def numbers(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))

    def learn(self, words: set[str]) -> None:
        """Encode and divide those of the words that have not been met before."""
        fresh = [w for w in words if w not in self.known]
        # A takes words that begin and end with no white space in one text, cut again by their bytes
        apart = [w for w in fresh if w[0].isspace() or w[-1].isspace()]
        lonely = set(apart)
        joined = [w for w in fresh if w not in lonely] if apart else fresh
        words = joined + apart
        data = [f" {w}".encode() for w in words]
        length = np.fromiter(map(len, data), np.int64, len(data))
        cuts = [*range(0, len(joined), LUMP), *range(len(joined), len(words) + 1)]
        spans = list(zip(cuts[:-1], cuts[1:], strict=True))
        texts = [" " + " ".join(words[lo:hi]) for lo, hi in spans]
        a_ids, a_many = [], []
        for (lo, hi), found in zip(spans, self.a.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            ids = np.array(found.ids, np.int32)
            ends, bounds = np.cumsum(self.a_long[ids]), np.cumsum(length[lo:hi])
            at = np.searchsorted(ends, bounds)
            if at[-1] != len(ids) - 1 or (ends[at] != bounds).any():
                raise ValueError("A does not begin a token at every word")
            a_ids.append(ids)
            a_many.append(np.diff(at, prepend=-1))
        found = self.b.encode(words, num_threads=1)
        many = [np.concatenate([np.zeros(0, np.int64), *a_many]), np.fromiter(map(len, found), np.int64, len(found))]
        ids = [np.concatenate([np.zeros(0, np.int32), *a_ids]), np.fromiter(chain.from_iterable(found), np.int32, many[1].sum())]
        wrong = self._differing(data, length, found, ids[1], many[1])
        begin = len(self.known)
        self.known.update(zip(words, range(begin, begin + len(words)), strict=True))
        self.wrong.update((begin + wrong).tolist())
        sizes, groups = self._divided(ids, many, wrong)
        self.ids, self.many, self.sizes = (
            [np.concatenate(x) for x in zip(old, new, strict=True)]
            for old, new in ((self.ids, ids), (self.many, many), (self.sizes, sizes))
        )
        self.groups = np.concatenate([self.groups, groups])

    def _differing(self, data: list[bytes], length: np.ndarray, found: list, ids: np.ndarray, many: np.ndarray) -> np.ndarray:
        """The places of the words whose bytes B does not keep; all words are compared at once as long as none differs."""
        total = np.r_[0, np.cumsum(self.b_long[ids])]
        ends = np.cumsum(many)
        same = (total[ends] - total[ends - many] == length).all()
        if same and b"".join(map(self.b_bytes.__getitem__, ids.tolist())) == b"".join(data):
            return np.zeros(0, np.int64)
        differ = (b"".join(map(self.b_bytes.__getitem__, x)) != w for w, x in zip(data, found, strict=True))
        return np.flatnonzero(np.fromiter(differ, bool, len(data)))

    def _divided(self, ids: list, many: list, wrong: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """The groups of words, whose tokens begin and end together: A ids and B ids in each, and groups a word.

        A word that B does not keep has none.
        """
        right = np.ones(len(many[0]), bool)
        right[wrong] = False
        a, b = (x[np.repeat(right, n)] for x, n in zip(ids, many, strict=True))
        a_first, b_first = (np.r_[0, np.cumsum(n[right])] for n in many)
        a_cuts, b_cuts = common_ends(np.cumsum(self.a_long[a]), np.cumsum(self.b_long[b]), a_first, b_first)
        groups = np.zeros(len(right), np.int64)
        groups[right] = np.diff(np.searchsorted(a_cuts, a_first, "right"))
        return [np.diff(x, prepend=0).astype(np.int32) for x in (a_cuts, b_cuts)], groups

    def tokens(self, words: np.ndarray, side: int) -> tuple[np.ndarray, np.ndarray]:
        """The words' ids end to end, and how many each has."""
        at, n = _gathered(self.many[side], words)
        return self.ids[side][at], n

    def cuts(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many A tokens, and B tokens, there are up to the end of each group of the words end to end."""
        at, _ = _gathered(self.groups, words)
        return tuple(np.cumsum(x[at], dtype=np.int64) for x in self.sizes)


def _gathered(many: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of the words' values, of which each has so `many`, end to end; and how many each has."""
    first, n = (np.cumsum(many) - many)[words], many[words]
    return np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum()), n


def byte_level(library) -> list[bytes]:
    """The bytes of each id of a byte-level vocabulary; those of an added string are its own."""
    byte = {c: i for i, c in enumerate(byte_characters())}
    out = [b""] * library.get_vocab_size(with_added_tokens=True)
    for entry, i in library.get_vocab(with_added_tokens=True).items():
        out[i] = bytes(byte[c] for c in entry) if all(c in byte for c in entry) else entry.encode()
    return out


def pieces(library) -> list[bytes]:
    """The bytes of each id of a piece vocabulary; ValueError where a piece goes on past a space."""
    out = []
    for i in range(library.get_piece_size()):
        piece = library.id_to_piece(i)
        if re.search("[^\u2581]\u2581", piece):
            raise ValueError("B has pieces that go on past a space")
        out.append(bytes([int(piece[1:-1], 16)]) if library.is_byte(i) else piece.replace("\u2581", " ").encode())
    probe = "  two  spaces\tand\n\nmore "
    if b"".join(out[i] for i in library.encode(probe)) != b" " + probe.encode():
        raise ValueError("B does not keep its texts as they are")
    return out


def common_ends(a: np.ndarray, b: np.ndarray, a_first: np.ndarray, b_first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many A tokens, and B tokens, there are up to the end of each group.

    a, b: rising ends of the tokens of texts laid end to end; a_first, b_first: the first token of each
    text, and their number. Both last tokens of a text end together.
    """
    lo, hi, b_lo, b_hi = a_first[:-1], a_first[1:], b_first[:-1], b_first[1:]
    span = np.zeros(len(lo), np.int64)
    live = hi > lo
    lo, hi, b_lo, b_hi, span = (x[live] for x in (lo, hi, b_lo, b_hi, span))
    a_cuts, b_cuts = [], []
    while len(lo):
        # A tokens lo .. hi - 2 end inside; look span neighbours far on both sides of the middle one
        middle = (lo + hi - 2) >> 1
        left, right = np.maximum(lo, middle - span), np.minimum(hi - 2, middle + span)
        many = np.where((hi - lo == 1) | (b_hi - b_lo == 1), 0, right - left + 1)
        owner = np.repeat(np.arange(len(lo)), many)
        probe = np.repeat(left - (np.cumsum(many) - many), many) + np.arange(len(owner))
        at = np.searchsorted(b, a[probe])
        away = np.where(b[at] == a[probe], np.abs(probe - middle[owner]) * 2 + (probe > middle[owner]), FAR)
        nearest = np.full(len(lo), FAR)
        asked = np.flatnonzero(many)
        if len(asked):
            nearest[asked] = np.minimum.reduceat(away, (np.cumsum(many) - many)[asked])
        found = nearest < FAR
        whole = ~found & ((many == 0) | ((left == lo) & (right == hi - 2)))
        a_cuts.append(hi[whole])
        b_cuts.append(b_hi[whole])
        wider = ~found & ~whole
        off = np.where(nearest[found] & 1, nearest[found] >> 1, -(nearest[found] >> 1))
        cut = middle[found] + off + 1
        b_cut = np.searchsorted(b, a[cut - 1]) + 1
        nil = np.zeros(len(cut), np.int64)
        lo, hi, b_lo, b_hi, span = (
            np.concatenate(x)
            for x in (
                (lo[wider], lo[found], cut),
                (hi[wider], cut, hi[found]),
                (b_lo[wider], b_lo[found], b_cut),
                (b_hi[wider], b_cut, b_hi[found]),
                (2 * span[wider] + 1, nil, nil),
            )
        )
    if not a_cuts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.sort(np.concatenate(a_cuts)), np.sort(np.concatenate(b_cuts))


def _distinct(group: np.ndarray, ids: np.ndarray, size: int):
    """(group, id, how often) of the different ids of each group, in order."""
    key = np.sort(group * size + ids)
    at = P.cuts(key)
    key = key[at[:-1]] if len(key) else key
    return key // size, key % size, np.diff(at)


def _summed(key: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(key, kind="stable")
    key = key[order]
    at = P.cuts(key)
    return (key[at[:-1]], np.add.reduceat(times[order], at[:-1])) if len(key) else (key, times)


def links(a_ids, b_ids, a_cuts, b_cuts, owner, a_size: int, b_size: int):
    """Each text's different id pairs with a common group: (text * a_size * b_size + a * b_size + b), and how often.

    owner: the text of each group. Ids that a group holds several times are multiplied, not paired one by one.
    """
    groups = np.arange(len(a_cuts))
    ga, a, na = _distinct(np.repeat(groups, np.diff(a_cuts, prepend=0)), a_ids, a_size)
    gb, b, nb = _distinct(np.repeat(groups, np.diff(b_cuts, prepend=0)), b_ids, b_size)
    first = np.searchsorted(gb, np.arange(len(groups) + 1))
    per = np.diff(first)[ga]
    total = np.cumsum(per)
    keys, times, lo = [], [], 0
    while lo < len(ga):
        hi = max(lo + 1, int(np.searchsorted(total, total[lo] - per[lo] + LINKS, "right")))
        n = per[lo:hi]
        x = np.repeat(np.arange(lo, hi), n)
        y = np.repeat(first[ga[lo:hi]] - (np.cumsum(n) - n), n) + np.arange(len(x))
        key, often = _summed((owner[ga[x]] * a_size + a[x]) * b_size + b[y], na[x] * nb[y])
        keys.append(key)
        times.append(often)
        lo = hi
    if len(keys) == 1:
        return keys[0], times[0]
    return _summed(np.concatenate(keys), np.concatenate(times)) if keys else (np.zeros(0, np.int64), np.zeros(0, np.int64))


class _Part:
    """Texts taken up block by block, then told as one row."""

    def __init__(self, vocabularies: Vocabularies, digest: bool):
        self.v, self.digest = vocabularies, digest
        self.keys, self.size = [], 0
        self.held, self.held_size = [], 0  # (text, words) of stretches yet to be worked on
        self.counts = [], [], [], []  # of each text: A tokens, B tokens, groups, links
        self.shown = []  # of each text: its groups, or their hash so far
        self.pairs, self.times = [], []
        self.wrong: set[int] = set()
        self.begun: set[int] = set()

    def add(self, key, text: str | None) -> None:
        number = len(self.keys)
        self.keys.append(key)
        self.shown.append(hashlib.sha256() if self.digest else [])
        for c in self.counts:
            c.append(0)
        for stretch in _stretches(text) if text else ():
            self.held.append((number, CUT.split(stretch)))
            self.held_size += len(stretch)
            if self.held_size >= BLOCK:
                self.settle()
        self.size += 64 + len(text or "")

    def settle(self) -> None:
        """Put together the groups of the stretches at hand; words not met before are divided first."""
        held, v = self.held, self.v
        self.held, self.held_size = [], 0
        if len(v.known) > REMEMBERED:
            v.clear()
        v.learn({w for _, words in held for w in words})
        held = [(number, v.numbers(words)) for number, words in held]
        if v.wrong:
            self.wrong |= {number for number, words in held if not v.wrong.isdisjoint(words.tolist())}
        held = [(number, words) for number, words in held if number not in self.wrong]
        if not held:
            return
        number = np.array([number for number, _ in held])
        last = np.cumsum([len(words) for _, words in held])
        words = np.concatenate([words for _, words in held])
        (a, n), (b, m) = v.tokens(words, 0), v.tokens(words, 1)
        a_first, b_first = np.r_[0, np.cumsum(n)[last - 1]], np.r_[0, np.cumsum(m)[last - 1]]
        a_cuts, b_cuts = v.cuts(words)
        at = np.searchsorted(a_cuts, a_first, "right")  # the first group of each stretch
        na, nb = np.diff(a_cuts, prepend=0), np.diff(b_cuts, prepend=0)
        made = np.r_[0, np.cumsum(na * nb)]
        for c, x in zip(self.counts, (a_first, b_first, at, made[at]), strict=True):
            for i, more in zip(number.tolist(), np.diff(x).tolist(), strict=True):
                c[i] += more
        self._show(number, a_first + b_first, _signed(a, b, a_cuts, b_cuts, v.a_size, v.b_size))
        key, times = links(a, b, a_cuts, b_cuts, np.repeat(number, np.diff(at)), v.a_size, v.b_size)
        self.pairs.append(key)
        self.times.append(times)

    def _show(self, number: np.ndarray, first: np.ndarray, codes: np.ndarray) -> None:
        for i, lo, hi in zip(number.tolist(), first[:-1].tolist(), first[1:].tolist(), strict=True):
            shown = b"".join(map(self.v.shown.__getitem__, codes[lo:hi].tolist()))
            # the last sign goes: whether it stands between groups is known when the next stretch comes
            if self.digest:
                if i in self.begun:
                    self.shown[i].update(b";")
                self.shown[i].update(shown[:-1])
            else:
                self.shown[i].append(shown[:-1].decode())
            self.begun.add(i)

    def row(self, number: int, kind: pa.DataType) -> pa.RecordBatch:
        self.settle()
        base = self.v.a_size * self.v.b_size
        key = np.concatenate(self.pairs) if self.pairs else np.zeros(0, np.int64)
        times = np.concatenate(self.times) if self.times else np.zeros(0, np.int64)
        if len(self.pairs) > 1:  # a text can lie in several blocks
            key, times = _summed(key, times)
        if self.wrong:
            right = ~np.isin(key // base, np.array(sorted(self.wrong)))
            key, times = key[right], times[right]
            for i in self.wrong:
                for c in self.counts:
                    c[i] = 0
        pairs, at, documents = np.unique(key % base, return_inverse=True, return_counts=True)
        per = np.bincount(key // base, minlength=len(self.keys))
        blob = P.pack(*map(P.small, (at, times, per, *map(np.array, self.counts))))
        none = [n == 0 for n in self.counts[0]]
        shown = [x.hexdigest() if self.digest else ";".join(x) for x in self.shown]
        shown = ["" if empty else x for empty, x in zip(none, shown, strict=True)]
        columns = [
            pa.array([number], pa.int64()),
            pa.array([pairs], pa.list_(pa.int64())),
            pa.array([documents.astype(np.int32)], pa.list_(pa.int32())),
            pa.array([self.keys], pa.list_(kind)),
            pa.array([shown], pa.list_(pa.string())),
            pa.array([blob], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["part", "pairs", "documents", "keys", "groups", "blob"])


def _stretches(text: str) -> Iterator[str]:
    """The text, cut where CUT allows into stretches of at least BLOCK characters."""
    at = 0
    while len(text) - at > BLOCK and (cut := CUT.search(text, at + BLOCK)):
        yield text[at : cut.start()]
        at = cut.end()
    yield text[at:]


def _signed(a, b, a_cuts, b_cuts, a_size: int, b_size: int) -> np.ndarray:
    """Places in Vocabularies.shown that spell the groups: each one's A ids, then its B ids."""
    na, nb = np.diff(a_cuts, prepend=0), np.diff(b_cuts, prepend=0)
    order = np.empty(len(a) + len(b), np.int64)
    for ids, cuts, n, ahead, base, size in ((a, a_cuts, na, b_cuts - nb, 0, a_size), (b, b_cuts, nb, a_cuts, 2 * a_size, b_size)):
        code = base + ids.astype(np.int64)
        code[cuts - 1] += size
        order[np.repeat(ahead, n) + np.arange(len(ids))] = code
    return order


def align_tokenizers(
    docs: DataFrame, a: str, b: str, key: str = "doc_id", text: str = "text", digest: bool = False
) -> tuple[DataFrame, DataFrame]:
    """How the tokens of two vocabularies lie over each other in each text, and which ids go together.

    `a` and `b` are paths, on the driver, of a byte-level vocabulary (tokenizers, .json) and of a piece
    vocabulary (sentencepiece, .model). Both encode a space and the text; special strings are plain text.

    Documents: (key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups) for each row of `docs`. A
    group ends where a token of each ends; links are the pairs of an A and a B token of one group; a pair's
    count is the number of rows that hold its ids linked; n_best counts the links whose pair has the
    highest count of its A id (ties included), count_sum adds up the links' counts. groups spells the
    groups as `a1,a2|b1;a3|b2,b3` in decimal ids (digest: its SHA-256 in lowercase hex). A text that is
    null or empty, or that B does not keep as it is, has no tokens: zeros, and '' for groups.

    Pairs: (a, b, n, best) for each linked id pair of the corpus: its count, and whether it is the
    highest of the A id.

    Rows that repeat, or bear the same key or none, count each. Columns other than key and text are not
    read. An empty table gives empty tables.
    """
    with open(a, encoding="utf-8") as f:
        given = [f.read()]
    with open(b, "rb") as f:
        given.append(f.read())
    here = Vocabularies(*given)
    shared = docs.sparkSession.sparkContext.broadcast(given)
    number = docs.schema[key].dataType.simpleString()
    size = here.b_size

    def taken(batches):
        v, part, kind, made = Vocabularies(*shared.value), None, None, 0
        for batch in batches:
            kind = batch.schema.field("key").type
            task = batch.column("task")[0].as_py() if len(batch) else 0
            for k, t in zip(batch.column("key").to_pylist(), batch.column("text"), strict=True):
                part = part or _Part(v, digest)
                part.add(k, t.as_py())
                if part.size >= PART:
                    yield part.row((task << 32) + made, kind)
                    part, made = None, made + 1
        if part:
            yield part.row((task << 32) + made, kind)

    rows = docs.select(F.spark_partition_id().cast("long").alias("task"), F.col(key).alias("key"), F.col(text).alias("text"))
    parts = written(rows.mapInArrow(taken, _PART.format(number)), "aligned")
    asked = parts.select("part", F.explode(F.arrays_zip("pairs", "documents")).alias("x"))
    asked = asked.select("part", F.col("x.pairs").alias("pair"), F.col("x.documents").alias("n"))
    counts = asked.groupBy("pair").agg(F.sum("n").alias("n")).withColumn("a", F.expr(f"pair div {size}"))
    highest = F.max("n").over(Window.partitionBy("a"))  # of at most as many rows as B has ids
    counts = written(counts.withColumn("best", F.col("n") == highest), "pairs")
    told = asked.select(F.col("part").alias("to"), "pair").join(counts.select("pair", "n", "best"), "pair")

    def answered(group, left, right):
        blob = P.unpack(left.column("blob")[0].as_py())
        at, times, per, *totals = (x.astype(np.int64) for x in blob)
        right = right.sort_by("pair")
        n, best = right.column("n").to_numpy(), right.column("best").to_numpy(zero_copy_only=False)
        ends = np.r_[0, np.cumsum(per)]
        sums = []
        for x in (best, n):
            total = np.r_[0, np.cumsum(times * x[at].astype(np.int64))] if len(at) else np.zeros(1, np.int64)
            sums.append(total[ends[1:]] - total[ends[:-1]])
        keys = left.column("keys").combine_chunks().flatten()
        columns = [keys, *map(pa.array, (*totals, *sums)), left.column("groups").combine_chunks().flatten()]
        return pa.table(columns, names=["key", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"])

    found = parts.select("part", "keys", "groups", "blob").groupBy("part").cogroup(told.groupBy("to"))
    documents = found.applyInArrow(answered, _FOUND.format(number)).withColumnRenamed("key", key)
    return documents, counts.select("a", (F.col("pair") % size).alias("b"), "n", "best")


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    a, b = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return align_tokenizers(docs, a, b, digest=True)[0].withColumnRenamed("groups", "groups_sha256")
