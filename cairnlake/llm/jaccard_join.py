"""Operator 2. Documents whose shingle sets are alike, joined on token-combination prefixes.

A token is the hash of a shingle. Tokens have one order everywhere: rarer first (by the number of
documents that have them), then by hash. Two sets with a Jaccard similarity of at least t differ in
so few tokens that some of each one's first ones are shared. How many first ones are needed depends
on what is indexed:

* a token of fewer than FREQUENT documents is indexed by itself, and counts one;
* a frequent token falls into one of G sub-classes by its hash; from each sub-class all pairs of the
  prefix's tokens are indexed, and all but its first token count one. The prefix is extended until
  the counts reach what the other set could lack, plus one. Then a similar set shares a token of the
  rare class or two tokens of some sub-class, whichever tokens it lacks.
* tokens that no other document has count, and are never written.

G must be the same for both sets: it follows from a size class (sizes in steps of 1/t), and a set is
indexed under its own class and the next one, where any similar set is too.

An index entry also keeps its *reach*: how much of the set had been counted when the prefix got there.
Sets of n and m tokens that are similar share an entry whose reach is at most what n may lack of m, in
both sets; so an entry of reach r meets no set above a certain size, and none at all where a set has more
tokens of its own than any partner could lack. Many texts of one template that are not similar never
become a pair.

Document frequencies are counted by sorted fingerprints between parts and shards (`packed`). Equal
sets are one node from then on. Candidates are not all pairs of a posting: in a round each posting has
one centre, verified against its nodes of other components, and connected components are contracted;
the first centre is the entry of least reach, as the source of a group of copies has, the next ones are
drawn by hash, until a round finds few links. A centre leaves its posting, as it has met all of it, and so does
an entry whose reach admits no size that the posting has. Postings that then still hold several components are
joined with themselves by size class and the classes that each entry's reach admits. Pairs meet there only if
few enough bits of their sketches differ: a token turns over one bit of its set's sketch, so two sets differ in
as many tokens at least. What meets is verified too. So no link between components is lost, a group of
thousands of near copies costs a star, and of a template's many altered texts only those near the limit meet.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import add, and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnlake.llm import packed as P
from cairnlake.llm.shared import components, written

WORDS = 5
PERCENT = 75
FREQUENT = 16
#: Sizes of one class differ by less than this factor.
CLASS = 1.05
#: Rounds end when one finds no link for one in so many of the components still in open postings.
FEW = 20
#: Longs of a set's sketch.
SKETCH = 8
SHARD_BYTES = 12 << 20

_ROWS = "kind int, node long, n int, ref long, reach int, items array<bigint>"
_ARROW = pa.schema(
    [("kind", pa.int32()), ("node", pa.int64()), ("n", pa.int32()), ("ref", pa.int64()), ("reach", pa.int32()), ("items", pa.list_(pa.int64()))]
)
MEMBER, SIGNATURE, SET = 0, 1, 2


def similar_documents(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """(key, n_shingles, component_id) for each row of `docs`; `key` is an integer.

    A-Z are lower-cased, words are `[^\\x20\\x09-\\x0D]+`, a row's set holds its distinct shingles of
    `words` words; with fewer words the whole sequence is the one shingle; null, empty or blank text
    has none and is linked with nothing. Rows link when 100 * intersection >= percent * union.
    component_id is the smallest key reachable by links, the row's own included. Rows with equal keys
    are one node: what either is linked with, both are. A row with a null key is linked with nothing
    and has a null component_id. Columns other than key and text are not read. An empty table gives
    an empty table.
    """
    members, links = _links(docs, key, text, words, percent)
    # a key of several texts connects the nodes of their sets
    several = members.where("node is not null").groupBy("node").agg(F.min("ref").alias("b"), F.max("ref").alias("hi"))
    several = several.where("b < hi").drop("hi")
    same = members.join(several, "node").select(F.col("ref").alias("a"), "b")
    found = components(links.unionByName(same))
    return members.join(found, members.ref == found.node, "left").select(
        members.node.alias(key),
        members.n.cast("long").alias("n_shingles"),
        F.coalesce("component", "ref").alias("component_id"),
    )


def _links(docs, key, text, words, percent):
    """Rows (node, n, ref: the smallest key with the same set), and links (a, b) that connect all components."""
    size = P.text_bytes(docs, text)
    shards = max(1, math.ceil(size / SHARD_BYTES))
    # fingerprints of a token: wide enough that two of the corpus seldom share one
    drop = np.uint64(max(0, 64 - max(40, size.bit_length() + 8)))
    documents = P.packed_parts(docs.select(F.col(key).cast("long").alias(key), text), key, text, P.part_count(size))
    by_part = documents.groupBy("part")

    def tokens(group, table):
        s = _Sets(P.unpacked(table), words)
        f, times = _counted(s, drop)
        s1, s2, least = s.s1[s.lead], s.s2[s.lead], s.least
        at_f, at_s = P.shard_of(f << drop, shards), P.shard_of(s1, shards)
        none = np.zeros(0, np.uint64)
        out = {k: [none] * 5 for k in sorted({*at_f.tolist(), *at_s.tolist()})} if len(s1) else {}
        for k, w in P.by_shard(at_f):
            out[k][:2] = [P.deltas(f[w]), P.small(times[w])]
        for k, w in P.by_shard(at_s):
            out[k][2:] = [P.deltas(s1[w]), s2[w], least[w].view(np.uint64)]
        return P.sent(group[0].as_py(), {k: P.pack(*v) for k, v in out.items()})

    def counted(group, table):
        held = P.received(table, "part")
        f = np.concatenate([P.undelta(a[0]) for _, a in held])
        times = np.concatenate([a[1].astype(np.int64) for _, a in held])
        order = np.argsort(f, kind="stable")
        at = P.cuts(f[order])
        df = np.empty(len(f), np.uint8)
        if len(f):
            total = np.minimum(np.add.reduceat(times[order], at[:-1]), 255)
            df[order] = np.repeat(total, np.diff(at))
        s1 = np.concatenate([P.undelta(a[2]) for _, a in held])
        s2 = np.concatenate([a[3] for _, a in held]).astype(np.uint64)
        doc = np.concatenate([a[4] for _, a in held]).astype(np.uint64).view(np.int64)
        order = np.lexsort((s2, s1))
        least = np.empty(len(s1), np.int64)
        if len(s1):
            fresh = np.r_[True, (s1[order][1:] != s1[order][:-1]) | (s2[order][1:] != s2[order][:-1])]
            first = np.flatnonzero(fresh)
            smallest = np.minimum.reduceat(doc[order], first)
            least[order] = np.repeat(smallest, np.diff(np.r_[first, len(s1)]))
        out, lo, so = {}, 0, 0
        for part, a in held:
            out[part] = P.pack(df[lo : lo + len(a[0])], least[so : so + len(a[2])].view(np.uint64))
            lo, so = lo + len(a[0]), so + len(a[2])
        return P.answers(group[0].as_py(), out)

    def indexed(group, left, right):
        if not left.num_rows:
            return _ARROW.empty_table()
        s = _Sets(P.unpacked(left), words)
        replies = [a for _, a in P.received(right, "shard")]
        df = np.concatenate([a[0] for a in replies]) if replies else np.zeros(0, np.uint8)
        first = np.concatenate([a[1] for a in replies]).astype(np.uint64).view(np.int64) if replies else np.zeros(0, np.int64)
        return _indexed(s, df, first, percent, drop)

    replies = by_part.applyInArrow(tokens, P.SENT).groupBy("shard").applyInArrow(counted, P.SENT)
    rows = by_part.cogroup(replies.groupBy("part")).applyInArrow(indexed, _ROWS)
    rows = written(rows, "jaccard", "kind")
    members = rows.where(F.col("kind") == MEMBER).select("node", "n", "ref")
    postings = rows.where(F.col("kind") == SIGNATURE).select("node", "n", "reach", F.col("ref").alias("signature"))
    sets = rows.where(F.col("kind") == SET).select("node", "items")

    # rounds of stars: each posting's centre against its nodes of other components
    first = F.struct("reach", "node", "n")
    left = postings.withColumn("component", F.col("node"))
    links, tried, number, waiting = None, None, 0, 1
    while waiting:
        pairs, found = _star(left, first, sets, percent)
        links = found if links is None else links.unionByName(found)
        tried = pairs if tried is None else tried.unionByName(pairs)
        many = found.count()
        if number and many * FEW <= waiting:
            break
        left = _open(left, first, components(links) if many else None, percent)  # a posting once closed stays so
        number, waiting = number + 1, left.agg(F.approx_count_distinct("component")).first()[0]
        first = F.struct(F.xxhash64("node", F.lit(number)).alias("drawn"), "reach", "node", "n")

    # what is left between components
    rest = _meeting(_sketched(left, sets), percent).join(tried, ["a", "b"], "left_anti")
    rest = written(rest, "pairs")
    return members, links.unionByName(written(_verified(rest, sets, percent), "links"))


def _star(left: DataFrame, first: Column, sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """The pairs of each posting's centre (the least by `first`) with nodes of other components, and the links found."""
    centre = F.min(F.struct(first.alias("order"), "component")).alias("c")
    centre = left.groupBy("signature").agg(centre, F.count("*").alias("size")).where("size > 1")
    of_centre = [F.col(f"c.order.{c}").alias(f"c_{c}") for c in ("node", "n", "reach")]
    centre = centre.select("signature", *of_centre, F.col("c.component").alias("c_component"))
    star = left.join(centre, "signature").where("component <> c_component")
    star = star.where(_may_link(F.col("n"), F.col("reach"), F.col("c_n"), F.col("c_reach"), percent))
    tried = written(_pairs(star, F.col("node"), F.col("c_node")), "pairs")
    return tried, written(_verified(tried, sets, percent), "links")


def _open(postings: DataFrame, first: Column, known: DataFrame | None, percent: int) -> DataFrame:
    """Postings that hold several components, each without its centre (the least by `first`).

    The centre has met all nodes of the posting, so nothing is left to find for it there. Entries leave too
    that could only be similar to sets shorter than any of the posting, or that are longer than all its
    entries admit.
    """
    if known is not None:
        left = postings.drop("component").join(known, "node", "left")
        postings = left.select("signature", "node", "n", "reach", F.coalesce("component", "node").alias("component"))
    longest = _longest(F.col("n"), F.col("reach"), percent)
    least, most = F.min("component").alias("lo"), F.max("component").alias("hi")
    bounds = F.min("n").alias("shortest"), F.max(longest).alias("longest")
    several = postings.groupBy("signature").agg(least, most, *bounds, F.min(first).alias("c"), F.count("*").alias("size"))
    several = several.where("lo < hi and size > 2").select("signature", "shortest", "longest", F.col("c.node").alias("centre"))
    left = postings.join(several, "signature").where("node <> centre and n <= longest").where(longest >= F.col("shortest"))
    return written(left.select(*postings.columns), "open")


def _meeting(left: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of a posting's nodes of different components that each other's sizes, reaches and sketches admit.

    Sizes fall into classes of CLASS; an entry is told under each class that its partner may be of, so
    those that admit no common pair of classes never meet.
    """
    n = F.col("n")
    most = _longest(n, F.col("reach"), percent)
    least = F.ceil(percent * n / 100)
    told = left.where(most >= least).withColumn("own", _class(n))
    told = told.withColumn("partner", F.explode(F.sequence(_class(least), _class(most))))
    x, y = told.alias("x"), told.alias("y")
    same = [("signature", "signature"), ("own", "partner"), ("partner", "own")]
    same = reduce(and_, [F.col(f"x.{p}") == F.col(f"y.{q}") for p, q in same])
    may = _may_link(F.col("x.n"), F.col("x.reach"), F.col("y.n"), F.col("y.reach"), percent)
    # for each bit in which sketches differ, one of the sets has a token that the other lacks
    apart = [F.bit_count(F.col(f"x.s{i}").bitwiseXOR(F.col(f"y.s{i}"))) for i in range(SKETCH)]
    near = (100 + percent) * reduce(add, apart) <= (100 - percent) * (F.col("x.n") + F.col("y.n"))
    met = x.join(y, same & (F.col("x.component") < F.col("y.component")) & may & near)
    return _pairs(met, F.col("x.node"), F.col("y.node"))


def _sketched(left: DataFrame, sets: DataFrame) -> DataFrame:
    """`left` with each node's sketch s0, s1, ...: a token of its set turns over one of 64 * SKETCH bits."""
    mine = sets.join(left.select("node").distinct(), "node", "left_semi")
    bits = "aggregate(filter(items, t -> pmod(t >> 6, {n}) = {i}), 0L, (s, t) -> s ^ shiftleft(1L, int(t & 63)))"
    return left.join(mine.select("node", *(F.expr(bits.format(n=SKETCH, i=i)).alias(f"s{i}") for i in range(SKETCH))), "node")


def _pairs(rows: DataFrame, a: Column, b: Column) -> DataFrame:
    return rows.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()


def _class(size: Column) -> Column:
    return F.floor(F.log(size.cast("double")) / math.log(CLASS))


def _longest(n: Column, reach: Column, percent: int) -> Column:
    """The most tokens of a set that one of n tokens could be similar to, if that lacks `reach` of them."""
    return F.floor((100 + percent) * (n - reach) / percent) - n


def _may_link(n, reach, m, other, percent) -> Column:
    """Could sets of n and m tokens be similar that lack so much of each other?"""
    common = F.least(n - reach, m - other)
    return (100 + percent) * common >= percent * (n + m)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    # sets that no pair names are not shuffled
    sets = sets.join(pairs.select(F.col("a").alias("node")).union(pairs.select("b")), "node", "left_semi")
    a = sets.select(F.col("node").alias("a"), F.col("items").alias("s"))
    b = sets.select(F.col("node").alias("b"), F.col("items").alias("t"))
    common = F.size(F.array_intersect("s", "t"))
    total = F.size("s") + F.size("t")
    return pairs.join(b, "b").join(a, "a").where((100 + percent) * common >= percent * total).select("a", "b")


class _Sets:
    """The distinct tokens of a part's rows.

    row, token: by row, tokens rising; n: of each row; lead: one row for each different set, in the
    order of the sets' hashes s1, s2; same: each row's place among them, or -1; least: their smallest key.
    """

    def __init__(self, rows: pa.Table, words: int):
        row, token = [], []
        for lo, data, bounds in P.chunks(rows.column("text")):
            data = P.LOWER[data]
            starts, ends, first = P.words(data, bounds)
            w = P.word_hashes(data, starts, ends)
            many = np.diff(first)
            owner = np.repeat(np.arange(len(many)), many)
            begin = np.flatnonzero(np.repeat(first[1:], many) - np.arange(len(w)) >= words)
            short = np.flatnonzero((many > 0) & (many < words))
            h = np.r_[P.range_hash(w, begin, begin + words, 1), P.range_hash(w, first[short], first[short + 1], 1)]
            o = np.r_[owner[begin], short]
            order = np.lexsort((h, o))
            h, o = h[order], o[order]
            fresh = np.ones(len(h), bool)
            fresh[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
            token.append(h[fresh])
            row.append(o[fresh] + lo)
        self.row = np.concatenate(row) if row else np.zeros(0, np.int64)
        self.token = np.concatenate(token) if token else np.zeros(0, np.uint64)
        self.rows = rows.num_rows
        self.n = np.bincount(self.row, minlength=self.rows)
        self.first = np.r_[0, np.cumsum(self.n)]
        self.null = rows.column("key").is_null().to_numpy()
        self.key = rows.column("key").fill_null(0).to_numpy().astype(np.int64)
        total = np.zeros((2, len(self.token) + 1), np.uint64)
        np.cumsum(P.mix(self.token), out=total[0, 1:])
        np.cumsum(P.mix(self.token + np.uint64(0x632BE59BD9B4E019)), out=total[1, 1:])
        s = total[:, self.first[1:]] - total[:, self.first[:-1]]
        self.s1, self.s2 = P.mix(s[0]), P.mix(s[1])
        live = np.flatnonzero((self.n > 0) & ~self.null)
        order = live[np.lexsort((self.s2[live], self.s1[live]))]
        fresh = np.ones(len(order), bool)
        fresh[1:] = (self.s1[order][1:] != self.s1[order][:-1]) | (self.s2[order][1:] != self.s2[order][:-1])
        self.lead = order[fresh]
        self.same = np.full(self.rows, -1)
        self.same[order] = np.cumsum(fresh) - 1
        at = np.flatnonzero(fresh)
        self.least = np.minimum.reduceat(self.key[order], at) if len(at) else np.zeros(0, np.int64)

    def of(self, rows: np.ndarray) -> np.ndarray:
        """Places of the tokens of the given rows."""
        n = self.n[rows]
        return np.repeat(self.first[rows] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


def _counted(s: _Sets, drop: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """Sorted fingerprints (all bits but the lowest `drop`) of a part's tokens, and the different sets that have each."""
    f = np.sort(s.token[s.of(s.lead)] >> drop)
    at = P.cuts(f)
    return (f[at[:-1]], np.diff(at)) if len(f) else (f, np.zeros(0, np.int64))


def _indexed(s: _Sets, df: np.ndarray, first: np.ndarray, percent: int, drop: np.uint64) -> pa.Table:
    """A part's rows, and of each set that is first here: its signatures, and its tokens if it has any.

    df: of the fingerprints of `_counted`; first: the smallest key of each of the part's sets.
    """
    ref = np.where(s.same >= 0, first[s.same] if len(first) else 0, s.key)
    member = _table(MEMBER, s.key, s.n, ref, null=s.null)
    own = s.lead[first == s.least] if len(first) else s.lead
    place = s.of(own)
    if not len(place):
        return member
    token = s.token[place]
    doc = np.repeat(np.arange(len(own)), s.n[own])
    known, _ = _counted(s, drop)
    freq = df[np.searchsorted(known, token >> drop)]
    order = np.lexsort((token, freq, doc))
    token, freq = token[order], freq[order]
    n = s.n[own].astype(np.int64)
    begin = np.cumsum(n) - n
    rank = np.arange(len(token)) - begin[doc]
    need = n - -(-percent * n // 100) + 1
    rare = np.bincount(doc[freq < FREQUENT], minlength=len(own))

    # the prefix's rare tokens, by themselves; one that nobody else has needs no entry
    single = (freq < FREQUENT) & (freq > 1) & (rank < need[doc])
    sig, sig_doc, sig_reach = [token[single]], [doc[single]], [rank[single]]
    # where these don't suffice: pairs of frequent tokens from the same sub-class
    base = 100 / percent
    size_class = np.floor(np.log(n) / math.log(base)).astype(np.int64)
    size_class += (base ** (size_class + 1) <= n).astype(np.int64)
    size_class -= (base**size_class > n).astype(np.int64)
    extended = (freq >= FREQUENT) & (rare < need)[doc]
    for step in (0, 1):
        if not extended.any():
            break
        scheme = size_class + step
        groups = np.maximum(1, (base ** (scheme - 1.0) / 4).astype(np.int64))
        t, d = token[extended], doc[extended]
        sub = (P.mix(t + np.uint64(0x632BE59BD9B4E019)) % groups[d].astype(np.uint64)).astype(np.int64)
        by = np.lexsort((np.arange(len(t)), sub, d))  # in the order of the prefix within a sub-class
        fresh = np.ones(len(t), bool)
        fresh[1:] = (sub[by][1:] != sub[by][:-1]) | (d[by][1:] != d[by][:-1])
        counts = np.empty(len(t), np.int64)
        counts[by] = ~fresh
        total = np.cumsum(counts)
        start = np.flatnonzero(np.r_[True, d[1:] != d[:-1]])
        before = np.repeat((total - counts)[start], np.diff(np.r_[start, len(d)]))
        reach = rare[d] + total - before - counts
        by = by[(reach < need[d])[by]]
        t, d, sub, reach = t[by], d[by], sub[by], reach[by]
        apart = 1
        while apart < len(t):
            pair = (d[apart:] == d[:-apart]) & (sub[apart:] == sub[:-apart])
            if not pair.any():
                break
            mark = scheme[d[apart:][pair]].astype(np.uint64)
            sig.append(P.mix(P.mix(t[:-apart][pair] + mark) + t[apart:][pair]))
            sig_doc.append(d[apart:][pair])
            sig_reach.append(reach[apart:][pair])
            apart += 1
    sig, sig_doc, sig_reach = np.concatenate(sig), np.concatenate(sig_doc), np.concatenate(sig_reach)
    key = s.least[first == s.least]
    has = np.unique(sig_doc)
    items = s.token[s.of(own[has])].view(np.int64)
    ends = np.r_[0, np.cumsum(n[has])].astype(np.int32)
    return pa.concat_tables(
        [
            member,
            _table(SIGNATURE, key[sig_doc], n[sig_doc], sig.view(np.int64), sig_reach),
            _table(SET, key[has], n[has], key[has], None, pa.ListArray.from_arrays(pa.array(ends), pa.array(items))),
        ]
    )


def _table(kind, node, n, ref, reach=None, items=None, null=None) -> pa.Table:
    count = len(node)
    columns = [
        pa.array(np.full(count, kind, np.int32)),
        pa.array(node, mask=null),
        pa.array(n.astype(np.int32)),
        pa.array(ref, mask=null),
        pa.nulls(count, pa.int32()) if reach is None else pa.array(reach.astype(np.int32)),
        pa.nulls(count, pa.list_(pa.int64())) if items is None else items,
    ]
    return pa.Table.from_arrays(columns, schema=_ARROW)


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return similar_documents(docs)
