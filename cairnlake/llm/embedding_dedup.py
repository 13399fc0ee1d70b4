"""Operator 3. Vectors with a cosine of at least 0.9, found on a robust-pruned flat graph.

Equal vectors are one node. Centroids are fitted on a bounded sample; every node goes to the shards of
clusters of its OVERLAP nearest centroids. Centroids that a chain of cosines in range connects are one
cluster, so a group of near copies is not cut up, however many centroids fall on it. Each shard builds a
graph: from a pool of near and random members every node keeps neighbours by robust pruning (the nearest
first, without those that a kept one is closer to by a factor ALPHA). A node's adjacency lists from all
its shards are united. Shards then run a greedy beam search for each of their members, from the shard's
medoid over the united lists, and expand it: every vector found in range is opened as well, until none
is left; where the whole beam is in range, the shard's members are all compared instead. Hits are
verified in double precision. Recall is audited against brute force over a bounded sample of queries; if
it is below RECALL, overlap and beam are widened and the search is repeated. If it is below LEAST_RECALL
at the widest, that is an error.

Pairs never leave a shard: a pair is counted in the first shard that both members share, and of the
links only a spanning star for each shard goes on to the connected components. A cluster of more than
SHARD members is split by hash into blocks, and each pair of blocks is a shard of its own, so a hot
cluster is spread over many tasks and loses no pair.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnlake.llm.shared import components, written

COSINE = 0.9
#: Recall that ends the widening, and below which there is no result.
RECALL, LEAST_RECALL = 0.95, 0.9
#: Members of a shard at most, and on average.
SHARD, AIM = 4096, 2048
OVERLAP = 3
#: Neighbours kept, near and random members in the pool, and the factor of the pruning.
DEGREE, NEAR, RANDOM, ALPHA = 24, 48, 16, 1.2
BEAM = 24
#: Bounds of the samples that centroids are fitted on and that recall is audited with, and of centroids.
FIT_ROWS, AUDIT_ROWS, CENTROIDS = 16_384, 512, 2048
#: Queries that an average of the audit takes at least.
CLASS_ROWS = 16

_MEMBER = "shard string, node long, home int, own array<int>, v array<double>, copies long"


def near_vectors(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", cosine: float = COSINE
) -> DataFrame:
    """(key, n_links, component_id, kept) for each row of `vectors`; `key` is an integer.

    Rows are linked when their cosine, in double precision, is at least `cosine`. Null or zero vectors,
    and those with null or non-finite components, are linked with nothing; so are vectors of different
    lengths. n_links: other rows linked directly. component_id: the smallest key reachable by links,
    its own included; kept: whether that is its own key. Equal vectors are linked with each other. A
    row with a null key takes no part and has a null component. A row repeated as a whole is a copy like
    any other, with a row of its own in the result; a key must not stand for different vectors. Columns
    other than key and vector are not read. An empty table gives an empty table. A RuntimeError tells
    that less than LEAST_RECALL of the audited links were found, even by the widest search.
    """
    rows = vectors.select(F.col(key).cast("long").alias("key"), F.col(vector).cast("array<double>").alias("v"))
    infinite = F.lit(float("inf"))
    sound = F.col("key").isNotNull() & F.col("v").isNotNull() & F.forall(
        "v", lambda x: x.isNotNull() & (F.abs(x) < infinite) & ~F.isnan(x)
    )
    unit = rows.where(sound & F.exists("v", lambda x: x != 0)).select("key", _unit(F.col("v")).alias("v"))
    nodes = unit.groupBy("v").agg(F.min("key").alias("node"), F.count("*").alias("copies"))
    nodes = written(nodes, "vectors")
    of = unit.join(nodes.where("copies > 1"), "v").select("key", "node").distinct()

    overlap, beam = OVERLAP, BEAM
    while True:
        found = _linked(nodes, cosine, overlap, beam)
        recall = audited_recall(nodes, found, cosine)
        if recall >= RECALL or overlap >= 4 * OVERLAP:
            break
        overlap, beam = 2 * overlap, 2 * beam
    if recall < LEAST_RECALL:
        raise RuntimeError(f"recall of {recall:.4f} on the audited vectors, below {LEAST_RECALL}")
    whole = components(found.select(F.col("node").alias("a"), F.explode("roots").alias("b")))
    count = found.select("node", "n_links")

    result = (
        rows.select("key").join(of, "key", "left").withColumn("node", F.coalesce("node", "key"))
        .join(count, "node", "left").join(whole, "node", "left")
        .select(
            F.col("key").alias(key),
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("component", "node").alias("component_id"),
        )
    )
    return result.withColumn("kept", F.col(key).eqNullSafe(F.col("component_id")) & F.col(key).isNotNull())


def _unit(v: Column) -> Column:
    """The vector of length 1; scaled by its largest component first, so that squares neither vanish nor overflow."""
    largest = F.aggregate(v, F.lit(0.0), lambda m, y: F.greatest(m, F.abs(y)))
    scaled = _divided(v, largest)
    return _bound(scaled, lambda s: _divided(s, F.sqrt(F.aggregate(s, F.lit(0.0), lambda t, x: t + x * x))))


def _divided(v: Column, by: Column) -> Column:
    return _bound(F.struct(v.alias("v"), by.alias("by")), lambda s: F.transform(s["v"], lambda x: x / s["by"]))


def _bound(value: Column, use) -> Column:
    """use(value), with `value` evaluated once a row; inside a lambda it would be once an element."""
    return F.get(F.transform(F.array(value), use), 0)


def _linked(nodes: DataFrame, cosine: float, overlap: int, beam: int) -> DataFrame:
    """(node, n_links, roots): links of each node's copies, and smaller nodes of its component."""
    members = written(_members(nodes, overlap, cosine), "members")
    lists = members.select("shard", "node", "v").groupBy("shard").applyInArrow(_built, "node long, near array<bigint>")
    united = lists.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))

    def searched(table):
        return _searched(table, cosine, beam)

    hits = (
        members.join(united, "node").groupBy("shard").applyInArrow(searched, "node long, n_links long, root long")
        .groupBy("node").agg(F.sum("n_links").alias("n_links"), F.collect_set("root").alias("roots"))
    )
    hits = nodes.select("node", "copies").join(hits, "node").select(
        "node", (F.col("n_links") + F.col("copies") - 1).alias("n_links"), "roots"
    )
    return written(hits, "hits")


def _members(nodes: DataFrame, overlap: int, cosine: float) -> DataFrame:
    """Each node once for each of its shards: (shard, node, home, own, v, copies).

    own: the node's clusters; home: the one of this shard, or -1 - home where only pairs of different
    blocks count.
    """
    spark = nodes.sparkSession
    total = nodes.count()
    sample = nodes.orderBy(F.xxhash64("node")).limit(FIT_ROWS).select("v").toArrow().column("v")
    centroids: dict[int, np.ndarray] = {}
    for size in sorted({len(x) for x in sample}):
        x = np.array([y.as_py() for y in sample if len(y) == size])
        wanted = math.ceil(total * len(x) / len(sample) * overlap / AIM)
        centroids[size] = _centroids(x, min(max(1, wanted), CENTROIDS, len(x)))
    base, at = {}, 0
    for size, c in centroids.items():
        base[size], at = at, at + len(c)
    cluster = {size: base[size] + chained(c, cosine) for size, c in centroids.items()}
    held = spark.sparkContext.broadcast((centroids, cluster))

    def assigned(batches):
        centroids, cluster = held.value
        for batch in batches:
            own = []
            for v in batch.column("v"):
                x = np.asarray(v.values)
                c = centroids.get(len(x))
                if c is None:  # a length that the sample has not met: one cluster
                    own.append([-len(x)])
                    continue
                near = c @ x
                k = min(overlap, len(c))
                best = np.argpartition(-near, k - 1)[:k] if k < len(c) else np.arange(len(c))
                own.append(np.unique(cluster[len(x)][best]).tolist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array(own, pa.list_(pa.int32())), batch.column("v"), batch.column("copies")],
                ["node", "own", "v", "copies"],
            )

    own = nodes.select("node", "v", "copies").mapInArrow(assigned, "node long, own array<int>, v array<double>, copies long")
    own = written(own, "assigned")
    each = own.withColumn("home", F.explode("own"))
    blocks = each.groupBy("home").agg(F.count("*").alias("size"))
    blocks = blocks.select("home", F.ceil(F.col("size") * F.when(F.col("size") > SHARD, 2).otherwise(1) / SHARD).alias("blocks"))
    each = each.join(blocks, "home")
    block = F.pmod(F.xxhash64("node"), F.col("blocks"))
    each = each.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    return each.select(
        F.concat_ws("-", "home", F.least("block", "other"), F.greatest("block", "other")).alias("shard"),
        "node",
        F.when(F.col("block") == F.col("other"), 0).otherwise(F.when(F.col("block") < F.col("other"), 1).otherwise(2)).cast("int").alias("side"),
        "home", "own", "v", "copies",
    )


def _centroids(x: np.ndarray, k: int) -> np.ndarray:
    rng = np.random.default_rng(7)
    c = x[rng.choice(len(x), k, replace=False)]
    for _ in range(8):
        nearest = np.concatenate([(x[i : i + 4096] @ c.T).argmax(1) for i in range(0, len(x), 4096)])
        order = np.argsort(nearest, kind="stable")
        at = np.searchsorted(nearest[order], np.arange(k + 1))
        some = np.flatnonzero(np.diff(at))
        c[some] = np.add.reduceat(x[order], at[some])
        size = np.linalg.norm(c, axis=1, keepdims=True)
        c = np.where(size > 0, c / np.maximum(size, 1e-300), c)
    return c


def chained(c: np.ndarray, cosine: float) -> np.ndarray:
    """For each row of `c` the first of those that a chain of cosines of at least `cosine` connects it with."""
    near = c @ c.T >= cosine
    np.fill_diagonal(near, True)
    return _least_reachable(near)


def _least_reachable(linked: np.ndarray) -> np.ndarray:
    """The smallest row reachable from each; `linked` is symmetric and links each row with itself."""
    root = np.arange(len(linked))
    while True:
        least = np.concatenate([np.where(linked[i : i + 256], root, len(root)).min(1) for i in range(0, len(root), 256)])
        least = least[least]
        if (least == root).all():
            return root
        root = least


def _matrix(column) -> np.ndarray:
    flat = column.combine_chunks()
    return np.asarray(flat.flatten()).reshape(len(flat), -1) if len(flat) else np.zeros((0, 1))


def _built(table):
    """The pruned neighbours of each member of a shard."""
    node = table.column("node").to_numpy()
    order = np.argsort(node)
    node, x = node[order], _matrix(table.column("v"))[order].astype(np.float32)
    near = pruned(x)
    count = (near >= 0).sum(1)
    lists = pa.ListArray.from_arrays(
        pa.array(np.r_[0, np.cumsum(count)].astype(np.int32)), pa.array(node[near[near >= 0]])
    )
    return pa.table({"node": pa.array(node), "near": lists})


def pruned(x: np.ndarray) -> np.ndarray:
    """Up to DEGREE neighbours of each row of `x` by robust pruning, -1 where there are fewer."""
    n = len(x)
    rng = np.random.default_rng(n)
    out = np.full((n, DEGREE), -1, np.int64)
    for lo in range(0, n, 256):
        own = np.arange(lo, min(n, lo + 256))
        near = x[own] @ x.T
        near[np.arange(len(own)), own] = -2
        k = min(NEAR, n - 1)
        if k < 1:
            break
        pool = np.argpartition(-near, k - 1, axis=1)[:, :k]
        pool = np.concatenate([pool, rng.integers(0, n, (len(own), RANDOM))], axis=1)
        sim = np.take_along_axis(near, pool, 1)
        order = np.argsort(-sim, axis=1, kind="stable")
        pool, sim = np.take_along_axis(pool, order, 1), np.take_along_axis(sim, order, 1)
        open_ = sim > -2
        far = 2 - 2 * sim  # squared distances of unit vectors
        vectors = x[pool]
        rows = np.arange(len(own))
        for slot in range(DEGREE):
            any_ = open_.any(1)
            if not any_.any():
                break
            pick = open_.argmax(1)
            chosen = pool[rows, pick]
            out[own[any_], slot] = chosen[any_]
            apart = 2 - 2 * np.einsum("bd,bkd->bk", x[chosen], vectors)
            open_ &= ~((ALPHA * ALPHA * apart <= far) | (pool == chosen[:, None])) | ~any_[:, None]
    return out


def _searched(table, cosine, beam):
    node = table.column("node").to_numpy()
    order = np.argsort(node)
    node = node[order]
    exact = _matrix(table.column("v"))[order]
    copies = table.column("copies").to_numpy()[order]
    side = table.column("side").to_numpy()[order]
    home = table.column("home")[0].as_py()
    own = table.column("own").to_pylist()
    own = [own[i] for i in order]

    near = table.column("near").combine_chunks().take(pa.array(order))
    flat = np.asarray(near.flatten())
    from_ = np.repeat(np.arange(len(node)), near.value_lengths().to_numpy())
    at = np.minimum(np.searchsorted(node, flat), len(node) - 1)
    inside = node[at] == flat
    from_, to = from_[inside], at[inside]
    width = max(1, int(np.bincount(from_, minlength=len(node)).max(initial=0)))
    lists = np.full((len(node), width), -1, np.int64)
    place = np.arange(len(from_)) - np.searchsorted(from_, from_)
    lists[from_, place] = to

    found = searched(exact, lists, cosine, beam)
    found |= found.T
    np.fill_diagonal(found, True)
    root = _least_reachable(found)
    np.fill_diagonal(found, False)
    # the first shard that two members share counts the pair; blocks count pairs across them once
    before = [[x for x in c if x < home] for c in own]
    wide = max(map(len, before))
    clusters = np.full((len(own), wide), home)
    for i, c in enumerate(before):
        clusters[i, : len(c)] = c
    links = np.zeros(len(node), np.int64)
    for lo in range(0, len(node), 256):
        a = slice(lo, lo + 256)
        first = found[a] & ((side[a, None] == 0) | (side[a, None] != side))
        for j in range(wide):  # a smaller cluster of one that the other has too
            for k in range(wide):
                first &= ~((clusters[a, j, None] == clusters[:, k]) & (clusters[a, j, None] < home))
        links[a] = first @ copies
    return pa.table({"node": pa.array(node), "n_links": pa.array(links), "root": pa.array(node[root])})


def searched(exact: np.ndarray, lists: np.ndarray, cosine: float, beam: int) -> np.ndarray:
    """found[q, r]: a search for row q over `lists` met row r in range; verified in double precision."""
    n = len(exact)
    x = exact.astype(np.float32)
    medoid = int(np.argmax(x @ x.sum(0)))
    least = np.float32(cosine - 1e-4)
    found = np.zeros((n, n), bool)
    block = max(16, min(256, (4 << 20) // max(1, lists.shape[1] * x.shape[1])))
    for lo in range(0, n, block):
        q = np.arange(lo, min(n, lo + block))
        rows = np.arange(len(q))
        seen = np.zeros((len(q), n), bool)
        seen[:, medoid] = True
        ids = np.full((len(q), beam), -1)
        sims = np.full((len(q), beam), -3, np.float32)
        opened = np.ones((len(q), beam), bool)
        ids[:, 0], sims[:, 0], opened[:, 0] = medoid, x[q] @ x[medoid], False
        hit = np.zeros((len(q), n), bool)
        hit[:, medoid] = sims[:, 0] >= least
        expanded = np.zeros((len(q), n), bool)
        while True:
            ahead = np.where(opened, -4, sims)
            pick = ahead.argmax(1)
            live = np.flatnonzero(ahead[rows, pick] > -3)
            if not len(live):
                break
            opened[live, pick[live]] = True
            at = ids[live, pick[live]]
            expanded[live, at] = True
            next_ = lists[at]
            ok = (next_ >= 0) & ~seen[live[:, None], next_]
            sim = np.einsum("bd,bkd->bk", x[q[live]], x[next_])
            sim = np.where(ok, sim, -3)
            r, c = np.nonzero(ok)
            seen[live[r], next_[r, c]] = True
            hit[live[r], next_[r, c]] = sim[r, c] >= least
            all_ids = np.concatenate([ids[live], next_], 1)
            all_sims = np.concatenate([sims[live], sim], 1)
            all_opened = np.concatenate([opened[live], ~ok], 1)
            best = np.argpartition(-all_sims, beam - 1, axis=1)[:, :beam]
            ids[live] = np.take_along_axis(all_ids, best, 1)
            sims[live] = np.take_along_axis(all_sims, best, 1)
            opened[live] = np.take_along_axis(all_opened, best, 1)
        # a beam all in range: a group of more than it, compared with every member at once
        dense = np.flatnonzero((sims >= least).all(1))
        if len(dense):
            expanded[dense] = True
            found[q[dense]] = exact[q[dense]] @ exact.T >= cosine
            hit[dense] = False
        while True:  # what is in range is opened too, beam or not
            r, c = np.nonzero(hit & ~expanded)
            if not len(r):
                break
            expanded[r, c] = True
            for i in range(0, len(r), 8192):
                a, near = r[i : i + 8192], lists[c[i : i + 8192]]
                s, k = np.nonzero((near >= 0) & ~seen[a[:, None], near])
                a, near = a[s], near[s, k]
                seen[a, near] = True
                inside = np.einsum("bd,bd->b", x[q[a]], x[near]) >= least
                hit[a[inside], near[inside]] = True
        r, c = np.nonzero(hit)
        for i in range(0, len(r), 65536):
            a, b = r[i : i + 65536], c[i : i + 65536]
            sure = np.einsum("bd,bd->b", exact[q[a]], exact[b]) >= cosine
            found[q[a[sure]], b[sure]] = True
    return found


def audited_recall(nodes: DataFrame, found: DataFrame, cosine: float) -> float:
    """The least share of true links that were found, over a bounded sample of queries against all rows.

    Shares are taken of all links together and as the queries' average in each class of sizes (`least_recall`),
    so a large group's links don't hide that those of small ones are missed.
    """
    sample = nodes.orderBy(F.xxhash64("node", F.lit(1))).limit(AUDIT_ROWS).join(found, "node", "left")
    sample = sample.select("node", "v", F.coalesce("n_links", F.col("copies") - 1).alias("n")).toArrow()
    if not sample.num_rows:
        return 1.0
    rows = [(v.as_py(), n) for v, n in zip(sample.column("v"), sample.column("n").to_pylist(), strict=True)]
    sizes = sorted({len(v) for v, _ in rows})
    held = nodes.sparkSession.sparkContext.broadcast({s: np.array([v for v, _ in rows if len(v) == s]) for s in sizes})
    got = {s: np.array([n for v, n in rows if len(v) == s]) for s in sizes}

    def counted(batches):
        for batch in batches:
            for size, q in held.value.items():
                own = [(v.values, c) for v, c in zip(batch.column("v"), batch.column("copies").to_pylist(), strict=True) if len(v) == size]
                if own:
                    x = np.array([np.asarray(v) for v, _ in own])
                    n = (q @ x.T >= cosine) @ np.array([c for _, c in own])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(q), size)), pa.array(np.arange(len(q))), pa.array(n.astype(np.int64))],
                        ["size", "query", "n"],
                    )

    true = nodes.select("v", "copies").mapInArrow(counted, "size long, query long, n long")
    true = true.groupBy("size", "query").agg(F.sum("n").alias("n")).collect()  # AUDIT_ROWS rows at most
    wanted = np.array([r.n - 1 for r in true])
    return least_recall(wanted, np.minimum(wanted, [got[r.size][r.query] for r in true]))


def least_recall(wanted: np.ndarray, met: np.ndarray) -> float:
    """The least of the pooled share of links met and the average shares of the classes of queries.

    A class has queries of like numbers of links wanted (by powers of two); it takes in the next larger
    ones until it has CLASS_ROWS queries, and the last one joins the class before if it has fewer.
    """
    order = np.argsort(wanted, kind="stable")
    order = order[wanted[order] > 0]
    if not len(order):
        return 1.0
    wanted, met = wanted[order], met[order]
    ends = np.r_[np.flatnonzero(np.diff(np.log2(wanted).astype(int))) + 1, len(wanted)]
    bounds = [0]
    for end in ends:
        if end - bounds[-1] >= CLASS_ROWS:
            bounds.append(end)
    bounds = [*bounds[: max(1, len(bounds) - 1)], len(wanted)]
    share = met / wanted
    classes = [share[lo:hi].mean() for lo, hi in zip(bounds, bounds[1:])]
    return float(min(met.sum() / wanted.sum(), *classes))


def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
