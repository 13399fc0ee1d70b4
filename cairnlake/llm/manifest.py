"""Operator 13. A Merkle manifest of a dataset: every row's digest, and proofs up to one root.

Rows become leaves (SHA-256 in the JVM; texts go no further). A range sort puts them in order, and the
numbers that Spark gives to sorted rows, partition by partition, tell each leaf's place in its source's
tree, with prefix sums over the partitions and no window over a source.

A tree is cut into *superblocks* of SPAN consecutive nodes, SPAN being a power of the arity, so each one
reduces by itself to one node some levels up; superblocks of those follow, until each source has its
subroot, and those one root. On the way back, nodes and the outer siblings of their superblock's top are
cogrouped by superblock (applyInPandas): the function finishes the local reduction, joins its siblings
to the outer ones, and folds the claimed digests up to the root. A group is some superblocks, whatever
source they belong to, so neither a source of a third of all rows nor many sources of one row matter.

A proof is a list of steps, one a level: the siblings' digests in order, with `*` for the own place.
"""

from __future__ import annotations

import math
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cairnlake.llm.prefix_sums import sums_before
from cairnlake.llm.shared import written

ARITY = 3
LEVELS = 6
OWN = "*"

#: Rows of a partition are numbered from 0 in the low bits, partitions in the high ones.
_ROW_BITS = 33
_NODE = "tree long, at long, size long, digest string"
_OUTER = "tree long, at long, steps array<string>, subroot string"
_PROVED = "shown string, source string, leaf string, subroot string, proof array<string>, folded_root string"


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def leaf_of(*fields: Column) -> Column:
    """SHA-256 of the fields: each its UTF-8 byte count, `:` and the value, or `-` if null."""
    shown = [f.cast("string") for f in fields]
    shown = [F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-")) for s in shown]
    return F.sha2(F.concat(*shown).cast("binary"), 256)


def reduced(nodes: list[str], levels: int | None, arity: int = ARITY) -> list[list[str]]:
    """Nodes of each level from the given ones up: so many levels, or until one node is left."""
    out = [nodes]
    while len(nodes) > 1 if levels is None else len(out) <= levels:
        nodes = [digest("".join(nodes[i : i + arity])) for i in range(0, len(nodes), arity)]
        out.append(nodes)
    return out


def steps_of(levels: list[list[str]], place: int, arity: int = ARITY) -> list[str]:
    """From the node at `place` of the lowest level to the highest level's one node."""
    out = []
    for nodes in levels[:-1]:
        first = place - place % arity
        run = nodes[first : first + arity]
        run[place - first] = OWN
        out.append("".join(run))
        place //= arity
    return out


def folded(node: str, steps: list[str]) -> str:
    for step in steps:
        node = digest(step.replace(OWN, node))
    return node


def manifest(
    docs: DataFrame, key: str, source: str, fields: list[str], claimed: Column | None = None, levels: int = LEVELS
) -> DataFrame:
    """(key, source, leaf, subroot, root, proof, folded_root, verified) for each row of `docs`.

    A leaf digests the row's `fields` (see `leaf_of`). The leaves of a source are ordered by key; while
    several nodes remain, every ARITY consecutive ones become the digest of their digests, the last run
    also where it has fewer; what remains is the subroot (a lone leaf itself). Subroots, ordered by source
    (as UTF-8 bytes), give the root likewise. proof is the row's list of steps to the root; folded_root folds the digest
    `claimed` (a column of the rows; the leaf where it is null or not given) through it; verified: it is
    the root. Null sources and keys come first; rows of equal source and key are ordered by leaf. Rows
    that repeat are leaves each. key is an integer or a string. Columns other than those named are not read. An empty table gives an
    empty table. levels: a superblock has ARITY ** levels nodes.
    """
    span = ARITY**levels
    kinds = [docs.schema[c].dataType.simpleString() for c in (key, source)]
    rows = docs.select(
        F.col(key).cast("string").alias("shown"),
        F.col(key).alias("key"),
        F.col(source).cast("string").alias("source"),
        leaf_of(*(F.col(f) for f in fields)).alias("digest"),
        (F.lit(None) if claimed is None else claimed).cast("string").alias("claimed"),
    )
    # where all else is equal, rows can change places: their numbers let Spark cut between them
    leaves, trees = _placed(written(rows.withColumn("row", F.monotonically_increasing_id()), "leaves"))
    many, largest = trees.agg(F.count("*"), F.max("size")).first()
    below = _levels(leaves, largest or 0, levels)
    tops = below[-1].select(
        F.lit(0).cast("long").alias("tree"), F.col("tree").alias("at"), F.lit(many).cast("long").alias("size"), "digest"
    )
    above = _levels(written(tops, "subroots"), many, levels)

    # down again: the steps above each node, from the root on
    outer = above[-1].select("tree", "at", F.array().cast("array<string>").alias("steps"), F.lit("").alias("subroot"))
    for nodes in above[-2::-1]:
        outer = _met(nodes, outer, levels, _lowered(levels), _OUTER)
    subroots = below[-1].select("tree", F.col("digest").alias("subroot"))
    outer = outer.select(F.col("at").alias("tree"), F.lit(0).cast("long").alias("at"), "steps").join(subroots, "tree")
    for nodes in below[-2:0:-1]:
        outer = _met(nodes, outer, levels, _lowered(levels), _OUTER)
    found = _met(leaves, outer, levels, _proved(levels), _PROVED)
    root = above[-1].first()
    return found.withColumn("root", F.lit(root and root["digest"])).select(
        F.col("shown").cast(kinds[0]).alias(key),
        F.col("source").cast(kinds[1]).alias(source),
        "leaf",
        "subroot",
        "root",
        "proof",
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def _placed(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Leaves (tree, at, size, digest, shown, source, claimed), and trees (tree, source, size), both written.

    tree: the source's place among all sources; at: the leaf's place among the source's.
    """
    order = ["source", "key", "digest", "row"]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered = ordered.select("source", "shown", "digest", "claimed", F.monotonically_increasing_id().alias("number"))
    part = F.shiftright("number", _ROW_BITS)
    ordered = written(ordered, "ordered").withColumn("part", part)
    ordered = ordered.withColumn("inside", F.col("number") - F.shiftleft("part", _ROW_BITS)).drop("number")
    begins = sums_before(ordered.groupBy("part").agg(F.count("*").alias("rows")), "part", "rows")
    # a source's rows follow each other, so where its first row is tells all places
    runs = ordered.groupBy("part", "source").agg(F.min("inside").alias("inside"), F.count("*").alias("rows"))
    runs = runs.join(written(begins, "begins"), "part")
    runs = written(runs.select("part", "source", "before", (F.col("before") + F.col("inside")).alias("start"), "rows"), "runs")
    first = F.min(F.struct("start", "part")).alias("first")
    trees = runs.groupBy("source").agg(first, F.sum("rows").alias("size")).select("source", "first.*", "size")
    trees = written(trees, "trees")
    fresh = sums_before(trees.groupBy("part").agg(F.count("*").alias("n")), "part", "n")
    place = F.row_number().over(Window.partitionBy("part").orderBy("start")) - 1
    trees = trees.withColumn("place", place).join(written(fresh, "fresh"), "part")
    trees = written(trees.select((F.col("before") + F.col("place")).alias("tree"), "source", "start", "size"), "trees")
    r, t = runs.alias("r"), trees.alias("t")
    places = r.join(t, F.col("r.source").eqNullSafe(F.col("t.source")))
    places = places.select("part", F.col("r.source").alias("of"), "tree", "size", (F.col("before") - F.col("t.start")).alias("ahead"))
    o, p = ordered.alias("o"), written(places, "places").alias("p")
    leaves = o.join(p, (F.col("o.part") == F.col("p.part")) & F.col("source").eqNullSafe(F.col("of")))
    at = (F.col("ahead") + F.col("inside")).alias("at")
    return written(leaves.select("tree", at, "size", "digest", "shown", "source", "claimed"), "placed"), trees


def _levels(nodes: DataFrame, largest: int, levels: int) -> list[DataFrame]:
    """The nodes, the tops of their superblocks, the tops of those, up to one node for each tree."""
    out, span = [nodes], ARITY**levels

    def tops(block: pd.DataFrame) -> pd.DataFrame:
        rows = [
            (tree, at, -(-size // span), reduced(nodes.tolist(), None if size <= span else levels)[-1][0])
            for (tree, at, size), nodes in _superblocks(block, span)
        ]
        return pd.DataFrame(rows, columns=["tree", "at", "size", "digest"])

    while True:
        narrow = out[-1].select("tree", "at", "size", "digest")
        dealt = narrow.withColumn("block", _block(out[-1], F.floor(F.col("at") / span), span))
        out.append(written(dealt.groupBy("block").applyInPandas(tops, _NODE), "level"))
        if largest <= span:
            return out
        largest = -(-largest // span)


def _block(nodes: DataFrame, superblock: Column, span: int) -> Column:
    """The group of a superblock: about as many groups as it takes for SPAN nodes each."""
    groups = max(1, math.ceil(nodes.count() / span))
    return F.pmod(F.xxhash64("tree", superblock.cast("long")), F.lit(groups))


def _superblocks(block: pd.DataFrame, span: int):
    """((tree, place of the superblock, size of the tree), digests in order) of each superblock of a group."""
    block = block.sort_values(["tree", "at"])
    tree, at, size, nodes = (block[c].to_numpy() for c in ("tree", "at", "size", "digest"))
    at = at // span
    cuts = np.flatnonzero(np.r_[True, (tree[1:] != tree[:-1]) | (at[1:] != at[:-1]), True])
    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
        yield (int(tree[lo]), int(at[lo]), int(size[lo])), nodes[lo:hi]


def _met(nodes: DataFrame, outer: DataFrame, levels: int, function, schema: str) -> DataFrame:
    """Nodes cogrouped by superblock with the outer steps of the superblock's top, written."""
    span = ARITY**levels
    left = nodes.withColumn("block", _block(nodes, F.floor(F.col("at") / span), span))
    right = outer.withColumn("block", _block(nodes, F.col("at"), span))
    return written(left.groupBy("block").cogroup(right.groupBy("block")).applyInPandas(function, schema), "met")


def _joined(nodes: pd.DataFrame, outer: pd.DataFrame, levels: int):
    """(place in its tree, digest, steps to the root, subroot, tree) of each node of a group, in order."""
    span = ARITY**levels
    above = {(t, a): (list(s), r) for t, a, s, r in zip(outer["tree"], outer["at"], outer["steps"], outer["subroot"], strict=True)}
    for (tree, place, size), held in _superblocks(nodes, span):
        steps, subroot = above[tree, place]
        local = reduced(held.tolist(), None if size <= span else levels)
        for i, node in enumerate(local[0]):
            yield place * span + i, node, steps_of(local, i) + steps, subroot, tree


def _lowered(levels: int):
    def lowered(nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        rows = [(tree, at, steps, subroot) for at, _, steps, subroot, tree in _joined(nodes, outer, levels)]
        return pd.DataFrame(rows, columns=["tree", "at", "steps", "subroot"])

    return lowered


def _proved(levels: int):
    def proved(nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        nodes = nodes.sort_values(["tree", "at"])
        claims = [c if isinstance(c, str) else None for c in nodes["claimed"]]
        rows = [
            (leaf, subroot, steps, folded(claim or leaf, steps))
            for claim, (_, leaf, steps, subroot, _) in zip(claims, _joined(nodes, outer, levels), strict=True)
        ]
        found = pd.DataFrame(rows, columns=["leaf", "subroot", "proof", "folded_root"])
        return found.assign(shown=nodes["shown"].to_numpy(), source=nodes["source"].to_numpy())

    return proved


def _sql(tampered: str = "replace(text, chr(10), '')") -> str:
    def leaf(text: str) -> str:
        shown = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
        return "sha256(" + " || ".join(f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in shown) + ")"

    def grown(name: str, leaves: str) -> str:
        return f"""{name} AS (
          SELECT tree, 0 AS lvl, place, digest FROM {leaves}
          UNION ALL
          SELECT tree, lvl + 1, place // 3, sha256(string_agg(digest, '' ORDER BY place))
          FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM {name}) WHERE n > 1
          GROUP BY tree, lvl, place // 3)"""

    def steps(leaves: str, nodes: str) -> str:
        return f"""
          SELECT l.doc, l.ahead + n.lvl AS step,
            coalesce(string_agg(n.digest, '' ORDER BY n.place) FILTER (n.place < l.place // (3 ** n.lvl)::BIGINT), '') AS before,
            coalesce(string_agg(n.digest, '' ORDER BY n.place) FILTER (n.place > l.place // (3 ** n.lvl)::BIGINT), '') AS after
          FROM {leaves} l JOIN {nodes} n
            ON n.tree = l.tree AND n.place // 3 = (l.place // (3 ** n.lvl)::BIGINT) // 3 AND n.lvl < l.height
          GROUP BY l.doc, l.ahead, n.lvl"""

    return f"""
    WITH RECURSIVE docs AS (
      SELECT *, {leaf("text")} AS digest, {leaf(tampered)} AS tampered,
        list_reduce(
          list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(doc_id::VARCHAR, ''),
            lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
          lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END
        ) & 1 = 1 AS even  -- the last step of a CRC-32 turns the bit
      FROM documents),
    trees AS (SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS tree FROM (SELECT DISTINCT source FROM docs)),
    leaves AS (
      SELECT d.*, row_number() OVER (ORDER BY doc_id) AS doc, tree,
        row_number() OVER (PARTITION BY tree ORDER BY doc_id) - 1 AS place
      FROM docs d JOIN trees t ON d.source IS NOT DISTINCT FROM t.source),
    {grown("nodes", "leaves")},
    heights AS (SELECT tree, max(lvl) AS height FROM nodes GROUP BY tree),
    tops AS (SELECT 0 AS tree, n.tree AS place, n.digest FROM nodes n JOIN heights h ON n.tree = h.tree AND n.lvl = h.height),
    {grown("upper", "tops")},
    summit AS (SELECT max(lvl) AS height FROM upper),
    inner_steps AS (SELECT l.doc, l.tree, l.place, 0 AS ahead, h.height FROM leaves l JOIN heights h USING (tree)),
    outer_steps AS (SELECT l.doc, 0 AS tree, l.tree AS place, h.height AS ahead, s.height FROM leaves l JOIN heights h USING (tree), summit s),
    steps AS ({steps("inner_steps", "nodes")} UNION ALL {steps("outer_steps", "upper")}),
    folds AS (
      SELECT doc, 0 AS step, CASE WHEN even THEN tampered ELSE digest END AS digest FROM leaves
      UNION ALL
      SELECT f.doc, f.step + 1, sha256(before || digest || after) FROM folds f JOIN steps s ON f.doc = s.doc AND f.step = s.step),
    last AS (SELECT doc, arg_max(digest, step) AS folded_root FROM folds GROUP BY doc),
    proofs AS (SELECT doc, string_agg(before || after, '' ORDER BY step) AS siblings FROM steps GROUP BY doc)
    SELECT doc_id, leaves.digest AS leaf, tops.digest AS subroot, r.digest AS root,
      sha256(coalesce(siblings, '')) AS proof_sha256, folded_root, folded_root = r.digest AS verified
    FROM leaves JOIN tops ON leaves.tree = tops.place JOIN last USING (doc) LEFT JOIN proofs USING (doc),
      (SELECT arg_max(digest, lvl) AS digest FROM upper) r
    """


OP13_SQL = _sql()


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    tampered = F.translate("text", "\n", "")
    tampered = leaf_of(*(tampered if f == "text" else F.col(f) for f in fields))
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    found = manifest(docs, "doc_id", "source", fields, claimed=F.when(even, tampered))
    siblings = F.translate(F.array_join("proof", ""), OWN, "")
    return found.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(siblings.cast("binary"), 256).alias("proof_sha256"), "folded_root", "verified"
    )
