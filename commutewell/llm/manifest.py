"""Merkle manifest of a dataset, with proofs by pointer jumping.

1. Every row is a leaf. Rows are dealt to key ranges, so a leaf's position in its language's tree is the size of
   the ranges before its own plus its place in it; no window holds a language.
2. Trees are built ``SPAN`` levels at a time, from runs of ``2 ** SPAN`` digests. The subroots are the leaves of
   one more tree over the languages.
3. Every node starts with the segment of its own siblings and a pointer to its parent. A self-join with the nodes
   pointed at appends their segments and takes over their pointers, which doubles the distance, until every leaf
   points at the root. Nodes that no later join needs are left out: after the distance 2^k only levels divisible
   by 2^(k+1) go on.
4. A proof is folded from its leaf upwards and compared with the root.

Defined results: NULL values are hashed as ``-``; rows without an id come first in their tree and are never
tampered with; rows with one id lie in the order of their leaves, and equal rows have equal leaves, so their order
changes nothing; a tampered NULL ``n_chars`` stays NULL, and that row verifies; an empty table gives an empty
result; columns other than those hashed are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from commutewell.llm.common import stored

SPAN = 10  # levels of a tree that are built from one run of digests
TAMPER = 7  # of so many ids one is tampered with, by the checksum of the id
BROADCAST = 8 << 20  # bytes of nodes ahead that may be copied to every executor; more are shuffled
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf(*values: Column) -> Column:
    """Digest of a row: each value by its length in bytes, a colon and itself; ``-`` for NULL."""
    written = []
    for value in values:
        text = value.cast("string")
        written.append(F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)))
    return F.unhex(F.sha2(F.concat(*written).cast("binary"), 256))


def positioned(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` with their place ``pos`` among those of their ``tree`` by ``order``, and the size ``n`` of the tree."""
    spread = rows.withColumn("spread", F.monotonically_increasing_id())  # equal rows need not meet in one range
    keys = ["tree", *order, "spread"]
    ranged = spread.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("spread")
    ranged = stored(ranged.withColumn("at", F.monotonically_increasing_id()), name)
    part = F.shiftright("at", 33).alias("part")
    parts = ranged.groupBy("tree", part).agg(F.min("at").alias("first"), F.count("*").alias("size"))
    whole = Window.partitionBy("tree")  # one row per range of a tree
    before = F.sum("size").over(whole.orderBy("part")) - F.col("size")
    parts = parts.select("tree", "part", (F.col("first") - before).alias("shift"), F.sum("size").over(whole).alias("n"))
    placed = ranged.withColumn("part", part).join(parts, ["tree", "part"])
    return placed.withColumn("pos", F.col("at") - F.col("shift")).drop("part", "at", "shift")


def _height(n: int) -> int:
    return (n - 1).bit_length()


def tree_levels(leaves: DataFrame, height: int, name: str) -> tuple[DataFrame, DataFrame]:
    """Nodes (tree, level, pos, left, right) below the roots, and the roots (tree, digest).

    ``left`` or ``right`` is the sibling's digest; a node that is alone in its run has neither.
    """
    schema = "tree string, n long, level int, pos long, left binary, right binary, digest binary"
    names = [f.split()[0] for f in schema.split(", ")]
    types = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]

    def climber(base: int):
        def climb(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for tree, n, run, block in zip(*(batch.column(i).to_pylist() for i in range(4))):
                    rows = []
                    nodes = [x["digest"] for x in run]
                    steps = min(SPAN, _height(n) - base)
                    for step in range(steps):
                        first, last = block << (SPAN - step), len(nodes) - 1
                        rows += [
                            (tree, n, base + step, first + i, nodes[i - 1] if i % 2 else None, nodes[i + 1] if i % 2 == 0 and i < last else None, None)
                            for i in range(len(nodes))
                        ]
                        nodes = [hashlib.sha256("".join(x.hex() for x in nodes[i : i + 2]).encode()).digest() for i in range(0, len(nodes), 2)]
                    rows.append((tree, n, base + steps, block, None, None, nodes[0]))
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

        return climb

    current = leaves.select("tree", "n", "pos", "digest")
    built, roots = [], []
    for base in range(0, max(height, 1), SPAN):
        runs = current.groupBy("tree", "n", F.shiftright("pos", SPAN).alias("block")).agg(
            F.array_sort(F.collect_list(F.struct("pos", "digest"))).alias("run")
        )
        out = stored(runs.select("tree", "n", "run", "block").mapInArrow(climber(base), schema), f"{name}-levels")
        built.append(out.filter("digest IS NULL").select("tree", "level", "pos", "left", "right"))
        tops = out.filter("digest IS NOT NULL")
        done = F.col("n") <= F.shiftleft(F.lit(1).cast("long"), base + SPAN)
        roots.append(tops.filter(done).select("tree", "digest"))
        current = tops.filter(~done).select("tree", "n", "pos", "digest")
    return reduce(DataFrame.unionByName, built), reduce(DataFrame.unionByName, roots)


def _ahead(nodes: DataFrame, rows: int, distance: int) -> DataFrame:
    """``nodes``, broadcast where ``rows`` of them with so many siblings take few bytes.

    High levels have few nodes, each ahead of very many leaves: a shuffle would deal these to few tasks.
    """
    return F.broadcast(nodes) if rows * (70 * distance + 100) <= BROADCAST else nodes


def jump(nodes: DataFrame, items: DataFrame, n_leaves: int, n_trees: int, height: int, name: str) -> DataFrame:
    """``items`` (tree, pos, item) of the leaves with ``path``, the siblings up to their root as (left, right).

    ``n_leaves`` leaves stand in ``n_trees`` trees of up to ``height`` levels.
    """
    own = F.array(F.struct("left", "right")).alias("path")
    up = [(F.col("level") + 1).alias("up_level"), F.shiftright("pos", 1).alias("up_pos")]
    inner = nodes.filter("level > 0").select("tree", "level", "pos", *up, own)
    none = F.filter(own, lambda x: F.lit(False))
    leaves = items.join(nodes.filter("level = 0"), ["tree", "pos"], "left").select(
        "tree", "pos", "item", F.lit(1).alias("up_level"), F.shiftright("pos", 1).alias("up_pos"),
        F.when(F.col("level").isNotNull(), own).otherwise(none).alias("path"),
    )
    distance = 1
    while distance < height:
        ahead = inner.filter(F.col("level") % (2 * distance) == distance).select(
            "tree", F.col("level").alias("up_level"), F.col("pos").alias("up_pos"),
            F.col("up_level").alias("far_level"), F.col("up_pos").alias("far_pos"), F.col("path").alias("more"),
        )

        def joined(rows: DataFrame, ahead: DataFrame) -> DataFrame:
            rows = rows.join(ahead, ["tree", "up_level", "up_pos"], "left")
            return rows.withColumns(
                {
                    "path": F.when(F.col("more").isNull(), F.col("path")).otherwise(F.concat("path", "more")),
                    "up_level": F.coalesce("far_level", "up_level"),
                    "up_pos": F.coalesce("far_pos", "up_pos"),
                }
            ).drop("far_level", "far_pos", "more")

        leaves = joined(leaves, _ahead(ahead.filter(F.col("up_level") == distance), (n_leaves >> distance) + n_trees, distance))
        inner = stored(joined(inner.filter(F.col("level") % (2 * distance) == 0), ahead), f"{name}-{distance}")  # read twice
        distance *= 2
    return leaves.select("tree", "pos", "item", "path")


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def siblings(path: Column) -> Column:
    """The digests of a path, one after another."""
    return F.array_join(F.transform(path, lambda s: F.coalesce(_hex(s["left"]), _hex(s["right"]), F.lit(""))), "")


def folded(start: Column, path: Column) -> Column:
    """The root that ``path`` leads to from the digest ``start``."""

    def parent(node: Column, s: Column) -> Column:
        both = F.concat(F.coalesce(_hex(s["left"]), F.lit("")), node, F.coalesce(_hex(s["right"]), F.lit("")))
        return F.sha2(both.cast("binary"), 256)

    return F.aggregate(path, _hex(start), parent)


def proved(rows: DataFrame, tree: Column, order: list[str], digest: str) -> DataFrame:
    """Every row as ``item`` with its ``tree``, subroot, root and the path from its leaf ``digest`` to the root.

    ``tree`` must not be NULL; the trees' roots are joined in the order of their names.
    """
    by = [f"by_{i}" for i in range(len(order))]
    leaves = rows.select(tree.alias("tree"), *[F.col(c).alias(b) for c, b in zip(order, by)], F.col(digest).alias("digest"), F.struct("*").alias("item"))
    leaves = stored(positioned(leaves, by, "leaves"), "positions")
    n_leaves, widest, n_trees = leaves.agg(F.count("*"), F.max("n"), F.count_if(F.col("pos") == 0)).first()
    nodes, subroots = tree_levels(leaves, _height(widest or 1), "tree")
    paths = jump(nodes, leaves.select("tree", "pos", "item"), n_leaves, n_trees, _height(widest or 1), "path")

    trees = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
    trees = stored(positioned(trees, ["name"], "trees"), "tree-positions")
    nodes, root = tree_levels(trees, _height(n_trees or 1), "top")
    tops = jump(nodes, trees.select("tree", "pos", F.struct("name", "digest").alias("item")), n_trees, 1, _height(n_trees or 1), "top-path")
    tops = tops.join(root.withColumnRenamed("digest", "root"), "tree").select(
        F.col("item.name").alias("tree"), F.col("item.digest").alias("subroot"), "root", F.col("path").alias("top")
    )
    tops = _ahead(tops, n_trees, _height(n_trees or 1) + 2)
    return paths.join(tops, "tree").select("tree", "item", "subroot", "root", F.concat("path", "top").alias("path"))


def manifest(docs: DataFrame) -> DataFrame:
    """Leaf, subroot, root and proof of every row of ``docs``, and whether the row as found later verifies."""
    col = {c: F.col(c) for c in FIELDS}
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPER == 0, F.lit(False)) & F.col("n_chars").isNotNull()
    leaf_of = leaf(*col.values())
    changed = leaf(*(col | {"n_chars": F.col("n_chars") + 1}).values())
    rows = docs.select(
        "doc_id", F.coalesce(F.concat(F.lit("="), "lang"), F.lit("-")).alias("lang_key"), leaf_of.alias("leaf"),
        F.when(hit, changed).alias("tampered"),
    )
    rows = stored(rows, "hashed")  # sampling for the ranges must not hash every text again
    proofs = proved(rows, F.col("lang_key"), ["doc_id", "leaf"], "leaf")
    found = F.coalesce("item.tampered", "item.leaf")
    return proofs.select(
        "item.doc_id",
        _hex(F.col("item.leaf")).alias("leaf"),
        _hex(F.col("subroot")).alias("subroot"),
        _hex(F.col("root")).alias("root"),
        F.sha2(siblings(F.col("path")).cast("binary"), 256).alias("proof_sha256"),
        folded(found, F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
