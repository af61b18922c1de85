"""Merkle manifest of a dataset, with levels held as concatenated hex strings.

Rows become leaves, one tree for each language, eight children to a node; the trees'
roots are the leaves of one more tree.  ``BLOCK`` leaves that lie side by side are one
row, which holds each of its levels as one string of hex digests.  A parent is the hash of
a substring of fixed width, and the siblings of a node are the two substrings beside
it, so no level is exploded, joined or sorted again.  The blocks' roots are the leaves of
the next round, ``BLOCK`` times fewer; their proofs come down to the blocks, not to
the rows.  Strings are kept as bytes, in which a substring costs nothing to reach.

A leaf's place in its tree is its place in a range-sorted table less where its tree starts
there, so a language that holds most rows is neither one group nor one window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.llm.common import partitions_for, stored

FANOUT = 8
DEPTH = 3  # levels of a block
BLOCK = FANOUT**DEPTH
HEX = 64  # digits of a digest
ROWS = 1 << 17  # leaves of a range
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def encoded(value: Column) -> Column:
    """The byte count, a colon and the value; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(value: Column) -> Column:
    """Lower-case hex of the SHA-256, as bytes."""
    return F.sha2(value, 256).cast("binary")


def leaf(df: DataFrame, text: Column) -> Column:
    return digest(F.concat(*(encoded(text if f == "text" else df[f]) for f in FIELDS)))


def placed(leaves: DataFrame, order: list[str]) -> DataFrame:
    """With ``pos``, a row's place from 0 among the rows of its ``tree``, in this order."""
    spark, part = leaves.sparkSession, F.shiftright("at", 33)
    rows = stored(leaves, "leaves")
    ranges = partitions_for(spark, rows.count(), ROWS)
    rows = rows.repartitionByRange(ranges, "tree", *order).sortWithinPartitions("tree", *order)
    rows = stored(rows.withColumn("at", F.monotonically_increasing_id()), "sorted").withColumn("part", part)
    # of each range, its rows by tree: as many as ranges and trees together
    runs = rows.groupBy("tree", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select("tree", "part", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"))
    return rows.join(runs, ["tree", "part"]).withColumn("pos", F.col("at") + F.col("shift")).drop("at", "part", "shift")


def parents(level: Column, more: Column) -> Column:
    """The next level of a block: hashes of its substrings of eight digests.

    One digest alone is hashed too if its tree has ``more`` blocks; else it is the root.
    """
    width = FANOUT * HEX
    starts = F.sequence(F.lit(0), F.floor((F.octet_length(level) - 1) / width).cast("int"))
    hashed = F.transform(starts, lambda k: digest(F.substring(level, k * width + 1, F.lit(width))).cast("string"))
    return F.when(more | (F.octet_length(level) > HEX), F.array_join(hashed, "").cast("binary")).otherwise(level)


def blocks(nodes: DataFrame) -> DataFrame:
    """(tree, block, more, l0 .. l3, rows): the levels of each aligned block of (tree, pos, node).

    ``rows`` holds what else the nodes carry, by place; ``more`` says that its tree has
    other blocks.
    """
    extra = [c for c in nodes.columns if c not in ("tree", "pos", "node")]
    item = F.struct("pos", "node", *extra)
    out = nodes.groupBy("tree", F.floor(F.col("pos") / BLOCK).alias("block")).agg(
        F.array_sort(F.collect_list(item)).alias("rows")
    )
    out = stored(out.withColumn("l0", F.array_join(F.transform("rows", lambda r: r["node"].cast("string")), "").cast("binary")), "blocks")
    trees = out.groupBy("tree").agg((F.count("*") > 1).alias("more"))
    out = out.join(trees, "tree")
    for k in range(DEPTH):
        out = out.withColumn(f"l{k + 1}", parents(F.col(f"l{k}"), F.col("more")))
    return out


def segments(k: Column) -> Column:
    """For leaf k of a block, level by level, the digests left and right of its node in the run."""
    levels = []
    for step in range(DEPTH):
        level, node = F.col(f"l{step}"), F.floor(k / FANOUT**step).cast("int")
        run = F.floor(node / FANOUT).cast("int") * FANOUT
        left = F.substring(level, run * HEX + 1, (node - run) * HEX)
        right = F.substring(level, (node + 1) * HEX + 1, (run + FANOUT - 1 - node) * HEX)
        here = F.col("more") | (F.octet_length(level) > HEX)
        levels.append(F.when(here, F.struct(left.alias("left"), right.alias("right"))))
    return F.array_compact(F.array(*levels))


def proved(nodes: DataFrame) -> DataFrame:
    """The (tree, pos, node, ...) with ``proof``, an array of (left, right), and the tree's ``root``."""
    held = stored(blocks(nodes), "levels")
    top = f"l{DEPTH}"
    if held.where("more").isEmpty():
        up = held.withColumn("root", F.col(top)).withColumn("above", F.expr("array()"))
    else:
        roots = held.select("tree", F.col("block").alias("pos"), F.col(top).alias("node"))
        roots = proved(roots).select("tree", F.col("pos").alias("block"), F.col("proof").alias("above"), "root")
        up = held.join(roots, ["tree", "block"])
    each = up.select("*", F.posexplode("rows").alias("k", "row")).drop("rows")
    return each.select("tree", "row.*", F.concat(segments(F.col("k")), F.col("above")).alias("proof"), "root")


def folded(node: Column, proof: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(proof, node, lambda h, s: digest(F.concat(s["left"], h, s["right"])))


def manifest(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof, checked_leaf, folded_root, verified.

    ``proof`` lists the siblings (left, right) of each level, first in the language's tree,
    then among the languages.  ``tampered`` is the text to check against the manifest, the
    documents' own by default; ``verified`` says that it leads to the root.  Nulls are
    leaves like others (encoded as ``-``), a null language is a tree of its own and comes
    first, null ids come first in a tree.  Rows with one id are ordered by their leaves,
    so repeated rows have one leaf each.  Without documents there are no rows.  Other
    columns are not read.
    """
    own = docs["text"]
    tree = F.coalesce(F.concat(F.lit("1"), docs["lang"].cast("string")), F.lit("0"))  # null first, then bytewise
    leaves = docs.select(
        tree.alias("tree"),
        docs["doc_id"].alias("doc_id"),
        leaf(docs, own).alias("node"),
        (leaf(docs, tampered) if tampered is not None else F.lit(None).cast("binary")).alias("other"),
    )
    rows = proved(placed(leaves, ["doc_id", "node"]))
    rows = stored(rows, "proofs")
    subroots = rows.groupBy("tree").agg(F.first("root").alias("node")).withColumn("lang", F.col("tree"))
    top = proved(placed(subroots.withColumn("tree", F.lit("")), ["lang"]))
    top = top.select(F.col("lang").alias("tree"), F.col("proof").alias("above"), F.col("root").alias("whole"))
    rows = rows.join(top, "tree").withColumn("proof", F.concat("proof", "above"))
    rows = rows.withColumn("checked_leaf", F.coalesce("other", "node"))
    rows = rows.withColumn("folded_root", folded(F.col("checked_leaf"), F.col("proof")))
    return rows.select(
        "doc_id",
        F.col("node").cast("string").alias("leaf"),
        F.col("root").cast("string").alias("subroot"),
        F.col("whole").cast("string").alias("root"),
        F.transform(
            "proof", lambda s: F.struct(s["left"].cast("string").alias("left"), s["right"].cast("string").alias("right"))
        ).alias("proof"),
        F.col("checked_leaf").cast("string").alias("checked_leaf"),
        F.col("folded_root").cast("string").alias("folded_root"),
        (F.col("folded_root") == F.col("whole")).alias("verified"),
    )


def proof_digest(proof: Column) -> Column:
    """Hash of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), ""), 256)
