"""Merkle manifest of a table: every row a leaf, a tree for each source, and one over the sources.

Slot pivot: a level of a tree is one grouping by parent, whose conditional aggregates spread
the children into as many columns as the fanout. The columns joined give the parent's
digest; joined without a child's own column, to its left and to its right, they give the
child's siblings. Levels are climbed from the leaves to the roots, and walked down again
with the siblings gathered on the way, so every leaf ends with its whole proof.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pacewatch.llm.common import fold, lower_ascii, only, settled

#: Children of a node.
FANOUT = 16
#: Rows whose id's crc32 this divides are tampered with.
TAMPERED = 5
_SIDES = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the parts joined."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def encoded(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaves(docs: DataFrame) -> DataFrame:
    """(tree, doc_id, leaf, tampered) of every row; ``tampered`` only where the row is tampered with.

    ``tree`` names the source: empty for null, else ``=`` and the source, so that null comes
    first and the order is that of the bytes.
    """
    rows = only(docs, doc_id="long", source="string", lang="string", n_chars="long", text="string")
    before = F.concat(*(encoded(F.col(name)) for name in ("doc_id", "source", "lang", "n_chars")))
    lowered = F.when(F.col("text").isNotNull(), lower_ascii(F.col("text")))
    return rows.select(
        F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("tree"),
        "doc_id",
        digest(before, encoded(F.col("text"))).alias("leaf"),
        F.when(fold(F.col("doc_id"), TAMPERED) == 0, digest(before, encoded(lowered))).alias("tampered"),
    )


def numbered(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` (with column ``tree``) and ``i``, their place in their tree from 0, and ``n``, the tree's size.

    Rows are cut into ranges of (tree, order), numbered within each, and moved on by what
    the ranges before hold of the same tree. A tree of any size is spread over ranges, and
    so are equal rows, by a salt. What is windowed by tree is one row a range.
    """
    salted = rows.withColumn("salt", F.monotonically_increasing_id())
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = settled(salted.repartitionByRange(parts, "tree", *order, "salt").withColumn("part", F.spark_partition_id()))
    sizes = ranged.groupBy("tree", "part").agg(F.count(F.lit(1)).alias("size"))
    tree = Window.partitionBy("tree")
    earlier = tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "tree", "part", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("offset"), F.sum("size").over(tree).alias("n")
    )
    here = F.row_number().over(Window.partitionBy("tree", "part").orderBy(*order, "salt")) - 1
    return ranged.withColumn("here", here).join(offsets, ["tree", "part"]).withColumn("i", F.col("here") + F.col("offset")).drop(
        "salt", "part", "here", "offset"
    )


def _slots() -> list[str]:
    return [f"s{k}" for k in range(FANOUT)]


def _hash(slot: str) -> Column:
    return F.coalesce(F.col(f"{slot}.hash"), F.lit(""))


def climb(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Levels of all trees at once, and their roots (tree, root).

    ``nodes`` are (tree, i, n, hash, other columns); other columns stay beside a leaf's hash.
    A level holds (tree, i, n, s0, ...): parents, how many there are in the tree, and their
    children. A tree with one node left is done.
    """
    levels, roots = [], []
    largest = nodes.agg(F.max("n")).first()[0] or 0
    while True:
        roots.append(nodes.filter("n = 1").select("tree", F.col("hash").alias("root")))
        if largest <= 1:
            break
        kept = F.struct("hash", *(c for c in nodes.columns if c not in ("tree", "i", "n", "hash")))
        slot = F.pmod("i", F.lit(FANOUT))
        spread = [F.max(F.when(slot == k, kept)).alias(f"s{k}") for k in range(FANOUT)]
        up = F.expr(f"i div {FANOUT}").alias("i"), F.expr(f"(n + {FANOUT - 1}) div {FANOUT}").alias("n")
        above = nodes.filter("n > 1").groupBy("tree", *up)
        levels.append(settled(above.agg(*spread)))
        nodes = levels[-1].select("tree", "i", "n", digest(*map(_hash, _slots())).alias("hash"))
        largest = -(-largest // FANOUT)
    return levels, settled(reduce(DataFrame.unionByName, roots))


def _children(level: DataFrame, *more: Column) -> DataFrame:
    """A row for each child of a level's nodes: (tree, i, node, sides, ...), siblings nearest first in ``sides``."""
    names = _slots()
    slots = [
        F.struct(
            F.lit(k).cast("long").alias("slot"),
            F.col(name).alias("node"),
            F.concat(*(map(_hash, names[:k])), F.lit("")).alias("left"),
            F.concat(*(map(_hash, names[k + 1 :])), F.lit("")).alias("right"),
        )
        for k, name in enumerate(names)
    ]
    rows = level.select("tree", "i", "sides", *more, F.explode(F.array(*slots)).alias("child")).filter("child.node is not null")
    own = F.array(F.struct("child.left", "child.right"))
    return rows.select("tree", (F.col("i") * FANOUT + F.col("child.slot")).alias("i"), "child.node", F.concat(own, "sides").alias("sides"), *more)


def descend(levels: list[DataFrame], tops: DataFrame, *more: str) -> DataFrame:
    """(tree, i, node, sides, ...) of every leaf below a root; ``tops`` has (tree, sides, ...) of the roots."""
    extra = [F.col(name) for name in more]
    below = last = None
    for level in reversed(levels):
        carried = level.filter("n = 1").join(tops, "tree")
        if below is not None:
            carried = carried.unionByName(level.filter("n > 1").join(below, ["tree", "i"]))
        below = _children(carried, *extra)
        last = below
        below = below.select("tree", "i", "sides", *more)
    return last


def folded(start: Column, sides: Column) -> Column:
    """Root that follows from a leaf and its siblings."""
    return F.aggregate(sides, start, lambda held, side: digest(side["left"], held, side["right"]))


def manifest(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row.

    A leaf is the digest of doc_id, source, lang, n_chars and text. Each source's leaves,
    ascending by doc_id (nulls first, equal ids by leaf), are hashed up in runs of sixteen
    to a subroot, and the subroots in order of source, null first, to the root.
    ``proof_sha256`` is the digest of a leaf's siblings from the leaf's level up. Where 5
    divides the id's crc32 (a null id counts as empty text) the text's A-Z are lower-cased
    before the root is folded again from leaf and siblings, and ``verified`` tells whether it
    is the root.

    Null and empty texts are leaves of their own kind; a repeated row is a leaf each time it
    stands there. Other columns are not read. An empty table gives no rows.

    Texts are read once and never shuffled: what moves is digests, in groups of sixteen.
    """
    made = settled(leaves(docs))
    nodes = settled(numbered(made, "doc_id", "leaf").withColumnRenamed("leaf", "hash"))
    levels, subroots = climb(nodes)
    named = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("source"), F.col("root").alias("hash"))
    over = settled(numbered(named, "source"))
    over_levels, top = climb(over)
    root = top.first()
    if root is None:
        return made.select("doc_id", "leaf", *(F.lit("").alias(x) for x in ("subroot", "root", "proof_sha256", "folded_root")), F.lit(True).alias("verified"))
    nothing = F.array().cast(_SIDES).alias("sides")
    tops = over.filter("n = 1").select(F.col("source").alias("tree"), F.col("hash").alias("subroot"), nothing)
    if over_levels:
        below = descend(over_levels, top.select("tree", nothing))
        tops = below.select(F.col("node.source").alias("tree"), F.col("node.hash").alias("subroot"), "sides")
    tops = settled(tops)
    every = nodes.filter("n = 1").join(tops, "tree").select("doc_id", F.col("hash").alias("leaf"), "tampered", "sides", "subroot")
    if levels:
        found = descend(levels, tops, "subroot")
        every = every.unionByName(found.select("node.doc_id", F.col("node.hash").alias("leaf"), "node.tampered", "sides", "subroot"))
    siblings = F.array_join(F.transform("sides", lambda side: F.concat(side["left"], side["right"])), "")
    proved = every.select(
        "doc_id",
        "leaf",
        "subroot",
        F.lit(root["root"]).alias("root"),
        digest(siblings).alias("proof_sha256"),
        folded(F.coalesce("tampered", "leaf"), F.col("sides")).alias("folded_root"),
    )
    return proved.withColumn("verified", F.col("folded_root") == F.col("root"))
