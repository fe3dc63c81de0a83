"""Merkle manifest of a table: one tree per group, one tree over the groups' roots, a proof per row.

A node is (tree, i, n, hash): its tree, its place on its level, the level's size and
a digest. On each level the nodes at slot zero of their run ask for the places of
their siblings, which are computed from their own: ``i XOR 1`` in binary trees, else
the slot shifted by 1, 2, ... within the run. One equijoin of the level with itself
answers, and the slot-zero rows, which then hold the digests of their run, emit the
parents. Each level is written once as its runs, so the levels above and the proofs
start from plain tables; the siblings of any node are read off its run by slot.

Proofs come back from the root: a run takes over the path of the node it has become,
one join of runs with runs per level, and at the end each leaf takes the path of its
run. A row's folded root is its (claimed) leaf hashed upwards along the path.

Places inside a group come from ranges, not from a window over the group: the rows
are dealt by range, numbered inside each range, and shifted by the sizes of the
ranges before. A group of any size is spread over all tasks.

Digests are hashed as hex text and kept as bytes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import checkpointed

ARITY = 8


def digest(*parts: Column | str) -> Column:
    """SHA-256 of texts one behind the other, as bytes."""
    return F.unhex(F.sha2(F.concat(*parts), 256))


def shown(digest: Column | str) -> Column:
    """A digest as lowercase hex text."""
    return F.lower(F.hex(digest))


def joined(digests: Column) -> Column:
    """The hex texts of several digests one behind the other."""
    return F.array_join(F.transform(digests, shown), "")


def framed(value: Column) -> Column:
    """A value with its UTF-8 length before it, so that no two rows read alike; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def numbered(rows: DataFrame, group: str, *order: str) -> DataFrame:
    """``rows`` with i, a row's place in its group from 0, and n, the group's size.

    Equal rows take places in any order. ``rows`` should be a written table: it is
    read once for the ranges' bounds and once to be dealt.
    """
    keys = [group, *order, "_tie"]
    dealt = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    dealt = checkpointed(dealt.withColumn("_at", F.monotonically_increasing_id()).drop("_tie"), "numbered")
    # The upper bits of _at are the range.
    dealt = dealt.withColumn("_range", F.shiftright("_at", 33))
    sizes = dealt.groupBy(group, "_range").agg(F.count("*").alias("_size"), F.min("_at").alias("_first"))
    of_group = W.partitionBy(group)
    before = F.sum("_size").over(of_group.orderBy("_range")) - F.col("_size")
    starts = sizes.select(group, "_range", (before - F.col("_first")).alias("_shift"), F.sum("_size").over(of_group).alias("n"))
    placed = dealt.join(starts, [group, "_range"])
    return placed.withColumn("i", F.col("_at") + F.col("_shift")).drop("_at", "_range", "_shift")


def _runs(nodes: DataFrame, arity: int) -> DataFrame:
    """(tree, i, n, run): the nodes at slot zero with the digests of their whole run, themselves first."""
    shifts = F.explode(F.array(*[F.lit(k).cast("bigint") for k in range(arity)])).alias("shift")
    asking = nodes.filter(F.col("i") % arity == 0).select("tree", "i", "n", shifts)
    sibling = F.col("i").bitwiseXOR(F.col("shift")) if arity == 2 else F.col("i") + F.col("shift")
    asked = nodes.select("tree", F.col("i").alias("sibling"), "hash")
    answers = asking.select("tree", "i", "n", sibling.alias("sibling")).join(asked, ["tree", "sibling"])
    run = F.sort_array(F.collect_list(F.struct("sibling", "hash")))["hash"]
    return answers.groupBy("tree", "i", "n").agg(run.alias("run"))


def grow(leaves: DataFrame, arity: int = ARITY) -> tuple[list[DataFrame], DataFrame]:
    """All levels of all trees over (tree, i, n, hash), and the roots as (tree, height, hash).

    ``levels[h]`` has (tree, up, run): the runs of the nodes of height h, under the
    place of the parent they become.
    """
    levels: list[DataFrame] = []
    roots: list[DataFrame] = []
    nodes = leaves
    largest = leaves.agg(F.max("n")).first()[0] or 0
    while True:
        roots.append(nodes.filter("n = 1").select("tree", F.lit(len(levels)).alias("height"), "hash"))
        if largest <= 1:
            break
        runs = _runs(nodes.filter("n > 1"), arity).select(
            "tree", F.expr(f"i div {arity}").alias("up"), F.expr(f"(n + {arity - 1}) div {arity}").alias("n"), "run"
        )
        runs = checkpointed(runs, f"level-{len(levels)}")
        levels.append(runs.drop("n"))
        nodes = runs.select("tree", F.col("up").alias("i"), "n", digest(joined(F.col("run"))).alias("hash"))
        largest = -(-largest // arity)
    every = roots[0]
    for some in roots[1:]:
        every = every.unionByName(some)
    return levels, checkpointed(every, "roots")


STEP = "struct<run: array<binary>, slot: bigint>"


def _step(place: Column, arity: int) -> Column:
    """A node's run and its slot in it, in front of the way from there to the root."""
    return F.concat(F.array(F.struct("run", (place % arity).alias("slot"))), F.col("way"))


def with_ways(leaves: DataFrame, levels: Sequence[DataFrame], roots: DataFrame, arity: int = ARITY) -> DataFrame:
    """``leaves`` with ``way``: per level the node's run and its slot in it, from the leaf to the root.

    ``roots`` has (tree, height, way), the way on from each tree's root.
    """

    def tops(height: int) -> DataFrame:
        return roots.filter(F.col("height") == height).select("tree", F.lit(0).cast("bigint").alias("up"), "way")

    above = tops(len(levels))
    for height in reversed(range(len(levels))):
        # The way of the runs of this height: that of the nodes they become.
        runs = levels[height].join(above, ["tree", "up"])
        if height:
            below = levels[height - 1].select("tree", F.col("up").alias("i")).withColumn("up", F.expr(f"i div {arity}"))
            members = below.join(runs, ["tree", "up"]).select("tree", F.col("i").alias("up"), _step(F.col("i"), arity).alias("way"))
            above = members.unionByName(tops(height))
    if not levels:
        return leaves.join(above.drop("up"), "tree")
    placed = leaves.withColumn("up", F.expr(f"i div {arity}"))
    many = placed.filter("n > 1").join(runs, ["tree", "up"]).withColumn("way", _step(F.col("i"), arity)).drop("run", "up")
    alone = leaves.filter("n = 1").join(tops(0).drop("up"), "tree")
    return many.unionByName(alone)


def manifest(
    docs: DataFrame,
    fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    group_col: str = "lang",
    id_col: str = "doc_id",
    arity: int = ARITY,
    claimed: dict[str, Column] | None = None,
) -> DataFrame:
    """Per row: doc_id, leaf, subroot, root, path, folded_root and verified.

    A leaf is the digest of the row's ``fields``. Rows of one ``group_col`` (null is a
    group of its own, the first) are the leaves of one tree, by id and among equal ids
    by digest; null ids come first. Runs of ``arity`` nodes become one. The
    groups' roots, in the order of the groups' bytes, are the leaves of the last tree.
    A path is an array of (left, right): the siblings of each level as hex text.
    ``claimed`` gives other values for some fields: folded_root is made from the leaf of
    these and the true path, and ``verified`` says whether it is the root.

    Repeated rows are leaves each, and each gets its own path; a group of one row has
    its leaf as subroot; one group alone has its subroot as root. A null field differs
    from an empty one. Columns that are not named are not read. An empty table gives
    no rows.
    """
    group = F.col(group_col).cast("string")
    leaf = digest(*[framed(F.col(f)) for f in fields])
    told = digest(*[framed(claimed.get(f, F.col(f))) for f in fields]) if claimed else leaf
    hashed = docs.select(
        # "" is the null group, and the first.
        F.coalesce(F.concat(F.lit("="), group), F.lit("")).alias("tree"),
        F.col(id_col).cast("bigint").alias("doc_id"),
        leaf.alias("hash"),
        told.alias("told"),
    )
    # A claim that is true needs no second digest.
    hashed = hashed.withColumn("told", F.when(F.col("told") != F.col("hash"), F.col("told")))
    leaves = checkpointed(numbered(checkpointed(hashed, "hashed"), "tree", "doc_id", "hash"), "leaves")
    levels, subroots = grow(leaves.select("tree", "i", "n", "hash"), arity)

    one = subroots.select(F.lit("").alias("all"), F.col("tree").alias("name"), "height", "hash")
    groups = checkpointed(numbered(one, "all", "name").withColumnRenamed("all", "tree"), "groups")
    high, root = grow(groups.select("tree", "i", "n", "hash"), arity)
    end = root.withColumn("way", F.array().cast(f"array<{STEP}>"))
    subtrees = with_ways(groups, high, end, arity).select(F.col("name").alias("tree"), "height", "way", F.col("hash").alias("subroot"))
    subtrees = checkpointed(subtrees, "subtrees")

    proven = with_ways(leaves, levels, subtrees.select("tree", "height", "way"), arity).join(subtrees.select("tree", "subroot"), "tree")

    def sides(step: Column) -> Column:
        left = F.slice(step["run"], 1, step["slot"].cast("int"))
        right = F.slice(step["run"], (step["slot"] + 2).cast("int"), arity)
        return F.struct(joined(left).alias("left"), joined(right).alias("right"))

    rows = proven.select(
        "doc_id",
        shown("hash").alias("leaf"),
        shown("subroot").alias("subroot"),
        # One row; null only where there is no row at all.
        shown(root.select("hash").scalar()).alias("root"),
        F.transform("way", sides).alias("path"),
        shown(F.coalesce("told", "hash")).alias("_told"),
    )
    folded = F.aggregate("path", F.col("_told"), lambda at, step: F.sha2(F.concat(step["left"], at, step["right"]), 256))
    out = rows.withColumn("folded_root", folded).drop("_told")
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def proof_digest(path: Column | str) -> Column:
    """One digest over all siblings of a path, from the leaf to the root and from left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), ""), 256)
