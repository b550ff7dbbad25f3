"""Merkle manifest of a dataset by nested structs (operator 11).

The leaves of a group stand in order; their rank in base ``FAN`` has a digit for each level of the
tree. Within blocks of ``FAN ** LEVELS`` leaves the digits are grouped away one after the other: the
nodes of a run become one row, which nests their structs and holds their hash. What is left is one
row a block with its whole tree inside. The roots of blocks are the leaves of the next round, so a
group of any size takes a few rounds. On the way back a block gets the path above it (one row a
block), and one nested transform and an explode give every leaf its whole path: no leaf is joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.session import materialize

FAN = 8
#: Levels of a block: 4096 leaves.
LEVELS = 4
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: monotonically_increasing_id counts below this within a partition.
PARTITION_BITS = 33
PATH = "array<struct<before:string,after:string>>"


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def field(value: Column) -> Column:
    """``-`` for null, else the byte count, a colon and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(columns: list[Column]) -> Column:
    return digest(F.concat(*[field(c) for c in columns]))


def ranked(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Adds ``rank`` (from 0 by ``order`` within the group) and ``depth`` (levels of the group's tree).

    Rows are dealt to ranges and sorted once; a row's place in its range, less that of the group's
    first row there, plus the rows of the ranges before, is its rank. So no group has to fit in a task.
    Equal rows are told apart by ``row``.
    """
    dealt = rows.repartitionByRange(group, *order, "row").sortWithinPartitions(group, *order, "row")
    placed = materialize(dealt.withColumn("__at", F.monotonically_increasing_id()).drop("row"), "placed")
    part = F.shiftright("__at", PARTITION_BITS)
    starts = placed.groupBy(F.col(group).alias("__g"), part.alias("__part")).agg(F.count("*").alias("n"), F.min("__at").alias("__first"))
    # At most one row for each range that holds a part of the group.
    before = Window.partitionBy("__g").orderBy("__part")
    starts = starts.select(
        "__g", "__part", "__first",
        (F.sum("n").over(before) - F.col("n")).alias("__base"),
        F.sum("n").over(Window.partitionBy("__g")).alias("__n"),
    )
    starts = materialize(starts, "starts")
    joined = placed.join(starts, (F.col(group) == F.col("__g")) & (part == F.col("__part")))
    depth = sum(((F.col("__n") > FAN**k).cast("int") for k in range(1, 21)), (F.col("__n") > 1).cast("int"))
    return joined.select(*[c for c in placed.columns if c != "__at"], (F.col("__at") - F.col("__first") + F.col("__base")).alias("rank"), depth.alias("depth"))


def nested(nodes: DataFrame, levels: int = LEVELS) -> DataFrame:
    """(g, block, depth, hash, tree): one row a block of ``nodes`` (g, rank, depth, hash, item)."""
    digits = [F.pmod(F.shiftright("rank", 3 * k), F.lit(FAN)).cast("int").alias(f"d{k}") for k in range(levels)]
    held = nodes.select("g", "depth", F.shiftright("rank", 3 * levels).alias("block"), *digits, F.struct("hash", "item").alias("node"))
    held = held.repartition("g", "block")  # every grouping below finds its rows here
    for k in range(levels):
        left = [f"d{j}" for j in range(k + 1, levels)]
        run = F.sort_array(F.collect_list(F.struct(F.col(f"d{k}").alias("digit"), "node"))).alias("run")
        held = held.groupBy("g", "block", "depth", *left).agg(run)
        parts = F.transform("run", lambda c: c["node"])
        own = F.array_join(F.transform("run", lambda c: c["node"]["hash"]), "")
        # Above the group's root a lone node is handed on as it is.
        made = F.when(F.col("depth") > k, digest(own)).otherwise(own)
        held = held.select("g", "block", "depth", *left, F.struct(made.alias("hash"), parts.alias("item")).alias("node"))
    return held.select("g", "block", "depth", "node.hash", F.col("node.item").alias("tree"))


def siblings(run: Column, place: Column) -> Column:
    """The hashes before and after a node in its run."""
    hashes = F.transform(run, lambda c: c["hash"])
    return F.struct(
        F.array_join(F.slice(hashes, F.lit(1), place), "").alias("before"),
        F.array_join(F.slice(hashes, place + 2, F.lit(FAN)), "").alias("after"),
    )


def leaves(tree: Column, depth: Column, above: Column, level: int = LEVELS) -> Column:
    """An array of (item, hash, path) of all leaves of a block's tree."""

    def step(place: Column) -> Column:
        return F.when(depth >= level, F.concat(F.array(siblings(tree, place)), above)).otherwise(above)

    if level == 1:
        return F.transform(tree, lambda c, k: F.struct(c["item"].alias("item"), c["hash"].alias("hash"), step(k).alias("path")))
    return F.flatten(F.transform(tree, lambda c, k: leaves(c["item"], depth, step(k), level - 1)))


def climbed(blocks: DataFrame) -> DataFrame:
    """(g, block, path, top): for every block of ``nested`` the path from its root to the group's."""
    blocks = blocks.select("g", "block", F.greatest(F.col("depth") - LEVELS, F.lit(0)).alias("depth"), "hash")
    if blocks.where("depth > 0").isEmpty():
        return blocks.select("g", "block", F.array().cast(PATH).alias("path"), F.col("hash").alias("top"))
    nodes = blocks.select("g", F.col("block").alias("rank"), "depth", "hash", F.struct("block").alias("item"))
    upper = materialize(nested(nodes), "upper")
    found = upper.join(climbed(upper).select("g", "block", F.col("path").alias("above"), "top"), ["g", "block"])
    out = found.select("g", "top", F.explode(leaves(F.col("tree"), F.col("depth"), F.col("above"))).alias("leaf"))
    return out.select("g", F.col("leaf.item.block").alias("block"), F.col("leaf.path").alias("path"), "top")


def folded(leaf: Column, path: Column) -> Column:
    return F.aggregate(path, leaf, lambda held, step: digest(F.concat(step["before"], held, step["after"])))


def manifest(
    docs: DataFrame,
    id_col: str = "doc_id",
    group_col: str = "lang",
    columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    tampered: dict[str, Column] | None = None,
) -> DataFrame:
    """Per row: the id, leaf, subroot, root, path (siblings from leaf to root), proof_sha256,
    folded_root and verified.

    A leaf is the hash of ``columns``. The leaves of each group, by id (null first, then by leaf), make
    a tree whose runs are ``FAN`` wide; the groups' roots, by group (null first, then bytewise), make
    another. ``proof_sha256`` is the hash of all siblings on the path. ``folded_root`` is worked out from the row's leaf after
    ``tampered`` (column name -> expression in its place, null for no change) and the stored siblings.
    Null is a group of its own; repeated rows are leaves of their own; a null id is never tampered with;
    an empty table stays empty. Other columns are not read.
    """
    values = [F.col(f"`{c}`") for c in columns]
    changed = {c: F.coalesce(e, F.col(f"`{c}`")) for c, e in (tampered or {}).items()}
    touched = F.lit(False)
    for expression in (tampered or {}).values():
        touched = touched | expression.isNotNull()
    group = F.concat(F.when(F.col(f"`{group_col}`").isNull(), "0").otherwise("1"), F.coalesce(F.col(f"`{group_col}`").cast("string"), F.lit("")))
    made = docs.select(
        F.col(f"`{id_col}`").alias("id"), group.alias("g"), leaf_hash(values).alias("hash"),
        F.when(touched, leaf_hash([changed.get(c, v) for c, v in zip(columns, values)])).alias("forged"),
        F.monotonically_increasing_id().alias("row"),
    )
    made = ranked(materialize(made, "leaves"), "g", ["id", "hash"])
    nodes = made.select("g", "rank", "depth", "hash", F.struct("id", "forged").alias("item"))
    blocks = materialize(nested(nodes), "blocks")
    upper = materialize(climbed(blocks), "paths")

    # The groups' roots are the leaves of one more tree.
    tops = upper.select("g", F.col("top").alias("hash")).distinct()
    tops = tops.select(F.lit("").alias("all"), F.col("g").alias("id"), "hash", F.lit(0).alias("row"))
    tops = ranked(tops, "all", ["id"]).select(F.col("all").alias("g"), "rank", "depth", "hash", F.struct("id").alias("item"))
    crown = materialize(nested(tops), "crown")
    crown = crown.join(climbed(crown).select("g", "block", F.col("path").alias("above"), F.col("top").alias("root")), ["g", "block"])
    crown = crown.select("root", F.explode(leaves(F.col("tree"), F.col("depth"), F.col("above"))).alias("leaf"))
    crown = materialize(crown.select("root", F.col("leaf.item.id").alias("g"), F.col("leaf.path").alias("crown")), "roots")

    above = upper.join(crown, "g").select("g", "block", F.concat("path", "crown").alias("above"), F.col("top").alias("subroot"), "root")
    rows = blocks.join(above, ["g", "block"])
    rows = rows.select("subroot", "root", F.explode(leaves(F.col("tree"), F.col("depth"), F.col("above"))).alias("leaf"))
    rows = rows.select(F.col("leaf.item.id").alias(id_col), F.col("leaf.hash").alias("leaf"), F.col("leaf.item.forged").alias("forged"), "subroot", "root", F.col("leaf.path").alias("path"))
    proof = digest(F.array_join(F.transform("path", lambda p: F.concat(p["before"], p["after"])), ""))
    again = folded(F.coalesce("forged", "leaf"), F.col("path"))
    out = rows.select(F.col(f"`{id_col}`"), "leaf", "subroot", "root", "path", proof.alias("proof_sha256"), again.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def lower_case(text: Column) -> Column:
    """A-Z in lower case, other letters as they are."""
    return F.translate(text, UPPER, LOWER)
