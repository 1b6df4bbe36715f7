"""Merkle manifest of a table: a tree of hashes per group, one tree over the groups, and a proof for every row.

Each row is a leaf: the SHA-256 of its fields. Leaves of a group stand in the order of their ids; every ``FAN``
consecutive nodes become their parent until one node, the group's root, remains. The roots of all groups, in the
order of the groups, become the root of the whole table in the same way. The levels are written as node rows that
name their parent. ``climb`` is a recursive query over these rows: it starts at the leaves, goes from parent to
parent, appends the siblings met on the way and folds the hash of the (possibly tampered) leaf into that of its
run. Leaves of one run share all nodes above them, so they climb in one row, each with a fold of its own; what they
share travels once. Hashes are kept as 32 bytes and written as lowercase hex where they are hashed or returned.

A place in a group is the row's place in a part of a range-partitioned, written table plus the sizes of the parts
before it. No task holds a group, and only the sizes of the parts are brought together.

Defined results: a null field is hashed as ``-``. Null ids and null groups come first. Rows that are equal in all
fields are leaves of their own with neighbouring places; rows with one id are ordered by their leaf. A group of
one row has that leaf as its root, a table of one group has that group's root. An empty table gives no rows.
Extra columns are ignored, whatever they are called.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tierloom.llm.shared import store

FAN = 8
HASH = 32
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# The tree over the groups; groups are numbered from 0.
TOP = -1
# Equal rows that one row of the table of places may stand for.
COPIES = 10_000
NODE_SCHEMA = "tree long, level int, pos long, parent_tree long, parent_level int, parent_pos long, slot int, hash binary, children binary"
NODE = [column.split(" ")[0] for column in NODE_SCHEMA.split(", ")]
ROW_LIMIT = "spark.sql.cteRecursionRowLimit"

CLIMB = """
with recursive climb (tree, level, pos, slot, first_run, above, subroot, top, leaves) as (
  select tree, level, pos, slot, first_run, above, subroot, top, leaves from {anchor}
  union all
  select n.parent_tree, n.parent_level, n.parent_pos, n.slot,
    coalesce(c.first_run, n.children),
    if(c.first_run is null, c.above, concat(c.above, substring(n.children, 1, 32 * c.slot), substring(n.children, 32 * c.slot + 33))),
    if(n.tree = -1 and c.subroot is null, substring(n.children, 1 + 32 * coalesce(c.slot, c.leaves[0].at), 32), c.subroot),
    n.hash,
    transform(c.leaves, x -> named_struct('id', x.id, 'at', x.at, 'leaf', x.leaf, 'folded', unhex(sha2(lower(hex(concat(
      substring(n.children, 1, 32 * coalesce(c.slot, x.at)), x.folded, substring(n.children, 32 * coalesce(c.slot, x.at) + 33)))), 256))))
  from climb c join {nodes} n on n.tree = c.tree and n.level = c.level and n.pos = c.pos
)
select first_run, above, subroot, top, leaves from climb where level is null
"""


@dataclass(frozen=True)
class Manifest:
    """Written tables of a manifest: ``nodes`` above the leaves, and the ``runs`` of leaves."""

    nodes: DataFrame
    runs: DataFrame


def field_text(value: Column) -> Column:
    """``-`` for null, else the number of bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(fields: Sequence[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*map(field_text, fields)), 256))


def hash_of(hashes: Column) -> Column:
    """Hash of concatenated hashes, each taken as hex text."""
    return F.unhex(F.sha2(F.lower(F.hex(hashes)), 256))


def hex_text(value: Column) -> Column:
    return F.lower(F.hex(value))


def places(rows: DataFrame, group: Sequence[str], order: Sequence[str], copies: str) -> DataFrame:
    """All columns and ``at``: how many copies stand before the row in its group."""
    ranged = store(rows.repartitionByRange(*group, *order).withColumn("part", F.spark_partition_id()), "ranged")
    sizes = ranged.groupBy("part", *group).agg(F.sum(copies).alias("in_part"))
    before = Window.partitionBy(*group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        F.col("part").alias("p"), *[F.col(g).alias(f"g{i}") for i, g in enumerate(group)], F.coalesce(F.sum("in_part").over(before), F.lit(0)).alias("before_")
    )
    within = Window.partitionBy("part", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    numbered = ranged.withColumn("within_", F.coalesce(F.sum(copies).over(within), F.lit(0)))
    same = [F.col("part") == F.col("p"), *[F.col(g).eqNullSafe(F.col(f"g{i}")) for i, g in enumerate(group)]]
    joined = numbered.join(starts, reduce(Column.__and__, same))
    return joined.select(*rows.columns, (F.col("before_") + F.col("within_")).alias("at"))


def _in_runs(level: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Runs of consecutive nodes: tree, run, size of the tree, hashes in order, and the extra columns in order."""
    members = F.array_sort(F.collect_list(F.struct("pos", "hash", *extra)))
    runs = level.groupBy("tree", F.floor(F.col("pos") / FAN).cast("long").alias("run"), "n").agg(members.alias("members"))
    together = F.aggregate("members", F.lit(b""), lambda done, m: F.concat(done, m["hash"]))
    return runs.select("tree", "run", "n", "members", together.alias("children"))


def _linked(groups: int) -> dict[str, Column]:
    """Parent and slot of the node that is alone in its tree, or not, from tree, pos, level and size of the tree."""
    alone, top = F.col("n") == 1, F.col("tree") == TOP
    root = alone & (top | F.lit(groups == 1))
    pick = lambda inside, above: F.when(root, None).when(alone, above).otherwise(inside)
    return {
        "parent_tree": pick(F.col("tree"), F.lit(TOP).cast("long")),
        "parent_level": pick(F.col("level") + 1, F.lit(1)),
        "parent_pos": pick(F.floor(F.col("pos") / FAN).cast("long"), F.floor(F.col("tree") / FAN).cast("long")),
        "slot": pick((F.col("pos") % FAN).cast("int"), (F.col("tree") % FAN).cast("int")),
    }


def _climb_levels(level: DataFrame, size: int, groups: int, first: DataFrame | None = None) -> tuple[list[DataFrame], DataFrame]:
    """Written levels above the given nodes (tree, pos, n, hash), and the last node of every tree (tree, hash)."""
    written, roots, runs = [], [level.where("n = 1").select("tree", "hash")], first
    height = 0
    while size > 1:
        height, size = height + 1, -(-size // FAN)
        runs = _in_runs(level.where("n > 1")) if runs is None else runs.where("n > 1")
        nodes = runs.select(
            "tree", F.lit(height).alias("level"), F.col("run").alias("pos"), F.ceil(F.col("n") / FAN).cast("long").alias("n"), "children", hash_of(F.col("children")).alias("hash")
        )
        nodes = store(nodes.withColumns(_linked(groups)), f"level_{height}")
        written.append(nodes)
        level, runs = nodes.select("tree", "pos", "n", "hash"), None
        roots.append(level.where("n = 1").select("tree", "hash"))
    return written, reduce(DataFrame.unionAll, roots)


def build(leaves: DataFrame, group: str = "grp") -> Manifest:
    """Manifest of leaves with columns ``id``, the group, ``leaf`` and ``start``, the hash that a proof is checked with."""
    spark = leaves.sparkSession
    counted = leaves.groupBy(group, "id", "leaf", "start").agg(F.count("*").alias("copies"))
    placed = store(places(counted, [group], ["id", "leaf", "start"], "copies"), "places")
    sizes = placed.groupBy(group).agg(F.sum("copies").alias("n"), F.lit(1).alias("one"))
    trees = store(places(sizes, [], [group], "one").select(F.col(group).alias("g"), F.col("at").alias("tree"), "n"), "trees")
    groups, largest = trees.agg(F.count("*"), F.max("n")).first()
    joined = placed.join(trees, F.col(group).eqNullSafe(F.col("g")))
    # Equal rows take consecutive places: first in portions, then one by one.
    portions = joined.withColumn("portion", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / COPIES).cast("long"))))
    first = F.col("at") + F.col("portion") * COPIES
    last = F.least(first + COPIES, F.col("at") + F.col("copies")) - 1
    single = portions.select("tree", "n", "id", "start", F.col("leaf").alias("hash"), F.explode(F.sequence(first, last)).alias("pos"))
    runs = store(_in_runs(single, ("id", "start")), "runs")
    level = runs.select("tree", "n", F.explode("members").alias("m")).select("tree", F.col("m.pos").alias("pos"), "n", F.col("m.hash").alias("hash"))
    below, subroots = _climb_levels(level, largest or 0, groups, runs)
    top = store(subroots.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("pos"), F.lit(groups).cast("long").alias("n"), "hash"), "subroots")
    above, _ = _climb_levels(top, groups, groups)
    nodes = reduce(DataFrame.unionAll, [t.select(*NODE) for t in below + above], spark.createDataFrame([], NODE_SCHEMA))
    return Manifest(nodes, runs.withColumn("groups", F.lit(groups)))


def climb(manifest: Manifest) -> DataFrame:
    """Per leaf: ``id``, ``leaf``, ``subroot``, ``root``, the ``siblings`` of its path and the ``folded`` root, hashes as bytes."""
    spark = manifest.nodes.sparkSession
    nothing = F.lit(None).cast("binary")
    alone = F.col("n") == 1
    root = alone & (F.col("groups") == 1)
    # The place of a root among the roots; named apart from the columns it is used beside.
    anchor = manifest.runs.withColumn("above_slot", F.when(alone, F.col("tree") % FAN)).select(
        F.when(root, None).when(alone, F.lit(TOP)).otherwise(F.col("tree")).cast("long").alias("tree"),
        F.when(root, None).otherwise(F.lit(1)).alias("level"),
        F.when(root, None).when(alone, F.floor(F.col("tree") / FAN)).otherwise(F.col("run")).cast("long").alias("pos"),
        F.lit(None).cast("int").alias("slot"),
        nothing.alias("first_run"),
        F.lit(b"").alias("above"),
        nothing.alias("subroot"),
        F.when(root, F.col("children")).alias("top"),
        F.transform(
            "members",
            lambda m: F.struct(
                m["id"].alias("id"),
                F.coalesce("above_slot", m["pos"] % FAN).cast("int").alias("at"),
                m["hash"].alias("leaf"),
                m["start"].alias("folded"),
            ),
        ).alias("leaves"),
    )
    limit = spark.conf.get(ROW_LIMIT)
    spark.conf.set(ROW_LIMIT, "-1")
    try:
        arrived = store(spark.sql(CLIMB, anchor=anchor, nodes=manifest.nodes), "climbed")
    finally:
        spark.conf.set(ROW_LIMIT, limit)
    each = arrived.select("first_run", "above", "subroot", "top", F.explode("leaves").alias("x"))
    own = F.concat(F.expr("substring(first_run, 1, 32 * x.at)"), F.expr("substring(first_run, 32 * x.at + 33)"))
    return each.select(
        F.col("x.id").alias("id"),
        F.col("x.leaf").alias("leaf"),
        F.coalesce("subroot", "top").alias("subroot"),
        F.col("top").alias("root"),
        F.coalesce(F.concat(own, F.col("above")), F.lit(b"")).alias("siblings"),
        F.col("x.folded").alias("folded"),
    )


def verified(
    docs: DataFrame, tampered: dict[str, Column], when: Column, id_col: str = "doc_id", group: str = "lang", fields: Sequence[str] = FIELDS
) -> DataFrame:
    """Proofs of all rows, checked with leaves whose fields are replaced by ``tampered`` where ``when`` holds.

    Per row: id, ``leaf``, ``subroot``, ``root``, ``proof_sha256`` (hash of the siblings), ``folded_root``, ``verified``.
    """
    plain = [F.col(f"`{f}`") for f in fields]
    other = [tampered.get(f, F.col(f"`{f}`")) for f in fields]
    leaf = leaf_hash(plain)
    start = F.when(F.coalesce(when, F.lit(False)), leaf_hash(other)).otherwise(leaf)
    leaves = docs.select(F.col(f"`{group}`").alias("grp"), F.col(f"`{id_col}`").alias("id"), leaf.alias("leaf"), start.alias("start"))
    found = climb(build(leaves))
    return found.select(
        F.col("id").alias(id_col),
        hex_text(F.col("leaf")).alias("leaf"),
        hex_text(F.col("subroot")).alias("subroot"),
        hex_text(F.col("root")).alias("root"),
        F.sha2(hex_text(F.col("siblings")), 256).alias("proof_sha256"),
        hex_text(F.col("folded")).alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )
