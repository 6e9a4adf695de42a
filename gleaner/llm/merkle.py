"""Merkle manifest of a dataset: levels of a tree built and proved by joins with sibling places."""

from __future__ import annotations

from functools import reduce
from operator import or_

from gleaner.llm.tasks import stored
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ARITY = 2
#: Levels joined in one query: a tree's height does not make a plan that the driver cannot hold.
PLANNED = 6
#: The columns that a leaf is made of, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_ENTRY = "array<struct<slot:int,others:array<binary>>>"


def digest(*parts: Column) -> Column:
    """SHA-256 of the texts one behind the other, as bytes."""
    return F.unhex(F.sha2(F.concat(*parts), 256))


def named(value: Column) -> Column:
    """A digest as text: lowercase hex."""
    return F.lower(F.hex(value))


def _joined(digests: Column) -> Column:
    return F.array_join(F.transform(digests, named), "")


def leaf(columns: list[Column]) -> Column:
    """The digest of a row: each value's UTF-8 byte count, ``:`` and the value; ``-`` for null."""
    texts = [column.cast("string") for column in columns]
    parts = [F.concat(F.octet_length(t).cast("string"), F.lit(":"), t) for t in texts]
    return digest(*(F.coalesce(part, F.lit("-")) for part in parts))


def placed(df: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """``df`` written, with each row's place (``idx``, from 0) in its group and the group's ``size``.

    Rows are range-partitioned by group and order and numbered where they
    are; only the rows per partition and group are added up. Rows that are
    equal in all keys are split by their arrival.
    """
    keys = [group, *order, "_arrival"]
    arrived = df.withColumn("_arrival", F.monotonically_increasing_id())
    ranged = arrived.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_arrival")
    lying = stored(ranged.withColumn("_place", F.monotonically_increasing_id()), name)
    lying = lying.withColumn("_part", F.shiftright("_place", 33))
    counts = lying.groupBy("_part", group).agg(F.count("*").alias("_rows"), F.min("_place").alias("_first"))
    within = Window.partitionBy(group)
    earlier = within.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "_part",
        group,
        (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_rows").over(within).alias("size"),
    )
    return lying.join(starts, ["_part", group]).withColumn("idx", F.col("_place") + F.col("_shift")).drop(
        "_part", "_place", "_shift"
    )


def _with_siblings(nodes: DataFrame, arity: int) -> DataFrame:
    """Each node with its slot in its run and the digests of the run's other nodes, left to right.

    One equijoin for each sibling: its place is the node's place XOR 1 in a
    binary tree, else so many slots on, round the run.
    """
    slot, met, near = F.col("idx") % arity, nodes, []
    for step in range(1, arity):
        at = (slot + step) % arity
        place = F.col("idx").bitwiseXOR(F.lit(1).cast("long")) if arity == 2 else F.col("idx") - slot + at
        held = nodes.select("group", F.col("idx").alias("_near"), F.col("node").alias(f"_node{step}"))
        met = met.withColumn("_near", place).join(held, ["group", "_near"], "left").drop("_near")
        near.append(F.struct(at.alias("slot"), F.col(f"_node{step}").alias("node")))
    there = F.array_sort(F.filter(F.array(*near), lambda n: n["node"].isNotNull()))
    met = met.withColumns({"slot": slot.cast("int"), "others": F.transform(there, lambda n: n["node"])})
    return met.drop(*(f"_node{step}" for step in range(1, arity)))


def _parents(level: DataFrame, arity: int) -> DataFrame:
    """The nodes above: the first slot of each run emits the digest of the run."""
    run = level.filter((F.col("slot") == 0) & (F.col("size") > 1))
    return run.select(
        "group",
        F.expr(f"idx div {arity}").alias("idx"),
        F.ceil(F.col("size") / arity).cast("long").alias("size"),
        digest(named(F.col("node")), _joined(F.col("others"))).alias("node"),
    )


def levels(leaves: DataFrame, arity: int = ARITY) -> list[DataFrame]:
    """The levels of the trees over ``leaves`` (group, idx, size, node), from the leaves to the roots.

    Each is written, with each node's ``slot`` and ``others``. A group ends at
    the level where it has one node.
    """
    made, largest = [], leaves.agg(F.max("size")).first()[0] or 0
    nodes = leaves
    while largest:
        level = stored(_with_siblings(nodes, arity), "level")
        made.append(level)
        largest = 0 if largest == 1 else -(-largest // arity)
        nodes = _parents(level, arity)
    return made


def roots(tree: list[DataFrame]) -> DataFrame:
    """(group, root) of all groups."""
    ended = [level.filter("size = 1").select("group", F.col("node").alias("root")) for level in tree]
    made = ended[0]
    for more in ended[1:]:
        made = made.unionByName(more)
    return made


def paths(tree: list[DataFrame], arity: int = ARITY) -> DataFrame:
    """The leaves with their ``path``: at each level the slot and the digests of the siblings, up to the group's root.

    From the top down: a node's path is its own siblings and its parent's
    path, so each level is joined once with the one above, of half its size.
    """
    above, height = None, 0
    for level in reversed(tree):
        own = F.array(F.struct("slot", "others"))
        ended = F.array().cast(_ENTRY)
        if above is None:
            met = level.withColumn("path", ended)
        else:
            met = level.withColumn("_up", F.expr(f"idx div {arity}")).join(above, ["group", "_up"], "left")
            met = met.withColumn("path", F.when(F.col("size") > 1, F.concat(own, "_path")).otherwise(ended))
            met = met.drop("_path", "_up")
        above = met.select("group", F.col("idx").alias("_up"), F.col("path").alias("_path"))
        if (height := height + 1) % PLANNED == 0 and level is not tree[0]:
            above = stored(above, "paths")
    return met


def proof(path: Column) -> Column:
    """The digest of all siblings, level by level, left to right."""
    return digest(F.array_join(F.transform(path, lambda step: _joined(step["others"])), ""))


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""

    def up(node: Column, step: Column) -> Column:
        before = F.slice(step["others"], 1, step["slot"])
        after = F.slice(step["others"], step["slot"] + 1, F.size(step["others"]))
        return digest(_joined(before), named(node), _joined(after))

    return F.aggregate(path, start, up)


def manifest(
    docs: DataFrame,
    tampered: dict[str, Column] | None = None,
    fields: tuple[str, ...] = FIELDS,
    id_column: str = "doc_id",
    group: str = "lang",
    arity: int = ARITY,
) -> DataFrame:
    """Each row's leaf, roots and proof, and whether the row as it is now still gives the root.

    Returns (id, leaf, subroot, root, proof_sha256, folded_root, verified),
    digests as lowercase hex. A leaf is the SHA-256 of the row's ``fields``;
    the leaves of a group, ascending by id, make a tree of ``arity``, whose root
    is the group's subroot; the subroots, ordered by group (null first, then
    bytewise), make the tree of the root. ``proof_sha256`` digests the
    siblings from the leaf to the root. ``tampered`` maps columns to what
    is found in them when the rows are checked: ``folded_root`` is made from
    that row and the siblings of the original, ``verified`` if it is the root.

    Each level of a tree is an equijoin of its nodes with the places of their
    siblings; the first slot of each run emits the parent. Levels are written,
    so that none is computed twice. Paths go from the top down.

    Null groups are a group of their own; null ids come first in a group, rows
    that share an id in the order of their leaves, equal rows in any order.
    Columns other than ``fields`` do not matter; an empty table gives an empty result.
    """
    columns = [F.col(name) for name in fields]
    changed = {name: value for name, value in (tampered or {}).items() if name in fields}
    found = [changed.get(name, F.col(name)) for name in fields]
    differs = reduce(or_, (~value.eqNullSafe(F.col(name)) for name, value in changed.items()), F.lit(False))
    leaves = docs.select(
        F.col(id_column).alias("id"),
        # Null comes first, before all texts.
        F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("group"),
        leaf(columns).alias("node"),
        F.when(differs, leaf(found)).alias("now"),
    )
    leaves = stored(leaves, "leaves")
    trees = levels(placed(leaves, "group", ["id", "node"], "placed-leaves"), arity)
    if not trees:
        nothing = {name: F.lit(None).cast("binary") for name in ("subroot", "root")}
        return _result(leaves.withColumns(nothing).withColumn("path", F.array().cast(_ENTRY)), id_column)
    subroots = roots(trees).select(F.col("group").alias("of"), F.col("root").alias("node"), F.lit("").alias("group"))
    top = levels(placed(subroots, "group", ["of"], "subroots"), arity)
    root = roots(top).first().root
    upper = paths(top, arity).select(
        F.col("of").alias("group"), F.col("node").alias("subroot"), F.col("path").alias("_rest")
    )
    met = paths(trees, arity).join(stored(upper, "subroot-paths"), "group")
    return _result(met.withColumns({"path": F.concat("path", "_rest"), "root": F.lit(root)}), id_column)


def _result(met: DataFrame, id_column: str) -> DataFrame:
    met = met.withColumn("folded_root", folded(F.coalesce("now", "node"), F.col("path")))
    return met.select(
        F.col("id").alias(id_column),
        named(F.col("node")).alias("leaf"),
        named(F.col("subroot")).alias("subroot"),
        named(F.col("root")).alias("root"),
        named(proof(F.col("path"))).alias("proof_sha256"),
        named(F.col("folded_root")).alias("folded_root"),
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )

