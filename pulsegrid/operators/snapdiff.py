"""What changed between consecutive full snapshots.

Method: keys fall into hash ranges, the leaves of a Merkle tree over each delivery. A node's digest is the exclusive or of
its rows' hashes, so each level follows from the one below, and in any order. Consecutive deliveries are compared from
the root down: only children of differing nodes are looked at, and only rows in differing leaves are diffed.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import key_hash
from ..session import cut, store
from .dedupe import first_per_key


def snapshot_changes(
    rows: DataFrame,
    *,
    group: tuple[str, ...] = ("stream",),
    instant: str = "timestamp_utc",
    key: tuple[str, ...] = ("entity", "field"),
    content: str = "value_text",
    order: tuple[str, ...] = ("fetched_at_utc", "chunk"),
    leaf_records: int = 16,
    leaf_bits: int | None = None,
    level_bits: int = 4,
    broadcast_leaves: int = 200_000,
) -> DataFrame:
    """Columns ``group``, ``key``, ``instant`` (of the later delivery), ``change_kind``, ``old_text``, ``new_text``.

    A delivery is all rows of a group with one instant; it is compared with the next one present. Of several copies of
    a record in a delivery the first by ``order`` counts, a tie takes the least text. Blanks and tabs around a text
    don't matter, null equals empty; nulls in a key are values of their own. Rows without instant belong to no
    delivery. The first delivery of a group yields nothing, nor does an empty table; further columns are ignored.
    The number of leaves follows from the records of a delivery, about ``leaf_records`` each, unless ``leaf_bits`` gives
    it. Up to ``broadcast_leaves`` differing leaves (some 10 MB) are sent to the rows, more are joined by a shuffle.
    """
    clean = F.coalesce(F.regexp_replace(F.col(content).cast("string"), r"^[ \t]+|[ \t]+$", ""), F.lit(""))
    slim = rows.filter(F.col(instant).isNotNull()).select(*group, F.col(instant).alias("_at"), *key, clean.alias("_text"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)])
    kept = store(first_per_key(slim, (*group, "_at", *key), tuple(f"_o{i}" for i in range(len(order)))).select(*group, "_at", *key, "_text"))  # the tree and the diff both read it
    if leaf_bits is None:
        per = kept.groupBy(*group, "_at").agg(F.count("*").alias("n")).agg(F.avg("n")).first()[0] or 1
        leaf_bits = level_bits * max(1, math.ceil(math.log2(max(1, per / leaf_records)) / level_bits))
    elif leaf_bits % level_bits:
        raise ValueError("leaf_bits must be a multiple of level_bits")
    kept = kept.withColumn("_g", key_hash(*group)).withColumn("_leaf", F.shiftrightunsigned(key_hash(*key), 64 - leaf_bits).cast("int"))

    digests = [F.bit_xor(F.xxhash64(F.lit(seed), key_hash(*key), F.col("_text"))).alias(f"_d{seed}") for seed in (1, 2)]
    leaves = cut(kept.groupBy("_g", "_at", "_leaf").agg(*digests, F.count("*").alias("_n")))
    deliveries = leaves.select("_g", "_at").distinct()
    w = Window.partitionBy("_g").orderBy("_at")
    ordinals = cut(deliveries.withColumn("_k", F.row_number().over(w)).withColumn("_before", F.lag("_at").over(w)))
    levels = {leaf_bits: leaves.join(ordinals, ["_g", "_at"]).select("_g", "_k", F.col("_leaf").alias("_node"), "_d1", "_d2", "_n")}
    for level in range(leaf_bits - level_bits, -1, -level_bits):
        below = levels[level + level_bits]
        up = below.groupBy("_g", "_k", F.shiftright("_node", level_bits).alias("_node")).agg(F.bit_xor("_d1").alias("_d1"), F.bit_xor("_d2").alias("_d2"), F.sum("_n").alias("_n"))
        levels[level] = cut(up)

    def differing(level: int, under: DataFrame | None) -> DataFrame:
        """(_g, _k of the later delivery, _node) where the digests of a delivery and its predecessor differ."""
        # each node meets its successor as the earlier side (sign -1) and its predecessor as the later side (+1)
        both = F.array(F.struct(F.col("_k").alias("k"), F.lit(1).alias("s")), F.struct((F.col("_k") + 1).alias("k"), F.lit(-1).alias("s")))
        sides = levels[level].select("_g", F.explode(both).alias("x"), "_node", "_d1", "_d2", "_n").select("_g", F.col("x.k").alias("_k"), "_node", "_d1", "_d2", (F.col("_n") * F.col("x.s")).alias("m"))
        if under is not None:
            parent = under.select("_g", "_k", F.col("_node").alias("_parent"))
            sides = sides.withColumn("_parent", F.shiftright("_node", level_bits)).join(parent, ["_g", "_k", "_parent"], "left_semi")
        return sides.groupBy("_g", "_k", "_node").agg(F.bit_xor("_d1").alias("a"), F.bit_xor("_d2").alias("b"), F.sum("m").alias("m")).filter("a <> 0 or b <> 0 or m <> 0").select("_g", "_k", "_node")

    real = ordinals.filter("_before is not null").select("_g", "_k", F.col("_at").alias("_later"), "_before")
    found = differing(0, None).join(real.select("_g", "_k"), ["_g", "_k"], "left_semi")
    for level in range(level_bits, leaf_bits + 1, level_bits):
        found = differing(level, found)

    two = F.array(F.struct(F.col("_later").alias("at"), F.lit(True).alias("later")), F.struct(F.col("_before").alias("at"), F.lit(False).alias("later")))
    wanted = found.join(real, ["_g", "_k"]).select("_g", F.col("_node").alias("_leaf"), "_later", F.explode(two).alias("x"))
    wanted = cut(wanted.select("_g", "_leaf", "_later", F.col("x.at").alias("_at"), F.col("x.later").alias("_is_later")))
    if wanted.count() <= 2 * broadcast_leaves:
        wanted = F.broadcast(wanted)
    facing = kept.join(wanted, ["_g", "_at", "_leaf"])
    diff = facing.groupBy(*group, *key, "_later").agg(
        F.max(F.when(~F.col("_is_later"), F.struct("_text"))).alias("old"), F.max(F.when(F.col("_is_later"), F.struct("_text"))).alias("new")
    )
    kind = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").when(F.col("old._text") != F.col("new._text"), "changed")
    return diff.select(*group, *key, F.col("_later").alias(instant), kind.alias("change_kind"), F.col("old._text").alias("old_text"), F.col("new._text").alias("new_text")).filter("change_kind is not null")


def changes_by_delivery(changes: DataFrame, group: tuple[str, ...] = ("stream",), instant: str = "timestamp_utc") -> DataFrame:
    """How many records each delivery added, removed and changed."""
    count = lambda kind: F.count_if(F.col("change_kind") == kind).alias(kind)
    return changes.groupBy(*group, instant).agg(*map(count, ("added", "removed", "changed")))
