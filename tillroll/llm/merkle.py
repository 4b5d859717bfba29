"""Merkle manifest of a dataset: a tree of hashes per group, a tree over the groups' roots, and proofs.

H is the lowercase hex SHA-256 of its inputs, concatenated; digests enter as hex text.  A leaf is H of a row's
fields.  The leaves of a group stand in the order of a key; while several nodes remain, every ``fanout``
consecutive ones (the last run: fewer, even one) become their H.  The groups' roots (a lone leaf is its own),
ordered by group, null first and then bytewise, become the root in the same way.

Slot pivot: conditional aggregates spread each parent's children into one column per slot;
concatenating the columns hashes the parent, leaving out the own slot's column gives the siblings.  One
aggregation does several levels at once (``fanout`` ** levels slots, at most ``MAX_SLOTS`` where fanout allows), so a
parent holds at most that many nodes, and the levels in between are column expressions on its arrays.
Proofs come down the same parents: a child's proof is its siblings inside the parent, then the parent's own proof, so
a proof is handed to a parent's children inside its row and never shuffled once per leaf.

Places in a group come from a range sort (see ranking.py); no task sees a whole group or a whole level.
Nulls: a null field is ``-``, a null group is a group of its own, a null order key comes first; rows equal in
the key are ordered by their leaf.  Repeated rows are leaves of their own.  An empty table has no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import written
from tillroll.llm.ranking import numbered

MAX_SLOTS = 16


def H(*inputs: Column) -> Column:
    return F.sha2(F.concat(*inputs), 256)


def field(value: Column) -> Column:
    """Byte count, colon and value; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(fields: list[Column]) -> Column:
    return H(*[field(f) for f in fields])


def siblings(steps: str = "proof") -> Column:
    """All siblings of a proof, level by level, left to right, as one text."""
    return F.expr(f"array_join(transform({steps}, s -> concat(s.left, s.right)), '')")


def folded(leaf: Column, steps: str = "proof") -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(steps, leaf, lambda acc, s: H(s["left"], acc, s["right"]))


def _levels(fanout: int) -> int:
    levels = 1
    while fanout ** (levels + 1) <= MAX_SLOTS:
        levels += 1
    return levels


def _climb(nodes: DataFrame, fanout: int) -> tuple[list[DataFrame], DataFrame]:
    """``nodes`` (grp, idx, n, hash, carry): the written tables of parents, from the leaves up, and (grp, hash) of
    each group's last node.  A parent keeps its children (hash, carry) and the nodes of each level inside it."""
    levels, tables = _levels(fanout), []
    slots = fanout ** levels
    while True:
        child = F.struct("hash", "carry") if not tables else F.struct("hash")
        parents = nodes.groupBy("grp", F.expr(f"idx div {slots}").alias("idx")).agg(
            F.max("n").alias("n"), *[F.max(F.when(F.col("idx") % slots == j, child)).alias(f"slot{j}") for j in range(slots)])
        parents = parents.select("grp", "idx", "n", F.array_compact(F.array(*[f"slot{j}" for j in range(slots)])).alias("child"))
        parents = parents.withColumn("at0", F.expr("transform(child, c -> c.hash)")).withColumn("n0", F.col("n"))
        for k in range(1, levels + 1):  # a group that has come down to one node is not hashed again
            parents = (parents.withColumn(f"at{k}", F.expr(
                f"if(n{k - 1} > 1, transform(sequence(0, (size(at{k - 1}) - 1) div {fanout}), "
                f"i -> sha2(array_join(slice(at{k - 1}, cast(i * {fanout} + 1 as int), {fanout}), ''), 256)), at{k - 1})"))
                .withColumn(f"n{k}", F.expr(f"(n{k - 1} + {fanout - 1}) div {fanout}")))
        tables.append(written(parents.drop("n"), "merkle-level"))
        nodes = tables[-1].select("grp", "idx", F.col(f"n{levels}").alias("n"), F.col(f"at{levels}")[0].alias("hash"))
        if (nodes.agg(F.max("n")).first()[0] or 1) == 1:
            return tables, nodes.select("grp", "hash")


def _descend(tables: list[DataFrame], top: DataFrame, fanout: int, keep: list[str]) -> DataFrame:
    """(carry, hash, proof, keep...) of every leaf; ``top``: (grp, proof, keep...) of each group's last node."""
    levels = _levels(fanout)
    steps = []
    for k in range(levels):
        place, first = f"cast(slot div {fanout ** k} as int)", f"cast(slot div {fanout ** (k + 1)} * {fanout} as int)"
        steps.append(f"if(n{k} > 1, array(named_struct('left', array_join(slice(at{k}, {first} + 1, {place} - {first}), ''), "
                     f"'right', array_join(slice(at{k}, {place} + 2, {first} + {fanout} - 1 - {place}), ''))), "
                     "cast(array() as array<struct<left: string, right: string>>))")
    upper = top.withColumn("idx", F.lit(0).cast("long"))
    for table in reversed(tables):
        each = table.join(upper, ["grp", "idx"]).select("*", F.posexplode("child").alias("slot", "own"))
        upper = each.select("grp", F.expr(f"idx * {fanout ** levels} + slot").alias("idx"),
                            F.expr(f"concat({', '.join(steps)}, proof)").alias("proof"), *keep, "own")
        upper, leaf = upper.drop("own"), upper
    return leaf.select("own.carry", "own.hash", "proof", *keep)


def proofs(leaves: DataFrame, group: str, order: str, leaf: str, carry: list[str], fanout: int = 2) -> DataFrame:
    """(carry..., leaf, subroot, root, proof) of every row of ``leaves`` (a written table); proof: array of
    (left, right), the siblings on each side from the leaf's level up to the root."""
    if fanout < 2:
        raise ValueError("fanout must be 2 at least")
    rows = leaves.select(F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("grp"), F.col(order).alias("order"),
                         F.col(leaf).alias("hash"), F.struct(*carry).alias("carry"))
    tables, subroots = _climb(numbered(rows, ["grp"], ["order", "hash"], "merkle-leaves").select("grp", "idx", "n", "hash", "carry"), fanout)
    # the groups' roots are the leaves of the upper tree
    names = written(subroots.select(F.col("grp").alias("of"), "hash"), "merkle-subroots")
    upper, root = _climb(numbered(names, [], ["of"], "merkle-upper").select(
        F.lit("").alias("grp"), "idx", "n", "hash", F.struct("of").alias("carry")), fanout)
    top = root.select("grp", F.col("hash").alias("root"), F.expr("cast(array() as array<struct<left: string, right: string>>)").alias("proof"))
    top = _descend(upper, top, fanout, ["root"]).select(F.col("carry.of").alias("grp"), F.col("hash").alias("subroot"), "root", "proof")
    return _descend(tables, top, fanout, ["subroot", "root"]).select("carry.*", F.col("hash").alias("leaf"), "subroot", "root", "proof")
