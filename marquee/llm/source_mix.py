"""Mixing sources to target weights by hierarchical budgeting.

The columns ``levels`` (domain, language, source) form a tree.  A token
budget runs from the root down: a node's budget is divided among its
children by weight; a child that cannot use its share (its subtree holds
fewer tokens, over all allowed epochs) takes what it has, and the rest goes
to its siblings by their weights.  Only what a whole subtree cannot use
reaches the siblings of its ancestor.  With the children in order of
capacity / weight the full ones come first, so each level of the tree is
decided by windows over the children of a node.

Each leaf then reads its documents in seeded epochs: epoch e orders them by
md5(seed:e:id).  Whole epochs come first; of the last one the longest
prefix within the leaf's remaining tokens is taken.  The prefix ends at a
key found from 4,096 key ranges of the leaf and one window over the range
in which it ends, so no task sees a whole leaf.

Cases: NULL levels are nodes like any other; NULL and empty texts have no
tokens and are read with the epoch at their place; rows with equal ids have
equal keys and are taken or left together; weights of 0 take nothing unless
all siblings are full; an empty table gives an empty result; further
columns are kept, those named like the added ones are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.store import Scratch, packed, unpacked

RANGE = 3        # hex digits of a key range: 4,096 ranges


def _weight(weights: dict[tuple, float], path: list[str]) -> Column:
    """Weight of the node at ``path``; 1 where none is given."""
    w = F.lit(1.0)
    for node, value in weights.items():
        if len(node) == len(path):
            same = F.lit(True)
            for c, v in zip(path, node):
                same = same & F.col(c).eqNullSafe(F.lit(v))
            w = F.when(same, F.lit(float(value))).otherwise(w)
    return w


def budgets(leaves: DataFrame, levels: list[str], weights: dict[tuple, float], budget: float, epochs: int) -> DataFrame:
    """``leaves`` (levels, avail tokens) with ``target`` tokens of each leaf."""
    tree = leaves.withColumn("_b", F.lit(float(budget)))
    for depth in range(1, len(levels) + 1):
        path, above = levels[:depth], levels[:depth - 1]
        nodes = (tree.groupBy(*path).agg((F.sum("avail") * epochs).cast("double").alias("cap"), F.first("_b").alias("_b"))
                 .withColumn("w", _weight(weights, path)))
        siblings = Window.partitionBy(*(above or [F.lit(0)]))
        by = siblings.orderBy(F.expr("if(w > 0, cap / w, double('infinity'))"), *path)
        nodes = nodes.withColumns({
            "used": F.coalesce(F.sum(F.expr("if(w > 0, cap, 0)")).over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)),
            "open": F.sum("w").over(by.rowsBetween(Window.currentRow, Window.unboundedFollowing))})
        # tokens per unit of weight once the children before this one are full; its
        # maximum is the level at which the budget is used up
        nodes = nodes.withColumn("level", F.max(F.expr("if(w > 0, (_b - used) / open, null)")).over(siblings))
        nodes = nodes.withColumns({
            "free": F.col("_b") - F.sum(F.expr("if(w > 0, cap, 0)")).over(siblings),
            "idle": F.sum(F.expr("if(w > 0, 0, cap)")).over(siblings)})
        got = F.expr("case when w > 0 then greatest(0, least(cap, level * w))"
                     " when free > 0 and idle > 0 then least(cap, free * cap / idle) else 0 end")
        nodes = nodes.select(*[F.col(c).alias(f"_{c}") for c in path], got.alias("_n"))
        same = F.lit(True)
        for c in path:
            same = same & tree[c].eqNullSafe(nodes[f"_{c}"])
        tree = tree.join(nodes, same).drop("_b", *[f"_{c}" for c in path]).withColumnRenamed("_n", "_b")
    return tree.withColumn("target", F.floor(F.round(F.col("_b"), 6)).cast("long")).drop("_b")


def mix(docs: DataFrame, levels: list[str], weights: dict[tuple, float], share: float = 0.8, epochs: int = 1, seed: int = 17,
        id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with n_tokens (words) and epoch, one row for each reading.

    The budget is ``share`` of all tokens of ``docs``."""
    scratch = Scratch(docs.sparkSession, "mix")
    plain = [c for c in docs.columns if c.lower() not in ("n_tokens", "epoch")]
    path = [f"l{i}" for i in range(len(levels))]
    tokens = F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    counted = packed(docs, **{p: F.col(c) for c, p in zip(levels, path)}, id=F.col(id_col).cast("string"), n_tokens=tokens)
    rows = scratch.save(counted.select(*path, "id", "n_tokens"), "rows")
    leaves = scratch.save(rows.groupBy(*path).agg(F.sum("n_tokens").alias("avail")), "leaves")
    budget = share * float(leaves.agg(F.coalesce(F.sum("avail"), F.lit(0))).first()[0])
    plan = budgets(leaves, path, weights, budget, epochs)
    plan = plan.withColumn("whole", F.when(F.col("avail") > 0, F.least(F.floor(F.col("target") / F.col("avail")), F.lit(epochs))).otherwise(1).cast("long"))
    plan = scratch.save(plan.withColumn("rest", F.col("target") - F.col("whole") * F.col("avail")), "plan")

    key = lambda epoch, i: F.md5(F.concat(F.lit(f"{seed}:"), epoch.cast("string"), F.lit(":"), F.coalesce(i, F.lit("null"))))
    same = lambda a, b, cols: [a[c].eqNullSafe(b[c]) for c in cols]
    partial = plan.where("rest > 0")
    keyed = rows.join(partial, same(rows, partial, path)).select(
        *[rows[p] for p in path], key(F.col("whole"), F.col("id")).alias("key"), "n_tokens", "rest")
    keyed = scratch.save(keyed.withColumn("range", F.substring("key", 1, RANGE)), "keyed")
    ranges = (keyed.groupBy(*path, "range").agg(F.sum("n_tokens").alias("n"), F.first("rest").alias("rest"), F.max("key").alias("last"))
              .withColumn("through", F.sum("n").over(Window.partitionBy(*path).orderBy("range"))))
    ranges = scratch.save(ranges, "ranges")
    inside = ranges.where("through > rest and through - n <= rest").select(*[F.col(p).alias(f"{p}_") for p in path], F.col("range").alias("range_"), (F.col("through") - F.col("n")).alias("before"))
    ends = keyed.join(inside, [keyed[p].eqNullSafe(inside[f"{p}_"]) for p in path] + [keyed["range"] == inside["range_"]])
    run = F.sum("n_tokens").over(Window.partitionBy(*path).orderBy("key").rangeBetween(Window.unboundedPreceding, Window.currentRow))
    ends = ends.withColumn("through", F.col("before") + run).where("through <= rest").select(*path, F.col("key").alias("last"))
    cut = ranges.where("through <= rest").select(*path, "last").unionByName(ends).groupBy(*path).agg(F.max("last").alias("cut"))
    plan = scratch.save(plan.join(cut, same(plan, cut, path), "left").select(*[plan[p] for p in path], "whole", "cut"), "cuts")

    plan = plan.withColumnsRenamed({p: f"{p}_of" for p in path})
    read = counted.join(plan, [F.col(p).eqNullSafe(F.col(f"{p}_of")) for p in path])
    partial = F.coalesce(key(F.col("whole"), F.col("id")) <= F.col("cut"), F.lit(False))
    read = read.withColumn("readings", F.col("whole") + partial.cast("long")).where("readings > 0")
    return (read.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("readings") - 1)))
            .select(*unpacked(plain), "n_tokens", "epoch"))
