"""Mixing sources to target weights by hierarchical budgeting.

A tree of domain, language and source carries a weight at each node. The token
budget flows from the root to the leaves: a node divides its budget among its
children by weight, and a child gets at most what its leaves can give in
max_epochs epochs. What a child cannot take goes to its siblings by weight; only
what all siblings together cannot take is left to the level above, since a node's
own limit is the sum of its children's. The division is a water level, found with
running sums over the children in the order in which they fill up.

A leaf's budget is met with whole epochs and a prefix of one more, in an order
seeded anew for each epoch. The prefix is cut by token counts of 4,096 ranges of
the seeded order; only the range that holds the cut is ordered row by row.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourgrid.llm.common import free_prefix, small_side, stored

TREE = ["domain", "lang", "source"]
ADDED = ["epoch", "budget", "tokens_taken"]


@dataclass(frozen=True)
class Mix:
    """Budget, limits and weights. A node that is not listed weighs default_weight.

    weights has paths as keys: ("news",), ("news", "en"), ("news", "en", "site"). They
    are whole numbers, so that their sums are exact in any order.
    """

    budget_tokens: int | None = None
    budget_share: float = 0.5
    max_epochs: int = 4
    seed: int = 17
    weights: dict[tuple[str, ...], int] = field(default_factory=dict)
    default_weight: int = 1


def word_count(text: Column) -> Column:
    """Tokens of the budget: words between ASCII blanks."""
    words = F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))
    return words.cast("long")


def leaf_budgets(leaves: DataFrame, mix: Mix) -> DataFrame:
    """Budgets of (domain, lang, source, tokens) leaves: adds cap and budget, in tokens.

    Each level is one window over the children of a node. Leaves without tokens get
    nothing. A budget is rounded down to whole tokens.
    """
    leaves = leaves.withColumn("cap", F.col("tokens") * mix.max_epochs)
    total = leaves.agg(
        F.coalesce(F.sum("cap"), F.lit(0)).cast("double").alias("root_cap"),
        F.coalesce(F.sum("tokens"), F.lit(0)).alias("root_tokens"),
    )
    if mix.budget_tokens is None:
        wanted = F.floor(F.col("root_tokens") * F.lit(mix.budget_share)).cast("double")
    else:
        wanted = F.lit(float(mix.budget_tokens))
    parents = total.select(F.least(wanted, "root_cap").alias("given"))
    for depth in range(1, len(TREE) + 1):
        path, parent = TREE[:depth], TREE[: depth - 1]
        children = (
            leaves.groupBy(*path)
            .agg(F.sum("cap").cast("double").alias("cap"))
            .withColumn("weight", _weight(path, mix))
        )
        if parent:
            on = [children[c].eqNullSafe(parents[f"_{c}"]) for c in parent]
            condition = on[0] if len(on) == 1 else on[0] & on[1]
            children = children.join(parents, condition).drop(*(f"_{c}" for c in parent))
        else:
            children = children.crossJoin(F.broadcast(parents))  # one row
        filled = water_level(children, parent, path)
        parents = filled.select(*(F.col(c).alias(f"_{c}") for c in path), "given")
    on = [leaves[c].eqNullSafe(parents[f"_{c}"]) for c in TREE]
    return leaves.join(parents, on[0] & on[1] & on[2]).select(
        *TREE, "tokens", "cap", F.floor("given").cast("long").alias("budget")
    )


def _weight(path: list[str], mix: Mix) -> Column:
    weight = F.lit(mix.default_weight).cast("long")
    for names, value in mix.weights.items():
        if len(names) == len(path):
            here = F.lit(True)
            for column, name in zip(path, names):
                here = here & F.col(column).eqNullSafe(F.lit(name))
            weight = F.when(here, F.lit(value).cast("long")).otherwise(weight)
    return weight


def water_level(children: DataFrame, parent: list[str], path: list[str]) -> DataFrame:
    """Divide `given` of a node among its children by weight, none above its cap.

    Children fill up in the order of cap / weight. A child is full if the level that
    would empty the budget over it and all later children reaches its own ratio.
    """
    ratio = F.when(F.col("weight") > 0, F.col("cap") / F.col("weight"))
    ordered = children.withColumn("ratio", ratio)
    order = Window.partitionBy(*parent).orderBy(F.col("ratio").asc_nulls_last(), *path)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(0, Window.unboundedFollowing)
    ordered = ordered.withColumns(
        {
            "used": F.coalesce(F.sum("cap").over(before), F.lit(0.0)),
            "weights": F.sum("weight").over(onward),
        }
    )
    level = (F.col("given") - F.col("used")) / F.nullif(F.col("weights"), F.lit(0))
    ordered = ordered.withColumn("full", F.coalesce(F.col("ratio") <= level, F.lit(False)))
    # The water level is that of the first child that is not full; later ones have less.
    whole = Window.partitionBy(*parent)
    ordered = ordered.withColumn("level", F.max(F.when(~F.col("full"), level)).over(whole))
    share = F.when(F.col("full"), F.col("cap")).otherwise(
        F.coalesce(F.greatest(F.col("level"), F.lit(0.0)) * F.col("weight"), F.lit(0.0))
    )
    return ordered.withColumn("given", F.least(share, "cap"))


def seeded_order(mix: Mix, epoch: Column, doc_id: Column) -> Column:
    """Place of a document in an epoch's order, as hexadecimal text."""
    return F.md5(
        F.concat_ws(
            ":",
            F.lit(str(mix.seed)),
            epoch.cast("string"),
            F.coalesce(doc_id.cast("string"), F.lit("")),
        )
    )


def mix_documents(docs: DataFrame, mix: Mix, id_col: str = "doc_id") -> DataFrame:
    """Rows of docs chosen to meet the budgets, once for each epoch they are in.

    docs needs id_col, domain, lang, source and tokens; other columns are carried
    along. Added: epoch, budget (of the leaf) and tokens_taken. A document is in the
    prefix of an epoch if the documents before it leave budget; the last one counts
    with the tokens that were left, but stays whole. Null tree names form leaves of
    their own. Documents without tokens are in whole epochs, and in a prefix if budget is
    left where they stand. Rows that share id and tokens may change places. No rows give
    no rows. Of the input's columns, those named like an added one are replaced.
    """
    docs = docs.drop(*ADDED)
    p = free_prefix(docs.columns)
    leaves = stored(docs.groupBy(*TREE).agg(F.sum("tokens").alias("tokens")), "mix-leaves")
    budgets = leaf_budgets(leaves, mix).where(F.col("budget") > 0)
    plan = budgets.select(
        *(F.col(c).alias(f"{p}{c}") for c in TREE),
        "budget",
        F.floor(F.col("budget") / F.col("tokens")).cast("int").alias(f"{p}whole"),
        F.pmod("budget", "tokens").alias(f"{p}rest"),
    )
    plan = small_side(stored(plan, "mix-plan"), 200)
    on = [docs[c].eqNullSafe(plan[f"{p}{c}"]) for c in TREE]
    rows = docs.join(plan, on[0] & on[1] & on[2])

    last = rows.where(F.col(f"{p}rest") > 0).withColumn(
        f"{p}place", seeded_order(mix, F.col(f"{p}whole"), F.col(id_col))
    )
    last = last.withColumn(f"{p}range", F.substring(f"{p}place", 1, 3))
    ranges = last.groupBy(*(f"{p}{c}" for c in TREE), f"{p}range", f"{p}rest").agg(
        F.sum("tokens").alias(f"{p}n")
    )
    by_leaf = Window.partitionBy(*(f"{p}{c}" for c in TREE)).orderBy(f"{p}range")
    ranges = ranges.withColumn(
        f"{p}below", F.sum(f"{p}n").over(by_leaf.rowsBetween(Window.unboundedPreceding, 0)) - F.col(f"{p}n")
    ).where(F.col(f"{p}below") < F.col(f"{p}rest"))
    ranges = ranges.select(
        *(F.col(f"{p}{c}").alias(f"{p}r{c}") for c in TREE),
        F.col(f"{p}range").alias(f"{p}rrange"),
        f"{p}below",
        (F.col(f"{p}below") + F.col(f"{p}n") > F.col(f"{p}rest")).alias(f"{p}cut"),
    )
    ranges = small_side(stored(ranges, "mix-ranges"), 200)
    on = [last[f"{p}{c}"].eqNullSafe(ranges[f"{p}r{c}"]) for c in TREE]
    last = last.join(ranges, on[0] & on[1] & on[2] & (last[f"{p}range"] == ranges[f"{p}rrange"]))
    in_range = Window.partitionBy(*(f"{p}{c}" for c in TREE), f"{p}range").orderBy(
        f"{p}place", id_col, "tokens"
    )
    so_far = F.sum("tokens").over(in_range.rowsBetween(Window.unboundedPreceding, 0))
    cut = (
        last.where(f"{p}cut")
        .withColumn(f"{p}left", F.col(f"{p}rest") - F.col(f"{p}below") - (so_far - F.col("tokens")))
        .where(F.col(f"{p}left") > 0)
        .withColumn("tokens_taken", F.least("tokens", f"{p}left"))
    )
    uncut = last.where(~F.col(f"{p}cut")).withColumn("tokens_taken", F.col("tokens"))
    whole = (
        rows.where(F.col(f"{p}whole") > 0)
        .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col(f"{p}whole") - 1)))
        .withColumn("tokens_taken", F.col("tokens"))
    )
    names = [*docs.columns, *ADDED]
    prefix = [part.withColumn("epoch", F.col(f"{p}whole")).select(*names) for part in (uncut, cut)]
    return whole.select(*names).unionByName(prefix[0]).unionByName(prefix[1])
