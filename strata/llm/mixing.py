"""Mixing sources to target weights by hierarchical budgeting (operator 4).

The levels (here domain, language, source) make a tree.  A token budget is
passed down from the root in proportion to the weights of the children.  A
child can use `max_epochs` times its tokens at most; what it cannot use goes
to its siblings in proportion to their weights, and only what no sibling can
use leaves the parent, for the parent's own siblings.  (A node's limit is the
sum of its leaves' limits, so a parent asks for no more than its children can
use, and sharing level by level from the top gives just that order.)

Every leaf reads its documents in epochs.  Epoch e runs through the leaf in
the order of md5("seed:e:doc_id"); a leaf's tokens are whole epochs and a
prefix of the next: documents in order, as long as their tokens fit.  The
prefix is found in two steps, sums of `BUCKETS` ranges of the order and then
the order inside each range, so no task reads a whole leaf.

Tokens are the runs of non-blank characters.  Budgets are whole tokens; each
share is rounded down.  Null level values are a child named "" of their own;
weights not given are 1; a child of weight 0 gets nothing.  Null and empty
texts have no tokens.  Rows of one leaf that share an id have one place in the
order and go in or stay out together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.session import materialize

#: Ranges of the seeded order: the first three hex digits of its hash.
HEX_DIGITS = 3
BUCKETS = 16 ** HEX_DIGITS
#: A leaf table of this many rows at most is sent to all tasks.
BROADCAST_LEAVES = 20_000


def token_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _weight(level: str, weights: dict[str, int]) -> Column:
    out = F.lit(1)
    for key, w in weights.items():
        out = F.when(F.col(level) == key, F.lit(int(w))).otherwise(out)
    return out.cast("long")


def share_out(children: DataFrame, parent: list[str]) -> DataFrame:
    """Adds `alloc`: each child's part of its parent's `budget`.

    `children` has the parent's columns and budget, and each child's key,
    `cap` and `weight` (whole numbers).  Children are taken in the order of
    cap / weight: as long as an equal share by weight of what is left would
    fill a child, it gets its cap; the others share the rest by weight.
    """
    ratio = F.when(F.col("weight") > 0, F.col("cap") / F.col("weight")).otherwise(F.lit(float("inf")))
    group = Window.partitionBy(*parent)
    before = group.orderBy("_ratio", "_key").rowsBetween(Window.unboundedPreceding, -1)
    sums = (children.withColumn("_ratio", ratio)
            .withColumn("_cap", F.coalesce(F.sum("cap").over(before), F.lit(0)))
            .withColumn("_w", F.coalesce(F.sum("weight").over(before), F.lit(0)))
            .withColumn("_all", F.sum("weight").over(group)))
    full = sums.withColumn("_full", (F.col("weight") > 0) & (
        F.col("cap") * (F.col("_all") - F.col("_w")) <= F.col("weight") * (F.col("budget") - F.col("_cap"))))
    rest = full.withColumn("_left", F.col("budget") - F.sum(F.when(F.col("_full"), F.col("cap")).otherwise(0)).over(group)) \
        .withColumn("_open", F.sum(F.when(F.col("_full"), 0).otherwise(F.col("weight"))).over(group))
    part = F.expr("case when _full then cap when weight = 0 then 0L else weight * _left div _open end")
    return rest.withColumn("alloc", part).drop("_ratio", "_cap", "_w", "_all", "_full", "_left", "_open")


def allocate(leaves: DataFrame, levels: list[str], weights: dict[str, dict[str, int]], budget: int,
             max_epochs: int) -> DataFrame:
    """(levels, tokens, alloc) for leaves with their tokens."""
    capped = leaves.withColumn("cap", F.col("tokens") * max_epochs)
    above = None
    for k in range(1, len(levels) + 1):
        nodes = capped.groupBy(*levels[:k]).agg(F.sum("cap").alias("cap"), F.sum("tokens").alias("tokens"))
        nodes = nodes.withColumn("weight", _weight(levels[k - 1], weights.get(levels[k - 1], {})))
        with_budget = nodes.join(above, levels[:k - 1]) if above else nodes.withColumn("budget", F.lit(budget))
        shared = share_out(with_budget.withColumn("_key", F.col(levels[k - 1])), levels[:k - 1])
        if k == len(levels):
            return shared.select(*levels, "tokens", "alloc")
        above = shared.select(*levels[:k], F.col("alloc").alias("budget"))
    raise ValueError("levels is empty")


def seeded(seed: int, epoch: Column, key: Column) -> Column:
    """Place of a document in an epoch's order (32 hex digits)."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(key.cast("string"), F.lit(""))))


def mix(docs: DataFrame, levels: dict[str, Column], weights: dict[str, dict[str, int]], budget_share: float = 0.5,
        budget_tokens: int | None = None, max_epochs: int = 4, seed: int = 42, id_col: str = "doc_id",
        text_col: str = "text") -> DataFrame:
    """The selected rows of `docs`, with the levels, n_tokens and epochs.

    `levels` names the tree's levels from the top; the budget is
    `budget_tokens`, or else `budget_share` of all tokens.  `epochs` is how
    often a row is read: whole epochs, and one more if it is in the prefix.
    Columns of `docs` with the names of added ones are replaced.
    """
    names = list(levels)
    key = {n: F.coalesce(c.cast("string"), F.lit("")) for n, c in levels.items()}
    slim = materialize(docs.select(F.col(id_col).alias("_id"), token_count(F.col(text_col)).alias("n_tokens"),
                                   *[c.alias(n) for n, c in key.items()]), docs.sparkSession)
    leaves = slim.groupBy(*names).agg(F.sum("n_tokens").alias("tokens"))
    total = slim.agg(F.sum("n_tokens")).first()[0] or 0
    budget = int(total * budget_share) if budget_tokens is None else budget_tokens
    plan = allocate(leaves, names, weights, min(budget, total * max_epochs), max_epochs)
    whole = F.expr("case when tokens > 0 then alloc div tokens else 0L end")
    plan = materialize(plan.withColumn("full", whole)
                       .withColumn("rest", F.col("alloc") - F.col("full") * F.col("tokens")), docs.sparkSession)
    few = plan.count() <= BROADCAST_LEAVES
    sent = F.broadcast if few else (lambda df: df)

    placed = (slim.join(sent(plan.select(*names, "full", "rest").where("rest > 0")), names)
              .withColumn("place", seeded(seed, F.col("full"), F.col("_id")))
              .withColumn("bucket", F.substring("place", 1, HEX_DIGITS)))
    ranges = placed.groupBy(*names, "bucket").agg(F.sum("n_tokens").alias("in_bucket"))
    up_to = Window.partitionBy(*names).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("before", F.coalesce(F.sum("in_bucket").over(up_to), F.lit(0)))
    order = Window.partitionBy(*names, "bucket").orderBy("place").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    prefix = (placed.join(ranges.drop("in_bucket"), [*names, "bucket"]).where("before <= rest")
              .withColumn("_sum", F.col("before") + F.sum("n_tokens").over(order))
              .where("_sum <= rest").groupBy(*names).agg(F.max("place").alias("last")))
    chosen = materialize(plan.join(prefix, names, "left").select(*names, "full", "last")
                         .where("full > 0 or last is not null"), docs.sparkSession)

    own = [c for c in docs.columns if c not in {*names, "n_tokens", "epochs"}]
    rows = docs.select(F.struct(*own).alias("row"), F.col(id_col).alias("_id"), token_count(F.col(text_col)).alias("n_tokens"),
                       *[c.alias(n) for n, c in key.items()])
    in_prefix = F.coalesce(seeded(seed, F.col("full"), F.col("_id")) <= F.col("last"), F.lit(False))
    out = (rows.join(sent(chosen), names)
           .withColumn("epochs", F.col("full") + in_prefix.cast("long")).where("epochs > 0"))
    return out.select("row.*", *names, "n_tokens", "epochs")
