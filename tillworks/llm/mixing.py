"""Mixing sources to target weights by hierarchical budgeting.

A budget of tokens goes down a tree of levels (domain, language, source). At each node the children share it by integer weights, up to
what they can give (tokens x epochs): what a child cannot give is shared among its siblings first, and only what all of them together
cannot give falls back to the parent's siblings, because a node's own limit is the sum below it. A leaf then gives whole epochs and,
of one more epoch in seeded order, a prefix of tokens that ends inside the last document.

DataFrame functions only. Rows are never sorted by leaf: the order is cut into buckets by its first digits, bucket sums tell in which
bucket the prefix ends, that bucket is cut by the next digits, and only the rows of the last bucket (a leaf's rows / 65536) are put in order.

Cases: null levels are a node of their own; a null text has no tokens and is never selected; rows with the same id and text are equal
and take equal shares where the prefix ends; an empty table or a zero budget selects nothing; other columns are not read by
:func:`plan_mixture` and kept by :func:`mixture`.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillworks.functions.skew import join_per_key
from tillworks.llm.names import free_prefix
from tillworks.llm.quality_rules import SPACE, SPACES
from tillworks.session import cut_lineage

#: Hexadecimal digits by which buckets are cut, one round after the other: each has 256 in a leaf.
BUCKET_DIGITS = (2, 4)


def token_count(text: str = "text") -> Column:
    """White-space words as the measure of tokens."""
    trimmed = F.btrim(F.col(text).cast("string"), F.lit(SPACE))
    return F.when(F.coalesce(trimmed, F.lit("")) == "", F.lit(0)).otherwise(F.size(F.split(trimmed, SPACES))).cast("long")


def weight_of(column: str, weights: Mapping[str, int], default: int) -> Column:
    """The integer weight of a node by its name."""
    out = None
    for name, weight in weights.items():
        test = F.col(column) == name
        out = F.when(test, F.lit(weight)) if out is None else out.when(test, F.lit(weight))
    return (F.lit(default) if out is None else out.otherwise(F.lit(default))).cast("long")


def shared_out(nodes: DataFrame, parents: Sequence[str], order: Sequence[str], weight: str, limit: str, budget: str) -> DataFrame:
    """Add ``target``: the parent's budget by weight, no more than ``limit``, what is over going to the siblings.

    In the order of limit ÷ weight the first nodes are filled; the rest get the same tokens per weight, which is the largest value of
    (budget - limits before) ÷ (weights from here on).
    """
    group = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(0))
    by = group.orderBy(F.col(limit) / F.col(weight), *order)
    before = F.coalesce(F.sum(limit).over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    onward = F.sum(weight).over(by.rowsBetween(0, Window.unboundedFollowing))
    rate = nodes.where(F.col(weight) > 0).withColumn("_rate", (F.col(budget) - before) / onward)
    return (rate.withColumn("_rate", F.max("_rate").over(group))
            .withColumn("target", F.least(F.col(limit), F.greatest(F.lit(0), F.floor(F.col("_rate") * F.col(weight)))).cast("long"))
            .drop("_rate"))


def _seeded(seed: int, epoch: Column, doc_id: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), doc_id))


def plan_mixture(rows: DataFrame, levels: Sequence[str], weights: Sequence[Column], budget_share: float = 0.5, max_epochs: int = 2,
                 seed: int = 17) -> DataFrame:
    """One row per leaf: the levels, leaf_tokens, target, epochs (whole ones), and the end of the prefix in the epoch after these: cut_at
    and cut_text (the document it ends in; NULL if there is none), cut_tokens (what each row of that document gives).

    ``rows``: levels, id (text), text_key, tokens. ``weights``: one integer column per level, over the level columns and ``tokens``.
    """
    levels = list(levels)
    tree = cut_lineage(rows.groupBy(*levels).agg(F.sum("tokens").alias("tokens")).where(F.col("tokens") > 0))
    whole = tree.agg(F.floor(F.coalesce(F.sum("tokens"), F.lit(0)) * F.lit(float(budget_share))).cast("long")).first()[0]
    above = None
    for depth in range(1, len(levels) + 1):
        own = levels[:depth]
        nodes = tree if depth == len(levels) else tree.groupBy(*own).agg(F.sum("tokens").alias("tokens"))
        nodes = nodes.withColumn("limit", F.col("tokens") * max_epochs).withColumn("weight", weights[depth - 1])
        nodes = nodes.withColumn("budget", F.lit(whole)) if above is None else join_per_key(nodes, above, own[:-1], "inner")
        above = shared_out(nodes, own[:-1], own[-1:], "weight", "limit", "budget")
        if depth < len(levels):
            above = above.select(*own, F.col("target").alias("budget"))
    plan = cut_lineage(above.select(
        *levels, F.col("tokens").alias("leaf_tokens"), "target", F.expr("target div tokens").alias("epochs"),
        F.expr("target % tokens").alias("rest")))

    part = join_per_key(rows.where(F.col("tokens") > 0), plan.where(F.col("rest") > 0), levels, "inner")
    part = part.select(*levels, "text_key", "tokens", _seeded(seed, F.col("epochs"), F.col("id")).alias("at"), F.col("rest").alias("left"))
    for digits in BUCKET_DIGITS:
        part = part.withColumn("bucket", F.substring("at", 1, digits))
        sums = part.groupBy(*levels, "bucket", "left").agg(F.sum("tokens").alias("tokens"))
        run = Window.partitionBy(*levels).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        last = (sums.withColumn("before", F.coalesce(F.sum("tokens").over(run), F.lit(0)))
                .where((F.col("before") < F.col("left")) & (F.col("before") + F.col("tokens") >= F.col("left")))
                .select(*levels, "bucket", (F.col("left") - F.col("before")).alias("left")))
        part = cut_lineage(join_per_key(part.drop("left"), last, [*levels, "bucket"], "inner").drop("bucket"))
    inside = part.groupBy(*levels, "left", "at", "text_key").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("n"))
    run = Window.partitionBy(*levels).orderBy("at", "text_key").rowsBetween(Window.unboundedPreceding, -1)
    ends = (inside.withColumn("before", F.coalesce(F.sum("tokens").over(run), F.lit(0)))
            .where((F.col("before") < F.col("left")) & (F.col("before") + F.col("tokens") >= F.col("left")))
            .select(*levels, F.col("at").alias("cut_at"), F.col("text_key").alias("cut_text"),
                    F.expr("(left - before) div n").alias("cut_tokens")))
    return cut_lineage(join_per_key(plan.drop("rest"), ends, levels, "left"))


def shares(rows: DataFrame, plan: DataFrame, levels: Sequence[str], tokens: str, doc_id: str, key: str, seed: int = 17) -> DataFrame:
    """Rows joined to their leaf's plan with ``epochs`` and ``part_tokens`` (of the epoch after); rows that give nothing go."""
    out = join_per_key(rows, plan.drop("leaf_tokens", "target"), list(levels), "inner")
    at = _seeded(seed, F.col("epochs"), F.col(doc_id))
    first = (at < F.col("cut_at")) | (at == F.col("cut_at")) & (F.col(key) < F.col("cut_text"))
    ending = (at == F.col("cut_at")) & (F.col(key) == F.col("cut_text"))
    part = F.when(first, F.col(tokens)).when(ending, F.col("cut_tokens")).otherwise(F.lit(0)).cast("long")
    return (out.withColumn("part_tokens", part).drop("cut_at", "cut_text", "cut_tokens")
            .where((F.col(tokens) > 0) & ((F.col("epochs") > 0) | (F.col("part_tokens") > 0))))


def leaf_rows(docs: DataFrame, levels: Mapping[str, Column], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """id as text, text_key, the level columns and tokens, written once to the shared folder."""
    return cut_lineage(docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"), F.xxhash64(F.col(text)).alias("text_key"),
                                   *[c.alias(n) for n, c in levels.items()], token_count(text).alias("tokens")))


def mixture(docs: DataFrame, levels: Mapping[str, Column], weights: Sequence[Column], doc_id: str = "doc_id", text: str = "text",
            struct: str = "mix", **options) -> DataFrame:
    """The documents that the mixture takes, with a struct column: the levels, tokens, epochs (times taken whole), part_tokens (first
    tokens taken once more). A struct name that a column has already is made longer."""
    seed = options.get("seed", 17)
    plan = plan_mixture(leaf_rows(docs, levels, doc_id, text), list(levels), weights, **options)
    p = free_prefix(docs, "_m")
    names = list(levels)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(f"{p}row"),
                       F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias(f"{p}id"), F.xxhash64(F.col(text)).alias(f"{p}key"),
                       *[c.alias(n) for n, c in levels.items()], token_count(text).alias("tokens"))
    out = shares(rows, plan, names, "tokens", f"{p}id", f"{p}key", seed)
    name = struct if struct.lower() not in [c.lower() for c in docs.columns] else p + struct
    return out.select(f"{p}row.*", F.struct(*names, "tokens", "epochs", "part_tokens").alias(name))
