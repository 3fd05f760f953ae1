"""Mixing sources to target weights: temperature mixing, realised as budgeted block permutations."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqloom.llm.common import fresh, materialize, words_of

#: Halvings of the exponent's range.
HALVINGS = 50
#: Sources whose token counts may reach the driver; more are bisected over by aggregations.
SOURCES = 100_000
#: Blocks of a source that one task sums up.
GROUP = 4096


def _bisect(met: Callable[[float], bool]) -> float:
    """The smallest exponent in [0, 1] that meets the targets; 1 if none does."""
    low, high = 0.0, 1.0
    for _ in range(HALVINGS):
        middle = (low + high) / 2
        low, high = (low, middle) if met(middle) else (middle, high)
    return high


def _meets(most: float, entropy: float, target_entropy: float | None, max_repetition: float | None) -> bool:
    return (max_repetition is None or most <= max_repetition) and (target_entropy is None or entropy <= target_entropy)


def temperature_weights(tokens: dict[str, int], target_entropy: float | None = None, max_repetition: float | None = None, cover: bool = False) -> dict[str, float]:
    """Weights proportional to (token share) ** exponent, the smallest exponent in [0, 1] that meets the targets.

    ``target_entropy``: at most so many nats.  ``max_repetition``: no source is repeated more often,
    for a budget of all tokens (or, with ``cover``, for the budget that reads every source at least
    once).  Both fall as the exponent grows, so it is bisected; 1 keeps the sources' own shares.
    Sources without tokens have weight 0.
    """
    total = sum(tokens.values())
    share = {s: n / total for s, n in sorted(tokens.items()) if n > 0}

    def weights(x: float) -> dict[str, float]:
        power = {s: p**x for s, p in share.items()}
        norm = sum(power.values())
        return {s: p / norm for s, p in power.items()}

    def met(x: float) -> bool:
        w = weights(x)
        over = [w[s] / share[s] for s in w]
        return _meets(max(over) / (min(over) if cover else 1.0), -sum(p * math.log(p) for p in w.values()), target_entropy, max_repetition)

    if not share:
        return {s: 0.0 for s in tokens}
    return {s: 0.0 for s in tokens} | weights(_bisect(met))


def _goals_of_few(per_source: DataFrame, target_entropy: float | None, max_repetition: float | None, budget_tokens: int | None, cover: bool) -> DataFrame:
    """(source, n, goal): tokens and target tokens of each of up to SOURCES sources."""
    tokens = {r["source"]: r["n"] for r in per_source.collect()}
    weights = temperature_weights(tokens, target_entropy, max_repetition, cover)
    if cover:
        budget = max((n / weights[s] for s, n in tokens.items() if n), default=0.0)
    else:
        budget = sum(tokens.values()) if budget_tokens is None else budget_tokens
    rows = [(s, n, math.floor(weights[s] * budget + (1e-6 if cover else 0.0))) for s, n in sorted(tokens.items())]
    return F.broadcast(per_source.sparkSession.createDataFrame(rows, "source string, n long, goal long"))


def _goals_of_many(per_source: DataFrame, target_entropy: float | None, max_repetition: float | None, budget_tokens: int | None, cover: bool) -> DataFrame:
    """The same for any number of sources: each step of the bisection is one aggregation over the table of sources, and no source reaches the driver."""
    total = per_source.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    share = (F.col("n") / F.lit(float(max(1, total)))).alias("share")
    full = per_source.where("n > 0").select("n", share)

    def sums(x: float) -> tuple[float, float, float, float]:
        power = F.pow("share", F.lit(x))
        # w = power / norm: entropy and repetition follow from sums over powers.
        r = full.agg(F.sum(power), F.sum(power * F.log(power)), F.max(power / F.col("share")), F.min(power / F.col("share"))).first()
        return (r[0], r[1], r[2], r[3]) if r[0] else (1.0, 0.0, 0.0, 1.0)

    def met(x: float) -> bool:
        norm, plogp, high, low = sums(x)
        return _meets(high / (low if cover else norm), math.log(norm) - plogp / norm, target_entropy, max_repetition)

    x = _bisect(met)
    norm, _, _, low = sums(x)
    weight = F.when(F.col("n") > 0, F.pow("share", F.lit(x)) / F.lit(norm)).otherwise(F.lit(0.0))
    budget = (total * norm / low if cover else float(total)) if budget_tokens is None or cover else float(budget_tokens)
    return per_source.select("source", "n", share).select("source", "n", F.floor(weight * F.lit(budget) + F.lit(1e-6 if cover else 0.0)).alias("goal"))


def order_key(*parts: Column) -> Column:
    """A pseudo-random long: the first 15 hexadecimal digits of an md5."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *[p.cast("string") for p in parts])), 1, 15), 16, 10).cast("long")


def _source() -> Column:
    return F.coalesce(F.col("source").cast("string"), F.lit(""))


def _text_hash() -> Column:
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def mixing_plan(
    docs: DataFrame,
    target_entropy: float | None = None,
    max_repetition: float | None = None,
    budget_tokens: int | None = None,
    cover: bool = False,
    block_tokens: int = 1 << 18,
    seed: int = 42,
    max_sources: int = SOURCES,
) -> DataFrame:
    """(doc_id, source, tokens, block, copies, text_hash) for every row of ``docs(doc_id, source, text, ...)``.

    Each source gets floor(weight * budget) tokens: whole passes over it, then one partial pass.
    For the partial pass the source's documents stand in blocks of about ``block_tokens``, dealt
    by a hash of doc_id, and the blocks in a pseudo-random order; blocks are taken while they fit
    the rest of the budget, and from the first that doesn't, its documents in a pseudo-random
    order while they fit.  ``budget_tokens`` is all tokens if None; with ``cover`` it is the least
    that reads every source once or more.  Tokens are words.

    Up to ``max_sources`` sources, one number for each reaches the driver; beyond, none does.  Running sums go over groups
    of blocks, over the blocks of a group, and over the documents of one block, so a hot source is no hot task.  Null
    text has no tokens (and is read in whole passes only); null source is the source ''; a null
    doc_id has a key of its own; rows that repeat a doc_id share its place in the order and are told
    apart by a hash of their text.  An empty table gives an empty plan; other columns are not read.
    """
    sizes = materialize(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            _source().alias("source"),
            F.size(words_of(F.col("text"))).cast("long").alias("tokens"),
            _text_hash().alias("text_hash"),
        ),
        "sizes",
    )
    per_source = materialize(sizes.groupBy("source").agg(F.sum("tokens").alias("n")), "sources")
    goals_of = _goals_of_few if per_source.count() <= max_sources else _goals_of_many
    whole = lambda c: F.when(F.col("n") > 0, c).otherwise(F.lit(0)).cast("long")
    goals = goals_of(per_source, target_entropy, max_repetition, budget_tokens, cover).select(
        "source",
        whole(F.expr("goal div greatest(n, 1)")).alias("passes"),
        whole(F.pmod("goal", F.greatest("n", F.lit(1)))).alias("rest"),
        F.expr(f"greatest(1, (n + {block_tokens - 1}) div {block_tokens})").cast("long").alias("blocks"),
    )
    doc_key = order_key(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    dealt = sizes.join(goals, "source").withColumn("key", doc_key).withColumn("block", F.col("key") % F.col("blocks"))
    blocks = dealt.groupBy("source", "block").agg(F.sum("tokens").alias("size"), F.first("rest").alias("rest"), F.first("blocks").alias("blocks"))
    ranked = blocks.withColumn("turn", order_key(F.lit(seed), F.lit("block"), F.col("source"), F.col("block")))
    # Two levels of running sums: blocks stand in groups by the upper part of their turn, a number below 16 ** 15.
    ranked = ranked.withColumn("group", F.floor(F.col("turn") / F.lit(16.0**15) * F.ceil(F.col("blocks") / GROUP)))
    groups = ranked.groupBy("source", "group").agg(F.sum("size").alias("group_size"))
    ahead = F.sum("group_size").over(Window.partitionBy("source").orderBy("group").rowsBetween(Window.unboundedPreceding, -1))
    offsets = groups.select("source", "group", F.coalesce(ahead, F.lit(0)).alias("ahead"))
    turn = Window.partitionBy("source", "group").orderBy("turn", "block").rowsBetween(Window.unboundedPreceding, 0)
    ranked = ranked.withColumn("inside", F.sum("size").over(turn)).join(offsets, ["source", "group"]).withColumn("upto", F.col("inside") + F.col("ahead"))
    # Sums never fall, so only the first block beyond the rest begins within it.
    state = F.when(F.col("upto") <= F.col("rest"), F.lit("whole")).when(F.col("upto") - F.col("size") <= F.col("rest"), F.lit("part"))
    taken = ranked.withColumn("state", state).where("state IS NOT NULL").select("source", "block", "state", (F.col("rest") - F.col("upto") + F.col("size")).alias("room"))
    marked = dealt.join(taken, ["source", "block"], "left")
    inside = Window.partitionBy("source", "block").orderBy("key", "doc_id", "text_hash").rowsBetween(Window.unboundedPreceding, 0)
    part = marked.where("state = 'part'").withColumn("more", F.when(F.sum("tokens").over(inside) <= F.col("room"), 1).otherwise(0))
    other = marked.where("state IS NULL OR state <> 'part'").withColumn("more", F.when(F.col("state") == "whole", 1).otherwise(0))
    # Documents without tokens never use up a budget; they are read in whole passes.
    more = F.when(F.col("tokens") > 0, F.col("more")).otherwise(0)
    return part.unionByName(other).select("doc_id", "source", "tokens", "block", (F.col("passes") + more).alias("copies"), "text_hash")


def mix_sources(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` as often as ``mixing_plan`` says, with their columns, of any names, as they were.

    Rows meet the plan by doc_id (null among them), source and a hash of the text; rows that repeat all three are read equally often.
    """
    id_, source, text, copies, turn = fresh(docs, "_id", "_source", "_text", "_copies", "_pass")
    plan = mixing_plan(docs, **options).groupBy("doc_id", "source", "text_hash").agg(F.max("copies").alias("copies")).where("copies > 0")
    plan = plan.toDF(id_, source, text, copies)
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(id_)) & (_source() == F.col(source)) & (_text_hash() == F.col(text))
    joined = docs.join(plan, same)
    return joined.withColumn(turn, F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies)))).select(*docs.columns)
