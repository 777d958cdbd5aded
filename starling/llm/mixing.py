"""Operator 9: mixing sources to target weights, DataFrame functions only.

A source with share p of all tokens gets the weight p^a / sum of p^a. The
exponent a is bisected, in rounds of ``GRID`` points that one aggregation over
the sources evaluates at once: to a target entropy of the weights (which falls
as a grows; the upper end, 1, is doubled until it is reached), or to the smallest a at which no source is repeated
more often than a limit (repeats fall as a grows). With a budget of T tokens a
source of t tokens is drawn weight x T / t times. Without a budget T is the
least at which every source is drawn ``min_repeats`` times.

The draws are block permutations. A source's documents are dealt into
``BLOCKS`` blocks by a hash. Every whole repeat draws all of them once, in an
order of blocks and of documents within blocks that differs from repeat to
repeat. What is left of a source's budget draws its blocks in such an order
until the budget is used, the last block document by document. A document is
drawn if the budget is not used up before it, so a source is off its budget by
less than one document.

A source with a third of all rows is spread over its blocks: sums are made by
(source, block), the only window over a whole source has BLOCKS rows, and
documents meet their plan in a join on (source, block).

Defined cases: a null source is a source of its own; a null or empty text and
a null token count have 0 tokens; a source without tokens has weight 0 and is
drawn once; ties in the order of documents are broken by their id and text;
repeated rows are rows of their own; an empty table gives no rows; further
columns stay.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starling.llm.common import cut

#: Points of a bisection round, rounds, and doublings of the upper end.
GRID, ROUNDS, DOUBLINGS = 257, 4, 40
#: Blocks of a source.
BLOCKS = 1 << 12
#: Seed of the permutations.
SEED = 20240501


def word_tokens(text: str = "text") -> Column:
    """Number of words of a text."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _grid(low: float, high: float) -> list[float]:
    return [low + (high - low) * i / (GRID - 1) for i in range(GRID)]


def bisect_exponent(totals: DataFrame, target_entropy: float | None = None, max_repeats: float | None = None,
                    budget: int | None = None, min_repeats: float = 1.0) -> float:
    """The exponent for the tokens per source in ``totals`` (column t). One row
    of GRID values reaches the driver in each round."""
    if (target_entropy is None) == (max_repeats is None):
        raise ValueError("give a target entropy or a limit on repeats")
    of = totals.where("t > 0").agg(F.sum("t").alias("whole"), F.max("t").alias("most"), F.count("*").alias("k")).first()
    whole = of["whole"] or 0
    if not whole:
        return 1.0
    if target_entropy is not None and target_entropy > math.log(of["k"]) + 1e-9:
        raise ValueError("the target entropy is above that of equal weights")
    share = F.log(F.col("t") / F.lit(float(whole if target_entropy is None else of["most"])))  # entropy: any scale
    some = totals.where("t > 0").select(share.alias("p"))

    def first_fit(grid: list[float]) -> int | None:
        sums = some.select("p", F.posexplode(F.lit(grid)).alias("i", "a")).groupBy("i").agg(
            F.sum(F.exp(F.col("a") * F.col("p"))).alias("z"),
            F.sum(F.exp(F.col("a") * F.col("p")) * F.col("p")).alias("zp"),
            F.max((F.col("a") - 1) * F.col("p")).alias("most"), F.min((F.col("a") - 1) * F.col("p")).alias("least"),
            F.first("a").alias("a"))
        if target_entropy is not None:
            fits = F.log("z") - F.col("a") * F.col("zp") / F.col("z") <= target_entropy + 1e-12
        elif budget is not None:  # most repeats: budget / whole x p^(a - 1) / z
            fits = F.lit(budget / whole) * F.exp("most") / F.col("z") <= max_repeats * (1 + 1e-12)
        else:
            fits = F.lit(float(min_repeats)) * F.exp(F.col("most") - F.col("least")) <= max_repeats * (1 + 1e-12)
        return sums.where(fits).agg(F.min("i")).first()[0]

    low, high = 0.0, 1.0
    for k in range(ROUNDS):
        grid = _grid(low, high)
        first = first_fit(grid)
        if first is None and k == 0 and target_entropy is not None:  # repeats are fewest at 1
            grid = [2.0**i for i in range(DOUBLINGS + 1)]
            first = first_fit(grid)
        if first is None:
            if k == 0:
                raise ValueError("no exponent meets the target entropy or the limit on repeats")
            return high
        if first == 0:
            return low
        low, high = grid[first - 1], grid[first]
    return high


def source_plan(totals: DataFrame, exponent: float, budget: int | None = None, min_repeats: float = 1.0) -> DataFrame:
    """(source, t, weight, quota, whole, rest): tokens, weight, tokens to draw,
    whole repeats and tokens of the last, partial one."""
    unit = 1.0 if exponent <= 1 else float(totals.agg(F.max("t")).first()[0] or 1)  # no power overflows
    power = F.when(F.col("t") > 0, F.pow(F.col("t") / F.lit(unit), F.lit(exponent))).otherwise(0.0)
    sums = totals.agg(F.sum(power).alias("z"), F.max(F.when(F.col("t") > 0, F.try_divide(F.col("t"), power))).alias("m")).first()
    z, m = sums["z"] or 1.0, sums["m"] or 0.0
    amount = float(budget) if budget is not None else min_repeats * m * z
    plan = totals.withColumn("weight", power / F.lit(z)).withColumn("quota", F.col("weight") * F.lit(amount))
    # a quota within a millionth of whole repeats is whole repeats
    ratio = F.when(F.col("t") > 0, F.col("quota") / F.col("t")).otherwise(1.0)
    near = F.when(F.abs(ratio - F.round(ratio)) < 1e-6, F.round(ratio)).otherwise(ratio)
    return (plan.withColumn("_r", near).withColumn("whole", F.floor("_r").cast("long"))
            .withColumn("rest", (F.col("_r") - F.col("whole")) * F.col("t")).drop("_r"))


def mix(docs: DataFrame, target_entropy: float | None = None, max_repeats: float | None = None,
        budget: int | None = None, min_repeats: float = 1.0, tokens: Column | None = None, source: str = "source",
        seed: int = SEED) -> DataFrame:
    """The draws: rows of ``docs``, each as often as it is drawn, with a struct
    column ``draw`` (n_tokens, exponent, weight, repeat from 0, block_order and
    doc_order; the mixture is read in the order repeat, block_order, doc_order)."""
    names = docs.columns
    n_tokens = F.coalesce((word_tokens() if tokens is None else tokens).cast("long"), F.lit(0))
    own = F.xxhash64(F.lit(seed), F.col(source), F.col("doc_id"), F.col("text"))
    rows = docs.select(F.struct(*names).alias("row"), F.col(source).alias("source"), n_tokens.alias("n"), own.alias("own"))
    rows = rows.withColumn("block", F.pmod(F.col("own"), F.lit(BLOCKS)).cast("int"))
    blocks = cut(rows.groupBy("source", "block").agg(F.sum("n").alias("n")))
    totals = blocks.groupBy("source").agg(F.sum("n").alias("t"))
    exponent = bisect_exponent(totals, target_entropy, max_repeats, budget, min_repeats)
    plan = source_plan(totals, exponent, budget, min_repeats).withColumnRenamed("source", "plan_source")

    order = lambda repeat, *key: F.xxhash64(F.lit(seed), repeat, *key)
    by_block = Window.partitionBy("source").orderBy("last_order", "block").rowsBetween(Window.unboundedPreceding, -1)
    planned = (blocks.join(plan, F.col("source").eqNullSafe(F.col("plan_source")))
               .withColumn("last_order", order(F.col("whole"), "source", "block"))
               .withColumn("used", F.coalesce(F.sum("n").over(by_block), F.lit(0)))
               .select(F.col("source").alias("plan_source"), F.col("block").alias("plan_block"), "weight", "whole", "rest", "used"))
    by_doc = (Window.partitionBy("source", "block").orderBy(order(F.col("whole"), "own"), "own")
              .rowsBetween(Window.unboundedPreceding, -1))
    met = rows.join(planned, F.col("source").eqNullSafe(F.col("plan_source")) & (F.col("block") == F.col("plan_block")))
    before = F.col("used") + F.coalesce(F.sum("n").over(by_doc), F.lit(0))
    repeats = F.col("whole") + F.when(before < F.col("rest"), 1).otherwise(0)
    drawn = (met.withColumn("times", repeats).where("times > 0")
             .withColumn("repeat", F.explode(F.sequence(F.lit(0).cast("long"), F.col("times") - 1))))
    draw = F.struct(F.col("n").alias("n_tokens"), F.lit(exponent).alias("exponent"), F.col("weight"), F.col("repeat"),
                    order(F.col("repeat"), "source", "block").alias("block_order"),
                    order(F.col("repeat"), "own").alias("doc_order"))
    return drawn.select(*(F.col("row").getField(c).alias(c) for c in names), draw.alias("draw"))
