"""Mixing sources to target weights by temperature, in DataFrame operations only.

The share p of a source's tokens is raised to a power alpha in [0, 1] and normalised: 1 keeps the natural
mix, 0 makes all sources equal. The exponent is found by bisection in which one Spark job tries ``TRIES``
exponents at once, so the bracket shrinks by that factor per job:

* ``entropy`` asks for the largest exponent with which the weights' entropy is at least this share of its
  maximum;
* ``max_repeats`` asks for the least exponent with which no document is used more often than this; given
  both, the entropy's exponent is raised as far as the limit needs.

The budget in tokens is given, or by default the smallest with which every source is used in full. Each
source's documents get a pseudo-random order, cut into blocks. A source's part of the budget is realised
as whole passes over its documents and one pass that ends where the budget does; every pass permutes the
blocks anew, and ``slot`` orders them across sources.

Order keys are hashes, so where the last pass ends is found from token sums by the key's leading digits,
and only the documents of one last block are ever ordered one by one. No source is gathered or sorted.

Defined results: a null source is a source of its own; a text without words has no tokens; equal rows
share one place in the order and are used alike; a source without tokens has weight 0 and is used once,
as is every row of a table without tokens; other columns are handed on untouched.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions.workspace import materialize

TRIES = 63
#: Bits of a digit of the order key; two digits name a block.
BITS = 10
#: Sources up to which their few numbers are broadcast; beyond, they are joined like any table.
BROADCAST_SOURCES = 20_000
TOLERANCE = 1e-9
WORDS = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Target:
    """What the mix must meet; the budget is in tokens, None for the smallest that uses every source in full."""

    entropy: float | None = None
    max_repeats: float | None = None
    budget: float | None = None
    seed: int = 17


def n_tokens(text: Column) -> Column:
    """Pieces without ASCII white space; 0 for a null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def order_key(seed: int) -> Column:
    """A row's place in the pseudo-random order of its source; compared as a signed number."""
    return F.xxhash64(F.lit(seed), "doc_id", F.xxhash64("text"))


def _digit(place: int) -> Column:
    """The key's digits, most significant first, in the key's order."""
    shifted = F.shiftright("key", 64 - BITS * (place + 1))
    return shifted + (1 << (BITS - 1)) if place == 0 else shifted.bitwiseAND(F.lit((1 << BITS) - 1))


def _tried(sizes: DataFrame, low: float, high: float) -> list[tuple[float, float, float, float]]:
    """For exponents spread over the bracket: exponent, sum of powers, entropy, and the range of use per token."""
    alphas = [low + (high - low) * k / (TRIES - 1) for k in range(TRIES)]
    power = F.pow("share", "alpha")
    rows = (
        sizes.where("share > 0")
        .select("share", F.explode(F.array(*[F.lit(a) for a in alphas])).alias("alpha"))
        .groupBy("alpha")
        .agg(F.sum(power).alias("total"), F.sum(power * F.log(power)).alias("part"),
             F.max(power / F.col("share")).alias("most"), F.min(power / F.col("share")).alias("least"), F.count("*").alias("n"))
        .collect()
    )
    return sorted((r["alpha"], r["total"], math.log(r["total"]) - r["part"] / r["total"], r["most"], r["least"], r["n"]) for r in rows)


def _bisect(sizes: DataFrame, meets: Callable[[tuple], bool], low: float, high: float, above: bool) -> float:
    """The end of the exponents that meet a limit: the least if they lie ``above`` it, else the largest."""
    while True:
        rows = _tried(sizes, low, high)
        fits = [k for k, row in enumerate(rows) if meets(row)]
        if not fits:
            return high if above else low
        best = fits[0] if above else fits[-1]
        if high - low <= TOLERANCE or best == (0 if above else len(rows) - 1):
            return rows[best][0]
        low, high = (rows[best - 1][0], rows[best][0]) if above else (rows[best][0], rows[best + 1][0])


def exponent(sizes: DataFrame, target: Target, tokens: int) -> float:
    """The exponent for a table with a column share of ``tokens`` tokens."""
    def even(row: tuple) -> bool:
        return row[2] >= target.entropy * math.log(row[5]) - TOLERANCE

    def rare(row: tuple) -> bool:
        _, total, _, most, least, _ = row
        repeats = most / least if target.budget is None else most / total * target.budget / tokens
        return repeats <= target.max_repeats * (1 + TOLERANCE)

    alpha = 0.0 if target.max_repeats is not None else 1.0
    if target.entropy is not None:
        alpha = _bisect(sizes, even, 0.0, 1.0, above=False)
    if target.max_repeats is not None:
        alpha = _bisect(sizes, rare, alpha, 1.0, above=True)
    return alpha


def _stop(sums: DataFrame, at: str) -> DataFrame:
    """Per source, the first ``at`` where the running sum passes ``left``, and what is left before it."""
    run = Window.partitionBy("id").orderBy(at).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = sums.withColumn("run", F.sum("tokens").over(run)).where(F.col("run") > F.col("left"))
    first = F.min(F.struct(F.col(at), (F.col("left") - F.col("run") + F.col("tokens")).alias("left")))
    return summed.groupBy("id").agg(first.alias("stop")).select("id", f"stop.{at}", "stop.left")


@dataclass
class Mix:
    """Per source: weight, whole passes and the key where the last pass ends."""

    keyed: DataFrame  # doc_id, id, tokens, key
    sources: DataFrame  # source, id, tokens, weight, passes, end
    alpha: float
    few: bool


def plan(docs: DataFrame, target: Target) -> Mix:
    """Measure the sources, find the exponent and where each source's last pass ends."""
    identity = F.xxhash64(F.col("source").isNull(), "source")
    keyed = materialize(docs.select(
        "doc_id", "source", identity.alias("id"), n_tokens(F.col("text")).alias("tokens"), order_key(target.seed).alias("key")), "keyed")
    measured = materialize(keyed.groupBy("id").agg(F.first("source").alias("source"), F.sum("tokens").alias("tokens")), "sources")
    tokens, n = measured.agg(F.sum("tokens"), F.count("*")).first()
    sizes = measured.withColumn("share", F.col("tokens") / F.lit(float(tokens or 1)))
    alpha = exponent(sizes, target, tokens) if tokens else 1.0
    power = F.when(F.col("share") > 0, F.pow("share", F.lit(alpha))).otherwise(0.0)
    total = sizes.agg(F.sum(power)).first()[0] or 1.0
    weighed = sizes.withColumn("weight", power / F.lit(total))
    budget = target.budget
    if budget is None:
        budget = weighed.where("weight > 0").agg(F.max(F.col("tokens") / F.col("weight"))).first()[0] or 0.0
    times = F.when(F.col("weight") > 0, F.col("weight") * F.lit(float(budget)) / F.col("tokens")).otherwise(1.0)
    weighed = weighed.withColumn("passes", F.floor(times + TOLERANCE)).withColumn(
        "left", F.greatest(F.lit(0.0), times - F.col("passes")) * F.col("tokens"))
    open_ones = weighed.where(F.col("left") > F.col("tokens") * TOLERANCE).select("id", "left")
    few = n <= BROADCAST_SOURCES
    near = F.broadcast if few else (lambda df: df)
    digits = keyed.select("id", "tokens", "key", _digit(0).alias("d0"), _digit(1).alias("d1"))
    first = _stop(digits.groupBy("id", "d0").agg(F.sum("tokens").alias("tokens")).join(near(open_ones), "id"), "d0")
    inside = digits.join(near(first), ["id", "d0"])
    second = _stop(inside.groupBy("id", "d0", "left", "d1").agg(F.sum("tokens").alias("tokens")), "d1")
    last = inside.drop("left").join(near(second), ["id", "d1"]).groupBy("id", "left", "key").agg(F.sum("tokens").alias("tokens"))
    # The last pass has the keys before the one that passes the budget.
    end = _stop(last, "key").select("id", F.col("key").alias("end"))
    return Mix(keyed, materialize(weighed.join(end, "id", "left").drop("left", "share"), "mix"), alpha, few)


def realise(docs: DataFrame, mix: Mix, target: Target) -> DataFrame:
    """Rows of ``docs`` (columns id and key beside its own), one for each use, with weight, pass, block and slot."""
    numbers = mix.sources.select("id", "weight", "passes", "end")
    placed = docs.join(F.broadcast(numbers) if mix.few else numbers, "id")
    copies = F.col("passes") + F.coalesce((F.col("key") < F.col("end")).cast("long"), F.lit(0))
    used = placed.withColumn("block", _digit(0) * (1 << BITS) + _digit(1)).where(copies > 0).withColumn(
        "pass", F.explode(F.sequence(F.lit(1).cast("long"), copies)))
    return used.withColumn("slot", F.xxhash64(F.lit(target.seed), "id", "pass", "block")).drop("passes", "end")


def mixed_ids(docs: DataFrame, target: Target) -> DataFrame:
    """doc_id, source, n_tokens, weight, pass, block and slot of every use of a row."""
    mix = plan(docs, target)
    return realise(mix.keyed.withColumnRenamed("tokens", "n_tokens"), mix, target).drop("id", "key")


def mixed_documents(docs: DataFrame, target: Target) -> DataFrame:
    """The rows of ``docs`` as often as they are used, with mix_weight, mix_pass, mix_block and mix_slot."""
    mix = plan(docs, target)
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(own, F.xxhash64(F.col("source").isNull(), "source").alias("id"), order_key(target.seed).alias("key"))
    return realise(rows, mix, target).select("row.*", *[F.col(c).alias(f"mix_{c}") for c in ("weight", "pass", "block", "slot")])
