"""Mixing sources to target weights, in DataFrame operations only.

Sizes are summed per source, targets follow from the weights by water-filling (a source stops at ``cap`` times its size
and the excess is shared again), and the repetition rate of a source is target over size. Each document is taken
floor(rate) times plus one hash-seeded Bernoulli copy with probability equal to the fraction. Every source has
``SEEDS`` candidate seeds; one pass sums what each seed would take and the seed nearest to the target is used. A copy's
draw under a seed is Bernoulli; that the seed is picked by its sum conditions the draws of a source on each other (sums
near the target are likelier), which is meant: README gives the size of the effect.

Defined results: null text has size 0 and is taken like any other document of its source (0 words); a null source is a
source of its own, ordered last; a null doc_id draws as the text 'null'; repeated rows draw alike; sources
without words have target 0 and rate 0; an empty table gives an empty result; extra columns, whatever their names, are
carried by ``mix`` and ignored by ``plan_mix``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldloom.llm.common import WORD, all_of, fresh, materialise, text_or_empty, with_global_rank

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2
SEEDS = 16


def n_words(column: str = "text") -> Column:
    return F.regexp_count(text_or_empty(column), F.lit(f"{WORD}+")).cast("long")


def draw(seed: int, id_column: str = "doc_id") -> Column:
    """A number in [0, 1) from the id and a seed; four seeds share a digest."""
    digest = F.md5(F.concat(F.lit(f"{seed // 4}:"), F.coalesce(F.col(id_column).cast("string"), F.lit("null"))))
    return F.conv(F.substring(digest, 1 + 8 * (seed % 4), 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """source, source_size, target: one row per source of sizes (source, size)."""
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = with_global_rank(sources, [F.col("source").asc_nulls_last()], "sources")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = materialise(ranked.select("source", "source_size", weight.alias("weight")), "weights")
    most = F.col("source_size") * cap
    size, weighed = ranked.agg(F.sum("source_size"), F.sum("weight")).first()
    total = share * (size or 0)
    level = total / weighed if weighed else 0.0
    while True:  # the level only rises, and each rise caps at least one more source
        full = most <= F.lit(level) * F.col("weight")
        held, free = ranked.agg(F.sum(F.when(full, most).otherwise(0)), F.sum(F.when(full, 0).otherwise(F.col("weight")))).first()
        higher = (total - held) / free if free else level
        if higher <= level:
            break
        level = higher
    return ranked.select("source", "source_size", F.least(most.cast("double"), F.lit(level) * F.col("weight")).alias("target"))


def _copies(rate: Column, seed: Column | int) -> Column:
    if isinstance(seed, int):
        lucky = draw(seed)
    else:
        lucky = F.element_at(F.array(*[draw(k) for k in range(SEEDS)]), seed + 1)
    return (F.floor(rate) + (lucky < rate - F.floor(rate)).cast("long")).cast("long")


def _sizes(docs: DataFrame) -> DataFrame:
    return materialise(docs.select("doc_id", "source", n_words().alias("size")), "sizes")


def rates(sizes: DataFrame, **options) -> DataFrame:
    """mix_source, source_size, target, rate, seed: one row per source of sizes (doc_id, source, size)."""
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    targets = materialise(source_targets(sizes, **options).withColumn("rate", rate), "targets").withColumnRenamed("source", "mix_source")
    rated = sizes.join(targets, F.col("source").eqNullSafe(F.col("mix_source")))
    tried = [F.sum(F.col("size") * _copies(F.col("rate"), k)).alias(f"t{k}") for k in range(SEEDS)]
    sums = rated.groupBy("mix_source", "source_size", "target", "rate").agg(*tried)
    nearest = F.array_min(F.array(*[F.struct(F.abs(F.col(f"t{k}") - F.col("target")).alias("off"), F.lit(k).alias("seed")) for k in range(SEEDS)]))
    return materialise(sums.select("mix_source", "source_size", "target", "rate", nearest["seed"].alias("seed")), "rates")


def plan_mix(docs: DataFrame, **options) -> DataFrame:
    """Per row of docs: doc_id, source, size, source_size, target, copies, taken."""
    sizes = _sizes(docs)
    chosen = sizes.join(rates(sizes, **options), F.col("source").eqNullSafe(F.col("mix_source")))
    copies = chosen.withColumn("copies", _copies(F.col("rate"), F.col("seed")))
    return copies.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each row of docs as often as its copies say, with the columns of docs.

    The rates, a row per source, are joined to the documents; Spark sends them to the texts where its size check allows.
    """
    name, rate, copy = (fresh(docs.columns, n) for n in ("mix_source", "mix_rate", "mix_copy"))
    plan = rates(_sizes(docs), **options).select(F.col("mix_source").alias(name), F.struct("rate", "seed").alias(rate))
    taken = docs.join(plan, F.col("source").eqNullSafe(F.col(name)))
    copies = _copies(F.col(f"{rate}.rate"), F.col(f"{rate}.seed"))
    return taken.withColumn(copy, F.explode(F.array_repeat(F.lit(1), copies.cast("int")))).select(*all_of(docs))
