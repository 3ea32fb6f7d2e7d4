"""Mixing sources to target weights.

Words are counted per document and summed per source; each source gets a target (share of a word
budget by weight, never above ``cap`` times its own size, the excess reshared by weight), hence a
repetition rate. A document is emitted floor(rate) times plus one copy drawn by a hash-seeded
Bernoulli trial whose probability is the fraction.

Defined results: a null text counts 0 words; a null source is a source of its own and comes last;
rows with a repeated doc_id each count; a row is drawn by its id or, without one, by its text (repeated rows agree);
an empty table gives an empty mix; other columns pass through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plotwise.llm.tables import fresh, stage

WORD = r"[^\x20\x09-\x0D]+"
SEED = "mix-1"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def unit_hash(*parts: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) from the first 52 bits of an MD5 over the parts (nulls left out)."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), *[p.cast("string") for p in parts]))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def draw_key(docs: DataFrame) -> Column:
    """What tells the rows of a source and size apart: the id, or the text where the id is missing."""
    return F.coalesce(docs["doc_id"].cast("string"), F.concat(F.lit("text "), F.xxhash64(docs["text"]).cast("string")))


def source_targets(sizes: DataFrame, weights=(3, 1, 2), budget: float = 1.5, cap: float = 2.0) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row per source.

    Water filling in closed form: ordered by cap/weight, sources are capped until the budget left,
    dealt by weight over the remaining sources, lies below the next cap. The windows run over one row
    per source, never over documents.
    """
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    top = F.col("source_size") * F.lit(cap)
    order = W.orderBy("_ratio", "_rank")
    before, rest = order.rowsBetween(W.unboundedPreceding, -1), order.rowsBetween(0, W.unboundedFollowing)
    whole = W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    ranked = sizes.withColumn("_rank", rank).withColumn("_w", weight).withColumn("_top", top)
    level = (F.lit(budget) * F.sum("source_size").over(whole) - F.coalesce(F.sum("_top").over(before), F.lit(0.0))) / F.sum("_w").over(rest)
    filled = ranked.withColumn("_ratio", F.col("_top") / F.col("_w")).withColumn("_level", level)
    # the level of the first source that stays below its cap holds for all after it
    found = F.min(F.when(F.col("_level") <= F.col("_ratio"), F.struct("_ratio", "_rank", "_level"))).over(whole)
    return filled.withColumn("_found", found).select(
        "source", "source_size",
        F.when(F.struct("_ratio", "_rank") < F.struct(F.col("_found._ratio"), F.col("_found._rank")), F.col("_top"))
        .otherwise(F.least(F.coalesce(F.col("_found._level") * F.col("_w"), F.col("_top")), F.col("_top"))).alias("target"))


def mix_counts(docs: DataFrame, weights=(3, 1, 2), budget: float = 1.5, cap: float = 2.0, seed: str = SEED) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken), one row per row of ``docs``.

    Texts are read once (the sizes are staged). The per-source table is joined on without a hint: Spark
    measures it, broadcasts it when small and splits a hot source otherwise.
    """
    sized = stage(docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), draw_key(docs).alias("_draw")), "mix-sizes")
    targets = source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, budget, cap)
    targets = targets.withColumnRenamed("source", "_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    drawn = unit_hash(F.col("_draw"), F.col("source"), F.col("size"), seed=seed) < F.col("_rate") - F.floor("_rate")
    return (sized.join(targets, F.col("source").eqNullSafe(F.col("_source")))
            .withColumn("_rate", rate)
            .withColumn("copies", (F.floor("_rate") + drawn.cast("int")).cast("long"))
            .select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken")))


def mix(docs: DataFrame, weights=(3, 1, 2), budget: float = 1.5, cap: float = 2.0, seed: str = SEED) -> DataFrame:
    """``docs`` with every document repeated as the mix takes it (0, 1, 2, ... times); same columns."""
    size, rate, key = fresh(docs, "_size", "_rate", "_key")
    sizes = docs.groupBy("source").agg(F.sum(n_words(F.col("text"))).alias("source_size"))
    rates = source_targets(sizes, weights, budget, cap).select(
        F.col("source").alias(key),
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)).alias(rate))
    joined = docs.join(stage(rates, "mix-rates"), docs["source"].eqNullSafe(F.col(key))).withColumn(size, n_words(F.col("text")))
    drawn = unit_hash(draw_key(docs), F.col("source"), F.col(size), seed=seed) < F.col(rate) - F.floor(rate)
    copies = (F.floor(rate) + drawn.cast("int")).cast("int")
    return joined.withColumn(size, F.explode(F.array_repeat(F.lit(1), copies))).select(*[docs[c] for c in docs.columns])
