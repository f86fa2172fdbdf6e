"""Mixing sources to target weights (problem 8).

Method: hash-threshold histograms. A document's place is a 48-bit hash of its id. Tokens are summed by source and
hash bucket; along the buckets the budget of each (mix, source) falls into one boundary bucket, and only that bucket
is refined by the next bits, until it holds single documents. The threshold found is a filter: nothing is sorted, and
thresholds of several mixes over one source are nested.

A mix takes the largest total at which each of its sources can give its share within its ``max_repeats``; a source is
repeated whole as often as its budget asks for, and the rest comes from the documents below the threshold. Weights need
not sum to one. A share that is null, NaN, zero or negative counts as zero, null repeats as one. Sources without tokens
have no part in the total and are reported with a reached share of zero. Several rows of one (mix, source) add up their
shares and keep the least repeats. Documents of null source or without tokens are never taken. Repeated rows of a
document are separate records with the same place. Empty inputs give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import cut

BITS, LEVELS = 12, 4
#: Rows of the plan up to which it is broadcast (about 100 bytes each); a larger plan is joined with salted keys.
BROADCAST_ROWS = 100_000
SALTS = 32


def _place(id_col: str) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.col(id_col), F.lit("mix")), 64 - BITS * LEVELS)


def _clean_targets(targets: DataFrame) -> DataFrame:
    share = F.coalesce(F.when(~F.isnan("target_share") & (F.col("target_share") > 0), F.col("target_share")), F.lit(0.0))
    repeats = F.greatest(F.coalesce("max_repeats", F.lit(1)), F.lit(0))
    known = targets.where(F.col("mix_name").isNotNull() & F.col("source").isNotNull())
    rows = known.groupBy("mix_name", "source").agg(F.sum(share).alias("weight"), F.min(repeats).alias("max_repeats"))
    total = F.sum("weight").over(Window.partitionBy("mix_name"))
    return rows.withColumn("target_share", F.when(total > 0, F.col("weight") / total).otherwise(F.lit(0.0)))


def _budgets(targets: DataFrame, totals: DataFrame) -> DataFrame:
    """Per (mix, source) with a budget: whole repeats and the tokens still wanted after them."""
    rows = targets.join(totals, "source").where((F.col("weight") > 0) & (F.col("max_repeats") > 0))
    most = F.min(F.col("size") * F.col("max_repeats") / F.col("weight")).over(Window.partitionBy("mix_name"))
    budget = F.least(F.round(F.col("weight") * most).cast("long"), F.col("size") * F.col("max_repeats"))
    rows = rows.withColumn("budget", budget)
    return rows.select("mix_name", "source", F.expr("cast(budget div size as int)").alias("whole"), F.expr("budget % size").alias("wanted"))


def thresholds(sized: DataFrame, targets: DataFrame, id_col: str, source_col: str, size_col: str) -> DataFrame:
    """``mix_name, source, whole, bound``: a document is taken ``whole`` times, once more if its place is below ``bound``."""
    docs = sized.select(_place(id_col).alias("place"), F.col(source_col).alias("source"), F.col(size_col).alias("n")).where(F.col("source").isNotNull() & (F.col("n") > 0))
    shift = BITS * (LEVELS - 1)
    hist = cut(docs.groupBy("source", F.shiftright("place", shift).alias("bucket")).agg(F.sum("n").alias("n")))
    totals = hist.groupBy("source").agg(F.sum("n").alias("size"))
    open_ = cut(_budgets(_clean_targets(targets), totals).withColumn("before", F.lit(0).cast("long")))
    near = docs
    for level in range(LEVELS):
        run = Window.partitionBy("mix_name", "source").orderBy("bucket")
        if level == 0:
            cells = open_.join(hist, "source")
        else:
            shift = BITS * (LEVELS - 1 - level)
            edge = open_.select("source", F.col("bucket").alias("edge")).distinct()
            near = cut(near.join(edge, (near.source == edge.source) & (F.shiftright("place", shift + BITS) == F.col("edge")), "left_semi"))
            finer = near.groupBy("source", F.shiftright("place", shift).alias("bucket")).agg(F.sum("n").alias("n"))
            cells = open_.withColumnRenamed("bucket", "edge").join(finer, "source").where(F.shiftright("bucket", BITS) == F.col("edge")).drop("edge")
        upto = F.col("before") + F.sum("n").over(run)
        cells = cells.withColumn("upto", upto).where(F.col("upto") > F.col("wanted"))
        # the first bucket that goes beyond the budget; there always is one, as the budget is less than the source
        open_ = cut(
            cells.groupBy("mix_name", "source", "whole", "wanted")
            .agg(F.min_by(F.struct("bucket", (F.col("upto") - F.col("n")).alias("before"), "n"), "bucket").alias("e"))
            .select("mix_name", "source", "whole", "wanted", "e.bucket", "e.before", "e.n")
        )
        if level < LEVELS - 1:
            open_ = open_.drop("n")
    nearer = (F.col("before") + F.col("n") - F.col("wanted")) < (F.col("wanted") - F.col("before"))
    return open_.select("mix_name", "source", "whole", F.when(nearer, F.col("bucket") + 1).otherwise(F.col("bucket")).alias("bound"))


def select_mix(sized: DataFrame, targets: DataFrame, id_col: str = "doc_id", source_col: str = "source", size_col: str = "n_tokens") -> DataFrame:
    """``mix_name, <id_col>, source, n_tokens, repeats``: the documents of each mix and how often each is used."""
    bounds = cut(thresholds(sized, targets, id_col, source_col, size_col))
    docs = sized.select(F.col(id_col).alias(id_col), F.col(source_col).alias("source"), F.col(size_col).alias("n_tokens")).where(F.col("n_tokens") > 0)
    if bounds.count() <= BROADCAST_ROWS:
        both = docs.join(F.broadcast(bounds), "source")
    else:
        salted = docs.withColumn("salt", F.pmod(F.xxhash64(id_col), F.lit(SALTS)).cast("int"))
        both = salted.join(bounds.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), ["source", "salt"]).drop("salt")
    repeats = F.col("whole") + (_place(id_col) < F.col("bound")).cast("int")
    return both.select("mix_name", id_col, "source", "n_tokens", repeats.alias("repeats")).where(F.col("repeats") > 0)


def reached_shares(selection: DataFrame, targets: DataFrame) -> DataFrame:
    """Target and reached share of each (mix, source) of the targets."""
    taken = selection.groupBy("mix_name", "source").agg(
        F.count(F.lit(1)).alias("docs"), F.sum(F.col("n_tokens") * F.col("repeats")).alias("tokens"), F.max("repeats").alias("most_repeats")
    )
    rows = _clean_targets(targets).join(taken, ["mix_name", "source"], "left")
    total = F.sum(F.coalesce("tokens", F.lit(0))).over(Window.partitionBy("mix_name"))
    share = F.when(total > 0, F.coalesce("tokens", F.lit(0)) / total).otherwise(F.lit(0.0))
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("docs", "tokens", "most_repeats")]
    return rows.select("mix_name", "source", "target_share", "max_repeats", *zero, share.alias("reached_share"))
