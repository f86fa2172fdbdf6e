"""Proximity of the strands of a nano, and its core."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config


def unit(vector: Column) -> Column:
    """The vector in doubles at length one; null stays null, a zero vector stays zero."""
    v = F.transform(vector, lambda x: x.cast("double"))
    size = F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))
    return F.transform(v, lambda x: F.when(size > 0, x / size).otherwise(F.lit(0.0)))


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def baseline(embeddings: DataFrame) -> DataFrame:
    """Mean and deviation of the cosine over all ordered pairs, themselves included, without making a pair.

    The mean is |sum v|^2 / n^2; the mean square is the squared norm of the matrix of second moments over n^2. Every task
    adds up that matrix over its batches and sends it once, so what is shuffled is a matrix for each task, not for each vector.
    """

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, first, second = 0, None, None
        for b in batches:
            if not b.num_rows:
                continue
            x = b.column(0).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(b.num_rows, -1)
            size = np.sqrt((x * x).sum(axis=1, keepdims=True))
            x = np.divide(x, size, out=np.zeros_like(x), where=size > 0)
            n += len(x)
            first = x.sum(axis=0) if first is None else first + x.sum(axis=0)
            second = x.T @ x if second is None else second + x.T @ x
        if first is not None:
            d = len(first)
            i, j = np.r_[-1, np.arange(d), np.repeat(np.arange(d), d)], np.r_[-1, np.full(d, -1), np.tile(np.arange(d), d)]
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(np.r_[float(n), first, second.ravel()])], names=["i", "j", "x"])

    cells = embeddings.where(F.col("embedding").isNotNull()).select("embedding").mapInArrow(moments, "i int, j int, x double").groupBy("i", "j").agg(F.sum("x").alias("x"))
    square = F.col("x") * F.col("x")
    one = cells.agg(F.max(F.when(F.col("i") < 0, F.col("x"))).alias("n"), F.sum(F.when((F.col("i") >= 0) & (F.col("j") < 0), square)).alias("s1"), F.sum(F.when(F.col("j") >= 0, square)).alias("s2"))
    mu = F.col("s1") / (F.col("n") * F.col("n"))
    return one.select(mu.alias("mu"), F.sqrt(F.col("s2") / (F.col("n") * F.col("n")) - mu * mu).alias("sd"))


def proximity(strands: DataFrame, base: DataFrame, tau: float = config.TAU, ref_min: int = config.REF_MIN_DOCS) -> DataFrame:
    """``nano_id, cid, n, share, prox, far`` of strands ``(nano_id, cid, n, embedding)``.

    The proximity of a strand is the share-weighted mean of the standardised cosine to the reference strands (at least
    ``ref_min`` documents) other than itself. With C the weighted sum of the reference vectors it needs one aggregate
    and one join per nano: no pair of strands is made. A nano needs two strands with a vector. Where the reference set
    is empty without the strand the proximity is null and ``far`` false.
    """
    s = strands.where(F.col("embedding").isNotNull()).select("nano_id", "cid", "n", unit(F.col("embedding")).alias("v"))
    size = s.groupBy("nano_id").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("strands")).where(F.col("strands") >= 2)
    s = s.join(size, "nano_id").withColumn("share", F.col("n") / F.col("total"))
    ref = s.where(F.col("n") >= ref_min)
    centre = ref.select("nano_id", "share", F.posexplode("v").alias("i", "x")).groupBy("nano_id", "i").agg(F.sum(F.col("share") * F.col("x")).alias("c"))
    centre = centre.groupBy("nano_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "c"))), lambda p: p["c"]).alias("centre"))
    weight = ref.groupBy("nano_id").agg(F.sum("share").alias("weight"))
    near = s.join(centre.join(weight, "nano_id"), "nano_id", "left").join(F.broadcast(base))  # base is one row
    own = F.when(F.col("n") >= ref_min, F.col("share")).otherwise(F.lit(0.0))
    rest = F.coalesce("weight", F.lit(0.0)) - own
    top = (_dot(F.col("v"), F.col("centre")) - F.col("mu") * F.col("weight")) / F.col("sd") - own * (_dot(F.col("v"), F.col("v")) - F.col("mu")) / F.col("sd")
    prox = F.when(rest > 1e-12, top / rest)
    return near.select("nano_id", "cid", "n", "share", prox.alias("prox")).withColumn("far", F.coalesce(F.col("prox") < tau, F.lit(False)))


def core_shares(strands: DataFrame, ref_min: int = config.REF_MIN_DOCS) -> DataFrame:
    """Per nano: documents in far strands, attached documents, core strands of ``ref_min`` documents, share of the core."""
    far = F.col("far")
    a = strands.groupBy("nano_id").agg(F.sum(F.when(far, F.col("n")).otherwise(0)).alias("far_docs"), F.sum("n").alias("attached_docs"), F.count_if(~far & (F.col("n") >= ref_min)).alias("n_core_strands"))
    return a.withColumn("core_share", 1 - F.col("far_docs") / F.greatest("attached_docs", F.lit(1)))


def residue(members: DataFrame, flagged: DataFrame, excluded: DataFrame, no_info: DataFrame) -> DataFrame:
    """Members of flagged nanos that are neither excluded nor without information, by nano."""
    left = members.join(flagged.select("nano_id").distinct(), "nano_id", "left_semi")
    left = left.join(excluded.select("work_id"), "work_id", "left_anti").join(no_info.select("work_id"), "work_id", "left_anti")
    return left.groupBy("nano_id").agg(F.count(F.lit(1)).alias("n_residue"))


def attachment(nanos: DataFrame, least: float) -> DataFrame:
    """Share of a nano's documents that are attached to a strand, null without any, and whether it is under ``least``."""
    frac = F.when(F.col("attached_docs") > 0, F.col("attached_docs") / F.greatest("denom", F.lit(1)))
    return nanos.withColumn("attach_frac", frac).withColumn("attach_frac_low", F.coalesce(F.col("attach_frac") < least, F.lit(False)))
