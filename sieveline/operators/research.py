"""Further research on rules: recounts, comparisons of calls with their key, attribution, batches, forms, genre words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.dialect import matches
from ..functions.text import STOP, det_key
from .skew import top_per_key


def forms(titles: DataFrame, catalogue: dict[tuple[str, str], str]) -> DataFrame:
    """``work_id, type, subform`` of all forms of a catalogue; one projection, one row for each form met."""
    each = F.array_compact(F.array(*[F.when(matches("title", p), F.struct(F.lit(t).alias("type"), F.lit(s).alias("subform"))) for (t, s), p in catalogue.items()]))
    return titles.select("work_id", F.explode(each).alias("f")).select("work_id", "f.type", "f.subform")


def forms_per_work(found: DataFrame) -> DataFrame:
    """The forms of a work as one sorted string."""
    return found.groupBy("work_id").agg(F.concat_ws(",", F.array_sort(F.collect_set("subform"))).alias("subforms"))


def match_calls(key: DataFrame, calls: DataFrame) -> DataFrame:
    """How many works are in the key only, in the calls only, in both, and in both with another batch."""
    k, c = key.select("work_id", F.col("batch").alias("kb"), F.lit(1).alias("in_key")), calls.select("work_id", F.col("call_batch").alias("cb"), F.lit(1).alias("in_calls"))
    both = k.join(c, "work_id", "full_outer")
    return both.agg(F.count_if(F.col("in_calls").isNull()).alias("key_only"), F.count_if(F.col("in_key").isNull()).alias("calls_only"), F.count_if(F.col("in_key").isNotNull() & F.col("in_calls").isNotNull()).alias("both"), F.count_if(F.col("kb") != F.col("cb")).alias("other_batch"))


def assert_matched(matched: DataFrame) -> None:
    """Raises unless every work of the key was called once and in its batch."""
    r = matched.first()
    if r["key_only"] or r["calls_only"] or r["other_batch"]:
        raise ValueError(f"key and calls don't match: {r.asDict()}")


def recount(hits: DataFrame, reported: DataFrame) -> DataFrame:
    """``type, recounted, reported`` of the types whose independent count isn't the reported one."""
    again = hits.select(F.explode("types").alias("type")).groupBy("type").agg(F.count(F.lit(1)).alias("recounted"))
    both = again.join(reported.select("type", F.col("hits").alias("reported")), "type", "full_outer")
    return both.select("type", F.coalesce("recounted", F.lit(0)).alias("recounted"), F.coalesce("reported", F.lit(0)).alias("reported")).where("recounted <> reported")


def attribution(hits: DataFrame) -> DataFrame:
    """Per rule: hits whose head is followed by a comma or a joined dash (the signs that later rules refuse), by overlap."""
    rows = hits.select("title_head", "v2_hit", F.explode("types").alias("type"))
    head = lambda sign: F.col("title_head").rlike(rf"^\s*[\w'’ ]{{1,40}}{sign}")
    return rows.groupBy("type").agg(F.count_if(head(r"\s*,")).alias("comma"), F.count_if(head(r"\s*[–—]")).alias("joined_dash"), F.count_if("v2_hit").alias("in_second"))


def overlapping(hits: DataFrame, some: list[str]) -> DataFrame:
    """Hits of any of the given rules."""
    return hits.where(F.coalesce(F.arrays_overlap("types", F.array(*map(F.lit, some))), F.lit(False)))


def by_retraction(hits: DataFrame, retracted: DataFrame) -> DataFrame:
    """Per rule: hits of works that aren't retracted, those added to and those shared with the second generation, their nanos."""
    rows = hits.join(retracted.select("work_id"), "work_id", "left_anti").select("nano_id", "v2_hit", F.explode("types").alias("type"))
    return rows.groupBy("type").agg(F.count(F.lit(1)).alias("hits"), F.count_if(~F.col("v2_hit")).alias("added"), F.count_if("v2_hit").alias("shared"), F.count_distinct("nano_id").alias("nanos"))


def batches(sample: DataFrame, n: int) -> DataFrame:
    """``work_id, batch`` in the order of a deterministic shuffle; a reader learns nothing of the type from either."""
    key = det_key("work_id", F.lit("batch"))
    return sample.select("work_id").distinct().withColumn("order_key", key).withColumn("batch", F.pmod(F.conv(F.substring("order_key", 1, 8), 16, 10).cast("bigint"), F.lit(n)).cast("int"))


def hash_sample(df: DataFrame, key: str, share: float) -> DataFrame:
    """About ``share`` of the rows by a hash of their key: the same rows in every engine and order."""
    return df.where(F.conv(F.substring(det_key(key), 1, 8), 16, 10).cast("bigint") < int(share * (1 << 32)))


def content_words(normalised: Column) -> Column:
    """Words of three letters or more outside the stop list, in order."""
    return F.filter(F.split(normalised, " "), lambda w: (F.length(w) >= 3) & ~w.isin(STOP))


def expected_totals(counts: DataFrame, expected: dict[str, int]) -> DataFrame:
    """``reason, documents, expected, agrees`` for every reason of either side."""
    told = counts.sparkSession.createDataFrame(list(expected.items()), "reason string, expected bigint")
    both = counts.join(told, "reason", "full_outer")
    return both.select("reason", F.coalesce("documents", F.lit(0)).alias("documents"), F.coalesce("expected", F.lit(0)).alias("expected")).withColumn("agrees", F.col("documents") == F.col("expected"))


def genre_words(titles: DataFrame) -> DataFrame:
    """Works whose title speaks of a genre anywhere in it."""
    return titles.where(matches("title", rules.GENRE_WORD)).select("work_id")


def largest(strands: DataFrame, cap: int) -> DataFrame:
    """The ``cap`` largest strands of each nano in two rounds of ranking, so a nano with very many is no single task; 0 keeps all."""
    return strands if cap <= 0 else top_per_key(strands, "nano_id", [F.desc("n"), F.col("cid")], cap)
