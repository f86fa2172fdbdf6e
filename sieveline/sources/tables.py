"""Typed readers for the tables of the project."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

S, L, D, B, I, TS = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType(), T.IntegerType(), T.TimestampType()


def _schema(**cols: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v, True) for k, v in cols.items()])


SCHEMAS: dict[str, T.StructType] = {
    "bib_store": _schema(work_id=S, title_display=S, abstract_display=S, publication_year=I, type_openalex=S, language=S, loaded_at=TS),
    "atlas_work_membership": _schema(work_id=S, effective_nano_id=L, loaded_at=TS),
    "work_meta": _schema(work_id=S, is_retracted=B),
    "junk_doc_flags": _schema(work_id=S, nano_id=L, title_head=S, reason=S),
    "junk_doc_flags_v3": _schema(work_id=S, nano_id=L, title_head=S, junk_types=T.ArrayType(S), flag_source=S, flag_only=B),
    "exclusion_flags": _schema(work_id=S, nano_id=L, reason=S, title_head=S, snapshot=S),
    "exclusion_flags_v3": _schema(work_id=S, nano_id=L, reason=S, title_head=S, snapshot=S),
    "a5_dist": _schema(
        nano_id=L, members=L, jd=L, ut=L, comb=L, core_n=L, core_comb=L, core_jd=L,
        pct_mem_comb=D, pct_mem_jd=D, pct_core_comb=D, pct_core_jd=D,
    ),
    "junk_title_type_dist": _schema(nano_id=L, junk_type=S, docs=L),
    "documents": _schema(doc_id=L, work_id=S, nano_id=L, text=S, lang=S, source=S, n_chars=L, fetched_at=TS),
    "mix_targets": _schema(mix_name=S, source=S, target_share=D, max_repeats=I),
    "embeddings": _schema(vec_id=L, embedding=T.ArrayType(T.FloatType()), label=I),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of ``sf_dir``; the declared schema is used where there is one, so no footer is read to infer it."""
    reader = spark.read
    if name in SCHEMAS:
        reader = reader.schema(SCHEMAS[name])
    return reader.parquet(f"{sf_dir}/{name}.parquet")
