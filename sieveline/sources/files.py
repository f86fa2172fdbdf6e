"""Other file sources and sinks."""

from __future__ import annotations

import json

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def optional(spark: SparkSession, path: str, schema: T.StructType, kind: str = "parquet") -> DataFrame:
    """A source that may be missing: then an empty table of its schema."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).format(kind).load(path)


def string_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """CSV with a header, all columns strings, malformed rows left out."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.schema(schema).options(header=True, quote='"', escape='"', mode="DROPMALFORMED").csv(path)


def research_ids(spark: SparkSession, path: str) -> DataFrame:
    """Ids that a JSON-lines file of judgements calls research."""
    rows = spark.read.schema("work_id string, verdict string").json(path)
    return rows.where(F.col("verdict") == "research").select("work_id").distinct()


def overrides(spark: SparkSession, path: str) -> DataFrame:
    """A JSON object by nano id as rows ``nano_key, status, reason, date, by, rederive_ladder``."""
    entry = "struct<status:string,reason:string,date:string,by:string,rederive_ladder:boolean>"
    text = spark.read.option("wholetext", True).text(path)
    return text.select(F.explode(F.from_json("value", f"map<string,{entry}>")).alias("nano_key", "o")).select("nano_key", "o.*")


def npz_embeddings(spark: SparkSession, path: str, ids: str = "cids", matrix: str = "V") -> DataFrame:
    """``cid, embedding`` of a NumPy archive. Such an archive is one file read by one process; convert it to Parquet
    once and read that instead at scale."""
    z = np.load(path)
    rows = [(int(i), [float(x) for x in v]) for i, v in zip(z[ids], z[matrix])]
    return spark.createDataFrame(rows, "cid bigint, embedding array<float>")


def write_ordered(df: DataFrame, path: str, *keys: str) -> None:
    """Parquet in the order of the keys: ranges over files, sorted within each."""
    df.repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode("overwrite").parquet(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_summary(row: dict, path: str) -> None:
    """A few numbers as one JSON document, written by the driver."""
    with open(path, "w", encoding="utf-8") as f:
        json.dump(row, f, ensure_ascii=False, indent=1, sort_keys=True)


def signature_matches(folder: str, signature: str) -> bool:
    """Whether parts in a folder were made by code of this signature; an empty folder takes it on."""
    from pathlib import Path

    mark = Path(folder) / "_CODE_SIG"
    if mark.exists():
        return mark.read_text() == signature
    mark.parent.mkdir(parents=True, exist_ok=True)
    mark.write_text(signature)
    return True
