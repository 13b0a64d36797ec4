"""JSON corpora, chunk files and configurations."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .markdown import SECTION, TABLE

METADATA = "struct<chip_category:string,document_type:string,sub_category:string,file_name:string,file_path:string,file_size:bigint,created_time:string,content_hash:string,language:string>"
DOCUMENT = f"struct<metadata:{METADATA},sections:array<{SECTION}>,summary:string,keywords:array<string>,tables:array<{TABLE}>,images:array<string>>"
CHUNK = "struct<id:string,type:string,text:string,metadata:struct<chip_category:string,document_type:string,sub_category:string,file_name:string,language:string,section_type:string,title:string,level:int,headers:array<string>,row_count:int>,tags:array<string>>"


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """The documents of ``{metadata, documents: [...]}`` files; one row each."""
    rows = spark.read.json(path, schema=f"documents array<{DOCUMENT}>", multiLine=True)
    return rows.select(F.explode("documents").alias("d")).select("d.*")


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """The chunks of an array file; a missing or broken one gives no rows."""
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in spark.createDataFrame([], f"c {CHUNK}").schema["c"].dataType.fields)
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.json(path, schema=schema, multiLine=True, mode="DROPMALFORMED").where("id is not null")


def read_ready(spark: SparkSession, path: str) -> DataFrame:
    """All three arrays of a file ready to be embedded, with the array's name as ``kind``."""
    rows = spark.read.json(path, schema=", ".join(f"{k} array<{CHUNK}>" for k in ("documents", "sections", "tables")), multiLine=True)

    def named(k: str):
        return F.transform(F.coalesce(k, F.array().cast(f"array<{CHUNK}>")), lambda c: F.struct(F.lit(k).alias("kind"), c.alias("c")))

    parts = [named(k) for k in ("documents", "sections", "tables")]
    return rows.select(F.explode(F.concat(*parts)).alias("x")).select("x.kind", "x.c.*")


def read_config(path: str, defaults: dict) -> dict:
    """A JSON file's settings over the defaults; the defaults alone if it is missing or broken."""
    try:
        with open(path, encoding="utf-8") as f:
            return defaults | json.load(f)
    except (OSError, ValueError):
        return dict(defaults)
