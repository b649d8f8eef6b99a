"""Receipts that decide whether finished work may be reused."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONFIG = "struct<backend:string,method:string,lang:string,model_source:string,version:string>"
RECEIPT = "struct<conversion_provenance:struct<version:int,source_sha256:string,build_config:string>,artifacts:array<struct<canonical:string,sha256:string>>>"
RECORD = f"struct<version:int,source_sha256:string,extraction_config:{CONFIG},files:map<string,string>>"


def inventory(files: DataFrame) -> DataFrame:
    """(book, files): the SHA-256 of each file's bytes by path; `files`: book, relpath, content. A book without files has no row."""
    one = files.select("book", "relpath", F.sha2("content", 256).alias("sha256"))
    return one.groupBy("book").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("relpath", "sha256")))).alias("files"))


def config(backend: Column, method: Column, lang: Column, model_source: Column, version: Column) -> Column:
    """The identity of an extraction: the method counts unless the model reads pages whole, the language only for the pipeline."""
    return F.struct(
        backend.alias("backend"), F.when(backend != "vlm-engine", method).alias("method"), F.when(backend == "pipeline", lang).alias("lang"), model_source.alias("model_source"), version.alias("version"),
    )


def recorded(work: DataFrame) -> DataFrame:
    """(book, record, error): the record of a finished extraction as JSON text, none where the source changed under it or no file came out.

    `work`: book, source_path, source_sha256, kept_sha256, config (struct as in `config`), files (map), finished_at.
    """
    error = F.when(~F.col("source_sha256").eqNullSafe(F.col("kept_sha256")), "source changed during extraction").when(F.col("files").isNull() | (F.size("files") == 0), "no files")
    record = F.to_json(F.struct(F.lit(1).alias("version"), F.col("finished_at").alias("timestamp"), F.col("source_path").alias("source_pdf"), "source_sha256", F.col("config").alias("extraction_config"), "files"))
    return work.select("book", F.when(error.isNull(), record).alias("record"), error.alias("error"))


def _sorted(m: Column) -> Column:
    return F.array_sort(F.map_entries(m))


def verify_extractions(work: DataFrame) -> DataFrame:
    """(book, verdict): null where the kept extraction may be reused, else the first failed check.

    `work`: book, record (JSON text), source_sha256, kept_sha256, config (struct as in `config`), files (map of what lies there now).
    """
    r = F.from_json("record", RECORD)
    rows = work.select("*", r.alias("r"))
    verdict = (
        F.when(F.col("r").isNull() | F.col("r.version").isNull() & F.col("r.source_sha256").isNull(), "no provenance").when(~F.col("r.version").eqNullSafe(F.lit(1)) | ~F.col("r.source_sha256").eqNullSafe(F.col("source_sha256")), "different source bytes")
        .when(~F.to_json("r.extraction_config").eqNullSafe(F.to_json("config")), "configuration changed").when(~F.col("kept_sha256").eqNullSafe(F.col("r.source_sha256")), "kept source was modified")
        .when(F.col("files").isNull() | ~_sorted(F.col("r.files")).eqNullSafe(_sorted(F.col("files"))), "files changed or incomplete")
    )
    return rows.select("book", verdict.alias("verdict"))


def attested(outputs: DataFrame, receipts: DataFrame) -> DataFrame:
    """(book, attested): whether every output of a book has a receipt with its source, configuration, path and hash.

    `outputs`: book, path, sha256, source_sha256, build_config; `receipts`: body (JSON text; damaged ones are skipped).
    """
    read = receipts.select(F.from_json("body", RECEIPT).alias("r")).where(F.col("r.conversion_provenance.version") == 1)
    made = read.select(F.col("r.conversion_provenance.source_sha256").alias("source_sha256"), F.col("r.conversion_provenance.build_config").alias("build_config"), F.explode("r.artifacts").alias("a"))
    made = made.select("source_sha256", "build_config", F.lower("a.canonical").alias("key"), F.col("a.sha256").alias("sha256")).distinct()
    keyed = outputs.withColumn("key", F.lower("path"))
    good = keyed.join(made, ["source_sha256", "build_config", "key", "sha256"], "left_semi").select("book", "key").distinct().withColumn("ok", F.lit(1))
    return keyed.select("book", "key").distinct().join(good, ["book", "key"], "left").groupBy("book").agg((F.count("ok") == F.count(F.lit(1))).alias("attested"))


def azw3_error(content: Column) -> Column:
    """Null for a file whose header is that of the format."""
    return F.when((F.length(content) < 100) | (F.substring(content, 61, 8) != F.lit(b"BOOKMOBI")), "invalid header")
