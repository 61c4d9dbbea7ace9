"""Folders of tables for the edge cases: empty, all null, and noisy (nulls, repeats, very long texts, extra columns)."""

import os

from pyspark.sql import functions as F

TABLES = ("samples", "assets", "asset_usage", "scenes", "sample_files", "mix_targets", "split_targets", "documents", "eval_items")
EXTRA = ("h", "size", "rank", "id", "path", "n", "v", "prefix", "range", "uses", "group", "pos", "pre", "bare", "chars", "version", "source_name", "asset")


def make(spark, sf, folder, kind):
    for t in TABLES:
        df = spark.read.parquet(f"{sf}/{t}.parquet")
        if kind == "empty":
            df = df.limit(0)
        elif kind == "null":
            df = df.limit(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields])
        else:
            ids = {"row_id", "id", "file_id", "doc_id", "item_id", "key", "field_name", "source_name", "target_share", "max_repeats", "split_name", "uid", "lang"}
            cols = [c if c in ids else F.when(F.xxhash64(*[x for x in df.columns if x in ids], F.lit(c)) % 5 == 0, None).otherwise(F.col(c)).alias(c) for c in df.columns]
            df = df.select(*cols)
            if "text" in df.columns:
                df = df.withColumn("text", F.when(F.monotonically_increasing_id() == 1, F.repeat(F.lit("very long text "), 40_000)).otherwise(F.col("text")))
            df = df.withColumns({c: F.lit("clash") for c in EXTRA if c not in df.columns})
            df = df.unionByName(df.limit(5)) if t not in ("mix_targets", "split_targets") else df
        df.write.parquet(os.path.join(folder, f"{t}.parquet"))
    return str(folder)
