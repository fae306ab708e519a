"""Exact dedup: a tree merge of sorted digest runs.

Every scanned partition turns its rows into a run of digest entries. Runs are then exchanged and merged in rounds, sixteen runs
into one a round (sort-aggregates over hash-dealt runs), and every level keeps one verified best entry per digest: the row with the
most code points, then the smallest id. An entry's key is SHA-256, length and xxHash64 of the normalised text together, so
texts only meet if three independent measures agree. A text that makes up a third of all rows shrinks to one entry a run
before anything is dealt by digest alone.

Text never moves: entries are about sixty bytes. Nulls: a null text counts as empty; a null doc_id is the last choice to
stay. Rows repeated with the same id and text count in group_size and each give a row, of which one at most is kept. An empty table
gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import RUNS, materialize, text_or_empty

#: Characters deleted before texts are compared (fixed values).
BLANKS = (" ", "\t", "\n", "\x0b", "\x0c", "\r")
KEY = ["digest", "norm_len", "norm_xx"]


def normalised(text: Column) -> Column:
    for ch in BLANKS:
        text = F.replace(text, F.lit(ch), F.lit(""))
    return text


def entries(docs: DataFrame) -> DataFrame:
    """One entry for each distinct (key, doc_id, code points), with the number of rows that share it."""
    text = text_or_empty()
    norm = normalised(text)
    return (
        docs.select("doc_id", F.length(text).cast("long").alias("n_points"), norm.alias("norm"))
        .select("doc_id", "n_points", F.unhex(F.sha2("norm", 256)).alias("digest"), F.octet_length("norm").alias("norm_len"), F.xxhash64("norm").alias("norm_xx"))
        .groupBy(*KEY, "doc_id", "n_points")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def tree_merge(runs: DataFrame) -> DataFrame:
    """(key, best, n_rows) of all runs: merged level by level, sixteen runs into one. Best: most points, then smallest id."""
    best = F.max(F.struct("n_points", F.bitwise_not("doc_id").alias("neg_id"), "doc_id")).alias("best")
    level = (
        runs.withColumn("run", F.pmod(F.spark_partition_id(), F.lit(RUNS)))
        .groupBy("run", *KEY)
        .agg(best, F.sum("n_rows").alias("n_rows"))
    )
    width = RUNS
    while width > 1:
        width //= 16
        level = (
            level.withColumn("run", F.shiftright("run", 4))
            .groupBy("run", *KEY)
            .agg(F.max("best").alias("best"), F.sum("n_rows").alias("n_rows"))
        )
    return level.select(*KEY, F.col("best.doc_id").alias("keep_id"), F.col("best.n_points").alias("keep_points"), F.col("n_rows").alias("group_size"))


def classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(entries, classes), both small and free of text; entries are in the shared folder."""
    runs = materialize(entries(docs))
    return runs, tree_merge(runs)


def exact_dedup(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    runs, merged = classes(docs)
    joined = runs.join(merged, KEY)  # a hot class is split by the adaptive skew join
    copies = F.explode(F.sequence(F.lit(1), F.col("n_rows")))
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n_points") == F.col("keep_points")) & (F.col("copy") == 1)
    return joined.select("*", copies.alias("copy")).select(
        "doc_id", "keep_id", "group_size", stays.alias("kept"), F.lower(F.hex("digest")).alias("text_sha256")
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents without their exact copies, all columns as they were: the stage of the pipeline."""
    _, merged = classes(docs)
    norm = normalised(text_or_empty())
    names = docs.columns
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), F.col("doc_id").alias("_id"), F.length(text_or_empty()).cast("long").alias("_points"), norm.alias("_norm"))
    row = row.withColumn("_digest", F.unhex(F.sha2("_norm", 256))).drop("_norm")
    best = merged.select(F.col("digest").alias("_digest"), "keep_id", "keep_points").alias("m")
    found = row.join(best, (row["_digest"] == F.col("m._digest")) & row["_id"].eqNullSafe(F.col("m.keep_id")) & (row["_points"] == F.col("m.keep_points")), "left_semi")
    # rows repeated with the same id and text: one stays
    once = found.groupBy("_id", "_digest", "_points").agg(F.first("_row").alias("_row"))
    return once.select(*[F.col(f"_row.`{c}`").alias(c) for c in names])
