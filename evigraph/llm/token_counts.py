"""Token counts: an exact length histogram.

Documents are aggregated by encoded length, first within each batch and then by length, so what moves is one row for each distinct length and
task. Suffix sums over the lengths then answer totals, quantiles and truncated totals for every context limit. The sums run over
blocks of lengths, so no task gets all lengths.

A null text counts as empty (length 0). Repeated rows each count. An empty table gives an empty histogram. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, ship
from .tokens import default_path, encoder, slices

BLOCK = 1024


def _lengths(path: str):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        coder = encoder(path)
        for batch in batches:
            column = batch.column(0)
            for start, n in slices(column):
                ids = coder.encode_batch(column.slice(start, n))
                ends = np.frombuffer(ids.buffers()[1], dtype=np.int32, count=n + 1) if n else np.zeros(1, np.int32)
                length, count = np.unique(np.diff(ends) // 2, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(length.astype(np.int64)), pa.array(count.astype(np.int64))], ["n_tokens", "n_docs"])

    return run


def histogram(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(n_tokens, n_docs): how many documents encode to each length."""
    ship(docs.sparkSession)
    pairs = docs.select("text").mapInArrow(_lengths(path or default_path()), "n_tokens long, n_docs long")
    return pairs.groupBy("n_tokens").agg(F.sum("n_docs").alias("n_docs"))


def suffix_sums(hist: DataFrame) -> DataFrame:
    """For each length L that occurs: n_docs, docs and tokens of that length or more, and all tokens left if texts are cut at L."""
    cells = hist.withColumn("block", F.floor(F.col("n_tokens") / BLOCK)).withColumn("tokens", F.col("n_tokens") * F.col("n_docs"))
    blocks = cells.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    after = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)  # a row for each 1024 lengths
    later = blocks.select("block", F.coalesce(F.sum("d").over(after), F.lit(0)).alias("d_after"), F.coalesce(F.sum("t").over(after), F.lit(0)).alias("t_after"))
    all_tokens = blocks.agg(F.sum("t").alias("total_tokens"))
    here = Window.partitionBy("block").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, 0)
    out = cells.join(later, "block").select(
        "n_tokens",
        "n_docs",
        (F.sum("n_docs").over(here) + F.col("d_after")).alias("docs_at_least"),
        (F.sum("tokens").over(here) + F.col("t_after")).alias("tokens_at_least"),
    )
    out = out.crossJoin(F.broadcast(all_tokens))  # one row
    kept = F.col("total_tokens") - F.col("tokens_at_least") + F.col("n_tokens") * F.col("docs_at_least")
    return out.select("n_tokens", "n_docs", "docs_at_least", "tokens_at_least", kept.alias("truncated_total"))


def truncated_total(sums: DataFrame, limit: int) -> int:
    """All tokens left if texts are cut at any limit, also one that is no document's length."""
    row = sums.filter(F.col("n_tokens") >= limit).orderBy("n_tokens").select("docs_at_least", "tokens_at_least").limit(1).collect()
    total = sums.agg(F.max("tokens_at_least")).first()[0] or 0
    return total if not row else total - row[0][1] + limit * row[0][0]


def quantile(sums: DataFrame, q: float) -> int | None:
    """The least length that at least a share q of the documents don't exceed."""
    n = sums.agg(F.max("docs_at_least")).first()[0]
    if not n:
        return None
    upto = F.lit(n) - F.col("docs_at_least") + F.col("n_docs")
    return sums.filter(upto >= F.lit(q) * n).agg(F.min("n_tokens")).first()[0]


def token_counts(docs: DataFrame, path: str | None = None) -> DataFrame:
    return suffix_sums(materialize(histogram(docs, path)))  # read three times below: texts are encoded once
