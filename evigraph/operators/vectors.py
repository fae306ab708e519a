"""Vector lookup by an inverted file (H5): coarse cells as partitions on disk, product-quantised residuals beside the vectors, and an exact order of what is left.

Centroids and codebooks are fitted on at most SAMPLE rows (a documented bound); every row is indexed. A lookup reads the codes of the nearest cells, ranks their rows by tables over the code bytes, reads the vectors of the best
SHORTLIST x k and orders those by exact cosine. How many rows an approximate lookup may read is set when the index is built: the least share at which the sample's own rows find TARGET of their true neighbours.
An exact lookup reads on: each cell knows its narrowest member, so cells that cannot hold a nearer row than the k-th found are left out by the triangle inequality, and the rest is read.

Vectors of another length than the index, null ones, ones with null or non-finite components and zero ones have no cosine: they are kept in a cell of their own and never found. Ties go by the smaller key.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship

SAMPLE, SPLITS, STEPS = 8192, 1024, 12
#: Dimensions to a code byte, rows of exact order for each row asked, recall aimed at on the sample.
SUB, SHORTLIST, TARGET = 8, 20, 0.97
#: The cell of rows without a cosine.
NOWHERE = -1


def unit(rows):
    """Rows of length 1; a zero row stays."""
    import numpy as np

    size = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    return rows / np.where(size > 0, size, 1)


def centres(rows, k: int, seed: int, spherical: bool):
    """k centres of some rows by Lloyd's steps from distinct rows; one that loses its rows keeps its place."""
    import numpy as np

    found = np.unique(rows, axis=0)
    rng = np.random.default_rng(seed)
    c = found[rng.choice(len(found), min(k, len(found)), replace=False)].copy()
    for _ in range(STEPS):
        own = nearest(rows, c)
        n = np.bincount(own, minlength=len(c))
        sums = np.zeros_like(c)
        np.add.at(sums, own, rows)
        c[n > 0] = sums[n > 0] / n[n > 0, None]
        if spherical:
            c = unit(c)
    return c


def nearest(rows, c):
    """The nearest centre of each row."""
    return ((c * c).sum(axis=1) - 2 * (rows @ c.T)).argmin(axis=1)


def coded(rows, own, c, books):
    """A byte for each group of SUB dimensions: the nearest entry of its book to the residual."""
    import numpy as np

    left = rows - c[own]
    return np.stack([nearest(left[:, g * SUB : (g + 1) * SUB], b) for g, b in enumerate(books)], axis=1).astype(np.uint8)


def matrix(lists, width: int):
    """(rows, usable): the batch's vectors as a matrix; a row that is no vector of this width is zero and not usable."""
    import numpy as np

    good = np.array([v is not None and len(v) == width for v in lists], bool)
    rows = np.zeros((len(lists), width))
    if good.any():
        rows[good] = np.stack([np.asarray(v, np.float64) for v in lists[good]])
    good &= np.isfinite(rows).all(axis=1)
    rows[~good] = 0
    return unit(rows), good & (rows != 0).any(axis=1)


def _placer(c, books):
    """struct(cell, code, near) of vectors: the cell, the residual's code and the cosine to the cell's centre."""
    width = c.shape[1]

    def place(vec):
        import numpy as np
        import pandas as pd

        rows, good = matrix(vec.to_numpy(), width)
        own = nearest(rows, c)
        codes = coded(rows, own, c, books)
        near = (rows * c[own]).sum(axis=1)
        return pd.DataFrame({"cell": np.where(good, own, NOWHERE).astype(np.int32), "code": [x.tobytes() for x in codes], "near": np.where(good, near, 0.0)})

    return F.pandas_udf(place, "cell int, code binary, near double")


def _code_score(query, c, books):
    """A pandas UDF of (cell, code): the inner product with the query by tables over the code's bytes."""
    import numpy as np

    tables = np.zeros((len(books), 256))
    for g, b in enumerate(books):
        tables[g, : len(b)] = b @ query[g * SUB : (g + 1) * SUB]
    base = c @ query

    def score(cell, code):
        import numpy as np
        import pandas as pd

        if not len(cell):
            return pd.Series([], dtype=float)
        codes = np.frombuffer(b"".join(code), np.uint8).reshape(len(cell), -1)
        return pd.Series(base[cell.to_numpy()] + tables[np.arange(codes.shape[1]), codes].sum(axis=1))

    return F.pandas_udf(score, "double")


def probe_share(sample, c, k: int = 10, target: float = TARGET) -> float:
    """The least share of rows to read: cells are read nearest first until they hold `target` of the true neighbours, on average over every twentieth row of the sample."""
    import numpy as np

    asked = sample[::20]
    if len(sample) <= k or not len(asked):
        return 1.0
    own = nearest(sample, c)
    n = np.bincount(own, minlength=len(c))
    true = np.argpartition(-(asked @ sample.T), k, axis=1)[:, :k]
    order = np.argsort(-(asked @ c.T), axis=1)
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(len(c))[None, :].repeat(len(asked), 0), axis=1)
    reads = np.cumsum(n[order], axis=1) / len(sample)  # the share read with each further cell
    share = np.sort(np.take_along_axis(reads, np.take_along_axis(place, own[true], axis=1), axis=1).ravel())
    return float(share[min(len(share) - 1, math.ceil(target * len(share)) - 1)])


def _sampled(given: DataFrame, n: int, sample: int) -> list:
    """The vectors of the first `sample` rows by a hash of their key. Only rows under a hash that about twice as many lie under are ordered, so that all tasks together hand the driver that many, not `sample` each."""
    usable, share = given.filter("vec is not null"), min(1.0, 2 * sample / max(1, n))
    while True:
        under = usable if share >= 1 else usable.filter(F.xxhash64("doc") <= F.lit(int(share * 2**64) - 2**63))
        taken = under.orderBy(F.xxhash64("doc"), "doc").limit(sample).collect()
        if share >= 1 or len(taken) == sample:
            return [r["vec"] for r in taken]
        share = min(1.0, 8 * share)


class InvertedFile:
    """An index of vectors at a path: open it with opened(), build it with build()."""

    def __init__(self, spark, path: str, c, books, cells: dict[int, tuple[int, float]], share: float, columns: str):
        self.spark, self.path, self.c, self.books, self.cells, self.share, self.columns = spark, path, c, books, cells, share, columns
        self.width, self.size = c.shape[1], sum(n for n, _ in cells.values())

    @property
    def rows(self) -> DataFrame:
        """(doc, vec, code, cell) of all rows."""
        return self.spark.read.schema(self.columns).parquet(f"{self.path}/rows")

    @staticmethod
    def build(df: DataFrame, key: str, vec: str, path: str, sample: int = SAMPLE, cells: int | None = None, target: float = TARGET) -> InvertedFile:
        """Write the index of df's vectors; the width is that of most of the sample's vectors."""
        import numpy as np

        spark = df.sparkSession
        ship(spark)
        given = df.select(F.col(key).alias("doc"), F.col(vec).alias("vec"))
        n = given.count()
        taken = _sampled(given, n, sample)
        sizes = [len(v) for v in taken]
        width = max(set(sizes), key=lambda w: (sizes.count(w), w)) if sizes else 1
        own = np.empty(len(taken), object)
        own[:] = taken
        rows, good = matrix(own, width) if taken else (np.zeros((0, width)), np.zeros(0, bool))
        rows = rows[good]
        if not len(rows):
            rows = np.eye(1, width)
        k = cells or min(SPLITS, max(1, len(rows) // 8), math.ceil(math.sqrt(max(1, n))))
        c = centres(rows, k, 7, True)
        left = rows - c[nearest(rows, c)]
        books = [centres(left[:, g : g + SUB], 256, g, False) for g in range(0, width, SUB)]
        placed = given.withColumn("p", _placer(c, books)(F.col("vec"))).select("doc", "vec", "p.code", "p.near", "p.cell")
        placed.repartition("cell").sortWithinPartitions("cell", "doc").write.mode("overwrite").partitionBy("cell").parquet(f"{path}/rows")
        columns = ", ".join(f"{c} {kind}" for c, kind in placed.dtypes)
        held = spark.read.schema(columns).parquet(f"{path}/rows").groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("near").alias("near")).collect()  # a row a cell
        about = {"centres": c.tolist(), "books": [b.tolist() for b in books], "cells": [[r["cell"], r["n"], r["near"]] for r in held], "share": probe_share(rows, c, target=target), "columns": columns}
        spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/about")
        return InvertedFile.opened(spark, path)

    @staticmethod
    def opened(spark, path: str) -> InvertedFile:
        import numpy as np

        ship(spark)
        about = json.loads(spark.read.text(f"{path}/about", wholetext=True).first()[0])
        return InvertedFile(spark, path, np.array(about["centres"]), [np.array(b) for b in about["books"]], {c: (n, near) for c, n, near in about["cells"]}, about["share"], about["columns"])

    def _asked(self, query: list[float]):
        """The query at length 1; a wrong width is an error, one without a direction is None."""
        import numpy as np

        q = np.asarray(query, float)
        if q.shape != (self.width,):
            raise ValueError(f"a vector of width {len(q)} was asked of an index of width {self.width}")
        return unit(q[None])[0] if np.isfinite(q).all() and q.any() else None

    def probes(self, query: list[float], share: float | None = None) -> list[int]:
        """The nearest cells that together hold `share` of the rows, one at least."""
        import numpy as np

        q, share = self._asked(query), self.share if share is None else share
        if q is None:
            return []
        most, got, total = share * sum(n for c, (n, _) in self.cells.items() if c != NOWHERE), [], 0
        for cell in np.argsort(-(self.c @ q), kind="stable").tolist():
            n = self.cells.get(cell, (0, 0.0))[0]
            if not n:
                continue
            if got and total + n > most:
                break
            got.append(cell)
            total += n
        return got

    def rows_in(self, cells: list[int]) -> int:
        return sum(self.cells[c][0] for c in cells)

    def search(self, query: list[float], k: int, exact: bool = False, share: float | None = None) -> DataFrame:
        """(doc, score): the k nearest by cosine among the cells read; exact: among all rows."""
        q, cells = self._asked(query), self.probes(query, share)
        if q is None or not cells:
            return self._ordered(self.rows.filter(F.lit(False)), [0.0] * self.width, k)
        if exact:
            return self._ordered(self.rows.filter(F.col("cell").isin(self.needed(query, k))), q.tolist(), k)
        codes = self.rows.filter(F.col("cell").isin(cells)).select("cell", "doc", _code_score(q, self.c, self.books)("cell", "code").alias("guess"))
        best = codes.orderBy(F.desc("guess"), "doc").limit(k * SHORTLIST).select("cell", "doc")
        held = self.rows.filter(F.col("cell").isin(cells)).select("cell", "doc", "vec").join(F.broadcast(best.distinct()), ["cell", "doc"], "left_semi")  # k x SHORTLIST rows
        return self._ordered(held, q.tolist(), k)

    def needed(self, query: list[float], k: int) -> list[int]:
        """The cells an exact lookup reads: the nearest one or more that hold k rows, and those that may hold a row nearer than the k-th of these."""
        import numpy as np

        q = self._asked(query)
        if q is None:
            return []
        order = [c for c in np.argsort(-(self.c @ q), kind="stable").tolist() if self.cells.get(c, (0, 0.0))[0]]
        first, n = [], 0
        for c in order:
            first.append(c)
            n += self.cells[c][0]
            if n >= k:
                break
        worst = self._ordered(self.rows.filter(F.col("cell").isin(first)), q.tolist(), k).agg(F.min("score"), F.count("score")).first()
        if worst[1] < k:
            return order
        angle = lambda x: math.acos(max(-1.0, min(1.0, x)))
        may = lambda c: math.cos(max(0.0, angle(float(self.c[c] @ q)) - angle(self.cells[c][1]))) >= worst[0] - 1e-9
        return [c for c in order if c in first or may(c)]

    @staticmethod
    def _ordered(rows: DataFrame, query: list[float], k: int) -> DataFrame:
        q = F.array(*[F.lit(float(x)) for x in query])
        return rows.select("doc", cosine(F.col("vec"), q).alias("score")).filter("score is not null").orderBy(F.desc("score"), "doc").limit(k)


def cosine(a: Column, b: Column) -> Column:
    """Null where either has no direction."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    size = dot(a, a) * dot(b, b)
    return dot(a, b) / F.sqrt(F.when(size > 0, size))
