"""Hard-negative mining by a vector-approximation file.

Vectors are scaled to integers and laid into blocks of rows. A block keeps, of each dimension, cells of about equal numbers of its rows and the least and greatest value in each cell; a row is
approximated by its cells. For a block of anchors, the tables give a lower and an upper bound of every inner product; only rows whose bounds leave them a chance are scored exactly: in the first pass
those that may be among an anchor's nearest rows of its own label, in the second those of other labels that may enter the window of one of its positives. What a pair of blocks finds is cut to what can
still be among the first, and ranked by windows over all blocks, so the result is exact.

The anchors are a stated query set that is held against all rows, block by block: a block of each side at a time in a task. Rows without an id, a label or a vector, with a null or non-finite component, or with one that lies
beyond LARGEST after scaling (its products would leave 64 bits) take no part. Vectors are only compared with those of the same length. Each of repeated rows is a row of its own: as an anchor it gives its results again, and the others are
among its positives. Ties go by the smaller id; no positives or no rows in the window give no rows; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, row_key, ship

ANCHOR_EACH, RELABEL_EACH, LABELS, SCALE = 100, 7, 10, 256
POSITIVES, NEGATIVES = 5, 10
#: A negative's score lies between these hundredths of the positive's.
WINDOW = (30, 90)
#: Cells of a dimension, rows and bytes of a block, anchors of a block.
CELLS, BLOCK_ROWS, BLOCK_BYTES, BLOCK_ANCHORS = 32, 4096, 8 << 20, 512
LARGEST = 1 << 24
BLOCK = "dim int, ids binary, labels binary, exact binary, codes binary, low binary, high binary"
ASKED = "a_dim int, a_keys binary, a_ids binary, a_labels binary, a_exact binary, a_windows binary"


def usable(rows: DataFrame) -> DataFrame:
    """(vec_id, label, vec): rows that take part, labels and components as they count."""
    vec = F.transform("embedding", lambda x: F.floor(SCALE * x.cast("double")).cast("double"))
    far = F.exists("vec", lambda x: F.abs(x) > LARGEST)
    label = F.when(F.col("vec_id") % RELABEL_EACH == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))  # floor() of others is no number
    got = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()).filter(finite)
    got = got.select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), vec.alias("vec"))
    return got.filter(~far).select("vec_id", "label", F.transform("vec", lambda x: x.cast("int")).alias("vec"))


def approximated(exact):
    """(codes, low, high) of rows: the cell of each value and each cell's least and greatest value, by dimension. A cell that no row is in has 0 for both."""
    import numpy as np

    n, dim = exact.shape
    codes = np.empty((n, dim), np.uint8)
    low, high = np.zeros((dim, CELLS), np.int32), np.zeros((dim, CELLS), np.int32)
    at = (np.arange(1, CELLS) * n) // CELLS
    for d in range(dim):
        column = exact[:, d]
        by = np.sort(column)
        cell = np.searchsorted(np.unique(by[at]), column, side="right").astype(np.uint8)
        codes[:, d] = cell
        order = np.argsort(cell, kind="stable")
        found, first = np.unique(cell[order], return_index=True)
        low[d, found], high[d, found] = np.minimum.reduceat(column[order], first), np.maximum.reduceat(column[order], first)
    return codes, low, high


def bounds(anchors, block):
    """(lower, upper) bounds of all inner products of anchors and a block's rows, summed from the cells' tables; None where they would leave the exact range of 64-bit floats."""
    import numpy as np

    dim = anchors.shape[1]
    low, high = block["low"].astype(np.float64), block["high"].astype(np.float64)
    if not dim or 4.0 * dim * max(1.0, np.abs(anchors).max(initial=0)) * max(1.0, np.abs(low).max(), np.abs(high).max()) >= 2.0**52:
        return None
    at = np.arange(dim)
    middle, width = (low + high)[at, block["codes"]], (high - low)[at, block["codes"]]  # twice the middle and the half-width
    a = anchors.astype(np.float64)
    centre, reach = a @ middle.T, np.abs(a) @ width.T
    return (centre - reach) / 2, (centre + reach) / 2


def products(anchor, rows):
    """Inner products of one anchor with some rows, as 64-bit integers; components within LARGEST keep them there up to 32,768 dimensions."""
    import numpy as np

    return rows.astype(np.int64) @ anchor.astype(np.int64)


def _blocks(batches):
    """Rows as blocks, by the length of their vectors."""
    import numpy as np
    import pyarrow as pa

    held: dict[int, list] = {}

    def out(dim: int, n: int):
        ids, labels, vecs = (np.concatenate(x) for x in zip(*held.pop(dim), strict=True))
        if len(ids) > n:
            held[dim] = [(ids[n:], labels[n:], vecs[n:])]
            ids, labels, vecs = ids[:n], labels[:n], vecs[:n]
        parts = (ids, labels, vecs, *approximated(vecs))
        return pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), *[pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for x in parts]], ["dim", "ids", "labels", "exact", "codes", "low", "high"])

    most = lambda dim: max(1, min(BLOCK_ROWS, BLOCK_BYTES // max(1, 4 * dim)))
    for batch in batches:
        if not batch.num_rows:
            continue
        ids, labels, vec = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2)
        offsets = vec.offsets.to_numpy()
        values = vec.values.to_numpy()
        sizes = np.diff(offsets)
        for dim in np.unique(sizes).tolist():
            rows = np.flatnonzero(sizes == dim)
            held.setdefault(dim, []).append((ids[rows], labels[rows], values[offsets[rows][:, None] + np.arange(dim)].astype(np.int32)))
            while sum(len(x[0]) for x in held.get(dim, ())) >= most(dim):
                yield out(dim, most(dim))
    for dim in list(held):
        yield out(dim, most(dim))


def _asked(batches):
    """Anchors (key, id, label, vec, windows) as blocks; windows: the scores of their positives, if they have any yet."""
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        of: dict[int, list[int]] = {}
        vecs, windows = batch.column(3).to_pylist(), batch.column(4).to_pylist()
        for i, v in enumerate(vecs):
            of.setdefault(len(v), []).append(i)
        columns = [batch.column(k).to_numpy() for k in range(3)]
        for dim, rows in of.items():
            for k in range(0, len(rows), BLOCK_ANCHORS):
                own = rows[k : k + BLOCK_ANCHORS]
                asked = np.full((len(own), POSITIVES), np.iinfo(np.int64).min)
                for r, i in enumerate(own):
                    asked[r, : len(windows[i] or ())] = windows[i] or ()
                parts = [c[own].tobytes() for c in columns] + [np.array([vecs[i] for i in own], np.int32).reshape(len(own), dim).tobytes(), asked.tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), *[pa.array([x], pa.binary()) for x in parts]], ["a_dim", "a_keys", "a_ids", "a_labels", "a_exact", "a_windows"])


def _unpacked(row: dict) -> tuple[dict, dict]:
    import numpy as np

    dim = row["dim"]
    i64 = lambda x: np.frombuffer(x, np.int64)
    i32 = lambda x, n: np.frombuffer(x, np.int32).reshape(n, -1) if n else np.zeros((0, dim), np.int32)
    ids, keys = i64(row["ids"]), i64(row["a_keys"])
    block = {"ids": ids, "labels": i64(row["labels"]), "exact": i32(row["exact"], len(ids)), "codes": np.frombuffer(row["codes"], np.uint8).reshape(len(ids), dim), "low": np.frombuffer(row["low"], np.int32).reshape(dim, CELLS), "high": np.frombuffer(row["high"], np.int32).reshape(dim, CELLS)}
    asked = {"keys": keys, "ids": i64(row["a_ids"]), "labels": i64(row["a_labels"]), "exact": i32(row["a_exact"], len(keys)), "windows": i64(row["a_windows"]).reshape(len(keys), POSITIVES)}
    return block, asked


def first(scores, ids, k: int):
    """Places of the first k by score, then the smaller id."""
    import numpy as np

    return np.lexsort((ids, -scores))[:k]


def nearest(block: dict, asked: dict, k: int = POSITIVES + 1):
    """(key, anchor id, id, score, the anchor's own score) of the first k rows of each anchor's label in a block, and how many rows were scored."""
    import numpy as np

    limits, out, scored = bounds(asked["exact"], block), [], 0
    for label in np.unique(asked["labels"]):
        rows = np.flatnonzero(block["labels"] == label)
        if not len(rows):
            continue
        for i in np.flatnonzero(asked["labels"] == label):
            chosen = rows
            if limits and len(rows) > k:
                low = limits[0][i, rows]
                chosen = rows[limits[1][i, rows] >= np.partition(low, -k)[-k]]
            anchor = asked["exact"][i]
            scores = products(anchor, block["exact"][chosen])
            scored += len(chosen)
            own = products(anchor, anchor[None])[0]
            for x in first(scores, block["ids"][chosen], k):
                out.append((asked["keys"][i], asked["ids"][i], block["ids"][chosen[x]], scores[x], own))
    return out, scored


def within(block: dict, asked: dict, k: int = NEGATIVES):
    """(key, number of the positive, id, score) of the first k rows of other labels in the window of each positive, and how many rows were scored."""
    import numpy as np

    limits, out, scored = bounds(asked["exact"], block), [], 0
    none = np.iinfo(np.int64).min
    for label in np.unique(asked["labels"]):
        other = np.flatnonzero(block["labels"] != label)
        if not len(other):
            continue
        ids, exact = block["ids"][other], block["exact"][other]
        for i in np.flatnonzero(asked["labels"] == label):
            windows = [(p, -(-WINDOW[0] * s // 100), WINDOW[1] * s // 100) for p, s in enumerate(asked["windows"][i].tolist()) if s != none]
            windows = [w for w in windows if w[1] <= w[2]]
            may = np.zeros(len(other), bool)
            if limits:
                low, high = limits[0][i, other], limits[1][i, other]
                for _, least, most in windows:
                    sure = low[(low >= least) & (high <= most)]
                    reach = np.partition(sure, -k)[-k] if len(sure) >= k else least
                    may |= (low <= most) & (high >= reach)
            else:
                may[:] = bool(windows)
            at = np.flatnonzero(may)
            if not len(at):
                continue
            scores = products(asked["exact"][i], exact[at])
            scored += len(at)
            for p, least, most in windows:
                fits = np.flatnonzero((scores >= least) & (scores <= most))
                for x in fits[first(scores[fits], ids[at[fits]], k)]:
                    out.append((asked["keys"][i], p, ids[at[x]], scores[x]))
    return out, scored


def _searched(search, names: list[str]):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for row in batch.to_pylist():
                if row["dim"] != row["a_dim"]:
                    continue
                found, _ = search(*_unpacked(row))
                table = np.array(found, np.int64).reshape(-1, len(names))
                yield pa.RecordBatch.from_arrays([pa.array(table[:, k], pa.int64()) for k in range(len(names))], names)

    return run


def _packed(anchors: DataFrame) -> DataFrame:
    """Anchors as full blocks, written once."""
    return materialize(anchors.coalesce(max(1, math.ceil(anchors.count() / BLOCK_ANCHORS))).mapInArrow(_asked, ASKED))


def _held_against(blocks: DataFrame, asked: DataFrame, search, names: list[str]) -> DataFrame:
    """What a search finds for each block of anchors in each block of rows. Lengths are compared in the task: as a join key they would deal everything to one."""
    return blocks.crossJoin(asked).mapInArrow(_searched(search, names), ", ".join(f"{n} long" for n in names))


def hard_negatives(rows: DataFrame) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)."""
    ship(rows.sparkSession)
    good = usable(rows)
    blocks = materialize(good.coalesce(max(1, math.ceil(rows.count() / BLOCK_ROWS))).mapInArrow(_blocks, BLOCK))
    anchors = materialize(good.filter(F.col("vec_id") % ANCHOR_EACH == 0).withColumn("key", row_key()).select("key", F.col("vec_id").alias("anchor_id"), "label", "vec"))
    asked = _packed(anchors.withColumn("windows", F.lit(None).cast("array<long>")))
    near = _held_against(blocks, asked, nearest, ["key", "anchor_id", "vec_id", "score", "own"])
    by = Window.partitionBy("key").orderBy(F.desc("score"), "vec_id")
    top = near.withColumn("at", F.row_number().over(by)).filter(F.col("at") <= POSITIVES + 1)
    is_own = ((F.col("vec_id") == F.col("anchor_id")) & (F.col("score") == F.col("own"))).cast("int")
    top = top.withColumn("is_own", is_own).withColumn("owns", F.sum("is_own").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    others = top.filter("not (is_own = 1 and owns = 1)").withColumn("p", F.col("at") - F.when(F.col("owns") > 0, 2).otherwise(1)).filter(F.col("p") < POSITIVES)
    positives = materialize(others.select("key", "p", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")))
    windows = positives.groupBy("key").agg(F.transform(F.array_sort(F.collect_list(F.struct("p", "positive_score"))), lambda x: x["positive_score"]).alias("windows"))  # POSITIVES at most
    asked = _packed(anchors.join(windows, "key").select("key", "anchor_id", "label", "vec", "windows"))
    found = _held_against(blocks, asked, within, ["key", "p", "negative_id", "negative_score"])
    place = F.row_number().over(Window.partitionBy("key", "p").orderBy(F.desc("negative_score"), "negative_id"))
    ranked = found.withColumn("rank", place).filter(F.col("rank") <= NEGATIVES)
    got = ranked.join(positives, ["key", "p"]).join(anchors.select("key", "anchor_id"), "key")
    return got.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
