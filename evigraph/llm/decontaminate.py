"""Benchmark decontamination: q-gram lemma filtering and banded alignment.

Benchmark items are cut into overlapping regions (whole items if they are short), so densely that a passage of 51 characters holds a region wherever it starts.
A document is scanned once: every q-gram is looked up in the
benchmark's q-grams, and each hit falls on a diagonal (place in the document less place in the item) and so in two overlapping bands. An occurrence of a
region of m characters with at most k edits shares at least m + 1 - q - k*q q-grams within one band (the q-gram lemma, k edits break k*q at
most); bands that reach that bound are kept and verified by banded alignment with k edits. Letters are compared in lower case with runs of white space as one space.

The benchmark is the stated query set: its index goes to every task, behind a check of its size; a larger benchmark is scanned in blocks of that size, so none is
left out. Only one block is on the driver and in the tasks at a time. With one block documents are never shuffled; with more, their rows are numbered, written once and joined with what was found by number.
An item of fewer than Q characters must stand as whole words. A null or empty text is clean; an item without letters or digits never matches; repeated rows each give a row;
an empty benchmark leaves all documents clean; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from functools import reduce
from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept, materialize, row_key, ship

Q = 12
#: A passage of REGION + STRIDE - 1 = 51 characters is found wherever in its item it starts.
REGION, STRIDE = 48, 4
#: Edits allowed, as a share of a region's characters.
EDIT_SHARE = 0.05
#: Characters of the benchmark that one index holds (about 30 bytes of index each); more make more indexes.
BLOCK_CHARS = 4_000_000
SCHEMA = "item_ids array<long>, n_regions long, best_edits int"


def _normal(text: str) -> str:
    return " ".join(text.lower().split())


def budget(m: int, q: int = Q, share: float = EDIT_SHARE) -> tuple[int, int]:
    """(edits allowed, q-grams that must be shared) of a region of m characters; edits are as many as leave one q-gram at least."""
    k = min(int(m * share), max(0, (m - q) // q))
    return k, m + 1 - q - k * q


def banded_edits(patterns, windows, k: int):
    """Least edits that turn each pattern (rows of m code points) into some substring of its window (m + 6k + 2: the diagonals of a band, k more on each side)."""
    import numpy as np

    m = patterns.shape[1]
    wide = windows.shape[1] - m + 1
    step = np.arange(wide, dtype=np.int16)
    row = np.zeros((len(patterns), wide), np.int16)
    for i in range(m):
        new = row + (windows[:, i : i + wide] != patterns[:, i : i + 1])
        new[:, :-1] = np.minimum(new[:, :-1], row[:, 1:] + 1)
        row = np.minimum.accumulate(new - step, axis=1) + step
    return row.min(axis=1)


class Regions:
    """(item, part, edits allowed, q-grams that must be shared) of every region, cut from the items' texts when asked for."""

    def __init__(self, items: list[tuple[int, str]], q: int, share: float):
        import numpy as np

        self.items, self.q, self.share = items, q, share
        self.m = np.array([min(len(t), REGION) for _, t in items], dtype=np.int64)
        self.last = np.array([len(t) for _, t in items], dtype=np.int64) - self.m
        self.n = -(-self.last // STRIDE) + 1
        self.first = np.cumsum(self.n) - self.n
        budgets = [budget(m, q, share) for m in range(REGION + 1)]
        self.allowed = np.array([k for k, _ in budgets], dtype=np.int64)[self.m]
        self.least = np.array([least for _, least in budgets], dtype=np.int64)[self.m]

    def __len__(self) -> int:
        return int(self.n.sum())

    def owner(self, r):
        import numpy as np

        return np.searchsorted(self.first, r, side="right") - 1

    def start(self, r):
        import numpy as np

        i = self.owner(r)
        return np.minimum((r - self.first[i]) * STRIDE, self.last[i])

    def __getitem__(self, r: int):
        if not 0 <= r < len(self):
            raise IndexError(r)
        i, at = int(self.owner(r)), int(self.start(r))
        item, text = self.items[i]
        return item, text[at : at + REGION], int(self.allowed[i]), int(self.least[i])


class Index:
    """q-grams of the items, as sorted 32-bit hashes with their (item, place) lists; regions are laid over the hits."""

    def __init__(self, items: list[tuple[int, str]], q: int = Q, share: float = EDIT_SHARE):
        import numpy as np

        self.q, real = q, []
        for item, text in items:
            t = _normal(text)
            if any(c.isalnum() for c in t):
                real.append((item, t))
        self.regions = Regions(real, q, share)
        self.short = [(int(self.regions.first[i]), t, re.compile(rf"(?<!\w){re.escape(t)}(?!\w)")) for i, (_, t) in enumerate(real) if len(t) < q]  # found as whole words
        grams = [self.hashes(t) for _, t in real]
        g = np.concatenate(grams) if grams else np.zeros(0, np.uint32)
        by = np.argsort(g, kind="stable")
        self.grams, self.first, self.count = np.unique(g[by], return_index=True, return_counts=True)
        self.owner = np.repeat(np.arange(len(grams)), [len(x) for x in grams])[by].astype(np.int32) if grams else np.zeros(0, np.int32)
        self.place = np.concatenate([np.arange(len(x)) for x in grams])[by].astype(np.int32) if grams else np.zeros(0, np.int32)
        self.marks = np.zeros(1 << 22, dtype=bool)
        self.marks[self.grams >> np.uint32(10)] = True
        self.fewest = min(self.regions.least[self.regions.m >= q].tolist(), default=1)
        self.longest = max((len(t) for _, t in real), default=0)

    def hashes(self, text: str):
        """A 32-bit hash of every q-gram of code points, by doubling. Grams that only share a hash add to counts, which verification sorts out."""
        import numpy as np

        h = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        n, w, left, span, done = len(h) - self.q + 1, 1, self.q, 0, None
        if n <= 0:
            return np.zeros(0, np.uint32)
        h = h * np.uint32(0x9E3779B1) + np.uint32(1)
        while left:
            factor = np.uint32(pow(0x01000193, w, 2**32))
            if left & 1:
                part = h[span : span + n]
                done = part if done is None else done * factor + part
                span += w
            left >>= 1
            if left:
                h = h[:-w] * factor + h[w:]
                w *= 2
        done = done ^ (done >> np.uint32(15))
        done *= np.uint32(0x85EBCA6B)
        return done

    def search(self, text: str) -> dict[int, int]:
        """region -> least edits, for the regions that occur within their budget."""
        import numpy as np

        found = {r: 0 for r, part, whole in self.short if part in text and whole.search(text)}
        h = self.hashes(text)
        at = np.flatnonzero(self.marks[h >> np.uint32(10)])
        if not len(self.grams) or len(at) < self.fewest:
            return found
        near = np.minimum(np.searchsorted(self.grams, h[at]), len(self.grams) - 1)
        hit = self.grams[near] == h[at]
        at, near = at[hit], near[hit]
        if len(at) < self.fewest:
            return found
        n = self.count[near]
        pick = np.repeat(self.first[near] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        item, place, at = self.owner[pick].astype(np.int64), self.place[pick].astype(np.int64), np.repeat(at, n)
        laid = self.regions
        band = (at - place + self.longest) // (laid.allowed[item] + 1)
        # each hit counts in its band and in the one before: bands overlap by half
        key = item << 33 | band + 1
        keys, group = np.unique(np.concatenate([key, key - 1]), return_inverse=True)
        span = self.longest + 1
        hits = np.unique(group * span + np.concatenate([place, place]))  # a q-gram of the item counts once
        group, place = hits // span, hits % span
        full = (np.bincount(group, minlength=len(keys)) >= laid.least[keys >> 33])[group]
        group, place = group[full], place[full]
        if not len(group):
            return found
        # the regions that hold each q-gram: from the first that ends after it to the last that starts before it
        item = keys[group] >> 33
        lo = np.minimum(np.maximum(-(-(place - laid.m[item] + self.q) // STRIDE), 0), laid.n[item] - 1)
        hi = np.where(place >= laid.last[item], laid.n[item] - 1, place // STRIDE)
        n = np.maximum(hi - lo + 1, 0)
        region = np.repeat(laid.first[item] + lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
        every = len(laid)
        pairs, shared = np.unique(np.repeat(group, n) * every + region, return_counts=True)
        item = keys[pairs // every] >> 33
        pairs, item = pairs[shared >= laid.least[item]], item[shared >= laid.least[item]]
        region = pairs % every
        k, m = laid.allowed[item], laid.m[item]
        begin = ((keys[pairs // every] & 0x1FFFFFFFF) - 1) * (k + 1) - self.longest + laid.start(region)  # of the band, in the text
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        for size in np.unique(m).tolist():
            mine = np.flatnonzero(m == size)
            most = int(k[mine[0]])
            wide = size + 6 * most + 2
            for some in np.array_split(mine, -(-len(mine) // 4096)):
                patterns = np.stack([self._points(i, s, size) for i, s in zip(item[some].tolist(), laid.start(region[some]).tolist(), strict=True)])
                x = (begin[some] - 2 * most)[:, None] + np.arange(wide)
                windows = np.where((x >= 0) & (x < len(points)), points[np.clip(x, 0, len(points) - 1)], np.uint32(0xFFFFFFFF))
                edits = banded_edits(patterns, windows, most)
                for r, e in zip(region[some][edits <= most].tolist(), edits[edits <= most].tolist(), strict=True):
                    found[r] = min(found.get(r, e), e)
        return found

    def _points(self, i: int, start: int, size: int):
        import numpy as np

        return np.frombuffer(self.regions.items[i][1][start : start + size].encode("utf-32-le", "surrogatepass"), dtype="<u4")


def _scan(items, name: str):
    """Of each row (number or id, text) what is found."""

    def run(batches):
        import pyarrow as pa

        index = kept(name, lambda: Index(items.value))
        for batch in batches:
            ids, n, best = [], [], []
            for text in batch.column(1).to_pylist():
                found = index.search(_normal(text)) if text else {}
                ids.append(sorted({index.regions[r][0] for r in found}))
                n.append(len(found))
                best.append(min(found.values(), default=None))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int64())), pa.array(n, pa.int64()), pa.array(best, pa.int32())], [batch.schema.names[0], "item_ids", "n_regions", "best_edits"])

    return run


def _pass(items, name: str, at: int):
    """The rows of whole batches whose text at that place holds no item."""

    def run(batches):
        import pyarrow as pa

        index = kept(name, lambda: Index(items.value))
        for batch in batches:
            yield batch.filter(pa.array([not (text and index.search(_normal(text))) for text in batch.column(at).to_pylist()], pa.bool_()))

    return run


def blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The benchmark in blocks of BLOCK_CHARS, one at a time on the driver: it is the stated query set, read in the order of its ids."""
    out: list[tuple[int, str]] = []
    size = 0
    for r in benchmark.filter("text is not null").select(F.col("item_id").cast("long"), "text").orderBy("item_id").toLocalIterator():
        if size + len(r[1]) > BLOCK_CHARS and out:
            yield out
            out, size = [], 0
        out.append((r[0], r[1]))
        size += len(r[1])
    yield out


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: doc_id, contaminated, item_ids (sorted), n_regions, best_edits."""
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select("doc_id", F.col("text").cast("string").alias("_text"))
    every = blocks(benchmark)
    first, second = next(every), next(every, None)
    if second is None:
        kind = rows.schema["doc_id"].dataType.simpleString()
        out = rows.mapInArrow(_scan(spark.sparkContext.broadcast(first), uuid.uuid4().hex), f"doc_id {kind}, " + SCHEMA)
    else:
        # equal rows stay apart: each has a number, fixed by writing it; what the blocks find is put together by that number
        rows = materialize(rows.withColumn("_number", row_key()))
        found = []
        for block in chain([first, second], every):
            items = spark.sparkContext.broadcast(block)
            found.append(materialize(rows.select("_number", "_text").mapInArrow(_scan(items, uuid.uuid4().hex), "_number long, " + SCHEMA).filter("n_regions > 0")))
            items.destroy()
        merged = reduce(DataFrame.unionByName, found).groupBy("_number").agg(
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids"), F.sum("n_regions").alias("n_regions"), F.min("best_edits").alias("best_edits")
        )
        none = {"item_ids": F.array().cast("array<long>"), "n_regions": F.lit(0).cast("long")}
        out = rows.drop("_text").join(merged, "_number", "left").withColumns({c: F.coalesce(c, x) for c, x in none.items()})
    return out.select("doc_id", (F.size("item_ids") > 0).alias("contaminated"), "item_ids", "n_regions", "best_edits")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no benchmark passage, all columns as they were: the stage of the pipeline. A text goes to Python once for each block."""
    spark = docs.sparkSession
    ship(spark)
    every = blocks(benchmark)
    block, out, at = next(every), docs, docs.columns.index("text")
    while block is not None:
        later = next(every, None)
        items = spark.sparkContext.broadcast(block)
        out = out.mapInArrow(_pass(items, uuid.uuid4().hex, at), docs.schema)
        if later is not None:
            out = materialize(out)
            items.destroy()
        block = later
    return out
