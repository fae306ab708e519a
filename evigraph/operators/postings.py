"""Ranked lookup in blocks of postings that know the most they can add to a score (H2, H9).

Documents are dealt into ranges, by their length first and by a hash of their key then; a frequent term's postings in a range are one block, with their greatest frequency and their least length. From these heads alone follows a bound
of the score of any document of a range. A top-k lookup scores the ranges with the highest bounds, and then only ranges whose bound reaches the k-th score found: what is left out cannot be among the first k, so the result is that of the
full ranking. Ranges hold documents of like length, so that a block's bound lies close to what its postings add. Most terms are rare and would fill blocks of one posting: where a term has few postings in a cell (a folder's share of the
ranges) they are one block of several ranges, and their own gains are the bounds.

One pass over the texts and one shuffle build it, of a row for each cell and batch of texts. No cell is larger than what its ranges and their texts allow; a term that every document holds is dealt over as many tasks as its size needs. A
row without text is skipped; a text without a token counts as a document of length 0; ties go by the smaller key; keys should be unique, as rows of one key are scored together.
"""

from __future__ import annotations

import json
import math
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship

K1, B = 1.2, 0.75
#: Folders of the postings, cells of one at least (more where a cell would get over SLICE_RANGES ranges of a length, or its share of over SLICE_BYTES of text), documents aimed at in a range, steps of the length to a power of two,
#: ranges scored for the first threshold.
PARTS, SLICES, RANGE_DOCS, LENGTH_STEPS, FIRST = 16, 16, 128, 3, 8
SLICE_RANGES, SLICE_BYTES = 64, 1 << 28
#: A term's postings in a cell are one block up to so many ranges' documents; longer texts are of one length; postings handed to Spark at a time.
TOGETHER, LONGEST, HANDED = 32, 1 << 20, 1 << 17
#: Like lengths share a range in about so many groups, so a range of one group is no larger than so many times RANGE_DOCS.
GROUPS = 8


def _word_bytes() -> bytes:
    """ASCII digits and lower-case letters stay; all other bytes are spaces."""
    return bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def _places(dl, near, ranges: int):
    """The ranges of documents in numpy, as place() has them in Spark: whole numbers on both sides."""
    import numpy as np

    starts = [next(m for m in range(int(2 ** (k / LENGTH_STEPS)), LONGEST + 1) if m**LENGTH_STEPS >= 2**k) for k in range(LONGEST.bit_length() * LENGTH_STEPS - LENGTH_STEPS + 1)]
    return (np.searchsorted(starts, np.minimum(dl.astype(np.int64) + 1, LONGEST), "right") - 1) * ranges + near


def _lists(starts, size: int, values):
    """A list from each start to the next."""
    import numpy as np
    import pyarrow as pa

    return pa.ListArray.from_arrays(pa.array(np.append(starts, size), pa.int32()), values)


def _packed(batches, ranges: int, slices: int):
    """(cell, docs, dls, near, terms, held, seats, tfs) of each cell in a batch of (doc, near, text): the documents of its slice, its terms with their number of postings, and the postings in that order as places among the documents with
    their frequencies. The term '' stands for the document itself."""
    import zlib
    from collections import Counter

    import numpy as np
    import pyarrow as pa

    table = _word_bytes()
    for batch in batches:
        terms, times, held, lengths = [], [], [], []
        for text in batch.column(2).to_pylist():
            words = text.lower().encode("utf-8", "replace").translate(table).split()
            own = Counter(words)
            own[b""] = 1
            terms += own
            times += own.values()
            held.append(len(own))
            lengths.append(len(words))
        if not held:
            continue
        coded = pa.array(terms, pa.binary()).dictionary_encode()
        names, code = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
        dl, near = np.array(lengths, np.int32), batch.column(1).to_numpy()
        slot = _places(dl, near, ranges) % slices
        seated = np.argsort(slot, kind="stable")
        first = np.searchsorted(slot[seated], np.arange(slices + 1))
        seat = np.empty(len(slot), np.int32)
        seat[seated] = np.arange(len(slot)) - first[slot[seated]]
        doc = np.repeat(np.arange(len(slot)), held)
        folder = np.array([zlib.crc32(t) % PARTS for t in names.to_pylist()], np.int64)
        key = (folder[code] * slices + slot[doc]) * len(names) + code
        order = np.argsort(key)
        key = key[order]
        runs = np.flatnonzero(np.diff(key, prepend=-1))  # a term's in a cell
        cells, at = np.unique(key[runs] // len(names), return_index=True)
        own = [seated[first[s] : first[s + 1]] for s in cells % slices]
        ends, docs = np.cumsum([0, *map(len, own)]), np.concatenate(own)
        of_docs, of_terms, of_postings = (partial(_lists, x, n) for x, n in ((ends[:-1], len(docs)), (at, len(runs)), (runs[at], len(key))))
        out = {
            "cell": pa.array(cells, pa.int32()), "docs": of_docs(batch.column(0).take(pa.array(docs))), "dls": of_docs(pa.array(dl[docs])), "near": of_docs(pa.array(near[docs], pa.int32())),
            "terms": of_terms(names.take(pa.array(key[runs] % len(names))).cast(pa.string())), "held": of_terms(pa.array(np.diff(np.append(runs, len(key))), pa.int32())),
            "seats": of_postings(pa.array(seat[doc[order]])), "tfs": of_postings(pa.array(np.array(times, np.int32)[order])),
        }
        yield pa.RecordBatch.from_pydict(out)


def _gathered(batches, ranges: int, slices: int, together: int):
    """The blocks of each cell, from rows of _packed in the order of cells."""
    import numpy as np

    held, now = [], None
    for batch in batches:
        cells = batch.column(0).to_numpy()
        runs = np.flatnonzero(np.diff(cells, prepend=-1)).tolist()
        for a, b in zip(runs, [*runs[1:], len(cells)], strict=True):
            if cells[a] != now and held:
                yield from _blocks(held, int(now) // slices, ranges, together)
                held = []
            now = cells[a]
            held.append(batch.slice(a, b - a))
    if held:
        yield from _blocks(held, int(now) // slices, ranges, together)


def _blocks(pieces, part: int, ranges: int, together: int):
    """(part, term, range, n, tf_most, dl_least, docs, tfs, dls) of one cell: a block a term, without a range, or of a term with more than `together` postings a block a range."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    rows = pa.Table.from_batches(pieces)
    flat = {c: pc.list_flatten(rows[c]).combine_chunks() for c in rows.column_names[1:]}
    sizes = {c: pc.list_value_length(rows[c]).to_numpy() for c in ("docs", "tfs")}
    docs, dl, tf = flat["docs"], flat["dls"].to_numpy(), flat["tfs"].to_numpy()
    at = flat["seats"].to_numpy() + np.repeat(np.cumsum(sizes["docs"]) - sizes["docs"], sizes["tfs"])
    coded = flat["terms"].dictionary_encode()
    by_name = pc.array_sort_indices(coded.dictionary)
    names, rank = coded.dictionary.take(by_name), np.empty(len(by_name), np.int64)
    rank[by_name.to_numpy()] = np.arange(len(by_name))
    code = np.repeat(rank[coded.indices.to_numpy()], flat["held"].to_numpy())
    spot = _places(dl, flat["near"].to_numpy(), ranges)[at]
    order = np.argsort(code * (int(spot.max()) + 1) + spot)
    code, spot, at, tf = code[order], spot[order], at[order], tf[order]
    dl, many = dl[at], np.bincount(code) > together
    starts = np.flatnonzero((np.diff(code, prepend=-1) != 0) | many[code] & (np.diff(spot, prepend=-1) != 0))
    edges = np.unique(np.append(np.searchsorted(starts, np.arange(0, len(code), HANDED)), len(starts)))
    stops = np.append(starts, len(code))
    for a, b in zip(edges, edges[1:]):
        lo, hi = stops[a], stops[b]
        first, own = starts[a:b], starts[a:b] - lo
        lists = partial(_lists, own, hi - lo)
        out = {
            "part": pa.array(np.full(b - a, part, np.int32)), "term": names.take(pa.array(code[first])), "range": pa.array(spot[first], pa.int64(), mask=~many[code[first]]), "n": pa.array(np.diff(stops[a : b + 1]), pa.int32()),
            "tf_most": pa.array(np.maximum.reduceat(tf[lo:hi], own)), "dl_least": pa.array(np.minimum.reduceat(dl[lo:hi], own)), "docs": lists(docs.take(pa.array(at[lo:hi]))), "tfs": lists(pa.array(tf[lo:hi])), "dls": lists(pa.array(dl[lo:hi])),
        }
        yield pa.RecordBatch.from_pydict(out)


def gain(tf: Column, dl: Column, avgdl: float) -> Column:
    """What a posting adds, less the term's idf. It grows with the frequency and falls with the length."""
    tf = tf.cast("double")
    return tf * (K1 + 1) / (tf + K1 * (1 - B + B * dl / F.lit(float(avgdl))))


def part_of(term: Column | str) -> Column:
    return F.pmod(F.crc32((F.col(term) if isinstance(term, str) else term).cast("binary")), F.lit(PARTS)).cast("int")


def _near(doc: Column, ranges: int) -> Column:
    return F.pmod(F.xxhash64(doc), F.lit(ranges)).cast("int")


def place(doc: Column, dl: Column, ranges: int) -> Column:
    """The range of a document: its length in steps, then its hash."""
    m = F.least(dl.cast("long") + 1, F.lit(LONGEST).cast("long"))
    power = m
    for _ in range(LENGTH_STEPS - 1):
        power = power * m
    return (F.length(F.bin(power)) - 1).cast("long") * ranges + _near(doc, ranges)


class BlockPostings:
    """The postings of a text property at a path."""

    def __init__(self, spark, path: str, n: int, avgdl: float, columns: str, ranges: int):
        self.spark, self.path, self.n, self.avgdl, self.columns, self.ranges = spark, path, n, avgdl, columns, ranges

    @property
    def blocks(self) -> DataFrame:
        """(term, range, n, tf_most, dl_least, docs, tfs, dls, part); the range is null where a block is of several."""
        return self.spark.read.schema(self.columns).parquet(f"{self.path}/blocks")

    @staticmethod
    def build(df: DataFrame, key: str, text: str, path: str, range_docs: int = RANGE_DOCS) -> BlockPostings:
        ship(df.sparkSession)
        rows = df.filter(F.col(text).isNotNull()).select(F.col(key).alias("doc"), F.col(text).alias("text"))
        size = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
        ranges = max(1, math.ceil(size["n"] / range_docs / GROUPS))
        slices = max(SLICES, math.ceil(ranges / SLICE_RANGES), math.ceil(size["bytes"] / SLICE_BYTES))
        kind = rows.schema["doc"].dataType.simpleString()
        cells = f"cell int, docs array<{kind}>, dls array<int>, near array<int>, terms array<string>, held array<int>, seats array<int>, tfs array<int>"
        found = rows.select("doc", _near(F.col("doc"), ranges).alias("near"), "text").mapInArrow(partial(_packed, ranges=ranges, slices=slices), cells)
        # one shuffle, of a row for each cell and batch of texts: a folder's postings go to its slices by their range, so a term of all documents is dealt over these
        dealt = found.repartition("cell").sortWithinPartitions("cell")
        columns = f"part int, term string, range long, n int, tf_most int, dl_least int, docs array<{kind}>, tfs array<int>, dls array<int>"
        blocks = dealt.mapInArrow(partial(_gathered, ranges=ranges, slices=slices, together=TOGETHER * range_docs), columns)
        blocks.sortWithinPartitions("part", "term", "range").write.mode("overwrite").partitionBy("part").parquet(f"{path}/blocks")
        made = BlockPostings(df.sparkSession, path, 0, 0.0, columns, ranges)
        total = F.sum(F.aggregate("dls", F.lit(0).cast("long"), lambda s, x: s + x))
        held = made._of([""]).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(total, F.lit(0)).alias("t")).first()
        about = {"n": held["n"], "avgdl": held["t"] / held["n"] if held["n"] else 0.0, "columns": columns, "ranges": ranges}
        df.sparkSession.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/about")
        return BlockPostings.opened(df.sparkSession, path)

    @staticmethod
    def opened(spark, path: str) -> BlockPostings:
        return BlockPostings(spark, path, **json.loads(spark.read.text(f"{path}/about", wholetext=True).first()[0]))

    def _of(self, terms: list[str]) -> DataFrame:
        """The blocks of some terms: only their folders are read, and of a folder's files what may hold them."""
        asked = self.spark.createDataFrame([(t,) for t in terms], "term string").select(part_of("term").alias("part")).distinct().collect()  # a row a query term
        return self.blocks.filter(F.col("part").isin([r["part"] for r in asked]) & F.col("term").isin(terms))

    def terms(self) -> int:
        return self.blocks.filter("term != ''").select("term").distinct().count()

    def _idf(self, terms: list[str]) -> dict[str, float]:
        held = self._of(terms).groupBy("term").agg(F.sum("n").alias("df")).collect() if terms else []  # a row a query term
        return {r["term"]: math.log(1 + (self.n - r["df"] + 0.5) / (r["df"] + 0.5)) for r in held}

    def _weighted(self, idf: dict[str, float]) -> DataFrame:
        weight = F.element_at(F.create_map(*[F.lit(x) for t in sorted(idf) for x in (t, idf[t])]), F.col("term"))
        return self._of(sorted(idf)).withColumn("idf", weight)

    def _each(self, blocks: DataFrame, *columns: str) -> DataFrame:
        """The postings of blocks: (range, doc, gain) and the columns named."""
        each = blocks.select(*columns, "range", F.explode(F.arrays_zip("docs", "tfs", "dls")).alias("p"))
        own = F.coalesce("range", place(F.col("p.docs"), F.col("p.dls"), self.ranges)).alias("range")
        return each.select(*columns, own, F.col("p.docs").alias("doc"), gain(F.col("p.tfs"), F.col("p.dls"), self.avgdl).alias("gain"))

    def _bounds(self, idf: dict[str, float]) -> DataFrame:
        """(range, most, blocks): a bound of the score of any document of a range, a little above for the rounding of sums, and the terms it holds."""
        held = self._weighted(idf)
        heads = held.filter("range IS NOT NULL").select("range", (F.col("idf") * gain(F.col("tf_most"), F.col("dl_least"), self.avgdl)).alias("most"))
        few = self._each(held.filter("range IS NULL"), "term", "idf").groupBy("term", "range").agg(F.max(F.col("idf") * F.col("gain")).alias("most")).select("range", "most")
        return heads.unionByName(few).groupBy("range").agg((F.sum("most") * (1 + 1e-9)).alias("most"), F.count(F.lit(1)).alias("blocks"))

    def _scored(self, idf: dict[str, float], ranges: DataFrame | None = None) -> DataFrame:
        held = self._weighted(idf)
        if ranges is None:
            each = self._each(held, "idf")
        else:  # blocks of a range are left out whole, of the others their postings
            kept = held.filter("range IS NOT NULL").join(ranges.select("range"), "range", "left_semi")
            each = self._each(kept, "idf").unionByName(self._each(held.filter("range IS NULL"), "idf").join(ranges.select("range"), "range", "left_semi"))
        return each.groupBy("doc").agg(F.sum(F.col("idf") * F.col("gain")).alias("score"))

    def _nothing(self) -> DataFrame:
        return self.blocks.filter(F.lit(False)).select(F.explode("docs").alias("doc"), F.lit(0.0).alias("score"))

    def search(self, terms: list[str]) -> DataFrame:
        """(doc, score) of all documents that hold a term."""
        idf = self._idf(terms)
        return self._scored(idf) if idf else self._nothing()

    def _needed(self, idf: dict[str, float], k: int) -> DataFrame:
        """(range, most, blocks): the ranges that may hold one of the first k."""
        bounds = self._bounds(idf)
        first = bounds.orderBy(F.desc("most"), "range").limit(max(FIRST, math.ceil(4 * k / RANGE_DOCS)))
        found = self._scored(idf, first).orderBy(F.desc("score"), "doc").limit(k).agg(F.min("score").alias("s"), F.count(F.lit(1)).alias("n")).first()
        return bounds.filter(F.col("most") >= F.lit(found["s"])) if found["n"] == k else bounds

    def top(self, terms: list[str], k: int) -> DataFrame:
        """(doc, score) of the first k, as the full ranking has them."""
        idf = self._idf(terms)
        if not idf:
            return self._nothing()
        return self._scored(idf, self._needed(idf, k)).orderBy(F.desc("score"), "doc").limit(k)

    def read_of(self, terms: list[str], k: int) -> tuple[int, int]:
        """(blocks that a top-k lookup scores, blocks of its terms)."""
        idf = self._idf(terms)
        if not idf:
            return 0, 0
        count = lambda df: df.agg(F.coalesce(F.sum("blocks"), F.lit(0))).first()[0]
        return count(self._needed(idf, k)), count(self._bounds(idf))
