"""MinHash near-dedup: improved consistent weighted sampling over TF-IDF shingles, banded, verified by weighted Jaccard similarity.

Shingles are five words in lower case; a shorter text is one shingle. A shingle's weight is its count in the text times an inverse document frequency,
kept within [1, 1 + IDF] so that frequent copies stay close. Document frequencies cover all documents in a table of fixed size (2^20 hashed counts, less the
mean load of a slot), the only corpus statistic each task gets.

Each text has SAMPLES consistent weighted samples (a shingle and a step of its weight); equal samples have the probability of the weighted Jaccard similarity.
Texts that share BAND samples of a band meet in a bucket. Equal texts are one node from the start. In a bucket's cell likely links are verified on whole texts,
surest first, but only between nodes that no verified link joins yet: what comes out is a spanning forest, never a list that grows with the square of a group. A link counts
as likely if LIKELY of the samples agree: at a similarity of 0.8 one in a million has fewer (and one in 1,300 shares no band).

A bucket over BLOCK nodes (or CELL_BYTES of text) is cut into blocks, each text going to one block. Of the parts found in a block one representative goes on; representatives
are dealt out and verified in the same way until one block holds a bucket's or no more parts merge. Where a bucket still has several parts, all nodes outside its largest part are
checked against all others, in cells of a block each; a text is copied once for each BLOCK nodes outside the largest part. So a large group of near copies moves each text about
twice, and no likely pair of different parts is left unverified. Parts are joined by alternating large and small stars on the cluster, with the lineage cut at each turn.

A null or blank text has no shingle: it is equal to texts of the same characters only. A null doc_id is never a class id unless all of the class are null.
Repeated rows are equal texts. Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept, materialize, ship, text_or_empty
from .tokens import slices

WORDS = 5
SIMILARITY = 0.8
SAMPLES, BAND = 30, 3
LIKELY, SURE = 12, 24
BLOCK, CELL_BYTES = 1024, 32 << 20
#: Shingles of a cell's texts are made in runs of so many texts and held up to so many hashes.
BAG_RUN, BAG_HASHES = 16, 4_000_000
IDF = 0.2
SLOTS_BITS = 20
CHUNK_BITS = 14
#: Random draws are taken from a table of so many rows by a shingle's hash; ties go to the smaller hash.
DRAWS_BITS = 14
SLICE_BYTES = 4 << 20

SIGNED = "doc_id long, node binary, size int, marks binary, bands array<long>"
#: A link has a similarity; a row without one says that node a is in the part of b in that bucket.
LINKS = "band int, key long, a binary, b binary, similarity double"


def _mix(h):
    import numpy as np

    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


class Shingler:
    def __init__(self, idf=None):
        self.idf = idf

    def shingles(self, texts):
        """For each text of a pyarrow string array: (sorted distinct shingle hashes, their counts)."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        import xxhash

        lists = pc.utf8_split_whitespace(pc.utf8_lower(pc.fill_null(texts, "")))
        offsets = lists.offsets.to_numpy().astype(np.int64)
        coded = lists.values[offsets[0] : offsets[-1]].dictionary_encode()
        offsets = offsets - offsets[0]
        digest = xxhash.xxh3_64_intdigest
        words = np.array([digest(w) for w in coded.dictionary.cast(pa.binary()).to_pylist()] or [0], dtype=np.uint64)
        blank = coded.dictionary.index("").as_py()
        where = coded.indices.to_numpy()
        h = words[where] if len(where) else np.zeros(0, np.uint64)
        if blank >= 0:  # what stands before the first and after the last white space
            real = where != blank
            kept = np.concatenate([[0], np.cumsum(real)])
            h, offsets = h[real], kept[offsets]
        out = []
        k = np.uint64(0x100000001B3)
        run = h
        for i in range(1, WORDS):
            run = run[:-1] * k + h[i:] if len(h) > i else h[:0]
        run = _mix(run)
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            if b - a >= WORDS:
                own = run[a : b - WORDS + 1].copy()
            elif b > a:
                x = b - a
                for w in h[a:b].tolist():
                    x = (x * int(k) + w) % 2**64
                own = _mix(np.array([x], dtype=np.uint64))
            else:
                own = h[:0]
            own.sort()
            first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])) if len(own) else np.zeros(0, np.int64)
            out.append((own[first], np.diff(np.append(first, len(own)))))
        return out

    def weights(self, hashes, counts):
        import numpy as np

        if self.idf is None:
            return counts.astype(np.float32)
        return counts * self.idf[(hashes >> np.uint64(64 - SLOTS_BITS)).astype(np.int64)]


class Sampler:
    """Improved consistent weighted sampling: of all shingles the one with the least ln a, where ln y = r (floor(ln w / r + b) - b) and ln a = ln c - ln y - r."""

    def __init__(self):
        import numpy as np

        rng = np.random.default_rng(20)
        shape = (1 << DRAWS_BITS, SAMPLES)
        self.r = rng.gamma(2, 1, shape).astype(np.float32)
        self.log_c = np.log(rng.gamma(2, 1, shape)).astype(np.float32)
        self.b = rng.random(shape).astype(np.float32)

    def marks(self, hashes, weights):
        """SAMPLES fingerprints of 32 bits."""
        import numpy as np

        best, pick, step = None, None, None
        log_w = np.log(weights).astype(np.float32)[:, None]
        for s in range(0, len(hashes), 4096):  # bounded memory for very long texts
            h = hashes[s : s + 4096]
            row = (h & np.uint64((1 << DRAWS_BITS) - 1)).astype(np.int64)
            r, b = self.r[row], self.b[row]
            t = np.floor(log_w[s : s + 4096] / r + b)
            a = self.log_c[row] - r * (t - b) - r
            i = a.argmin(axis=0)
            low, at, col = a[i, np.arange(SAMPLES)], h[i], t[i, np.arange(SAMPLES)]
            if best is None:
                best, pick, step = low, at, col
            else:
                less = low < best
                best, pick, step = np.where(less, low, best), np.where(less, at, pick), np.where(less, col, step)
        return (_mix(pick + step.astype(np.int64).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(32)).astype(np.uint32)


def _bands(marks):
    """One 64-bit key for each band."""
    import numpy as np

    m = marks.reshape(-1, BAND).astype(np.uint64)
    key = np.arange(len(m), dtype=np.uint64) + np.uint64(1)
    for i in range(BAND):
        key = _mix(key * np.uint64(0x100000001B3) + m[:, i])
    return key.astype(np.int64)


def _frequencies(batches):
    """This task's counts by slot, as compressed chunks, and the number of its documents and shingles."""
    import zlib

    import numpy as np
    import pyarrow as pa
    from pyspark import TaskContext

    size, n, total = 1 << SLOTS_BITS, 0, 0
    counts, shingler = np.zeros(size, np.int64), Shingler()
    for batch in batches:
        for a, k in slices(batch.column(0), SLICE_BYTES):
            for h, _ in shingler.shingles(batch.column(0).slice(a, k)):
                n += 1
                total += len(h)
                np.add.at(counts, (h >> np.uint64(64 - SLOTS_BITS)).astype(np.int64), 1)
    if n:
        step, part = 1 << CHUNK_BITS, TaskContext.get().partitionId() % 256
        chunks = [zlib.compress(counts[i : i + step].tobytes(), 1) for i in range(0, size, step)]
        m = len(chunks)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(m), pa.int32()), pa.array([part] * m, pa.int32()), pa.array([n] + [0] * (m - 1), pa.int64()), pa.array([total] + [0] * (m - 1), pa.int64()), pa.array(chunks, pa.binary())],
            ["chunk", "part", "n", "total", "counts"],
        )


CHUNKS = "chunk int, part int, n long, total long, counts binary"


def _sum_chunks(pdf):
    import zlib

    import numpy as np

    total = sum(np.frombuffer(zlib.decompress(x), np.int64) for x in pdf["counts"])
    return pdf.head(1).assign(n=pdf["n"].sum(), total=pdf["total"].sum(), counts=[zlib.compress(total.tobytes(), 1)])


def idf_table(docs: DataFrame):
    """Weight factor of each slot, float32, 2^20 entries (4 MB): 1 + IDF * ln(N / df) / ln(N + 1)."""
    import zlib

    import numpy as np

    ship(docs.sparkSession)
    parts = docs.select(F.col("text").cast("string")).mapInArrow(_frequencies, CHUNKS)
    for shift in (0, 4, 8):  # a tree: a group has one chunk of a 256th of the tasks, then sixteen sums, then sixteen
        parts = parts.withColumn("part", F.shiftright("part", shift and 4)).groupBy("chunk", "part").applyInPandas(_sum_chunks, CHUNKS)
    rows = parts.collect()  # 64 chunks
    if not rows:
        return np.ones(1 << SLOTS_BITS, np.float32)
    n, total = sum(r["n"] for r in rows), sum(r["total"] for r in rows)
    counts = np.concatenate([np.frombuffer(zlib.decompress(r["counts"]), np.int64) for r in sorted(rows, key=lambda r: r["chunk"])])
    df = np.clip(counts - total / (1 << SLOTS_BITS), 1, n)
    return (1 + IDF * np.log(n / df) / np.log(n + 1)).astype(np.float32)


def _tool(idf, key: str):
    return kept(key, lambda: (Shingler(idf.value), Sampler()))


def _sign(idf, key: str):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        shingler, sampler = _tool(idf, key)
        none = np.zeros(SAMPLES, np.uint32).tobytes()
        for batch in batches:
            for a, k in slices(batch.column(3), SLICE_BYTES):
                marks, bands = [], []
                for h, c in shingler.shingles(batch.column(3).slice(a, k)):
                    if len(h):
                        m = sampler.marks(h, shingler.weights(h, c))
                        marks.append(m.tobytes())
                        bands.append(_bands(m))
                    else:
                        marks.append(none)
                        bands.append(np.zeros(0, np.int64))
                ends = np.cumsum([0, *map(len, bands)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(bands) if bands else np.zeros(0, np.int64)))
                yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(a, k) for i in range(3)), pa.array(marks, pa.binary()), lists], ["doc_id", "node", "size", "marks", "bands"])

    return run


class Bags:
    """Weighted shingles of a cell's texts, made when asked for and held within a bound."""

    def __init__(self, shingler: Shingler, texts: list):
        self.shingler, self.texts, self.runs, self.held = shingler, texts, {}, 0

    def __getitem__(self, i: int):
        import pyarrow as pa

        at = i // BAG_RUN
        if at not in self.runs:
            if self.held > BAG_HASHES:
                self.runs, self.held = {}, 0
            made = self.shingler.shingles(pa.array(self.texts[at * BAG_RUN : (at + 1) * BAG_RUN], pa.string()))
            self.runs[at] = [(h, self.shingler.weights(h, c).astype(float)) for h, c in made]
            self.held += sum(len(h) for h, _ in made)
        return self.runs[at][i % BAG_RUN]


def _links(idf, key: str, least: float, parts: bool):
    """Verified links of each cell (rows lie sorted by cell: band, key, i, j): every two nodes that likely links of the cell join are joined by links found or had the same
    label before. In a cell of two blocks (i < j) only nodes of different sides are compared. With `parts`, also each node's part in its cell, named by one of its nodes."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        shingler, _ = _tool(idf, key)
        out: list[tuple] = []

        def cell(place, sides, nodes, labels, marks, texts):
            if len(nodes) < 2:
                if parts:
                    out.extend((*place[:2], x, x, None) for x in nodes)
                return
            band, two = place[0], place[2] != place[3]
            m = np.frombuffer(b"".join(marks), np.uint32).reshape(len(nodes), SAMPLES)
            side, bags = np.array(sides), Bags(shingler, texts)
            names: dict = {}
            part, tried = np.array([names.setdefault(x, len(names)) for x in labels]), set()
            for bound in (SURE, LIKELY):
                for i in range(len(nodes) - 1):
                    apart = part[i + 1 :] != part[i]
                    if two:
                        apart &= side[i + 1 :] != side[i]
                    other = np.flatnonzero(apart) + i + 1
                    if not len(other):
                        if not (part != part[0]).any():
                            break
                        continue
                    same = m[other] == m[i]
                    near = same.sum(axis=1) >= bound
                    if band:  # who shares an earlier band meets there
                        near &= ~same[:, : BAND * band].reshape(-1, band, BAND).all(axis=2).any(axis=1)
                    for j in other[near].tolist():
                        if part[j] != part[i] and (i, j) not in tried:
                            tried.add((i, j))
                            if (x := similarity(bags[i], bags[j])) >= least:
                                out.append((*place[:2], nodes[i], nodes[j], x))
                                part[part == part[j]] = part[i]
            if parts:
                first = {}
                for x, p in zip(nodes, part.tolist(), strict=True):
                    out.append((*place[:2], x, first.setdefault(p, x), None))

        def sent():
            kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.float64())
            got = [pa.array([x[k] for x in out], kind) for k, kind in enumerate(kinds)]
            out.clear()
            return pa.RecordBatch.from_arrays(got, ["band", "key", "a", "b", "similarity"])

        at, rows = (0, 0, 0, 0), ([], [], [], [], [])
        for batch in batches:
            columns = [batch.column(x).to_pylist() for x in range(9)]
            for where, *row in zip(zip(*columns[:4], strict=True), *columns[4:], strict=True):
                if where != at:
                    cell(at, *rows)
                    at, rows = where, ([], [], [], [], [])
                    if len(out) > 20_000:
                        yield sent()
                for column, x in zip(rows, row, strict=True):
                    column.append(x)
        cell(at, *rows)
        if out:
            yield sent()

    return run


def similarity(x, y) -> float:
    """Weighted Jaccard similarity of (sorted hashes, weights)."""
    import numpy as np

    if len(x[0]) > len(y[0]):
        x, y = y, x
    if not len(x[0]):
        return 0.0
    at = np.minimum(np.searchsorted(y[0], x[0]), len(y[0]) - 1)
    both = np.where(y[0][at] == x[0], np.minimum(x[1], y[1][at]), 0.0).sum()
    whole = x[1].sum() + y[1].sum() - both
    return float(both / whole) if whole else 0.0


def components(links: DataFrame) -> DataFrame:
    """(node, label) of all nodes in links (a, b); label: the least node of the part. Alternating large and small stars."""
    edges = materialize(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct())

    def state(e: DataFrame):
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.shiftright(F.xxhash64("u", "v"), 20))).first())

    before = state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        edges = materialize(small.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        now = state(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())


def signatures(docs: DataFrame):
    """(signed rows, the broadcast weight table and its key)."""
    spark = docs.sparkSession
    idf = spark.sparkContext.broadcast(idf_table(docs))
    key = uuid.uuid4().hex
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.md5(text_or_empty())).alias("node"), F.octet_length(text_or_empty()).alias("size"), F.col("text").cast("string").alias("text"))
    return materialize(rows.mapInArrow(_sign(idf, key), SIGNED)), idf, key


def verified_links(docs: DataFrame, signed: DataFrame, idf, key: str, least: float = SIMILARITY) -> DataFrame:
    """(a, b, similarity): verified links that join every two nodes which likely links join."""
    nodes = signed.groupBy("node").agg(F.first("size").alias("size"), F.first("marks").alias("marks"), F.first("bands").alias("bands"), F.min("doc_id").alias("doc_id"))
    bucket = materialize(nodes.select("node", "doc_id", "size", "marks", F.posexplode("bands").alias("band", "key")))
    blocks = F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("size") / CELL_BYTES)).cast("int")
    full = bucket.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n"), blocks.alias("g")).filter("n > 1")
    member = materialize(bucket.join(full, ["band", "key"]).drop("n"))
    chosen = member.select("node", "doc_id").distinct()  # one document of each node that shares a bucket
    text = docs.select(F.col("doc_id").cast("long").alias("_id"), F.unhex(F.md5(text_or_empty())).alias("node"), F.col("text").cast("string").alias("text"))
    texts = text.join(chosen, "node").filter(F.col("_id").eqNullSafe(F.col("doc_id"))).groupBy("node").agg(F.first("text").alias("text"))

    def found(rows: DataFrame, parts: bool) -> DataFrame:
        """rows: band, key, i, j, side, node, label, marks."""
        cells = rows.join(texts, "node").select("band", "key", "i", "j", "side", "node", "label", "marks", "text")
        laid = cells.repartition("band", "key", "i", "j").sortWithinPartitions("band", "key", "i", "j", "node")
        return materialize(laid.mapInArrow(_links(idf, key, least, parts), LINKS))

    def dealt(rows: DataFrame) -> DataFrame:
        """Each node to one of its bucket's g blocks."""
        own = F.pmod(F.xxhash64("node", "band"), F.col("g")).cast("int")
        return rows.select("band", "key", own.alias("i"), own.alias("j"), F.lit(0).alias("side"), "node", F.col("node").alias("label"), "marks")

    links = found(dealt(member.filter("g = 1")), False)
    large = member.filter("g > 1").select("band", "key", "g", "node", "size", "marks")
    if large.isEmpty():
        return links.select("a", "b", "similarity")
    texts = materialize(texts.join(large.select("node").distinct(), "node", "left_semi"))
    large = materialize(large.withColumn("label", F.col("node")))
    before = None
    while True:  # representatives of the parts found so far, each in one block; then those of the parts that are left
        heads = large.filter("node = label").drop("label")
        sizes = heads.groupBy("band", "key").agg(blocks.alias("g"))
        count = sizes.agg(F.sum("g"), F.max("g")).first()
        left = heads.count()
        if before is not None and left > 0.9 * before:
            break
        before = left
        got = found(dealt(heads.drop("g").join(sizes, ["band", "key"])), True)
        links = links.unionByName(got.filter("similarity is not null"))
        moved = got.filter("similarity is null and a != b").select("band", "key", F.col("a").alias("label"), F.col("b").alias("to"))
        large = materialize(large.join(moved, ["band", "key", "label"], "left").withColumn("label", F.coalesce("to", "label")).drop("to"))
        if count[1] == 1:
            break
    # buckets that still have several parts: what is outside the largest part against everything
    of_part = large.groupBy("band", "key", "label").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"))
    shape = of_part.groupBy("band", "key").agg(F.max(F.struct("n", "bytes", "label")).alias("top"), F.sum("n").alias("n"), F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("parts"))

    def cut(n, size):
        return F.ceil(F.greatest(n / BLOCK, size / CELL_BYTES)).cast("int")

    shape = shape.filter("parts > 1").select(
        "band", "key", F.col("top.label").alias("main"), cut(F.col("top.n"), F.col("top.bytes")).alias("gm"), cut(F.col("n") - F.col("top.n"), F.col("bytes") - F.col("top.bytes")).alias("gr")
    )
    rest = large.join(shape, ["band", "key"])
    is_main = F.col("label") == F.col("main")
    rest = rest.withColumn("own", F.pmod(F.xxhash64("node", "band"), F.when(is_main, F.col("gm")).otherwise(F.col("gr"))).cast("int"))

    def to(i, j, side):
        return F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"), side.cast("int").alias("side"))

    every = F.sequence(F.lit(0), F.col("gr") - 1)
    of_main = F.transform(every, lambda q: to(F.col("own"), F.col("gm") + q, F.lit(0)))
    of_rest = F.concat(
        F.transform(F.sequence(F.lit(0), F.col("gm") - 1), lambda p: to(p, F.col("gm") + F.col("own"), F.lit(1))),
        F.transform(every, lambda q: to(F.col("gm") + F.least(F.col("own"), q), F.col("gm") + F.greatest(F.col("own"), q), F.col("own") > q)),
    )
    cells = rest.withColumn("cell", F.explode(F.when(is_main, of_main).otherwise(of_rest))).select("band", "key", "cell.i", "cell.j", "cell.side", "node", "label", "marks")
    return links.unionByName(found(cells, False)).select("a", "b", "similarity")


def classes(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """(doc_id, node, label) for each row: label is the least node of its class."""
    signed, idf, key = signatures(docs)
    labels = components(verified_links(docs, signed, idf, key, least))
    return signed.select("doc_id", "node").join(labels, "node", "left").select("doc_id", "node", F.coalesce("label", "node").alias("label"))


def near_dedup(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """One row per document: doc_id, class_id (least doc_id of the class), class_size, kept."""
    rows = materialize(classes(docs, least))
    size = materialize(rows.groupBy("label").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size")))  # written, so that the join can split a large class
    return rows.join(size, "label").select("doc_id", "class_id", "class_size", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"))


def keep_one(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """One document of each class, all columns as they were: the stage of the pipeline."""
    names = docs.columns
    rows = materialize(classes(docs, least))
    best = rows.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "node")).alias("m")).select("m.doc_id", "m.node")
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), F.col("doc_id").cast("long").alias("_id"), F.unhex(F.md5(text_or_empty())).alias("_node"))
    kept = whole.join(best, (F.col("_node") == F.col("node")) & F.col("_id").eqNullSafe(F.col("doc_id")), "left_semi")
    once = kept.groupBy("_id", "_node").agg(F.first("_row").alias("_row"))  # rows repeated with the same id and text
    return once.select(*[F.col(f"_row.`{c}`").alias(c) for c in names])
