"""LM scoring: prediction by partial matching over a byte-context trie.

The trie holds how often each byte followed each context of up to ORDER bytes in the training texts, with a mark for the end of a text. A byte's
probability is its count over the context's total plus its number of distinct followers; an unseen byte escapes to the next shorter context, where the
symbols of the longer one are excluded (method C), down to a uniform choice. All of a corpus's contexts are counted, in numpy by batch and then by key;
a lower order is the sum of the higher one. Every text is scored at ORDER, whatever the size. Up to MOST_NODES nodes, each task gets the whole trie. Beyond, it
gets the MOST_NODES most frequent nodes with their probabilities; what a text has besides is counted by node, looked up once a distinct node, in groups by the
last two symbols of the context (all that a longer context needs is in its group, the rest in a trie of lower order), and joined back. So no copy grows with the input.

The base score is an add-one unigram over words. Word counts are exact: counted by task and then by word. The most frequent words, HEAD_WORDS at most, are
given to every task (a fixed bound); what a document has besides is joined with the table of counts by word, counts first, so no word, however frequent in a few
documents, moves more than once a document. Results are sums by row.

A null text counts as empty: one end token. Only rows with crc32 of the id modulo 7 other than 2 are learned from; null ids count as 0. Repeated rows each give a row. With nothing to
learn from, N and V are 0 and the byte model is uniform. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import crc_mod, kept, log_floor, materialize, ship

ORDER = 4
END = 256
MOST_NODES = 8_000_000
HEAD_WORDS = 200_000
FLUSH_WORDS, FLUSH_CODES = 400_000, 2_000_000
SLICE = 3 << 20
#: Stands for the end of a document: no word can hold white space.
END_WORD = b"\n"


def _slices(texts):
    """Lists of (place, bytes) of about SLICE bytes each; a long text alone."""
    out, size = [], 0
    for i, t in enumerate(texts):
        b = (t or "").encode("utf-8", "surrogatepass")
        if out and size + len(b) > SLICE:
            yield out
            out, size = [], 0
        out.append((i, b))
        size += len(b)
    if out:
        yield out


def symbol_codes(blobs: list[bytes], order: int = ORDER):
    """(codes, owner): for every byte and every end, the order+1 symbols up to it, nine bits each; before a text stand ends."""
    import numpy as np

    sizes = np.array([len(b) + 1 for b in blobs], dtype=np.int64)
    pad = order
    total = int(sizes.sum()) + pad * len(blobs)
    ends = np.cumsum(sizes + pad)
    line = np.full(total, END, dtype=np.uint64)
    data = np.frombuffer(b"".join(blobs), dtype=np.uint8)
    begin = ends - sizes  # of each text's first byte
    n = sizes - 1
    line[np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(n.sum())] = data
    code = line.copy()
    for k in range(1, order + 1):
        code[k:] |= line[:-k] << np.uint64(9 * k)
    at = np.repeat(begin - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
    return code[at], np.repeat(np.arange(len(blobs)), sizes)


def _count(batches):
    """Rows (kind 0: word, kind 1: context code) with counts; a task's words and codes are summed as long as they fit in FLUSH_WORDS and FLUSH_CODES."""
    from collections import Counter

    import numpy as np
    import pyarrow as pa

    names = ["word", "code", "n"]

    def words_out(words: Counter):
        return pa.RecordBatch.from_arrays([pa.array(list(words), pa.binary()), pa.nulls(len(words), pa.int64()), pa.array(list(words.values()), pa.int64())], names)

    def codes_out():
        for i in range(0, len(codes), 100_000):
            c = codes[i : i + 100_000]
            yield pa.RecordBatch.from_arrays([pa.nulls(len(c), pa.binary()), pa.array(c.astype(np.int64)), pa.array(counts[i : i + 100_000])], names)

    words: Counter = Counter()
    codes, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for batch in batches:
        for part in _slices(batch.column(0).to_pylist()):
            blobs = [b for _, b in part]
            for b in blobs:
                words.update(b.lower().split())
            words[END_WORD] += len(blobs)
            if len(words) > FLUSH_WORDS:
                yield words_out(words)
                words = Counter()
            c, n = np.unique(symbol_codes(blobs)[0], return_counts=True)
            codes, counts = np.concatenate([codes, c]), np.concatenate([counts, n])
            codes, at = np.unique(codes, return_inverse=True)
            counts = np.bincount(at, weights=counts).astype(np.int64)
            if len(codes) > FLUSH_CODES:
                yield from codes_out()
                codes, counts = codes[:0], counts[:0]
    if words:
        yield words_out(words)
    yield from codes_out()


class Trie:
    """Counts of (context, symbol) at each order, as sorted arrays, with what escapes and exclusion need. With `short`, its levels serve the orders it has."""

    def __init__(self, codes, counts, order: int, short: Trie | None = None):
        import numpy as np

        self.order, self.levels = order, []
        codes, counts = np.asarray(codes, np.uint64), np.asarray(counts, np.int64)
        by = np.argsort(codes, kind="stable")
        codes, counts = codes[by], counts[by]
        for k in range(order, short.order if short else -1, -1):
            if k < order:
                codes, at = np.unique(codes & np.uint64((1 << 9 * (k + 1)) - 1), return_inverse=True)
                counts = np.bincount(at, weights=counts, minlength=len(codes)).astype(np.int64)
            context = codes >> np.uint64(9)
            ctx, first = np.unique(context, return_index=True)
            total = np.add.reduceat(counts, first) if len(codes) else np.zeros(0, np.int64)
            distinct = np.diff([*first, len(codes)]) if len(codes) else np.zeros(0, np.int64)
            self.levels.append({"codes": codes, "counts": counts, "ctx": ctx, "first": first, "total": total, "distinct": distinct})
        own = len(self.levels)
        self.levels += short.levels if short else []
        for i, (high, low) in enumerate(zip(self.levels[:own], self.levels[1:], strict=False)):
            # what a context's own symbols make up of its suffix context
            k = self.order - i - 1
            at = np.searchsorted(low["codes"], high["codes"] & np.uint64((1 << 9 * (k + 1)) - 1))
            high["below"] = np.add.reduceat(low["counts"][at], high["first"]) if len(high["codes"]) else np.zeros(0, np.int64)

    @staticmethod
    def _find(table, x):
        import numpy as np

        if not len(table):
            return np.zeros(len(x), np.int64), np.zeros(len(x), bool)
        at = np.minimum(np.searchsorted(table, x), len(table) - 1)
        return at, table[at] == x

    def log10(self, codes):
        """log10 probability of the last symbol of each code (sorted, unique codes are quickest)."""
        import numpy as np

        out = np.zeros(len(codes))
        open_ = np.arange(len(codes))
        gone_n = np.zeros(len(codes), np.int64)  # excluded: their number and what they make up of the next context
        gone_t = np.zeros(len(codes), np.int64)
        for i, level in enumerate(self.levels):
            k = self.order - i
            x = codes[open_] & np.uint64((1 << 9 * (k + 1)) - 1)
            c, seen = self._find(level["ctx"], x >> np.uint64(9))
            s, hit = self._find(level["codes"], x)
            hit &= seen
            room_t = np.where(seen, level["total"][c] - gone_t[open_], 0) if len(level["ctx"]) else np.zeros(len(x), np.int64)
            room_n = np.where(seen, level["distinct"][c] - gone_n[open_], 0) if len(level["ctx"]) else np.zeros(len(x), np.int64)
            whole = np.maximum(room_t + room_n, 1)
            if hit.any():
                out[open_[hit]] += np.log10(level["counts"][s[hit]] / whole[hit])
            escape = seen & ~hit & (room_n > 0)
            out[open_[escape]] += np.log10(room_n[escape] / whole[escape])
            if "below" in level and len(level["ctx"]):
                gone_t[open_] = np.where(seen, level["below"][c], 0)
            if len(level["ctx"]):
                gone_n[open_] = np.where(seen, level["distinct"][c], 0)
            open_ = open_[~hit]
        out[open_] += np.log10(1.0 / np.maximum(END + 1 - gone_n[open_], 1))
        return out


def text_log10(trie: Trie, blobs: list[bytes]):
    """log10 probability of each text, its end included. Equal contexts of a batch are looked up once."""
    import numpy as np

    codes, owner = symbol_codes(blobs, trie.order)
    key = codes << np.uint64(14) | owner.astype(np.uint64) if trie.order <= 4 and len(blobs) < 1 << 14 else None
    if key is None:
        codes, at = np.unique(codes, return_inverse=True)
        return np.bincount(owner, weights=trie.log10(codes)[at], minlength=len(blobs))
    key.sort()
    code = key >> np.uint64(14)
    first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]])) if len(code) else np.zeros(0, np.int64)
    value = np.repeat(trie.log10(code[first]), np.diff([*first, len(code)]))
    return np.bincount((key & np.uint64((1 << 14) - 1)).astype(np.int64), weights=value, minlength=len(blobs))


class Head:
    """The most frequent nodes, sorted, with log10 of their probabilities: a seen symbol is never excluded at the longest context."""

    def __init__(self, codes, log10):
        self.codes, self.log10 = codes, log10

    def texts(self, blobs: list[bytes]):
        """(log10 of what is known, for each text its other codes and how often each occurs)."""
        import numpy as np

        codes, owner = symbol_codes(blobs)
        by = np.lexsort((codes, owner))
        codes, owner = codes[by], owner[by]
        first = np.flatnonzero(np.concatenate([[True], (codes[1:] != codes[:-1]) | (owner[1:] != owner[:-1])]))
        n = np.diff([*first, len(codes)])
        codes, owner = codes[first], owner[first]
        at, hit = Trie._find(self.codes, codes)
        score = np.bincount(owner[hit], weights=self.log10[at[hit]] * n[hit], minlength=len(blobs))
        cuts = np.cumsum(np.bincount(owner[~hit], minlength=len(blobs)))[:-1]
        return score, np.split(codes[~hit].astype(np.int64), cuts), np.split(n[~hit].astype(np.int64), cuts)


def _score(shared, key: str):
    def run(batches):
        from collections import Counter

        import numpy as np
        import pyarrow as pa

        def made():
            nodes, words, freq = shared.value
            return Head(*nodes) if len(nodes) == 2 else Trie(*nodes), dict(zip(words, freq.tolist(), strict=True))

        trie, head = kept(key, made)
        for batch in batches:
            ids, held = batch.column(0), batch.column(1)
            for part in _slices(batch.column(2).to_pylist()):
                blobs = [b for _, b in part]
                if isinstance(trie, Head):
                    score, rare, rare_n = trie.texts(blobs)
                else:
                    score = np.concatenate([text_log10(trie, blobs[i : i + 16000]) for i in range(0, len(blobs), 16000)])
                    rare = rare_n = [[]] * len(blobs)
                n_tokens, known, logs, tails, tail_n = [], [], [], [], []
                for b in blobs:
                    words = b.lower().split()
                    words.append(END_WORD)
                    got = list(map(head.get, words))
                    n_tokens.append(len(words))
                    if None in got:
                        tail = Counter(w for w, c in zip(words, got, strict=True) if c is None)
                        tails.append(list(tail))
                        tail_n.append(list(tail.values()))
                        got = [c for c in got if c is not None]
                    else:
                        tails.append([])
                        tail_n.append([])
                    known.append(len(got))
                    logs.append(math.fsum(got))
                a, z = part[0][0], part[-1][0] + 1
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(a, z - a),
                        held.slice(a, z - a),
                        pa.array(n_tokens, pa.int64()),
                        pa.array(known, pa.int64()),
                        pa.array(logs, pa.float64()),
                        pa.array(score, pa.float64()),
                        pa.array(tails, pa.list_(pa.binary())),
                        pa.array(tail_n, pa.list_(pa.int64())),
                        pa.array(rare, pa.list_(pa.int64())),
                        pa.array(rare_n, pa.list_(pa.int64())),
                    ],
                    ["doc_id", "held_out", "n_tokens", "head_known", "head_logs", "score", "tail", "tail_n", "rare", "rare_n"],
                )

    return run


SCORED = "doc_id long, held_out boolean, n_tokens long, head_known long, head_logs double, score double, tail array<binary>, tail_n array<long>, rare array<long>, rare_n array<long>"
#: The last two symbols of a code's context.
NEAR = f"code >> 9 & {(1 << 18) - 1}"


def counts(docs: DataFrame) -> DataFrame:
    """Training counts: (word, null, n) and (null, code, n)."""
    ship(docs.sparkSession)
    raw = docs.filter(crc_mod("doc_id", 7) != 2).select(F.col("text").cast("string")).mapInArrow(_count, "word binary, code long, n long")
    return materialize(raw.groupBy("word", "code").agg(F.sum("n").alias("n")))


def contexts(table: DataFrame, order: int = ORDER, most: int = MOST_NODES):
    """(codes, counts, order) of the trie's deepest level: the longest contexts whose nodes fit in `most`, of one symbol at least (66,049 nodes at most)."""
    import numpy as np

    level = table.filter("code is not null").select("code", "n")
    while order > 1 and level.count() > most:
        order -= 1
        level = level.groupBy(F.expr(f"code & {(1 << 9 * (order + 1)) - 1}").alias("code")).agg(F.sum("n").alias("n"))
    got = level.toArrow()
    codes, n = got.column("code").to_numpy().astype(np.uint64), got.column("n").to_numpy()
    by = np.argsort(codes)
    return codes[by], n[by].astype(np.int64), order


def frequent(level: DataFrame, most: int):
    """(codes, log10 probabilities) of the most frequent nodes, `most` at most; of about equally frequent ones all or none."""
    import numpy as np

    least = log_floor(level, "n", most)
    if least is None:
        return np.zeros(0, np.uint64), np.zeros(0)
    context = Window.partitionBy(F.expr("code >> 9"))  # 257 rows at most
    whole = level.withColumn("whole", F.sum("n").over(context) + F.count(F.lit(1)).over(context))
    got = whole.filter(F.col("n") >= least).toArrow()  # `most` rows at most
    codes = got.column("code").to_numpy().astype(np.uint64)
    by = np.argsort(codes)
    return codes[by], np.log10(got.column("n").to_numpy() / got.column("whole").to_numpy())[by]


def _look_up(shared, key: str):
    def run(asked, known):
        import pyarrow as pa

        if not asked.num_rows:
            return pa.table({"code": pa.array([], pa.int64()), "value": pa.array([], pa.float64())})
        trie = Trie(known.column("code").to_numpy(), known.column("n").to_numpy(), ORDER, kept(key, lambda: Trie(*shared.value)))
        codes = asked.column("code").to_numpy()
        return pa.table({"code": pa.array(codes), "value": pa.array(trie.log10(codes.astype("uint64")))})

    return run


def looked_up(asked: DataFrame, level: DataFrame, most: int) -> DataFrame:
    """(code, value): log10 probability at ORDER of each code asked for. A group holds the training's nodes with the same last two symbols of the context."""
    shared = asked.sparkSession.sparkContext.broadcast(contexts(level, most=most))
    ours, theirs = asked.withColumn("near", F.expr(NEAR)), level.withColumn("near", F.expr(NEAR))
    return ours.groupBy("near").cogroup(theirs.groupBy("near")).applyInArrow(_look_up(shared, uuid.uuid4().hex), "code long, value double")


def lm_score(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    import numpy as np

    spark = docs.sparkSession
    table = counts(docs)
    words = table.filter("word is not null").select("word", F.col("n").alias("c"))
    size = words.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
    n_train, vocabulary = size["n"] or 0, size["v"]
    under = math.log10(n_train + vocabulary + 1)
    head = words.filter(F.col("c") >= (log_floor(words, "c", HEAD_WORDS) or n_train + 1)).toArrow()  # HEAD_WORDS rows at most; no task gathers them
    logs = np.log10(head.column("c").to_numpy() + 1.0) - under
    level = table.filter("code is not null").select("code", "n")
    whole = level.count() <= MOST_NODES
    nodes = contexts(table) if whole else frequent(level, MOST_NODES)
    shared = spark.sparkContext.broadcast((nodes, head.column("word").to_pylist(), logs))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (crc_mod("doc_id", 7) == 2).alias("held_out"), F.col("text").cast("string"))
    scored = materialize(rows.mapInArrow(_score(shared, uuid.uuid4().hex), SCORED).withColumn("row", F.monotonically_increasing_id()))
    tail = scored.filter(F.size("tail") > 0).select("row", F.explode(F.arrays_zip("tail", "tail_n")).alias("t")).select("row", F.col("t.tail").alias("word"), F.col("t.tail_n").alias("k"))
    found = tail.join(words, "word", "left")  # split where a word of held-out texts is frequent
    c = F.coalesce("c", F.lit(0))
    sums = found.groupBy("row").agg(F.sum(F.when(c > 0, F.col("k")).otherwise(0)).alias("known"), F.sum(F.col("k") * (F.log10(c + 1.0) - F.lit(under))).alias("logs"))
    out = scored.drop("tail", "tail_n", "rare", "rare_n").join(sums, "row", "left")
    if not whole:
        rare = scored.filter(F.size("rare") > 0).select("row", F.explode(F.arrays_zip("rare", "rare_n")).alias("t")).select("row", F.col("t.rare").alias("code"), F.col("t.rare_n").alias("k"))
        values = looked_up(rare.select("code").distinct(), level, MOST_NODES)
        rest = rare.join(values, "code").groupBy("row").agg(F.sum(F.col("k") * F.col("value")).alias("rest"))
        out = out.join(rest, "row", "left").withColumn("score", F.col("score") + F.coalesce("rest", F.lit(0.0)))
    return out.select(
        "doc_id", "held_out", "n_tokens",
        (F.col("head_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(n_train).cast("long").alias("train_tokens"),
        (F.col("head_logs") + F.coalesce("logs", F.lit(0.0))).alias("base_score"),
        "score",
    )
