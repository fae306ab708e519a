"""Packing: windows of a fixed token mixture, by deficit round-robin over source queues.

Each queue holds its sources' token ids. A window takes from every queue in turn what the queue is owed: its share of the
window plus the fraction of a token it was left short of before. Carried on, the tokens owed after w windows are a rounding of
w * window * share, so every window's cuts follow from queue totals alone: any partition can compute its own pieces, and the deficits carry
across windows and partitions without a sequential pass. The rounding is of cumulative shares (sum over the queues before and with this one), so a window's
quotas add up to the window exactly and none is negative.

A queue that is owed under a quantum (a sixteenth of a window) waits until a turn is worth that many. All such queues share one queue of the window; that queue's tokens are dealt in the same
way, in longer rounds, to those that are owed a quantum a round, and what is left over to a next level. So a window has at most sixteen queues with a
part in it and a few small ones in turn, however many sources there are, and a document is not shredded by their number. Targets are the shares of the tokens themselves unless `targets` sets weights by source:
then the queues of those sources are dealt out in these proportions as long as all of them have tokens, and what is left afterwards by its shares.

A source with a 256th of all rows or more has a queue of its own; the others are dealt into LANES queues by a hash, so that what the driver and the tasks get is bounded, whatever the number of sources.

The last, incomplete window is cut into sequences of a power of two, so no id of padding is needed at all. Ids are
written once (16 bits each) to the shared folder; a block is one scanned partition of documents, and queue offsets are per (queue, block): a few numbers a block.

A null or empty text is the single end id. A null source is a source. Repeated rows and null ids are packed like others. An
empty table gives an empty result; other columns are ignored. A source with a third of all rows is no hot group: nothing is grouped by source but row counts and block totals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, ship
from .tokens import default_path, encoder, slices

WINDOW = 2048
END_ID = 1
#: A turn is worth a window's tokens divided by TURNS at least; rounds grow by RAISE; queues of small sources.
TURNS, RAISE, LANES = 16, 16, 4096
#: Sources with one row in so many or more have their own queue.
OWN_ROWS = 256
#: Queue offsets by block up to so many rows are broadcast (24 MB); above, they are joined by block.
MOST_OFFSETS = 1_000_000

TOKENS = "block int, queue int, within long, doc_id long, source string, n long, ids binary"
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, source string"


def _tokenize(path: str, end_id: int):
    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        coder, block, tail = encoder(path), TaskContext.get().partitionId(), np.array([end_id], "<u2").tobytes()
        sent: dict[int, int] = {}  # tokens of each queue so far in this block
        for batch in batches:
            for start, n in slices(batch.column(3)):
                part = batch.slice(start, n)
                ids = [x + tail for x in coder.encode_batch(part.column(3)).to_pylist()]
                within = []
                for queue, x in zip(part.column(2).to_pylist(), ids, strict=True):
                    within.append(at := sent.get(queue, 0))
                    sent[queue] = at + len(x) // 2
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, block, np.int32)),
                        part.column(2),
                        pa.array(within, pa.int64()),
                        part.column(0),
                        part.column(1),
                        pa.array(np.array([len(x) // 2 for x in ids], np.int64)),
                        pa.array(ids, pa.binary()),
                    ],
                    ["block", "queue", "within", "doc_id", "source", "n", "ids"],
                )

    return run


def own_queues(docs: DataFrame, always: list[str | None] = ()) -> list[str | None]:
    """Sources with a queue of their own, in order: those with one row in OWN_ROWS or more (as many at most) and those named. Reads the column of sources only."""
    counts = docs.groupBy(F.col("source").cast("string").alias("source")).agg(F.count(F.lit(1)).alias("n"))
    least = docs.count() / OWN_ROWS
    return sorted({*always, *(r[0] for r in counts.filter(F.col("n") >= least).select("source").collect())}, key=lambda s: (s is not None, s or ""))


def encode(docs: DataFrame, own: list[str | None], path: str | None = None, end_id: int = END_ID) -> DataFrame:
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("text").cast("string").alias("text"))
    named = F.broadcast(spark.createDataFrame([(s, q) for q, s in enumerate(own)], "s string, q int"))  # OWN_ROWS rows and those with targets at most
    lane = (F.pmod(F.xxhash64("source"), F.lit(LANES)) + len(own)).cast("int")
    rows = rows.join(named, F.col("source").eqNullSafe(F.col("s")), "left").select("doc_id", "source", F.coalesce("q", lane).alias("queue"), "text")
    return materialize(rows.mapInArrow(_tokenize(path or default_path(), end_id), TOKENS))


def levels(totals: dict[int, int], window: int) -> list[tuple[int, list[int], int]]:
    """(round, queues, tokens of the levels below) of each level. A queue is owed a quantum a round at least, and what is below a token: else the last queue joins it there."""
    out, left, turn, quantum = [], dict(sorted(totals.items())), window, max(1, window // TURNS)
    while left:
        whole = sum(left.values())
        large = [q for q, n in left.items() if n * turn >= quantum * whole]
        rest = whole - sum(left[q] for q in large)
        if rest and rest * turn < whole and len(large) > 1:
            rest += left[large.pop()]
        if not large or (rest and rest * turn < whole):
            turn *= RAISE
            continue
        out.append((turn, large, rest))
        left, turn = {q: n for q, n in left.items() if q not in set(large)}, window
    return out


def phases(totals: dict[int, int], weights: dict[int, float]) -> list[dict[int, int]]:
    """Tokens that each queue gives in each phase. A phase deals out the queues with weights in their proportion until one of them is empty; the last one has what is left."""
    left, out = dict(totals), []
    while live := {q: w for q, w in weights.items() if w > 0 and left.get(q)}:
        first = min(live, key=lambda q: (left[q] / live[q], q))
        scale = left[first] / live[first]
        gives = {q: left[q] if q == first else min(left[q], int(w * scale)) for q, w in live.items()}
        out.append({q: n for q, n in gives.items() if n})
        left = {q: n - gives.get(q, 0) for q, n in left.items()}
    return [*out, rest] if (rest := {q: n for q, n in left.items() if n}) else out


class Deal:
    """Cumulative cuts of queues of these sizes, dealt in rounds of `turn` tokens."""

    def __init__(self, sizes: list[int], turn: int):
        import itertools

        import numpy as np

        self.turn, self.total = turn, sum(sizes)
        self.full = self.total // turn
        ends = [0, *itertools.accumulate(sizes)]
        self.ends = np.array(ends, dtype=np.int64)
        self.whole = np.array([e * turn // self.total for e in ends], dtype=np.int64)
        self.part = np.array([e * turn % self.total for e in ends], dtype=np.int64)
        self.exact = self.full * self.total < 2**62

    def cut(self, w, k):
        """Tokens of the first k queues dealt before round w (arrays; w from 0 to full + 1)."""
        import numpy as np

        c, part = np.minimum(w, self.full), self.part[k]
        # beyond 64 bits: Python's integers
        more = c * part // self.total if self.exact else (c.astype(object) * part.astype(object) // self.total).astype(np.int64)
        return np.where(w > self.full, self.ends[k], c * self.whole[k] + more)

    def lay(self, k, a, b):
        """(which, begin, end, position in the stream) of the intervals a..b of queues k, cut by rounds."""
        import numpy as np

        owed = self.turn * ((self.ends[k + 1] - self.ends[k]) / self.total)  # a token a round at least
        lo = np.clip((a / owed).astype(np.int64) - 3, 0, self.full)
        hi = np.clip(((b - 1) / owed).astype(np.int64) + 3, 0, self.full)
        which, w = _spread(lo, hi)
        k = k[which]
        c0, c1, d0, d1 = self.cut(w, k), self.cut(w, k + 1), self.cut(w + 1, k), self.cut(w + 1, k + 1)
        begin, end = np.maximum(a[which], c1 - c0), np.minimum(b[which], d1 - d0)
        ok = end > begin
        place = w * self.turn + (d0 - c0) + begin - (c1 - c0)
        return which[ok], begin[ok], end[ok], place[ok]


def _spread(lo, hi):
    """(which, value): every whole number from lo to hi of each pair."""
    import numpy as np

    n = hi - lo + 1
    which = np.repeat(np.arange(len(lo)), n)
    return which, np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - lo, n)


class Plan:
    """Where in the packed stream each queue's tokens lie: phases, levels of each, and the sequences the stream is cut into."""

    def __init__(self, totals: dict[int, int], window: int, weights: dict[int, float] | None = None):
        import numpy as np

        self.window, total = window, sum(totals.values())
        self.full, rest = divmod(total, window)
        sizes = [1 << k for k in reversed(range(window.bit_length())) if rest >> k & 1]
        self.bounds = np.array([0, *np.cumsum(sizes)], dtype=np.int64)  # of the last window's sequences
        n_queues = max(totals, default=-1) + 1
        self.phases, base, sent = [], 0, np.zeros(n_queues, np.int64)
        for gives in phases(totals, weights or {}):
            made = []
            for turn, large, below in levels(gives, window):
                own = np.full(n_queues, -1, np.int64)
                own[large] = np.arange(len(large))
                made.append((Deal([gives[q] for q in large] + [below] * (below > 0), turn), own, len(large)))
            upto = sent.copy()
            for q, n in gives.items():
                upto[q] += n
            self.phases.append((sent, upto, base, made))
            sent, base = upto, base + sum(gives.values())

    def places(self, queue, a, b):
        """(which, begin, end, position): the intervals a..b of queues, as runs of the stream, in order of which and begin."""
        import numpy as np

        out = []
        for lo, hi, base, made in self.phases:
            x, y = np.maximum(a, lo[queue]), np.minimum(b, hi[queue])
            row = np.flatnonzero(y > x)
            shift = lo[queue]  # the phase's own places
            carried = tuple(np.zeros(0, np.int64) for _ in range(4))  # row, begin in its queue, begin and end in the stream below
            for deal, own, last in reversed(made):
                mine = row[own[queue[row]] >= 0]
                k = np.concatenate([own[queue[mine]], np.full(len(carried[0]), last)])
                start = np.concatenate([x[mine], carried[1]])
                p = np.concatenate([x[mine] - shift[mine], carried[2]])
                q = np.concatenate([y[mine] - shift[mine], carried[3]])
                which, begin, end, place = deal.lay(k, p, q)
                carried = (np.concatenate([mine, carried[0]])[which], start[which] + begin - p[which], place, place + end - begin)
            out.append((carried[0], carried[1], carried[2] + base, carried[3] + base))
        row, begin, place, stop = (np.concatenate(x) for x in zip(*out, strict=True))
        by = np.lexsort((begin, row))
        row, begin, place, stop = row[by], begin[by], place[by], stop[by]
        new = np.ones(len(row), bool)  # runs that go on where the one before ends are one
        new[1:] = (row[1:] != row[:-1]) | (place[1:] != stop[:-1]) | (begin[1:] - begin[:-1] != stop[:-1] - place[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(row)) - 1
        return row[first], begin[first], place[first], stop[last]

    def _sequence(self, place):
        import numpy as np

        tail = place - self.full * self.window
        return np.where(tail < 0, place // self.window, self.full + np.searchsorted(self.bounds, np.maximum(tail, 0), side="right") - 1)

    def _begin(self, sequence):
        import numpy as np

        tail = np.clip(sequence - self.full, 0, len(self.bounds) - 1)
        return np.minimum(sequence, self.full) * self.window + np.where(sequence > self.full, self.bounds[tail], 0)

    def pieces(self, queue, a, b):
        """(which, begin, end, sequence, offset) of the pieces that the intervals become."""
        import numpy as np

        row, begin, place, stop = self.places(queue, a, b)
        which, s = _spread(self._sequence(place), self._sequence(stop - 1))
        s0, s1 = self._begin(s), np.where(s + 1 >= self.full + len(self.bounds) - 1, np.iinfo(np.int64).max, self._begin(s + 1))
        x, y = np.maximum(place[which], s0), np.minimum(stop[which], s1)
        start = begin[which] + x - place[which]
        return row[which], start, start + y - x, s, x - s0


def _pieces(totals: dict[int, int], window: int, weights):
    def run(batches):
        import zlib

        import numpy as np
        import pyarrow as pa

        plan = Plan(totals, window, weights)
        for batch in batches:
            if not batch.num_rows:
                continue
            queue, begin, n = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1, 2))
            row, a, b, sequence, offset = plan.pieces(queue, begin, begin + n)
            start, length = a - begin[row], b - a
            crc, ids, crc32 = np.empty(len(row), np.int64), batch.column(3), zlib.crc32
            at, wide = -1, None
            for i, (r, s, e) in enumerate(zip(row.tolist(), (4 * start).tolist(), (4 * (start + length)).tolist(), strict=True)):
                if r != at:
                    at, wide = r, memoryview(np.frombuffer(ids[r].as_buffer(), "<u2").astype("<u4").tobytes())
                crc[i] = crc32(wide[s:e])
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [batch.column(4).take(take), *(pa.array(x) for x in (start, length, crc, n[row], sequence, offset)), batch.column(5).take(take)],
                [x.split()[0] for x in PIECES.split(", ")],
            )

    return run


def pack(docs: DataFrame, path: str | None = None, window: int = WINDOW, end_id: int = END_ID, targets: dict[str | None, float] | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, source."""
    spark = docs.sparkSession
    own = own_queues(docs, tuple(targets or ()))
    tokens = encode(docs, own, path, end_id)
    cells = materialize(tokens.groupBy("queue", "block").agg(F.sum("n").alias("n")))
    totals = {r["queue"]: r["n"] for r in cells.groupBy("queue").agg(F.sum("n").alias("n")).collect()}  # a row a queue: LANES and own ones at most
    if not totals:
        return spark.createDataFrame([], PIECES)
    before = F.sum("n").over(Window.partitionBy("queue").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))  # a row a block
    offsets = cells.select(F.col("queue").alias("o_queue"), F.col("block").alias("o_block"), F.coalesce(before, F.lit(0)).alias("block_begin"))
    if cells.count() <= MOST_OFFSETS:
        offsets = F.broadcast(offsets)
    placed = tokens.join(offsets, (F.col("block") == F.col("o_block")) & (F.col("queue") == F.col("o_queue")))
    rows = placed.select("queue", (F.col("block_begin") + F.col("within")).alias("begin"), "n", "ids", "doc_id", "source")
    weights = {own.index(s): w for s, w in (targets or {}).items()}
    return rows.mapInArrow(_pieces(totals, window, weights), PIECES)
