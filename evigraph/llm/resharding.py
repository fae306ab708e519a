"""Sharding: minimum-cost-flow resharding under the law `rows` (row counts of any two shards differ by one at most).

Old shard sizes and new capacities make a small flow network: old shard -> itself costs nothing, old shard -> any other costs the
bytes of the rows that move, and a shard's rows leave smallest first, so its cost arcs are convex. Successive shortest paths
on that network (two blocks a shard, whatever the data) give the block transfers that move the fewest bytes. All that reaches the driver is a few numbers for each shard.
Ranks come from counts of (shard, size, salt) and a row number within each, so equal sizes, such as copies of one text or repeated rows, are spread by salt.

Nulls: a null text has no bytes (size 16, crc32 0); a null old shard counts as shard 0; a null doc_id is a row like others. Repeated rows
each get a slot. An empty table gives an empty result. `rewrite` writes only files of shards that gain or lose rows; the query returns the placement.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, row_key, text_or_empty

ROW_BYTES = 16
SALTS = 256


def min_cost_flow(n: int, arcs: list[tuple[int, int, int, float]], source: int, sink: int) -> list[int]:
    """Flow on each arc (from, to, capacity, cost a unit) of a maximum flow of least cost, by successive shortest paths."""
    out: list[list[int]] = [[] for _ in range(n)]
    to, room, cost = [], [], []
    for a, b, cap, c in arcs:
        for u, v, k, x in ((a, b, cap, c), (b, a, 0, -c)):
            out[u].append(len(to))
            to.append(v)
            room.append(k)
            cost.append(x)
    while True:
        far, via = [float("inf")] * n, [-1] * n
        far[source], queue, waits = 0.0, [source], [False] * n
        while queue:
            u = queue.pop(0)
            waits[u] = False
            for e in out[u]:
                if room[e] > 0 and far[u] + cost[e] < far[to[e]] - 1e-9:
                    far[to[e]], via[to[e]] = far[u] + cost[e], e
                    if not waits[to[e]]:
                        waits[to[e]] = True
                        queue.append(to[e])
        if via[sink] < 0:
            return [room[2 * i + 1] for i in range(len(arcs))]
        path, v = [], sink
        while v != source:
            path.append(via[v])
            v = to[via[v] ^ 1]
        step = min(room[e] for e in path)
        for e in path:
            room[e] -= step
            room[e ^ 1] += step


def transfers(counts: list[int], forced_bytes: list[int], marginal: list[int]) -> tuple[list[int], list[list[int]]]:
    """(rows each shard may hold, rows to move from i to j). marginal[i]: bytes of the last row that must go if shard i gets no
    extra slot; forced_bytes[i]: bytes of all that must go before it."""
    n = len(counts)
    low, extra = divmod(sum(counts), n)
    source, hub, pool, sink = 2 * n, 2 * n + 1, 2 * n + 2, 2 * n + 3
    arcs: list[tuple[int, int, int, float]] = []
    for i, c in enumerate(counts):
        arcs.append((source, i, c, 0))
        arcs.append((i, n + i, c, 0))
        over = c - low
        arcs.append((i, hub, max(0, over - 1), forced_bytes[i] / max(1, over - 1)))
        arcs.append((i, hub, 1 if over > 0 else 0, marginal[i]))
        arcs.append((hub, n + i, low + 1, 0))
        arcs.append((n + i, sink, low, 0))
        arcs.append((n + i, pool, 1, 0))
    arcs.append((pool, sink, extra, 0))
    flow = min_cost_flow(2 * n + 4, arcs, source, sink)
    leave = [flow[7 * i + 2] + flow[7 * i + 3] for i in range(n)]
    enter = [flow[7 * i + 4] for i in range(n)]
    moves, j, left = [[0] * n for _ in range(n)], 0, list(enter)
    for i in range(n):
        due = leave[i]
        while due:
            while not left[j]:
                j += 1
            k = min(due, left[j])
            moves[i][j] += k
            left[j] -= k
            due -= k
    return [counts[i] - leave[i] + enter[i] for i in range(n)], moves


def old_layout(shards: int, text: Column | None = None) -> Column:
    """The layout before: content-addressed, so that equal texts lay together."""
    return F.pmod(F.xxhash64(text_or_empty() if text is None else text), F.lit(shards)).cast("int")


def free_name(name: str, columns: list[str]) -> str:
    """The name, or with so many underscores that no column has it."""
    while name.lower() in {c.lower() for c in columns}:
        name += "_"
    return name


def ranked(docs: DataFrame, old: Column, number: str | None = None) -> DataFrame:
    """doc_id, size, text_crc32, old, number, rank: the rank of a row among its old shard's, smallest first, from 0. number: a column of docs that is unique, or a new one."""
    text = text_or_empty()
    rows = docs.select(
        "doc_id",
        (F.octet_length(text).cast("long") + ROW_BYTES).alias("size"),
        F.crc32(text).cast("long").alias("text_crc32"),
        F.coalesce(old, F.lit(0)).cast("int").alias("old"),
        (F.col(number) if number else row_key()).alias("number"),
    )
    # the number's high bits tell partitions of the scan apart, so that rows repeated with one id are spread too
    rows = materialize(rows.withColumn("salt", F.pmod(F.xxhash64("doc_id", "text_crc32", F.shiftright("number", 33)), F.lit(SALTS)).cast("int")))
    cells = rows.groupBy("old", "size", "salt").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("old").orderBy("size", "salt").rowsBetween(Window.unboundedPreceding, -1))
    cells = cells.select("old", "size", "salt", F.coalesce(before, F.lit(0)).alias("base"))
    within = F.row_number().over(Window.partitionBy("old", "size", "salt").orderBy("doc_id", "text_crc32", "number")) - 1
    at = rows.withColumn("within", within).join(cells, ["old", "size", "salt"])
    return materialize(at.select("doc_id", "size", "text_crc32", "old", "number", (F.col("base") + F.col("within")).alias("rank")))


def plan(ranks: DataFrame, shards: int) -> list[tuple[int, int, int, int, int]]:
    """(old, first rank, end rank, new shard, first slot): what happens to each range of ranks. At most 2 x shards + moves rows."""
    found = {r["old"]: r["n"] for r in ranks.groupBy("old").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a shard
    counts = [found.get(i, 0) for i in range(shards)]
    low = sum(counts) // shards
    over = F.lit(0)
    for i, c in enumerate(counts):
        over = F.when(F.col("old") == i, F.lit(max(0, c - low))).otherwise(over)
    goes = ranks.withColumn("over", over).filter(F.col("rank") < F.col("over"))
    last = F.col("rank") == F.col("over") - 1
    sums = goes.groupBy("old").agg(F.sum(F.when(~last, F.col("size"))).alias("forced"), F.sum(F.when(last, F.col("size"))).alias("marginal"))
    cost = {r["old"]: (r["forced"] or 0, r["marginal"] or 0) for r in sums.collect()}  # a row a shard
    _, moves = transfers(counts, [cost.get(i, (0, 0))[0] for i in range(shards)], [cost.get(i, (0, 0))[1] for i in range(shards)])
    left = [sum(m) for m in moves]
    filled = [counts[i] - left[i] for i in range(shards)]
    ranges = [(i, left[i], counts[i], i, 0) for i in range(shards) if counts[i] > left[i]]
    for i in range(shards):
        at = 0
        for j in range(shards):
            if moves[i][j]:
                ranges.append((i, at, at + moves[i][j], j, filled[j]))
                at += moves[i][j]
                filled[j] += moves[i][j]
    return ranges


def _placed(docs: DataFrame, shards: int, old: Column | None, number: str | None = None) -> DataFrame:
    ranks = ranked(docs, old_layout(shards) if old is None else old, number)
    ranges = docs.sparkSession.createDataFrame(plan(ranks, shards), "o int, first long, last long, shard int, slot0 long")
    placed = ranks.join(F.broadcast(ranges), (F.col("old") == F.col("o")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("last")))  # ranges: under shards x 3 rows
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        (F.col("slot0") + F.col("rank") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        F.col("old").alias("old_shard"), (F.col("old") != F.col("shard")).alias("moved"), "number",
    )


def reshard(docs: DataFrame, shards: int = 40, old: Column | None = None) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard, old_shard, moved."""
    return _placed(docs, shards, old).drop("number")


def rewrite(docs: DataFrame, path: str, shards: int = 40, old: Column | None = None, rows_per_file: int = 100_000) -> tuple[str, list[int]]:
    """Solve the transfers and write the shards that gain or lose rows under path/shard=N, all columns as they were, in files of bounded size; the other shards' files stay.

    Rows are numbered and written once, so null and repeated ids keep each row. Returns the name of the shard column (`shard`, with underscores behind it if
    docs has such a column) and the shards that were written."""
    number = free_name("_number", docs.columns)
    rows = materialize(docs.withColumn(number, row_key()))
    placed = materialize(_placed(rows, shards, old, number))
    affected = sorted(r[0] for r in placed.filter("moved").select(F.explode(F.array("shard", "old_shard"))).distinct().collect())  # at most a row a shard
    name, file = free_name("shard", docs.columns), free_name("_file", docs.columns)
    to = placed.filter(F.col("shard").isin(affected)).select(F.col("number").alias(number), F.col("shard").alias(name), F.floor(F.col("slot") / rows_per_file).alias(file))
    out = rows.join(to, number).repartition(name, file).drop(number, file)
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(name).parquet(path)
    return name, affected
