"""Source divergence audit: how far the term frequencies of a language's sources lie apart, and from the language's own.

Texts are split into terms and counted in one pass; what leaves a task is one row for each language, source and term it met, and one shuffle by language and term adds them up. Pairs of sources are
summed by a heavy-light split. Terms of many groups go into dense tiles, terms by sources, that numpy subtracts column against column; a tile holds a bounded number of terms and two bounded blocks
of sources. Terms of few groups stay postings: what a term adds where one source of the pair lacks it follows from a histogram of the counts in the other, so only pairs of sources that share the
term are visited, and corrected. Both partial sums are added; all arithmetic is on integers.

Null text, language or source count as ''. A group without terms has its rows, with counts of 0; a language without kept terms gives its pairs the value 0 and no terms; repeated rows each count; ids
and other columns are not read; an empty table gives an empty result; a text of any length is counted whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, ship, text_or_empty

LEAST_DOCS, TOP = 10, 10
#: A term is light if it occurs in at most one of so many groups of its language, and in so many groups at most.
LIGHT_SHARE, LIGHT_MOST = 8, 64
#: Terms of a tile, sources of a block.
TILE_TERMS, SIDE = 2048, 128
#: Terms a task counts before it hands on what it has.
HELD_TERMS = 300_000
UNIT = 1_000_000_000


def byte_table() -> bytes:
    """A-Z in lower case; bytes that part terms as spaces. Bytes from 0x80 on belong to other characters and stay."""
    parts = [*range(0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
    return bytes(0x20 if b in parts else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def _counted(batches):
    """(lang, source, term, n, docs) of what a task reads; the term '' stands for the group itself."""
    from collections import Counter, defaultdict

    import pyarrow as pa

    table = byte_table()
    times, docs, held = defaultdict(Counter), defaultdict(Counter), 0

    def handed():
        for (lang, source), found in docs.items():
            n = times[lang, source]
            terms = list(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(terms), pa.string()), pa.array([source] * len(terms), pa.string()), pa.array(terms, pa.binary()).cast(pa.string()), pa.array([n[t] for t in terms], pa.int64()), pa.array(list(found.values()), pa.int64())],
                ["lang", "source", "term", "n", "docs"],
            )
        times.clear()
        docs.clear()

    for batch in batches:
        langs, sources, texts = (batch.column(i) for i in range(3))
        for lang, source, text in zip(langs.to_pylist(), sources.to_pylist(), texts.cast(pa.binary()).to_pylist(), strict=True):
            words = text.translate(table).split()
            own = docs[lang, source]
            before = len(own)
            times[lang, source].update(words)
            own.update({*words, b""})
            held += len(own) - before
        if held >= HELD_TERMS:
            yield from handed()
            held = 0
    yield from handed()


def term_counts(docs: DataFrame, least: int = LEAST_DOCS) -> DataFrame:
    """(lang, term, source, n, lang_n, groups, first) of kept terms, written once; a row with the term '' for each group."""
    ship(docs.sparkSession)
    rows = docs.select(text_or_empty("lang").alias("lang"), text_or_empty("source").alias("source"), text_or_empty().alias("text"))
    parts = rows.mapInArrow(_counted, "lang string, source string, term string, n long, docs long")
    sums = parts.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))  # one shuffle: the group-by and the window keep to it
    w = Window.partitionBy("lang", "term")
    sums = sums.select("lang", "term", "source", "n", F.sum("docs").over(w).alias("docs"), F.sum("n").over(w).alias("lang_n"), F.count(F.lit(1)).over(w).alias("groups"), (F.col("source") == F.min("source").over(w)).alias("first"))
    return materialize(sums.filter((F.col("docs") >= least) | (F.col("term") == "")).drop("docs"))


def share(n: Column | str, total: str, terms: str) -> Column:
    """p of a count: 1 + floor(10^9 (n + 2) / (total + 2 terms)); counts of any size."""
    wide = lambda c: c.cast("decimal(20,0)")
    n = F.col(n) if isinstance(n, str) else n
    return F.lit(1) + F.call_function("div", F.lit(UNIT).cast("decimal(10,0)") * wide(n + 2), wide(F.col(total) + 2 * F.col(terms)))


def apart(p: str, q: str) -> Column:
    """floor((p - q)^2 / (p + q))."""
    return F.expr(f"({p} - {q}) * ({p} - {q}) div ({p} + {q})")


def group_table(counts: DataFrame) -> DataFrame:
    """(lang, source, no, total, n_groups, n_terms, lang_total, absent): a row a group, numbered within its language; absent is the p of a count of 0, null without kept terms."""
    real = F.col("term") != ""
    own = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count_if(real & F.col("first")).alias("firsts"))
    w = Window.partitionBy("lang")  # a row a group
    got = own.select("lang", "source", "total", (F.row_number().over(w.orderBy("source")) - 1).alias("no"), F.count(F.lit(1)).over(w).alias("n_groups"), F.sum("firsts").over(w).alias("n_terms"), F.sum("total").over(w).alias("lang_total"))
    return materialize(got.withColumn("absent", F.when(F.col("n_terms") > 0, share(F.lit(0).cast("long"), "total", "n_terms"))))


def top_terms(postings: DataFrame, top: int = TOP) -> DataFrame:
    """The terms that lift a group farthest above its language: (lang, source, part, item, value, rank)."""
    above = postings.withColumn("q", share("lang_n", "lang_total", "n_terms")).filter("n > 0 and p > q").select("lang", "source", F.col("term").alias("item"), apart("p", "q").alias("value"))
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return above.withColumn("rank", place).filter(F.col("rank") <= top).select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")


def _tile(key, table):
    """Sums over a tile's terms of the pairs (i, j) between two blocks of sources, i before j. Terms that no source here has are counted, not laid out."""
    import numpy as np
    import pyarrow as pa

    lang, _, left, right = (k.as_py() for k in key)
    no, p = table.column("no").to_numpy(), table.column("p").to_numpy()
    term = table.column("term").combine_chunks().dictionary_encode()
    code = term.indices.fill_null(-1).to_numpy(zero_copy_only=False)
    marks = code < 0
    held = int(table.column("tile_terms").to_numpy()[marks][0])
    order = np.argsort(no[marks])
    names, absent = no[marks][order], p[marks][order]
    dense = np.broadcast_to(absent, (len(term.dictionary) + 1, len(names))).copy()  # the last row: a term that none has
    dense[code[~marks], np.searchsorted(names, no[~marks])] = p[~marks]
    times = np.ones(len(dense), np.int64)
    times[-1] = held - len(term.dictionary)
    out_i, out_j, out_v = [], [], []
    for a in range(len(names)):
        if names[a] // SIDE != left:
            continue
        to = np.flatnonzero((names // SIDE == right) & (names > names[a]))
        one, other = dense[:, a : a + 1], dense[:, to]
        gap = one - other
        out_v.append(((gap * gap // (one + other)) * times[:, None]).sum(axis=0))
        out_i.append(np.full(len(to), names[a]))
        out_j.append(names[to])
    flat = lambda parts: pa.array(np.concatenate([np.zeros(0, np.int64), *parts]), pa.int64())
    v = flat(out_v)
    return pa.table({"lang": pa.array([lang] * len(v), pa.string()), "i": flat(out_i), "j": flat(out_j), "value": v})


def heavy_sums(heavy: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, i, j, value) over terms of many groups, by dense tiles. heavy: lang, term, no, p, first."""
    tiled = heavy.withColumn("tile", F.pmod(F.xxhash64("term"), F.ceil(F.col("n_terms") / TILE_TERMS)).cast("int"))  # n_terms is in each row: a join on lang would deal a language to a task
    tiles = tiled.filter("first").groupBy("lang", "tile").agg(F.count(F.lit(1)).alias("tile_terms"))
    none = groups.join(tiles, "lang").select("lang", "tile", F.lit(None).cast("string").alias("term"), "no", F.col("absent").alias("p"), "tile_terms", "n_groups")
    rows = tiled.select("lang", "tile", "term", "no", "p", F.lit(0).cast("long").alias("tile_terms"), "n_groups").unionByName(none)
    blocks = F.floor((F.col("n_groups") - 1) / SIDE).cast("long")
    dealt = rows.withColumn("own", F.floor(F.col("no") / SIDE).cast("long")).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks)))
    dealt = dealt.select("lang", "tile", F.least("own", "other").alias("left"), F.greatest("own", "other").alias("right"), "term", F.col("no").cast("long").alias("no"), F.col("p").cast("long").alias("p"), "tile_terms")
    return dealt.groupBy("lang", "tile", "left", "right").applyInArrow(_tile, "lang string, i long, j long, value long")


def light_sums(light: DataFrame, groups: DataFrame, pairs: DataFrame) -> DataFrame:
    """(lang, i, j, value) over terms of few groups. Where a source lacks a term its p is `absent`, so a term's part of a pair is known from the source that has it: first a histogram of p in each
    source is held against every other source's absent p and all remaining terms count as missing in both, then pairs that share a term are corrected. light: lang, term, no, p, absent, first."""
    bars = light.groupBy("lang", "no", "p").agg(F.count(F.lit(1)).alias("times"))
    far = groups.select("lang", F.col("no").alias("o"), F.col("absent").alias("o_absent"))
    one = bars.join(far, "lang").filter("no != o").select("lang", F.least("no", "o").alias("i"), F.greatest("no", "o").alias("j"), (F.col("times") * apart("p", "o_absent")).alias("value"))
    n_of = light.groupBy("lang", "no").agg(F.count(F.lit(1)).alias("n_own"))
    every = light.filter("first").groupBy("lang").agg(F.count(F.lit(1)).alias("n_light"))
    sides = pairs.join(every, "lang").join(n_of.select("lang", F.col("no").alias("i"), F.col("n_own").alias("n_i")), ["lang", "i"], "left").join(n_of.select("lang", F.col("no").alias("j"), F.col("n_own").alias("n_j")), ["lang", "j"], "left")
    neither = sides.select("lang", "i", "j", ((F.col("n_light") - F.coalesce("n_i", F.lit(0)) - F.coalesce("n_j", F.lit(0))) * apart("a_i", "a_j")).alias("value"))
    lists = light.groupBy("lang", "term").agg(F.array_sort(F.collect_list(F.struct("no", "p", "absent"))).alias("l"))  # LIGHT_MOST entries at most
    shared = lists.filter("size(l) > 1").select("lang", "l", F.explode("l").alias("x")).select("lang", "x", F.explode(F.filter("l", lambda y: y["no"] > F.col("x.no"))).alias("y"))
    both = shared.select("lang", F.col("x.no").alias("i"), F.col("y.no").alias("j"), (apart("x.p", "y.p") - apart("x.p", "y.absent") - apart("x.absent", "y.p") + apart("x.absent", "y.absent")).alias("value"))
    return one.unionByName(neither).unionByName(both)


def pair_values(postings: DataFrame, groups: DataFrame, light_share: int = LIGHT_SHARE, light_most: int = LIGHT_MOST) -> DataFrame:
    """Every pair of sources of a language: (lang, source, part, item, value, rank)."""
    a, b = groups.alias("a"), groups.alias("b")
    pairs = a.join(b, (F.col("a.lang") == F.col("b.lang")) & (F.col("a.no") < F.col("b.no"))).select(
        F.col("a.lang").alias("lang"), F.col("a.no").alias("i"), F.col("b.no").alias("j"), F.col("a.source").alias("s_i"), F.col("b.source").alias("s_j"), F.col("a.absent").alias("a_i"), F.col("b.absent").alias("a_j")
    )  # the pairs of the result
    is_light = (F.col("groups") * light_share <= F.col("n_groups")) & (F.col("groups") <= light_most)
    parts = heavy_sums(postings.filter(~is_light), groups).unionByName(light_sums(postings.filter(is_light), groups, pairs))
    sums = parts.groupBy("lang", "i", "j").agg(F.sum("value").alias("value"))
    got = pairs.join(sums, ["lang", "i", "j"], "left").withColumn("value", F.coalesce("value", F.lit(0)).cast("long"))
    both = got.select("lang", F.explode(F.array(F.struct(F.col("s_i").alias("source"), F.col("s_j").alias("item")), F.struct(F.col("s_j").alias("source"), F.col("s_i").alias("item")))).alias("x"), "value")
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return both.select("lang", "x.source", "x.item", "value").select("lang", "source", F.lit("pair").alias("part"), "item", "value", place.alias("rank"))


def divergence(docs: DataFrame, least: int = LEAST_DOCS, top: int = TOP, light_share: int = LIGHT_SHARE, light_most: int = LIGHT_MOST) -> DataFrame:
    """(lang, source, part, item, value, rank) of all pairs and of the top terms of every group."""
    counts = term_counts(docs, least)
    groups = group_table(counts)
    postings = counts.filter("term != ''").join(groups, ["lang", "source"]).withColumn("p", share("n", "total", "n_terms"))
    return pair_values(postings, groups, light_share, light_most).unionByName(top_terms(postings, top))
