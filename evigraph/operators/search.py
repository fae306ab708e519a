"""Search: BM25 postings, character-gram vectors, exact cosine, fused ranks, two-stage routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship
from .postings import K1, B, BlockPostings
from .vectors import InvertedFile, cosine

WIDTH = 256


def tokens(text: Column) -> Column:
    """Runs of ASCII letters and digits in lower case."""
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda t: t != "")


def postings(df: DataFrame, key: str, text: str) -> DataFrame:
    """(doc, term, tf, dl); rows without text are skipped."""
    words = df.filter(F.col(text).isNotNull()).select(F.col(key).alias("doc"), tokens(F.col(text)).alias("w"))
    return words.select("doc", F.size("w").alias("dl"), F.explode("w").alias("term")).groupBy("doc", "term", "dl").agg(F.count(F.lit(1)).alias("tf"))


def query_terms(query: str) -> list[str]:
    return sorted({t for t in "".join(c if c.isascii() and c.isalnum() else " " for c in query.lower()).split()})


def bm25(df: DataFrame, key: str, text: str, query: str) -> DataFrame:
    """(doc, score) of all documents that hold a query token: sum of idf * tf (k1+1) / (tf + k1 (1 - b + b dl / avgdl)). One pass that keeps a row for each hit of a query token, and
    another over lengths alone; for many lookups build the postings once (TextIndex)."""
    docs = df.filter(F.col(text).isNotNull()).select(F.col(key).alias("doc"), tokens(F.col(text)).alias("w")).select("doc", F.size("w").alias("dl"), "w")
    terms = query_terms(query)
    wanted = F.array(*[F.lit(t) for t in terms]).cast("array<string>")
    hits = docs.select("doc", "dl", F.explode(F.filter("w", lambda t: F.array_contains(wanted, t))).alias("term")).groupBy("doc", "dl", "term").agg(F.count(F.lit(1)).alias("tf"))
    return _scored(hits, docs.agg(F.count(F.lit(1)).alias("n"), F.avg("dl").alias("avgdl")))


def _scored(hits: DataFrame, stats: DataFrame) -> DataFrame:
    """hits (doc, dl, term, tf) of the query's terms; stats: one row (n, avgdl)."""
    spread = hits.groupBy("term").agg(F.count(F.lit(1)).alias("df"))  # a row a query term
    got = hits.join(F.broadcast(spread), "term").crossJoin(F.broadcast(stats))  # one row
    idf = F.log(1 + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    tf = F.col("tf").cast("double")
    part = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * F.col("dl") / F.col("avgdl")))
    return got.groupBy("doc").agg(F.sum(part).alias("score"))


class IndexMissing(LookupError):
    pass


class Indexes:
    """A registry of text and vector indexes over node properties (H1, H5, H9): blocks of postings and inverted files, each written once."""

    def __init__(self, spark, path: str):
        self.spark, self.path = spark, path
        self.texts: dict[tuple[str, str], BlockPostings] = {}
        self.vectors: dict[tuple[str, str], InvertedFile] = {}

    def build_text(self, label: str, prop: str, df: DataFrame, key: str) -> dict:
        """Write the postings of a property; rows without text are skipped. What is returned: indexed, terms, skipped."""
        made = BlockPostings.build(df, key, prop, f"{self.path}/text-{label}-{prop}")
        self.texts[label, prop] = made
        return {"indexed": made.n, "terms": made.terms(), "skipped": df.count() - made.n}

    def search_text(self, label: str, prop: str, query: str, top_k: int | None = None) -> DataFrame:
        """(doc, score) from the postings of the query's terms; a property without an index raises."""
        if (label, prop) not in self.texts:
            raise IndexMissing(f"{label}.{prop} has no text index")
        held, terms = self.texts[label, prop], query_terms(query)
        return held.search(terms) if top_k is None else held.top(terms, top_k)

    def build_vectors(self, label: str, prop: str, df: DataFrame, key: str, model: str = "chargram") -> dict:
        """Embed a property and index its vectors, so that a lookup neither embeds nor reads them all again."""
        return self.add_vectors(label, prop, embedder(model)(df.filter(F.col(prop).isNotNull()), key, prop), "doc", "vec")

    def add_vectors(self, label: str, prop: str, df: DataFrame, key: str, vec: str) -> dict:
        """Index vectors that are there already."""
        made = InvertedFile.build(df, key, vec, f"{self.path}/vector-{label}-{prop}")
        self.vectors[label, prop] = made
        return {"indexed": made.size, "dim": made.width}

    def search_vectors(self, label: str, prop: str, vec: list[float], k: int, exact: bool = True) -> DataFrame:
        if (label, prop) not in self.vectors:
            raise IndexMissing(f"{label}.{prop} has no vector store")
        return self.vectors[label, prop].search(vec, k, exact)

    def listed(self) -> DataFrame:
        """(kind, label, property, indexed) of all indexes."""
        rows = [("text", a, b, x.n) for (a, b), x in self.texts.items()] + [("vector", a, b, v.size) for (a, b), v in self.vectors.items()]
        return self.spark.createDataFrame(rows, "kind string, label string, property string, indexed long")


def embedder(model: str, width: int = WIDTH):
    """The vectoriser of a model id; another id or width is refused (H4)."""
    if model != "chargram" or width != WIDTH:
        raise ValueError(f"no embedder {model!r} of width {width}; there is 'chargram' of width {WIDTH}")
    return chargram_vectors


def _gram_vectors():
    """A pandas UDF of normal texts: their vectors, row by row."""

    def vectors(text):
        import zlib

        import numpy as np
        import pandas as pd

        out = np.zeros((len(text), WIDTH))
        for i, t in enumerate(text):
            t = t or ""
            h = np.fromiter((zlib.crc32(t[k : k + n].encode("utf-8", "replace")) for n in (3, 4, 5) for k in range(len(t) - n + 1)), np.int64)
            out[i] = np.bincount(h % WIDTH, weights=np.where(h & 65536, 1.0, -1.0), minlength=WIDTH)
        out = np.where(out == 0, 0.0, np.sign(out) * (1 + np.log(np.maximum(np.abs(out), 1))))
        size = np.sqrt((out * out).sum(axis=1, keepdims=True))
        return pd.Series(list(out / np.where(size > 0, size, 1)))

    return F.pandas_udf(vectors, "array<double>")


def chargram_vectors(df: DataFrame, key: str, text: str) -> DataFrame:
    """(doc, vec) of each row: 256 slots of signed, damped counts of 3-, 4- and 5-grams, of length 1. No gram: all zero. Names lie tight on disk, so a few splits hold very many: the narrow rows are dealt anew, the wide ones
    are neither shuffled nor joined."""
    ship(df.sparkSession)
    rows = df.select(F.col(key).alias("doc"), F.col(text).alias("t")).repartition("doc")
    norm = F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower("t"), r"[^\p{L}\p{N}]+", " ")), F.lit(" "))
    return rows.select("doc", _gram_vectors()(norm).alias("vec"))


def cosine_top_k(df: DataFrame, key: str, vec: str, query: list[float], k: int) -> DataFrame:
    """Exact: one scan, top k."""
    q = F.array(*[F.lit(float(x)) for x in query])
    return df.select(F.col(key).alias("doc"), cosine(F.col(vec), q).alias("score")).orderBy(F.desc("score"), "doc").limit(k)


def fuse(lanes: list[DataFrame], weights: list[float] | None = None) -> DataFrame:
    """(doc, score): weighted sum of lanes (doc, score); a lane without the document adds nothing."""
    weights = weights or [1.0] * len(lanes)
    out = None
    for lane, w in zip(lanes, weights, strict=True):
        part = lane.select("doc", (F.col("score") * w).alias("score"))
        out = part if out is None else out.unionByName(part)
    return out.groupBy("doc").agg(F.sum("score").alias("score"))


def route(lexical: DataFrame, fallback) -> DataFrame:
    """Lexical hits where there are any, else what fallback() gives."""
    return fallback() if lexical.isEmpty() else lexical


def find(df: DataFrame, key: str, text: str, query: str, k: int, keep: Column | None = None, vectors: InvertedFile | None = None) -> DataFrame:
    """(doc, score, route) of the best k: lexical hits first, on a miss the nearest character-gram vectors of the whole name; `keep` filters candidates by rank or placeholder (H8). With an index of
    the names' vectors a miss embeds the query alone; without one, or where candidates are filtered, it embeds them all."""
    rows = df if keep is None else df.filter(keep)
    lexical = bm25(rows, key, text, query)

    def nearest():
        asked = chargram_vectors(df.sparkSession.createDataFrame([(0, query)], "k int, t string"), "k", "t").first()["vec"]
        if vectors is not None and keep is None:
            return vectors.search(list(asked), k, exact=True).withColumn("route", F.lit("vector"))
        return cosine_top_k(chargram_vectors(rows, key, text), "doc", "vec", asked, k).withColumn("route", F.lit("vector"))

    return route(lexical.orderBy(F.desc("score"), "doc").limit(k).withColumn("route", F.lit("lexical")), nearest)


def prefix(df: DataFrame, column: str, start: str, limit: int) -> DataFrame:
    return df.filter(F.col(column).startswith(start)).orderBy(column).limit(limit)
