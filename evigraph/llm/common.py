"""What the operators share: columns by name, shared storage, hold-out rules and prefix sums."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Base of a run id per scanned partition; the tree merges fold it sixteen ways a level.
RUNS = 4096


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share (spark.checkpoint.dir). Only where it is unset and the master is local, as in tests, a local one is set."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="evigraph-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def run_dir(spark: SparkSession) -> str:
    """This session's part of the shared folder; it is deleted when the driver ends."""
    sc = spark.sparkContext
    if not getattr(sc, "_evigraph_run", None):
        name = f"{shared_dir(spark)}/evigraph-{uuid.uuid4().hex}"
        path = sc._jvm.org.apache.hadoop.fs.Path(name)
        fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
        fs.mkdirs(path)
        fs.deleteOnExit(path)
        sc._evigraph_run = name
    return sc._evigraph_run


def materialize(df: DataFrame, codec: str = "zstd") -> DataFrame:
    """Cut the lineage: write df as Parquet in the shared folder and read it back with the same schema."""
    path = f"{run_dir(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def log_floor(df: DataFrame, column: str, most: int) -> int | None:
    """A value of the positive column that at most `most` rows reach, from a histogram of under 1,100 bins; None: no such bin."""
    step = F.floor(F.log2(column) * 16)
    bins = sorted(df.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n"), F.min(column).alias("least")).collect(), key=lambda r: -r["step"])
    found, total = None, 0
    for r in bins:
        total += r["n"]
        if total > most:
            break
        found = r["least"]
    return found


#: What a Python worker keeps between tasks: one tool at a time, so that a worker that serves several stages holds none of the earlier ones.
_kept: dict = {}


def kept(key, make):
    """The worker's tool of this key; another key's is dropped first and its memory given back."""
    if key not in _kept:
        if _kept:
            _kept.clear()
            give_back()
        _kept[key] = make()
    return _kept[key]


def give_back() -> None:
    """Return freed memory to the system, where the platform can."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # not glibc
        return


def crc_mod(column: str, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as 0."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % n, F.lit(0))


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def row_key() -> Column:
    """Unique for each row of one scan; only stable once it is materialized."""
    return F.monotonically_increasing_id()


#: Rows and bytes of an Arrow batch: whole texts are held twice on each side of the pipe, so batches are kept small.
BATCH_ROWS, BATCH_BYTES = 2000, 16 << 20


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package wherever they run: once a session it is zipped and handed to Spark's own file server. Larger Arrow batches are cut to the bounds above."""
    import zipfile
    from pathlib import Path

    sc = spark.sparkContext
    for name, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        now = spark.conf.get(f"spark.sql.execution.arrow.{name}").rstrip("b")
        if not now.isdigit() or int(now) == 0 or int(now) > most:
            spark.conf.set(f"spark.sql.execution.arrow.{name}", str(most))
    package = Path(__file__).resolve().parent.parent
    if getattr(sc, "_evigraph_shipped", False) or not package.is_dir():
        return
    target = Path(tempfile.mkdtemp(prefix="evigraph-code-")) / "evigraph_code.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(str(target))
    sc._evigraph_shipped = True
