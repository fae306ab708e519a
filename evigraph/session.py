"""Session defaults for local runs; on a cluster the submitted configuration wins."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

#: Rows and bytes of an Arrow batch: whole texts are held twice on each side of the pipe, so batches are kept small.
BATCH_ROWS, BATCH_BYTES = 2000, 16 << 20


def local_session(cores: int | str = 8, shuffle: int = 8, app: str = "evigraph") -> SparkSession:
    """A UTC session with AQE on. An active session is returned as it is."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("EVIGRAPH_DRIVER_MEMORY", "8g"))
    )
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str):
    """One table of a data directory; only Spark opens the path."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package wherever they run: once a session it is zipped and handed to Spark's own file server. Larger Arrow batches are cut to the bounds above."""
    import zipfile
    from pathlib import Path

    sc = spark.sparkContext
    for name, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        now = spark.conf.get(f"spark.sql.execution.arrow.{name}").rstrip("b")
        if not now.isdigit() or int(now) == 0 or int(now) > most:
            spark.conf.set(f"spark.sql.execution.arrow.{name}", str(most))
    package = Path(__file__).resolve().parent
    if getattr(sc, "_evigraph_shipped", False) or not package.is_dir():
        return
    target = Path(tempfile.mkdtemp(prefix="evigraph-code-")) / "evigraph_code.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(str(target))
    sc._evigraph_shipped = True
