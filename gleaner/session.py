"""Session factory and the few session facts that the operators read."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Largest side, in bytes by the optimizer's own statistics, that may be broadcast by hint.
BROADCAST_LIMIT = 32 * 1024 * 1024


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers of every executor this package, once for each Spark context.

    The workers import it by name; on a cluster they have neither the driver's folders nor its path.
    """
    sc = spark.sparkContext
    if getattr(sc, "_gleaner_shipped", False):
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="gleaner-package-")) / "gleaner.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(archive))
    sc._gleaner_shipped = True


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "gleaner") -> SparkSession:
    """A session with the settings that the tests and the benchmark use."""
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    ship_package(spark)
    return spark


def small_side(df: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """`df` with a broadcast hint if the optimizer's size estimate is within `limit`, else `df` itself.

    The estimate is an upper bound derived from file sizes, so a side that outgrows the limit is
    joined by shuffle (with AQE's skew handling) and never sent to every executor.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return F.broadcast(df) if size <= limit else df


def own_exchange(df: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """`df` behind an exchange of its own, broadcast if it is small: for an aggregated side of a join on its key.

    An aggregate is partitioned by its key already and joins without an exchange; then adaptive
    execution cannot split a hot key of the other side. The rows are spread evenly first, so that the
    join has to bring its own exchange; they are one row a key, so no partition is hot on this side.
    """
    sized = small_side(df, limit)
    if sized is not df:
        return sized
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Keep the shared folder named in `spark.checkpoint.dir`; set a local one only on a local master that names none.

    Elsewhere a folder of one machine would be lost with it, so a missing name is an error.
    """
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not sc.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="gleaner-checkpoint-"))


def ship_file(spark: SparkSession, path: str) -> None:
    """Give a file of the driver to the workers of every executor, once for each Spark context; nothing if the driver has none."""
    sc = spark.sparkContext
    known = getattr(sc, "_gleaner_files", set())
    if path not in known and Path(path).is_file():
        sc.addFile(path)
        sc._gleaner_files = known | {path}


def shipped(path: str) -> str:
    """Within a worker: the path itself if this machine has it, else the file that the driver gave."""
    return path if Path(path).is_file() else SparkFiles.get(Path(path).name)
