"""Session helpers: shared scratch space and local test sessions.

Library code never changes session settings that shape query plans
(shuffle partitions, broadcast thresholds).  The only thing it needs from the
session is a *shared* folder for checkpoints and materialised intermediate
tables; that comes from ``spark.checkpoint.dir`` so that on a cluster every
executor sees the same storage.
"""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
#: Codec of stored tables: hashes, half of a fact's bytes, are hex texts that the default one leaves as they are.
CODEC = "zstd"


class NoSharedFolder(RuntimeError):
    """The session names no folder that all executors share."""


def shared_dir(spark: SparkSession) -> str:
    """Root of the shared scratch space (the session's checkpoint folder).

    Reads ``spark.checkpoint.dir``.  Where it is unset, a session that runs in
    one process (master ``local[...]``, as in tests) gets a temporary folder of
    its own; any other session raises `NoSharedFolder`, because executors on
    other machines would not see each other's files.
    """
    sc = spark.sparkContext
    root = spark.conf.get(CHECKPOINT_CONF, None) or sc.getCheckpointDir()
    if not root:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise NoSharedFolder(f"set {CHECKPOINT_CONF} to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="strata-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, root)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared scratch space.

    It is marked for deletion when the session's process ends.
    """
    path = f"{shared_dir(spark)}/strata/{name}-{uuid.uuid4().hex[:12]}"
    sc = spark.sparkContext
    target = sc._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(sc._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def materialize(df, spark: SparkSession | None = None):
    """Cut lineage with a reliable checkpoint in the shared folder.

    Used where two branches of one plan must see the *same* partition
    assignment (e.g. range slices), and where a retried task must not
    recompute a nondeterministic intermediate differently.
    """
    shared_dir(spark or df.sparkSession)
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of jobs that nothing refers to any
    more: it learns of them by the driver's garbage collection, which a large
    heap puts off for long."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


class Staged:
    """Tables written compressed to scratch folders and read back, for steps
    that read them more than once; the folders go when the step ends."""

    def __init__(self, spark: SparkSession):
        self.spark, self._paths = spark, []

    def __enter__(self) -> Staged:
        return self

    def keep(self, df: DataFrame) -> DataFrame:
        self._paths.append(path := scratch_path(self.spark, "staged"))
        df.write.parquet(path, compression=CODEC)
        return self.spark.read.schema(df.schema).parquet(path)

    def __exit__(self, *_) -> None:
        sc = self.spark.sparkContext
        for path in self._paths:
            p = sc._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)
        release(self.spark)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once per application.

    Functions that run in tasks are found by their module's name, so the
    workers must be able to import the package wherever they run.
    """
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    top = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="strata-py-"), "strata.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    file = os.path.join(folder, name)
                    z.write(file, os.path.relpath(file, os.path.dirname(top)))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and local benchmarks (UI off, UTC, AQE on)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("strata")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark
