"""Sessions, table access and the one place where lineage is cut."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Settings for a session of our own; a cluster's own values are never overridden.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session; on a cluster, use the session that is there."""
    builder = SparkSession.builder.master(f"local[{cores}]").config("spark.sql.shuffle.partitions", shuffle_partitions)
    return builder.config(map=DEFAULTS | conf).getOrCreate()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir, which all executors reach. Only where it is unset (tests, one
    machine) a temporary folder is made and set."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="tidemark-")
        atexit.register(shutil.rmtree, folder[7:], True)
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


@contextmanager
def compiled_in_parts(spark: SparkSession):
    """For actions with very large expressions: the JVM compiles no method of more than 8000 bytes of code, so stages
    that would be one such method run expression by expression instead. The setting is put back afterwards."""
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    spark.conf.set(name, "8000")
    try:
        yield
    finally:
        spark.conf.set(name, before)


class Scratch:
    """Tables written in the shared folder to cut lineage; they outlive the loss of any executor.

    ``keep`` writes a frame and reads it back; ``drop`` removes a table no later step reads. What is left goes at
    the end of the driver's process."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.base = f"{shared_folder(spark)}/tidemark-{uuid.uuid4().hex}"
        self.n = 0
        atexit.register(self._remove, self.base)

    def _remove(self, path: str) -> None:
        try:
            jvm = self.spark.sparkContext._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # the JVM may be gone already at the end of the process
            if path.startswith("file://"):
                shutil.rmtree(path[7:], ignore_errors=True)

    def keep(self, df: DataFrame, name: str = "t", by: str | None = None) -> DataFrame:
        """``by``: a column whose values become folders, so that a filter on it reads its rows only."""
        self.n += 1
        path = f"{self.base}/{self.n:03d}_{name}"
        (df.write.partitionBy(by) if by else df.write).parquet(path)
        kept = self.spark.read.schema(df.schema).parquet(path)
        kept._tidemark_path = path
        return kept

    def drop(self, df: DataFrame) -> None:
        path = getattr(df, "_tidemark_path", None)
        if path:
            self._remove(path)


def partitions_for(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def data_dir(scale: str = "sf0.001") -> str:
    return os.environ.get("TIDEMARK_DATA", "/root/testdata") + f"/{scale}"
