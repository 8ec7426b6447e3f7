"""Versions of a state table in a folder that the whole cluster sees.

A version is a folder of its own and counts once its writer has finished, so a run that is lost midway leaves the
version before it in place and can be repeated.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``. Where that is unset, a folder of its own, but on one machine only: executors of a
    cluster do not see the driver's folders."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("spark.checkpoint.dir is not set: it names the folder that driver and executors share")
    return "file://" + tempfile.mkdtemp(prefix="parcelspark-")


class States:
    """The states of one job under ``root``: named tables whose versions are counted together."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = root or f"{shared_folder(spark)}/states-{uuid.uuid4().hex}"

    def _files(self):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.root)
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def version(self, name: str) -> int:
        """The newest finished version of ``name``, 0 if there is none."""
        path, files = self._files()
        done = files.globStatus(path.suffix(f"/{name}/*/_SUCCESS")) or []
        return max((int(found.getPath().getParent().getName()) for found in done), default=0)

    def read(self, name: str, version: int | None = None) -> DataFrame | None:
        """The newest version of ``name``, or the one asked for; None if there is none."""
        version = self.version(name) if version is None else version
        return self.spark.read.parquet(f"{self.root}/{name}/{version}") if version else None

    def write(self, name: str, df: DataFrame, version: int, keep: int = 2) -> DataFrame:
        """Writes ``df`` as a version and removes those older than the last ``keep``. The folder of a run that did
        not finish is written again."""
        df.write.mode("overwrite").parquet(f"{self.root}/{name}/{version}")
        path, files = self._files()
        for found in files.globStatus(path.suffix(f"/{name}/*")) or []:
            if int(found.getPath().getName()) <= version - keep:
                files.delete(found.getPath(), True)
        return self.read(name, version)
