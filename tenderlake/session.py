"""A session with the settings that the operators rely on, and scratch tables in the shared folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def session(master: str | None = None, **more) -> SparkSession:
    b = SparkSession.builder.appName("tenderlake")
    if master:
        b = b.master(master)
    conf = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", "spark.sql.variant.allowDuplicateKeys": "true"} | more
    return b.config(map=conf).getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a temporary one where that is unset and all runs on one machine."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="tenderlake-")
        spark.sparkContext.setCheckpointDir(found)
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


#: Whether the shuffles of a query go at its end.
SWEPT = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Scratch:
    """Tables written to the shared folder, so that a lost executor costs no more than the current stage.

    What is not dropped before goes when the driver ends, as results are read lazily.

    Spark takes a table's compressed files for its size, and what is exploded from it for no larger; joins would send such tables through
    the driver at many times that size.  With sent=False they are sorted and merged, unless a join asks for broadcasting.

    Shuffles stay on disk until the driver collects its garbage.  With kept=False those of a table go once it is written, as nothing reads them again.
    """

    def __init__(self, spark: SparkSession, name: str, sent: bool = True, kept: bool = True):
        self.spark, self.root, self.n, self.sent, self.kept = spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}", 0, sent, kept
        root, fs = self._at(self.root)
        fs.mkdirs(root)
        fs.deleteOnExit(root)

    def _at(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())

    def path(self, name: str = "t") -> str:
        self.n += 1
        return f"{self.root}/{name}{self.n}"

    def save(self, df: DataFrame, name: str = "t", **options: str) -> DataFrame:
        """Writes df, with these options of the writer, and returns what was written, cut from its lineage."""
        path = self.path(name)
        writer, swept = df.write.options(compression="zstd", **options), self.spark.conf.get(SWEPT)
        if not self.kept:
            self.spark.conf.set(SWEPT, "true")
        try:
            writer.parquet(path)
        finally:
            self.spark.conf.set(SWEPT, swept)
        out = self.spark.read.schema(df.schema).parquet(path)
        out = out if self.sent else out.hint("merge")
        out._scratch_path = path
        return out

    def drop(self, *frames: DataFrame) -> None:
        """Deletes saved tables that nothing reads any more."""
        for df in frames:
            path, fs = self._at(df._scratch_path)
            fs.delete(path, True)

    def clear(self) -> None:
        """Deletes all tables saved so far."""
        root, fs = self._at(self.root)
        fs.delete(root, True)
