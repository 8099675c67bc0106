"""Tables written to the shared folder and read again, which cuts lineage: a lost executor costs a re-read of files."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; where it is unset a temporary one, in local mode only, where all is one process."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.partition("[")[0] == "local":
            raise RuntimeError("spark.checkpoint.dir has to name a folder that driver and executors share")
        named = "file://" + tempfile.mkdtemp(prefix="lumentide-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


#: Rows to a file of a table that is known to be small, and files that such a table has at most.
FILE_ROWS, FILES = 1 << 17, 8


class Scratch:
    """Parquet tables in the shared folder; ``drop`` removes those that are done with."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
        self.made = 0

    def write(self, df: DataFrame, *by: str, rows: int | None = None) -> DataFrame:
        """df from files, in folders by the columns ``by``, so that filters on these read their folders only.

        rows: a bound of df's rows, where one is known.  A table of few rows then goes to few files rather than one a
        task, since making, committing and opening each file costs more than its rows.
        """
        if rows is not None and rows <= FILE_ROWS * FILES:
            df = df.repartition(max(1, -(-rows // FILE_ROWS)))
        self.made += 1
        path = f"{self.root}/t{self.made}"
        df.write.partitionBy(*by).option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, *tables: DataFrame | None) -> None:
        jvm = self.spark._jvm
        conf = self.spark._jsc.hadoopConfiguration()
        for t in tables:
            if t is not None and getattr(t, "_scratch_path", None):
                path = jvm.org.apache.hadoop.fs.Path(t._scratch_path)
                path.getFileSystem(conf).delete(path, True)
