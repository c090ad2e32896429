"""Session helpers: the shared folder and tables that cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession

_OWN_DIR: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. Where it is unset, a session in one process (local master)
    gets a temporary folder; on a cluster that would lie on each machine's own disk, so there it is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN_DIR:
        _OWN_DIR[app] = "file://" + tempfile.mkdtemp(prefix="strandloom-")
    return _OWN_DIR[app]


def materialize(df: DataFrame, name: str = "step") -> DataFrame:
    """Write df as a table in the shared folder and read it again: lineage is cut, a lost executor costs nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_table(df: DataFrame) -> None:
    """Remove the files behind materialized tables that nothing reads any more; other files are left alone."""
    spark = df.sparkSession
    shared = urlparse(shared_dir(spark)).path
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if urlparse(folder).path.rsplit("/", 1)[0] == shared:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
