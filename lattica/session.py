"""Session helpers: the shared folder for cut lineage, and names that cannot clash with data columns."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Prefix of every column an operator adds for its own use.
INTERNAL = "__lt_"

#: White space trimmed from identifiers; the same set is used in the SQL twins.
BLANKS = " \t\n\r\x0b\x0c "


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it in spark.checkpoint.dir.

    Only where that setting is absent and the master is local (tests, a laptop) is a temporary folder made and set; on a
    cluster its absence is an error, as no folder of one machine is shared.
    """
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    jsc = spark.sparkContext._jsc.sc()
    if jsc.getCheckpointDir().isDefined():
        return jsc.getCheckpointDir().get().rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    own = tempfile.mkdtemp(prefix="lattica-")
    atexit.register(shutil.rmtree, own, True)
    spark.sparkContext.setCheckpointDir(f"file://{own}")
    return jsc.getCheckpointDir().get().rstrip("/")


_made: list[str] = []


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; clear_staging removes what stands there."""
    _made.append(f"{shared_dir(spark)}/lattica-{name}-{uuid.uuid4().hex}")
    return _made[-1]


def clear_staging(spark: SparkSession) -> int:
    """Delete the staged tables of this driver. DataFrames that were built on them can no longer be read."""
    jvm, n = spark._jvm, 0
    while _made:
        at = jvm.org.apache.hadoop.fs.Path(_made.pop())
        n += bool(at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True))
    return n


def staged(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write df as a table in the shared folder and read it back: lineage ends there, and a lost executor costs nothing."""
    path = staging_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trimmed(column: Column | str) -> Column:
    """column without white space at its ends (tabs, line ends and no-break spaces included)."""
    return F.btrim(F.col(column) if isinstance(column, str) else column, F.lit(BLANKS))


def folded_id(column: Column | str) -> Column:
    """The form in which two spellings of one identifier are equal: trimmed and upper-cased."""
    return F.upper(trimmed(column))
