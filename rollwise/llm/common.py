"""What the operators of this subpackage share: sessions, tables, scratch tables, digests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans import files
from ..session import apply_conf, scratch_path, ship_package

# Rows of a batch handed to Python: long texts make batches of many rows heavy.
ARROW_ROWS = 2000


def prepare(spark: SparkSession) -> None:
    """Session settings of the operators, and the package on the Python workers."""
    apply_conf(spark)
    # these joins sort: a hashed side stays in memory, which the operators' own buffers need
    spark.conf.set("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "0")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    # every step ends in a written table, so a step's shuffle files need not outlive it
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    ship_package(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the shared checkpoint folder and read back: its rows are
    fixed from here on and survive lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, "llm", name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete the files of ``stored`` frames that no later step reads."""
    for df in frames:
        files.delete(df.sparkSession, df._scratch)


def spans_text(spans: Column) -> Column:
    """'kind:start:end,...' of an array of structs with those fields, in array order."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == F.lit(kind))).cast("long")


def of_kinds(spans: Column, kinds: tuple[str, ...]) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)
