"""What the training-data operators share: tables, scratch folders, exact ids and word rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from semesta.session import scratch_path

#: Bytes A-Z to a-z, every other byte as it is.
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name below the folder that all executors share; the folder ends with the application."""
    return scratch_path(spark, f"llm-{name}")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: later readers don't compute it again."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows that a Python worker gets at once: texts can be long, and a task holds several batches.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Let the session hand rows to Python in batches of at most BATCH_ROWS; a smaller setting stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, BATCH_ROWS)


def whole(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z only) words: runs of bytes other than space and 0x09 to 0x0D."""
    return text.encode("utf-8", "surrogatepass").translate(LOWER).split() if text else []
