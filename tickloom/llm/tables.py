"""Reading the test tables and keeping intermediate ones in the shared folder."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.session import remove, run_folder


COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def texts(docs: DataFrame, *kept: str) -> DataFrame:
    """``doc_id``, ``text`` and columns named ``kept``, whatever else the rows carry."""
    own = [F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")]
    return docs.select(*own, *kept)


def plain_names(stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A stage that returns the columns of ``docs``, whatever further ones are named.

    Columns that documents do not have by themselves are known by their position meanwhile, so no name
    clashes with one that a stage uses or has to be quoted.
    """

    @wraps(stage)
    def run(docs: DataFrame, *args, **kwargs) -> DataFrame:
        names = [name if name in COLUMNS else f"further{i}" for i, name in enumerate(docs.columns)]
        return stage(docs.toDF(*names), *args, **kwargs).toDF(*docs.columns)

    return run


def text_key(text: Column) -> Column:
    """Digest of a text. Ids may be null or repeated, so a document is known by its id and this."""
    return F.xxhash64(text.cast("string"))


def stored(frame: DataFrame, name: str) -> DataFrame:
    """Write once, read from there on: cuts lineage and survives lost executors."""
    spark = frame.sparkSession
    path = f"{run_folder(spark)}/{name}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def discard(frame: DataFrame) -> None:
    """Delete the files of a table made by ``stored`` once nothing reads it any more."""
    for folder in {name.rpartition("/")[0] for name in frame.inputFiles()}:
        remove(frame.sparkSession, folder)
