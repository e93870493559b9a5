"""Helpers shared by the training-data operators: reading tables, written stages, word splitting."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space as a regex class body: space and 0x09 to 0x0D.
WS = r"\x20\x09-\x0D"
WS_CHARS = " \t\n\x0b\f\r"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``. Only a local master may
    go without it (then a temporary folder is made once per session)."""
    conf = spark.sparkContext.getConf()
    folder = conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    own = getattr(spark.sparkContext, "_tabmill_llm_dir", None)
    if own is None:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        own = tempfile.mkdtemp(prefix="tabmill-llm-")
        spark.sparkContext._tabmill_llm_dir = own
    return own


class Stages:
    """Written intermediate tables of one operator call. Reading them back cuts the lineage, so a
    lost executor costs at most the running job; ``drop`` deletes those no later plan reads."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
        self.paths: dict[int, str] = {}

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = path
        out._stage_path = path
        return out

    def drop(self, *frames: DataFrame) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for df in frames:
            path = jvm.org.apache.hadoop.fs.Path(df._stage_path)
            path.getFileSystem(conf).delete(path, True)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, all with as many more underscores in front as it takes for ``df`` to have no column called so (case
    ignored): an operator's own columns beside extra columns of any name."""
    taken, front = {c.lower() for c in df.columns}, ""
    while any((front + n).lower() in taken for n in names):
        front += "_"
    return [front + n for n in names]


def words(text: Column) -> Column:
    """Words of a text: maximal runs of characters other than ASCII white space."""
    return F.array_remove(F.split(text, f"[{WS}]+"), "")


def normal_line(line: Column) -> Column:
    """Lower case, white space runs as one space, none at the ends."""
    return F.trim(F.lower(F.regexp_replace(line, f"[{WS}]+", " ")))


def n_words(normal: Column) -> Column:
    """Words of a ``normal_line``."""
    return F.when(normal == "", 0).otherwise(F.length(normal) - F.length(F.replace(normal, F.lit(" "), F.lit(""))) + 1)


def without_lines(df: DataFrame, gone: str) -> DataFrame:
    """``text`` without the lines whose numbers are in the array column ``gone`` (null: unchanged). The lines are a column of
    their own first: inside a lambda the text would be split again for every line."""
    lines, = free_names(df, "__lines")
    df = df.withColumn(lines, F.when(F.col(gone).isNotNull(), F.split("text", "\n")))
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(gone))
    left = F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n")
    return df.withColumn("text", F.when(F.col(gone).isNull(), F.col("text")).otherwise(left)).drop(lines)
