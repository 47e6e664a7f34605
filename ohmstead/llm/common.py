"""Shared folder, written tables and checked lookups for the operators of this package."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A word is a longest run of characters that are neither a space nor one of \x09-\x0D.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"

_local: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a local session without it gets one of its own."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return _local.setdefault("dir", tempfile.mkdtemp(prefix="ohmstead-shared-"))


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written once as Parquet in the shared folder, and read from there.

    Used where a costly result is read twice; the files survive lost executors.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(*tables: DataFrame) -> None:
    """Removes tables of ``stored`` whose every reader has been written itself; nothing may read them afterwards."""
    for df in tables:
        jvm = df.sparkSession._jvm
        for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def lookup(df: DataFrame, most_rows: int = 20_000, most_bytes: int = 4 << 20) -> DataFrame:
    """A written per-key table for the small side of a join.

    It is broadcast only if both its rows and the bytes of its strings are seen to stay within the
    bounds; otherwise Spark shuffles both sides and splits skewed keys.
    """
    texts = (T.StringType, T.BinaryType)
    width = sum((F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)) if isinstance(f.dataType, texts) else F.lit(16) for f in df.schema), F.lit(0))
    n, size = df.agg(F.count("*"), F.coalesce(F.sum(width), F.lit(0))).first()
    return F.broadcast(df) if n <= most_rows and size <= most_bytes else df


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def unit_hash(*parts: Column) -> Column:
    """A number in [0, 1) from the md5 of the parts, the same on every run and in other engines."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 13), 16, 10).cast("double") / float(16**13)


def split_words(text: str) -> list[bytes]:
    """The words of a text, by ``WORD``; without arguments, bytes split at just these blanks."""
    return text.encode().split()
