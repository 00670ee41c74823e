"""Helpers that several operators share: scratch tables, table reading, words and hashes."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.cdr import bound_batches

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WORD_SEPARATOR = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``; a fresh temporary
    folder only where that is unset and everything runs on one machine, as in tests."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return f"{named}/tidelog-{spark.sparkContext.applicationId}"
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    if not hasattr(spark.sparkContext, "_tidelog_scratch"):
        spark.sparkContext._tidelog_scratch = tempfile.mkdtemp(prefix="tidelog-")
    return spark.sparkContext._tidelog_scratch


def stash(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back, which cuts the lineage and
    survives the loss of any executor. The compression is the session's: Zstandard would hold native
    memory for each open column of each writer and reader, beside the executor's heap."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    written = spark.read.schema(df.schema).parquet(path)
    written._scratch = path
    return written


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``stash`` gave, once all that is made of them is written."""
    for t in tables:
        path = t.sparkSession._jvm.org.apache.hadoop.fs.Path(t._scratch)
        path.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. For a text whose bytes are all ASCII, ``lower`` does just that."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, ASCII_UPPER, ASCII_UPPER.lower()))


def space_words(text: Column) -> Column:
    """The maximal runs of characters other than ASCII white space; an empty array for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_SEPARATOR), lambda w: w != "")


BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 << 20  # of strings, binaries and arrays


def hinted(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, read from a written table, with a broadcast hint if it has at most ``rows`` rows and
    BROADCAST_BYTES of values without a fixed size; else as it is, for a shuffled join. Counting
    stops at the limit of rows."""
    sizes = [F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)) for f in df.schema if f.dataType.typeName() in ("string", "binary")]
    sizes += [8 * F.greatest(F.size(F.col(f"`{f.name}`")), F.lit(0)) for f in df.schema if f.dataType.typeName() == "array"]
    wide = sum((s.cast("long") for s in sizes), F.lit(0).cast("long"))
    n, held = df.limit(rows + 1).agg(F.count(F.lit(1)), F.sum(wide)).first()
    return F.broadcast(df) if n <= rows and (held or 0) <= BROADCAST_BYTES else df


TEXT_ROWS, TEXT_BYTES = 250, 4 << 20


def bounded_batches(df: DataFrame) -> DataFrame:
    """``df``, after making sure that the Arrow batches of its texts that go to Python are bounded. The
    bounds are below those of messages: of a text come hundreds of tokens, in several arrays, and a
    worker keeps much of what its largest batch took while it waits for the next task."""
    bound_batches(df.sparkSession, TEXT_ROWS, TEXT_BYTES)
    return df
