"""Shared helpers of the training-data operators: word rule, row keys, shared scratch tables."""

from __future__ import annotations

import atexit
import os
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but space and the five ASCII control spaces; bytes.split() follows the same rule.
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words of a text, 0 for null. Each word shrinks to its first character, so no array of words is made."""
    first = r"[\x20\x09-\x0D]+|([^\x20\x09-\x0D])[^\x20\x09-\x0D]*[\x20\x09-\x0D]*"
    return F.coalesce(F.length(F.regexp_replace(text, first, "$1")), F.lit(0)).cast("long")


def shared_dir(spark: SparkSession) -> str:
    """Folder that the driver and all executors see: spark.checkpoint.dir.

    Where it is unset, a temporary folder serves if driver and executors are one process; on a cluster that is an error,
    since an executor's own disk is not seen by the others and goes with it."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise RuntimeError(f"spark.checkpoint.dir is unset; on {master} it must name a folder that the driver and all executors share")
    return "file://" + os.path.join(tempfile.gettempdir(), "checkpoints", "maskwright")


_swept: set[str] = set()


def _sweep(conf, jvm, root: str) -> None:
    path = jvm.org.apache.hadoop.fs.Path(root)
    path.getFileSystem(conf).delete(path, True)


def new_path(spark: SparkSession, name: str) -> str:
    """A new name in this application's scratch folder, which goes when the driver's Python ends."""
    root = f"{shared_dir(spark)}/maskwright-{spark.sparkContext.applicationId}"
    if root not in _swept:
        _swept.add(root)
        atexit.register(_sweep, spark._jsc.hadoopConfiguration(), spark._jvm, root)
    return f"{root}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df as a Parquet table in the shared folder and read it back.

    This cuts the lineage and survives the loss of executors."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of a few numbers that a file of a scratch table should hold at least.
NARROW_ROWS = 65536


def few_files(df: DataFrame, rows: int) -> DataFrame:
    """df, of at most `rows` narrow rows, in no more partitions than these fill, but two a core; fewer partitions stay.

    A file costs more than such rows: on a local disk the executor's JVM starts a process for each mode that it sets.
    Not for a result in which the rows of one key may stand in a row, such as a join that Spark may split."""
    return df.coalesce(max(2 * df.sparkSession.sparkContext.defaultParallelism, -(-rows // NARROW_ROWS)))


def dropped(df: DataFrame) -> None:
    """Delete the scratch files behind a table made by stored() that nothing reads any more."""
    spark = df.sparkSession
    root = shared_dir(spark).split(":", 1)[-1].lstrip("/")
    jvm = spark._jvm
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if root in folder:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: Texts cross to Python in batches of about this many bytes, whatever their number.
BATCH_BYTES, BATCH_ROWS = 8 << 20, 2000


def small_batches(df: DataFrame) -> DataFrame:
    """df, with the session's Arrow batches bounded for long texts; smaller settings of the session stay."""
    conf = df.sparkSession.conf
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        now = conf.get(key, None)
        digits = "".join(c for c in now or "" if c.isdigit())
        if not digits or not now.isdigit() or not 0 < int(now) <= most:
            conf.set(key, str(most))
    return df


def row_key(*cols: str) -> Column:
    """128-bit key (MD5, hexadecimal) of a row's content; equal rows share it. Nulls differ from empty texts."""
    parts = []
    for c in cols:
        value = F.col(c).cast("string")
        parts.append(F.when(value.isNull(), "n").otherwise(F.concat(F.length(value).cast("string"), F.lit(":"), value)))
    return F.md5(F.concat(*parts))


_learnt: dict[str, Callable[[], None]] = {}


def begins(owner: str, forget: Callable[[], None] | None = None) -> None:
    """Called in a Python worker as a task of `owner` begins: what other operators have learnt there goes.

    Workers outlive tasks, so that words and chunks are looked up once; without this they would outlive the operator too,
    beside all that the next ones learn. forget: empties the owner's own tables."""
    for other in [k for k in _learnt if k != owner]:
        _learnt.pop(other)()
    if forget:
        _learnt[owner] = forget


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def per_text(df: DataFrame, keep: list[str], columns: dict[str, tuple[str, pa.DataType]], work: Callable[[list], list]) -> DataFrame:
    """Columns `keep` of df untouched, and what work(texts) returns: one list for each of `columns` (Spark and Arrow types).

    Texts come as str or None. Values cross as Arrow, so long keys beside nulls keep all their digits."""
    fields = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    schema = ", ".join([f"`{k}` {fields[k]}" for k in keep] + [f"`{k}` {t}" for k, (t, _) in columns.items()])
    kinds = [t for _, t in columns.values()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begins(work.__qualname__)
        for b in batches:
            made = work(b.column(len(keep)).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(i) for i in range(len(keep))] + [x if isinstance(x, pa.Array) else pa.array(x, t) for x, t in zip(made, kinds)], names=[*keep, *columns])

    return small_batches(df).select(*keep, F.col("text").cast("string").alias("_text")).mapInArrow(run, schema)
