"""Token counts of documents in flat, unindexed token files, by a separator scan.

A file is a bare sequence of little-endian token ids; an end-of-document id closes each document. Blocks of a file are
searched for that id with one vector comparison each, in any order and on any executor. A prefix scan over the blocks'
summaries (separators so far, last separator so far) stitches documents that cross blocks: its result tells each block
the number of its first document and where that began. The scan has two levels, so that a huge file is no single task.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import new_path, small_batches, stored, table

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the public word pattern of this byte-level vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
END = 50256
BLOCK_TOKENS, BLOCKS_A_GROUP = 1 << 19, 512


def write_token_files(docs: DataFrame, folder: str, vocabulary: str = VOCABULARY, end: int = END, width: str = "<u2") -> DataFrame:
    """Write the texts' tokens to flat files in a shared folder, one file a task, each document closed by `end`.

    Returns the stored list (doc_id, file, place). Only files in the list count: those of failed tasks are not in it.
    A null text has no tokens; repeated rows are written again. The vocabulary is a local file of the driver, of a
    fixed size, and goes to the executors as it is."""
    with open(vocabulary, "rb") as f:
        held = docs.sparkSession.sparkContext.broadcast(f.read())
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, held.value.splitlines())}
        coder = tiktoken.Encoding("flat", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        fs, path = pyarrow.fs.FileSystem.from_uri(folder)
        fs.create_dir(path, recursive=True)
        name, out, place = f"{uuid.uuid4().hex}.bin", None, 0
        for b in batches:
            if out is None:
                out = fs.open_output_stream(f"{path}/{name}")
            for text in b.column(1):
                ids = coder.encode_ordinary(text.as_py() or "")
                ids.append(end)
                out.write(np.array(ids, dtype=width).tobytes())
            n = b.num_rows
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([name] * n, pa.string()), pa.array(range(place, place + n), pa.int64())], names=["doc_id", "file", "place"])
            place += n
        if out is not None:
            out.close()

    return stored(small_batches(docs).select("doc_id", F.col("text").cast("string")).mapInArrow(run, f"doc_id {kind}, file string, place long"), "token-list")


def token_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, length in bytes) of the files in a folder; their content is not read."""
    return spark.read.format("binaryFile").load(folder).select("path", "length")


def count_tokens(files: DataFrame, end: int = END, width: str = "<u2", block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(path, length) of flat token files to (path, place, n_tokens, closed), one row for each document in file order.

    Tokens after the last separator are a document of their own with closed false. An empty file has no document; two
    separators in a row enclose a document of no tokens. A length that is no multiple of the width loses the odd bytes."""
    size = np.dtype(width).itemsize
    blocks = files.filter(F.col("length") >= size).select("path", F.floor(F.col("length") / size).alias("tokens"))
    blocks = blocks.withColumn("block", F.explode(F.sequence(F.lit(0), F.floor((F.col("tokens") - 1) / block_tokens)))).repartition(F.col("path"), F.col("block"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            marks = []
            for path, tokens, block in zip(*(b.column(i).to_pylist() for i in range(3))):
                fs, name = pyarrow.fs.FileSystem.from_uri(path if "://" in path else path.replace(":/", ":///", 1))
                first = block * block_tokens
                with fs.open_input_file(name) as f:
                    f.seek(first * size)
                    ids = np.frombuffer(f.read(min(block_tokens, tokens - first) * size), dtype=width)
                marks.append(first + np.flatnonzero(ids == end))
            ends = np.cumsum([0, *map(len, marks)])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(marks), pa.int64()))], names=["path", "tokens", "block", "marks"])

    found = stored(blocks.mapInArrow(run, "path string, tokens long, block long, marks array<long>"), "separators")
    short = found.select("path", "block", F.floor(F.col("block") / BLOCKS_A_GROUP).alias("g"), F.size("marks").cast("long").alias("n"), F.array_max("marks").alias("last"))
    groups = short.groupBy("path", "g").agg(F.sum("n").alias("n"), F.max("last").alias("last"))

    def before(order: str, *part: str):
        return W.partitionBy(*part).orderBy(order).rowsBetween(W.unboundedPreceding, -1)

    groups = groups.select("path", "g", F.sum("n").over(before("g", "path")).alias("gn"), F.max("last").over(before("g", "path")).alias("gl"))
    scan = short.withColumn("bn", F.sum("n").over(before("block", "path", "g"))).withColumn("bl", F.max("last").over(before("block", "path", "g"))).join(groups, ["path", "g"])
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    carry = scan.select("path", "block", (zero("gn") + zero("bn")).alias("place"), F.coalesce("bl", "gl", F.lit(-1)).alias("prior"))
    rows = found.join(carry, ["path", "block"])
    ends = F.array_append("marks", F.col("tokens"))
    open_ = (F.col("block") == F.floor((F.col("tokens") - 1) / block_tokens)) & (F.coalesce(F.array_max("marks"), F.col("prior")) < F.col("tokens") - 1)
    spots = F.when(open_, ends).otherwise(F.col("marks"))
    starts = F.concat(F.array("prior"), F.col("marks"))
    each = rows.select("path", "place", "tokens", F.posexplode(F.zip_with(spots, F.slice(starts, F.lit(1), F.size(spots)), lambda e, s: F.struct(e.alias("e"), (e - s - 1).alias("n")))).alias("i", "d"))
    return each.select("path", (F.col("place") + F.col("i")).alias("place"), F.col("d.n").alias("n_tokens"), (F.col("d.e") < F.col("tokens")).alias("closed"))


def op3_token_counts(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    folder = new_path(spark, "tokens")
    listed = write_token_files(docs, folder)
    counts = count_tokens(token_files(spark, folder)).withColumn("file", F.element_at(F.split("path", "/"), -1))
    return listed.join(counts, ["file", "place"]).select("doc_id", "n_tokens")
