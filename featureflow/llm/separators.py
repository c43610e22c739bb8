"""Token counts of documents in flat token files without an index.

A file is a run of 16-bit token ids in which every document ends with a separator id; nothing says where.
Files are cut into blocks of fixed size that are searched in parallel with one vector comparison each. A
block's first document may have begun in an earlier block: a prefix scan over the blocks' counts and
last separators (one row a block) numbers the documents and gives the first one its start.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from featureflow.llm.tokens import tokenizer
from featureflow.llm.words import runs
from featureflow.session import scratch_path

BLOCK_TOKENS = 1 << 21
SEPARATOR = 49_407
# Stands for the separator's own id inside a text; the vocabulary ends below it.
QUOTED = 0xFFFF
WIDTH = 2


def _opened(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:///") else "file://" + uri.removeprefix("file:"))


def write_token_files(docs: DataFrame, folder: str, path: str, separator: int = SEPARATOR, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write each partition's documents as one flat file in ``folder``; lazily returns (file, ordinal, doc_id).

    ``folder`` must be reachable by all executors. A file takes its name from the partition and its place by a
    rename, so that an attempt after a lost executor replaces the earlier one. A null text has no tokens. The
    separator's id inside a text is written as ``QUOTED``, so that it is counted and cuts nothing; a token whose own
    id does not fit below ``QUOTED`` raises.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, coder = TaskContext.get(), tokenizer(path)
        fs, at = _opened(folder)
        name = f"tokens-{context.partitionId():06d}.bin"
        part = f"{at}/.{name}.{context.taskAttemptId()}"
        fs.create_dir(at, recursive=True)
        end, ordinal = np.array([separator], dtype="<u2").tobytes(), 0
        with fs.open_output_stream(part) as out:
            for batch in batches:
                for run in runs(batch, text):
                    for t in run.column(1).to_pylist():
                        ids = np.frombuffer(coder.encode(t), dtype="<u4")
                        if len(ids) and ids.max() >= QUOTED:
                            raise ValueError(f"token ids must be below {QUOTED}")
                        out.write(np.where(ids == separator, QUOTED, ids).astype("<u2").tobytes() + end)
                    places = pa.array(np.arange(ordinal, ordinal + run.num_rows))
                    ordinal += run.num_rows
                    yield pa.RecordBatch.from_arrays([pa.array([name] * run.num_rows), places, run.column(0)], names=["file", "ordinal", "doc_id"])
        fs.move(part, f"{at}/{name}")

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(write, f"file string, ordinal bigint, doc_id {kind}")


def token_files(spark: SparkSession, folder: str) -> DataFrame:
    """(file, uri, bytes) of the flat files in ``folder``; their content is not read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.bin").load(folder)
    return found.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("file"), F.col("path").alias("uri"), F.col("length").alias("bytes"))


def _scan(separator: int):
    """Blocks -> (file, block, ends: places of separators in the file, in tokens)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                fs, at = _opened(row["uri"])
                with fs.open_input_file(at) as source:
                    source.seek(row["first"] * WIDTH)
                    data = np.frombuffer(source.read(row["tokens"] * WIDTH), dtype="<u2")
                ends = np.flatnonzero(data == separator) + row["first"]
                lists = pa.array([ends], type=pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array([row["file"]]), pa.array([row["block"]], type=pa.int64()), lists], names=["file", "block", "ends"])

    return scan


def count_tokens(files: DataFrame, separator: int = SEPARATOR, block: int = BLOCK_TOKENS) -> DataFrame:
    """(file, ordinal, start, n_tokens) per document of ``files`` (file, uri, bytes), separators not counted.

    Defined results: an empty file has no document; what follows the last separator of a file is a document
    if it has tokens; a document may span any number of blocks; a file whose size is not whole tokens is an
    error.
    """
    tokens = F.when(F.col("bytes") % WIDTH != 0, F.raise_error(F.lit("a token file holds part of a token"))).otherwise(F.expr(f"bytes div {WIDTH}"))
    sized = files.select("file", "uri", tokens.cast("bigint").alias("size")).where("size > 0")
    blocks = sized.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(size - 1) div {block}L"))))
    blocks = blocks.withColumn("first", F.col("block") * block).withColumn("tokens", F.least(F.lit(block), F.col("size") - F.col("first")))
    # Blocks, not files, are the unit of work: spread them before reading.
    spread = blocks.select("file", "uri", "block", "first", "tokens").repartition(F.xxhash64("file", "block"))
    found = spread.mapInArrow(_scan(separator), "file string, block bigint, ends array<bigint>")

    before = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    stitched = found.select(
        "file",
        "ends",
        F.coalesce(F.sum(F.size("ends")).over(before), F.lit(0)).alias("earlier"),
        F.coalesce(F.max(F.array_max("ends")).over(before), F.lit(-1)).alias("last"),
    )
    each = stitched.select("file", "ends", "earlier", "last", F.posexplode("ends").alias("at", "end"))
    start = F.when(F.col("at") == 0, F.col("last")).otherwise(F.get("ends", F.col("at") - 1)) + 1
    documents = each.select("file", (F.col("earlier") + F.col("at")).cast("bigint").alias("ordinal"), start.alias("start"), (F.col("end") - start).alias("n_tokens"))
    ends = found.groupBy("file").agg(F.max(F.array_max("ends")).alias("last"), F.sum(F.size("ends")).alias("n"))
    rest = sized.join(ends, "file").withColumn("start", F.coalesce(F.col("last"), F.lit(-1)) + 1).where("size > start")
    tail = rest.select("file", F.col("n").cast("bigint").alias("ordinal"), F.col("start").cast("bigint").alias("start"), (F.col("size") - F.col("start")).alias("n_tokens"))
    return documents.unionByName(tail)


def document_tokens(docs: DataFrame, path: str, separator: int = SEPARATOR, block: int = BLOCK_TOKENS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens) per row of ``docs``: written as flat files, then counted from the files alone.

    Defined result: all tokens of the text count, the separator's own id too where a text quotes it.
    """
    spark = docs.sparkSession
    folder = scratch_path(spark, "tokens")
    listed = scratch_path(spark, "listed")
    write_token_files(docs, folder, path, separator, key, text).write.parquet(listed)
    names = spark.read.parquet(listed)
    counted = count_tokens(token_files(spark, folder), separator, block)
    return names.join(counted, ["file", "ordinal"]).select("doc_id", "n_tokens")
