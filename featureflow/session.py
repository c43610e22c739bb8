"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "featureflow", **conf: str) -> SparkSession:
    """A session with adaptive execution and UTC; ``conf`` adds or overrides settings.

    Master, memory, shuffle partitions and the checkpoint folder are left to the cluster
    (``spark-submit`` / ``spark-defaults.conf``) unless given here.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


# A scan with this much input per core has splits enough.
CORE_BYTES = 32 * 1024 * 1024
# Smaller pieces than this cost more in task overhead than they save.
LEAST_BYTES = 1024 * 1024


def input_bytes(df: DataFrame) -> int:
    """Size of the files and tables ``df`` reads, from the optimizer's statistics."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Repartition a small input over the cores; a large one is left as it was read.

    A small file may hold a single row group, which one task would then work through alone. From
    ``CORE_BYTES`` per core on nothing is moved.
    """
    cores, size = df.sparkSession.sparkContext.defaultParallelism, input_bytes(df)
    if size >= cores * CORE_BYTES:
        return df
    return df.repartition(min(cores, size // LEAST_BYTES + 1), *keys)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    A temporary folder is made only for a local master with the setting absent (tests); on a
    cluster a machine-local folder would lose data, so the call fails there instead.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
            named = tempfile.mkdtemp(prefix="featureflow-")
        context.setCheckpointDir(named)
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing has written to yet."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def written_table(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and return the frame that reads it.

    Cuts the lineage: lost executors re-read files, they do not recompute joins. Unlike a
    checkpoint the files are columnar, so later readers prune columns and push filters.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Pieces of a training table, at least, unless the caller names another number.
TRAIN_PARTS = 8
# Rows of a piece, at most about so many: what one task of a fit reads does not grow with the table.
TRAIN_PIECE_ROWS = 200_000
# The same for rows that hold whole texts.
TEXT_PIECE_ROWS = 10_000


def pieces_for(rows: int, parts: int = TRAIN_PARTS, piece_rows: int | None = None) -> int:
    """Number of pieces for so many rows: ``parts``, or more where they would be larger than ``piece_rows``."""
    return max(parts, -(-rows // (piece_rows or TRAIN_PIECE_ROWS)))


def dealt(written: DataFrame, parts: int, *keys: str) -> DataFrame:
    """A written table in ``parts`` pieces hashed by ``keys``, each sorted by them."""
    return written.repartition(parts, *keys).sortWithinPartitions(*keys)


def training_table(
    df: DataFrame, label: str, *keys: str, parts: int = TRAIN_PARTS, piece_rows: int | None = None, scratch: Scratch | None = None
) -> DataFrame:
    """Write ``df`` and read it in pieces hashed by ``keys``, each sorted by them: ``pieces_for`` says how many.

    Bagging and random starts depend on which rows share a partition and in which order; here that follows
    from the rows, ``parts`` and ``piece_rows`` alone, not from cores, file sizes or the shuffle setting. ``keys``
    should tell rows apart; rows equal in all of them may swap places.
    """
    written = (scratch.write if scratch else written_table)(df, label)
    # The rows are known from the files' footers.
    return dealt(written, pieces_for(written.count(), parts, piece_rows), *keys)


class Scratch:
    """Written intermediate tables with an owner: leaving the ``with`` block removes them.

    A frame that is returned out of the block may read only tables written with ``keep=True``;
    those stay until the application's shared folder is cleared.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self._paths: list[str] = []

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_: object) -> None:
        for path in self._paths:
            _remove(self.spark, path)
        self._paths.clear()

    def write(self, df: DataFrame, label: str, keep: bool = False) -> DataFrame:
        """``written_table`` under this owner."""
        path = scratch_path(self.spark, label)
        if not keep:
            self._paths.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def _remove(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
