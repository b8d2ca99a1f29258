"""Small helpers of the operators: reading, checkpoints, Arrow batches, hash splits."""

from __future__ import annotations

import tempfile
from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ARROW_BYTES, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "4m"


def small_batches(spark: SparkSession) -> None:
    """Let Spark hand rows to Python in Arrow batches of about 4 MB, unless the session has a limit of its own.

    Of long texts the usual batch is tens of megabytes, which the JVM holds outside its heap and the Python worker once more.
    Narrow rows still come by the usual number. Results are lazy and run later, so the setting stays; it changes no result.
    """
    if spark.conf.get(ARROW_BYTES, None) is None:
        spark.conf.set(ARROW_BYTES, BATCH_BYTES)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def column_of(df: DataFrame, name: str, kind: str) -> Column:
    """The column as the type that an operator works on; unlike a bare name it never touches other columns."""
    return df[f"`{name}`"].cast(kind)


def kept(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder: it survives lost executors and cuts the lineage.

    The folder is the one in ``spark.checkpoint.dir``. Only a local master may
    go without that setting; it then gets a temporary folder of its own.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="netvigil-llm-"))
    return df.checkpoint()


def batches_of(groups: Iterable[Iterable[tuple]], schema) -> Iterator:
    """Arrow batches of the tuples of each group. ``schema``: "name type, ..." in Arrow's simple types."""
    import pyarrow as pa

    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "double": pa.float64(),
             "boolean": pa.bool_(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()),
             "array<double>": pa.list_(pa.float64()), "array<string>": pa.list_(pa.string())}
    fields = [part.strip().split(" ") for part in schema.split(",")]
    arrow = pa.schema([(name, kinds[kind]) for name, kind in fields])
    for group in groups:
        rows = list(group)
        if rows:
            columns = [pa.array(column, field.type) for column, field in zip(zip(*rows), arrow)]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)


def text_blocks(batch, column: int, most_bytes: int) -> Iterator:
    """Consecutive slices of an Arrow batch whose texts have about ``most_bytes`` together; a longer text is one by itself."""
    import numpy as np
    import pyarrow.compute as pc

    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        before = int(sizes[at - 1]) if at else 0
        upto = max(at + 1, int(np.searchsorted(sizes, before + most_bytes, "right")))
        yield batch.slice(at, upto - at)
        at = upto


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves ``remainder``; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % modulus == remainder, F.lit(False))
