"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import atexit
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

#: Python-side work is done on slices of an Arrow batch of at most this many bytes of text.
SLICE_BYTES = 1 << 20
#: Size of the Arrow batches between Spark and its Python workers, where the session sets none.
BATCH_BYTES = 4 << 20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def column_index(df: DataFrame, name: str) -> int:
    """Position of a column: the exact spelling wins over one that differs in case."""
    if name in df.columns:
        return df.columns.index(name)
    near = [i for i, c in enumerate(df.columns) if c.lower() == name.lower()]
    if len(near) != 1:
        raise ValueError(f"column {name!r} not found once in {df.columns}")
    return near[0]


def pick(df: DataFrame, **cols: str) -> DataFrame:
    """``pick(df, out=source)``: only these columns, found by position, so that other columns
    may have clashing names (another case, or a name the operator uses itself)."""
    at = {out: column_index(df, name) for out, name in cols.items()}
    flat = df.toDF(*[f"_c{i}" for i in range(len(df.columns))])
    return flat.select(*[F.col(f"_c{i}").alias(out) for out, i in at.items()])


def slices(batch: pa.RecordBatch, text: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut a batch so that no slice has more than SLICE_BYTES of text, one row at least."""
    col = batch.column(batch.schema.get_field_index(text))
    sizes = pc.fill_null(pc.binary_length(col), 0).to_pylist()
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > SLICE_BYTES:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield batch.slice(start)


def spread(first: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of ranges that begin at first and have n numbers, one range after the other."""
    n = n.astype(np.int64)
    return np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum()), n


def bound_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small, as each is held several times: by Spark on its way out and in, by the
    Python worker, and as Python objects there. A single large row is a batch of its own."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(BATCH_BYTES))


def arrow_map(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str | StructType, text: str = "text") -> DataFrame:
    """mapInArrow with a function of one bounded slice; the column ``text`` bounds the slices."""
    bound_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                yield fn(part)
        relieve()

    return df.mapInArrow(run, schema)


def map_rows(df: DataFrame, text_col: str, fn: Callable[[pa.Array], tuple[pa.Array, pa.Array]]) -> DataFrame:
    """The rows of df with all their columns, whatever their names: ``fn`` takes the texts of a bounded
    slice and gives the texts to put in their place and which rows stay. One Python pass for each row."""
    names = [f"_c{i}" for i in range(len(df.columns))]
    at = column_index(df, text_col)
    flat = df.toDF(*names)

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        texts, keep = fn(part.column(at))
        columns = [texts if i == at else part.column(i) for i in range(part.num_columns)]
        return pa.RecordBatch.from_arrays(columns, names=names).filter(keep)

    open_ = StructType([StructField(f.name, f.dataType) for f in flat.schema.fields])
    return arrow_map(flat, run, open_, f"_c{at}").toDF(*df.columns)


#: What this Python worker has built for the operator it last worked for: by slot, a key and the thing.
_BUILT: dict[str, tuple] = {}


def built(slot: str, key: object, make: Callable[[], object]):
    """make(), remembered in this worker, one thing for each slot ("operator" or "operator.part"), until
    another operator is worked for: workers outlive stages, and what a former stage has built must not
    stay in memory beside the next one's."""
    operator = slot.partition(".")[0]
    if any(s.partition(".")[0] != operator for s in _BUILT):
        _BUILT.clear()
    if slot not in _BUILT or _BUILT[slot][0] != key:
        _BUILT.pop(slot, None)
        _BUILT[slot] = key, make()
    return _BUILT[slot][1]


def relieve() -> None:
    """Give free memory back to the machine at the end of a partition, where the allocators can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not every C library has it
        pass


def shared_dir(spark: SparkSession) -> str:
    """A new folder below the shared one that the session names in spark.checkpoint.dir; one of
    this machine only where that is unset (local runs)."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = _local_root()
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    return f"{root.rstrip('/')}/tidewell-{uuid.uuid4().hex}"


_ROOT: list[str] = []


def _local_root() -> str:
    if not _ROOT:
        _ROOT.append("file://" + tempfile.mkdtemp(prefix="tidewell-"))
    return _ROOT[0]


def stored(df: DataFrame) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: this cuts the lineage and
    survives lost executors. The table is removed when the driver ends."""
    spark = df.sparkSession
    path = shared_dir(spark)
    df.write.parquet(path)
    _KEPT.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


_KEPT: list[tuple[SparkSession, str]] = []


def drop_stored(since: int = 0) -> None:
    """Remove the tables that stored() wrote, from the given position on."""
    while len(_KEPT) > since:
        spark, path = _KEPT.pop()
        try:
            jvm = spark.sparkContext._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # noqa: BLE001  the session may have ended
            pass


atexit.register(drop_stored)


def sha256_hex(col: Column) -> Column:
    return F.sha2(col, 256)
