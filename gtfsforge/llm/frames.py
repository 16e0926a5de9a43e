"""Helpers shared by the corpus operators: shared folders, stored tables and
column-appending Arrow maps."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: Rows handed to a Python helper at once, and the text bytes after which a slice is closed earlier.
SLICE_ROWS = 512
SLICE_BYTES = 8 << 20

#: ASCII white space between words: exactly what ``bytes.split()`` splits on.
WORD = r"[^\x20\x09-\x0D]+"


def ensure_importable(spark: SparkSession) -> None:
    """Let Python workers import this package when only the driver's path names it.
    On a cluster the package is shipped with the job (``--py-files``)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    have = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in have:
        env["PYTHONPATH"] = os.pathsep.join([root, *[p for p in have if p]])


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: the session's checkpoint folder.

    Only a local session without that setting gets a scratch folder of its own;
    any other session without it is an error.
    """
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        path = sc.getConf().get("spark.checkpoint.dir", None)
        if not path:
            if not sc.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            path = tempfile.mkdtemp(prefix="corpus-")
        sc.setCheckpointDir(path)
    return sc.getCheckpointDir().rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder once and read it back (cuts the lineage;
    survives the loss of any executor)."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(batch: pa.RecordBatch, text: str | None = None) -> Iterator[pa.RecordBatch]:
    """Row slices of a batch, each of at most SLICE_ROWS rows and, in the column
    ``text``, about SLICE_BYTES bytes (one row at least)."""
    n, start = batch.num_rows, 0
    sizes = None
    if text is not None:
        import pyarrow.compute as pc

        sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text))), 0).to_numpy(zero_copy_only=False)
    while start < n:
        end = min(n, start + SLICE_ROWS)
        if sizes is not None:
            total, k = 0, start
            while k < end and (k == start or total + sizes[k] <= SLICE_BYTES):
                total += int(sizes[k])
                k += 1
            end = k
        yield batch.slice(start, end - start)
        start = end


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    """The column of that name, whatever the case of its letters (as Spark resolves names)."""
    i = batch.schema.get_field_index(name)
    if i < 0:
        i = next(k for k, x in enumerate(batch.schema.names) if x.lower() == name.lower())
    return batch.column(i)


def append_columns(df: DataFrame, fields: Sequence[T.StructField], text: str,
                   make: Callable[[], Callable[[list], dict[str, Iterable]]]) -> DataFrame:
    """``df`` with further columns computed from the column ``text``.

    ``make()`` runs once per task and returns a function from a list of whole
    texts (null: the empty text) to one list or array per field.  Input columns
    that bear the name of a new column are replaced, also the text itself.
    """
    ensure_importable(df.sparkSession)
    taken = {f.name.lower() for f in fields}
    keep = [c for c in df.columns if c.lower() not in taken or c.lower() == text.lower()]
    base = df.select(*[f"`{c}`" for c in keep])
    stay = [f for f in base.schema.fields if f.name.lower() not in taken]
    schema = T.StructType([*stay, *fields])
    names = [f.name for f in stay]
    types = {f.name: _arrow(f.dataType) for f in fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for part in slices(batch, next(x for x in batch.schema.names if x.lower() == text.lower())):
                made = work([t or "" for t in column(part, text).to_pylist()])
                arrays = [pa.array(made[name], type=kind) for name, kind in types.items()]
                yield pa.RecordBatch.from_arrays([*[part.column(part.schema.get_field_index(n)) for n in names], *arrays], names=[*names, *types])

    return base.mapInArrow(run, schema)


def _arrow(kind: T.DataType) -> pa.DataType:
    simple = {T.LongType: pa.int64(), T.IntegerType: pa.int32(), T.DoubleType: pa.float64(), T.BooleanType: pa.bool_(),
              T.StringType: pa.string(), T.BinaryType: pa.binary()}
    if isinstance(kind, T.ArrayType):
        return pa.list_(_arrow(kind.elementType))
    return simple[type(kind)]
