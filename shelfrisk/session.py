"""What the operators need from the session: a checkpoint folder and size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Largest table, in estimated bytes, that may be sent whole to every executor.
BROADCAST_BYTES = 64 * 1024 * 1024
# Most rows one task may hold sorted for a single key.
TASK_ROWS = 1_000_000
# Up to this many rows, working a result out again is cheaper than storing it.
CHEAP_ROWS = 200_000

# Bytes of values that lists hold more tightly than rows.
_IN_LISTS = {T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.FloatType: 4, T.DateType: 4}
_STORED: list[str] = []
_SEEN: WeakKeyDictionary[DataFrame, dict] = WeakKeyDictionary()


def checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder; a temporary one is chosen only in local mode."""
    sc = spark.sparkContext
    folder = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="shelfrisk-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return folder


def materialise(df: DataFrame, **totals: Column) -> DataFrame:
    """Compute `df` once, keep it as a table in the checkpoint folder and forget how it was made.

    A lost executor loses nothing, and later plans see the true file size. Its rows and their bytes, and any
    `totals` asked for, are added up on the way: see `row_count`, `table_bytes` and `total_of`.
    """
    path = f"{checkpoint_dir(df.sparkSession)}/shelfrisk-{uuid.uuid4().hex}"
    _STORED.append(path)
    seen = Observation()
    watched = df.observe(seen, F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(long_bytes(df.schema)), F.lit(0)).alias("long_bytes"),
                         *[c.alias(n) for n, c in totals.items()])
    watched.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    _SEEN[table] = seen.get | {"path": path}
    return table


def release(spark: SparkSession) -> int:
    """Delete every table that `materialise` has stored in this process; returns how many. Results that still read
    from them must have been written or collected before."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    gone = len(_STORED)
    while _STORED:
        path = jvm.org.apache.hadoop.fs.Path(_STORED.pop())
        path.getFileSystem(conf).delete(path, True)
    return gone


def stored(df: DataFrame) -> DataFrame:
    """`df` itself if `materialise` made it, else its stored copy."""
    return df if df in _SEEN else materialise(df)


def row_count(df: DataFrame) -> int:
    """Number of rows; free for a table that `materialise` returned."""
    return _SEEN[df]["rows"] if df in _SEEN else df.count()


def stored_as(table: DataFrame, schema: T.StructType) -> DataFrame:
    """A table that `materialise` returned, read with another schema of the same files."""
    other = table.sparkSession.read.schema(schema).parquet(_SEEN[table]["path"])
    _SEEN[other] = _SEEN[table]
    return other


def total_of(table: DataFrame, name: str):
    """One of the `totals` given to `materialise`."""
    return _SEEN[table][name]


def row_bytes(schema: T.StructType) -> int:
    """Bytes of one row in memory without its texts, lists and maps."""
    return 24 + 8 * len(schema)


def long_bytes(schema: T.StructType) -> Column:
    """Bytes of a row's texts, lists and maps, measured."""
    total = F.lit(0).cast("long")
    for field in schema:
        size = _value_bytes(F.col("`" + field.name.replace("`", "``") + "`"), field.dataType)
        if size is not None:
            total = total + F.coalesce(size.cast("long"), F.lit(0))
    return total


def _value_bytes(value: Column, kind: T.DataType) -> Column | None:
    """Bytes of one value; None if all values of its type are equally wide."""
    if isinstance(kind, T.StringType | T.BinaryType):
        return F.octet_length(value) + 8
    if isinstance(kind, T.ArrayType):
        inner = _value_bytes(F.lit(None).cast(kind.elementType), kind.elementType)
        if inner is None:
            return F.size(value) * _IN_LISTS.get(type(kind.elementType), _flat_width(kind.elementType)) + 16
        return F.aggregate(value, F.lit(16).cast("long"), lambda total, x: total + 8 + F.coalesce(
            _value_bytes(x, kind.elementType).cast("long"), F.lit(0)))
    if isinstance(kind, T.MapType):
        keys = _value_bytes(F.map_keys(value), T.ArrayType(kind.keyType))
        return keys + _value_bytes(F.map_values(value), T.ArrayType(kind.valueType))
    if isinstance(kind, T.StructType):
        parts = [(f, _value_bytes(value.getField(f.name), f.dataType)) for f in kind]
        total = F.lit(_flat_width(kind))
        for _, size in parts:
            if size is not None:
                total = total + F.coalesce(size, F.lit(0))
        return total
    return None


def _flat_width(kind: T.DataType) -> int:
    return 16 + 8 * len(kind) if isinstance(kind, T.StructType) else 8


def table_bytes(df: DataFrame) -> int:
    """Bytes of all rows in memory, measured; free for a table that `materialise` returned, else one pass."""
    if df in _SEEN:
        rows, extra = _SEEN[df]["rows"], _SEEN[df]["long_bytes"]
    else:
        rows, extra = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(long_bytes(df.schema)), F.lit(0))).first()
    return rows * row_bytes(df.schema) + extra


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES, rows: int | None = None) -> DataFrame:
    """`df` with a broadcast hint if its measured bytes fit `max_bytes`, else `df` unchanged.

    Without the hint Spark shuffles both sides and splits skewed partitions at run time. Best given a materialised table;
    any other is read once more to measure it, unless an upper bound on its `rows` is known and all its columns
    are of fixed width.
    """
    return F.broadcast(df) if fits_broadcast(df, max_bytes, rows) else df


def fits_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES, rows: int | None = None) -> bool:
    fixed = all(_value_bytes(F.lit(None).cast(f.dataType), f.dataType) is None for f in df.schema)
    if rows is not None and fixed:
        return rows * row_bytes(df.schema) <= max_bytes
    return table_bytes(df) <= max_bytes


def attach(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join per-group values onto rows; a NULL key matches a NULL key, as in a group-by."""
    renamed = right.withColumnsRenamed({key: f"__{key}" for key in keys})
    match = None
    for key in keys:
        same = left[key].eqNullSafe(renamed[f"__{key}"])
        match = same if match is None else match & same
    return left.join(renamed, match, how).drop(*[f"__{key}" for key in keys])
