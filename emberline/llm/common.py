"""What several operators of this subpackage share: the shared work folder, lineage cuts, global row numbers."""

from __future__ import annotations

import atexit
import tempfile
import uuid

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of all contracts here: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
#: Numbers that are sent to all tasks at most (8 MB).
FEW = 1 << 20
#: Stands for a null id where ids are compared; sorts before every other.
NO_ID = -(2**63)


def shared_folder(spark: SparkSession) -> str:
    """A folder of this application below ``spark.checkpoint.dir``, which all executors share.

    Where the setting is missing (tests, one machine) a temporary folder takes its place; on a cluster that is an error.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        held = sc._jsc.sc().getCheckpointDir()
        base = held.get() if held.isDefined() else None
    if not base:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-work-")
        sc.setCheckpointDir(base)
    return f"{base.rstrip('/')}/emberline-{sc.applicationId}"


def _delete(spark: SparkSession, path: str) -> None:
    try:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # the session may be gone at exit; the shared folder is scratch space
        pass


_swept: set[str] = set()


def table(df: DataFrame) -> DataFrame:
    """Cuts the lineage: writes ``df`` as Parquet to the shared folder and reads it back. Survives lost executors.

    The folder goes when the application ends.
    """
    spark = df.sparkSession
    top = shared_folder(spark)
    if top not in _swept:
        _swept.add(top)
        atexit.register(_delete, spark, top)
    path = f"{top}/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_table(df: DataFrame) -> None:
    """Deletes what :func:`table` wrote, once nothing reads it any more."""
    for file in df.inputFiles()[:1]:
        _delete(df.sparkSession, file.rsplit("/", 1)[0])


def id_key(column: str) -> Column:
    return F.coalesce(F.col(column).cast("long"), F.lit(NO_ID))


def null_if_no_id(column: Column) -> Column:
    return F.when(column != NO_ID, column)


def numbered(docs: DataFrame) -> DataFrame:
    """(row, doc): the rows of ``docs`` as structs, each with a number of its own, written once so that the numbers stay.

    Inside the struct the columns can't clash with an operator's own, whatever their names; ``select("doc.*")`` brings them back.
    """
    return table(docs.select(F.monotonically_increasing_id().alias("row"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc")))


def without_rows(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """The ``rows`` whose number ``row`` isn't in ``gone``. Up to FEW numbers are sent to all tasks, so that rows aren't shuffled; more are joined by sorting."""
    gone = table(gone.select("row"))
    few = gone.count() <= FEW
    return rows.join(F.broadcast(gone) if few else gone.hint("merge"), "row", "left_anti")


def splittable(key: str) -> Column:
    """A second grouping key that is always 0.

    An aggregate by (key, this) isn't partitioned by key alone, so a later join by key plans exchanges of its own on
    both sides, and adaptive execution can split the partitions of hot keys there.
    """
    return F.pmod(F.hash(key), F.lit(1)).alias("_one")


def running_totals(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """Adds ``before`` (sum of ``value`` over all rows before this one in the order of ``by``) and ``row_index``, both over the whole frame.

    ``by`` must order the rows totally. Rows are range-partitioned and sorted, each partition sums up its own rows, and
    the partitions' totals (one row a partition) are added afterwards. ``value`` holds no nulls. Returns a cut frame.
    """
    spark = df.sparkSession
    names = df.columns

    def sums(batches):
        part, total, count = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            v = batch.column(names.index(value)).to_numpy(zero_copy_only=False).astype("int64")
            c = v.cumsum()
            n = len(v)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(total + c - v), pa.array(range(count, count + n), pa.int64()), pa.array([part] * n, pa.int32())],
                names=[*names, "before", "row_index", "_part"],
            )
            if n:
                total += int(c[-1])
            count += n

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + ", before long, row_index long, _part int"
    local = table(df.repartitionByRange(*by).sortWithinPartitions(*by).mapInArrow(sums, schema))
    per_part = local.groupBy("_part").agg(F.count("*").alias("n"), F.sum(value).alias("v")).toPandas().sort_values("_part")
    per_part["_rows_before"] = per_part["n"].cumsum() - per_part["n"]
    per_part["_sum_before"] = per_part["v"].cumsum() - per_part["v"]
    offsets = spark.createDataFrame(
        per_part[["_part", "_rows_before", "_sum_before"]] if len(per_part) else pd.DataFrame({"_part": [], "_rows_before": [], "_sum_before": []}),
        "_part int, _rows_before long, _sum_before long",
    )
    return (
        local.join(F.broadcast(offsets), "_part")  # as many rows as partitions
        .withColumns({"before": F.col("before") + F.col("_sum_before"), "row_index": F.col("row_index") + F.col("_rows_before")})
        .drop("_part", "_rows_before", "_sum_before")
    )
