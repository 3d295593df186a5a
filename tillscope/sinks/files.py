"""Result files."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillscope.session import shared_folder

FORMATS = ("csv", "parquet")
MODES = ("overwrite", "append", "error", "ignore")

# Fixed value: what Hadoop's file systems call being able to join files without copying them.
CONCAT = "fs.capability.paths.concat"


def save_results(
    df: DataFrame,
    output_path: str,
    format: str = "csv",
    mode: str = "overwrite",
    *,
    single_file: bool = False,
    bounded: bool = False,
) -> None:
    """Write ``df`` below ``output_path`` as CSV with header, or Parquet.

    A sorted result comes out as part files in that order. Adaptive execution merges small
    partitions, so a small result is a single file anyway; ``single_file`` forces one. One task
    then makes and writes a ``bounded`` result. Any other is made by all tasks, and as CSV joined
    by :func:`write_one_csv`; a single Parquet file must be of bounded size.
    """
    if format not in FORMATS:
        raise ValueError(f"unsupported format {format!r}; supported: {', '.join(FORMATS)}")
    if mode not in MODES:
        raise ValueError(f"unsupported mode {mode!r}; supported: {', '.join(MODES)}")
    if single_file and format == "csv" and not bounded:
        write_one_csv(df, output_path, mode)
        return
    writer = (df.coalesce(1) if single_file else df).write.mode(mode)
    if format == "csv":
        writer.option("header", True).csv(output_path)
    else:
        writer.parquet(output_path)


def _file_system(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())


def write_one_csv(df: DataFrame, output_path: str, mode: str = "overwrite") -> None:
    """Write ``df`` as one CSV file with one header, whatever its size, in the order it has.

    Where the file system can join files, tasks write part files beside the output and their blocks
    become one file; no byte is copied. Elsewhere the rows are written as a table in the shared folder,
    numbered in order, and one task streams them from there, in bounded memory. Either way the
    output is touched only when all rows are made, so a result that fails leaves the old file.
    """
    spark = df.sparkSession
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    files = _file_system(spark, output_path)
    if mode in ("error", "ignore") and files.exists(path_of(output_path)):
        # Spark's own outcome for an output that is there.
        df.limit(0).write.mode(mode).csv(output_path)
        return
    aside = f"{output_path.rstrip('/')}-parts-{uuid.uuid4().hex}"
    if files.hasPathCapability(path_of(output_path), CONCAT):
        try:
            _join_parts(df, output_path, mode, files, aside)
        finally:
            files.delete(path_of(aside), True)
    else:
        staged = f"{shared_folder(spark)}/csv-rows-{uuid.uuid4().hex}"
        try:
            _stream_rows(df, output_path, mode, staged)
        finally:
            _file_system(spark, staged).delete(path_of(staged), True)


def _stream_rows(df: DataFrame, output_path: str, mode: str, staged: str) -> None:
    # The number follows the partitions, hence the order of a sorted result.
    columns = [F.col(f"row.`{name}`") for name in df.columns]
    df.select(F.monotonically_increasing_id().alias("nth"), F.struct("*").alias("row")).write.parquet(staged)
    rows = df.sparkSession.read.parquet(staged).coalesce(1).sortWithinPartitions("nth")
    rows.select(*columns).write.mode(mode).option("header", True).csv(output_path)


def _join_parts(df: DataFrame, output_path: str, mode: str, files, aside: str) -> None:
    spark = df.sparkSession
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    df.write.csv(f"{aside}/rows")
    header = spark.createDataFrame([], df.schema).coalesce(1)
    header.write.option("header", True).csv(f"{aside}/header")
    # Names of files only; parts are numbered in the order of the rows.
    parts = []
    for folder in ("header", "rows"):
        listed = [f for f in files.listStatus(path_of(f"{aside}/{folder}")) if f.getLen() > 0]
        data = [f.getPath() for f in listed if f.getPath().getName().startswith("part-")]
        parts += sorted(data, key=lambda p: p.getName())
    whole = path_of(f"{aside}/part-00000-{uuid.uuid4().hex}.csv")
    files.create(whole).close()
    joined = spark.sparkContext._gateway.new_array(path_of, len(parts))
    for i, part in enumerate(parts):
        joined[i] = part
    files.concat(whole, joined)
    target = path_of(output_path)
    if mode == "overwrite":
        files.delete(target, True)
    files.mkdirs(target)
    if not files.rename(whole, path_of(target, whole.getName())):
        raise OSError(f"cannot move the joined file to {output_path}")
