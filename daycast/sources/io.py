"""Sources, cleansing and sinks.

Inputs are read with the fixed schemas of `schemas.py`.  CSV is read as
text and parsed by the cleansers, which accept what the original loaders
accepted (unpadded location numbers, 'null' close dates) without relying
on schema inference.  Parquet inputs are read as they are and cleansed
with the same functions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daycast.params import ForecastParams
from daycast.sources import schemas


def pad_key(c: Column | str, width: int = schemas.LOC_WIDTH) -> Column:
    """B1: left-pad the location number with zeros; longer keys stay as they are
    (plain lpad would cut them)."""
    x = F.trim((F.col(c) if isinstance(c, str) else c).cast("string"))
    return F.when(F.length(x) < width, F.lpad(x, width, "0")).otherwise(x)


def parse_date(c: Column | str, bad_dates: str = "null") -> Column:
    """B2: text (yyyy-MM-dd) or date to date.

    Empty text and 'null' mean "no date".  Any other text that is no date
    becomes null, or stops the job with `bad_dates="raise"`.
    """
    col = F.col(c) if isinstance(c, str) else c
    text = F.nullif(F.nullif(F.trim(col.cast("string")), F.lit("null")), F.lit(""))
    date = F.try_to_date(text)
    if bad_dates == "raise":
        error = F.raise_error(F.concat(F.lit("not a date: "), text)).cast("date")
        return F.when(text.isNotNull() & date.isNull(), error).otherwise(date)
    return date


def cleanse_columns(df: DataFrame, keys: Sequence[str] = ("loc_num",), dates: Sequence[str] = (), width: int = schemas.LOC_WIDTH,
                    bad_dates: str = "null") -> DataFrame:
    """B3 for any table: key columns padded to `width` and date columns parsed; all others stay.

    A column that the table lacks is an error, so that a misspelt name
    doesn't leave its column as it was.
    """
    unknown = sorted({*keys, *dates} - set(df.columns))
    if unknown:
        raise ValueError(f"columns to cleanse are not in the table: {unknown}")
    both = sorted(set(keys) & set(dates))
    if both:
        raise ValueError(f"columns are both keys and dates: {both}")
    return df.withColumns({c: pad_key(c, width) for c in keys} | {c: parse_date(c, bad_dates) for c in dates})


def typed_columns(name: str, df: DataFrame, bad_dates: str = "null") -> DataFrame:
    """The registered table's date columns parsed, and its location key padded, where it has them."""
    return cleanse_columns(df, [c for c in ("loc_num",) if c in df.columns],
                           [c for c in schemas.DATE_COLUMNS[name] if c in df.columns], bad_dates=bad_dates)


def unparsed_dates(name: str, raw: DataFrame) -> DataFrame:
    """B2: one row with the number of values, per date column of a raw table, that are text but no date.

    Empty text and 'null' mean "no date" and don't count.
    """
    text = lambda c: F.nullif(F.nullif(F.trim(F.col(c).cast("string")), F.lit("null")), F.lit(""))
    found = [c for c in schemas.DATE_COLUMNS[name] if c in raw.columns]
    return raw.agg(*(F.count_if(text(c).isNotNull() & parse_date(c).isNull()).alias(c) for c in found))


def cleanse_sales_days_future(df: DataFrame, months_predict: int = 120, bad_dates: str = "null") -> DataFrame:
    """B3-B5, B7 on the location table.

    A 'null' or missing close date means the location never closes (B4);
    a missing open date is kept as null and reported by check L1.
    `months_predict` is added when the file does not carry it (B5).
    """
    out = typed_columns("sales_days_future", df, bad_dates)
    out = out.withColumn("close_date", F.coalesce(F.col("close_date"), F.lit(schemas.FAR_FUTURE)))
    if "months_predict" in df.columns:
        mp = F.coalesce(F.col("months_predict").cast("int"), F.lit(months_predict))
    else:
        mp = F.lit(months_predict)
    out = out.withColumn("months_predict", mp)
    if "price_group" in df.columns:
        out = out.withColumn("price_group", F.col("price_group").cast("string"))
    else:
        out = out.withColumn("price_group", F.lit(None).cast("string"))
    return out.select(*[f.name for f in schemas.SALES_DAYS_FUTURE.fields])


def _cast_to(df: DataFrame, name: str, bad_dates: str) -> DataFrame:
    schema = schemas.INPUTS[name]
    out = typed_columns(name, df, bad_dates)
    return out.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields
                        if f.name in out.columns])


def cleanse(name: str, df: DataFrame, params: ForecastParams | None = None, bad_dates: str = "null") -> DataFrame:
    """Cleanse one input table by name."""
    if name == "sales_days_future":
        return cleanse_sales_days_future(df, params.months_predict if params else 120, bad_dates)
    return _cast_to(df, name, bad_dates)


def read_input(spark: SparkSession, name: str, path: str, fmt: str = "csv",
               params: ForecastParams | None = None, bad_dates: str = "raise") -> DataFrame:
    """A1: read one input table (CSV with header, or Parquet) and cleanse it.

    A text that is no date stops the job that reads its column;
    `bad_dates="null"` reads it as no date (`unparsed_dates` counts them).
    """
    if fmt == "csv":
        # Header-named text columns: no schema inference, optional columns may be absent.
        raw = spark.read.option("header", True).option("inferSchema", False).option("mode", "FAILFAST").csv(path)
        missing = {f.name for f in schemas.INPUTS[name].fields if not f.nullable} - set(raw.columns)
        if missing:
            raise ValueError(f"{path}: missing required columns {sorted(missing)}")
    elif fmt == "parquet":
        raw = spark.read.parquet(path)
    else:
        raise ValueError(f"unsupported format {fmt!r}")
    return cleanse(name, raw, params, bad_dates)


CORRUPT = "_malformed"


def _text_rows(spark: SparkSession, path: str, columns: Sequence[str] | None) -> DataFrame:
    """A CSV file's fields as text, and the line itself in CORRUPT where its number of fields is not the table's."""
    csv = spark.read.option("header", columns is None)
    columns = list(columns) if columns is not None else csv.csv(path).columns
    fixed = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, CORRUPT]])
    # Pruned columns would not be parsed, and then a short line would pass for a good one.
    return (csv.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).option("columnPruning", False)
            .schema(fixed).csv(path))


def _fault(name: str, columns: Sequence[str]) -> Column:
    """Why a row of text fields can't be a row of the table; null if it can."""
    fault = F.when(F.col(CORRUPT).isNotNull(), F.lit("fields"))
    for field in schemas.INPUTS[name].fields:
        if field.name not in columns:
            continue
        text = F.nullif(F.nullif(F.trim(field.name), F.lit("null")), F.lit(""))
        value = parse_date(field.name) if isinstance(field.dataType, T.DateType) else text.try_cast(field.dataType)
        fault = fault.when(text.isNotNull() & value.isNull(), F.lit(f"{field.name}: no {field.dataType.typeName()}"))
        if not field.nullable:
            fault = fault.when(text.isNull(), F.lit(f"{field.name}: missing"))
    return fault


def read_checked(spark: SparkSession, name: str, path: str, columns: Sequence[str] | None = None,
                 params: ForecastParams | None = None) -> tuple[DataFrame, DataFrame]:
    """A CSV input table read with a fixed schema, and its rejects.

    Rejects are rows (line, reason): lines with too few or too many fields
    ("fields"), fields that are not of their column's type, and required
    fields that are missing; the first fault in column order counts.  All
    other rows are cleansed and returned.  Nothing stops the job.
    `columns` names the fields of files without a header line.
    """
    rows = _text_rows(spark, path, columns)
    own = [c for c in rows.columns if c != CORRUPT]
    missing = {f.name for f in schemas.INPUTS[name].fields if not f.nullable} - set(own)
    if missing:
        raise ValueError(f"{path}: missing required columns {sorted(missing)}")
    rows = rows.withColumn("_fault", _fault(name, own))
    line = F.coalesce(F.col(CORRUPT), F.concat_ws(",", *(F.coalesce(c, F.lit("")) for c in own)))
    rejects = rows.where(F.col("_fault").isNotNull()).select(line.alias("line"), F.col("_fault").alias("reason"))
    good = rows.where(F.col("_fault").isNull()).select(*(F.nullif(F.col(c), F.lit("")).alias(c) for c in own))
    return cleanse(name, good, params), rejects


def load_inputs(spark: SparkSession, paths: Mapping[str, str], fmt: str = "csv",
                params: ForecastParams | None = None, bad_dates: str = "raise") -> dict[str, DataFrame]:
    """A2: named dataset registry: table name -> path becomes name -> DataFrame,
    each also registered as a temporary view."""
    unknown = set(paths) - set(schemas.INPUTS)
    if unknown:
        raise ValueError(f"unknown input tables: {sorted(unknown)}")
    frames = {name: read_input(spark, name, path, fmt, params, bad_dates) for name, path in paths.items()}
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    return frames


SORT_KEYS = ("loc_num", "month", "date_forecast")


def write_sorted(df: DataFrame, path: str, fmt: str = "parquet", files: int | None = None, keys: tuple[str, ...] = SORT_KEYS) -> None:
    """H1: overwrite `path` with files that form one order by `keys`: every file follows the one before it by name.

    Rows are dealt by ranges of the keys, cut from a sample, and sorted
    within; no task sees more than its range.  The keys are unique in the
    forecast, so a location that holds most rows is cut within.  The sample
    is a pass over `df`: give a stored table, not a plan.
    """
    n = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    write_output(df.repartitionByRange(n, *keys).sortWithinPartitions(*keys), path, fmt, partition_by=None)


def with_file_positions(stored: DataFrame) -> DataFrame:
    """`stored` (Parquet files as read) with `position`, each row's place from 1 in the order of file names and rows in them.

    Only the files' row counts are summed up in one place.
    """
    rows = stored.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    by_name = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    files = rows.groupBy("_file").agg(F.count(F.lit(1)).alias("_n")).select(
        "_file", F.coalesce(F.sum("_n").over(by_name), F.lit(0)).alias("_before"))
    return rows.join(files, "_file").withColumn("position", F.col("_before") + F.col("_row") + 1).drop("_file", "_row", "_before")


def write_output(df: DataFrame, path: str, fmt: str = "parquet", single_file: bool = False,
                 partition_by: str | None = "date_forecast", sort: bool = False) -> None:
    """A3: overwrite `path` with the forecast.

    Parquet partitioned by forecast date is the default, so readers can prune
    by date.  `single_file=True` reproduces the one-CSV output of the
    original job: one task writes everything, but only writes; the plan runs
    in all tasks before it, and the rows reach the writer as a stream.
    `sort=True` sorts rows by location and month inside each file
    without a global sort (`write_sorted` makes one order of all files).
    """
    out = df
    if single_file:
        # An exchange: coalesce(1) would run the plan's last joins, for all rows, in the one task that writes.
        out = out.repartition(1)
        partition_by = None
    if sort:
        out = out.sortWithinPartitions("loc_num", "month", "date_forecast")
    w = out.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    elif fmt == "parquet":
        w.parquet(path)
    else:
        raise ValueError(f"unsupported format {fmt!r}")


def _files(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and a function that makes its paths."""
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), make


def remove(spark: SparkSession, path: str) -> None:
    fs, make = _files(spark, path)
    fs.delete(make(path), True)


def publish(spark: SparkSession, staging: str, path: str) -> None:
    """Replace `path` by the directory `staging` (Hadoop FileSystem rename)."""
    fs, make = _files(spark, staging)
    src, dst = make(staging), make(path)
    # The result before stays until the new one is in its place.
    old = make(path.rstrip("/") + ".old")
    fs.delete(old, True)
    if fs.exists(dst) and not fs.rename(dst, old):
        raise OSError(f"could not move {path} aside")
    if not fs.exists(dst.getParent()):
        fs.mkdirs(dst.getParent())
    if not fs.rename(src, dst):
        if fs.exists(old):
            fs.rename(old, dst)
        raise OSError(f"could not move {staging} to {path}")
    fs.delete(old, True)


def partition_name(column: str, value: object) -> str:
    """The directory of a partition (of a value that needs no escaping)."""
    return f"{column}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}"


def partitions_of(spark: SparkSession, path: str) -> list[str]:
    """The partition directories directly under `path`."""
    fs, make = _files(spark, path)
    if not fs.exists(make(path)):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(make(path)) if s.isDirectory() and "=" in s.getPath().getName())


def publish_partitions(spark: SparkSession, staging: str, path: str, names: list[str] | None = None) -> None:
    """Replace partitions of `path` by those of the directory `staging`; all others stay.

    `names` are the partitions to replace (default: those of `staging`); one
    that `staging` lacks is removed.  The old partitions stay aside until
    every new one is in place; if a move fails, all are moved back.
    """
    fs, make = _files(spark, staging)
    root, old = path.rstrip("/"), path.rstrip("/") + ".old"
    new = set(partitions_of(spark, staging))
    fs.delete(make(old), True)
    fs.mkdirs(make(root))
    fs.mkdirs(make(old))
    done: list[tuple[str, str]] = []

    def move(a: str, b: str) -> None:
        if not fs.rename(make(a), make(b)):
            raise OSError(f"could not move {a} to {b}")
        done.append((a, b))

    try:
        for name in sorted(new) if names is None else names:
            if fs.exists(make(f"{root}/{name}")):
                move(f"{root}/{name}", f"{old}/{name}")
            if name in new:
                move(f"{staging}/{name}", f"{root}/{name}")
    except Exception:
        for a, b in reversed(done):
            fs.rename(make(b), make(a))
        raise
    fs.delete(make(old), True)
    fs.delete(make(staging), True)


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """A4: the first rows, as a lazy DataFrame (never inside an operator)."""
    return df.limit(n)
