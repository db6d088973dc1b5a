"""Reading and writing of a partitioned lake through Spark's own sources."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stintlake.functions.coerce import week_start as _week_start


def empty_frame(spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    return spark.createDataFrame([], schema)


def read_table(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """A Parquet file, table folder, or list of them."""
    return spark.read.parquet(*([path] if isinstance(path, str) else path))


def read_prefix(spark: SparkSession, prefix: str, schema: T.StructType | str | None = None) -> DataFrame:
    """All Parquet files below a folder, united by name; the empty frame of `schema` if there is none.

    Partition folders become columns. Files whose types differ but widen are merged by Spark.
    """
    try:
        return spark.read.option("mergeSchema", True).parquet(prefix)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA") and schema is not None:
            return empty_frame(spark, schema)
        raise


def read_drifting(frames: Iterable[DataFrame]) -> DataFrame:
    """Union by name of frames whose types clash: clashing columns become strings."""
    frames = list(frames)
    kinds: dict[str, set[str]] = {}
    for f in frames:
        for field in f.schema.fields:
            kinds.setdefault(field.name, set()).add(field.dataType.simpleString())
    numbers = {"tinyint", "smallint", "int", "bigint", "float", "double"}
    clash = {c for c, k in kinds.items() if len(k - {"void"}) > 1 and not k <= numbers}
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [f.withColumns({c: F.col(c).cast("string") for c in f.columns if c in clash}) for f in frames])


def path_partition(key: str) -> Column:
    """The value of a key=value segment in the path of a row's file; null if there is none."""
    return F.nullif(F.regexp_extract(F.col("_metadata.file_path"), f"/{key}=([^/]+?)(?:\\.parquet)?(?:/|$)", 1), F.lit(""))


def partition_columns(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Adds key=value path segments as columns where the files don't have them."""
    return df.withColumns({k: path_partition(k) for k in keys if k not in df.columns})


def snapshot_date(path: Column, today: str | None = None) -> Column:
    """load_date=<d> in a path, else today."""
    found = F.regexp_extract(path, r"load_date=(\d{4}-\d{2}-\d{2})", 1).try_cast("date")
    return F.coalesce(found, F.lit(today).cast("date") if today else F.current_date())


def latest_partition(df: DataFrame, column: str = "load_date") -> DataFrame:
    """Rows of the greatest partition value; an error if there is none."""
    top = df.agg(F.max(column)).first()[0]
    if top is None:
        raise ValueError(f"no partition of {column}")
    return df.where(F.col(column) == F.lit(top))


def files(df: DataFrame) -> DataFrame:
    """path, size and modification time of the files below a frame."""
    return df.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"), F.col("_metadata.file_modification_time").alias("modified")).distinct()


def latest_by_mtime(df: DataFrame) -> str | None:
    """The path of the newest file (then the greatest path)."""
    return files(df).agg(F.max(F.struct("modified", "path")).getField("path")).first()[0]


def latest_file(df: DataFrame) -> str | None:
    """The lexically greatest path."""
    return files(df).agg(F.max("path")).first()[0]


def read_glob(spark: SparkSession, pattern: str, schema: T.StructType | str) -> DataFrame:
    """All files of a glob under one explicit schema; further columns of theirs are not read."""
    return spark.read.schema(schema).parquet(pattern)


def write_partitioned(df: DataFrame, path: str, by: Sequence[str], mode: str = "overwrite") -> None:
    """Partitioned Parquet. Each task sorts its rows by partition, so hot values stay spread over tasks."""
    df.write.partitionBy(*by).mode(mode).parquet(path)


def write_bronze(df: DataFrame, base: str, entity: str, date: str, cadence: str = "daily", week_start: str = "tuesday") -> str | None:
    """Writes base/entity/<cadence>/load_date=<d>, replacing that partition only; nothing if df is empty.

    weekly rolls the date back to the start of its week; season expects a season column.
    """
    if not df.limit(1).count():
        return None
    path = f"{base}/{entity}/{cadence}"
    by = "season" if cadence == "season" else "load_date"
    if cadence != "season":
        d = F.lit(date).cast("date")
        df = df.withColumn("load_date", _week_start(d, week_start) if cadence == "weekly" else d)
    df.write.option("partitionOverwriteMode", "dynamic").partitionBy(by).mode("overwrite").parquet(path)
    return path


def write_seasons(df: DataFrame, path: str, date: str) -> str:
    """A partition for every season; without a season column one for the load date."""
    by = "season" if "season" in df.columns else "load_date"
    (df if by == "season" else df.withColumn(by, F.lit(date).cast("date"))).write.option("partitionOverwriteMode", "dynamic").partitionBy(by).mode("overwrite").parquet(path)
    return by


def resume(work: DataFrame, done: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """Work units whose output does not exist yet."""
    return work if done is None else work.join(done.select(*keys).distinct(), list(keys), "left_anti")


def records_to_table(df: DataFrame, column: str, schema: T.StructType | str) -> DataFrame:
    """JSON text to typed columns; values that don't fit are null."""
    text = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    loose = T.StructType([T.StructField(f.name, f.dataType if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)) else T.StringType()) for f in text.fields])
    parsed = df.select(F.from_json(column, loose).alias("r"))
    return parsed.select(*[F.col(f"r.{f.name}").alias(f.name) if f.dataType == loose[f.name].dataType else F.col(f"r.{f.name}").try_cast(f.dataType).alias(f.name) for f in text.fields])


def read_json_records(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """JSON lines with an explicit schema, or one inferred from all of them."""
    return spark.read.schema(schema).json(path) if schema is not None else spark.read.option("samplingRatio", 1.0).json(path)


def read_jdbc(spark: SparkSession, url: str, table: str, column: str | None = None, bounds: tuple[int, int, int] | None = None) -> DataFrame:
    """A relational table; with a number column and (low, high, parts) in parallel."""
    extra = {"column": column, "lowerBound": bounds[0], "upperBound": bounds[1], "numPartitions": bounds[2]} if column and bounds else {}
    return spark.read.jdbc(url, table, **extra)


def values_with_players(values: DataFrame, players: DataFrame) -> DataFrame:
    """All values, each with its player's columns if there is one, by id."""
    return values.join(players, "player_id", "left").orderBy("id")


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.option("header", True).mode("overwrite").csv(path)


def read_mapping(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A CSV mapping; the empty frame of its schema if the file is missing."""
    try:
        return read_csv(spark, path, schema)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return empty_frame(spark, schema)
        raise


def static_table(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def profile(tables: dict[str, DataFrame], exact: bool = False) -> DataFrame:
    """table_name, column_name, data_type, n_rows, n_null, n_distinct of every column, a pass per table.

    n_distinct is an estimate unless `exact` (which shuffles every column's values). profiles.py keeps
    estimates per partition and merges them.
    """
    kinds_of = F.count_distinct if exact else F.approx_count_distinct
    parts = []
    for name, df in tables.items():
        plain = [f for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant")]
        agg = df.agg(F.count("*").alias("n"), *[F.count(F.when(F.col(f"`{f.name}`").isNull(), 1)).alias(f"null_{i}") for i, f in enumerate(plain)], *[kinds_of(F.col(f"`{f.name}`")).alias(f"kinds_{i}") for i, f in enumerate(plain)])
        rows = F.array(*[F.struct(F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"), F.col("n").alias("n_rows"), F.col(f"null_{i}").alias("n_null"), F.col(f"kinds_{i}").alias("n_distinct")) for i, f in enumerate(plain)])
        parts.append(agg.select(F.lit(name).alias("table_name"), F.explode(rows).alias("x")).select("table_name", "x.*"))
    return reduce(DataFrame.unionByName, parts)


def profile_sizes(tables: dict[str, DataFrame]) -> DataFrame:
    """table_name, n_files, n_bytes, and a total over all tables (table_name null)."""
    parts = [files(df).agg(F.count("*").alias("n_files"), F.sum("size").alias("n_bytes")).select(F.lit(n).alias("table_name"), "n_files", "n_bytes") for n, df in tables.items()]
    each = reduce(DataFrame.unionByName, parts)
    return each.unionByName(each.agg(F.sum("n_files").alias("n_files"), F.sum("n_bytes").alias("n_bytes")).select(F.lit(None).cast("string").alias("table_name"), "n_files", "n_bytes"))


def split_bad_records(df: DataFrame, check: Callable[[DataFrame], Column]) -> tuple[DataFrame, DataFrame]:
    """(good rows, rows for the error table): check gives a reason, or null for good rows."""
    marked = df.withColumn("error", check(df))
    return marked.where("error IS NULL").drop("error"), marked.where("error IS NOT NULL")
