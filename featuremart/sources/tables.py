"""Raw text tables and date-partitioned tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, MapType, StringType, StructType

from ..functions.cleaning import to_date
from ..operators.schema import quoted
from .scratch import remove_path

SNAPSHOT = "snapshot_date"
MALFORMED = "_malformed"
HASH = "_row_hash"


def read_raw_csv(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Headered text table with every column as string: one pass, no type inference.

    Types are imposed by the silver transforms from the raw text, so a large number never passes
    through a float rendering such as 2.4E7 first.
    """
    reader = spark.read.option("header", True)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def read_raw_rows(spark: SparkSession, path: str) -> DataFrame:
    """:func:`read_raw_csv` with one more column, :data:`MALFORMED`: the line as it came where it does not
    fit the header (too few or too many fields), else null."""
    names = read_raw_csv(spark, path).columns
    if MALFORMED in names:
        raise ValueError(f"the source has a column {MALFORMED!r}")
    schema = StructType()
    for name in [*names, MALFORMED]:
        schema = schema.add(name, StringType())
    return spark.read.option("header", True).option("columnNameOfCorruptRecord", MALFORMED).schema(schema).csv(path)


def reject_reason(column: str = SNAPSHOT) -> Column:
    """Why a row of :func:`read_raw_rows` belongs to no partition; null if it does."""
    return (
        F.when(quoted(MALFORMED).isNotNull(), "malformed row")
        .when(to_date(F.col(column)).isNull(), "unreadable snapshot date")
    )


def slice_snapshots(df: DataFrame, dates: Iterable[str], column: str = SNAPSHOT) -> DataFrame:
    """Rows of the wanted snapshot dates, with the date typed. Other rows, and rows without a
    readable date, belong to no partition; ``unreadable_dates`` has the latter."""
    wanted = [F.lit(d).cast("date") for d in dates]
    return df.withColumn(column, to_date(F.col(column))).filter(F.col(column).isin(*wanted))


def unreadable_dates(df: DataFrame, column: str = SNAPSHOT) -> DataFrame:
    """Rows as they came whose snapshot date is missing or can't be read."""
    return df.filter(to_date(F.col(column)).isNull())


def _hashable(kind: DataType) -> bool:
    return not isinstance(kind, MapType)


def row_hash(df: DataFrame, but: Sequence[str] = ()) -> Column:
    """64 bits that depend on the names, types and values of a row, not on the order of its columns."""
    fields = sorted((f for f in df.schema if f.name not in but), key=lambda f: f.name)
    values = [quoted(f.name) if _hashable(f.dataType) else F.to_json(quoted(f.name)) for f in fields]
    # nulls don't change the hash, so which columns are null goes in too
    nulls = F.concat_ws(",", *[F.when(quoted(f.name).isNull(), F.lit(f.name)) for f in fields])
    return F.xxhash64(*values, nulls)


def checksum_parts(row: Column) -> dict[str, Column]:
    """Aggregates over row hashes that do not depend on their order: how many, their exclusive-or, and a sum
    (equal rows cancel out in the exclusive-or)."""
    return {"rows_hashed": F.count(row), "xor": F.bit_xor(row), "sum": F.sum(F.pmod(row, F.lit(1 << 32)))}


def checksum(row: Column) -> Column:
    return F.struct(*[c.alias(n) for n, c in checksum_parts(row).items()])


def partition_checksums(df: DataFrame, by: str = SNAPSHOT) -> DataFrame:
    """``by, content``: rows and checksum of each partition."""
    return df.groupBy(quoted(by)).agg(checksum(row_hash(df, but=[by])).alias("content"))


def as_written(df: DataFrame, like: DataFrame) -> DataFrame:
    """A table read back from text, with the columns' types as they were before writing."""
    return df.select(*[quoted(f.name).try_cast(f.dataType).alias(f.name) for f in like.schema])


def verify_content(spark: SparkSession, path: str, expected: DataFrame, fmt: str = "parquet", by: str = SNAPSHOT) -> DataFrame:
    """Per partition of the expected or the written table: rows on both sides, and whether rows and content
    agree. Each side is reduced to a row for each partition before they meet."""
    written = as_written(read_partitions(spark, path, fmt, by=by), expected)
    both = partition_checksums(expected, by).withColumnRenamed("content", "a").join(
        partition_checksums(written, by).withColumnRenamed("content", "b"), by, "full"
    )
    rows = lambda side: F.coalesce(F.col(f"{side}.rows_hashed"), F.lit(0))
    return both.select(
        by,
        rows("a").alias("expected_rows"),
        rows("b").alias("written_rows"),
        (rows("a") == rows("b")).alias("rows_match"),
        F.col("a").eqNullSafe(F.col("b")).alias("content_matches"),
    )


def write_partitions(
    df: DataFrame,
    path: str,
    by: str = SNAPSHOT,
    fmt: str = "parquet",
    rebalance: bool = True,
    dates: Iterable[str] | None = None,
    content: bool = False,
) -> None:
    """Overwrite the partitions present in ``df`` and leave the others as they are.

    ``dates`` names the partitions this write stands for: one of them that gets no rows loses what an
    earlier run left there. Which dates got rows, and how many, is observed during the write, without
    another pass; then the written partitions are counted, and a difference is an error. ``content`` also
    observes a checksum of all rows with their dates, and reads the partitions back to compare.

    The rebalance hint gathers a date into few files and splits a date that holds a large share of
    the rows. Turn it off when the input already arrives grouped by date.
    """
    out = df.hint("rebalance", F.col(by)) if rebalance else df
    seen = None
    if dates is not None:
        seen, dates = Observation(), sorted(set(dates))
        out = out.withColumn(HASH, row_hash(df)) if content else out
        out = out.observe(
            seen,
            F.collect_set(F.col(by).cast("string")).alias("written"),
            F.count(F.lit(1)).alias("rows"),
            *([c.alias(n) for n, c in checksum_parts(F.col(HASH)).items()] if content else []),
        ).drop(HASH)
    writer = (
        out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(by)
        .format(fmt)
    )
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.save(path)
    if seen is not None:
        found = observed(seen)
        if not found and not df.isEmpty():
            raise RuntimeError(f"the write to {path} was not observed")
        written = sorted(found.get("written") or ())
        drop_partitions(df.sparkSession, path, set(dates) - set(written), by)
        check_written(df.sparkSession, path, written, found.get("rows") or 0, fmt, by)
        if content and written:
            check_content(df, path, written, [found[n] for n in checksum_parts(F.col(HASH))], fmt, by)


def observed(seen: Observation) -> dict:
    """What a finished write observed; nothing if it had no rows and the plan was dropped for that."""
    try:
        return seen.get
    except Exception:  # the session's own error: no metrics came
        return {}


def check_written(spark: SparkSession, path: str, values: Sequence[str], rows: int, fmt: str, by: str) -> None:
    """Raise unless the partitions of the values hold ``rows`` rows; of Parquet only footers are read."""
    found = read_partitions(spark, path, fmt).filter(F.col(by).cast("string").isin(list(values))).count() if values else 0
    if found != rows:
        raise RuntimeError(f"{rows} rows were written to {path}, but it holds {found}")


def check_content(df: DataFrame, path: str, written: Sequence[str], expected: Sequence, fmt: str, by: str) -> None:
    """Raise unless the partitions on disk have the checksum observed during the write. Only then the rows
    are made again, to say which partitions differ."""
    spark, chosen = df.sparkSession, F.col(by).cast("string").isin(list(written))
    found = as_written(read_partitions(spark, path, fmt, by=by), df).filter(chosen)
    if tuple(found.agg(checksum(row_hash(found)).alias("content")).first()["content"]) == tuple(expected):
        return
    wrong = verify_content(spark, path, df, fmt, by).filter(chosen & ~F.col("content_matches")).select(F.col(by).cast("string"))
    names = ", ".join(sorted(r[0] for r in wrong.collect()))
    raise RuntimeError(f"the content of {path} differs from what was written{' for ' + names if names else ''}")


def drop_partitions(spark: SparkSession, path: str, values: Iterable[str], by: str = SNAPSHOT) -> None:
    """Remove whole partitions; one that does not exist is no error."""
    for value in values:
        remove_path(spark, f"{path}/{by}={value}")


def read_partitions(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    dates: Iterable[str] | None = None,
    by: str = SNAPSHOT,
    merge_schema: bool = False,
) -> DataFrame:
    """All partitions of a table, or those of the given dates by partition pruning.

    ``merge_schema`` reads every footer so that columns present in only some partitions are kept.
    It is off by default because all writers here use one schema for all dates.
    """
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    if merge_schema and fmt == "parquet":
        reader = reader.option("mergeSchema", True)
    df = reader.load(path)
    if dates is not None:
        df = df.filter(F.col(by).isin(*[F.lit(d).cast("date") for d in dates]))
    return df


def partition_values(spark: SparkSession, path: str, by: str = SNAPSHOT) -> list[str]:
    """Values of the partitions that exist, in order; one listing of the table's folder."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{by}=*")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    return sorted(f.getPath().getName().split("=", 1)[1] for f in found or [])


def read_dates(spark: SparkSession, path: str, dates: Sequence[str], fmt: str = "parquet", by: str = SNAPSHOT) -> DataFrame:
    """The named partitions by their own folders: no file of another date is opened, not even for its
    schema. At least one of them has to exist."""
    reader = spark.read.option("basePath", path).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    there = set(partition_values(spark, path, by))
    return reader.load([f"{path}/{by}={d}" for d in dates if d in there])


def union_all(*tables: DataFrame) -> DataFrame:
    """Rows of all tables by column name; a column a table lacks is null in its rows."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out


def has_partitions(spark: SparkSession, path: str, by: str = SNAPSHOT) -> bool:
    """Whether a table holds any partition; one without any has no schema to read."""
    return bool(partition_values(spark, path, by))


def partition_counts(df: DataFrame, by: str = SNAPSHOT) -> DataFrame:
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("rows"))


def verify_written(spark: SparkSession, path: str, expected: DataFrame, fmt: str = "parquet") -> DataFrame:
    """Read back a written table: row and column counts next to those of its input."""
    written = read_partitions(spark, path, fmt)
    sides = union_all(
        expected.agg(F.count(F.lit(1)).alias("expected_rows")),
        written.agg(F.count(F.lit(1)).alias("written_rows")),
    )
    return sides.agg(
        F.sum("expected_rows").alias("expected_rows"),
        F.sum("written_rows").alias("written_rows"),
        (F.sum("expected_rows") == F.sum("written_rows")).alias("rows_match"),
        F.lit(set(written.columns) == set(expected.columns)).alias("columns_match"),
    )
