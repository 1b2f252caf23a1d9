"""Reading, writing, partitions, spine."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from featuremart.sources import scratch, spine, tables

D = dt.date


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def dated(spark):
    data = [(i, D(2023, 1 + i % 3, 1)) for i in range(30)]
    return spark.createDataFrame(data, "id int, snapshot_date date")


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_rewriting_a_partition_leaves_the_others(spark, dated, tmp_path, fmt):
    path = str(tmp_path / "t")
    tables.write_partitions(dated, path, fmt=fmt)
    for _ in range(2):
        tables.write_partitions(spark.createDataFrame([(99, D(2023, 2, 1))], dated.schema), path, fmt=fmt)
        counts = dict(rows(tables.partition_counts(tables.read_partitions(spark, path, fmt))))
        assert counts == {D(2023, 1, 1): 10, D(2023, 2, 1): 1, D(2023, 3, 1): 10}


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_a_date_without_rows_loses_its_old_partition(spark, dated, tmp_path, fmt):
    path = str(tmp_path / "t")
    tables.write_partitions(dated, path, fmt=fmt)
    only = dated.filter(F.col("snapshot_date") == "2023-02-01").limit(4)
    tables.write_partitions(only, path, fmt=fmt, dates=["2023-02-01", "2023-03-01", "2023-04-01"])
    counts = dict(rows(tables.partition_counts(tables.read_partitions(spark, path, fmt))))
    assert counts == {D(2023, 1, 1): 10, D(2023, 2, 1): 4}


def test_dates_prune_partitions(spark, dated, tmp_path):
    path = str(tmp_path / "t")
    tables.write_partitions(dated, path, rebalance=False)
    one = tables.read_partitions(spark, path, dates=["2023-03-01"])
    assert one.count() == 10
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "snapshot_date" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_a_large_date_is_split_over_files(spark, tmp_path):
    """Most rows share one date; the rebalance hint may still write it from several tasks."""
    df = spark.range(400_000).select(
        F.sha2(F.col("id").cast("string"), 512).alias("x"),
        F.when(F.col("id") < 40, F.lit(D(2023, 2, 1))).otherwise(F.lit(D(2023, 1, 1))).alias("snapshot_date"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4m")
    try:
        tables.write_partitions(df, str(tmp_path / "t"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "t" / "snapshot_date=2023-01-01").glob("*.parquet"))) > 1
    assert len(list((tmp_path / "t" / "snapshot_date=2023-02-01").glob("*.parquet"))) == 1


def test_raw_csv_is_text_and_sliced_by_date(spark, tmp_path):
    source = tmp_path / "raw.csv"
    source.write_text("Customer_ID,amount,snapshot_date\na,24198062_,2023-01-01\nb,,2023-02-01\nc,1,bad\n")
    raw = tables.read_raw_csv(spark, str(source))
    assert {t for _, t in raw.dtypes} == {"string"}
    assert rows(tables.slice_snapshots(raw, ["2023-01-01", "2023-02-01"])) == [
        ("a", "24198062_", D(2023, 1, 1)),
        ("b", None, D(2023, 2, 1)),
    ]


def test_verify_written(spark, dated, tmp_path):
    path = str(tmp_path / "t")
    tables.write_partitions(dated, path)
    assert rows(tables.verify_written(spark, path, dated)) == [(30, 30, True, True)]
    assert rows(tables.verify_written(spark, path, dated.limit(3)))[0][2] is False


def test_union_fills_missing_columns(spark):
    a, b = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([(2, 3)], "x int, y int")
    assert rows(tables.union_all(a, b)) == [(1, None), (2, 3)]


@pytest.mark.parametrize(
    "start, end, first, count",
    [("2023-01-01", "2024-12-01", D(2023, 1, 1), 24), ("2023-01-17", "2023-03-31", D(2023, 1, 1), 3)],
)
def test_spine(spark, start, end, first, count):
    dates = sorted(r[0] for r in spine.spine_between(spark, start, end).collect())
    assert dates[0] == first and len(dates) == count and all(d.day == 1 for d in dates)


def test_scratch_lies_in_the_checkpoint_folder(spark):
    assert scratch.scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_cut_keeps_rows_and_shortens_the_plan(spark, dated):
    kept = scratch.cut(dated.groupBy("snapshot_date").count())
    assert dict(rows(kept)) == {D(2023, m, 1): 10 for m in (1, 2, 3)}
    assert "Aggregate" not in kept._jdf.queryExecution().optimizedPlan().toString()


def test_scope_removes_its_scratch_tables(spark, dated, tmp_path):
    outside = scratch.cut(dated)
    with scratch.scratch_scope(spark):
        inside = scratch.cut(dated)
        path = inside.inputFiles()[0].rsplit("/", 1)[0]
        assert inside.count() == 30
        inside.write.parquet(str(tmp_path / "kept"))
    from pathlib import Path

    assert not Path(path.removeprefix("file:").replace("//", "/")).exists()
    assert outside.count() == 30 == spark.read.parquet(str(tmp_path / "kept")).count()


def test_a_write_that_lost_rows_is_an_error(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([(i, D(2023, 1, 1)) for i in range(9)], "x int, snapshot_date date")
    tables.write_partitions(df, str(tmp_path / "t"), dates=["2023-01-01"])
    real = tables.read_partitions
    monkeypatch.setattr(tables, "read_partitions", lambda *a, **b: real(*a, **b).filter("x <> 4"))
    with pytest.raises(RuntimeError, match="9 rows were written"):
        tables.write_partitions(df, str(tmp_path / "t"), dates=["2023-01-01"])


def test_rows_without_a_readable_date_are_counted_and_kept(spark, tmp_path):
    from featuremart.plans.medallion import write_bronze

    source, bronze = tmp_path / "raw.csv", str(tmp_path / "bronze")
    source.write_text("X,snapshot_date\n1,2023-01-01\n2,soon\n3,\n4,2023-05-01\n")
    assert write_bronze(spark, "lms", str(source), bronze, ["2023-01-01"]) == 2
    assert sorted(r.x for r in spark.read.parquet(f"{bronze}_rejects/lms").collect()) == ["2", "3"]
    assert [r.x for r in spark.read.parquet(f"{bronze}/lms").collect()] == ["1"]
    source.write_text("X,snapshot_date\n1,2023-01-01\n")
    assert write_bronze(spark, "lms", str(source), bronze, ["2023-01-01"]) == 0
    assert not (tmp_path / "bronze_rejects" / "lms").exists()


# ---- content checks


def test_checksums_do_not_depend_on_order(spark, dated):
    one = rows(tables.partition_checksums(dated.repartition(7, "id")))
    assert one == rows(tables.partition_checksums(dated.orderBy(F.desc("id")).select("snapshot_date", "id")))
    changed = dated.withColumn("id", F.when(F.col("id") == 4, 400).otherwise(F.col("id")))
    other = rows(tables.partition_checksums(changed))
    assert [a[0] for a, b in zip(one, other, strict=True) if a != b] == [D(2023, 2, 1)]


def test_checksums_notice_doubled_rows_and_moved_nulls(spark):
    day = D(2023, 1, 1)
    sums = lambda data: rows(tables.partition_checksums(spark.createDataFrame(data, "a int, b int, m map<string,int>, snapshot_date date")))
    base = [(1, None, {"x": 1}, day), (2, 2, None, day)]
    assert sums(base) == sums(base[::-1])
    assert sums(base) != sums([*base, (3, 3, None, day), (3, 3, None, day)])
    assert sums(base) != sums([(None, 1, {"x": 1}, day), (2, 2, None, day)])
    assert sums(base) != sums([(1, None, {"x": 2}, day), (2, 2, None, day)])


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_verify_content_names_the_partition(spark, dated, tmp_path, fmt):
    path = str(tmp_path / "t")
    full = dated.select("id", F.when(F.col("id") % 4 != 0, F.col("id") / 3).alias("x"), F.lit("a,\"b\"").alias("s"), "snapshot_date")
    tables.write_partitions(full, path, fmt=fmt, dates=["2023-01-01", "2023-02-01", "2023-03-01"], content=True)
    assert all(r[3] and r[4] for r in rows(tables.verify_content(spark, path, full, fmt)))
    changed = full.filter("month(snapshot_date) = 2").withColumn("x", F.when(F.col("id") == 4, 0.1).otherwise(F.col("x")))
    tables.write_partitions(changed, path, fmt=fmt)
    tables.write_partitions(full.filter("month(snapshot_date) = 3").limit(9), path, fmt=fmt)
    extra = full.limit(1).withColumn("snapshot_date", F.lit(D(2023, 7, 1)))
    tables.write_partitions(extra, path, fmt=fmt)
    assert [r[1:] for r in rows(tables.verify_content(spark, path, full, fmt))] == [
        (10, 10, True, True), (10, 10, True, False), (10, 9, False, False), (0, 1, False, False)
    ]


def test_a_write_that_changed_a_value_is_an_error(spark, dated, tmp_path, monkeypatch):
    real = tables.read_partitions
    wrong = lambda *a, **b: real(*a, **b).withColumn("id", F.when(F.col("id") == 4, 400).otherwise(F.col("id")))
    days = ["2023-01-01", "2023-02-01", "2023-03-01"]
    tables.write_partitions(dated, str(tmp_path / "t"), dates=days, content=True)
    monkeypatch.setattr(tables, "read_partitions", wrong)
    with pytest.raises(RuntimeError, match="differs from what was written for 2023-02-01$"):
        tables.write_partitions(dated, str(tmp_path / "t"), dates=days, content=True)


# ---- quarantine


def test_failing_parts_are_found_by_halving():
    from featuremart.sources import quarantine

    tried = []

    def attempt(parts):
        tried.append(tuple(parts))
        bad = sorted({"c", "k"} & set(parts))
        if bad:
            raise ValueError(f"{bad[0]} is bad\nmore")

    names = list("abcdefghijklmnop")
    assert quarantine.failing(names, attempt) == {"c": "ValueError: c is bad", "k": "ValueError: k is bad"}
    assert len(tried) <= 17
    tried.clear()
    assert quarantine.process_good(["a", "b"], attempt, attempt) == {} and tried == [("a", "b")]
    assert quarantine.process_good(["a", "b", "c"], attempt, attempt) == {"c": "ValueError: c is bad"} and tried[-1] == ("a", "b")
    with pytest.raises(ValueError, match="c is bad"):
        quarantine.process_good(["c", "k"], attempt, attempt)
    assert quarantine.failing([], attempt) == {}


def test_malformed_rows_are_kept_aside(spark, tmp_path):
    from featuremart.plans.medallion import rejected_reasons, write_bronze

    source, bronze = tmp_path / "raw.csv", str(tmp_path / "bronze")
    source.write_text('X,Y,snapshot_date\n1,a,2023-01-01\n2,b\n3,c,2023-01-01,more\n4,"d,e",2023-01-01\n5,f,soon\n6,,2023-01-01\n')
    assert write_bronze(spark, "lms", str(source), bronze, ["2023-01-01"], content=True) == 3
    kept = spark.read.parquet(f"{bronze}_rejects/lms").collect()
    assert sorted((r["reason"], r["_malformed"]) for r in kept if r["_malformed"]) == [("malformed row", "2,b"), ("malformed row", "3,c,2023-01-01,more")]
    assert [(r["x"], r["reason"]) for r in kept if not r["_malformed"]] == [("5", "unreadable snapshot date")]
    assert sorted((r.x, r.y) for r in spark.read.parquet(f"{bronze}/lms").collect()) == [("1", "a"), ("4", "d,e"), ("6", None)]
    assert rejected_reasons(spark, bronze, "lms") == ["bronze lms: 2 malformed rows", "bronze lms: 1 rows without a readable snapshot date"]


@pytest.mark.parametrize("content", [False, True])
def test_dates_without_any_row(spark, tmp_path, content):
    from featuremart.plans.medallion import write_bronze

    source, bronze = tmp_path / "raw.csv", str(tmp_path / "bronze")
    source.write_text("X,snapshot_date\n1,2023-01-01\n2,soon\n")
    assert write_bronze(spark, "lms", str(source), bronze, ["2024-01-01", "2024-02-01"], content=content) == 1
    assert not tables.has_partitions(spark, f"{bronze}/lms")
