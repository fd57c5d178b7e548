from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from tidegrid.session import release, scratch_path, stored
from tidegrid.sources import readers, versions, writers
from tidegrid.sources.schemas import dataset_schema
from tidegrid.sources.versions import path_exists
from tidegrid.streaming.append import append_if_absent_batch

SCHEMA = "k string, v double"


@pytest.fixture
def rows(spark):
    return lambda *pairs: spark.createDataFrame(list(pairs), SCHEMA)


def _set(df):
    return {tuple(r) for r in df.select("k", "v").collect()}


def test_first_write_wins(rows):
    old, new = rows(("a", 1.0), ("b", 2.0)), rows(("b", 99.0), ("c", 3.0))
    once = writers.append_if_absent(old, new, ["k"])
    assert _set(once) == {("a", 1.0), ("b", 2.0), ("c", 3.0)}
    assert _set(writers.append_if_absent(once, new, ["k"])) == _set(once)


def test_missing_and_repeated_keys(rows):
    old, new = rows(("a", 1.0)), rows((None, 5.0), (None, 4.0), ("a", 9.0), ("b", 3.0), ("b", 2.0), ("b", None))
    once = writers.append_if_absent(old, new, ["k"])
    assert once.count() == 3 and _set(once) == {("a", 1.0), (None, 4.0), ("b", None)}
    again = writers.append_if_absent(once, new.repartition(5), ["k"])
    assert again.count() == 3 and _set(again) == _set(once)


def test_the_order_decides_between_new_rows(spark):
    new = spark.createDataFrame([("b", 1.0, 2), ("b", 2.0, 1)], "k string, v double, seq int")
    assert writers.absent_rows(new.limit(0), new, ["k"], order=["seq"]).collect() == [("b", 2.0, 1)]


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_versions_are_written_and_read_apart(spark, rows, tmp_path, fmt):
    path = str(tmp_path / "t")
    schema = rows().schema
    with pytest.raises(versions.NoVersionError):
        versions.read_latest(spark, path, schema, fmt)
    writers.overwrite_version(rows(("a", 1.0)), path, date(2024, 12, 5), fmt)
    writers.overwrite_version(rows(("b", None), ("c", float("inf"))), path, date(2025, 1, 5), fmt)
    writers.overwrite_version(rows(("a", 7.0)), path, date(2024, 12, 9), fmt)
    table = versions.read_versions(spark, path, schema, fmt)
    assert [r[0] for r in versions.list_versions(table).collect()] == ["2024_12", "2025_01"]
    assert _set(versions.read_latest(spark, path, schema, fmt)) == {("b", None), ("c", float("inf"))}
    assert _set(table.where("version = '2024_12'")) == {("a", 7.0)}
    writers.append_rows(rows(("d", 4.0)), path, date(2025, 1, 5), fmt)
    assert _set(versions.read_latest(spark, path, schema, fmt)) == {("b", None), ("c", float("inf")), ("d", 4.0)}
    assert versions.has_version(spark, path, "2025_01") and not versions.has_version(spark, path, "2025_02")


def test_explicit_schema_keeps_labels_and_empty_columns(spark, tmp_path):
    schema = dataset_schema(["T"], ["I"])
    names = schema.fieldNames()
    line = ["2020-10", "2020", "10", "4"] + [""] * (len(names) - 4)
    (tmp_path / "d.csv").write_text(",".join(names) + "\n" + ",".join(line) + "\n")
    df = readers.read_csv(spark, str(tmp_path / "d.csv"), schema)
    row = df.first()
    assert row["Date"] == "2020-10" and row["I_MOM"] is None and dict(df.dtypes)["I_MOM"] == "double"


def test_nan_is_missing_at_the_source(spark, tmp_path):
    spark.createDataFrame([(float("nan"),), (1.0,)], "v double").write.parquet(str(tmp_path / "p"))
    assert readers.read_parquet(spark, str(tmp_path / "p")).where("v IS NULL").count() == 1


def test_file_listing(spark, tmp_path):
    for name in ("data_2025_01.csv", "data_2024_12.csv", "other.csv", "data_2025_01.txt"):
        (tmp_path / name).write_text("x\n")
    got = [r[0] for r in versions.list_files(spark, str(tmp_path), "data_").collect()]
    assert got == ["data_2024_12.csv", "data_2025_01.csv"]


def test_scan_pushes_both_conditions(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.createDataFrame([("a", date(2024, 1, 1), 1.0), ("a", date(2024, 2, 1), 2.0), ("b", date(2024, 1, 1), 3.0)],
                          "s string, ts date, v double").write.parquet(path)
    out = readers.scan_series(readers.read_parquet(spark, path), ["a", "absent"], date(2024, 1, 1), date(2024, 2, 1),
                              series="s", ts="ts")
    assert [r["v"] for r in out.collect()] == [1.0]
    plan = out._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):]
    assert "GreaterThanOrEqual(ts" in pushed and "LessThan(ts" in pushed and "In(s" in pushed


def test_latest_version_prunes_partitions(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    for m in (1, 2):
        writers.overwrite_version(rows(("a", float(m))), path, date(2025, m, 1), "parquet")
    newest = versions.latest_version(versions.read_versions(spark, path, rows().schema, "parquet"))
    assert "PartitionFilters: [isnotnull(version" in newest._jdf.queryExecution().executedPlan().toString()
    assert _set(newest) == {("a", 2.0)}


def test_read_latest_reads_one_partition(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    for m in (1, 2, 3):
        writers.overwrite_version(rows(("a", float(m))), path, date(2025, m, 1), "parquet")
    assert versions.version_folders(spark, path) == ["2025_01", "2025_02", "2025_03"]
    # Unreadable data of other versions does not matter: no file is opened to find the newest.
    for file in (tmp_path / "t" / "version=2025_01").glob("*.parquet"):
        file.write_bytes(b"broken")
    newest = versions.read_latest(spark, path, rows().schema, "parquet")
    assert _set(newest) == {("a", 3.0)} and len(newest.inputFiles()) >= 1
    assert "PartitionFilters: [isnotnull(version" in newest._jdf.queryExecution().executedPlan().toString()


def test_lines_are_written_in_order(spark, tmp_path):
    lines = spark.range(50).select((F.lit(50) - F.col("id")).alias("line_no"), F.format_string("l%d", 50 - F.col("id")).alias("line"))
    writers.write_lines(lines.repartition(8), str(tmp_path / "r"))
    (part,) = (tmp_path / "r").glob("part-*")
    assert part.read_text().split() == [f"l{i}" for i in range(1, 51)]


def test_stored_frames_live_in_the_checkpoint_folder(spark, rows):
    df = stored(rows(("a", 1.0)))
    assert spark.conf.get("spark.checkpoint.dir") in df.inputFiles()[0]
    assert _set(df) == {("a", 1.0)}


def test_released_scratch_is_gone(spark, rows, tmp_path):
    path = scratch_path(spark, "test")
    rows(("a", 1.0)).write.parquet(path)
    assert path_exists(spark, path)
    release(spark)
    assert not path_exists(spark, path)


def test_streaming_append_is_idempotent(spark, rows, tmp_path):
    source, sink = str(tmp_path / "in"), str(tmp_path / "out")

    def run(checkpoint: str) -> None:
        query = (spark.readStream.schema(SCHEMA).parquet(source).writeStream
                 .option("checkpointLocation", str(tmp_path / checkpoint))
                 .foreachBatch(append_if_absent_batch(sink, ["k"])).trigger(availableNow=True).start())
        query.awaitTermination(60)

    rows(("a", 1.0), ("b", 2.0), ("b", 2.0)).write.parquet(source)
    run("c1")
    rows(("b", 99.0), ("c", 3.0), (None, 7.0), (None, 6.0)).write.mode("append").parquet(source)
    run("c1")
    kept = {("a", 1.0), ("b", 2.0), ("c", 3.0), (None, 6.0)}
    assert _set(spark.read.parquet(sink)) == kept
    run("c2")  # a lost stream checkpoint replays everything
    assert _set(spark.read.parquet(sink)) == kept and spark.read.parquet(sink).count() == 4
