import datetime as dt
import json

import pytest

from gustledger.sources import files, sinks


@pytest.fixture()
def drifting(spark, tmp_path):
    """Three months: numbers, then text, then an extra column and a missing one."""
    paths = [str(tmp_path / f"m{i}.parquet") for i in (1, 2, 3)]
    t = dt.datetime(2024, 1, 1)
    spark.createDataFrame([("a", t, 1.5)], "id string, t timestamp_ntz, v double").coalesce(1).write.parquet(paths[0])
    spark.createDataFrame([("b", "2024-02-01 00:00:00", "2,5"), ("c", "bad", "3.5")], "id string, t string, v string"
                          ).coalesce(1).write.parquet(paths[1])
    spark.createDataFrame([("d", 9)], "id string, extra int").coalesce(1).write.parquet(paths[2])
    return paths


def test_read_union_with_declared_types(spark, drifting, rows):
    df = files.read_union(spark, drifting, {"t": "timestamp_ntz", "v": "double"})
    assert {f.name: f.dataType.simpleString() for f in df.schema} == {
        "id": "string", "t": "timestamp_ntz", "v": "double", "extra": "int", "filename": "string"
    }
    assert rows(df, "id", "t", "v", "extra") == [
        ("a", dt.datetime(2024, 1, 1), 1.5, None), ("b", dt.datetime(2024, 2, 1), None, None),
        ("c", None, 3.5, None), ("d", None, None, 9),
    ]
    assert all(r["filename"].endswith(".parquet") for r in df.collect())


def test_undeclared_drift_becomes_text(spark, drifting):
    df = files.read_union(spark, drifting, file_column=None)
    assert dict(df.dtypes)["v"] == "string" and "filename" not in df.columns


def test_equal_schemas_share_one_scan(spark, tmp_path):
    paths = []
    for i in range(5):
        paths.append(str(tmp_path / f"p{i}"))
        spark.range(i + 1).write.parquet(paths[-1])
    df = files.read_union(spark, paths)
    assert df.count() == 15
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1


def test_monthly_fallback(spark, tmp_path, caplog):
    spark.range(2).selectExpr("id as val_x").write.parquet(str(tmp_path / "S_2024_01.parquet"))
    (tmp_path / "S_2024_01.csv").write_text("val_x\n99\n")
    (tmp_path / "S_2024_02.csv").write_text("val_x;nome\n7.5;é\n")
    months = ["2024_01", "2024_02", "2024_03"]
    df = files.read_monthly(spark, str(tmp_path), "S", months, {"val_x": "double"}, sep=";")
    assert sorted((r["val_x"], r["nome"]) for r in df.collect()) == [(0.0, None), (1.0, None), (7.5, "é")]
    assert "S_2024_03" in caplog.text


def test_no_file_at_all(spark, tmp_path):
    with pytest.raises(ValueError):
        files.read_monthly(spark, str(tmp_path), "S", ["2024_01"])


def test_month_list():
    want = ["2025_12", "2026_01", "2026_02", "2026_03", "2026_04", "2026_05"]
    assert files.month_list(dt.date(2026, 6, 15)) == want
    assert files.month_list(dt.date(2024, 1, 31), 2, 0) == ["2023_12", "2024_01"]


def test_registry_codes_stay_text(spark, tmp_path, rows):
    path = tmp_path / "seed.csv"
    path.write_text("projeto,spe,ceg\nP,A1,037102-5\nP,A2,040625-2\n")
    df = files.read_registry(spark, str(path), "projeto string, spe string, ceg string")
    assert rows(df, "ceg") == [("037102-5",), ("040625-2",)]


def test_json_records_keep_nulls(spark):
    df = spark.createDataFrame(
        [(None, float("nan"), dt.datetime(2024, 1, 1, 0, 30), dt.date(2024, 1, 1), "é")],
        "a int, b double, c timestamp_ntz, d date, e string",
    )
    got = json.loads(sinks.json_records(df).first()["json"])
    assert got == {"a": None, "b": None, "c": "2024-01-01T00:30:00.000", "d": "2024-01-01T00:00:00.000", "e": "é"}


def test_write_table_replaces_and_partitions(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(1, "2024_01"), (2, "2024_02")], "v int, mes string")
    sinks.write_table(first, path, "mes")
    again = sinks.write_table(first.filter("v = 2"), path, "mes")
    assert rows(again, "v", "mes") == [(2, "2024_02")]
    assert again.schema == first.schema


def test_write_table_keeps_an_empty_table(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_table(spark.range(3), path)
    assert sinks.write_table(spark.range(0), path).count() == 0


def _jobs(spark, group, make):
    """What ``make`` gives and how many jobs it took."""
    spark.sparkContext.setJobGroup(group, group)
    try:
        made = make()
        return made, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("schemas", [1, 3])
def test_jobs_grow_with_schemas_not_with_files(spark, tmp_path, schemas):
    """A hundred times the files take the same jobs; each file is opened by a task, not by the driver."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    def fill(folder, n):
        folder.mkdir()
        for i in range(n):
            own = {"id": pa.array([i], pa.int64())}
            if i % schemas == 1:
                own["v"] = pa.array([str(i)])
            if i % schemas == 2:
                own["v"] = pa.array([float(i)])
            pq.write_table(pa.table(own), folder / f"f{i:05d}.parquet")
        return str(folder)

    few, many = fill(tmp_path / "few", 6), fill(tmp_path / "many", 600)
    taken = []
    for path, n in ((few, 6), (many, 600)):
        df, jobs = _jobs(spark, path, lambda: files.read_union(spark, [path], {"v": "double"}))
        got = {r["id"]: r["v"] for r in df.collect()}
        assert got == {i: (float(i) if i % schemas else None) for i in range(n)}
        assert df._jdf.queryExecution().optimizedPlan().toString().count("Relation") == schemas
        taken.append(jobs)
    # Spark lists more than 32 paths by a job of its own.
    assert taken[1] <= taken[0] + schemas and taken[0] <= 5 + 2 * schemas


def test_files_that_tasks_cannot_open_are_asked_for_by_the_driver(spark, drifting, rows, monkeypatch):
    plain = files.read_union(spark, drifting, {"t": "timestamp_ntz", "v": "double"})

    def blind(fmt, roots):
        def run(batches):
            import pyarrow as pa

            for batch in batches:
                nothing = pa.nulls(batch.num_rows, pa.string())
                yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.string()), nothing, pa.array([""] * batch.num_rows)], ["path", "signature", "base"])

        return run

    monkeypatch.setattr(files, "_footers", blind)
    other = files.read_union(spark, drifting, {"t": "timestamp_ntz", "v": "double"})
    names = ["id", "t", "v", "extra"]
    assert rows(other, *names) == rows(plain, *names)


def test_csv_headers_and_key_folders_drift(spark, tmp_path, rows):
    for i, header in enumerate(["id,v", "id,v", "id,w"]):
        (tmp_path / f"k={i}").mkdir()
        (tmp_path / f"k={i}" / "a.csv").write_text(f"{header}\r\n{i},{i}.5\r\n")
    df = files.read_union(spark, {"csv": [str(tmp_path)]}, {"id": "bigint", "v": "double", "w": "double"}, file_column=None)
    assert rows(df, "id", "v", "w", "k") == [(0, 0.5, None, 0), (1, 1.5, None, 1), (2, None, 2.5, 2)]


def test_a_broken_file_is_named(spark, tmp_path):
    spark.range(2).coalesce(1).write.parquet(str(tmp_path / "ok"))
    (tmp_path / "ok" / "zz.parquet").write_bytes(b"not a parquet file")
    with pytest.raises(Exception, match="zz.parquet"):
        files.read_union(spark, [str(tmp_path / "ok")]).count()
