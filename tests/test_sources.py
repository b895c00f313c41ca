import json

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from gritmill import schemas
from gritmill.sources import readers, writers
from gritmill.streaming import resume

SCHEMA = schemas.fields("item_id string, n bigint, note string")


def test_shards_are_bound_by_name(spark, tmp_path):
    (tmp_path / "a.csv000").write_text('item_id,n,note\n1,10,x\n2,"",null\n3,abc,""\n4,1,y,extra\n')
    (tmp_path / "a.csv001").write_text("note,item_id\nz,5\n")
    rows = sorted(map(tuple, readers.read_shards(spark, str(tmp_path), "a.csv*", SCHEMA).collect()))
    assert rows[:3] == [("1", 10, "x"), ("2", None, "null"), ("3", None, None)] and rows[-1] == ("5", None, "z")
    assert all(r[0] != "4" or r[2] == "y" for r in rows)


def test_missing_shards(spark, tmp_path):
    assert readers.read_shards(spark, str(tmp_path), "b*", SCHEMA, on_missing="empty").schema == SCHEMA
    with pytest.raises(FileNotFoundError):
        readers.read_shards(spark, str(tmp_path), "b*", SCHEMA)


def test_broken_ledger_lines(spark, tmp_path):
    (tmp_path / "l.jsonl").write_text('{"item_id": "a", "n": 1}\n\n{broken\n{"item_id": "b"}\n')
    assert sorted(r.item_id for r in readers.read_ledger(spark, str(tmp_path / "l.jsonl"), SCHEMA).collect()) == ["a", "b"]
    assert readers.read_ledger(spark, str(tmp_path / "none"), SCHEMA).count() == 0


def test_footers(spark, tmp_path):
    spark.range(7).coalesce(1).write.parquet(str(tmp_path / "t"))
    (tmp_path / "t" / "bad.parquet").write_bytes(b"nothing")
    rows = readers.parquet_summary(spark, str(tmp_path / "t")).collect()
    assert sorted(r.n_rows or -1 for r in rows) == [-1, 7] and any(r.error for r in rows)


def test_footers_are_all_that_is_read(spark, tmp_path):
    wide = pa.table({f"c{i}": [i] for i in range(900)} | {"s": [{"a": 1, "b": 2}]})
    pq.write_table(wide, tmp_path / "wide %20.parquet")
    content = (tmp_path / "wide %20.parquet").read_bytes()
    with (tmp_path / "large.parquet").open("wb") as f:
        f.seek(3 << 30)
        f.write(content)
    (tmp_path / "bad.parquet").write_bytes(b"\xff" * 100_000)
    (tmp_path / "cut.parquet").write_bytes(content[:-1])
    rows = {r.path.rpartition("/")[2]: r for r in readers.parquet_summary(spark, str(tmp_path)).collect()}
    assert pq.read_metadata(tmp_path / "wide %20.parquet").serialized_size > readers.TAIL
    for name in ("wide %20.parquet", "large.parquet"):
        assert (rows[name].n_rows, rows[name].n_columns, rows[name].columns, rows[name].error) == (1, 901, ",".join(wide.column_names), None)
    assert rows["large.parquet"].size_bytes == (3 << 30) + len(content)
    assert all(rows[name].error and rows[name].n_rows is None for name in ("bad.parquet", "cut.parquet"))


def test_a_folder_is_one_table(spark, tmp_path):
    d = tmp_path / "a" / "x=1"
    spark.range(10).repartition(4).write.parquet(str(d / "parts.parquet"))
    spark.range(3).selectExpr("id", "'x' AS note").coalesce(1).write.mode("append").parquet(str(d / "parts.parquet"))
    spark.range(9).selectExpr("id", "id % 3 AS k").write.partitionBy("k").parquet(str(d / "dealt.parquet"))
    pq.write_table(pa.table({"id": [1, 2]}), d / "single.parquet")
    for name in ("_metadata", "old/part-0.parquet", "_temporary/part-0.parquet", ".hidden.parquet"):
        (d / "parts.parquet" / name).parent.mkdir(exist_ok=True)
        pq.write_table(pa.table({"id": [1]}), d / "parts.parquet" / name)
    spark.range(5).repartition(2).write.parquet(str(d / "broken.parquet"))
    (d / "broken.parquet" / "part-9").write_bytes(b"nothing")
    spark.range(5).where("false").write.parquet(str(d / "none.parquet"))
    rows = {r.file: r for r in readers.parquet_tables(spark, f"{d}/").collect()}
    whole = {name: (r.n_rows, r.n_columns, set(r.columns.split(","))) for name, r in rows.items() if r.error is None}
    assert whole == {name: (df.count(), len(df.columns), set(df.columns)) for name in ("parts.parquet", "dealt.parquet", "single.parquet", "none.parquet") for df in [spark.read.option("mergeSchema", True).parquet(str(d / name))]}
    assert rows["dealt.parquet"].columns == "id,k"
    assert "part-9" in rows["broken.parquet"].error and rows["broken.parquet"].n_rows is rows["broken.parquet"].columns is None
    assert readers.parquet_tables(spark, str(tmp_path)).count() == readers.parquet_tables(spark, str(tmp_path / "none")).count() == 0


def test_existing_files(spark, tmp_path):
    (tmp_path / "x.jpg").write_bytes(b"1")
    df = spark.createDataFrame([("1", str(tmp_path / "x.jpg")), ("2", str(tmp_path / "y.jpg")), ("3", None)], "item_id string, p string")
    assert [r.item_id for r in readers.existing_files(df, "p", readers.file_listing(spark, str(tmp_path))).collect()] == ["1"]


def test_point_lookup_is_pushed_down(spark, tmp_path):
    spark.range(100).write.parquet(str(tmp_path / "t"))
    df = readers.point_lookup(readers.read_stage(spark, str(tmp_path / "t")), "id", 7)
    assert df.count() == 1 and "PushedFilters: [IsNotNull(id), EqualTo(id,7)]" in df._jdf.queryExecution().toString()


def test_empty_tables_keep_their_schema(spark, tmp_path):
    out = writers.write_stage(schemas.empty(spark, SCHEMA), str(tmp_path / "e"))
    assert spark.read.parquet(str(tmp_path / "e")).columns == SCHEMA.names and out.count() == 0


def test_reuse(spark, tmp_path):
    writers.write_stage(spark.range(3), str(tmp_path / "r"))
    assert writers.write_stage(spark.range(9), str(tmp_path / "r"), "reuse").count() == 3


def test_reports(spark, tmp_path):
    df = spark.createDataFrame([("a", 1)], "k string, n int")
    writers.write_csv(df, str(tmp_path / "c"))
    data = next((tmp_path / "c").glob("part-*")).read_bytes()
    assert data.startswith(b"\xef\xbb\xbfk,n")
    writers.write_json(df, str(tmp_path / "j"), array=True)
    assert json.loads(next((tmp_path / "j").glob("part-*")).read_text()) == [{"k": "a", "n": 1}]
    writers.write_id_lists(spark.createDataFrame([("1", "x"), ("1", "x"), (" ", "x")], "item_id string, c string"), str(tmp_path / "i"), by="c", distinct=True)
    assert next((tmp_path / "i" / "category=x").glob("part-*")).read_text() == "1\n"


def test_preview_and_ledger(spark, tmp_path):
    assert writers.preview(spark.range(9), 2)["rows"] == [{"id": 0}, {"id": 1}]
    writers.append_ledger(spark.range(1), str(tmp_path / "l"), "r1")
    writers.append_ledger(spark.range(1), str(tmp_path / "l"), "r2")
    assert spark.read.parquet(str(tmp_path / "l")).select("run_id").distinct().count() == 2


def test_incremental_runs_equal_one_run(spark, tmp_path):
    schema, base = schemas.fields("item_id string, n bigint"), str(tmp_path)
    for k in range(3):
        spark.createDataFrame([(f"{k}", k), ("same", k)], schema).coalesce(1).write.mode("append").parquet(f"{base}/in")
        resume.run_incremental(spark, f"{base}/in", schema, lambda df: df, f"{base}/out", f"{base}/ck")
    assert resume.run_incremental(spark, f"{base}/in", schema, lambda df: df, f"{base}/out", f"{base}/ck") == 0
    rows = resume.latest_results(spark, f"{base}/out", schema).collect()
    assert sorted(r.item_id for r in rows) == ["0", "1", "2", "same"]


def test_required_columns(spark):
    with pytest.raises(ValueError, match="nope"):
        schemas.require_columns(spark.range(1), "id", "nope")
