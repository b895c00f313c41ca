import pytest

from gritmill.plans import catalogue

from .conftest import SF, rows_of


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query_agrees_with_its_sql(spark, duck, name):
    got = rows_of(catalogue.QUERIES[name](spark, SF).toPandas())
    assert got == rows_of(duck.sql(catalogue.SQL[name]).df())


def test_every_query_has_sql():
    assert set(catalogue.QUERIES) == set(catalogue.SQL)


def test_the_whole_sort_has_all_rows_in_order(spark):
    got = [tuple(r) for r in catalogue.QUERIES["priority_sort"](spark, SF).collect()]
    orders = spark.read.parquet(f"{SF}/orders.parquet").select("o_orderkey", "o_orderpriority", "o_totalprice").collect()
    assert len(got) > 500 and got == sorted(map(tuple, orders), key=lambda r: (r[1], -r[2], r[0]))


def test_no_class_is_dropped(spark, tmp_path):
    d = str(tmp_path)
    spark.range(150).selectExpr("id AS o_orderkey", "concat('p', id) AS o_orderpriority", "double(id) AS o_totalprice").write.parquet(f"{d}/orders.parquet")
    spark.range(150).selectExpr("id AS c_custkey", "concat('s', id) AS c_mktsegment").write.parquet(f"{d}/customer.parquet")
    assert catalogue.QUERIES["quota_select"](spark, d).count() == catalogue.QUERIES["stratified_sample"](spark, d).count() == 150


def test_good_rows_come_first_then_by_score(spark):
    got = [(r.ok, r.score, r.vec_id) for r in catalogue.QUERIES["ok_score_sort"](spark, SF).collect()]
    assert got == sorted(got, key=lambda r: (not r[0], r[1] is None, -(r[1] or 0), r[2]))


def test_footers_of_tables_in_folders(spark, duck, tmp_path):
    for name in catalogue.COLUMNS:
        spark.read.parquet(f"{SF}/{name}.parquet").repartition(3).write.parquet(f"{tmp_path}/{name}.parquet")
    got = rows_of(catalogue.QUERIES["parquet_footers"](spark, str(tmp_path)).toPandas())
    assert got == rows_of(duck.sql(catalogue.SQL["parquet_footers"]).df())


def test_overwriting_warns(spark, tmp_path):
    from gritmill.sources import writers

    writers.write_stage(spark.range(1), str(tmp_path / "t"))
    with pytest.warns(UserWarning, match="overwritten"):
        writers.write_stage(spark.range(2), str(tmp_path / "t"))
