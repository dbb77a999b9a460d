"""Types found from whole files, and loads that survive bad rows."""

from itertools import permutations

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.fixtures import ORDERS, write_f1_csv
from tillroll import schemas as S
from tillroll.plans.etl import WarehousePaths, _read, read_bronze_orders, register_views, run_stage
from tillroll.plans.registry import warehouse
from tillroll.sources import checked
from tillroll.sources.files import csv_sources, read_result_csv, write_result_csv
from tillroll.sources.runlog import read_log

SPARK_NAMES = {"BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean", "DATE": "date", "TIMESTAMP": "timestamp_ntz"}


def put(scratch, text, name="a.csv"):
    path = scratch / name
    path.write_text(text)
    return str(path)


def types(schema):
    return {f.name: f.dataType.simpleString() for f in schema}


def test_each_type_and_its_merges(spark, scratch):
    path = put(
        scratch,
        "whole,decimal,big,flag,day,at,mixed,dates,none,words\n"
        "1,1.5,9223372036854775807,true,2024-02-29,2024-01-01 10:00:00,1,2024-01-01,,a\n"
        " -2 ,3,9223372036854775808,FALSE,2024-12-31,2024-01-01T10:00:00.25,true,2024-01-01 00:00:01,,\n"
        ",1e3,,,,,,,\"\",\"b, \"\"c\"\"\"\n",
    )
    assert types(checked.infer_schema(spark, path)) == {
        "whole": "bigint", "decimal": "double", "big": "double", "flag": "boolean", "day": "date", "at": "timestamp_ntz",
        "mixed": "string", "dates": "timestamp_ntz", "none": "string", "words": "string",
    }


def test_impossible_dates_are_text_and_late_rows_count(spark, scratch):
    path = put(scratch, "day,late\n2023-02-29,1\n" + "2024-01-01,2\n" * 30_000 + "2024-01-01,none\n")
    assert types(checked.infer_schema(spark, path)) == {"day": "string", "late": "string"}


def test_no_rows(spark, scratch):
    path = put(scratch, "a,b\n")
    assert types(checked.infer_schema(spark, path)) == {"a": "string", "b": "string"}
    empty = checked.read_csv_checked(spark, path)
    assert (empty.rows.count(), empty.rejects.count()) == (0, 0)


def test_types_of_the_role_files_are_duckdbs(spark, scratch):
    raw = warehouse(spark, "/root/testdata/sf0.001").raw
    for name in ("orders", "order_products_prior", "products", "aisles", "departments"):
        path = str(scratch / name)
        write_result_csv(getattr(raw, name), path)
        told = duckdb.sql(f"DESCRIBE SELECT * FROM read_csv_auto('{path}/*.csv', header=true, sample_size=-1)").fetchall()
        assert types(checked.infer_schema(spark, path)) == {row[0]: SPARK_NAMES[row[1]] for row in told}, name


masks = st.dictionaries(st.sampled_from("abc"), st.none() | st.integers(0, checked.ANY))


@settings(max_examples=60, deadline=None)
@given(st.lists(masks, min_size=1, max_size=3))
def test_masks_merge_in_any_order(parts):
    whole = checked.merged(*parts)
    assert all(checked.merged(*order) == whole for order in permutations(parts))
    assert checked.merged(checked.merged(*parts[:1]), *parts[1:]) == checked.merged(whole, whole) == whole


def test_masks_of_two_files_are_those_of_both(spark, scratch):
    put(scratch, "a,b\n1,x\n2,\n", "one.csv")
    put(scratch, "a,b\n1.5,\n,2\n", "two.csv")
    read = lambda name: checked.column_masks(spark.read.option("header", True).csv(f"{scratch}/{name}"))
    together = checked.merged(read("one.csv"), read("two.csv"))
    assert together == read("*.csv")
    assert types(checked.schema_of(together)) == {"a": "double", "b": "string"}


def test_rejects_hold_text_and_every_reason(spark, scratch):
    path = put(
        scratch,
        "name,id,price,broken_line\n"
        '"a ""q"", b",1,1.5,t\n'
        "a,1,1.5,t\n"
        "a,1,1.5,t\n"
        "c,x,dear,t\n"
        "d,3\n"
        "e,4,2,t,more\n"
        "f,,,\n"
        '"g, h",99999999999,1,t\n',
    )
    found = checked.read_csv_checked(spark, path, "price double, id int, name string")
    assert sorted(tuple(r) for r in found.rows.na.fill({"price": -1, "id": -1}).collect()) == [
        (-1.0, -1, "f"), (1.5, 1, "a"), (1.5, 1, "a"), (1.5, 1, 'a "q", b'),
    ]
    assert sorted((r.row_text, r.reason) for r in found.rejects.collect()) == [
        ('"g, h",99999999999,1,t', "id: '99999999999' is not int"),
        ("c,x,dear,t", "price: 'dear' is not double; id: 'x' is not int"),
        ("d,3", "too few or too many fields"),
        ("e,4,2,t,more", "too few or too many fields"),
    ]
    assert all(r.source.endswith("a.csv") for r in found.rejects.collect())
    # Counting needs no column; the lines are split whole all the same.
    assert (found.rows.count(), found.rejects.count()) == (4, 4)


def test_inferred_read_rejects_broken_lines_only(spark, scratch):
    found = checked.read_csv_checked(spark, put(scratch, "a,b\n1,2024-01-01\n2\nx,2024-01-02\n"))
    assert types(found.rows.schema) == {"a": "string", "b": "date"}
    assert (found.rows.count(), found.rejects.first().row_text) == (2, "2")


def test_quotes_survive_the_csv_sink(spark, scratch):
    texts = ['5" "plates", red', "back\\slash", '"', "a,b"]
    write_result_csv(spark.createDataFrame([(t,) for t in texts], "t string"), str(scratch / "out"))
    assert sorted(r.t for r in read_result_csv(spark, str(scratch / "out"), "t string").collect()) == sorted(texts)


def test_missing_column_is_an_error(spark, scratch):
    with pytest.raises(ValueError, match="lacks"):
        checked.read_csv_checked(spark, put(scratch, "a\n1\n"), "b int")


def test_load_survives_bad_rows_and_logs_them(spark, scratch):
    raw_dir, seed = write_f1_csv(scratch)
    with open(f"{raw_dir}/orders.csv", "a") as orders:
        orders.write("soon,1,prior,1,1,1,1\n7\n")
    paths = WarehousePaths(str(scratch / "wh"))
    with pytest.raises(Exception):
        run_stage(spark, csv_sources(spark, raw_dir, seed), WarehousePaths(str(scratch / "strict")), "bronze")
    run_stage(spark, csv_sources(spark, raw_dir, seed, bad_rows="reject"), paths, "all", with_quality=False)
    assert read_bronze_orders(spark, paths).count() == len(ORDERS)
    assert read_bronze_orders(spark, paths).schema == S.BRONZE_ORDERS
    assert read_log(spark, paths.log).where(F.col("status") == "SUCCESS").first().message == "OK, 2 raw rows rejected"
    assert sorted(r.row_text for r in _read(spark, paths, "bronze_rejects").collect()) == ["7", "soon,1,prior,1,1,1,1"]
    assert "bronze_rejects" in register_views(spark, paths)
    with pytest.raises(ValueError, match="bad_rows"):
        csv_sources(spark, raw_dir, seed, bad_rows="skip")
