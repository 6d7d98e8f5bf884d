from datetime import date

import pytest

from dimflow.plans.pipeline import run_pipelines
from dimflow.plans.rejects import reject_counts, rejected
from dimflow.spec import PipelineSpec, SourceSpec, check_specs
from tests.conftest import rows


def spec(path, name, **more):
    return PipelineSpec(name, SourceSpec("csv", str(path)), f"staging.{name}", f"target.{name}", **more)


def test_rejects_by_day_and_rerun(spark, tmp_path):
    file = tmp_path / "in.csv"
    own = spec(file, "rejecting", rejects_table="staging.rejecting_rejects")
    run = lambda day: run_pipelines(spark, [own], str(tmp_path / "out"), day)
    file.write_text("id,name,department,salary\n1,a,IT,1\n,b,IT,2\nzz,c,,3\nzz,c,,3\n")
    run("2024-01-01")
    stored = rows(spark.table(own.rejects_table))
    assert [(r[1], r[2], r[4]) for r in stored] == [
        ("zz", "key is no int", date(2024, 1, 1)), ("zz", "key is no int", date(2024, 1, 1)),
        (None, "key is missing", date(2024, 1, 1))]
    assert stored[0][3] == '{"id":"zz","name":"c","department":null,"salary":"3"}'
    # another day, with another column; then the first day again, mended
    file.write_text("id,name,department,salary,extra\n2,a,IT,1,x\nqq,b,IT,2,y\n")
    run("2024-01-02")
    assert rows(reject_counts(spark, own.rejects_table)) == [
        ("rejecting", date(2024, 1, 1), "key is missing", 1), ("rejecting", date(2024, 1, 1), "key is no int", 2),
        ("rejecting", date(2024, 1, 2), "key is no int", 1)]
    file.write_text("id,name,department,salary\n1,a,IT,1\n")
    run("2024-01-01")
    assert rows(reject_counts(spark, own.rejects_table)) == [("rejecting", date(2024, 1, 2), "key is no int", 1)]


def test_rejected_and_loaded_are_all_rows(spark):
    raw = spark.createDataFrame([("1", "a"), ("1.5", "b"), ("", "c"), (None, "d"), ("99999999999", "e"), (" 7 ", "f")],
                                "id STRING, name STRING")
    from dimflow.operators.cleaning import clean
    own = spec("x", "both", int_defaults={}, tracked=("name",))
    lost = rejected(raw, own).selectExpr("get_json_object(source_row, '$.name')")
    assert sorted([r[0] for r in lost.collect()] + [r.name.lower() for r in clean(raw, own).collect()]) == list("abcdef")
    assert rejected(raw, spec("x", "text", key_type="string", int_defaults={}, tracked=("name",))).count() == 1


def test_rejects_tables_are_checked():
    with pytest.raises(ValueError, match="database.name"):
        check_specs([spec("x", "one", rejects_table="nodatabase")])
    with pytest.raises(ValueError, match="used twice"):
        check_specs([spec("x", "one", rejects_table="a.b"), spec("x", "two", rejects_table="a.b")])
    check_specs([spec("x", "one"), spec("x", "two")])
