import hashlib
import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from dimflow.operators.access import create_secure_view
from dimflow.plans.dimension_table import load_number
from dimflow.plans.pipeline import apply_scd, history_table, run_pipelines
from dimflow.sources.tables import overwrite_table
from dimflow.spec import PipelineSpec, SourceSpec, add_spec, check_specs, parse_specs
from tests.conftest import rows


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def employee_file(tmp_path):
    path = tmp_path / "employee.csv"
    path.write_text("id,name,department,salary\n1,john doe,IT,50000\n2,jane smith,HR,60000\n"
                    "3,robert brown,Finance,70000\n4,,IT,\n")
    return str(path)


def test_golden_extract(spark, tmp_path):
    spec = PipelineSpec.register("employee_pipeline", employee_file(tmp_path))
    for single in (True, False):  # a second run changes nothing
        out = run_pipelines(spark, [spec], str(tmp_path / "out"), "2026-03-27", single)["employee_pipeline"]
        extract = spark.read.option("header", True).csv(out)
        assert extract.columns == ["id", "name_masked", "department", "salary_hash", "start_date"]
        assert rows(extract) == [
            ("1", "****", "IT", sha("50000"), "2026-03-27"), ("2", "****", "HR", sha("60000"), "2026-03-27"),
            ("3", "****", "Finance", sha("70000"), "2026-03-27"), ("4", "****", "IT", sha("0"), "2026-03-27")]
    assert rows(spark.table("staging.employee_pipeline"))[3] == (4, None, "IT", 0)


STEPS = [
    ("2024-01-01", [(1, "Ann", "IT", 10), (2, "Bob", "HR", 20), (3, "Cid", None, 30)]),
    ("2024-01-02", [(1, "Ann", "IT", 10), (2, "Bob", "OPS", 25), (4, "Dan", "IT", 40)]),
    ("2024-01-03", [(2, "Bob", "OPS", 30), (3, "Cid", "HR", 30)]),
]
SCHEMA = "id INT, name STRING, department STRING, salary INT"


def load_all(spark, scd_type, name, twice=False, load=None):
    spec = PipelineSpec(name, SourceSpec("csv", "unused"), f"staging.{name}", f"target.{name}", scd_type, load=load)
    for day, batch in STEPS:
        for _ in range(2 if twice else 1):
            staged = overwrite_table(spark.createDataFrame(batch, SCHEMA), spec.staging_table)
            dim = apply_scd(staged, spec, day)
    return spec, dim


@pytest.mark.parametrize("twice", [False, True])
def test_type2_history(spark, twice):
    spec, dim = load_all(spark, 2, f"hist2_{int(twice)}", twice)
    d = date.fromisoformat
    expected = [
        (1, "Ann", "IT", 10, d("2024-01-01"), None, True),
        (2, "Bob", "HR", 20, d("2024-01-01"), d("2024-01-02"), False),
        (2, "Bob", "OPS", 25, d("2024-01-02"), d("2024-01-03"), False),
        (2, "Bob", "OPS", 30, d("2024-01-03"), None, True),
        (3, "Cid", None, 30, d("2024-01-01"), d("2024-01-03"), False),
        (3, "Cid", "HR", 30, d("2024-01-03"), None, True),
        (4, "Dan", "IT", 40, d("2024-01-02"), None, True)]
    assert rows(dim.drop("hash")) == sorted(expected, key=lambda r: tuple((x is None, str(x)) for x in r))
    assert dim.columns == ["id", "name", "department", "salary", "start_date", "end_date", "is_current", "hash"]
    assert load_number(spark, spec.target_table) == (6 if twice else 3)


def test_type6_shows_newest_on_all_versions(spark):
    _, dim = load_all(spark, 6, "hist6")
    found = rows(dim.filter("id = 2").orderBy("start_date")
                 .select("salary", "current_salary", "prev_salary", "current_department", "prev_department"))
    assert found == sorted([(20, 30, None, "OPS", None), (25, 30, 20, "OPS", "HR"), (30, 30, 25, "OPS", "OPS")],
                           key=lambda r: tuple((x is None, str(x)) for x in r))


def test_other_types(spark):
    _, dim = load_all(spark, 0, "hist0", True)
    assert rows(dim) == [(1, "Ann", "IT", 10), (2, "Bob", "HR", 20), (3, "Cid", None, 30), (4, "Dan", "IT", 40)]
    _, dim = load_all(spark, 1, "hist1")
    assert rows(dim.drop("hash")) == [(2, "Bob", "OPS", 30), (3, "Cid", "HR", 30)]
    _, dim = load_all(spark, 1, "hist1m", True, "merge")
    assert rows(dim.drop("hash")) == [(1, "Ann", "IT", 10), (2, "Bob", "OPS", 30), (3, "Cid", "HR", 30),
                                      (4, "Dan", "IT", 40)]
    _, dim = load_all(spark, 3, "hist3", True)
    assert rows(dim.select("id", "salary", "prev_salary", "department", "prev_department")) == [
        (1, 10, None, "IT", None), (2, 30, 25, "OPS", "HR"), (3, 30, None, "HR", None), (4, 40, None, "IT", None)]
    spec, dim = load_all(spark, 4, "hist4", True)
    assert rows(dim.drop("hash"))[1] == (2, "Bob", "OPS", 30)
    old = spark.table(history_table(spec)).select("id", "department", "salary", F.col("valid_to").cast("string"))
    assert rows(old) == [(2, "HR", 20, "2024-01-02"), (2, "OPS", 25, "2024-01-03"), (3, None, 30, "2024-01-03")]


def test_reload_keeps_no_history(spark):
    spec = PipelineSpec("again", SourceSpec("csv", "unused"), "staging.again", "target.again", 2, load="reload")
    for day, batch in STEPS:
        dim = apply_scd(overwrite_table(spark.createDataFrame(batch, SCHEMA), spec.staging_table), spec, day)
    assert rows(dim.select("id", F.col("start_date").cast("string"), "is_current")) == [
        (2, "2024-01-03", True), (3, "2024-01-03", True)]


def test_repeated_keys_are_not_merged(spark):
    spec = PipelineSpec("rep", SourceSpec("csv", "unused"), "staging.rep", "target.rep")
    with pytest.raises(ValueError, match="more than once"):
        apply_scd(spark.createDataFrame([(1, "A", "B", 1), (1, "A", "C", 1)], SCHEMA), spec)


def test_failed_load_leaves_the_dimension(spark, monkeypatch):
    spec, dim = load_all(spark, 2, "crash")
    before = rows(dim)
    staged = overwrite_table(spark.createDataFrame([(1, "Ann", "HR", 11)], SCHEMA), spec.staging_table)
    from dimflow.plans import dimension_table
    monkeypatch.setattr(dimension_table, "_select", lambda *a: 1 / 0)  # stop after the rows are written
    with pytest.raises(ZeroDivisionError):
        apply_scd(staged, spec, "2024-01-04")
    monkeypatch.undo()
    assert rows(spark.table(spec.target_table)) == before
    # the next try is another batch: nothing of the failed one may show
    staged = overwrite_table(spark.createDataFrame([(1, "Ann", "OPS", 12)], SCHEMA), spec.staging_table)
    dim = apply_scd(staged, spec, "2024-01-04")
    assert rows(dim.filter("id = 1 AND is_current").select("department", "salary")) == [("OPS", 12)]
    assert dim.count() == len(before) + 1 and dim.filter("id = 1 AND is_current").count() == 1


def test_current_readers_do_not_plan_history(spark, capsys):
    spec, dim = load_all(spark, 2, "pruned")
    view = create_secure_view(spark, spec)
    spark.table(view).explain("formatted")
    plan = capsys.readouterr().out
    # one scan, of the current partition, without names and technical columns
    assert plan.count("Scan parquet") == 2 and "Union" not in plan  # in the tree and in the details
    assert "ReadSchema: struct<id:int,department:string,salary:int,start_date:date>" in plan
    assert re.search(r"PartitionFilters: \[.*load#\d+ = 3.*is_current#\d+", plan)


def test_files_left_by_a_lost_catalog_do_not_matter(spark):
    spec, _ = load_all(spark, 2, "lost")
    spark.sql(f"DROP VIEW {spec.target_table}")
    spark.sql(f"DROP TABLE {spec.target_table}__loads")
    dim = apply_scd(spark.table(spec.staging_table), spec, "2024-01-09")
    assert rows(dim.select("id", "is_current")) == [(2, True), (3, True)]


def test_specs():
    text = """
pipelines:
- pipeline_name: a
  scd_type: 1
  pii_columns: [name]
  source: {file_type: csv, path: /x}
  staging_table: staging.a
  target_table: target.a_dim
"""
    (spec,) = parse_specs(text)
    assert spec.scd_type == 1 and spec.pii_columns == ("name",) and spec.view_name == "warehouse.a_vw"
    assert PipelineSpec.register("b", "/y").target_table == "target.b_dim"
    with pytest.raises(ValueError, match="used twice"):
        add_spec([spec], spec)
    for bad in ({"scd_type": 5}, {"staging_table": "x; DROP"}, {"pipeline_name": ""}, {"load": "never"}):
        with pytest.raises(ValueError):
            check_specs([PipelineSpec.from_dict({**spec.__dict__, **bad})])
    assert parse_specs("") == []
