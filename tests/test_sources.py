import pytest

from dimflow.operators import cleaning, quality
from dimflow.operators.access import column_policy, row_policy
from dimflow.sources import readers, tables
from dimflow.sources.storage import shared_root, work_dir
from dimflow.spec import PipelineSpec, SourceSpec
from tests.conftest import rows


def test_csv_edges(spark, tmp_path):
    path = tmp_path / "edges.csv"
    path.write_text('id,name,department,salary\n1," a  b ",IT,abc\nx,c,IT,1\n2,d\n3,e,HR,5,extra\n4,"",IT,60000.7\n5,f,,99999999999\n')
    raw = readers.read_csv(spark, str(path))
    assert {t for _, t in raw.dtypes} == {"string"}
    spec = PipelineSpec("edges", SourceSpec("csv", str(path)), "staging.edges", "target.edges")
    assert sorted(map(str, rows(cleaning.clean(raw, spec)))) == sorted(map(str, [
        (1, "A  B", "IT", None), (2, "D", None, 0), (3, "E", "HR", 5), (4, None, "IT", 60000), (5, "F", None, None)]))
    with pytest.raises(ValueError, match="lacks"):
        cleaning.clean(raw.drop("salary"), spec)


def test_corrupt_lines(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("id,n\n1,2\n3,x\n")
    raw = readers.read_csv(spark, str(path), schema="id INT, n INT, _corrupt_record STRING",
                           columnNameOfCorruptRecord="_corrupt_record")
    good, bad = quality.split_corrupt(raw)
    assert rows(good) == [(1, 2)] and rows(bad) == [(3, None, "3,x")]


def test_dispatch(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id INT, name STRING")
    for kind, write in {"csv": lambda p: df.write.option("header", True).csv(p),
                        "tsv": lambda p: df.write.options(header=True, sep="\t").csv(p),
                        "json": df.write.json, "parquet": df.write.parquet, "orc": df.write.orc,
                        "xml": lambda p: df.write.option("rowTag", "row").xml(p)}.items():
        path = str(tmp_path / kind)
        write(path)
        found = readers.read_source(spark, SourceSpec(kind, path, schema="id INT, name STRING"))
        assert rows(found) == [(1, "a"), (2, "b")], kind
    piped = str(tmp_path / "piped")
    df.write.options(header=True, sep="|").csv(piped)
    assert rows(readers.read_source(spark, SourceSpec("txt", piped, {"sep": "|"}))) == [("1", "a"), ("2", "b")]
    df.createOrReplaceTempView("dispatch_rows")
    text = SourceSpec("sql", "SELECT name FROM dispatch_rows WHERE id = :wanted", {"wanted": 2})
    assert rows(readers.read_source(spark, text)) == [("b",)]
    with pytest.raises(ValueError, match="unknown file type"):
        readers.read_source(spark, SourceSpec("xlsx", "x"))


def test_profile(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id INT, name STRING")
    assert rows(readers.describe_source(df)) == [(0, "id", "int", True), (1, "name", "string", True)]
    assert rows(readers.profile_source(df)) == [(0, "id", "int", 2, 0), (1, "name", "string", 2, 1)]
    assert readers.preview(df, 1).count() == 1


def test_table_sinks(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id INT, name STRING")
    for _ in range(2):
        stored = tables.overwrite_table(df, "staging.sinks")
    assert rows(stored) == [(1, "a"), (2, "b")]
    # files left without a table do not stand in the way
    spark.sql("DROP TABLE staging.sinks")
    assert tables.overwrite_table(df, "staging.sinks").count() == 2
    tables.append_table(df.select("name", "id"), "staging.sinks")
    assert rows(tables.read_table(spark, "staging.sinks")) == [(1, "a"), (1, "a"), (2, "b"), (2, "b")]
    assert tables.validate_readback(df, "staging.sinks").first().equal is False
    assert tables.validate_readback(df.union(df), "staging.sinks").first().equal is True
    assert tables.create_typed_table(spark, "staging.sinks", df.schema).count() == 0


def test_single_file_export(spark, tmp_path):
    df = spark.range(100).repartition(4)
    one, many = str(tmp_path / "one.csv"), str(tmp_path / "many.csv")
    tables.export_csv(df, one, single_file=True)
    tables.export_csv(df, many)
    assert len(list((tmp_path / "one.csv").glob("part-*"))) == 1 < len(list((tmp_path / "many.csv").glob("part-*")))
    assert readers.read_csv(spark, one).count() == readers.read_csv(spark, many).count() == 100


def test_rules(spark):
    df = spark.createDataFrame([(1, 5, "ab", "x"), (2, None, None, None), (3, 50, "Ab", "z")], "id INT, n INT, s STRING, c STRING")
    rules = [quality.not_null("n"), quality.in_range("n", 1, 10), quality.matches("s", "^[a-z]+$"), quality.in_set("c", ["x", "y"]),
             quality.in_range("id", low=2)]
    found = {r.id: r.violations for r in quality.validate(df, rules).collect()}
    assert found == {1: ["id_range"], 2: ["n_not_null"], 3: ["n_range", "s_regex", "c_in_set"]}
    with pytest.raises(ValueError):
        quality.validate(df, [quality.Rule("x", "odd", "n")])
    with pytest.raises(ValueError):
        quality.in_range("n")


def test_nulls_and_tables(spark):
    df = spark.createDataFrame([(1, None, None), (None, "a", None), (2, "b", 1.0)], "i INT, s STRING, d DOUBLE")
    assert rows(cleaning.handle_nulls(df, {"s": "?"}, drop_any=["i"])) == [(1, "?", None), (2, "b", 1.0)]
    assert rows(cleaning.handle_nulls(df, drop_all=["s", "d"])) == [(2, "b", 1.0), (None, "a", None)]
    assert cleaning.drop_duplicates(df.union(df)).count() == 3 and cleaning.drop_duplicates(df.union(df), ["i"]).count() == 3
    codes = spark.createDataFrame([("a", "Alpha")], "code STRING, label STRING")
    assert rows(cleaning.map_codes(df, "s", codes, "code", "label", "t").select("s", "t")) == [("a", "Alpha"), ("b", "b"), (None, None)]
    factors = spark.createDataFrame([("b", 2.0, 1.0)], "unit STRING, factor DOUBLE, offset DOUBLE")
    assert rows(cleaning.convert_unit(df, "i", "s", factors, "v").select("s", "v")) == [("a", None), ("b", 5.0), (None, None)]


def test_policies(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id INT, dept STRING")
    grants = spark.createDataFrame([("ann", "a"), ("ann", "a"), ("bob", "b")], "principal STRING, dept STRING")
    assert rows(row_policy(df, grants, "dept", "ann")) == [(1, "a")]
    assert row_policy(df, grants, "dept", "eve").count() == 0
    assert column_policy(df, {"r": {"id": "clear"}}, "r").columns == ["id"]
    with pytest.raises(ValueError):
        column_policy(df, {"r": {"id": "open"}}, "r")


def test_shared_folder(spark):
    assert work_dir(spark, "x").startswith(shared_root(spark)) and work_dir(spark, "x") != work_dir(spark, "x")


def test_xml_files_are_bounded(spark, tmp_path):
    df = spark.range(10).selectExpr("CAST(id AS INT) AS id", "concat('n', id) AS name").coalesce(1)
    path = tables.write_xml(df, str(tmp_path / "xml"), "row", rows_per_file=4)
    found = readers.read_source(spark, SourceSpec("xml", path, schema="id INT, name STRING"))
    assert len(found.inputFiles()) == 3 and rows(found) == [(i, f"n{i}") for i in range(10)]
