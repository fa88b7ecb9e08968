import math

import pytest

import plumbline as pl
from plumbline.sources.tables import feature_base, format_of, load_sample
from plumbline.staging import shared_folder


def test_csv_tokens_and_types(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text("k,a,b,c,d\nx,1,1.5,True,\nNA,NA,nan,False,\n,3,bad,,\n\"q,r\", 4 ,2e3,True,\n")
    df = pl.read_table(spark, str(path))
    assert dict(df.dtypes) == {"k": "string", "a": "bigint", "b": "string", "c": "boolean", "d": "double"}
    assert [tuple(r) for r in df.orderBy("a").collect()] == [
        (None, None, None, False, None),
        ("x", 1, "1.5", True, None),
        (None, 3, "bad", None, None),
        ("q,r", 4, "2e3", True, None),
    ]


def test_csv_types_of_mixed_cells(spark):
    """A column has the type of its widest cell; the cells are tested one by one, not per column."""
    from plumbline.sources.tables import infer_schema, kinds_of_columns

    columns = {
        "long": ["1", " 2 ", None], "whole": ["1", "1" * 30, "-7"], "double": ["1", "9" * 50, "Infinity"],
        "wide": ["9" * 50, "1", None], "suffix": ["1", "2d", "3"], "boolean": ["true", None, "FALSE"],
        "mixed": ["true", "1", None], "yes": ["1.5", "true", "2"], "text": ["x", "1", "2"], "none": [None, None, None],
        "special": ["-Infinity", "NaN", " 1e5"], "f": ["-inf", "1", "2"], "hex": ["0x1p3", "1", "2"],
    }
    df = spark.createDataFrame(list(zip(*columns.values())), ", ".join(f"`{c}` string" for c in columns))
    kinds = {f.name: f.dataType.simpleString() for f in infer_schema(df).fields}
    assert kinds == {
        "long": "bigint", "whole": "decimal(38,0)", "double": "double", "wide": "double", "suffix": "string",
        "boolean": "boolean", "mixed": "string", "yes": "string", "text": "string", "none": "double",
        "special": "double", "f": "string", "hex": "double",
    }
    assert {f.dataType.simpleString() for f in infer_schema(df.limit(0)).fields} == {"double"}
    patterns = [
        spark._jvm.PythonSQLUtils.explainString(kinds_of_columns(d)._jdf.queryExecution(), "simple").count("RLIKE")
        for d in (df, df.select("long"))
    ]
    assert patterns[0] == patterns[1] > 0


def test_csv_with_schema_nulls_bad_cells(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text("k,a,b\nx,1,1.5\ny,oops,NaN\nN/A,3,inf\n")
    df = pl.read_table(spark, str(path), schema="k string, a int, b double").orderBy("a")
    assert [tuple(r) for r in df.collect()] == [("y", None, None), ("x", 1, 1.5), (None, 3, math.inf)]


def test_csv_line_breaks_and_long_numbers(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text(
        'id,huge,s\n1234567890123456789,12345678901234567890123,"two\nlines, ""quoted"""\n'
        "1234567890123456788,7,plain\n"
    )
    df = pl.read_table(spark, str(path))
    assert dict(df.dtypes) == {"id": "bigint", "huge": "decimal(38,0)", "s": "string"}
    rows = [(r["id"], int(r["huge"]), r["s"]) for r in df.orderBy("id").collect()]
    assert rows == [
        (1234567890123456788, 7, "plain"),
        (1234567890123456789, 12345678901234567890123, 'two\nlines, "quoted"'),
    ]


@pytest.mark.parametrize("row", ["3,4,5", "3"])
@pytest.mark.parametrize("schema", [None, "a int, b int"])
def test_csv_row_of_another_length_is_an_error(spark, tmp_path, row, schema):
    path = tmp_path / "raw.csv"
    path.write_text(f"a,b\n1,2\n{row}\n")
    with pytest.raises(Exception, match="MALFORMED|Malformed|FAILFAST"):
        pl.read_table(spark, str(path), schema=schema).select("a").collect()


def test_failed_write_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    pl.write_table(spark.range(3), path)
    with pytest.raises(Exception):
        pl.write_table(spark.range(3).selectExpr("raise_error('no') as id"), path)
    assert pl.read_table(spark, path).count() == 3
    pl.write_table(pl.read_table(spark, path).filter("id < 1"), path)
    assert pl.read_table(spark, path).count() == 1


def test_unknown_format():
    assert format_of("a/b.csv") == "csv"
    with pytest.raises(ValueError):
        format_of("a/b.hdf")


def test_unknown_sample(spark):
    assert load_sample(spark, "/root/testdata/sf0.001", "part").count() == 200
    with pytest.raises(ValueError):
        load_sample(spark, "/root/testdata/sf0.001", "boston")


def test_write_replaces(spark, tmp_path):
    path = str(tmp_path / "t.csv")
    pl.write_table(spark.range(5).toDF("a"), path)
    pl.write_table(spark.range(2).toDF("a"), path)
    assert pl.read_table(spark, path).count() == 2


def test_stage_folder_names(tmp_path):
    folders = pl.StageFolders(str(tmp_path), "csv")
    assert folders.path("raw", "x").endswith("/raw/x.csv")
    with pytest.raises(ValueError):
        folders.path("other", "x")


def test_feature_sets_keep_rows_together(spark, tmp_path):
    rows = [(1, "a", 2.0, 3.0, 10.0), (2, "b", 4.0, None, None), (3, "a", 5.0, 6.0, 30.0)]
    df = spark.createDataFrame(rows, "id int, k string, p double, q double, y double")
    spec = pl.TableSpec("y", "numerical", ("k",), key=("id",))
    for fmt in ("parquet", "csv"):
        paths = pl.write_feature_sets(df, spec, str(tmp_path / fmt), fmt)
        poly = pl.read_table(spark, paths["poly2"], fmt).orderBy("id")
        assert poly.columns == ["id", "y", "k", "p", "q", "p^2", "p q", "q^2"]
        assert [tuple(r)[3:] for r in poly.collect()] == [(2, 3, 4, 6, 9), (5, 6, 25, 30, 36)]
        poly1 = pl.read_table(spark, paths["poly1"], fmt)
        assert poly1.columns == ["id", "y", "k", "p", "q", "p q"]


def test_feature_base_runs_registered_functions(spark):
    from plumbline.operators.cleaning import FEATURIZERS

    @pl.featurizer
    def doubled(df):
        return df.withColumn("p2", df["p"] * 2)

    try:
        df = spark.createDataFrame([(1.0, 2.0, 0.0), (3.0, None, 0.0)], "p double, y double, junk double")
        out = feature_base(df, pl.TableSpec("y", "numerical", drop_cols=("junk",)))
        assert [tuple(r) for r in out.collect()] == [(1.0, 2.0, 2.0)]
    finally:
        del FEATURIZERS["doubled"]


def test_mapping_keeps_missing_category(spark, tmp_path):
    df = spark.createDataFrame([("b",), (None,), ("a",)], "k string")
    mapping = pl.fit_categories(df, "k")
    pl.write_mapping(mapping, str(tmp_path / "m"))
    back = pl.read_mapping(spark, str(tmp_path / "m"))
    assert sorted(map(tuple, back.collect()), key=lambda r: r[2]) == [("k", "a", 1), ("k", "b", 2), ("k", None, 3)]
    assert [r["k"] for r in pl.OrdinalEncoder("k").use(back).apply(df).collect()] == [2, 3, 1]


def test_shared_folder_is_the_session_setting(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
