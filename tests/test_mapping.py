import pytest
from pyspark.sql import functions as F

from fieldloom.operators import columns, mapping
from fieldloom.operators.mapping import Target


def test_apply_map(spark):
    df = spark.createDataFrame([("a", None, "x", "u"), (None, "b", "y", "v")], "one string, two string, three string, four string")
    found = {"one": Target("collection", "scientific_name", ("two", "missing")), "two": Target("collection", "scientific_name"), "three": Target("assembly", "n")}
    out = mapping.apply_map(df, found, "src")
    assert out.columns == ["collection", "assembly", "unmapped"]
    assert out.schema["collection"].dataType.names == ["scientific_name", "scientific_name_1"]
    assert [tuple(r.collection) for r in out.collect()] == [("a", None), ("b", "b")]
    assert out.schema["unmapped"].dataType.names == ["src_four"]
    assert out.count() == df.count()


def test_entity_id_is_null_with_its_column(spark):
    df = spark.createDataFrame([("a",), (None,)], "n string")
    out = mapping.convert(df, {"n": Target("assembly", "scientific_name")}, "D", event="assembly")
    assert [r.collection.entity_id for r in out.collect()] == ["Da", None]
    with pytest.raises(ValueError):
        mapping.convert(df, {}, "D")


def test_legacy_sheet(spark):
    rows = [(1, "Scientific Name", "a, b::x (note), c", None), (2, "Other", '"quoted', "0"), (3, "X", "/path", " "), (4, "taxonID", "nan", "a::y"), (5, "Proj", "PRJ thing", None)]
    sheet = spark.createDataFrame(rows, "row int, `Field Name` string, `T1 Collection` string, `T8 Record` string")
    out = {r.old: (r.event, r.new, list(r.fallbacks)) for r in mapping.compile_sheet(sheet, "row", prefixes=("PRJ",)).collect()}
    assert out == {"a": ("accession", "taxon_id", [])}  # columns go by their place; a later event wins for an equal key
    first = mapping.compile_sheet(sheet.filter("row = 1"), "row").first()
    assert (first.old, first.event, first.new, first.fallbacks) == ("a", "collection", "_scientific__name", ["b", "c"])
    assert mapping.LEGACY_EVENTS[2] == "sample prep" and mapping.LEGACY_EVENTS[7] == "record level"


def test_modern_sheet(spark):
    rows = [(1, "collection", "n", " a ; b"), (2, " ", "m", "c"), (3, "collection", "k", '"d'), (4, None, "k", "e")]
    sheet = spark.createDataFrame(rows, "row int, event string, schema_label string, src string")
    assert [tuple(r) for r in mapping.compile_modern(sheet, "src", "row").collect()] == [("a", "collection", "n", ["b"])]


def test_names(spark):
    assert [columns.snake_name(n) for n in ("taxonID", "ABCDef", "Genus", "already_snake")] == ["taxon_id", "_abcdef", "_genus", "already_snake"]
    df = spark.createDataFrame([(1, None)], "`A b` int, C int")
    assert columns.underscore_columns(df).columns == ["A_b", "C"]
    assert columns.lower_columns(df).columns == ["a b", "c"]
    assert columns.drop_empty_columns(df).columns == ["A b"]
    assert columns.drop_any_null_columns(df).columns == ["A b"]
    assert columns.keep(df, ["C", "x"]).columns == ["C"]
    assert columns.align(df, ["C", "x"]).columns == ["C", "x"]
    with pytest.raises(ValueError):
        columns.drop_strict(df, ["x"])
    assert columns.right_only(df, df.withColumn("z", F.lit(1)).withColumn("y", F.lit(2)), ["C"]).columns == ["C", "y", "z"]
    assert columns.transposed(df).count() == 1
    assert columns.cast(spark.createDataFrame([("1",), ("x",)], "a string"), {"a": "long"}).collect()[1].a is None
