"""Dictionary encoding: dense codes in value order whatever the layout, round trip, nulls, and the category rule."""

from tickerloom.sources import dictionary


def test_round_trip_and_rule(spark):
    rows = [(i, ["b", "a", "c", None][i % 4], f"unique {i}") for i in range(400)]
    df = spark.createDataFrame(rows, "id long, kind string, note string")
    for layout in (df.repartition(1), df.repartition(7, "id")):
        encoded, tables = dictionary.encode(layout)
        assert set(tables) == {"kind"}  # note has a value per row: left as text
        assert "note" in encoded.columns and "kind" not in encoded.columns
        codes = {r.value: r.code for r in tables["kind"][0].collect()}
        assert codes == {"a": 0, "b": 1, "c": 2}
        got = {r.id: r.kind_code for r in encoded.collect()}
        assert got[3] is None and got[0] == 1 and got[1] == 0
        back = dictionary.decode(encoded, tables).select("id", "kind", "note")
        assert sorted(back.collect()) == sorted(df.collect())
    assert dict(encoded.dtypes)["kind_code"] == "tinyint"


def test_empty_table(spark):
    empty = spark.createDataFrame([], "id long, kind string")
    encoded, tables = dictionary.encode(empty)
    assert tables == {} and encoded.count() == 0
