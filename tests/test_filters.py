from shoplens.functions import filters as flt


def keep(spark, pred, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).filter(pred).collect()]


def test_age_needs_both_bounds(spark):
    data = [(1, 10), (2, 30), (3, None)]
    s = "id long, age int"
    assert keep(spark, flt.between_or_all("age", 20, None), data, s) == [1, 2, 3]
    assert keep(spark, flt.between_or_all("age", None, 40), data, s) == [1, 2, 3]
    assert keep(spark, flt.between_or_all("age", 20, 40), data, s) == [2]


def test_any_overlap(spark):
    data = [(1, "1,3"), (2, "4"), (3, None), (4, ""), (5, "-1"), (6, "12")]
    s = "id long, v string"
    assert keep(spark, flt.any_in("v", "1,2,5"), data, s) == [1]
    assert keep(spark, flt.any_in("v", ["12"]), data, s) == [6]
    assert keep(spark, flt.any_in("v", ""), data, s) == [1, 2, 3, 4, 5, 6]
    assert keep(spark, flt.any_in("v", None), data, s) == [1, 2, 3, 4, 5, 6]


def test_equal(spark):
    data = [(1, "male"), (2, "female"), (3, None)]
    s = "id long, sex string"
    assert keep(spark, flt.equal_or_all("sex", "female"), data, s) == [2]
    assert keep(spark, flt.equal_or_all("sex", None), data, s) == [1, 2, 3]


def test_area_level(spark):
    df = spark.createDataFrame([("华北",), ("华南",), ("西南",), ("东北",), (None,)], "a string")
    got = [r[0] for r in df.select(flt.area_level("a", flt.AREA_LEVELS_CN)).collect()]
    assert got == ["A", "B", "C", "D", "D"]
