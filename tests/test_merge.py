from shoplens.operators.merge import append_distinct, merge_add, merge_overwrite, replace_groups

S = "k string, g string, click_count long"


def _set(df):
    return sorted(tuple(r) for r in df.collect())


def test_merge_add(spark):
    t = spark.createDataFrame([("a", "x", 1), ("b", "x", 2)], S)
    b = spark.createDataFrame([("b", "x", 5), ("c", "y", 1)], S)
    assert _set(merge_add(t, b, ["k", "g"])) == [("a", "x", 1), ("b", "x", 7), ("c", "y", 1)]
    assert _set(merge_add(t, b.limit(0), ["k", "g"])) == _set(t)
    assert _set(merge_add(t.limit(0), b, ["k", "g"])) == _set(b)


def test_merge_add_is_associative_over_batch_splits(spark):
    rows = [("a", "x", 1), ("b", "x", 2), ("a", "x", 3), ("c", "y", 4)]
    whole = merge_add(spark.createDataFrame([], S), spark.createDataFrame(rows, S), ["k", "g"])
    step = spark.createDataFrame([], S)
    for r in rows:
        step = merge_add(step, spark.createDataFrame([r], S), ["k", "g"])
    assert _set(whole) == _set(step)


def test_merge_overwrite(spark):
    t = spark.createDataFrame([("a", "x", 1), ("b", "x", 2)], S)
    b = spark.createDataFrame([("b", "x", 5), ("c", "y", 1)], S)
    assert _set(merge_overwrite(t, b, ["k", "g"])) == [("a", "x", 1), ("b", "x", 5), ("c", "y", 1)]


def test_replace_groups(spark):
    t = spark.createDataFrame([("a", "x", 1), ("b", "x", 2), ("c", "y", 3)], S)
    b = spark.createDataFrame([("d", "x", 9)], S)
    assert _set(replace_groups(t, b, ["g"])) == [("c", "y", 3), ("d", "x", 9)]


def test_append_distinct(spark):
    t = spark.createDataFrame([(1,)], "user_id long")
    b = spark.createDataFrame([(1,), (2,), (2,)], "user_id long")
    assert _set(append_distinct(t, b, ["user_id"])) == [(1,), (2,)]
