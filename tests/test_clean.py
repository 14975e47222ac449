import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from tierline.operators import clean


def test_dedupe_keep_min_id_equals_row_number(spark):
    rows = [(5, "a", None), (3, "a", None), (None, "a", None), (7, "b", 1), (None, "c", 2), (None, "c", 2),
            (2, None, None), (1, None, None)]
    df = spark.createDataFrame(rows, "id int, s string, v int")
    w = Window.partitionBy("s", "v").orderBy(F.col("id").asc_nulls_last())
    ref = df.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")
    got = clean.dedupe_keep_min_id(df, "id")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, ref.collect()), key=str)
    assert clean.dedupe_keep_min_id(df.drop("id"), "id").count() == 4


def test_fill_with_mean(spark):
    df = spark.createDataFrame([(1, 2.0, "a"), (None, None, "b"), (3, 4.0, None)], "i int, x double, s string")
    got = clean.fill_with_mean(df).collect()
    assert [r.i for r in got] == [1.0, 2.0, 3.0]
    assert [r.x for r in got] == [2.0, 3.0, 4.0]
    assert [r.s for r in got] == ["a", "b", None]


def test_drop_nulls(spark):
    df = spark.createDataFrame([(1, None), (None, "a"), (2, "b")], "i int, s string")
    assert clean.drop_null_rows(df).count() == 1
    assert clean.drop_null_rows(df, ["s"]).count() == 2


def test_parse_timestamp_and_sample(spark):
    df = spark.createDataFrame([(1, "2010-02-03 00:00:00"), (2, "bad"), (3, None)], "id int, d string")
    got = [r.d for r in clean.parse_timestamp(df, "d").orderBy("id").collect()]
    assert str(got[0]) == "2010-02-03 00:00:00" and got[1] is None and got[2] is None
    big = spark.range(50).withColumnRenamed("id", "k")
    s1 = [r.k for r in clean.hash_sample(big, "k", 10).collect()]
    s2 = [r.k for r in clean.hash_sample(big, "k", 10).collect()]
    assert s1 == s2 and len(s1) == 10
    import hashlib
    assert s1 == sorted(range(50), key=lambda k: hashlib.md5(str(k).encode()).hexdigest())[:10]
    assert clean.hash_sample(big.where("k < 0"), "k", 10).count() == 0
    assert clean.hash_sample(big, "k", 1000).count() == 50


def test_pandas_duplicates_semantics(spark):
    rows = [(1, "a"), (1, "a"), (2, "b")]
    df = spark.createDataFrame(rows, "i int, s string")
    assert clean.drop_duplicate_rows(df).count() == len(pd.DataFrame(rows).drop_duplicates())
