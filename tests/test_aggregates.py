from pyspark.sql import functions as F

from tidemark.functions.aggregates import Aggregate, user_aggregate


def test_user_aggregate_combines_before_the_shuffle(spark, rows):
    class DistinctUsers(Aggregate):
        def create(self):
            return set()

        def add(self, acc, rows):
            return acc | set(rows["user"])

        def merge(self, a, b):
            return a | b

        def result(self, acc):
            return (len(acc),)

    df = spark.range(0, 3000, 1, 3).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 7).alias("k"),
        (F.col("id") % 11).alias("user"))
    want = rows(df.groupBy("k").agg(F.countDistinct("user")))
    for max_keys in (2, 1000):
        got = user_aggregate(df, ["k"], ["user"], DistinctUsers(), "uv long", max_keys)
        assert rows(got) == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.index("FlatMapGroupsInPandas") < plan.index("Exchange") < plan.index("MapInPandas")
