import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from cabstar.operators.lineage import number_within


def _frame(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        # one hot file holding ~2/3 of the rows, a few small ones, some NULL file names
        f = "hot.parquet" if rnd.random() < 0.66 else rnd.choice(["a.parquet", "b.parquet", "c.parquet", None])
        rows.append((f, rnd.randint(0, 50), rnd.choice([None, 1.5, 2.5, 3.5]), i))
    return spark.createDataFrame(rows, "file string, k1 int, k2 double, uid int")


def test_matches_window_row_number(spark):
    df = _frame(spark)
    order = ["k1", "k2", "uid"]
    ours = number_within(df, "file", order, F.floor(F.col("k1") / 7), "rn").select("uid", "rn")
    w = Window.partitionBy("file").orderBy(*[F.col(c).asc_nulls_first() for c in order])
    brute = df.withColumn("rn", F.row_number().over(w)).select("uid", "rn")
    assert sorted(ours.collect()) == sorted(brute.collect())


def test_ties_get_a_permutation_of_numbers(spark):
    df = _frame(spark)
    ours = number_within(df, "file", ["k1"], F.col("k1"), "rn")
    got = ours.groupBy("file", "k1").agg(F.sort_array(F.collect_list("rn")).alias("rns"))
    w = Window.partitionBy("file").orderBy(F.col("k1").asc_nulls_first())
    brute = df.withColumn("rn", F.row_number().over(w)).groupBy("file", "k1").agg(
        F.sort_array(F.collect_list("rn")).alias("rns"))
    assert sorted(got.collect(), key=str) == sorted(brute.collect(), key=str)


def test_null_first_keys_come_first(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", -5, 2), ("a", None, 0), ("", 3, 3), (None, 2, 4)],
                               "file string, k1 int, uid int")
    ours = number_within(df, "file", ["k1", "uid"], F.floor(F.col("k1") / 2), "rn")
    assert sorted((r["uid"], r["rn"]) for r in ours.collect()) == [(0, 1), (1, 2), (2, 3), (3, 1), (4, 1)]


def test_hot_file_is_spread_over_tasks(spark):
    df = _frame(spark).repartition(16)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ours = number_within(df, "file", ["k1", "uid"], F.col("k1"), "rn")
        tasks = ours.where("file = 'hot.parquet'").groupBy(F.spark_partition_id()).count().count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert tasks >= 8


def test_rows_are_shuffled_once_and_nothing_runs_early(spark, scratch):
    _frame(spark).write.parquet(f"{scratch}/f")
    group = f"lineage-{scratch}"
    spark.sparkContext.setJobGroup(group, "build")
    df = spark.read.parquet(f"{scratch}/f")
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    ours = number_within(df, "file", ["k1", "uid"], F.floor(F.col("k1") / 7), "rn")
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) == before
    plan = ours._jdf.queryExecution().executedPlan().toString()
    # one exchange of the rows, one of the small counts, one for their running sum
    assert plan.count("Exchange hashpartitioning") <= 3
