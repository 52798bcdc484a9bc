"""One key holding a third of all rows."""

from conftest import plan_of
from pyspark.sql import functions as F

from tidemark.operators import keep_one_by_key
from tidemark.plans import gold
from tidemark.quality import ForeignKey, run_suite

ROWS = 9000


def hot_key(name):
    spread = F.col("id") % 1000 + 1
    return F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(spread).cast("bigint").alias(name)


def orders(spark):
    return spark.range(ROWS, numPartitions=4).select(
        F.col("id").alias("order_id"),
        hot_key("customer_id"),
        F.timestamp_seconds(F.col("id") % 5 * 86400).alias("order_timestamp"),
        F.lit("1.00").cast("decimal(14,2)").alias("total_amount"),
    )


def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")


def defaults(spark):
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def rows_through(df, operator):
    """Rows an operator of the executed plan put out, from its metrics."""
    stack, found = [df._jdf.queryExecution().executedPlan()], []
    while stack:
        node = stack.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            stack.append(node.executedPlan())
            continue
        if name.endswith("QueryStageExec"):
            stack.append(node.plan())
            continue
        if name == operator and node.metrics().contains("shuffleRecordsWritten"):
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        children = node.children()
        stack += [children.apply(i) for i in range(children.size())]
    return found


def test_hot_customer_brings_a_row_per_day_to_the_join(spark):
    customers = spark.range(1001).select(
        F.col("id").alias("customer_id"), F.lit("PK").alias("country_code")
    )
    no_broadcast(spark)
    try:
        sales = gold.daily_sales(orders(spark), customers)
        found = {str(r.order_date): r for r in sales.collect()}
    finally:
        defaults(spark)
    plan = plan_of(sales)
    assert plan.index("SortMergeJoin") < plan.rindex("partial_sum")
    assert sum(r.order_count for r in found.values()) == ROWS
    assert sum(r.total_revenue for r in found.values()) == ROWS
    # Of 3000 orders of the hot customer, at most one row per task and day is shuffled.
    assert max(rows_through(sales, "ShuffleExchangeExec")) < ROWS - 2000


def test_hot_parent_key_is_counted_once(spark):
    parents = spark.range(1, 1001).select(F.col("id").alias("key"))
    no_broadcast(spark)
    try:
        (result,) = run_suite(
            orders(spark), "orders", [ForeignKey("customer_id", parents, "key")]
        ).results
        orphans = ForeignKey("customer_id", parents, "key").orphan_rows(orders(spark))
        orphans.collect()
    finally:
        defaults(spark)
    assert result.metric_value == ROWS // 3
    assert max(rows_through(orphans, "ShuffleExchangeExec")) < ROWS - 2000


def test_copies_of_a_hot_key_stay_on_the_map_side(spark):
    df = orders(spark)
    latest = keep_one_by_key(df, ["customer_id"], [F.desc("order_timestamp"), "order_id"])
    assert latest.count() == df.select("customer_id").distinct().count()
    latest.collect()
    # No task sends more than one row for any of its keys.
    assert max(rows_through(latest, "ShuffleExchangeExec")) <= 4 * 1001
