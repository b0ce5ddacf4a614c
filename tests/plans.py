"""Reading physical plans."""


def final_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    """Shuffles in the physical plan, with broadcasts of small inputs turned off."""
    spark = df.sparkSession
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = final_plan(df.select("*"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    return plan.count("Exchange ")
