"""Local Spark session for tests and benchmarks."""

from pyspark.sql import SparkSession


def local_session(cores="8", **conf):
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tenura")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(cores).replace("*", "8"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
