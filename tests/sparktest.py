from pyspark.sql import SparkSession


def session(cpus: int | str = 8):
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("seriesloom")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
