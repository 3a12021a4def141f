from pyspark.sql import SparkSession


def local_session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .appName("stratalake-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", "/tmp/stratalake-warehouse")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    return spark
