"""Session settings the library relies on."""

from pyspark.sql import SparkSession


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the runtime settings that results depend on; safe to call again."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    return spark


def build(app: str = "tickerloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session for scripts and tests. On a cluster the submitter's settings win."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())
