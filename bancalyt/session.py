"""Session settings the plans rely on.

``configure`` only changes a setting that still has Spark's built-in value
(or none), so a cluster's own configuration (shuffle partitions sized to
the data, checkpoint dir on shared storage, broadcast thresholds) wins.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    # adaptive execution: runtime broadcast decisions from measured sizes,
    # partition coalescing, skew-join splitting
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot key's partition even where the split needs one more
    # shuffle: in a chain of joins on id_cliente (accounts x customers x
    # score) only the first join would qualify otherwise.  The extra shuffle
    # is added only when a skewed partition is actually found.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # reuse identical exchanges / subqueries (e.g. a grand total computed
    # from the same shuffle as the rows it divides)
    "spark.sql.exchange.reuse": "true",
    "spark.sql.execution.reuseSubquery": "true",
}


# Spark's own values of the keys above: a session still holding these was
# not tuned by its owner
SPARK_BUILTIN = {
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "false",
}


def configure(spark: SparkSession, overrides: dict[str, str] | None = None) -> SparkSession:
    conf = spark.conf
    for key, value in {**DEFAULTS, **(overrides or {})}.items():
        current = conf.get(key, None)
        if current is None or current == SPARK_BUILTIN.get(key) or (overrides and key in overrides):
            conf.set(key, value)
    return spark


def local_session(cores: int = 8, shuffle_partitions: int = 8, app: str = "bancalyt",
                  extra: dict[str, str] | None = None) -> SparkSession:
    """A local session for tests and the bench (UI off, no server)."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "8g"))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
