"""Options of the external stores; the caller supplies addresses and credentials."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class JdbcTarget:
    url: str
    user: str
    password: str
    driver: str = "org.postgresql.Driver"

    def options(self, table: str) -> dict[str, str]:
        return {
            "url": self.url,
            "dbtable": table,
            "user": self.user,
            "password": self.password,
            "driver": self.driver,
        }


def read_jdbc(
    spark: SparkSession,
    target: JdbcTarget,
    table: str,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
) -> DataFrame:
    """Read a table; with a partition column the executors read ranges of it in parallel."""
    options = target.options(table)
    if partition_column and bounds:
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return spark.read.format("jdbc").options(**options).load()


def write_jdbc(df: DataFrame, target: JdbcTarget, table: str, mode: str = "append") -> None:
    df.write.format("jdbc").options(**target.options(table)).mode(mode).save()


def object_store_conf(endpoint: str, access_key: str, secret_key: str) -> dict[str, str]:
    """Session settings for ``s3a://`` paths on an S3-compatible store."""
    return {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.access.key": access_key,
        "spark.hadoop.fs.s3a.secret.key": secret_key,
        "spark.hadoop.fs.s3a.path.style.access": "true",
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
    }
