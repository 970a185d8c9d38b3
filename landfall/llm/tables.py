"""Small helpers shared by the operators."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from landfall.sources import shared_folder


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read again.

    Cuts the lineage: a lost executor costs tasks of later jobs only, and nothing that the
    plan above it did is done twice.
    """
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` alone, a null text as an empty one."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, changed where the table has columns of these names."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        found.append(name)
    return found
