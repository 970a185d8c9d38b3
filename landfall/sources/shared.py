import tempfile
from uuid import uuid4

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path for intermediate tables, in the shared folder that the cluster names.

    The folder is that of ``spark.checkpoint.dir``. A session without one gets a folder of
    this machine, which is right only where all executors run on it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("Set spark.checkpoint.dir to a folder that all executors share.")
        base = tempfile.gettempdir()
    return f"{base.rstrip('/')}/landfall/{name}-{uuid4().hex}"
