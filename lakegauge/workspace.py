"""Where jobs put intermediate and scratch tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

from lakegauge import storage

# Per application: the folder used where the session names none.
_local: dict[str, str] = {}
# Applications whose scratch folder exists.
_prepared: set[str] = set()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, named by ``spark.checkpoint.dir``.

    Only a local session, where every task runs on this machine, may go
    without the setting; it gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _local:
        _local[context.applicationId] = tempfile.mkdtemp(prefix="lakegauge-")
    return _local[context.applicationId]


def new_folder(spark: SparkSession, label: str) -> str:
    """A path nobody has used yet, in this application's scratch folder.

    The scratch folder is removed when the application ends.
    """
    scratch = f"{shared_folder(spark)}/lakegauge-{spark.sparkContext.applicationId}"
    if scratch not in _prepared:
        storage.create_until_exit(spark, scratch)
        _prepared.add(scratch)
    return f"{scratch}/{label}-{uuid.uuid4().hex}"
