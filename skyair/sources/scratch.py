"""Where intermediate tables go: the shared folder the cluster names."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import SparkSession

_SETTING = "spark.checkpoint.dir"


@lru_cache(maxsize=1)
def _local_root() -> str:
    folder = tempfile.TemporaryDirectory(prefix="skyair-", ignore_cleanup_errors=True)
    atexit.register(folder.cleanup)
    return folder.name


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below ``spark.checkpoint.dir``.

    Unset, it is only replaced where every task runs on this machine, by a folder that is removed when the
    process ends; on a cluster a local folder would be a different one on every executor. Results may read
    what stands there, so a cluster's folder is emptied by whoever runs the jobs, after the last of them.
    """
    root = spark.conf.get(_SETTING, None)
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError(f"set {_SETTING} to a folder all executors share")
        root = _local_root()
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
