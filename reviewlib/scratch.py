"""Where intermediate tables go."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

_SETTING = "spark.checkpoint.dir"


def scratch_dir(spark: SparkSession) -> str:
    """A new folder under the shared one the session names in ``spark.checkpoint.dir``.

    Only a plain local session may do without the setting: there one process is driver and
    executor, so a temporary folder is as shared as it gets. Settings are left as they are.
    """
    base = spark.conf.get(_SETTING, None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError(f"set {_SETTING} to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="reviewlib-")
    return f"{base.rstrip('/')}/reviewlib-{uuid.uuid4().hex}"
