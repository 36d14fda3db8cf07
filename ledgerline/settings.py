"""Where the layers live and which table format they use.

Paths are plain arguments (no environment lookup). ``work_dir`` finds the
shared folder the cluster names in ``spark.checkpoint.dir``; a private
folder is created only for a local-mode session that has none.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Layout:
    """Table locations of one lake. ``fmt`` is ``parquet`` or ``delta``."""

    root: str
    fmt: str = "parquet"
    dataset: str = "pagamentos"
    landing_dir: str | None = None  # files may land outside the lake root

    @property
    def landing(self) -> str:
        return self.landing_dir or f"{self.root}/landing/{self.dataset}"

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze/{self.dataset}"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver/{self.dataset}"

    def gold(self, table: str) -> str:
        return f"{self.root}/gold/{table}"

    @property
    def gold_pre(self) -> str:
        """Month-partitioned pre-aggregate the Gold tables are rolled up from."""
        return f"{self.root}/gold/_pre_aggregate"

    @property
    def gold_notes(self) -> str:
        """Folder names ``YYYYMM-<id>``: months of Silver written since the pre-aggregate read them."""
        return f"{self.root}/gold/_rewritten_months"


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_dir(spark: SparkSession) -> str:
    """The session's shared checkpoint folder.

    Read from the session; when unset and the master is local (tests, bench),
    a private folder is created and registered. On a cluster an unset value is
    an error: a machine-local folder would not survive a lost executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    if not _is_local(spark):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="ledgerline-ckpt-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)  # scratch tables of a local session
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def work_dir(spark: SparkSession, name: str | None = None) -> str:
    """A fresh sub-folder of the checkpoint folder for written tables."""
    base = checkpoint_dir(spark)
    sub = name or f"run-{uuid.uuid4().hex[:12]}"
    path = f"{base.rstrip('/')}/ledgerline/{sub}"
    if path.startswith("file:"):
        os.makedirs(path[len("file:"):], exist_ok=True)
    return path
