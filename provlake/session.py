"""Tables, durable intermediate results and small plan helpers."""

from __future__ import annotations

import atexit
import contextlib
import gc
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the workers this package, once per application, wherever they run."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    here = Path(__file__).resolve().parent
    d = tempfile.mkdtemp(prefix=f"{here.name}-")  # on the driver, whose file server hands it out
    atexit.register(shutil.rmtree, d, ignore_errors=True)
    archive = Path(d) / f"{here.name}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for path in sorted(here.rglob("*.py")):
            z.write(path, path.relative_to(here.parent))
    sc.addPyFile(str(archive))
    _shipped.add(sc.applicationId)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data directory."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: the session's spark.checkpoint.dir.

    Only where it is unset and the master is local, as in tests, a temporary
    folder is taken and set as the checkpoint directory; on a cluster a folder
    of one machine would lose the data of the others, so that is an error.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not path:
        held = sc._jsc.sc().getCheckpointDir()
        if not held.isDefined() and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = held.get() if held.isDefined() else tempfile.mkdtemp(prefix="provlake-")
        if not held.isDefined():
            sc.setCheckpointDir(path)
    return path.rstrip("/")


class Stash:
    """Intermediate tables in the shared folder.

    A written table cuts the lineage, outlives a lost executor and lets the
    shuffle files that led to it be removed.  `drop` removes those of them
    that a later written table has made superfluous.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.root = spark, f"{shared_dir(spark)}/stash-{uuid.uuid4().hex}"
        # results read from it lazily, so it goes when the driver's program ends, on whatever file system
        atexit.register(self._end, self.root)

    def put(self, df: DataFrame, name: str, **options) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.options(**options).mode("overwrite").parquet(path)
        schema = df.schema
        del df
        self.release()
        return self.spark.read.schema(schema).parquet(path)

    def release(self) -> None:
        """Let Spark's cleaner see which shuffles nobody refers to any more."""
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()

    def _delete(self, path: str) -> None:
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)

    def _end(self, path: str) -> None:
        local = path.removeprefix("file://")
        if local.startswith("/"):
            shutil.rmtree(local, ignore_errors=True)
        else:
            with contextlib.suppress(Exception):  # the session may be gone already
                self._delete(path)

    def drop(self, name: str) -> None:
        self._delete(f"{self.root}/{name}")


def hash_sample(df: DataFrame, id_col: str, most: int) -> DataFrame:
    """At most so many rows, the first by a hash of the id: what a model is fitted on.

    Of a large table only about four times as many rows are sorted, so that no
    partition sends more than its share.
    """
    n = df.count()
    if n > 4 * most:
        df = df.where(F.pmod(F.xxhash64(id_col), F.lit(1 << 40)) < int((1 << 40) * 4 * most / n))
    return df.orderBy(F.xxhash64(id_col), id_col).limit(most)
