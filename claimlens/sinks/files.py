"""Folders that driver and executors share, and files that are made once or not at all."""

from __future__ import annotations

import datetime as dt
import uuid
from zoneinfo import ZoneInfo

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

LOCAL_SHARED = "/tmp/checkpoints"


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path under ``spark.checkpoint.dir``.

    Where it is unset, a session on this machine alone gets a folder of its own; on a cluster, where executors
    would write to their own disks, that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", "")
    if not base:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = LOCAL_SHARED
    return f"{base.rstrip('/')}/claimlens-{name}-{uuid.uuid4().hex}"


def stamp(moment: dt.datetime, zone: str = "UTC") -> str:
    """``YYYYMMDD_HHMM`` of a UTC moment in a time zone, for the names of a run's outputs."""
    aware = moment if moment.tzinfo else moment.replace(tzinfo=dt.timezone.utc)
    return aware.astimezone(ZoneInfo(zone)).strftime("%Y%m%d_%H%M")


class Files:
    """The file system of a path, through Hadoop's own interface."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self._jvm = spark._jvm
        self._conf = spark._jsparkSession.sessionState().newHadoopConf()
        self._root = self._path(root)
        self._fs = self._root.getFileSystem(self._conf)

    def _path(self, text: str):
        return self._jvm.org.apache.hadoop.fs.Path(text)

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def names(self, folder: str) -> list[str]:
        """Names in a folder; none where it does not exist."""
        if not self.exists(folder):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(folder)))

    def read(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create_once(self, path: str, text: str) -> bool:
        """Makes a file with its whole content, or gives False because it is there already.

        The content is written beside it and renamed without overwriting, which HDFS does in one step.
        """
        waiting = self._path(f"{path}.{uuid.uuid4().hex}.tmp")
        out = self._fs.create(waiting, True)
        try:
            out.write(bytearray(text, "utf-8"))
        finally:
            out.close()
        fc = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf)
        rename = self._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename")
        options = self._jvm.java.lang.reflect.Array.newInstance(rename, 0)
        try:
            fc.rename(waiting, self._path(path), options)
        except Py4JJavaError as error:
            self._fs.delete(waiting, False)
            if error.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
                return False
            raise
        return True
