"""Small text files beside the tables, through whatever file system Spark uses for the folder."""

from __future__ import annotations

import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class SmallFiles:
    """Files are whole or absent: they are written under another name and renamed."""

    def __init__(self, spark: SparkSession, root: str):
        self.root = root.rstrip("/")
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()
        self._gateway = spark.sparkContext._gateway
        self._fs = self._path("").getFileSystem(self._conf)
        #: Hadoop's local file system overwrites on rename without a check, the operating system's link does not.
        self.local = self._fs.getUri().getScheme() == "file"

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def _own(self, name: str) -> str:
        return self._path(name).toUri().getPath()

    def _written(self, name: str, text: str) -> str:
        draft = f"{name}.{uuid.uuid4().hex}.draft"
        self._fs.mkdirs(self._path(name).getParent())
        if self.local:
            with open(self._own(draft), "w", encoding="utf-8") as out:
                out.write(text)
        else:
            out = self._fs.create(self._path(draft), True)
            out.write(bytearray(text.encode()))
            out.close()
        return draft

    def _rename(self, draft: str, name: str, over: bool) -> None:
        kind = self._jvm.org.apache.hadoop.fs.Options.Rename
        how = self._gateway.new_array(kind, 1)
        how[0] = kind.OVERWRITE if over else kind.NONE
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf)
        context.rename(self._path(draft), self._path(name), how)

    def create(self, name: str, text: str) -> bool:
        """False if there is a file of this name: of several writers one succeeds."""
        draft = self._written(name, text)
        try:
            if self.local:
                os.link(self._own(draft), self._own(name))
            else:
                self._rename(draft, name, over=False)
        except FileExistsError:
            return False
        except Py4JJavaError as error:
            if "FileAlreadyExists" not in str(error.java_exception):
                raise
            return False
        finally:
            self.delete(draft)
        return True

    def replace(self, name: str, text: str) -> None:
        """Readers see the old file or the new one."""
        draft = self._written(name, text)
        if self.local:
            os.replace(self._own(draft), self._own(name))
        else:
            self._rename(draft, name, over=True)

    def read(self, name: str) -> str | None:
        try:
            stream = self._fs.open(self._path(name))
        except Py4JJavaError as error:
            if "FileNotFound" in str(error.java_exception):
                return None
            raise
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def names(self, folder: str) -> list[str]:
        """What is in `folder`, without drafts and hidden files."""
        if not self.exists(folder):
            return []
        found = (s.getPath().getName() for s in self._fs.listStatus(self._path(folder)))
        return sorted(n for n in found if not n.startswith((".", "_")) and not n.endswith(".draft"))

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._path(name))

    def delete(self, name: str) -> None:
        self._fs.delete(self._path(name), True)
