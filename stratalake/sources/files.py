"""The few file operations that readers and writers of DataFrames lack, on whatever file system Spark uses."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Files:
    """Small files and folders of the file system of a path: all calls run on the driver."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark._jvm
        self._array = spark.sparkContext._gateway.new_array
        self._conf = spark._jsparkSession.sessionState().newHadoopConf()

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def _system(self, path: str):
        return self._path(path).getFileSystem(self._conf)

    def exists(self, path: str) -> bool:
        return self._system(path).exists(self._path(path))

    def names(self, folder: str) -> dict[str, int]:
        """Name and modification time (seconds) of everything in ``folder``; nothing if there is none."""
        if not self.exists(folder):
            return {}
        found = self._system(folder).listStatus(self._path(folder))
        return {s.getPath().getName(): s.getModificationTime() // 1000 for s in found}

    def folders(self, folder: str, depth: int) -> list[str]:
        """Paths relative to ``folder`` of the sub-folders ``depth`` levels down, "" for depth 0."""
        if depth == 0:
            return [""]
        found = []
        for status in self._system(folder).listStatus(self._path(folder)):
            name = status.getPath().getName()
            if status.isDirectory() and "=" in name:
                found += [f"{name}/{rest}".rstrip("/") for rest in self.folders(f"{folder}/{name}", depth - 1)]
        return sorted(found)

    def read(self, path: str) -> str:
        stream = self._system(path).open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def first_line(self, path: str) -> str:
        """The first line of a text file; only its beginning is read."""
        jvm = self._jvm
        stream = jvm.java.io.InputStreamReader(self._system(path).open(self._path(path)), "UTF-8")
        reader = jvm.java.io.BufferedReader(stream)
        try:
            return reader.readLine() or ""
        finally:
            reader.close()

    def create(self, path: str, text: str) -> None:
        """Put a file there whole, or raise FileExistsError: it is written beside and renamed without overwriting."""
        folder, _, name = path.rpartition("/")
        beside = f"{folder}/.{name}.{uuid.uuid4().hex}"
        stream = self._system(beside).create(self._path(beside), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        rename = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self._array(rename, 1)
        options[0] = rename.NONE
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path(path).toUri(), self._conf)
        try:
            context.rename(self._path(beside), self._path(path), options)
        except Exception as error:
            self.delete(beside)
            if "FileAlreadyExists" in str(error):
                raise FileExistsError(path) from None
            raise

    def delete(self, path: str) -> bool:
        return self._system(path).delete(self._path(path), True)
