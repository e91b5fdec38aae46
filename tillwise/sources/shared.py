"""Small files in the shared folder, through Hadoop's file systems: the driver's notes."""

from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class SharedFolder:
    """A folder that all writers and readers of a table agree on.

    ``claim`` is what makes commits safe: a file appears under its name whole or not at all,
    and of several writers of the same name exactly one succeeds.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._files = self._path("").getFileSystem(self._conf)

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}".rstrip("/"))

    def names(self, name: str = "") -> list[str]:
        """Names in a sub-folder, sorted; none if it does not exist."""
        if not self.exists(name):
            return []
        return sorted(status.getPath().getName() for status in self._files.listStatus(self._path(name)))

    def exists(self, name: str) -> bool:
        return self._files.exists(self._path(name))

    def modified(self, name: str) -> float:
        """Seconds since 1970."""
        return self._files.getFileStatus(self._path(name)).getModificationTime() / 1000

    def read(self, name: str) -> str:
        stream = self._files.open(self._path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def delete(self, name: str) -> None:
        self._files.delete(self._path(name), True)

    def claim(self, name: str, text: str) -> bool:
        """Create a file with a text; False if the name is taken."""
        own = f"{name.rpartition('/')[0]}/_claim-{uuid4().hex}".lstrip("/")
        stream = self._files.create(self._path(own), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        try:
            return self._link(own, name) if self._files.getScheme() == "file" else self.move(own, name)
        finally:
            self.delete(own)

    def _link(self, own: str, name: str) -> bool:
        """Local file systems rename over existing files, but do not link over them."""
        paths = [self._files.makeQualified(self._path(n)).toUri().getPath() for n in (name, own)]
        nio = self._jvm.java.nio.file
        at, existing = (self._jvm.java.io.File(p).toPath() for p in paths)
        try:
            nio.Files.createLink(at, existing)
        except Py4JJavaError as failure:
            if "FileAlreadyExists" in str(failure.java_exception):
                return False
            raise
        return True

    def move(self, name: str, to: str) -> bool:
        """Rename a file or folder; False if the new name is taken."""
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._files.getUri(), self._conf)
        none = self.spark.sparkContext._gateway.new_array(getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        if self.exists(to):
            return False
        try:
            context.rename(*(self._files.makeQualified(self._path(n)) for n in (name, to)), none)
        except Py4JJavaError as failure:
            if self.exists(to):
                return False
            raise failure
        return True
