"""Names and small texts in whatever store the tables lie in, through Hadoop's file systems."""

from pyspark.sql import SparkSession


class Folders:
    """One writer at a time; readers see a text whole or not at all."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def _at(self, path: str):
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self.spark._jsc.hadoopConfiguration()), target

    def exists(self, path: str) -> bool:
        store, target = self._at(path)
        return store.exists(target)

    def names(self, path: str) -> list[str]:
        """Sorted names in a folder; none if there is no such folder."""
        store, target = self._at(path)
        return sorted(f.getPath().getName() for f in store.listStatus(target)) if store.exists(target) else []

    def put(self, path: str, text: str) -> None:
        """Write under another name first, then rename: a writer that dies leaves nothing under ``path``."""
        store, target = self._at(path)
        folder, _, name = path.rpartition("/")
        _, draft = self._at(f"{folder}/_draft-{name}")
        out = store.create(draft, True)
        out.write(bytearray(text.encode()))
        out.close()
        if store.exists(target):
            store.delete(target, False)
        if not store.rename(draft, target):
            raise OSError(f"cannot write {path}")

    def get(self, path: str) -> str:
        store, target = self._at(path)
        stream = store.open(target)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def remove(self, path: str) -> None:
        store, target = self._at(path)
        store.delete(target, True)
