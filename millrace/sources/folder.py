"""Files below a folder: listing, moving and small texts, on any file system that Spark reads."""

from __future__ import annotations

from urllib.parse import unquote, urlsplit

from pyspark.sql import SparkSession


class Folder:
    """Files below a folder, by their paths within it."""

    def __init__(self, spark: SparkSession, root: str):
        self._paths = spark._jvm.org.apache.hadoop.fs.Path
        self.root = root
        self._fs = self._paths(root).getFileSystem(spark._jsc.hadoopConfiguration())
        # File names in rows are URIs, in which blanks and the like are escaped.
        self._prefix = unquote(urlsplit(self._fs.makeQualified(self._paths(root)).toUri().toString()).path).rstrip("/") + "/"

    def path(self, relative: str) -> str:
        return f"{self.root}/{relative}"

    def _at(self, relative: str):
        return self._paths(self._paths(self.root), relative) if relative else self._paths(self.root)

    def relative(self, uri: str) -> str:
        """The path within the folder of a file that a row names."""
        path = unquote(urlsplit(uri).path)
        if not path.startswith(self._prefix):
            raise ValueError(f"{uri} isn't in {self.root}")
        return path[len(self._prefix):]

    def exists(self, relative: str) -> bool:
        return self._fs.exists(self._at(relative))

    def size(self, relative: str) -> int:
        return self._fs.getFileStatus(self._at(relative)).getLen()

    def expect(self, relative: str, size: int) -> None:
        """Raise if a file is gone or has another size."""
        if not self.exists(relative) or self.size(relative) != size:
            raise RuntimeError(f"{self.path(relative)} was changed by someone else; try again")

    def files(self, relative: str = "", suffix: str = "") -> list[str]:
        """The files below a folder, without hidden ones and hidden folders, in order."""
        if not self.exists(relative):
            return []
        found, listed = [], self._fs.listFiles(self._at(relative), True)
        while listed.hasNext():
            path = unquote(urlsplit(listed.next().getPath().toUri().toString()).path)[len(self._prefix):]
            inner = path[len(relative) + 1:] if relative else path
            if path.endswith(suffix) and not any(part.startswith(("_", ".")) and "=" not in part for part in inner.split("/")):
                found.append(path)
        return sorted(found)

    def move(self, source: str, target: str) -> None:
        """Move a file, unless that was done before."""
        if not self.exists(source):
            if not self.exists(target):
                raise RuntimeError(f"{self.path(source)} is gone")
            return
        self._fs.mkdirs(self._at(target.rpartition("/")[0]))
        if not self._fs.rename(self._at(source), self._at(target)):
            raise RuntimeError(f"{self.path(source)} can't be moved")

    def delete(self, relative: str) -> None:
        self._fs.delete(self._at(relative), True)

    def write(self, relative: str, text: str) -> None:
        out = self._fs.create(self._at(relative), True)
        out.write(bytearray(text.encode()))
        out.close()

    def read(self, relative: str) -> str:
        source = self._fs.open(self._at(relative))
        data = bytes(source.readAllBytes())
        source.close()
        return data.decode()
