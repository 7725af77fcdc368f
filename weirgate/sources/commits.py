"""Folders of a stored table that grows: appended parts and snapshots, each visible once committed."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Commits:
    """Committed folders under ``root``.

    A part is written to a folder of its own, then named in a numbered file that exactly one
    writer can create; until then no reader sees it, so a crash between the two leaves nothing
    but an unused folder. A snapshot replaces all parts before it and the snapshot they follow.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm = spark._jvm
        self._fs = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())
        self._fs.mkdirs(self._path(f"{self.root}/_commits"))

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def folder(self) -> str:
        """A new folder to write a part to."""
        return f"{self.root}/part-{uuid.uuid4().hex}"

    def commit(self, folder: str, snapshot_of: int | None = None) -> int:
        """Make ``folder`` visible; as a snapshot, in place of everything up to that number."""
        name = folder.rsplit("/", 1)[1]
        text = f"{name} {-1 if snapshot_of is None else snapshot_of}\n"
        while True:
            number = max((n for n, _, _ in self._entries(finished=False)), default=0) + 1
            try:
                out = self._fs.create(self._path(f"{self.root}/_commits/{number:012d}"), False)
            except Exception as e:  # another writer took the number
                if "FileAlreadyExists" not in str(e):
                    raise
                continue
            out.write(bytearray(text.encode()))
            out.close()
            return number

    def _entries(self, finished: bool = True) -> list[tuple[int, str, int]]:
        found = []
        for status in self._fs.listStatus(self._path(f"{self.root}/_commits")):
            number = status.getPath().getName()
            if not number.isdigit():
                continue
            text = ""
            if finished:
                stream = self._fs.open(status.getPath())
                try:
                    text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
                finally:
                    stream.close()
                if not text.endswith("\n"):  # its writer died
                    continue
            name, upto = text.split() if text else ("", "-1")
            found.append((int(number), name, int(upto)))
        return sorted(found)

    def live(self) -> tuple[str | None, list[str], int]:
        """The newest snapshot's folder, the parts that it does not hold, and the last number read."""
        entries = self._entries()
        snapshots = [(upto, n, name) for n, name, upto in entries if upto >= 0]
        upto, _, snapshot = max(snapshots, default=(0, 0, None))
        tail = [f"{self.root}/{name}" for n, name, of in entries if of < 0 and n > upto]
        return (f"{self.root}/{snapshot}" if snapshot else None), tail, max((n for n, _, _ in entries), default=0)
