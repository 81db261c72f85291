"""Publishing: a run's outputs are written beside the place they belong to and swapped in as whole folders.

A run first stages its files below ``<base>._publish/<run>``, in the layout they will have below ``base``. Then it stores
a manifest there that names every folder the run stands for, those without rows included: from that moment the run is
decided. The swap replaces one named folder after the other, and removes those for which nothing was staged, so no old
rows of the run's groups stay. A run that fails before its manifest changes nothing below ``base``; a swap that was
broken off is finished from its manifest by ``recover``, which every publication begins with. Folders the manifest does
not name are never touched.

One writer at a time may publish to a base. The manifest has a line for each folder: groups times steps.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from py4j.java_gateway import JavaObject
from pyspark.sql import SparkSession

MANIFEST = "manifest"


class Files:
    """The file system a path lies on."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark.sparkContext._jvm
        self._fs = self.path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, path: str) -> JavaObject:
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self._fs.exists(self.path(path))

    def delete(self, path: str) -> None:
        self._fs.delete(self.path(path), True)

    def folders(self, path: str) -> list[str]:
        """Names of the folders in a folder; none where there is no such folder."""
        if not self.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self.path(path)) if s.isDirectory())

    def is_empty(self, path: str) -> bool:
        """Whether a folder is there and has nothing but marks (names that begin with ``_`` or ``.``)."""
        if not self.exists(path):
            return False
        return all(s.getPath().getName()[0] in "_." for s in self._fs.listStatus(self.path(path)))

    def move(self, source: str, target: str) -> None:
        self._fs.mkdirs(self.path(target).getParent())
        if not self._fs.rename(self.path(source), self.path(target)):
            raise OSError(f"cannot move {source} to {target}")

    def write(self, path: str, text: str) -> None:
        """A small file that appears at once: it is renamed when it is complete."""
        out = self._fs.create(self.path(path + ".tmp"), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        self.move(path + ".tmp", path)

    def make(self, path: str) -> None:
        self._fs.mkdirs(self.path(path))

    def read(self, path: str) -> str:
        stream = self._fs.open(self.path(path))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()


class Publication:
    """Outputs of one run. ``groups`` are the location groups it stands for; without them it stands for all: those it
    has rows of, and those that are there from earlier runs."""

    def __init__(self, spark: SparkSession, base: str, groups: Sequence[str] | None = None):
        self.base = base.rstrip("/")
        self.groups = None if groups is None else list(groups)
        self.files = Files(spark, self.base)
        # Directory names of partition values are escaped the way Spark's writer does it
        self._escaped = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
        recover(spark, self.base)
        self.stage = f"{_side(self.base)}/{uuid.uuid4().hex[:12]}"
        self._outputs: list[tuple[str, str, str]] = []

    def output(self, name: str, partition: str, inner: str = "") -> str:
        """Where to stage the files of the output ``name`` (a path below the base, or empty), which is partitioned by
        ``partition``; ``inner`` is a fixed folder within each group that the run replaces."""
        self._outputs.append((name, partition, inner))
        return _join(self.stage, name)

    def _folders(self) -> list[str]:
        out = []
        for name, partition, inner in self._outputs:
            if self.groups is None:
                found = {*self.files.folders(_join(self.stage, name)), *self.files.folders(_join(self.base, name))}
                groups = sorted(f for f in found if f.lower().startswith(f"{partition}="))
            else:
                groups = [f"{partition}={self._escaped(g)}" for g in self.groups]
                extra = {f for f in self.files.folders(_join(self.stage, name)) if f.startswith(f"{partition}=")} - set(groups)
                if extra:
                    raise ValueError(f"rows of groups the run does not stand for: {', '.join(sorted(extra))}")
            out += [_join(name, g, inner) for g in groups]
        return out

    def commit(self) -> None:
        try:
            folders = self._folders()
        except ValueError:
            self.discard()
            raise
        self.files.write(f"{self.stage}/{MANIFEST}", "\n".join(folders))
        _swap(self.files, self.base, self.stage)

    def discard(self) -> None:
        self.files.delete(self.stage)

    def __enter__(self) -> Publication:
        return self

    def __exit__(self, kind, *_: object) -> None:
        """Commit, or drop everything staged where the run failed."""
        self.discard() if kind else self.commit()


def _side(base: str) -> str:
    return f"{base}._publish"


def _join(*parts: str) -> str:
    return "/".join(p for p in parts if p)


def _swap(files: Files, base: str, stage: str) -> None:
    """Can be repeated: a folder that is no longer staged has been moved, unless the manifest says it is empty. Which
    ones are empty is settled by a second list before the first folder moves."""
    filled = f"{stage}/filled"
    folders = files.read(f"{stage}/{MANIFEST}").split("\n")
    if not files.exists(filled):
        files.write(filled, "\n".join(f for f in folders if f and files.exists(_join(stage, f))))
    full = set(files.read(filled).split("\n"))
    for folder in filter(None, folders):
        source, target = _join(stage, folder), _join(base, folder)
        if folder not in full:
            files.delete(target)
            files.make(target.rpartition("/")[0])  # an output without rows is an empty table, not a missing one
        elif files.exists(source):
            files.delete(target)
            files.move(source, target)
    files.delete(stage)


def recover(spark: SparkSession, base: str) -> None:
    """Finish swaps that were decided and broken off; drop what undecided runs left behind."""
    base = base.rstrip("/")
    files = Files(spark, base)
    for run in files.folders(_side(base)):
        stage = f"{_side(base)}/{run}"
        if files.exists(f"{stage}/{MANIFEST}"):
            _swap(files, base, stage)
        else:
            files.delete(stage)
