"""Committed results: readers see a run's outputs all at once or not at all.

A run writes every result to a folder of its own and then publishes one manifest that names them. The manifest is put
in place by a rename, so a run that dies before it leaves the earlier results as they were, and its folders are never read.
Each epoch commits once: a replayed micro-batch finds its manifest and adds nothing. Overwriting and appending differ
only in what a manifest says about the epochs before it.

Layout under ``base``: ``_commits/<epoch>.json`` and ``<name>/<epoch>-<attempt>/``. When more than
``FOLD_EVERY`` epochs are open, a commit folds them into one manifest (``<epoch>.all.json``), so a reader opens a
bounded number of files.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

FOLD_EVERY = 50
APPEND, OVERWRITE = "append", "overwrite"


class CommitLog:
    """The manifests under ``base``; one writer at a time, any number of readers."""

    def __init__(self, spark: SparkSession, base: str, fmt: str = "parquet"):
        self.spark, self.base, self.fmt = spark, base.rstrip("/"), fmt
        self._jvm = spark.sparkContext._jvm  # noqa: SLF001
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()  # noqa: SLF001

    # -- manifests -------------------------------------------------------------------------------------------------

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}")

    def _files(self) -> dict[str, int]:
        """Manifest file names and their epochs."""
        folder = self._path("_commits")
        fs = folder.getFileSystem(self._conf)
        if not fs.exists(folder):
            return {}
        names = [f.getPath().getName() for f in fs.listStatus(folder)]
        return {n: int(n.split(".")[0]) for n in names if n.endswith(".json") and not n.startswith(("_", "."))}

    def _read(self, name: str) -> dict:
        path = self._path(f"_commits/{name}")
        stream = path.getFileSystem(self._conf).open(path)
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _publish(self, name: str, manifest: dict) -> bool:
        """Puts a manifest in place whole; False if there is one already."""
        target, draft = self._path(f"_commits/{name}"), self._path(f"_commits/_{name}.{uuid.uuid4().hex}")
        fs = target.getFileSystem(self._conf)
        if fs.exists(target):
            return False
        fs.mkdirs(target.getParent())
        out = fs.create(draft, False)
        try:
            out.write(bytearray(json.dumps(manifest).encode()))
        finally:
            out.close()
        done = fs.rename(draft, target)
        if not done:
            fs.delete(draft, False)
        return done

    def epochs(self) -> list[int]:
        """Committed epochs since the last fold, and that one."""
        files = self._files()
        folded = max((e for n, e in files.items() if n.endswith(".all.json")), default=-1)
        return sorted({e for e in files.values() if e >= folded})

    def is_committed(self, epoch: int) -> bool:
        """Also true of epochs before the last folded one: epochs only go up."""
        files = self._files()
        folded = max((e for n, e in files.items() if n.endswith(".all.json")), default=-1)
        return epoch <= folded or epoch in files.values()

    def last(self) -> dict | None:
        """The manifest of the last committed epoch."""
        epochs = self.epochs()
        return self._read(f"{epochs[-1]:020d}.json") if epochs else None

    def next_epoch(self) -> int:
        return max(self.epochs(), default=-1) + 1

    def visible(self) -> dict[str, list[str]]:
        """Result names and the folders, relative to ``base``, that make up each result now."""
        files = self._files()
        folded = max((e for n, e in files.items() if n.endswith(".all.json")), default=None)
        found: dict[str, list[str]] = {} if folded is None else self._read(f"{folded:020d}.all.json")["results"]
        later = sorted(e for n, e in files.items() if not n.endswith(".all.json") and (folded is None or e > folded))
        for epoch in later:
            manifest = self._read(f"{epoch:020d}.json")
            for name, folder in manifest["results"].items():
                found[name] = [*(found.get(name, []) if manifest["mode"] == APPEND else []), folder]
        return found

    # -- writing and reading ---------------------------------------------------------------------------------------

    def stage(self, df: DataFrame, name: str, epoch: int, **options) -> str:
        """Writes ``df`` where no reader looks; returns the folder for :meth:`commit`."""
        folder = f"{name}/{epoch:020d}-{uuid.uuid4().hex[:12]}"
        df.write.format(self.fmt).mode("errorifexists").options(**options).save(f"{self.base}/{folder}")
        return folder

    def commit(self, epoch: int, staged: dict[str, str], mode: str = OVERWRITE, **facts) -> bool:
        """Makes the staged results visible together; False if the epoch was committed before. ``facts`` are kept."""
        if self.is_committed(epoch):
            return False
        done = self._publish(f"{epoch:020d}.json", {"epoch": epoch, "mode": mode, "results": staged, **facts})
        if done and len(self.epochs()) > FOLD_EVERY:
            self._publish(f"{epoch:020d}.all.json", {"epoch": epoch, "results": self.visible()})
        return done

    def read(self, name: str, schema=None) -> DataFrame:
        """The committed rows of a result; with ``schema``, an empty frame before the first commit."""
        folders = self.visible().get(name, [])
        if not folders:
            if schema is None:
                raise FileNotFoundError(f"no committed result {name!r} under {self.base}")
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.format(self.fmt)
        return (reader.schema(schema) if schema is not None else reader).load([f"{self.base}/{f}" for f in folders])

    def drop_unused(self) -> int:
        """Deletes folders that no manifest names (of runs that died, and overwritten ones); returns how many.

        To be run when neither a writer nor a reader of an older state is at work."""
        used = {f for folders in self.visible().values() for f in folders}
        root = self._path("")
        fs, n = root.getFileSystem(self._conf), 0
        for result in fs.listStatus(root):
            name = result.getPath().getName()
            if result.isDirectory() and not name.startswith("_"):
                for run in fs.listStatus(result.getPath()):
                    if f"{name}/{run.getPath().getName()}" not in used:
                        n += bool(fs.delete(run.getPath(), True))
        return n
