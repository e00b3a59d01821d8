"""Sets of tables that are published together: a reader sees all of a version or the one before.

Each version's tables are written into a folder of their own; a small manifest, written last under its final
name, makes the version exist. What a crashed writer leaves is in no manifest and so in no reader's way.
One writer at a time is assumed. The manifest keeps every table's schema, so a table without rows is read
as such.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _options(fmt: str) -> dict[str, object]:
    return {"header": True, "quote": '"', "escape": '"', "multiLine": True} if fmt == "csv" else {}


@dataclass(frozen=True)
class Version:
    number: int
    folder: str
    #: What the writer said about the version.
    about: dict
    tables: dict[str, dict]

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        """One table; columns are those it was written with."""
        held = self.tables[name]
        schema = T.StructType.fromJson(held["schema"])
        if held["format"] == "csv" and held["rows"] == 0:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).options(**_options(held["format"])).format(held["format"]).load(f"{self.folder}/{name}")


class Versions:
    """The versions below ``path``, of which the last ``keep`` stay."""

    def __init__(self, spark: SparkSession, path: str, keep: int = 2):
        self.spark, self.path, self.keep = spark, path.rstrip("/"), keep

    def _at(self, name: str = ""):
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)
        return where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), where

    def _manifests(self) -> list[str]:
        fs, where = self._at()
        names = [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []
        return sorted(n for n in names if n.startswith("version-") and n.endswith(".json"))

    def _read(self, name: str) -> Version:
        fs, where = self._at(name)
        source = fs.open(where)
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
        finally:
            source.close()
        held = json.loads(text)
        return Version(held["number"], f"{self.path}/{held['folder']}", held["about"], held["tables"])

    def latest(self) -> Version | None:
        names = self._manifests()
        return self._read(names[-1]) if names else None

    def _remove(self, name: str) -> None:
        fs, where = self._at(name)
        fs.delete(where, True)

    def publish(self, tables: dict[str, DataFrame], about: dict | None = None, fmt: str = "parquet", number: int | None = None) -> Version:
        """Write ``tables`` as the next version, or as version ``number``; older ones go afterwards."""
        names = self._manifests()
        number = number if number is not None else (self._read(names[-1]).number + 1 if names else 0)
        folder, held = f"data-{uuid.uuid4().hex}", {}
        for name, df in tables.items():
            df.write.options(**_options(fmt)).format(fmt).save(f"{self.path}/{folder}/{name}")
            rows = 0 if df.sparkSession.read.schema(df.schema).options(**_options(fmt)).format(fmt).load(f"{self.path}/{folder}/{name}").isEmpty() else 1
            held[name] = {"format": fmt, "schema": df.schema.jsonValue(), "rows": rows}
        text = json.dumps({"number": number, "folder": folder, "about": about or {}, "tables": held})
        fs, draft = self._at(f"draft-{uuid.uuid4().hex}")
        out = fs.create(draft, True)
        try:
            out.write(bytearray(text, "utf-8"))
        finally:
            out.close()
        final = self._at(f"version-{number:012d}.json")[1]
        if not fs.rename(draft, final):
            raise OSError(f"version {number} of {self.path} exists already")
        for old in self._manifests()[:-self.keep]:
            gone = self._read(old)
            self._remove(old)  # first the manifest, so that none names a missing folder
            self._remove(gone.folder.rpartition("/")[2])
        return self._read(f"version-{number:012d}.json")
