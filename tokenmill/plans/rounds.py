"""Resumable driver loops: the state of a round, published when it is whole.

A loop (BPE fit, crawl) gives a folder in shared storage.  Each kept round
writes its tables as Parquet into a folder of its own, and last a manifest (a
JSON text: round, tables with their row counts, the loop's own values, and the
fingerprint of what the loop reads), whose commit marker Spark writes when all
is there.  A new application that runs the same loop over the same input goes
on after the newest published round; a round that was cut off has no marker and
is not seen.  A fingerprint of another input or of other parameters raises.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession


def input_fingerprint(df: DataFrame, *parameters) -> str:
    """Of the files that ``df`` reads (path, length, time of change), its
    columns, and the loop's parameters; of an input without files only the rest."""
    spark = df.sparkSession
    facts = []
    for name in sorted(df.inputFiles()):
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        status = path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path)
        facts.append((name, status.getLen(), status.getModificationTime()))
    return hashlib.sha256(json.dumps([facts, df.schema.jsonValue(), [repr(p) for p in parameters]], sort_keys=True).encode()).hexdigest()


class Rounds:
    """The published rounds of one loop below ``folder``."""

    def __init__(self, spark: SparkSession, folder: str, fingerprint: str) -> None:
        self.spark, self.folder, self.fingerprint = spark, folder.rstrip("/"), fingerprint

    def _numbers(self) -> list[int]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(path):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(path)]
        whole = self.spark._jvm.org.apache.hadoop.fs.Path
        return sorted(int(n[6:]) for n in names if n.startswith("round-")
                      and fs.exists(whole(f"{self.folder}/{n}/manifest/_SUCCESS")))

    def publish(self, number: int, tables: dict[str, DataFrame], values: dict) -> dict[str, DataFrame]:
        """Write a round; returns its tables as read back."""
        at = f"{self.folder}/round-{number:06d}"
        counts = {}
        for name, df in tables.items():
            df.write.mode("overwrite").parquet(f"{at}/{name}")
            counts[name] = self.spark.read.parquet(f"{at}/{name}").count()
        manifest = json.dumps({"round": number, "fingerprint": self.fingerprint, "rows": counts, "values": values})
        self.spark.createDataFrame([(manifest,)], "value string").coalesce(1).write.mode("overwrite").text(f"{at}/manifest")
        return {name: self.spark.read.schema(df.schema).parquet(f"{at}/{name}") for name, df in tables.items()}

    def all(self, name: str) -> DataFrame:
        """One table of every published round together."""
        return self.spark.read.parquet(*[f"{self.folder}/round-{k:06d}/{name}" for k in self._numbers()])

    def latest(self) -> tuple[int, dict[str, DataFrame], dict] | None:
        """(round, tables, values) of the newest published round, if any."""
        numbers = self._numbers()
        if not numbers:
            return None
        at = f"{self.folder}/round-{numbers[-1]:06d}"
        manifest = json.loads("".join(r["value"] for r in self.spark.read.text(f"{at}/manifest").collect()))
        if manifest["fingerprint"] != self.fingerprint:
            raise ValueError(f"{self.folder} holds the rounds of another input or of other parameters")
        tables = {name: self.spark.read.parquet(f"{at}/{name}") for name in manifest["rows"]}
        for name, rows in manifest["rows"].items():
            if tables[name].count() != rows:
                raise ValueError(f"{at}/{name} is short: {rows} rows were published")
        return manifest["round"], tables, manifest["values"]
