"""What each micro-batch of a query has done so far, kept in the shared folder.

``foreachBatch`` repeats a batch whose function failed or whose driver was lost. Each step of a batch is a table or a
note below ``folder/step/batch=number``; a step counts as done once Spark has committed its files. A repeated batch
reads the finished steps again and does only the rest, so what it hands on is the same, down to its times.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from skygrain.plans.durable import freed

MARK = "_SUCCESS"  # the file that Spark's writers leave last


class Ledger:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def path(self, step: str, number: int | None = None) -> str:
        return f"{self.folder}/{step}" if number is None else f"{self.folder}/{step}/batch={number}"

    def _files(self, path: str):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()), place

    def done(self, step: str, number: int) -> bool:
        files, place = self._files(f"{self.path(step, number)}/{MARK}")
        return files.exists(place)

    def numbers(self, step: str) -> list[int]:
        """Batches that have finished the step, in order."""
        files, place = self._files(self.path(step))
        if not files.exists(place):
            return []
        found = [s.getPath().getName() for s in files.listStatus(place)]
        known = sorted(int(n.removeprefix("batch=")) for n in found if n.startswith("batch="))
        return [n for n in known if self.done(step, n)]

    def table(self, step: str, number: int, rows: Callable[[], DataFrame]) -> DataFrame:
        """The step's table, written now unless an earlier attempt finished it."""
        path = self.path(step, number)
        if not self.done(step, number):
            df = rows()
            with freed(df.sparkSession):
                df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self.spark.read.option("recursiveFileLookup", True).parquet(path)

    def note(self, step: str, number: int, facts: Mapping[str, int]) -> None:
        row = self.spark.range(1).select(*[F.lit(v).cast("long").alias(k) for k, v in facts.items()])
        row.coalesce(1).write.mode("overwrite").json(self.path(step, number))

    def once(self, step: str, number: int, act: Callable[[], None]) -> None:
        """Run ``act`` unless it was run to its end for this batch.

        A driver lost between the end of ``act`` and the note makes it run again: the gap that a store without
        transactions leaves. ``act`` then hands on the same rows under the same keys.
        """
        if not self.done(step, number):
            act()
            self.note(step, number, {"done": 1})

    def notes(self, step: str, facts: tuple[str, ...]) -> DataFrame:
        """``batch`` and the facts noted, one row per batch."""
        schema = ", ".join(f"{n} long" for n in (*facts, "batch"))
        return self.spark.read.schema(schema).json(self.path(step))

    def forget(self, step: str, before: int) -> None:
        """Delete this ledger's tables of the batches before ``before``, which no repeat can ask for."""
        for n in self.numbers(step):
            if n < before:
                files, place = self._files(self.path(step, n))
                files.delete(place, True)
