"""The log of finished loads: one small file per load, put there only if its number is free.

A load builds on the loads it has seen and commits the next number. Of two loads that build on the same state
only one gets the number; the other finds the file there and starts over from what is then the state.
"""

import json
import uuid
from typing import Any

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "load_no int, batch_id string, folder string, loaded_at timestamp_ntz, feed string"


class CommitLog:
    def __init__(self, spark: SparkSession, root: str, schema: str = SCHEMA):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema

    def rows(self) -> DataFrame:
        """One row per finished load."""
        if not self._hadoop(self.root)[1].exists(self._hadoop(self.root)[0]):
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).option("pathGlobFilter", "*.json").json(self.root)

    def publish(self, number: int, row: dict[str, Any]) -> bool:
        """Put the row under its number in one step; False if the number is taken.

        `number` goes into the row's first column. The row is written under another name first, so that no reader sees half of it.
        """
        waiting, files = self._hadoop(f"{self.root}/.{uuid.uuid4().hex}.tmp")
        out = files.create(waiting, False)
        out.write(bytearray(json.dumps({**row, self.schema.split()[0]: number}).encode()))
        out.close()
        try:
            return self._move(waiting, self._hadoop(f"{self.root}/{number:08d}.json")[0], files)
        finally:
            files.delete(waiting, False)

    def _move(self, waiting, taken, files) -> bool:
        jvm = self.spark._jvm
        try:
            if files.getUri().getScheme() == "file":  # a rename would replace the file; a link does not
                java = [jvm.java.io.File(p.toUri().getPath()).toPath() for p in (taken, waiting)]
                jvm.java.nio.file.Files.createLink(*java)
            else:
                context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), self.spark._jsc.hadoopConfiguration())
                none = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
                none[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
                context.rename(waiting, taken, none)
        except Exception as error:
            if "FileAlreadyExists" in str(error):
                return False
            raise
        return True

    def _hadoop(self, path: str):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place, place.getFileSystem(self.spark._jsc.hadoopConfiguration())
