"""A log of commits: what has been written, and by which run.

A job writes its tables first and appends to the log last. What the log does not name was
never written: a job that dies before its commit is simply repeated, and readers that
go by the log never see its remains. A run that asks the log need not list the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Ledger:
    """Commits below one folder, numbered from 1; each has rows of one schema."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType):
        self._spark = spark
        self._schema = schema
        # the underscore hides the log from readers of the table beside it
        self.root = f"{root.rstrip('/')}/_commits"

    def commits(self) -> list[int]:
        """Numbers of the finished commits, one per run so far."""
        path = self._spark._jvm.org.apache.hadoop.fs.Path(self.root)
        fs = path.getFileSystem(self._spark._jsc.hadoopConfiguration())
        if not fs.exists(path):
            return []
        found = []
        for folder in fs.listStatus(path):
            number = folder.getPath().getName().removeprefix("commit=")
            done = self._spark._jvm.org.apache.hadoop.fs.Path(folder.getPath(), "_SUCCESS")
            if number.isdigit() and fs.exists(done):
                found.append(int(number))
        return sorted(found)

    def next(self) -> int:
        return max(self.commits(), default=0) + 1

    def entries(self) -> DataFrame:
        """Rows of all finished commits, each with the number of its ``commit``."""
        commits = self.commits()
        schema = T.StructType([*self._schema.fields, T.StructField("commit", T.IntegerType())])
        if not commits:
            return self._spark.createDataFrame([], schema)
        paths = [f"{self.root}/commit={n}" for n in commits]
        return self._spark.read.schema(schema).option("basePath", self.root).parquet(*paths)

    def append(self, rows: DataFrame, number: int) -> None:
        """Finish commit ``number``; one file, so that it is there as a whole or not at all.

        What a run that died left in its place is replaced; a finished commit is an error.
        """
        if number in self.commits():
            raise ValueError(f"commit {number} of {self.root!r} is finished")
        columns = [F.col(f.name).cast(f.dataType) for f in self._schema.fields]
        rows.select(*columns).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/commit={number}")
