"""Tables of written batches that count from the moment a log names them.

A table is a folder with ``data``, one folder per batch, and ``log``, one small file per commit, numbered from 1.
Batches are written first and then named by a commit, which is one exclusive write of a few bytes. So
readers never meet a half-written batch, an attempt that dies before its commit leaves nothing that counts, and of two
writers that take the same number one fails and takes the next.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


class CommitLog:
    """The numbered commits of a folder; each is a JSON object."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _folder(self):
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/log")
        return folder, folder.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def commits(self) -> list[tuple[int, dict]]:
        """Numbers and contents in order; a file that its writer did not finish is no commit."""
        folder, files = self._folder()
        if not files.exists(folder):
            return []
        read = self.spark.read.text(f"{self.path}/log", wholetext=True).selectExpr("value", "_metadata.file_name AS name").collect()
        found = []
        for row in read:
            try:
                found.append((int(row["name"]), json.loads(row["value"])))
            except ValueError:
                continue
        return sorted(found, key=lambda commit: commit[0])

    def last_number(self) -> int:
        """The highest number taken, finished or not; 0 if none is."""
        folder, files = self._folder()
        names = [status.getPath().getName() for status in files.listStatus(folder)] if files.exists(folder) else []
        return max((int(name) for name in names if name.isdigit()), default=0)

    def publish(self, number: int, content: dict) -> bool:
        """Write commit ``number``; False if it is taken."""
        folder, files = self._folder()
        place = self.spark._jvm.org.apache.hadoop.fs.Path(folder, f"{number:012d}")
        if files.exists(place):
            return False
        try:
            out = files.create(place, False)
        except Exception as error:
            if "exist" in str(error).lower():
                return False
            raise
        out.write(bytearray(json.dumps(content).encode()))
        out.close()
        return True


class CommittedTable:
    """Rows appended in batches, read as far as they are committed."""

    def __init__(self, spark: SparkSession, path: str, schema: str | StructType | None = None):
        """``schema`` is what the table reads as before its first batch; without it the table then has no columns."""
        self.spark, self.log = spark, CommitLog(spark, path)
        self.schema = schema or StructType([])

    def append(self, df: DataFrame, key: str | None = None, expected: int | None = None, place: dict | None = None, **notes) -> bool:
        """Write ``df`` as a batch and commit it with ``notes``. False, and no rows, if it does not count.

        ``place``, columns with one value for the batch, names its folder, where it replaces what an attempt without a commit left; without it the
        batch gets a folder of its own. A batch whose ``key`` is committed already is not written again. With ``expected``, the batch counts only if that was the
        last number taken, so what was worked out from the table's state still holds.
        """
        if key is not None and any(c.get("key") == key for _, c in self.log.commits()):
            return False
        folder = "/".join(f"{k}={v}" for k, v in place.items()) if place else f"data/{uuid.uuid4().hex}"
        rows = df.drop(*place) if place else df
        rows.write.mode("overwrite").parquet(f"{self.log.path}/{folder}")
        content = {"key": key, "data": folder, "schema": df.schema.json(), **notes}
        while True:
            number = self.log.last_number() if expected is None else expected
            if self.log.publish(number + 1, content):
                return True
            if expected is not None or key is not None and any(c.get("key") == key for _, c in self.log.commits()):
                return False

    def read(self) -> DataFrame:
        """All committed rows, each once. Before the first commit the table is empty."""
        commits = [c for _, c in self.log.commits()]
        if not commits:
            return self.spark.createDataFrame([], self.schema)
        schema = StructType.fromJson(json.loads(commits[-1]["schema"]))
        reader = self.spark.read.schema(schema).option("basePath", self.log.path)
        return reader.parquet(*[f"{self.log.path}/{c['data']}" for c in commits])
