"""Published tables (S14-S16): results as Parquet behind a commit log.

``SnapshotTable`` replaces its frames as one version; ``KeyedTable`` takes
changed rows and shows the newest row of every key.  Readers see a commit whole
or not at all.  A reader that reads on while new versions come opens the table
with ``open``, whose lease keeps its version's files; otherwise they stay for
``keep_seconds`` after being replaced.  Versions are the log's epochs, so
neither a replayed batch nor a reset checkpoint brings old rows back
(``sinks/commits.py``).
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens.sinks import segments as S
from shoplens.sinks.commits import KEEP_SECONDS, Commit, CommitLog


class SnapshotTable:
    """One or more frames, replaced together."""

    def __init__(
        self, spark: SparkSession, root: str, keep_seconds: float = KEEP_SECONDS, clock: Callable[[], float] = time.time
    ):
        self.log = CommitLog(spark, root, keep_seconds, clock)
        self.spark = spark

    def publish(
        self,
        frames: DataFrame | Mapping[str, DataFrame],
        batch_id: int | None = None,
        writer: str = "",
        note: dict | None = None,
    ) -> Commit:
        """Replace the frames; ``note`` is kept with the version.  A batch that
        is already published changes nothing."""
        latest = self.log.latest()
        if CommitLog.replayed(latest, writer, batch_id):
            return latest
        path = self.log.new_path()
        frames = frames if isinstance(frames, Mapping) else {"rows": frames}
        for name, df in frames.items():
            df.write.parquet(f"{path}/{name}")
        body = {"data": {"path": path, "frames": list(frames)}, "note": note or {}}
        return self.log.commit(body, latest, writer, batch_id)

    def _frame(self, commit: Commit | None, name: str, schema) -> DataFrame | None:
        if commit is None:
            return self.spark.createDataFrame([], schema) if schema is not None else None
        reader = self.spark.read.schema(schema) if schema is not None else self.spark.read
        return reader.parquet(f"{commit.body['data']['path']}/{name}")

    def read(self, name: str = "rows", schema=None) -> DataFrame | None:
        """The current version of a frame; before the first, None, or an empty
        frame where ``schema`` is given."""
        return self._frame(self.log.latest(), name, schema)

    @contextmanager
    def open(self, name: str = "rows", schema=None, seconds: float = KEEP_SECONDS) -> Iterator[DataFrame | None]:
        """``read`` of a version that stays until the block ends."""
        with self.log.lease(seconds) as commit:
            yield self._frame(commit, name, schema)

    def note(self) -> dict:
        latest = self.log.latest()
        return latest.body["note"] if latest else {}


class KeyedTable:
    """Rows by key, updated by the rows that changed.

    An update writes its own rows and a commit; segments of like size are
    merged now and then (``sinks/segments.py``).  Null keys are keys like any
    other; of rows of one key within one update any one may win."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: str | T.StructType,
        keys: Sequence[str],
        keep_seconds: float = KEEP_SECONDS,
        fanout: int = S.FANOUT,
        clock: Callable[[], float] = time.time,
    ):
        self.log = CommitLog(spark, root, keep_seconds, clock)
        self.spark, self.keys, self.fanout = spark, list(keys), fanout
        self.schema = spark.createDataFrame([], schema).schema
        self.columns = [f.name for f in self.schema]
        self.stored = T.StructType([*self.schema.fields, T.StructField(S.EPOCH, T.LongType())])
        self.merge = S.newest(self.keys)

    def upsert(self, changed: DataFrame, batch_id: int | None = None, writer: str = "") -> Commit:
        latest = self.log.latest()
        if CommitLog.replayed(latest, writer, batch_id):
            return latest
        epoch = latest.epoch + 1 if latest else 0
        rows = changed.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema])
        added = S.write(self.log, rows.withColumn(S.EPOCH, F.lit(epoch).cast("bigint")), self.keys)
        held = [*(latest.body["segments"] if latest else []), added]
        held = S.compact(self.log, held, self.stored, self.merge, self.keys, self.fanout)
        return self.log.commit({"segments": held}, latest, writer, batch_id)

    def _rows(self, commit: Commit | None) -> DataFrame:
        held = commit.body["segments"] if commit else []
        return self.merge(S.read(self.spark, held, self.stored)).select(*self.columns)

    def read(self) -> DataFrame:
        """The newest row of every key; filters on keys reach the files."""
        return self._rows(self.log.latest())

    @contextmanager
    def open(self, seconds: float = KEEP_SECONDS) -> Iterator[DataFrame]:
        with self.log.lease(seconds) as commit:
            yield self._rows(commit)

    def segments(self) -> list[dict]:
        latest = self.log.latest()
        return latest.body["segments"] if latest else []
