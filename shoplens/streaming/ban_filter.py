"""Q5 on a stream: drop clicks of banned users; ban a user once their clicks
on one ad in one day reach the threshold (T7, J3, A9, S17, S18).

The state is two tables on the shared file system, each a set of segments
(``sinks/segments.py``): clicks per (date, user, ad), added up, and bans, the
first per user.  A micro-batch

  1. anti-joins its clicks with the bans of earlier batches and writes what is
     kept (the crossing batch's own clicks still count),
  2. counts what it kept per (date, user, ad),
  3. adds the earlier counts of just those keys; a key at the threshold (``>=``,
     K11) bans its user from the *next* batch on (once, never cleared: K12),
  4. commits kept clicks, counts and bans as one entry of the commit log.

All of it is joins and aggregates in the JVM: a user with a third of the
clicks is one row per task after the partial count, and the ban table has one
row per user.  A batch that is replayed after its commit adds nothing, one that
died before it starts afresh; the state outlives a checkpoint.

The output folder holds ``epoch=<n>`` per commit, rows of ``kind`` click or ban.
It is written aside and moved in after the commit, so a reader of the folder
sees whole commits only; a move that a crash prevented is made up by the next
batch or start.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens.functions import constants as K
from shoplens.plans.ads import with_date
from shoplens.sinks import fs
from shoplens.sinks import segments as S
from shoplens.sinks.commits import KEEP_SECONDS, Commit, CommitLog, writer_of

OUTPUT_SCHEMA = T.StructType(
    [
        T.StructField(name, T.LongType() if name in ("timestamp", "arrival") else T.StringType())
        for name in ("kind", "timestamp", "area", "city", "userid", "adid", "date", "arrival")
    ]
)
COUNTS_SCHEMA = "date STRING, userid STRING, adid STRING, cnt BIGINT"
BANS_SCHEMA = "userid STRING, ban_date STRING"
_COUNT_KEYS = ["date", "userid", "adid"]


def _shaped(rows: DataFrame) -> DataFrame:
    """The output's columns, null where ``rows`` lacks one."""
    have = set(rows.columns)
    return rows.select(
        *[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in OUTPUT_SCHEMA]
    )


class BanFilter:
    """The state and output of one ban filter, in one folder.

    ``count_days``: drop counts of days more than that many before the newest
    day seen when segments are merged and when counts are looked up, so the
    state does not grow with the years (a click that comes later for such a
    day starts its count anew: a documented difference).  Default: keep all."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        threshold: int = K.BAN_THRESHOLD,
        tz: str = "UTC",
        count_days: int | None = None,
        keep_seconds: float = KEEP_SECONDS,
    ):
        self.spark, self.root = spark, root.rstrip("/")
        self.threshold, self.tz, self.count_days = threshold, tz, count_days
        self.log = CommitLog(spark, f"{self.root}/_state", keep_seconds)
        self.add_up = S.summed(_COUNT_KEYS, "cnt")
        self.first_ban = S.least(["userid"], "ban_date")

    # --- state ---

    def bans(self) -> DataFrame:
        """(userid, ban_date) committed so far."""
        latest = self.log.latest()
        return self.first_ban(S.read(self.spark, latest.body["bans"] if latest else [], BANS_SCHEMA))

    def counts(self) -> DataFrame:
        """(date, userid, adid, cnt) of the clicks kept so far."""
        latest = self.log.latest()
        return self.add_up(S.read(self.spark, latest.body["counts"] if latest else [], COUNTS_SCHEMA))

    def settle(self, latest: Commit | None) -> None:
        """Move the last commit's output into view, if that was not done."""
        if latest is not None:
            to = f"{self.root}/epoch={latest.epoch:012d}"
            if not fs.exists(self.spark, to) and fs.exists(self.spark, latest.body["staged"]):
                fs.rename(self.spark, latest.body["staged"], to)

    # --- a micro-batch ---

    def process(self, clicks: DataFrame, batch_id: int) -> None:
        latest = self.log.latest()
        self.settle(latest)
        writer = writer_of(clicks)
        if CommitLog.replayed(latest, writer, batch_id):
            return
        staged = f"{self.root}/_staged/{self.log.new_path().rsplit('/', 1)[1]}"
        fs.mkdirs(self.spark, f"{self.root}/_staged")
        self._keep(clicks, S.read(self.spark, latest.body["bans"] if latest else [], BANS_SCHEMA), staged)

        kept = self.spark.read.schema(OUTPUT_SCHEMA).parquet(staged)
        delta = kept.groupBy(*_COUNT_KEYS).agg(F.count(F.lit(1)).alias("cnt"))
        days = [F.min("date").alias("first"), F.max("date").alias("last")]
        added = S.write(self.log, delta, ["date"], days)
        seen = added.pop("seen")
        first, newest = seen["first"], seen["last"]
        held = {"counts": [*(latest.body["counts"] if latest else []), added], "bans": latest.body["bans"] if latest else []}
        if first is not None:
            new = self._new_bans(latest, added, first, newest)
            banned = S.write(self.log, new, watch=[F.count(F.lit(1)).alias("n")])
            if banned.pop("seen")["n"]:
                held["bans"] = [*held["bans"], banned]
                told = self.spark.read.schema(BANS_SCHEMA).parquet(banned["path"])
                out = told.select(F.lit("ban").alias("kind"), "userid", F.col("ban_date").alias("date"))
                _shaped(out).write.mode("append").parquet(staged)
        held["newest"] = max(d for d in (newest, latest and latest.body["newest"], "") if d is not None)
        held["counts"] = S.compact(self.log, held["counts"], COUNTS_SCHEMA, self._forgetful(held["newest"]), ["date"])
        held["bans"] = S.compact(self.log, held["bans"], BANS_SCHEMA, self.first_ban)
        self.settle(self.log.commit(held | {"staged": staged}, latest, writer, batch_id))

    def _keep(self, clicks: DataFrame, bans: DataFrame, path: str) -> None:
        dated = with_date(clicks, self.tz).withColumn("kind", F.lit("click"))
        _shaped(dated.join(bans.select("userid"), "userid", "left_anti")).write.parquet(path)

    def _since(self, newest: str):
        """Days whose counts are still held."""
        return F.col("date") >= F.date_format(F.date_sub(F.lit(newest).cast("date"), self.count_days), K.DATE_FORMAT)

    def _forgetful(self, newest: str) -> S.Merge:
        if self.count_days is None or not newest:
            return self.add_up
        return lambda rows: self.add_up(rows.filter(self._since(newest)))

    def _new_bans(self, latest: Commit | None, added: dict, first: str, last: str) -> DataFrame:
        """(userid, ban_date) of the users that this batch, with clicks from the
        day ``first`` to ``last``, brings to the threshold."""
        delta = self.spark.read.schema(COUNTS_SCHEMA).parquet(added["path"])
        before = S.read(self.spark, latest.body["counts"] if latest else [], COUNTS_SCHEMA)
        # the batch's days, as literals that prune files sorted by day
        before = before.filter(F.col("date").between(first, last))
        if self.count_days is not None:
            before = before.filter(self._since(max(last, latest.body["newest"] if latest else last)))
        before = before.join(delta.select(*_COUNT_KEYS), _COUNT_KEYS, "left_semi")
        reached = self.add_up(delta.unionByName(before)).filter(F.col("cnt") >= self.threshold)
        return reached.groupBy("userid").agg(F.min("date").alias("ban_date"))


def kept_clicks(filtered: DataFrame) -> DataFrame:
    return filtered.filter(F.col("kind") == "click").drop("kind")


def bans(filtered: DataFrame) -> DataFrame:
    return filtered.filter(F.col("kind") == "ban").select("userid", F.col("date").alias("ban_date"))
