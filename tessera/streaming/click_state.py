"""The ad-click black list with one state per user.

The rule is that of ``blacklist``: a user's clicks of a batch are judged with the flag as it
was when the batch began.  Clicks are counted per (user, day, ad) inside their task, and a
user's counts travel as one row of a task, there and back, so that a hot user is a few rows;
the state of a user is a flag and a map of running counts, which goes once the user is
listed.  The counts of a month and of ADS ads side by side share an
entry of the map, since each entry is a call: a user's batch reads and writes the entries of
its own months, and an entry has a bounded size.  The flag is a call too, left out for a
user who has counts.  Counts are JSON texts {"day/ad": n} on their way and in the state:
there, each element of an array is gone through in Python and again in the JVM.  A batch
touches the state of its own users only, so its cost does not depend on the batches before
it.  Changed counts and newly listed users go out as rows; ``tables`` keeps them as keyed
logs, whose readers take a snapshot and later deltas.

``ttl`` (a duration; processing time) lets the running count of a (day, ad) go that long
after its last click, which bounds the state of users who are never listed; the result
tables keep it.  Each (day, ad) then has an entry, and with it a time, of its own.
"""

from __future__ import annotations

import datetime
import json
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tessera.streaming.blacklist import THRESHOLD
from tessera.streaming.keyed_log import EVERY, KeyedLog
from tessera.streaming.panes import counted

JUDGED = "userid long, counts string, listed boolean"
COUNTS = "dt string, userid long, adid long, count long"
BLACK = "userid long"
MONTH = len("yyyy-MM")
ADS = 64                   # ads of an entry of the state


class UserClicks(StatefulProcessor):
    """Input rows (user, counts); an output row of JUDGED per user: the changed counts, and whether the user gets listed."""

    def __init__(self, threshold: int, ttl_ms: int | None = None):
        self.threshold, self.ttl_ms = threshold, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.listed = handle.getValueState("listed", "listed boolean")
        self.counts = handle.getMapState("counts", "block string", "counts string", self.ttl_ms)
        self.found = False

    def _block(self, at: str) -> str:
        if self.ttl_ms is not None:
            return at
        day, _, ad = at.rpartition("/")
        return f"{day[:MONTH]}/{int(ad) // ADS}"

    def _held(self, block: str) -> dict[str, int]:
        """An entry's counts.  Behind an entry that was there the next one is read at once: one
        call, not two.  Behind one that was not it is looked for first, since Spark logs a
        warning for each read of an entry that is not there."""
        value = self.counts.getValue((block,)) if self.found or self.counts.containsKey((block,)) else None
        self.found = value is not None
        return json.loads(value[0]) if self.found else {}

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        batch: dict[str, dict[str, int]] = {}
        for row in rows:  # the tasks' partial counts
            for at, n in json.loads(row.counts).items():
                new = batch.setdefault(self._block(at), {})
                new[at] = new.get(at, 0) + n
        out, over, blocks = {}, False, {}
        for i, (block, new) in enumerate(batch.items()):
            held = self._held(block)
            if i == 0 and not held and self.listed.exists():  # a user with counts is not listed
                return
            added = {at: n + held.get(at, 0) for at, n in new.items() if n < self.threshold}
            over |= len(added) < len(new) or any(n >= self.threshold for n in added.values())
            if added:
                blocks[block] = held | added
                out.update(added)
        if over:
            self.listed.update((True,))
            self.counts.clear()  # a listed user's clicks count no more
        else:
            for block, held in blocks.items():
                self.counts.updateValue((block,), (json.dumps(held),))
        yield Row(userid=key[0], counts=json.dumps(out), listed=over)

    def close(self) -> None:
        pass


def click_counts(clicks: DataFrame) -> DataFrame:
    """(user, counts): clicks per "day/ad" counted in each task, a row per user; rows without a user, day or ad count nowhere."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = list(counted(batches, ["user", "at"]))
        if parts:
            users = pa.Table.from_batches(parts).group_by("user", use_threads=False).aggregate([("at", "list"), ("n", "list")])
            yield from users.select(["user", "at_list", "n_list"]).rename_columns(["user", "at", "n"]).to_batches()

    rows = clicks.where("user is not null and day is not null and ad is not null")
    at = F.concat_ws("/", F.col("day").cast("string"), F.col("ad").cast("long").cast("string"))
    users = rows.select(F.col("user").cast("long").alias("user"), at.alias("at")).mapInArrow(
        count, "user long, at array<string>, n array<long>")
    return users.select("user", F.to_json(F.map_from_arrays("at", "n")).alias("counts"))


def judged(clicks: DataFrame, threshold: int = THRESHOLD, ttl: datetime.timedelta | None = None) -> DataFrame:
    """Rows (dt, userid, adid, count, listed) from a stream of clicks, in update mode; ``listed``
    ones have no count.  Start the query inside ``panes.keyed_state``."""
    ms = None if ttl is None else int(ttl.total_seconds() * 1000)
    changes = click_counts(clicks).groupBy("user").transformWithState(
        UserClicks(threshold, ms), JUDGED, "Update", "None" if ms is None else "ProcessingTime")
    counts = F.map_entries(F.from_json("counts", "map<string, long>"))
    listing = F.when(F.col("listed"), F.array(F.lit(None))).otherwise(F.array())
    at, ad = F.col("at.key"), F.substring_index("at.key", "/", -1)
    return changes.select("userid", F.explode(F.concat(counts, listing)).alias("at")).select(
        F.left(at, F.length(at) - F.length(ad) - 1).alias("dt"), "userid", ad.cast("long").alias("adid"),
        F.col("at.value").alias("count"), F.col("at").isNull().alias("listed"))


def tables(spark: SparkSession, out: str, every: int = EVERY) -> tuple[KeyedLog, KeyedLog]:
    """(user_ad_count, black_list) as keyed logs under ``out``."""
    return (KeyedLog(spark, f"{out}/counts", ["dt", "userid", "adid"], COUNTS, every),
            KeyedLog(spark, f"{out}/black", ["userid"], BLACK, every))


def sink(spark: SparkSession, out: str, every: int = EVERY) -> Callable[[DataFrame, int], None]:
    """foreachBatch function over the rows of ``judged``."""
    counts, black = tables(spark, out, every)

    def write(rows: DataFrame, batch_id: int) -> None:
        rows.persist()  # the state must run once
        try:
            counts.write(rows.where("not listed"), batch_id)
            black.write(rows.where("listed"), batch_id)
        finally:
            rows.unpersist()
    return write
