"""Structured Streaming forms of the access, pickup and delay jobs.

The transformations are the batch functions; only time handling is added.
Event times without a zone are cast to timestamps, as watermarks need one.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState

from ferrolith.functions import text
from ferrolith.operators.joins import with_problem_flag
from ferrolith.plans import access
from ferrolith.session import new_folder


def timed(stream: DataFrame, moment: str, delay: str = "10 minutes") -> DataFrame:
    return stream.withColumn(moment, F.col(moment).cast("timestamp")).withWatermark(moment, delay)


def access_decisions(reads: DataFrame, residents: DataFrame) -> DataFrame:
    """Decide each read against a registry table as it was when the stream began (see ``live_decisions`` for one that changes)."""
    return access.audit_log(access.decide(reads, residents))


def distinct_passages(reads: DataFrame, key: str, moment: str, minutes: int = 5, delay: str = "10 minutes") -> DataFrame:
    """One read per plate and time slot; state is dropped once the watermark has passed the slot."""
    slots = timed(reads, moment, delay).withColumn(
        "slot", F.floor(F.unix_micros(moment) / (minutes * 60_000_000)).cast("bigint"))
    return slots.dropDuplicatesWithinWatermark([key, "slot"])


def hourly_counts(events: DataFrame, moment: str, by: str, value: str, delay: str = "10 minutes") -> DataFrame:
    """Count and sum per hour and type, emitted when the hour is complete."""
    windows = timed(events, moment, delay).groupBy(F.window(moment, "1 hour"), by)
    return windows.agg(F.count("*").alias("n"), F.sum(value).alias("total")).select(
        F.col("window.start").cast("timestamp_ntz").alias("hour_start"), by, "n", "total")


def passages(reads: DataFrame, key: str, moment: str, minutes: int = 5, delay: str = "10 minutes") -> DataFrame:
    """(``key``, first_seen, last_seen, reads): one row per passage, emitted once the watermark has passed its end.

    Reads of a plate belong together while the next one follows within
    ``minutes``; a late read that lies between two passages makes them one.
    """
    sessions = timed(reads, moment, delay).groupBy(key, F.session_window(moment, f"{minutes} minutes"))
    return sessions.agg(F.min(moment).alias("first_seen"), F.max(moment).alias("last_seen"), F.count("*").alias("reads")).select(
        key, "first_seen", "last_seen", "reads")


#: Copies of a plate's registry state, so that one plate's reads spread over tasks, and groups of plates that share a state.
SHARES, GROUPS = 8, 1024
_ENTRY = "plate array<string>, at array<long>, there array<boolean>, acces array<string>, marque array<string>, nom array<string>"


def live_decisions(reads: DataFrame, changes: DataFrame, read_id: str, moment: str = "timestamp", plate: str = "plate_number",
                   confidence: str = "detection_confidence", least: float = 0.5, keep: str = "1 day") -> DataFrame:
    """(``read_id``, plaque, timestamp, resultat, normalized_plate, resident_name) of confident reads, as both streams go on.

    ``changes`` has op (add, delete, toggle), plaque, marque, nom, acces,
    ``moment`` and seq, which orders changes of one moment. A read is decided by
    the changes up to its moment that have arrived with it or before; a change of
    the same moment counts. An add for a plate that is there is rejected, a
    toggle for one that is not does nothing. The state holds a plate's
    entries of the last ``keep`` before its newest row and the one before them,
    so late reads find what held at their time and the state does not grow.
    Plates share a state in ``GROUPS`` groups by a hash, as a call per plate
    costs far more than its few rows.
    """
    length = reads.sparkSession.sql(f"SELECT CAST(INTERVAL '{keep}' AS INTERVAL DAY TO SECOND) AS d").first()["d"]
    span = int(length.total_seconds() * 1e6)
    confident = reads.filter((F.col(confidence) >= least) & (F.trim(plate) != ""))
    mine = confident.select(
        text.plate_key(F.col(plate)).alias("normalized_plate"), F.pmod(F.xxhash64(read_id), F.lit(SHARES)).cast("int").alias("share"),
        F.unix_micros(F.col(moment).cast("timestamp")).alias("at"), F.col(read_id).cast("long").alias("seq"), F.lit(None).cast("string").alias("op"),
        F.col(plate).alias("plaque"), *[F.lit(None).cast("string").alias(c) for c in ("acces", "marque", "nom")])
    theirs = changes.select(
        text.plate_key(F.col("plaque")).alias("normalized_plate"), F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1))).alias("share"),
        F.unix_micros(F.col(moment).cast("timestamp")).alias("at"), F.col("seq").cast("long").alias("seq"), "op", "plaque", "acces", "marque", "nom")
    moment_of = itemgetter(0)

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(frames)).sort_values(["at", "seq"], kind="stable")
        entries: dict[str, list[tuple]] = {}
        for name, *entry in zip(*state.get, strict=True) if state.exists else ():
            entries.setdefault(name, []).append(tuple(entry))
        changed = rows[rows["op"].notna()]
        for name, at, op, *values in zip(*(changed[c].tolist() for c in ("normalized_plate", "at", "op", "acces", "marque", "nom")), strict=True):
            own = entries.get(name, [])
            place = bisect_right(own, at, key=moment_of)
            there, *last = own[place - 1][1:] if place else (False, None, None, None)
            if op == "add" and not there:
                new = (True, *values)
            elif op == "delete":
                new = (False, None, None, None)
            elif op == "toggle" and there:
                new = (True, "non" if last[0] == "oui" else "oui", *last[1:])
            else:
                continue
            own.insert(place, (int(at), *new))
            entries[name] = own
        held = rows[rows["op"].isna()]
        if len(held):
            found = []
            for name, at in zip(held["normalized_plate"].tolist(), held["at"].to_numpy(np.int64).tolist(), strict=True):
                own = entries.get(name, [])
                place = bisect_right(own, at, key=moment_of)
                found.append(own[place - 1] if place else (0, False, None, None, None))
            yield pd.DataFrame({
                read_id: held["seq"], "plaque": held["plaque"], "at": held["at"], "resultat": [
                    access.AUTHORISED if e[1] and e[2] == "oui" else access.REFUSED for e in found],
                "normalized_plate": held["normalized_plate"], "resident_name": [e[4] if e[1] else None for e in found]})
        seen = rows.dropna(subset="at").drop_duplicates("normalized_plate", keep="last")  # rows are in order of time
        for name, at in zip(seen["normalized_plate"].tolist(), seen["at"].tolist(), strict=True):
            if own := entries.get(name):
                entries[name] = own[max(bisect_right(own, max(int(at), own[-1][0]) - span, key=moment_of) - 1, 0):]
        if entries:
            state.update(tuple(map(list, zip(*((name, *e) for name, own in entries.items() for e in own), strict=True))))

    both = mine.unionByName(theirs).withColumn("group", F.pmod(F.xxhash64("normalized_plate"), F.lit(GROUPS)).cast("int"))
    decided = both.groupBy("group", "share").applyInPandasWithState(
        step, f"{read_id} long, plaque string, at long, resultat string, normalized_plate string, resident_name string", _ENTRY, "append", "NoTimeout")
    return decided.select(read_id, "plaque", F.timestamp_micros("at").cast("timestamp_ntz").alias("timestamp"), "resultat", "normalized_plate", "resident_name")


def late_alerts(rentals: DataFrame, previous: DataFrame, row_id: str, previous_id: str, delay: str, gap: str, moment: str,
                within: str = "31 days", lateness: str = "10 minutes") -> DataFrame:
    """Each rental with a previous one, whether that was later than the gap allows (``is_problem``), and its delay.

    Both sides are streams, so a previous rental may arrive first or last. Its
    ``moment`` must lie ``within`` that time of the rental's; both sides have a
    watermark, so rows leave the state when their time is over, and a rental
    whose previous one never came is returned then without a delay.
    """
    followers = timed(rentals.filter(F.col(previous_id).isNotNull() & F.col(gap).isNotNull()), moment, lateness)
    ended = timed(previous.select(F.col(row_id).alias("_ended"), F.col(delay).alias("prev_delay"), F.col(moment).alias("_ended_at")), "_ended_at", lateness)
    span = F.expr(f"INTERVAL {within}")
    joined = followers.join(ended, (F.col(previous_id) == F.col("_ended")) & (F.col("_ended_at") >= F.col(moment) - span) & (
        F.col("_ended_at") <= F.col(moment) + span), "leftOuter")
    return with_problem_flag(joined, F.col("prev_delay"), F.col(gap)).drop("_ended", "_ended_at")


def run_to_folder(stream: DataFrame, label: str, folder: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """Process what is there, append it to Parquet exactly once, and return the files as a table.

    Both folders default to fresh ones in the shared folder; pass the same
    ones again to continue where the last run stopped.
    """
    spark: SparkSession = stream.sparkSession
    folder = folder or new_folder(spark, f"{label}-out")
    checkpoint = checkpoint or new_folder(spark, f"{label}-state")
    query = (
        stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
        .option("path", folder).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(folder)
