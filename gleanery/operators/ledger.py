"""Incremental state: an append-only event log, listing differences, edit replay, run history."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import HANDLED_AGAIN, NO_ORIGINAL


def current(events: DataFrame, key: str, seq: str, status: str) -> DataFrame:
    """Each record's last status, how often it was tried and how many events it has."""
    return events.groupBy(key).agg(F.max_by(status, seq).alias("status"), F.min(seq).alias("first_seq"), F.max(seq).alias("last_seq"), F.count("*").alias("n_events"))


def histogram(state: DataFrame, status: str = "status") -> DataFrame:
    return state.groupBy(status).agg(F.count("*").alias("n"), F.count_if(F.col(status).endswith("_failed")).alias("failed"))


def by_status(state: DataFrame, *statuses: str) -> DataFrame:
    return state.where(F.col("status").isin(*statuses))


def pending(state: DataFrame, ready: tuple[str, ...], failed: str, retry_failed: bool = False) -> DataFrame:
    """Records whose status is among those that a step takes up, the failed ones only if they are to be tried again."""
    return by_status(state, *ready, *([failed] if retry_failed else []))


def listing_diff(listing: DataFrame, state: DataFrame) -> DataFrame:
    """What to do with each entry of a listing (drive_id, path, md5, suffix): skip, ignored, duplicate, new_version, again or new; and `renamed`.

    suffix is what archive_kind tells, null for what is no archive. state (drive_id, path, md5, status, seq) is what is known in the order that it came to be, one row for each drive_id and md5. Records that
    are new, failed, under way or ignored are looked at again, all others are skipped. Of entries with one md5 the record that came last, else the first by path, is the original; failed, ignored
    and duplicate records are no originals.
    """
    had = state.select("drive_id", "md5", F.col("path").alias("old_path"), "status")
    ids = state.groupBy("drive_id").agg(F.count("*").alias("versions"))
    owner = state.where(~F.col("status").isin(*NO_ORIGINAL)).groupBy("md5").agg(F.max_by(F.struct("path", "drive_id"), "seq").alias("owner"))
    seen = listing.join(had, ["drive_id", "md5"], "left").join(ids, "drive_id", "left").join(owner, "md5", "left")
    open_ = F.col("status").isNull() | F.col("status").isin(*HANDLED_AGAIN)
    # an entry that is taken up is the original from then on; one whose md5 has another original is not taken up
    mine = F.col("owner").isNull() | (F.col("owner.drive_id") == F.col("drive_id"))
    takes = seen.where(open_ & F.col("suffix").isNotNull() & mine).groupBy("md5").agg(F.min(F.struct("path", "drive_id")).alias("first"))
    seen = seen.join(takes, "md5", "left")
    action = (
        F.when(~open_, "skip").when(F.col("suffix").isNull(), "ignored").when(~mine, "duplicate")
        .when((F.col("owner").isNull()) & ((F.col("first.path") != F.col("path")) | (F.col("first.drive_id") != F.col("drive_id"))), "duplicate")
        .when(F.col("status").isNotNull(), "again").when(F.col("versions") > 0, "new_version").otherwise("new")
    )
    return seen.select("drive_id", "path", "md5", action.alias("action"), F.coalesce(F.col("old_path") != F.col("path"), F.lit(False)).alias("renamed"))


def completed(marks: DataFrame, run: str, seq: str, mark: str) -> DataFrame:
    """Runs that are marked complete: their last mark is 'done', not 'unmarked'."""
    return marks.groupBy(run).agg(F.max_by(mark, seq).alias("mark"), F.max(seq).alias("seq")).where("mark = 'done'").select(run, "seq")


def edited(changes: DataFrame, session: str, cell: str, seq: str, op: str, value: str) -> DataFrame:
    """session, cell, value after edits, undos and redos, of cells that hold a value at the end.

    An undo takes back the session's last edit that stands, whatever its cell; a redo does the last undone one again; an edit forgets what could be
    redone. Undos and redos with nothing to do are no errors. Each depends on all before it, so a session is one task's work.
    """
    kinds = {f.name: f.dataType for f in changes.schema}

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by(seq)
        held, done, undone = {}, [], []
        for c, what, v in zip(*(table.column(x).to_pylist() for x in (cell, op, value))):
            if what == "undo":
                if done:
                    undone.append(done.pop())
                    held[undone[-1][0]] = undone[-1][1]
            elif what == "redo":
                if undone:
                    done.append(undone.pop())
                    held[done[-1][0]] = done[-1][2]
            else:
                done.append((c, held.get(c), v))
                undone.clear()
                held[c] = v
        held = {c: v for c, v in held.items() if v is not None}
        one = table.column(session).slice(0, 1)
        return pa.table({session: pa.chunked_array([one.combine_chunks()] * len(held), table.schema.field(session).type), cell: pa.array(list(held), table.schema.field(cell).type), value: pa.array(list(held.values()), table.schema.field(value).type)})

    narrow = changes.select(session, cell, seq, op, value)
    return narrow.groupBy(session).applyInArrow(run, ", ".join(f"`{c}` {kinds[c].simpleString()}" for c in (session, cell, value)))


def frame_positions(files: DataFrame, sequence: str, path: str) -> DataFrame:
    """files with `position`: the place, from 0, of each in its sequence, ordered by the parts of its path: a/x stands before a-b/x."""
    return files.withColumn("position", F.row_number().over(Window.partitionBy(sequence).orderBy(F.split(path, "/"))) - 1)


def seeded_sample(rows: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """n rows by the SHA-256 of seed:key, the same ones whatever the partitions; each task keeps n at most."""
    return rows.orderBy(F.sha2(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")), 256), key).limit(n)


def attempts(events: DataFrame, key: str, status: str, tried: str) -> DataFrame:
    return events.groupBy(key).agg(F.count_if(F.col(status) == tried).alias("attempts"))


def replayed(changes: DataFrame, cell: list[str], seq: str, op: str, value: str) -> DataFrame:
    """The value of each cell after edits and undos: an undo takes back the last edit of its cell that still stands.

    Walking back from the end, an edit stands if no more undos than edits follow it up to there.
    """
    w = Window.partitionBy(*cell).orderBy(F.desc(seq)).rowsBetween(Window.unboundedPreceding, 0)
    # running balance of undos less edits, from the end; the first edit that brings it below zero is the one that stands
    step = F.when(F.col(op) == "undo", 1).otherwise(-1)
    level = changes.withColumn("_b", F.sum(step).over(w))
    stands = level.where((F.col(op) != "undo") & (F.col("_b") < 0))
    return stands.groupBy(*cell).agg(F.max_by(value, seq).alias(value))


def run_history(runs: DataFrame, command: str, exit_code: Column, seconds: str) -> DataFrame:
    failed = exit_code.isNotNull() & (exit_code != 0)
    return runs.groupBy(command).agg(F.count("*").alias("runs"), F.count_if(failed).alias("failures"), F.max(seconds).alias("longest"))


def best_rows(rows: DataFrame, group: str, metric: str, order: list[str]) -> DataFrame:
    """By group the row of the highest metric, the first on a tie; how many rows there were."""
    best = F.min_by(F.struct(F.col(metric).alias("best"), *order), F.struct((-F.col(metric)).alias("m"), *order)).alias("b")
    return rows.groupBy(group).agg(best, F.count("*").alias("epochs")).select(group, F.round("b.best", 4).alias("best"), *(F.col(f"b.{c}").alias(c) for c in order), "epochs")


def next_empty(rows: DataFrame, group: str, order: str, empty: Column) -> DataFrame:
    """rows with `next_empty`: the least later place without a box."""
    w = Window.partitionBy(group).orderBy(order).rowsBetween(1, Window.unboundedFollowing)
    return rows.withColumn("next_empty", F.min(F.when(empty, F.col(order))).over(w))


def phase_changes(rows: DataFrame, group: str, order: str, phase: str) -> DataFrame:
    """Where a phase begins, numbered from 1 by group."""
    w = Window.partitionBy(group).orderBy(order)
    begins = rows.withColumn("_last", F.lag(phase).over(w)).where(F.col("_last").isNull() | (F.col("_last") != F.col(phase)))
    return begins.withColumn("phase_no", F.row_number().over(w)).drop("_last")
