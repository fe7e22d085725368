"""One load of raw shifts into the stored tables, shared by batch runs and streams.

A load reads the tables as one commit left them, writes what it adds to folders that nothing
reads yet, and commits shifts, errors, ids and payroll weeks at once. If another load
committed in the meantime, what was written still holds unless both met an id or touched a
payroll week: then all of it, or payroll alone, is written anew, from the newer tables on. So
loads may overlap, no shift is lost or stored twice, and payroll always equals the stored shifts.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from datetime import datetime

from pyspark.sql import DataFrame, functions as F, types as T

from shiftpay import schemas
from shiftpay.functions.columns import week_of
from shiftpay.operators import merge, pay, quality
from shiftpay.sources import commits, files, sinks
from shiftpay.sources.commits import State


@dataclass
class Load:
    """What a load produced: its number, its frames, from written files, and rows per table.

    ``weeks`` is the payroll of every employee and week that the load touched, over all
    stored shifts. ``discard`` deletes the staged files once the frames are done with.
    """

    number: int
    validated: DataFrame
    logs: DataFrame
    weeks: DataFrame
    folder: str
    logs_inserted: int
    payroll_rows: int
    has_errors: bool

    def discard(self) -> None:
        files.remove(self.validated.sparkSession, self.folder)


def seen_ids(root: str, raw: DataFrame, attempts: list[str]) -> DataFrame | None:
    """Ids of ``raw`` that these attempts met, clean or flagged; None without any attempt.

    Only buckets that hold ids of this load are read, and their ids are reduced to those of
    the load before anything else, so what goes on from here is no larger than the load.
    """
    if not attempts:
        return None
    ids = raw.select("log_id")
    return merge.known_ids(sinks.stored_ids(raw.sparkSession, root, attempts, ids), ids)


def merged_payroll(
    root: str, logs: DataFrame, base: State, now: datetime, weeks: set[str], folder: str
) -> tuple[DataFrame, bool]:
    """The payroll of ``weeks`` as it is after a load of ``logs``, which these are all weeks of;
    whether it lies in ranges of weeks.

    Payroll rows hold the exact sums that they were rounded from, so only payroll of the
    weeks of the load is read, and no stored shift. Where shifts or payroll were changed
    without the other, the months those weeks reach into are added up instead.
    """
    spark = logs.sparkSession
    parts = pay.payroll_parts(logs)
    stored = sinks.payroll(spark, root, base, weeks, with_parts=True)
    if not base.loose:
        return merge.add_payroll(stored, parts, now), True
    keys = ["employee_id", "week_start"]
    own = files.stage_in(parts, f"{folder}/own-parts", files.CODEC)
    touched = own.select(*keys).distinct()
    days = own.select(F.explode(F.array("week_start", F.date_add("week_start", 6))).alias("log_date"))
    in_months = sinks.any_of(sinks.with_month(days), "log_month")
    shifts = sinks.time_logs(spark, root, base).filter(in_months)
    earlier = pay.payroll_parts(shifts).join(touched, keys, "left_semi")
    # the parts of earlier shifts take the place of those that payroll has
    lists = pay.part_lists(pay.add_parts(earlier.unionByName(own)))
    time = F.lit(now).cast("timestamp").alias("created_at")
    folded = lists.select(*keys, *pay.folded_list("parts"), "parts", time)
    return merge.upsert_payroll(stored, folded), False


@dataclass
class _Written:
    """What an attempt wrote for one state of the tables; ``payroll`` is its last attempt at that."""

    attempt: str
    number: int
    load: Load
    weeks: set[str]
    payroll: str | None = None


def _write(
    root: str,
    raw: DataFrame,
    ingest_order: list[str],
    base: State,
    number: int,
    run_id: str,
    now: datetime,
    known_are_errors: bool,
    folder: str,
) -> _Written:
    """Write all but payroll."""
    attempt = sinks.new_attempt()
    folder = f"{folder}/{attempt}"
    seen = seen_ids(root, raw, list(base.ids.values()))
    judged = quality.validate(raw, ingest_order, seen, known_are_errors)
    # what told rows apart so far is not needed any more
    judged = judged.select(*schemas.names(schemas.RAW_LOGS), "error_reason")
    validated = files.stage_in(judged, f"{folder}/validated", files.CODEC)
    clean = quality.clean_logs(validated)
    # no id of these is in an earlier load, so nothing needs to be looked up once more
    path = f"{root}/time_logs/{sinks.load_folder(number, attempt)}"
    inserted = sinks.write_logs(clean, path, pay.transform)
    # read back, by month and employee: what adds them up or copies them need not compute or deal them
    logs = sinks.loaded_logs(raw.sparkSession, root, number, attempt)
    errors = quality.validation_errors(validated, run_id, now)
    has_errors = sinks.load_errors(root, errors, number, attempt)
    # the first row of each id that no earlier load met
    firsts = F.coalesce(F.col("error_reason") != quality.DUPLICATE, F.lit(True))
    sinks.write_ids(root, validated.filter(firsts), attempt)
    weeks = sinks.week_names(logs.select(week_of(F.col("log_date")).alias("week_start")))
    load = Load(number, validated, logs, None, folder, inserted, 0, has_errors)
    return _Written(attempt, number, load, weeks)


def _write_payroll(root: str, written: _Written, base: State, now: datetime) -> None:
    """Write the payroll of the load, going on from that of ``base``."""
    load, attempt = written.load, sinks.new_attempt()
    _remove_payroll(root, written)
    written.payroll = attempt
    merged, by_week = merged_payroll(
        root, load.logs, base, now, written.weeks, f"{load.folder}/{attempt}"
    )
    load.payroll_rows = sinks.write_payroll(root, merged, attempt, by_week)
    rows = sinks.loaded_payroll(load.logs.sparkSession, root, attempt)
    load.weeks = pay.summary_of_parts(rows.select("employee_id", "week_start", F.inline("parts")))


def _remove_payroll(root: str, written: _Written) -> None:
    if written.payroll:
        files.remove(written.load.logs.sparkSession, f"{root}/payroll_summary/attempt={written.payroll}")


def _remove(root: str, written: _Written) -> None:
    """Delete what an attempt wrote to the tables."""
    spark, own = written.load.validated.sparkSession, f"attempt={written.attempt}"
    for table in ("time_logs", "validation_errors"):
        files.remove(spark, f"{root}/{table}/batch_id={written.number}/{own}")
    files.remove(spark, f"{root}/log_ids/{own}")
    _remove_payroll(root, written)
    written.load.discard()


def _renumber(root: str, written: _Written, number: int) -> None:
    """Give the folders of a load its number, where another load took the one they have."""
    spark, load = written.load.validated.sparkSession, written.load
    if number != written.number:
        for table, some in (("time_logs", True), ("validation_errors", load.has_errors)):
            if some:
                old, new = (sinks.load_folder(n, written.attempt) for n in (written.number, number))
                files.move(spark, f"{root}/{table}/{old}", f"{root}/{table}/{new}")
        load.logs = sinks.loaded_logs(spark, root, number, written.attempt)
    written.number = load.number = number


def load_raw(
    root: str,
    raw: DataFrame,
    ingest_order: list[str],
    batch_id: int | None,
    run_id: str,
    now: datetime,
    known_are_errors: bool = True,
    stream: str | None = None,
    part: int | None = None,
    before_commit: Callable[[], None] | None = None,
) -> Load:
    """Validate, compute pay, insert, and bring the touched payroll weeks up to date.

    Ids that an earlier load met are duplicates (a stream of new files), or with
    ``known_are_errors`` off they are passed over (a batch run over a folder that grows),
    and only repeats within the load count.

    The load gets the next number when it commits. With ``batch_id`` it asks for that one;
    if the tables have a load of that number and run already, nothing is done, and the load
    returned is empty. ``before_commit`` is called when everything is written and nothing
    shows yet. A load that fails leaves nothing that readers see.
    """
    spark = raw.sparkSession
    folder = files.new_folder(spark, "load")
    written = None

    def committed(state: State) -> bool:
        known = state.loads.get(batch_id)
        return known is not None and known["run"] == run_id

    def number_in(state: State) -> int:
        wanted = batch_id if batch_id is not None else state.next_load
        return wanted if wanted > max(state.loads, default=-1) else state.next_load

    def change(state: State) -> State:
        _renumber(root, written, number_in(state))
        number, load = written.number, written.load
        record = {"run": run_id, "at": now.isoformat(), "stream": stream, "part": part, "counts": counts}
        changed = replace(
            state,
            loads=state.loads | {number: record},
            logs=state.logs | ({number: written.attempt} if load.logs_inserted else {}),
            errors=state.errors | ({number: written.attempt} if load.has_errors else {}),
            ids=state.ids | {number: written.attempt},
        )
        return sinks.with_weeks(changed, written.weeks, written.payroll)

    def meets_none_since(state: State) -> bool:
        """Whether no load between the state worked on and this one met an id of this load."""
        between = [a for n, a in state.ids.items() if base.ids.get(n) != a]
        met = seen_ids(root, raw, between)
        return met is None or met.isEmpty()

    def holds(state: State) -> bool:
        """Whether what was written is right beside the loads that came in between."""
        if committed(state) or not sinks.same_weeks(base, state, written.weeks):
            return False
        return state.loose == base.loose and meets_none_since(state)

    try:
        base = commits.latest(spark, root)
        while True:
            if committed(base):
                return _nothing(raw, base, batch_id, folder)
            if written is None:
                number = number_in(base)
                written = _write(
                    root, raw, ingest_order, base, number, run_id, now, known_are_errors, folder
                )
                counts = {
                    k: str(v)
                    for k, v in quality.run_metrics(written.load.validated).first().asDict().items()
                }
            _write_payroll(root, written, base, now)
            if before_commit:
                before_commit()
            if commits.commit(spark, root, base, change, holds):
                written.load.folder = folder
                return written.load
            newer = commits.latest(spark, root)
            # where only payroll weeks were touched by both, the shifts stay as they are written
            if committed(newer) or not meets_none_since(newer):
                _remove(root, written)
                written = None
            base = newer
    except BaseException:
        if written:
            _remove(root, written)
        files.remove(spark, folder)
        raise


def _nothing(raw: DataFrame, base: State, number: int, folder: str) -> Load:
    """A load that the tables have already."""
    spark = raw.sparkSession
    judged = schemas.with_fields(schemas.RAW_LOGS, error_reason=T.StringType())
    none = [spark.createDataFrame([], s) for s in (judged, schemas.TIME_LOGS, schemas.PAYROLL)]
    return Load(number, *none, folder, 0, 0, number in base.errors)
