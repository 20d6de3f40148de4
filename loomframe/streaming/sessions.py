"""Sessions of users over a stream of events."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import IntegralType, StringType

from loomframe.functions.numeric import seconds_of

#: Per bucket of users, as Arrow: each user's last whole second that came out and the number of its session, and the events that wait.
STATE = "users binary, waiting binary"
#: Buckets that users are dealt to by a hash. A call for a bucket costs what one for a user does.
BUCKETS = 4096


def stream_sessions(
    events: DataFrame,
    user: str,
    ts: str,
    gap_min: int = 30,
    tiebreak: str | None = None,
    delay: str = "1 hour",
    buckets: int = BUCKETS,
) -> DataFrame:
    """``sessionize`` over a stream: every event once with ``session_id``, counted from 0 for each user.

    An event waits in the state until the newest time seen is ``delay`` past it.
    Then all that may come before it has come, and events leave in order of time and
    ``tiebreak``; the session numbers are those of the batch form. An event that arrives
    more than ``delay`` late, by the times of earlier batches, is dropped and counted by
    Spark as late. Events without a time are dropped; NULL is a user like any other.

    A row with a time, a NULL user and a NULL ``tiebreak`` is a heartbeat where ``tiebreak``
    is given: it moves time on, so that waiting events leave, and does not come out.

    State is the last time and a number per user and what waits, so it grows with ``delay``
    and not with the history. Users that are whole numbers or strings share the state of
    one of ``buckets`` buckets, and a task numbers a bucket's users at once; a batch
    reads and writes the state of every bucket it has events of. The batch's own limit
    (``files`` of ``follow_files``) bounds what a bucket gets at once, more ``buckets``
    make them smaller. Their number stays with the checkpoint.
    """
    kinds = {f.name: f.dataType for f in events.schema}
    # pandas would turn whole numbers next to NULL into doubles.
    whole = {c: F.col(c).cast("string") for c, kind in kinds.items() if isinstance(kind, IntegralType)}
    tie = F.lit(0) if tiebreak is None else F.col(tiebreak)
    # A NULL beside them would do the same to the numbers that break ties.
    tied = F.coalesce(tie, F.lit(0)) if tiebreak in whole else tie
    dealt = user in whole or kinds[user] == StringType()
    bucket = F.pmod(F.xxhash64(user), F.lit(buckets)) if dealt else F.col(user)
    times = {
        "_time": F.col(ts).cast("timestamp"),
        "_second": seconds_of(events, ts),
        "_tie": tied,
        "_untied": tie.isNull(),
        "_bucket": bucket,
        "_who": F.col(user).cast("string") if dealt else F.lit(""),
    }
    watched = events.where(F.col(ts).isNotNull()).withColumns(times).withColumns(whole)
    watched = watched.withColumn("_micros", F.unix_micros("_time")).withWatermark("_time", delay)
    fields = ", ".join(f"`{c}` {'string' if c in whole else kind.simpleString()}" for c, kind in kinds.items())
    numbered = watched.groupBy("_bucket").applyInPandasWithState(
        _numbering(list(kinds), user, tiebreak is not None, gap_min * 60),
        f"{fields}, session_id long",
        STATE,
        "append",
        GroupStateTimeout.EventTimeTimeout,
    )
    return numbered.withColumns({c: F.col(c).cast(kinds[c]) for c in whole})


def _numbering(columns: list[str], user: str, heartbeats: bool, gap: int) -> Callable:
    carried = [*columns, "_who", "_second", "_micros", "_untied", "_tie"]

    def packed(rows: pd.DataFrame) -> bytes:
        table = pa.Table.from_pandas(rows, preserve_index=False)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as writer:
            writer.write_table(table)
        return sink.getvalue().to_pybytes()

    def unpacked(state: bytes) -> pd.DataFrame:
        return pa.ipc.open_stream(state).read_pandas()

    def numbers(rows: pd.DataFrame, users: pd.DataFrame | None) -> tuple[pd.Series, pd.DataFrame]:
        """The session of each row, given in order of users and times, and the users after them."""
        seen = 0 if users is None else len(users)
        names = rows["_who"] if users is None else pd.concat([users["who"], rows["_who"]], ignore_index=True)
        codes, who = pd.factorize(names, use_na_sentinel=False)
        last, number = np.zeros(len(who), "int64"), np.zeros(len(who), "int64")
        if seen:
            last[:seen], number[:seen] = users["last"], users["number"]
        at, seconds = codes[seen:], rows["_second"].to_numpy("int64")
        starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        before = np.r_[seconds[:1], seconds[:-1]]
        # A user's first row follows what came out before, or nothing.
        before[starts] = np.where(at[starts] < seen, last[at[starts]], seconds[starts])
        fresh = (seconds - before > gap).astype("int64")
        so_far = fresh.cumsum()
        lengths = np.diff(np.r_[starts, len(at)])
        sessions = so_far + np.repeat(number[at[starts]] - so_far[starts] + fresh[starts], lengths)
        ends = starts + lengths - 1
        last[at[ends]], number[at[ends]] = seconds[ends], sessions[ends]
        return sessions, pd.DataFrame({"who": who, "last": last, "number": number})

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        users, waiting = state.get if state.exists else (None, None)
        parts = [] if waiting is None else [unpacked(waiting)]
        if not state.hasTimedOut:
            for batch in batches:
                if heartbeats:
                    batch = batch[batch[user].notna() | ~batch["_untied"]]
                if len(batch):
                    parts.append(batch[carried])
        if not parts:
            return
        rows = pd.concat(parts, ignore_index=True)
        watermark = state.getCurrentWatermarkMs()
        due = rows["_micros"] <= watermark * 1000
        leaving, staying = rows[due], rows[~due]
        if len(leaving):
            leaving = leaving.sort_values(["_who", "_micros", "_untied", "_tie"], kind="stable", ignore_index=True)
            sessions, known = numbers(leaving, None if users is None else unpacked(users))
            users = packed(known)
            yield leaving[columns].assign(session_id=sessions)
        state.update((users, packed(staying) if len(staying) else None))
        if len(staying):
            # What waits leaves once time has passed the first of it.
            state.setTimeoutTimestamp(max(int(staying["_micros"].min()) // 1000, watermark))

    return run
