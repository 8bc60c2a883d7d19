"""Keyed stateful processors for ``transformWithStateInPandas`` (UDX-3).

Each processor keeps one small value per key (a date, a row, a profile) and
handles the key's rows of a micro-batch in event-time order — Spark does not
order rows within a batch, so the processor sorts them by ``(ts, tie-break)``.
A key's rows of one micro-batch are handled together; bound micro-batch size
with ``maxOffsetsPerTrigger`` / ``maxFilesPerTrigger`` for very hot keys.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

DAY_MS = 86_400_000


def _days(ts: pd.Series, zone: str) -> pd.Series:
    t = pd.to_datetime(ts.astype("int64"), unit="ms", utc=True)
    return t.dt.tz_convert(zone).dt.strftime("%Y-%m-%d")


def _midnights_ms(days: pd.Series, zone: str) -> pd.Series:
    """Epoch milliseconds of the days' midnights (0 for a missing day)."""
    t = pd.to_datetime(days).dt.tz_localize(zone).dt.tz_convert("UTC").dt.tz_localize(None)
    ms = (t - pd.Timestamp(0)) // pd.Timedelta(milliseconds=1)
    return ms.fillna(0).astype("int64")


def _sorted(rows: Iterator[pd.DataFrame], order: Sequence[str]) -> pd.DataFrame:
    frames = [f for f in rows if len(f)]
    if not frames:
        return pd.DataFrame()
    return pd.concat(frames, ignore_index=True).sort_values(list(order), kind="stable")


class DailyFirst(StatefulProcessor):
    """SEQ-1 / SEQ-3 / SEQ-4: ``flag`` = 1 when the row's day differs from the
    key's stored last day (then the day is stored).  Optional TTL."""

    def __init__(self, out_cols: Sequence[str], ts: str = "ts", tiebreak: str = "log_id",
                 flag: str = "uv", zone: str = "UTC", ttl_ms: int | None = None,
                 only_flagged: bool = False):
        self.out_cols, self.ts, self.tiebreak, self.flag = list(out_cols), ts, tiebreak, flag
        self.zone, self.ttl_ms, self.only_flagged = zone, ttl_ms, only_flagged

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last_day", "day string", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues):
        pdf = _sorted(rows, [self.ts, self.tiebreak])
        if pdf.empty:
            return
        last = self.last.get()[0] if self.last.exists() else None
        day = _days(pdf[self.ts], self.zone)
        pdf[self.flag] = day.ne(day.shift(fill_value=last)).astype("int64")
        self.last.update((day.iloc[-1],))
        if self.only_flagged:
            pdf = pdf[pdf[self.flag] == 1]
        yield pdf[self.out_cols + [self.flag]]

    def close(self) -> None:
        pass


class ReturningUser(StatefulProcessor):
    """SEQ-5: emits the first login of each day with ``uu_ct`` = 1 and
    ``back_ct`` = 1 when whole days since the previous login day's midnight
    reach ``min_days``.  No TTL (the last login day must be remembered)."""

    def __init__(self, key: str = "uid", ts: str = "ts", tiebreak: str = "log_id",
                 min_days: int = 8, zone: str = "UTC"):
        self.key, self.ts, self.tiebreak, self.min_days, self.zone = key, ts, tiebreak, min_days, zone

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last_login_day", "day string")

    def handleInputRows(self, key, rows, timerValues):
        pdf = _sorted(rows, [self.ts, self.tiebreak])
        if pdf.empty:
            return
        last = self.last.get()[0] if self.last.exists() else None
        day = _days(pdf[self.ts], self.zone)
        before = day.shift(fill_value=last)
        first = day.ne(before)
        self.last.update((day.iloc[-1],))
        ts, before = pdf.loc[first, self.ts].astype("int64"), before[first]
        if len(ts):
            gap = (ts - _midnights_ms(before, self.zone)) // DAY_MS
            yield pd.DataFrame({self.key: key[0], self.ts: ts, "uu_ct": 1,
                                "back_ct": (before.notna() & (gap >= self.min_days)).astype("int64")})

    def close(self) -> None:
        pass


class NewVisitorRepair(StatefulProcessor):
    """SEQ-6: rewrites ``is_new`` = '1' to '0' on any day other than the
    device's anchor day (first day seen, or the day before when the first log
    was already marked old)."""

    def __init__(self, out_cols: Sequence[str], ts: str = "ts", tiebreak: str = "log_id",
                 zone: str = "UTC", ttl_ms: int | None = None):
        self.out_cols, self.ts, self.tiebreak, self.zone, self.ttl_ms = \
            list(out_cols), ts, tiebreak, zone, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.anchor = handle.getValueState("anchor_day", "day string", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues):
        pdf = _sorted(rows, [self.ts, self.tiebreak])
        if pdf.empty:
            return
        anchor = self.anchor.get()[0] if self.anchor.exists() else None
        day, new = _days(pdf[self.ts], self.zone), pdf["is_new"].eq("1")
        if anchor is None:      # decided by the first row
            anchor = day.iloc[0] if new.iloc[0] else _days(pdf[self.ts].iloc[:1] - DAY_MS, self.zone).iloc[0]
            self.anchor.update((anchor,))
        pdf["is_new"] = pdf["is_new"].mask(new & day.ne(anchor), "0")
        yield pdf[self.out_cols]

    def close(self) -> None:
        pass


def _negated(v: pd.Series) -> pd.Series:
    """Negated decimals held as text (the reference prefixes ``-``; a value that
    is already negative loses its sign instead of gaining a second one)."""
    t = v.astype("string")
    return t.str[1:].where(t.str.startswith("-"), "-" + t).where(t.notna(), None).astype(object)


class Retraction(StatefulProcessor):
    """SEQ-7: on a repeated id, first re-emit the stored row with its amounts
    negated (``sign`` = -1, its own time), then the new row (``sign`` = 1)."""

    def __init__(self, out_cols: Sequence[str], amounts: Sequence[str], order: Sequence[str],
                 ttl_ms: int | None = None):
        self.out_cols, self.amounts, self.order, self.ttl_ms = list(out_cols), list(amounts), \
            list(order), ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last_row", "row string", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues):
        pdf = _sorted(rows, self.order)
        if pdf.empty:
            return
        new = pdf[self.out_cols].astype(object).where(pdf[self.out_cols].notna(), None).reset_index(drop=True)
        stored = pd.DataFrame([json.loads(self.last.get()[0])]) if self.last.exists() else new.iloc[:0]
        # The row before each new row is taken back just ahead of it.
        taken = pd.concat([stored, new.iloc[:-1]], ignore_index=True)[self.out_cols]
        for a in self.amounts:
            taken[a] = _negated(taken[a])
        taken.index = range(len(new) - len(taken), len(new))
        out = pd.concat([taken.assign(sign=-1), new.assign(sign=1)]).sort_index(kind="stable")
        self.last.update((json.dumps(new.iloc[-1].to_dict(), default=int),))
        yield out[[*self.out_cols, "sign"]].reset_index(drop=True)

    def close(self) -> None:
        pass


class RunningProfile(StatefulProcessor):
    """AGG-9: per user the running page count, the first ``os``, the first
    ``ts`` and the latest search item (the greatest of one instant); one output
    row per input row, with its event time ``et`` for the operators after it.
    The sets of all values seen, which nothing downstream reads beyond their
    first or last element, are not state: their elements are rows of
    ``operators.label.profile_values``."""

    def __init__(self, key: str = "uid", ts: str = "ts", ttl_ms: int | None = None):
        self.key, self.ts, self.ttl_ms = key, ts, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState(
            "profile", "pv long, os string, first_ts long, last_search string", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues):
        pdf = _sorted(rows, [self.ts, "search_item", "os"])
        if pdf.empty:
            return
        pv, os, first_ts, search = self.state.get() if self.state.exists() else (0, None, None, None)
        ts = pdf[self.ts].astype("int64")
        oses = pd.concat([pd.Series([os], dtype=object), pdf["os"].astype(object)], ignore_index=True)
        found = pd.concat([pd.Series([search], dtype=object), pdf["search_item"].astype(object)],
                          ignore_index=True).ffill().iloc[1:].to_numpy()
        least = oses.dropna()
        out = pd.DataFrame({
            self.key: key[0], "event_ts": ts.to_numpy(), "pv": pv + pd.RangeIndex(1, len(pdf) + 1),
            "os": _running_min(oses).iloc[1:].to_numpy(),
            "ts": (ts.cummin() if first_ts is None else ts.cummin().clip(upper=first_ts)).to_numpy(),
            "last_search": found, "et": pd.to_datetime(ts.to_numpy(), unit="ms")})
        self.state.update((int(out["pv"].iloc[-1]), None if least.empty else least.min(),
                           int(out["ts"].iloc[-1]), None if pd.isna(found[-1]) else found[-1]))
        text = ["os", "last_search"]
        out[text] = out[text].astype(object).where(out[text].notna(), None)
        yield out

    def close(self) -> None:
        pass


PROFILE_ROW = ("uid string, event_ts bigint, pv bigint, os string, ts bigint, last_search string, "
               "et timestamp")


class LogRepair(NewVisitorRepair):
    """SEQ-6 inside the log job: rows of a device are repaired in event-time
    order; rows under a key that is no device (bad messages, logs without one)
    pass unchanged and leave no state."""

    DEVICE = "m:"

    def handleInputRows(self, key, rows, timerValues):
        if key[0].startswith(self.DEVICE):
            yield from super().handleInputRows(key, rows, timerValues)
        else:
            for pdf in rows:
                yield pdf[self.out_cols]


def _running_min(v: pd.Series) -> pd.Series:
    """Smallest text so far (missing values skipped)."""
    known = v.dropna()
    codes, names = pd.factorize(known, sort=True)
    low = pd.Series(codes, index=known.index).cummin()
    return low.map(dict(enumerate(names))).reindex(v.index).ffill()
