"""Greedy segmentation: a segment closes at the first row that conflicts with what it has kept.

Two rules need it: a mass-spectrometer scan closes when a mass repeats, and a burst of repeated commands
closes when the setpoint changes or the first sighting is too long ago. Where a segment starts depends on
where the previous one started, so it is no window function. Per chunk we compute, for every possible
first start inside the chunk (at most one segment length of them), what is open at its end. Such summaries
compose: neighbours are combined ``FAN`` at a time in rounds, until a key has one, and the states are handed
down the same way, so no group holds more than a few summaries. A last pass numbers the rows. Only keys,
chunk, position and values pass through Python; a row gets its segment by a join on its position.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from abyssal.functions.common import write_and_read

FAN = 8  # summaries of one group

def _next_change(v: np.ndarray) -> np.ndarray:
    """Index of the next row that differs from each row (the length where none does)."""
    change = np.append(np.flatnonzero((v[1:] != v[:-1]).any(axis=1)) + 1, len(v))
    return change[np.searchsorted(change, np.arange(len(v)), side="right")]


class RepeatRule:
    """A segment holds each value of the last column at most once; the columns before it stay the same in it."""

    def next_start(self, v: np.ndarray) -> np.ndarray:
        n, last = len(v), v[:, -1]
        order = np.argsort(last, kind="stable")
        s = last[order]
        nxt = np.full(n, n, dtype=np.int64)
        same = s[1:] == s[:-1]
        nxt[order[:-1][same]] = order[1:][same]
        nxt = np.minimum.accumulate(nxt[::-1])[::-1]
        return nxt if v.shape[1] == 1 else np.minimum(nxt, _next_change(v[:, :-1]))

    def open_at_end(self, v: np.ndarray, start: int) -> list[list[int]]:
        return v[start:].tolist()

    def entry(self, state: list, lead: np.ndarray, limit: int) -> int:
        seen, around = {int(r[-1]) for r in state}, list(map(int, state[0][:-1]))
        for i, r in enumerate(lead):
            if int(r[-1]) in seen or list(map(int, r[:-1])) != around:
                return i
        return limit

    def extend(self, state: list, lead: np.ndarray) -> list:
        return [*state, *[list(r) for r in lead]]


class HoldRule:
    """A segment holds repeats of one setpoint no later than `window_us` after its first row (setpoint, time)."""

    def __init__(self, window_us: int) -> None:
        self.window_us = window_us

    def next_start(self, v: np.ndarray) -> np.ndarray:
        return np.minimum(_next_change(v[:, :1]), np.searchsorted(v[:, 1], v[:, 1] + self.window_us, side="right"))

    def open_at_end(self, v: np.ndarray, start: int) -> list[list[int]]:
        return [v[start].tolist()]

    def entry(self, state: list, lead: np.ndarray, limit: int) -> int:
        # rows of a lead belong to one segment: one setpoint, times in order
        setpoint, kept = int(state[0][0]), int(state[0][1])
        if len(lead) == 0:
            return limit
        return 0 if int(lead[0][0]) != setpoint else int(np.searchsorted(lead[:, 1], kept + self.window_us, side="right"))

    def extend(self, state: list, lead: np.ndarray) -> list:
        return state


def _walk(nxt: np.ndarray, start: int) -> list[int]:
    """Segment starts inside the chunk, from the given first one."""
    out, n = [], len(nxt)
    while start < n:
        out.append(start)
        start = int(nxt[start])
    return out


def _last_starts(nxt: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every row as first start: the last start inside the chunk and the number of starts, by pointer jumping."""
    n = len(nxt)
    last, count = np.arange(n), np.ones(n, dtype=np.int64)
    ahead = np.minimum(nxt, n)
    while (inside := ahead < n).any():
        to = ahead[inside]
        count[inside] += count[to]
        last[inside] = last[to]
        ahead[inside] = ahead[to]
    return last, count


class Summary:
    """What a stretch of rows does to the state it is entered with.

    ``lead`` are the rows up to the first that closes the segment begun by row 0 (all ``n`` if none does). ``ends[f]`` is the state
    at the end when the first segment starts at row f, ``starts[f]`` the number of starts; f = len(lead) = n is a stretch without.
    """

    def __init__(self, lead: np.ndarray, n: int, ends: Sequence[list], starts: Sequence[int]) -> None:
        self.lead, self.n, self.ends, self.starts = lead, n, ends, starts

    @classmethod
    def of(cls, v: np.ndarray, rule) -> Summary:
        n, nxt = len(v), rule.next_start(v)
        limit = min(int(nxt[0]), n)
        last, count = _last_starts(nxt)
        kept = min(limit + 1, n)
        ends = [rule.open_at_end(v, int(i)) for i in last[:kept]] + [[]] * (limit + 1 - kept)
        return cls(v[:limit], n, ends, [*count[:kept].tolist(), *[0] * (limit + 1 - kept)])

    def after(self, state: list, rule) -> tuple[list, int]:
        """State at the end and starts inside, entered with a state ([] at the beginning of a key)."""
        f = rule.entry(state, self.lead, len(self.lead)) if len(state) else 0
        return (rule.extend(state, self.lead), 0) if f >= self.n else (self.ends[f], self.starts[f])

    def then(self, other: Summary, rule) -> Summary:
        outcomes = [(e, s, *other.after(e, rule)) for e, s in zip(self.ends, self.starts) if len(e)]
        ends, starts = [e for *_, e, _ in outcomes], [s + more for _, s, _, more in outcomes]
        lead = self.lead
        if len(lead) == self.n:  # a segment may run through all of this stretch and close in the other
            cut = rule.entry(self.ends[0], other.lead, len(other.lead))
            lead = np.concatenate([lead, other.lead[:cut]])
            ends += list(other.ends[:cut + 1])
            starts += list(other.starts[:cut + 1])
        return Summary(lead, self.n + other.n, ends, starts)


def greedy_segments(
    df: DataFrame, keys: Sequence[str], chunk: str, pos: Sequence[str], values: Sequence[str], rule
) -> DataFrame:
    """Add ``segment`` (0-based per key) and ``is_start`` to every row; `values` must be non-null integers, positions unique."""
    keys, pos, values = list(keys), list(pos), list(values)
    part = [*keys, chunk]
    nested = T.ArrayType(T.ArrayType(T.LongType()))
    key_fields = [df.schema[c] for c in keys]
    state_fields = [T.StructField("state", nested), T.StructField("before", T.LongType())]
    body = [T.StructField("lead", nested), T.StructField("n_rows", T.LongType()), T.StructField("ends", T.ArrayType(nested)),
            T.StructField("starts", T.ArrayType(T.LongType()))]
    width = len(values)
    columns = list(dict.fromkeys([*part, *pos, *values]))
    where = list(dict.fromkeys([*part, *pos]))

    def matrix(pdf: pd.DataFrame) -> np.ndarray:
        return pdf[values].to_numpy(dtype=np.int64)

    def as_row(head: pd.DataFrame, s: Summary) -> pd.DataFrame:
        return head.assign(lead=[s.lead.tolist()], n_rows=s.n, ends=[s.ends], starts=[s.starts])

    def plain(state) -> list:
        return [list(map(int, r)) for r in state]

    def read(row) -> Summary:
        lead = np.array([list(r) for r in row.lead], dtype=np.int64).reshape(-1, width)
        return Summary(lead, int(row.n_rows), [plain(e) for e in row.ends], [int(x) for x in row.starts])

    def summarise(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(pos, kind="stable")
        return as_row(pdf.iloc[:1][part].reset_index(drop=True), Summary.of(matrix(pdf), rule))

    def combine(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = [read(r) for r in pdf.sort_values("__i").itertuples()]
        whole = rows[0]
        for s in rows[1:]:
            whole = whole.then(s, rule)
        return as_row(pdf.iloc[:1][[*keys, "__up"]].rename(columns={"__up": "__i"}).reset_index(drop=True), whole)

    def hand_down(pdf: pd.DataFrame, carry: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("__i").reset_index(drop=True)
        state, count = (plain(carry["state"].iloc[0]), int(carry["before"].iloc[0])) if len(carry) else ([], 0)
        states, counts = [], []
        for r in pdf.itertuples():
            states.append(state)
            counts.append(count)
            state, more = read(r).after(state, rule)
            count += more
        return pdf[[*keys, "__i"]].assign(state=states, before=counts)

    def number(pdf: pd.DataFrame, carry: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(pos, kind="stable").reset_index(drop=True)
        v = matrix(pdf)
        n, nxt = len(v), rule.next_start(v)
        limit = min(int(nxt[0]), n)
        state, before = plain(carry["state"].iloc[0]), int(carry["before"].iloc[0])
        first = rule.entry(state, v[:limit], limit) if len(state) else 0
        flags = np.zeros(n, dtype=bool)
        flags[_walk(nxt, first)] = True
        return pdf[where].assign(segment=before - 1 + np.cumsum(flags), is_start=flags)

    rows = df.select(*columns)
    summary = rows.groupBy(*part).applyInPandas(summarise, T.StructType([*key_fields, df.schema[chunk], *body]))
    # one row per chunk: numbered per key
    level = write_and_read(summary.withColumn("__i", (F.row_number().over(Window.partitionBy(*keys).orderBy(chunk)) - 1).cast("bigint")))
    chunks = level.select(*part, "__i")
    i_field = T.StructField("__i", T.LongType())
    top = level.agg(F.max("__i")).first()[0] or 0
    levels = [level.drop(chunk)]
    while top >= FAN:
        above = levels[-1].withColumn("__up", F.floor(F.col("__i") / FAN).cast("bigint"))
        levels.append(write_and_read(above.groupBy(*keys, "__up").applyInPandas(combine, T.StructType([*key_fields, *body, i_field]))))
        top //= FAN
    carry_schema = T.StructType([*key_fields, i_field, *state_fields])
    carry = df.sparkSession.createDataFrame([], T.StructType([*key_fields, T.StructField("__up", T.LongType()), *state_fields]))
    for n, below in enumerate(reversed(levels)):
        group = below.withColumn("__up", F.floor(F.col("__i") / FAN).cast("bigint"))
        carry = group.groupBy(*keys, "__up").cogroup(carry.groupBy(*keys, "__up")).applyInPandas(hand_down, carry_schema)
        if n < len(levels) - 1:
            carry = carry.withColumnRenamed("__i", "__up")
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in [*keys, "__i"]]
    carry = carry.alias("a").join(chunks.alias("b"), same).select(*[f"b.{c}" for c in part], "a.state", "a.before")
    numbered = rows.groupBy(*part).cogroup(carry.groupBy(*part)).applyInPandas(
        number, T.StructType([*[df.schema[c] for c in where], T.StructField("segment", T.LongType()), T.StructField("is_start", T.BooleanType())]))
    if set(df.columns) <= set(where):
        return numbered
    # the last position first: both sides sort by these columns, and keys or chunks hardly tell rows apart
    at = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in dict.fromkeys([pos[-1], *where])]
    return df.alias("a").join(numbered.alias("b"), at).select("a.*", "b.segment", "b.is_start")


def time_chunks(df: DataFrame, ts_us: str, width_us: int, name: str = "__chunk") -> DataFrame:
    """Chunk column for time-ordered segmentation."""
    return df.withColumn(name, F.floor(F.col(ts_us) / F.lit(width_us)).cast("bigint"))
