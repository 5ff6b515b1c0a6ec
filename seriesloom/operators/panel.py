"""The panel: many series in one DataFrame, and the ordered passes over them.

A plain ``Window.partitionBy(series)`` puts a whole series in one task. That is right while
every series is short, and hopeless when one series holds a third of a huge table. Every
ordered pass here therefore has two plans with the same result:

* whole - the largest series fits ``rows_per_task`` rows: one hash exchange on the series;
* split - it does not: rows get their exact position in the series without any task seeing
  the whole series, positions are cut into chunks, and windows run per (series, chunk).
  Bounded frames borrow the few rows they need from the neighbouring chunk; running sums,
  fills and decayed means pass one summary row per chunk.

The size is measured by one pre-aggregated count unless the caller proves a bound.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import cached_property, reduce
from operator import and_, or_

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesloom import session

POS = "__pos"
CHUNK = "__chunk"
SLAB = "__slab"
# A split series has at most this many chunks, so one summary row per chunk is always small.
MAX_CHUNKS = 4096
# One row per series and calendar day over four centuries.
CALENDAR_ROWS = 366 * 400

Stage = Callable[[WindowSpec], Mapping[str, Column]]


class Panel:
    """Rows keyed by ``series`` and ordered by ``order`` (together unique). Null keys make a series of their own."""

    def __init__(
        self,
        df: DataFrame,
        series: Sequence[str],
        order: Sequence[str],
        *,
        rows_per_task: int | None = None,
        rows_bound: int | None = None,
        _chunk_rows: int | None = None,
        _reach: int = 0,
    ):
        self.df = df
        self.series = list(series)
        self.order = list(order)
        self.limit = rows_per_task or session.rows_per_task(df.sparkSession)
        self.rows_bound = rows_bound
        self._chunk_rows = _chunk_rows
        # Furthest row before the current one that a frame has read.
        self._reach = _reach

    @classmethod
    def calendar(cls, df: DataFrame, series: Sequence[str], date: str, **kw) -> Panel:
        """A panel built by grouping on (series, day or coarser): its length has a proven bound."""
        return cls(df, series, [date], rows_bound=CALENDAR_ROWS, **kw)

    def with_df(self, df: DataFrame) -> Panel:
        """The same panel over other columns or fewer rows; what is known of its sizes stays known."""
        p = Panel(
            df, self.series, self.order, rows_per_task=self.limit, rows_bound=self.rows_bound, _chunk_rows=self._chunk_rows, _reach=self._reach
        )
        if "_sizes" in self.__dict__:
            p.__dict__["_sizes"] = self._sizes
        return p

    # -- choosing the plan ------------------------------------------------------------------

    @cached_property
    def _sizes(self) -> tuple[int, int, bool]:
        """Rows of the largest series, rows of all, and whether a key is null."""
        if self.rows_bound is not None and self.rows_bound <= self.limit:
            return self.rows_bound, self.rows_bound, False
        nulls = reduce(or_, [F.col(c).isNull() for c in self.series], F.lit(False))
        row = self.df.groupBy(*self.series).count().agg(F.max("count"), F.sum("count"), F.max(nulls)).first()
        return (row[0] or 0, row[1] or 0, bool(row[2]))

    @property
    def total(self) -> int:
        """Rows of all series, as measured (or the proven bound of one)."""
        return self._sizes[1]

    @property
    def is_split(self) -> bool:
        return self._chunk_rows is not None or self._sizes[0] > self.limit

    def _window(self, descending: bool = False) -> WindowSpec:
        if self.is_split:
            keys, order = [*self.series, CHUNK], [POS]
        else:
            keys, order = self.series, self.order
        cols = [F.col(c).desc() if descending else F.col(c).asc() for c in order]
        return Window.partitionBy(*keys).orderBy(*cols)

    def _split(self) -> Panel:
        """Add positions and chunk numbers; a no-op when they are there already."""
        if self._chunk_rows is not None:
            return self
        largest, total, nulls = self._sizes
        chunk_rows = max(self.limit, -(-largest // MAX_CHUNKS))
        df = exact_positions(self.df, self.series, self.order, total, chunk_rows, nulls)
        df = df.withColumn(CHUNK, _chunk_of(chunk_rows))
        p = Panel(df, self.series, self.order, rows_per_task=self.limit, _chunk_rows=chunk_rows)
        p.__dict__["_sizes"] = self._sizes
        return p

    def finish(self) -> DataFrame:
        """The rows without the bookkeeping columns."""
        return self.df.drop(*[c for c in self.df.columns if c.startswith("__")])

    def unsplit(self) -> DataFrame:
        """The rows without this panel's positions and chunks."""
        return self.df.drop(POS, CHUNK)

    # -- passes -----------------------------------------------------------------------------

    def positions(self, name: str = "pos") -> Panel:
        """Add the 1-based position of each row in its series."""
        if not self.is_split:
            return self.with_df(self.df.withColumn(name, F.row_number().over(self._window()).cast("long")))
        p = self._split()
        return p.with_df(p.df.withColumn(name, F.col(POS)))

    def frames(self, *stages: Stage, back: int = 0, ahead: int = 0) -> Panel:
        """Add columns computed over frames reaching at most ``back`` / ``ahead`` rows away.

        Each stage gets the window and may use the columns of the stages before it.
        """
        if not self.is_split:
            w, df = self._window(), self.df
            for stage in stages:
                df = df.withColumns(dict(stage(w)))
            return self.with_df(df)
        p = self._split()
        size = p._chunk_rows
        home, off = _chunk_of(size), F.pmod(F.col(POS) - 1, F.lit(size))
        # A row is lent to every later chunk whose frames reach back to it, and to every earlier one they reach ahead from.
        places = [home]
        places += [F.when(off >= k * size - back, home + k) for k in range(1, -(-back // size) + 1)]
        places += [F.when((off < ahead - (k - 1) * size) & (home >= k), home - k) for k in range(1, -(-ahead // size) + 1)]
        df = p.df.withColumn(CHUNK, F.explode(F.array_compact(F.array(*places))))
        w = p._window()
        for stage in stages:
            df = df.withColumns(dict(stage(w)))
        done = p.with_df(df.filter(F.col(CHUNK) == _chunk_of(size)))
        done._reach = max(p._reach, back)
        return done

    def _matched(self, df: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
        return matched(df, rows, keys, self._sizes[2])

    def _carry(self, summary: Sequence[Column], combine: Callable[[WindowSpec], Mapping[str, Column]], back: bool) -> DataFrame:
        """One row per (series, chunk) with what the chunks before (or after) it hand over."""
        rows = self.df.groupBy(*self.series, CHUNK).agg(*summary)
        by = F.col(CHUNK).desc() if back else F.col(CHUNK).asc()
        w = Window.partitionBy(*self.series).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
        return rows.select(*self.series, CHUNK, *[e.alias(n) for n, e in combine(w).items()])

    def _fill(self, cols: Sequence[str], backward: bool, leading: bool) -> Panel:
        cols = list(cols)
        if not cols:
            return self
        if not self.is_split:
            w = self._window(descending=backward).rowsBetween(Window.unboundedPreceding, 0)
            if leading:
                whole = self._window().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
                exprs = {c: F.coalesce(F.col(c), F.first(c, ignorenulls=True).over(whole)) for c in cols}
            else:
                exprs = {c: F.last(c, ignorenulls=True).over(w) for c in cols}
            return self.with_df(self.df.withColumns(exprs))
        p = self._split()
        if backward and leading:
            return p._fill_head(cols)
        edge = F.min_by if backward else F.max_by
        summary = [edge(F.col(c), F.when(F.col(c).isNotNull(), F.col(POS))).alias(f"__edge_{c}") for c in cols]
        carry = p._carry(
            summary, lambda w: {f"__carry_{c}": F.last(f"__edge_{c}", ignorenulls=True).over(w) for c in cols}, backward
        )
        w = p._window(descending=backward).rowsBetween(Window.unboundedPreceding, 0)
        df = p.df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in cols})
        df = p._matched(df, carry, [*p.series, CHUNK])
        df = df.withColumns({c: F.coalesce(F.col(c), F.col(f"__carry_{c}")) for c in cols})
        return p.with_df(df.drop(*[f"__carry_{c}" for c in cols]))

    def _fill_head(self, cols: Sequence[str]) -> Panel:
        """Fill leading nulls in a split series. Frames reach ``_reach`` rows back, so the nulls lie in the
        chunks that many rows fill, and the first value in those or the next."""
        deep = max(1, -(-self._reach // self._chunk_rows))
        first = self.df.filter(F.col(CHUNK) <= deep).groupBy(*self.series).agg(
            *[F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(POS))).alias(f"__head_{c}") for c in cols]
        )
        first = first.withColumn(CHUNK, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(deep - 1).cast("long"))))
        df = self._matched(self.df, first, [*self.series, CHUNK])
        df = df.withColumns({c: F.coalesce(F.col(c), F.col(f"__head_{c}")) for c in cols})
        return self.with_df(df.drop(*[f"__head_{c}" for c in cols]))

    def fill_back(self, cols: Sequence[str], *, leading: bool = False) -> Panel:
        """Replace each null by the next non-null value. ``leading``: nulls only lead the series."""
        return self._fill(cols, True, leading)

    def fill_forward(self, cols: Sequence[str]) -> Panel:
        """Replace each null by the last non-null value before it."""
        return self._fill(cols, False, False)

    def running_sums(self, sums: Mapping[str, Column]) -> Panel:
        """Add running totals, current row included; nulls count as zero."""
        if not self.is_split:
            w = self._window().rowsBetween(Window.unboundedPreceding, 0)
            return self.with_df(self.df.withColumns({n: F.sum(F.coalesce(e, F.lit(0))).over(w) for n, e in sums.items()}))
        p = self._split()
        base = p.with_df(p.df.withColumns({f"__in_{n}": F.coalesce(e, F.lit(0)) for n, e in sums.items()}))
        carry = base._carry(
            [F.sum(f"__in_{n}").alias(f"__part_{n}") for n in sums],
            lambda w: {f"__carry_{n}": F.sum(f"__part_{n}").over(w) for n in sums},
            False,
        )
        w = base._window().rowsBetween(Window.unboundedPreceding, 0)
        df = base.df.withColumns({n: F.sum(f"__in_{n}").over(w) for n in sums})
        df = p._matched(df, carry, [*p.series, CHUNK])
        df = df.withColumns({n: F.col(n) + F.coalesce(F.col(f"__carry_{n}"), F.lit(0)) for n in sums})
        return p.with_df(df.drop(*[f"__{k}_{n}" for k in ("in", "carry") for n in sums]))

    def decayed_mean(self, out: str, c: str, alpha: float, *, adjust: bool) -> Panel:
        """Exponentially weighted mean of ``c``; weights decay by position, nulls add no weight.

        ``adjust=True`` divides by the weights seen so far; ``adjust=False`` is the recursion
        seeded with the first value. Either way a row's state is affine in the state entering
        its chunk, so chunks are scanned alone and the entering state is applied afterwards.
        """
        split = self.is_split
        p = self._split() if split else self.with_df(self.df.withColumn(CHUNK, F.lit(0).cast("long")))
        sort_by = [POS] if split else self.order
        keep = 1.0 - alpha
        parts = ("__u", "__v")
        schema = T.StructType([*p.df.schema.fields, *[T.StructField(x, T.DoubleType()) for x in parts]])

        def scan(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values(sort_by, kind="stable").reset_index(drop=True)
            x = pd.to_numeric(pdf[c]).to_numpy(dtype="float64", na_value=np.nan)
            u, v = (decayed_sums if adjust else recursion_maps)(x, keep)
            return pdf.assign(__u=u, __v=v)

        df = session.spread(p.df, [*p.series, CHUNK]).groupBy(*p.series, CHUNK).applyInPandas(scan, schema)
        observed = F.col(c).isNotNull()
        if not split:
            first = F.first(c, ignorenulls=True).over(
                Window.partitionBy(*p.series, CHUNK).orderBy(*self.order).rowsBetween(Window.unboundedPreceding, 0)
            )
            value = F.col("__u") / F.col("__v") if adjust else F.col("__u") * first + F.col("__v")
        else:
            # Scanned once: the summary and the rows below both read the written scan.
            df = session.cut(df)
            seen = F.when(observed, F.col(POS))
            rows = df.groupBy(*p.series, CHUNK).agg(
                F.min_by(c, seen).cast("double").alias("__x1"),
                F.min(seen).alias("__pos1"),
                F.max(seen).alias("__pos_n"),
                F.max_by("__u", seen).alias("__u_n"),
                F.max_by("__v", seen).alias("__v_n"),
            )
            w = Window.partitionBy(*p.series).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
            done = F.collect_list(F.when(F.col("__pos1").isNotNull(), F.struct("__x1", "__pos1", "__pos_n", "__u_n", "__v_n"))).over(w)
            rows = rows.withColumn("__done", done)
            k = F.lit(keep)
            if adjust:
                # Sums of the earlier chunks, each decayed by the rows up to this chunk's first row.
                start = F.col(CHUNK) * p._chunk_rows

                def entering(field: str) -> Column:
                    return F.aggregate("__done", F.lit(0.0), lambda acc, r: acc + r[field] * F.pow(k, start - r["__pos_n"]))

                carry = rows.select(*p.series, CHUNK, entering("__u_n").alias("__u_in"), entering("__v_n").alias("__v_in"))
                decay = F.pow(k, F.col(POS) - F.col(CHUNK) * p._chunk_rows)
                value = (F.col("__u") + decay * F.col("__u_in")) / (F.col("__v") + decay * F.col("__v_in"))
            else:
                # Value at each chunk's first observation, from the value the chunk before ended with.
                def join_in(e: Column, at: Column, x1: Column, pos1: Column) -> Column:
                    old = F.pow(k, pos1 - at)
                    return F.when(e.isNull(), x1).otherwise((old * e + alpha * x1) / (old + alpha))

                state = F.struct(F.lit(None).cast("double").alias("e"), F.lit(None).cast("long").alias("at"))

                def step(acc: Column, r: Column) -> Column:
                    e1 = join_in(acc["e"], acc["at"], r["__x1"], r["__pos1"])
                    return F.struct((r["__u_n"] * e1 + r["__v_n"]).alias("e"), r["__pos_n"].alias("at"))

                rows = rows.withColumn("__s", F.aggregate("__done", state, step))
                e1 = join_in(F.col("__s.e"), F.col("__s.at"), F.col("__x1"), F.col("__pos1"))
                carry = rows.select(*p.series, CHUNK, e1.alias("__e1"))
                value = F.col("__u") * F.col("__e1") + F.col("__v")
            df = p._matched(df, carry, [*p.series, CHUNK])
        df = df.withColumn(out, F.when(observed, value))
        # At a null the mean keeps its last value.
        done = p.with_df(df.drop("__u", "__v", "__u_in", "__v_in", "__e1"))
        if not split:
            done = self.with_df(done.df.drop(CHUNK))
        return done.fill_forward([out])


def decayed_sums(x: np.ndarray, keep: float) -> tuple[np.ndarray, np.ndarray]:
    """Decayed sums of values and of weights, by blocks short enough not to overflow."""
    n = len(x)
    num, den = np.empty(n), np.empty(n)
    block = max(1, int(200.0 / -np.log(keep)))
    seen = ~np.isnan(x)
    value, weight = np.where(seen, x, 0.0), seen.astype("float64")
    a = b = 0.0
    for lo in range(0, n, block):
        hi = min(n, lo + block)
        down = keep ** np.arange(1, hi - lo + 1)
        num[lo:hi] = down * (a + np.cumsum(value[lo:hi] / down))
        den[lo:hi] = down * (b + np.cumsum(weight[lo:hi] / down))
        a, b = num[hi - 1], den[hi - 1]
    return num, den


def recursion_maps(x: np.ndarray, keep: float) -> tuple[np.ndarray, np.ndarray]:
    """Per observed row, (u, v) such that its mean is ``u * mean at the first observed row + v``."""
    alpha = 1.0 - keep
    u, v = np.full(len(x), np.nan), np.full(len(x), np.nan)
    at = np.flatnonzero(~np.isnan(x))
    if len(at):
        old = keep ** np.diff(at)
        hold, take = old / (old + alpha), alpha / (old + alpha) * x[at[1:]]
        a, b = [1.0], [0.0]
        for h, t in zip(hold.tolist(), take.tolist()):
            a.append(a[-1] * h)
            b.append(b[-1] * h + t)
        u[at], v[at] = a, b
    return u, v


def _chunk_of(chunk_rows: int) -> Column:
    return F.floor((F.col(POS) - 1) / F.lit(chunk_rows)).cast("long")


def matched(df: DataFrame, rows: DataFrame, keys: Sequence[str], nulls: bool = True, how: str = "left") -> DataFrame:
    """``df`` joined to ``rows`` on ``keys``; a null key matches a null key, as it does in a grouping.

    The plain equality is kept where no key can be null, by the schema or because ``nulls`` is known to be False: it reuses the
    exchange of the windows.
    """
    nullable = {f.name for f in df.schema.fields if f.nullable} & {f.name for f in rows.schema.fields if f.nullable}
    if not nulls or not nullable.intersection(keys):
        return df.join(rows, list(keys), how)
    theirs = rows.withColumnsRenamed({c: f"__of_{c}" for c in keys})
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"__of_{c}")) if c in nullable else F.col(c) == F.col(f"__of_{c}") for c in keys])
    return df.join(theirs, same, how).drop(*[f"__of_{c}" for c in keys])


def in_slabs(df: DataFrame, order: Sequence[str], total: int, slab_rows: int) -> DataFrame:
    """``df`` range-partitioned on ``order``, with ``__slab``, the number of each row's partition."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    wanted = -(-total // slab_rows)
    slabs = int(max(1, min(wanted, max(cores, total // session.DEFAULT_ROWS_PER_TASK), 8 * MAX_CHUNKS)))
    return df.repartitionByRange(slabs, *order).withColumn(SLAB, F.spark_partition_id())


def exact_positions(df: DataFrame, series: Sequence[str], order: Sequence[str], total: int, chunk_rows: int, nulls: bool) -> DataFrame:
    """Add ``__pos``, the 1-based position in the series, with no task holding a whole series.

    A range exchange on (series, order) cuts the table into contiguous slabs, however long one
    series is. Rows are numbered inside their sorted slab and written out, so slabs and numbers
    stay fixed; a count per (series, slab) then shifts every run of rows to its place.
    """
    ranged = session.cut(in_slabs(df, [*series, *order], total, chunk_rows).sortWithinPartitions(*series, *order).withColumn("__at", F.monotonically_increasing_id()))
    keys = [*series, SLAB]
    w = Window.partitionBy(*series).orderBy(SLAB).rowsBetween(Window.unboundedPreceding, -1)
    runs = ranged.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"), F.min("__at").alias("__first"))
    starts = runs.select(*keys, (F.coalesce(F.sum("__rows").over(w), F.lit(0)) - F.col("__first") + 1).alias("__shift"))
    return matched(ranged, starts, keys, nulls, "inner").withColumn(POS, F.col("__at") + F.col("__shift")).drop(SLAB, "__at", "__shift")
