"""Exact linear-interpolation quantiles without funnelling a column through one task.

Semantics match pandas ``quantile`` / DuckDB ``quantile_cont``: for ``n``
non-null values and probability ``p`` the position is ``h = (n-1)p`` and the
result ``x[floor h] + (x[ceil h] - x[floor h]) * (h - floor h)``.

Strategy (per key; a key is one column, or one group of a grouped request):

1. One aggregation pass gives ``count``, ``min`` and ``max`` per key.
2. Every target order statistic has an interval, at first the whole key. While
   an interval holds many rows, *histogram narrowing* shrinks it: a pass buckets
   the values inside the current interval of every target order statistic into
   ``buckets`` equal-width buckets (``width_bucket``, JVM-side), counts them in
   a distributed aggregation, and narrows the interval to the bucket holding
   the target rank. When the interval holds few rows (or one distinct value)
   the order statistic is read with a window over the *distinct values* of that
   interval, whose size was counted beforehand. Only counts per bucket and the
   final values reach the driver.

Everything that reaches the driver is bounded by ``keys x targets x buckets``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Rows per interval at which narrowing stops and the value is read directly.
FINISH_ROWS = 100_000
BUCKETS = 1024

_KEY = "__qk"
_VAL = "__qv"


def long_values(df: DataFrame, columns: Sequence[str], carry: str | None = None) -> DataFrame:
    """Unpivot ``columns`` into (key, value) rows; key = column name. With ``carry``, also the column named."""
    structs = [F.struct(F.lit(c).alias(_KEY), F.col(c).cast("double").alias(_VAL)) for c in columns]
    # NaN and infinite values have no place in a distribution and would stop the narrowing
    finite = F.col(_VAL).isNotNull() & ~F.isnan(_VAL) & (F.abs(_VAL) != float("inf"))
    return df.select(*([carry] if carry else []), F.inline(F.array(*structs))).filter(finite)


def _positions(n: int, probs: Sequence[float]):
    out = []
    for p in probs:
        h = (n - 1) * p
        lo = math.floor(h)
        hi = math.ceil(h)
        out.append((lo, hi, h))
    return out


def _interp(lo_v: float, hi_v: float, lo: int, hi: int, at: float) -> float:
    """Linear interpolation as the weighted mean that Spark's ``percentile`` takes."""
    if lo == hi or lo_v == hi_v:
        return lo_v
    return (hi - at) * lo_v + (at - lo) * hi_v


def quantiles_long(long_df: DataFrame, probs: Sequence[float], *, finish_rows: int | None = None,
                   buckets: int | None = None) -> dict[str, dict]:
    """Quantiles of ``__qv`` per ``__qk`` for a long (key, value) frame.

    Returns ``{key: {"n", "min", "max", "q": [values per prob]}}``; keys without
    values do not appear. Unset limits take the module settings at call time.
    """
    finish_rows = FINISH_ROWS if finish_rows is None else finish_rows
    buckets = BUCKETS if buckets is None else buckets
    probs = list(probs)
    stats = (long_df.groupBy(_KEY)
             .agg(F.count(_VAL).alias("n"), F.min(_VAL).alias("mn"), F.max(_VAL).alias("mx"))
             .collect())
    result = {r[_KEY]: {"n": r["n"], "min": r["mn"], "max": r["mx"], "q": [None] * len(probs)} for r in stats}
    if probs and result:
        _narrow(long_df, result, list(result), probs, finish_rows, buckets)
    return result


def _narrow(long_df, result, keys, probs, finish_rows, buckets):
    ranks = {k: sorted({r for lo, hi, _ in _positions(result[k]["n"], probs) for r in (lo, hi)}) for k in keys}
    values = select_ranks(long_df, {k: result[k] for k in keys}, ranks, finish_rows, buckets)
    for k in keys:
        info = result[k]
        info["q"] = [_interp(values[(k, lo)], values[(k, hi)], lo, hi, at)
                     for lo, hi, at in _positions(info["n"], probs)]


def _path_str(path) -> str:
    return "".join(f"/{b}" for b in path)


def _bucket(buckets: int):
    v, lo, hi = F.col(_VAL), F.col("__lo"), F.col("__hi")
    return F.least(F.width_bucket(v, lo, hi, F.lit(buckets)), F.lit(buckets))


def _descend(long_df: DataFrame, bounds: dict, paths: set, buckets: int) -> DataFrame:
    """Rows inside the intervals ``paths`` (same depth), with ``__p`` (path) and ``__lo``/``__hi``.

    Level by level, each row's bucket index inside its parent interval is
    appended to its path, and an equality join with that level's (tiny,
    broadcast) interval table keeps only rows of pending intervals: no row is
    ever multiplied, whatever the number of targets.
    """
    spark = long_df.sparkSession
    depth = len(next(iter(paths))[1])
    df = long_df.withColumn("__p", F.lit(""))
    for level in range(depth + 1):
        spec = sorted({(k, _path_str(p[:level])) + tuple(bounds[(k, p[:level])]) for k, p in paths})
        spec_df = spark.createDataFrame([(k, ps, float(lo), float(hi)) for k, ps, lo, hi in spec],
                                        f"{_KEY} string, __p string, __lo double, __hi double")
        df = df.join(F.broadcast(spec_df), [_KEY, "__p"]).filter(F.col(_VAL).between(F.col("__lo"), F.col("__hi")))
        if level < depth:
            df = (df.withColumn("__p", F.concat(F.col("__p"), F.lit("/"), _bucket(buckets).cast("string")))
                  .drop("__lo", "__hi"))
    return df


def _histogram(frame: DataFrame, buckets: int) -> list:
    return (frame.groupBy(_KEY, "__p", _bucket(buckets).alias("__b"))
            .agg(F.count(F.lit(1)).alias("c"), F.min(_VAL).alias("bmn"), F.max(_VAL).alias("bmx"))
            .collect())


def select_ranks(long_df: DataFrame, stats: dict, ranks: dict, finish_rows: int | None = None,
                 buckets: int | None = None, first: list | None = None) -> dict:
    """Exact order statistics: ``{(key, rank0): value}`` for 0-based ranks per key, by histogram narrowing.

    ``stats[key]`` needs ``n``, ``min`` and ``max``. Each pass is one distributed
    aggregation (counts per bucket of every pending interval); targets in the
    same interval share it. Only bucket counts and final values reach the driver.
    ``first`` is the histogram over [min, max], if the caller has it already.
    """
    finish_rows = FINISH_ROWS if finish_rows is None else finish_rows
    buckets = BUCKETS if buckets is None else buckets
    state = {}
    bounds = {}
    for k, rs in ranks.items():
        mn, mx = stats[k]["min"], stats[k]["max"]
        bounds[(k, ())] = (mn, mx)
        for r in rs:
            state[(k, r)] = {"path": (), "below": 0, "value": mn if mn == mx else None}
    pending = {t for t, st in state.items() if st["value"] is None}
    finish = sorted(t for t in pending if stats[t[0]]["n"] <= finish_rows) if first is None else []
    if finish:
        _finish(long_df, bounds, state, finish, buckets)
        pending.difference_update(finish)
    while pending:
        paths = {(k, state[(k, r)]["path"]) for k, r in pending}
        hist = first or _histogram(_descend(long_df, bounds, paths, buckets), buckets)
        first = None
        by_interval = {}
        for r in hist:
            by_interval.setdefault((r[_KEY], r["__p"]), []).append(r)
        finish = []
        for t in sorted(pending):
            k, rank = t
            st = state[t]
            local = rank - st["below"]
            acc = 0
            for r in sorted(by_interval.get((k, _path_str(st["path"])), []), key=lambda x: x["__b"]):
                if acc + r["c"] > local:
                    if st["path"] and (r["bmn"], r["bmx"]) == bounds[(k, st["path"])] and r["c"] > finish_rows:
                        raise RuntimeError(f"narrowing of {k!r} makes no progress between {r['bmn']} and {r['bmx']}")
                    st["path"] = st["path"] + (r["__b"],)
                    st["below"] += acc
                    bounds[(k, st["path"])] = (r["bmn"], r["bmx"])
                    if r["bmn"] == r["bmx"]:
                        st["value"] = r["bmn"]
                        pending.discard(t)
                    elif r["c"] <= finish_rows:
                        finish.append(t)
                    break
                acc += r["c"]
            else:
                raise RuntimeError(f"rank {rank} of {k!r} not found while narrowing")
        if finish:
            _finish(long_df, bounds, state, finish, buckets)
            pending.difference_update(finish)
    return {t: st["value"] for t, st in state.items()}


def _finish(long_df, bounds, state, finish, buckets):
    """Read order statistics inside intervals small enough (counted) for one window task each."""
    spark = long_df.sparkSession
    paths = {(k, state[(k, r)]["path"]) for k, r in finish}
    frame = _descend(long_df, bounds, paths, buckets)
    vals = frame.groupBy(_KEY, "__p", _VAL).agg(F.count(F.lit(1)).alias("c"))
    w = Window.partitionBy(_KEY, "__p").orderBy(_VAL).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cum = vals.withColumn("cum", F.sum("c").over(w))
    want = spark.createDataFrame(
        [(k, _path_str(state[(k, r)]["path"]), int(r), int(r - state[(k, r)]["below"])) for k, r in finish],
        f"{_KEY} string, __p string, rank long, local long")
    got = (cum.join(F.broadcast(want), [_KEY, "__p"])
           .filter((F.col("cum") - F.col("c") <= F.col("local")) & (F.col("local") < F.col("cum")))
           .select(_KEY, "rank", _VAL).collect())
    for r in got:
        state[(r[_KEY], r["rank"])]["value"] = r[_VAL]


def column_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], **kw) -> dict[str, dict]:
    """Quantiles of several numeric columns of one frame (NULLs skipped), one pass per stage."""
    res = quantiles_long(long_values(df, columns), probs, **kw)
    empty = {"n": 0, "min": None, "max": None, "q": [None] * len(probs)}
    return {c: res.get(c, dict(empty)) for c in columns}


def bounded_quantiles(df: DataFrame, col: str, probs: Sequence[float], low: float, high: float, at_most: int,
                      finish_rows: int | None = None, buckets: int | None = None) -> dict:
    """Quantiles of one column whose values are known to lie in [low, high] and to be at most ``at_most``.

    With these bounds from an earlier pass no statistics pass is needed. Up to ``finish_rows`` values, one job
    counts, ranks and picks them; beyond, one job counts and histograms them, and usually one more reads the
    values of the buckets that hold the targets. Returns ``{"n", "q"}``.
    """
    finish_rows = FINISH_ROWS if finish_rows is None else finish_rows
    buckets = BUCKETS if buckets is None else buckets
    long = long_values(df, [col])
    if at_most > finish_rows and low < high:
        hist = _histogram(long.withColumns({"__p": F.lit(""), "__lo": F.lit(float(low)), "__hi": F.lit(float(high))}), buckets)
        n = sum(r["c"] for r in hist)
        if not n:
            return {"n": 0, "q": [None] * len(probs)}
        ranks = sorted({r for lo, hi, _ in _positions(n, probs) for r in (lo, hi)})
        values = select_ranks(long, {col: {"n": n, "min": low, "max": high}}, {col: ranks}, finish_rows, buckets, hist)
        return {"n": n, "q": [_interp(values[(col, lo)], values[(col, hi)], lo, hi, at) for lo, hi, at in _positions(n, probs)]}
    counts = long.groupBy(_VAL).agg(F.count(F.lit(1)).alias("c"))  # at most finish_rows rows, or one value
    cum = counts.select(_VAL, "c", F.sum("c").over(Window.orderBy(_VAL).rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("cum"),
                        F.sum("c").over(Window.partitionBy()).alias("n"))
    holds = F.lit(False)
    for prob in probs:
        for rank in (F.floor((F.col("n") - 1) * prob), F.ceil((F.col("n") - 1) * prob)):
            holds = holds | ((F.col("cum") - F.col("c") <= rank) & (rank < F.col("cum")))
    got = cum.filter(holds).collect()
    if not got:
        return {"n": 0, "q": [None] * len(probs)}
    n = got[0]["n"]

    def value(rank):
        return next(r[_VAL] for r in got if r["cum"] - r["c"] <= rank < r["cum"])

    return {"n": n, "q": [_interp(value(lo), value(hi), lo, hi, at) for lo, hi, at in _positions(n, probs)]}


def group_quantiles(df: DataFrame, columns: Sequence[str], group_cols: Sequence[str], probs: Sequence[float],
                    num_partitions: int | None = None) -> DataFrame:
    """Exact quantiles per column and group for any number of groups: (variable, group columns, n, q), ``q`` an array in
    the order of ``probs``.

    Values collapse to counts per (group, value), one keyed prefix sum ranks them, and a conditional aggregation picks
    the order statistics next to each target rank. Ranks, counts and targets stay in DataFrames: nothing per group
    reaches the driver, and a hot group's values are spread over range partitions. NULL group values form a group; NULL and
    non-finite values are left out, and groups without values don't appear.

    ``num_partitions`` is for values that hardly repeat within a group, as many as the rows of the lines: the values are
    dealt over that many partitions before they are counted, by their source partition too, so that a frequent value is
    counted in many tasks and merged from their counts. Without it they are counted where they are read, and the counts
    go to ``spark.sql.shuffle.partitions``.
    """
    from .ordering import prefix_sums  # ordering needs the session helpers only
    groups = list(group_cols)
    long = long_values(df.withColumn("__g", F.struct(*[F.col(g) for g in groups])), columns, carry="__g").withColumnRenamed(_KEY, "variable")
    value = ["variable", "__g", _VAL]
    if num_partitions:
        long = long.withColumn("__s", F.spark_partition_id()).repartition(num_partitions, *value, "__s")
        counts = (long.groupBy(*value, "__s").agg(F.count(F.lit(1)).alias("c")).repartition(num_partitions, *value)
                  .groupBy(*value).agg(F.sum("c").alias("c")))
    else:
        counts = long.groupBy(*value).agg(F.count(F.lit(1)).alias("c"))
    # one text that tells NULL from every value, since joins don't match NULL keys
    text = [F.col(f"__g.{g}").cast("string") for g in groups]
    text = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text]
    counts = counts.withColumn(_KEY, F.concat_ws("\u0001", "variable", *text))
    cum = prefix_sums(counts, [_KEY], [F.col(_VAL)], ["c"], num_partitions, total_prefix="n_")
    n = F.col("n_c")
    picks, parts = [], []
    for i, prob in enumerate(probs):
        at = (n - 1) * F.lit(float(prob))
        for side, rank in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            picks.append(F.max(F.when((F.col("cum_c") - F.col("c") <= rank) & (rank < F.col("cum_c")), F.col(_VAL))).alias(f"{side}{i}"))
        lo, hi = F.col(f"lo{i}"), F.col(f"hi{i}")
        # the weighted mean that ``_interp`` takes
        parts.append(F.when(lo == hi, lo).otherwise((F.ceil(at) - at) * lo + (at - F.floor(at)) * hi))
    out = cum.groupBy("variable", "__g").agg(F.max("n_c").alias("n_c"), *picks)
    return out.select("variable", *[F.col(f"__g.{g}").alias(g) for g in groups], n.cast("bigint").alias("n"), F.array(*parts).alias("q"))


def rank_values(long_df: DataFrame, ranks_for_n, **kw) -> dict:
    """Exact values at chosen 1-based ranks per key; ``ranks_for_n(n)`` gives the ranks for a key of n values.

    Returns ``{key: (n, [(rank, value), ...])}`` (bounded by keys x ranks).
    """
    stats = {r[_KEY]: {"n": r["n"], "min": r["mn"], "max": r["mx"]} for r in
             long_df.groupBy(_KEY).agg(F.count(_VAL).alias("n"), F.min(_VAL).alias("mn"),
                                       F.max(_VAL).alias("mx")).collect()}
    wanted = {k: sorted({r - 1 for r in ranks_for_n(s["n"])}) for k, s in stats.items() if s["n"]}
    vals = select_ranks(long_df, stats, wanted, **kw)
    return {k: (stats[k]["n"], [(r + 1, vals[(k, r)]) for r in rs]) for k, rs in wanted.items()}
