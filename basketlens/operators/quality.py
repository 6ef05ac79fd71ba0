"""Data quality: missing-value reports and policies, integrity checks, IQR filters.

Reports are small DataFrames computed in one aggregation pass each; repairs
are projections/filters. Scalars a policy needs (mode, 'Unknown' count,
quantiles) come from separate small distributed jobs.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import blank_to_null, is_blank_or_null
from ..sources.schemas import ID_COLUMNS
from .binning import iqr_bounds
from .quantiles import bounded_quantiles, column_quantiles


# ---------------------------------------------------------------------------
# Reports
# ---------------------------------------------------------------------------

def require_columns(df: DataFrame, required: Sequence[str]) -> None:
    """Raise if any required column is missing."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}; available: {df.columns}")


def shape_report(df: DataFrame, name: str) -> DataFrame:
    """(dataset, rows, columns) (A3)."""
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(name).alias("dataset"), F.col("rows"), F.lit(len(df.columns)).cast("bigint").alias("columns"))


def missing_report(df: DataFrame) -> DataFrame:
    """(column, n_null, n_invalid) for every column in ONE pass.

    ``n_invalid`` also counts '' and ' ' text, as the reference does.
    """
    aggs = []
    for f in df.schema.fields:
        aggs.append(F.count_if(F.col(f.name).isNull()).alias(f"n__{f.name}"))
        inv = is_blank_or_null(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name).isNull()
        aggs.append(F.count_if(inv).alias(f"i__{f.name}"))
    wide = df.agg(*aggs)
    pairs = [F.struct(F.lit(f.name).alias("column"), F.col(f"n__{f.name}").cast("bigint").alias("n_null"),
                      F.col(f"i__{f.name}").cast("bigint").alias("n_invalid"))
             for f in df.schema.fields]
    return wide.select(F.inline(F.array(*pairs)))


# ---------------------------------------------------------------------------
# Missing-value policies
# ---------------------------------------------------------------------------

def normalize_blanks(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """'' / ' ' text to NULL so one policy treats blanks and NULLs alike."""
    cols = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: blank_to_null(c) for c in cols})


def mode_value(df: DataFrame, col: str):
    """Most frequent non-NULL value, lowest on ties (C6). Distributed top-1, no value map on one task."""
    row = (df.filter(F.col(col).isNotNull()).groupBy(col).count()
           .orderBy(F.desc("count"), F.asc(col)).limit(1).collect())
    return row[0][0] if row else None


def handle_missing_values(df: DataFrame, col: str, policy: str = "keep") -> DataFrame:
    """Policy 'delete' | 'default' | 'keep' for a non-identifier column."""
    df = normalize_blanks(df, [col]) if isinstance(df.schema[col].dataType, T.StringType) else df
    if policy == "keep":
        return df
    if policy == "delete":
        return df.dropna(subset=[col])
    if policy != "default":
        raise ValueError(f"unknown policy {policy!r}")
    if isinstance(df.schema[col].dataType, T.StringType):
        k = df.agg(F.count_if(F.col(col).contains("Unknown"))).first()[0]
        return df.withColumn(col, F.coalesce(F.col(col), F.lit(f"Unknown-{k + 1}")))
    m = mode_value(df, col)
    return df if m is None else df.withColumn(col, F.coalesce(F.col(col), F.lit(m)))


ID_CHUNK = 50_000  # ordinals of identical rows that one output row of the first expansion stands for


def _content_text(columns: Sequence[str]):
    """Row content as one text: '<length>:<value>' per column, '-' for NULL, so no two contents agree."""
    parts = []
    for c in columns:
        text = F.col(f"`{c}`").cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.concat(*parts) if parts else F.lit("")


def fill_missing_ids(df: DataFrame, col: str, seed: str = "basketlens", length: int = 32) -> DataFrame:
    """Give every row with a missing identifier its own deterministic ID (C7, D-J4, D15).

    ID = upper-case hex prefix of sha2('seed|ordinal|content'), where identical
    rows are numbered 1, 2, ... So the IDs depend on the rows alone, never on
    their partitions. Identical rows are counted map-side, and a hot group is
    expanded again in chunks that are spread over tasks. An ID that a row
    already has is given up for a second hash; 32 hex characters (128 bits)
    make any other collision negligible.
    """
    df = normalize_blanks(df, [col])
    others = [c for c in df.columns if c != col]
    have = df.filter(F.col(col).isNotNull())
    need = (df.filter(F.col(col).isNull()).groupBy(*[F.col(f"`{c}`") for c in others])
            .agg(F.count(F.lit(1)).alias("__n"))
            .withColumn("__k", F.explode(F.sequence(F.lit(0).cast("long"),
                                                    F.floor((F.col("__n") - 1) / ID_CHUNK).cast("long"))))
            .withColumn("__content", _content_text(others)))
    need = (need.repartition("__content", "__k")
            .withColumn("__ord", F.explode(F.sequence(F.col("__k") * ID_CHUNK + 1,
                                                      F.least(F.col("__n"), (F.col("__k") + 1) * ID_CHUNK)))))

    def hashed(label: str):
        text = F.concat(F.lit(f"{label}|"), F.col("__ord").cast("string"), F.lit("|"), F.col("__content"))
        return F.upper(F.substring(F.sha2(text, 256), 1, length))

    taken = have.select(F.col(col).alias("__id")).distinct().withColumn("__taken", F.lit(True))
    filled = (need.withColumn("__id", hashed(seed)).join(taken, "__id", "left")
              .withColumn(col, F.when(F.col("__taken"), hashed(f"{seed}/2")).otherwise(F.col("__id")))
              .select(*[F.col(f"`{c}`") for c in df.columns]))
    return have.unionByName(filled)


def handle_missing_identifiers(df: DataFrame, col: str, policy: str = "delete", **kw) -> DataFrame:
    """Identifier policy 'delete' | 'generate' (C7, C8); blanks count as missing."""
    if policy == "delete":
        if isinstance(df.schema[col].dataType, T.StringType):
            return df.filter(F.trim(F.col(col)) != "")  # what is left has no blanks to normalise
        return normalize_blanks(df, [col]).dropna(subset=[col])
    if policy == "generate":
        return fill_missing_ids(df, col, **kw)
    if policy == "keep":
        return df
    raise ValueError(f"unknown identifier policy {policy!r}")


def process_missing_data(df: DataFrame, policies: Mapping[str, str] | None = None,
                         default_policy: str = "keep", id_policy: str = "delete") -> DataFrame:
    """Apply a policy per column; identifiers use the identifier policies.

    Declarative replacement for the reference's prompts: ``policies`` maps a
    column to 'delete' | 'default' | 'keep' (or 'generate' for IDs).
    """
    policies = dict(policies or {})
    for c in df.columns:
        if c in ID_COLUMNS:
            df = handle_missing_identifiers(df, c, policies.get(c, id_policy))
        else:
            df = handle_missing_values(df, c, policies.get(c, default_policy))
    return df


# ---------------------------------------------------------------------------
# Integrity
# ---------------------------------------------------------------------------

def remove_negative_unit_price(df: DataFrame, col: str = "UnitPrice") -> DataFrame:
    """Drop negative prices, keep NULL prices."""
    return df.filter((F.col(col) >= 0) | F.col(col).isNull())


def duplicate_report(df: DataFrame) -> DataFrame:
    """Every fully duplicated row content with its multiplicity (C11). NULLs group together."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)


def drop_duplicates(df: DataFrame) -> DataFrame:
    """Full-row dedup (C12): hash aggregation on all columns, partial map-side."""
    return df.dropDuplicates()


def drop_missing(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Drop rows NULL in any required column."""
    return df.dropna(subset=list(required))


def perform_integrity_checks(lines: DataFrame, campaign: DataFrame):
    """Negative prices out, duplicates out for both inputs (C16). Returns (lines, campaign)."""
    return drop_duplicates(remove_negative_unit_price(lines)), drop_duplicates(campaign)


def observed_integrity_checks(lines: DataFrame, campaign: DataFrame):
    """Integrity checks with before/after counts collected as a side effect.

    Returns (lines_clean, campaign_clean, observations). The ``Observation``
    metrics are filled when the caller's own action over the cleaned frames
    runs, so the report costs no extra pass; ``obs[name].get`` then holds
    ``{"rows": ...}`` (and ``negative_price`` for the lines input).
    """
    from pyspark.sql import Observation
    obs = {n: Observation(n) for n in ("lines_input", "lines_final", "campaign_input", "campaign_final")}
    lines_in = lines.observe(obs["lines_input"], F.count(F.lit(1)).alias("rows"),
                             F.count_if(F.col("UnitPrice") < 0).alias("negative_price"))
    lines_clean = drop_duplicates(remove_negative_unit_price(lines_in)).observe(
        obs["lines_final"], F.count(F.lit(1)).alias("rows"))
    campaign_in = campaign.observe(obs["campaign_input"], F.count(F.lit(1)).alias("rows"))
    campaign_clean = drop_duplicates(campaign_in).observe(obs["campaign_final"], F.count(F.lit(1)).alias("rows"))
    return lines_clean, campaign_clean, obs


def integrity_report(lines: DataFrame, campaign: DataFrame) -> DataFrame:
    """Row counts per step: (dataset, step, rows), each input scanned once.

    Rows are counted per content (map-side first, so many copies of one row are no hot group); input, removed and
    final counts then all follow from the contents and their multiplicities.
    """
    def counted(df, name, bad):
        content = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("__n"))
        bad = F.coalesce(bad, F.lit(False))
        steps = [("input", F.coalesce(F.sum("__n"), F.lit(0)))]
        if name == "lines":
            steps.append(("negative_price_removed", F.coalesce(F.sum(F.when(bad, F.col("__n"))), F.lit(0))))
        steps.append(("final", F.count_if(~bad)))
        row = content.agg(*[e.cast("bigint").alias(s) for s, e in steps])
        return row.select(F.inline(F.array(*[F.struct(F.lit(name).alias("dataset"), F.lit(s).alias("step"), F.col(s).alias("rows")) for s, _ in steps])))

    return counted(lines, "lines", F.col("UnitPrice") < 0).unionByName(counted(campaign, "campaign", F.lit(False)))


# ---------------------------------------------------------------------------
# Fills (C17, C18)
# ---------------------------------------------------------------------------

def median_fill(df: DataFrame, columns: Sequence[str], **qkw) -> DataFrame:
    """NULLs of each column replaced by the column's exact median (C17)."""
    q = column_quantiles(df, list(columns), [0.5], **qkw)
    fills = {c: q[c]["q"][0] for c in columns if q[c]["q"][0] is not None}
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v).cast(df.schema[c].dataType)) for c, v in fills.items()})


def constant_fill(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """fillna with a per-column constant."""
    return df.fillna(dict(values))


# ---------------------------------------------------------------------------
# IQR outlier filter
# ---------------------------------------------------------------------------

def _step_report(df: DataFrame, steps) -> DataFrame:
    """(step, column, lower, upper, removed, remaining) from ONE aggregation over the input.

    ``steps`` holds (step, column, lower, upper, keep-condition); the rows kept
    after step i are those meeting conditions 0..i, so cumulative ``count_if``
    gives every count in one pass (C20).
    """
    schema = "step int, column string, lower double, upper double, removed bigint, remaining bigint"
    if not steps:
        return df.sparkSession.createDataFrame([], schema)
    acc = F.lit(True)
    aggs = [F.count(F.lit(1)).alias("n0")]
    for i, (_, _, _, _, cond) in enumerate(steps):
        acc = acc & cond
        aggs.append(F.count_if(acc).alias(f"r{i}"))
    structs = []
    for i, (step, col, lo, hi, _) in enumerate(steps):
        prev = F.col("n0") if i == 0 else F.col(f"r{i - 1}")
        structs.append(F.struct(F.lit(step).cast("int").alias("step"), F.lit(col).alias("column"),
                                F.lit(lo).cast("double").alias("lower"), F.lit(hi).cast("double").alias("upper"),
                                (prev - F.col(f"r{i}")).cast("bigint").alias("removed"),
                                F.col(f"r{i}").cast("bigint").alias("remaining")))
    return df.agg(*aggs).select(F.inline(F.array(*structs)))


def iqr_filter(df: DataFrame, columns: Sequence[str], mode: str = "sequential", nulls: str = "drop",
               k: float = 1.5, **qkw):
    """Keep rows inside [Q1 - k IQR, Q3 + k IQR] for each column.

    ``mode='sequential'`` reproduces the reference (each column's quartiles
    come from the rows surviving the previous columns); ``'simultaneous'``
    takes every column's bounds from the input in one pass. ``nulls='drop'``
    drops NULL cells (the reference's keep-inside filter), ``'keep'`` keeps
    them. Returns (filtered frame, report frame (step, column, lower, upper,
    removed, remaining), the counts from one aggregation over the input).
    The sequential mode costs one job for all columns' spans and then one or two
    jobs a column; its conditions stack up in one filter over the input, which the
    caller may want to have cached.
    """
    cols = [c for c in columns if c in df.columns]
    report = []

    def keep(c, lo, hi):
        inside = F.col(c).between(lo, hi)
        return (inside | F.col(c).isNull()) if nulls == "keep" else F.coalesce(inside, F.lit(False))

    if mode == "simultaneous":
        q = column_quantiles(df, cols, [0.25, 0.75], **qkw)
        cond = F.lit(True)
        for i, c in enumerate(cols):
            if q[c]["n"] == 0:
                continue
            lo, hi = iqr_bounds(*q[c]["q"], k=k)
            cond = cond & keep(c, lo, hi)
            report.append((i, c, lo, hi, keep(c, lo, hi)))
        return df.filter(cond), _step_report(df, report)

    if mode != "sequential":
        raise ValueError(f"unknown mode {mode!r}")
    # one pass gives every column's bounds and count over the input; they hold for all that survives, so
    # each step needs no statistics of its own: its one or two jobs read the input under the filters so far
    first = df.agg(*[a for i, c in enumerate(cols) for a in _column_span(c, i)]).first() if cols else None
    cond = F.lit(True)
    alive = None
    for i, c in enumerate(cols):
        if not first[f"n{i}"]:
            continue
        most = first[f"n{i}"] if alive is None else min(alive, first[f"n{i}"])
        q = bounded_quantiles(df.filter(cond), c, [0.25, 0.75], first[f"mn{i}"], first[f"mx{i}"], most, **qkw)
        if q["n"] == 0:
            continue
        if nulls == "drop":
            alive = q["n"]  # later columns see at most the rows that had a value here
        lo, hi = iqr_bounds(*q["q"], k=k)
        cond = cond & keep(c, lo, hi)
        report.append((i, c, lo, hi, keep(c, lo, hi)))
    return df.filter(cond), _step_report(df, report)


def _column_span(c: str, i: int):
    """Count, smallest and largest finite value of a column."""
    v = F.col(c).cast("double")
    ok = F.when(~F.isnan(v) & (F.abs(v) != float("inf")), v)
    return F.count(ok).alias(f"n{i}"), F.min(ok).alias(f"mn{i}"), F.max(ok).alias(f"mx{i}")
