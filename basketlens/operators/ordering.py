"""Global running sums and ranks without a single-task window.

A window ordered over a whole table runs in one task. Instead:

1. Collapse ties first (``groupBy(key, value).count()``): a value held by a
   third of all rows becomes one row.
2. Range-partition the distinct values (``repartitionByRange``) and compute
   running sums *within* each range partition.
3. Per-partition totals (bounded by partitions x keys) give each partition its
   offset through a small window and a broadcast join. The range-partitioned
   frame is checkpointed (reliably) so partition ids are stable.

Ranks of individual rows are regenerated from (start, count) runs in chunks
of bounded size, so a hot value's rows are emitted by many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

CHUNK = 50_000


def _parts(df: DataFrame, n: int | None) -> int:
    if n:
        return n
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))


def prefix_sums(df: DataFrame, keys: Sequence[str], order: Sequence[Column], sum_cols: Sequence[str],
                num_partitions: int | None = None, prefix: str = "cum_", few_keys: bool | None = None,
                total_prefix: str | None = None) -> DataFrame:
    """Add inclusive running sums of ``sum_cols`` in ``order`` within each key.

    ``df`` should already have one row per distinct ordering value (collapse
    ties first). One task handles the rows of one range partition; the
    partitions' offsets are added. Tables of every size go the same way.
    The offsets (partitions x keys rows) are broadcast without keys, or where the
    caller knows the keys to be few; else the engine picks the join by size.
    With ``num_partitions`` the sums within a range partition are taken over that many
    partitions too, instead of the session's. ``total_prefix`` adds each key's total.
    Rows with a NULL key take no part.
    """
    keys = list(keys)
    p = _parts(df, num_partitions)
    # The partition id is materialised once with a reliable checkpoint: the
    # window branch and the totals branch (and any recomputation after an
    # executor loss) must see the same range partition of every row, which a
    # recomputed exchange (AQE coalescing, new samples) does not guarantee.
    r = cut_lineage(df.repartitionByRange(p, *[F.col(k) for k in keys], *order)
                    .withColumn("__pid", F.spark_partition_id()))
    w = Window.partitionBy("__pid", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    dealt = r.repartition(p, "__pid", *keys) if num_partitions else r
    local = dealt.withColumns({f"__l_{c}": F.sum(c).over(w) for c in sum_cols})
    totals = r.groupBy("__pid", *keys).agg(*[F.sum(c).alias(f"__t_{c}") for c in sum_cols])
    wo = Window.partitionBy(*keys).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    offsets = totals.select("__pid", *keys, *[F.coalesce(F.sum(f"__t_{c}").over(wo), F.lit(0)).alias(f"__o_{c}")
                                              for c in sum_cols],
                            *[F.sum(f"__t_{c}").over(whole).alias(f"{total_prefix}{c}") for c in sum_cols if total_prefix])
    small = not keys if few_keys is None else few_keys
    out = local.join(F.broadcast(offsets) if small else offsets, ["__pid", *keys])
    return out.select(*df.columns, *[(F.col(f"__l_{c}") + F.col(f"__o_{c}")).alias(f"{prefix}{c}")
                                     for c in sum_cols], *[f"{total_prefix}{c}" for c in sum_cols if total_prefix])


def value_ranks(long_df: DataFrame, key: str, value: str, num_partitions: int | None = None,
                chunk: int = CHUNK, few_keys: bool = False) -> DataFrame:
    """One row per input row: (key, value, rank 1..n within key by value, n).

    Tied values receive consecutive ranks (their order is immaterial since
    the rows are identical in (key, value)). ``few_keys`` says that the keys are few
    enough to broadcast a row of each (column names, say).
    """
    d = long_df.groupBy(key, value).agg(F.count(F.lit(1)).alias("__c"))
    d = prefix_sums(d, [key], [F.col(value)], ["__c"], num_partitions, few_keys=few_keys)
    n = d.groupBy(key).agg(F.sum("__c").alias("n"))
    runs = d.select(key, value, (F.col("cum___c") - F.col("__c") + 1).alias("__s"), F.col("__c"))
    # Split long runs into chunks of at most ``chunk`` ranks, spread them, then expand.
    pieces = (runs.withColumn("__k", F.explode(F.sequence(F.lit(0), ((F.col("__c") - 1) / chunk).cast("long"))))
              .select(key, value,
                      (F.col("__s") + F.col("__k") * chunk).alias("__a"),
                      F.least(F.col("__s") + F.col("__k") * chunk + chunk - 1,
                              F.col("__s") + F.col("__c") - 1).alias("__b")))
    pieces = pieces.repartition(_parts(long_df, num_partitions), key, "__a")
    ranked = pieces.select(key, value, F.explode(F.sequence("__a", "__b")).alias("rank"))
    return ranked.join(F.broadcast(n) if few_keys else n, key)
