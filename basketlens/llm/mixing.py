"""Mixing sources to target weights by Poisson replication.

A source with size c (characters of its whole texts) and target share w of a
budget of B characters is repeated w * B / c times on average. Every document draws
its own number of copies: a hash of the seed and its key gives a uniform number,
and the inverse Poisson distribution function turns it into a count. Copies are
then ordered globally by another hash. So the result depends on the rows and the
seed only, not on partitions, and no source is ever gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.llm.common import written

SEED = 17
#: Share of a source in proportion to its size to this power, without given weights.
ALPHA = 0.5
#: Mean of the budget in passes over all documents.
EPOCHS = 1.0
#: Larger rates are drawn as sums of several Poisson numbers.
LARGEST_DRAW = 256.0
#: Up to so many sources their table is broadcast; a larger one is joined by shuffle.
BROADCAST_SOURCES = 2_000


def _uniform(*parts: Column) -> Column:
    """52 bits of a hash as a number in [0, 1)."""
    digits = F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / float(2**52)


def _document_key() -> Column:
    return F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text"), F.md5(F.coalesce("text", F.lit("")))))


def source_rates(docs: DataFrame, weights: dict[str, float] | None = None, alpha: float = ALPHA, epochs: float = EPOCHS) -> DataFrame:
    """One row per source: source, chars, rate (mean copies of each of its documents).

    ``weights`` gives target shares (any scale; sources left out get none);
    otherwise shares are in proportion to chars ** alpha. A source without any
    character has the rate ``epochs``. NULL is a source of its own.
    """
    sizes = docs.groupBy("source").agg(F.sum(F.coalesce(F.length("text"), F.lit(0)).cast("bigint")).alias("chars"))
    if weights is None:
        share = F.pow(F.col("chars").cast("double"), F.lit(alpha))
    else:
        given = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair]) if weights else F.lit(None).cast("map<string,double>")
        share = F.coalesce(F.element_at(given, F.col("source")).cast("double"), F.lit(0.0))
    shares = written(sizes.withColumn("share", share), "sources")
    totals = shares.agg(F.sum("chars").cast("double").alias("chars"), F.sum("share").alias("share")).first()
    all_chars, all_shares = totals["chars"] or 0.0, totals["share"] or 0.0
    if not all_shares:
        return shares.select("source", "chars", F.lit(float(epochs) if weights is None else 0.0).alias("rate"))
    rate = F.col("share") / F.lit(all_shares) * F.lit(all_chars * epochs) / F.col("chars")
    return shares.select("source", "chars", F.when(F.col("chars") > 0, rate).otherwise(F.lit(float(epochs))).alias("rate"))


def _with_distribution(rates: DataFrame) -> DataFrame:
    """Adds ``draws`` and ``cdf``: a count is the sum over draws of the number of
    entries of the distribution function that a uniform number reaches."""
    each = rates.withColumn("draws", F.greatest(F.lit(1), F.ceil(F.col("rate") / LARGEST_DRAW)).cast("int")).withColumn("mean", F.col("rate") / F.col("draws"))
    last = (F.ceil(F.col("mean") + 12 * F.sqrt("mean")) + 40).cast("int")
    start = F.struct(F.exp(-F.col("mean")).alias("p"), F.array(F.exp(-F.col("mean"))).alias("cdf"))

    def step(acc: Column, k: Column) -> Column:
        p = acc["p"] * F.col("mean") / k
        return F.struct(p.alias("p"), F.concat(acc["cdf"], F.array(F.element_at(acc["cdf"], -1) + p)).alias("cdf"))

    return each.withColumn("cdf", F.aggregate(F.sequence(F.lit(1), last), start, step, lambda acc: acc["cdf"]))


def mix(docs: DataFrame, weights: dict[str, float] | None = None, alpha: float = ALPHA, epochs: float = EPOCHS, seed: int = SEED,
        columns: list[str] | None = None) -> DataFrame:
    """Copies of the rows of ``docs`` in a global random order: the given columns (all
    by default), ``copy`` (from 0) and ``shuffle_key``.

    Rows draw by their doc_id, or by their text where that is NULL; repeated rows
    draw the same number. A NULL text has no characters. An empty table gives no rows. A
    column of ``docs`` called ``copy`` or ``shuffle_key``, in any case, is replaced. The order is that of ``shuffle_key``:
    partitions are ranges of it and sorted. A hot source is not gathered: the table
    of sources is broadcast if a count shows it to be small, else joined by shuffle
    with the split of skewed keys left to adaptive execution.
    """
    rates = written(_with_distribution(source_rates(docs, weights, alpha, epochs)).select(F.col("source").alias("__source"), "draws", "cdf"), "rates")
    if rates.count() <= BROADCAST_SOURCES:
        rates = F.broadcast(rates)
    kept = [c for c in columns or docs.columns if c.lower() not in ("copy", "shuffle_key")]
    # the row as one column, so that its own column names can't clash
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), "source", _document_key().alias("key"))
    rows = whole.join(rates, whole["source"].eqNullSafe(F.col("__source"))).select("row", "key", "draws", "cdf")

    def drawn(total: Column, j: Column) -> Column:
        return total + F.size(F.filter("cdf", lambda c: c <= _uniform(F.lit(str(seed)), F.col("key"), j.cast("string"))))

    copies = F.aggregate(F.sequence(F.lit(0), F.col("draws") - 1), F.lit(0), drawn)
    counted = rows.select("row", "key", copies.alias("copies")).where("copies > 0")
    copied = counted.select("row", "key", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"))
    keyed = copied.select("row", "copy", F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit("order"), "key", F.col("copy").cast("string"))).alias("shuffle_key"))
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # the key is uniform: equal ranges of its first digits need no sample of the rows
    place = F.conv(F.substring("shuffle_key", 1, 8), 16, 10).cast("bigint")
    part = F.floor(place * partitions / (1 << 32)).cast("int")
    return (keyed.repartitionById(partitions, part).sortWithinPartitions("shuffle_key")
            .select(*[F.col(f"row.`{c}`") for c in kept], "copy", "shuffle_key"))
