"""Customer clustering on MLlib.

Scaling is one aggregation; K-means, bisecting K-means and PCA are MLlib
(distributed). Ward linkage on every customer is O(n²) and is re-aimed: bisecting
K-means over all rows gives the hierarchical labels (I5), and its splits, measured
by Ward's distance with Spark aggregates, the dendrogram (I6).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.ml.clustering import BisectingKMeans, KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import finite_or_null
from ..session import cut_lineage, ensure_checkpoint_dir, fit_partitions
from .modeling import CATEGORICAL_INT_FIELDS, numeric_model_columns, standard_scale
from .quality import iqr_filter


def clustering_matrix(data: DataFrame, columns: Sequence[str] | None = None, key: str | None = "CustomerID",
                      remove_outliers: bool = False):
    """Numeric columns, [sequential IQR filter], inf/NULL -> 0, population-std scaling, assembled.

    Returns (frame with ``features`` vector and the key, column list).
    """
    # loyalty and nps are categories in the reference, so not clustering inputs.
    cols = list(columns) if columns else [c for c in numeric_model_columns(data, response="__none__")
                                          if c not in CATEGORICAL_INT_FIELDS]
    df = data.select(*([key] if key and key in data.columns else []), *cols)
    if remove_outliers:
        df, _ = iqr_filter(df, cols, mode="sequential")
    df = df.withColumns({c: F.coalesce(finite_or_null(c), F.lit(0.0)) for c in cols})
    df = standard_scale(df, cols)
    va = VectorAssembler(inputCols=cols, outputCol="features")
    return va.transform(df), cols


def choose_k(features: DataFrame, k_values: Sequence[int] = range(2, 11), seed: int = 42) -> DataFrame:
    """(k, inertia, silhouette) per k; the caller takes the argmax silhouette.

    Silhouette is MLlib's squared-Euclidean variant (linear-time), not the
    O(n²) Euclidean one.
    """
    features = fit_partitions(features, features.count()).persist(StorageLevel.MEMORY_AND_DISK)  # every fit reads it
    try:
        return _search_k(features, k_values, seed)[0]
    finally:
        features.unpersist()


def _search_k(features: DataFrame, k_values: Sequence[int], seed: int, parallelism: int = 4):
    """Fit every k concurrently (like CrossValidator's ``parallelism``): each fit is a
    chain of small jobs, so running several keeps the executors busy. Seeded fits,
    so the result does not depend on the interleaving."""
    from concurrent.futures import ThreadPoolExecutor

    def fit(k):
        model = KMeans(k=int(k), seed=seed, featuresCol="features").fit(features)
        ev = ClusteringEvaluator(featuresCol="features", predictionCol="prediction")
        return int(k), model, float(model.summary.trainingCost), float(ev.evaluate(model.transform(features)))

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        results = list(pool.map(fit, list(k_values)))
    rows = [(k, cost, sil) for k, _, cost, sil in results]
    models = {k: m for k, m, _, _ in results}
    return features.sparkSession.createDataFrame(rows, "k int, inertia double, silhouette double"), rows, models


def bisecting(feats: DataFrame, k: int, seed: int = 42):
    """MLlib's bisecting K-means over all rows: (model, rows with the leaf index ``__leaf``).

    MLlib starts a split at the centre times 1 ± a small noise, so a centre at the
    origin, as that of scaled columns, is never split. All rows are therefore moved
    by 1 in each column, which changes no distance.
    """
    moved = feats.withColumn("__moved", array_to_vector(F.transform(vector_to_array("features"), lambda x: x + 1.0)))
    model = BisectingKMeans(k=k, seed=seed, featuresCol="__moved", predictionCol="__leaf").fit(moved)
    return model, model.transform(moved).drop("__moved")


def bisecting_tree(model, spark) -> dict:
    """{index: child indices} of a bisecting K-means model, read from its saved data.

    At most 2k - 1 entries whatever the number of rows; leaves have no children.
    """
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/bisecting-{uuid.uuid4().hex}"
    model.write().save(path)
    return {r["index"]: list(r["children"]) for r in spark.read.parquet(f"{path}/data/data").select("index", "children").collect()}


def split_table(labelled: DataFrame, nodes: dict) -> DataFrame:
    """Every split of the tree as a merge (step, left, right, height, size), lowest first.

    Sizes and centres are aggregates over all rows. The height is Ward's distance
    of the two sides, sqrt(2ab / (a + b)) times the distance of their centres, and
    no less than the height of any split below, so a merge follows those it is
    made of. Leaves keep their index; merge ``step`` has the id leaves + step - 1.
    """
    spark = labelled.sparkSession
    parent = {c: i for i, children in nodes.items() for c in children}
    above = []
    for i in nodes:
        at = i
        while at is not None:
            above.append((i, at))
            at = parent.get(at)
    pairs = F.broadcast(spark.createDataFrame(above, "node int, top int"))
    splits = F.broadcast(spark.createDataFrame([(i, *c) for i, c in nodes.items() if c], "node int, l int, r int"))
    rows = labelled.groupBy("__leaf").agg(F.count("*").alias("n"), vector_to_array(Summarizer.sum(F.col("features"))).alias("s"))
    total = F.aggregate(F.collect_list("s"), F.lit(None).cast("array<double>"),  # one entry for each leaf below
                        lambda out, x: F.coalesce(F.zip_with(out, x, lambda p, q: p + q), x))
    stats = (rows.join(pairs, F.col("__leaf") == F.col("node")).groupBy("top")
             .agg(F.sum("n").alias("n"), total.alias("s")))
    stats = cut_lineage(stats)  # read several times below; one row a node
    left = stats.select(F.col("top").alias("l"), F.col("n").alias("ln"), F.col("s").alias("ls"))
    right = stats.select(F.col("top").alias("r"), F.col("n").alias("rn"), F.col("s").alias("rs"))
    gap = F.zip_with("ls", "rs", lambda x, y: x / F.col("ln") - y / F.col("rn"))
    squared = F.aggregate(gap, F.lit(0.0), lambda total, g: total + g * g)
    own = cut_lineage(splits.join(left, "l").join(right, "r").select(
        "node", "l", "r", (F.col("ln") + F.col("rn")).alias("size"),
        F.sqrt(2.0 * F.col("ln") * F.col("rn") / (F.col("ln") + F.col("rn")) * squared).alias("h")))
    height = own.select("node", "h").join(pairs, "node").groupBy(F.col("top").alias("node")).agg(F.max("h").alias("height"))
    depth = pairs.groupBy("node").agg(F.count("*").alias("depth"))
    # a window over the splits of the tree, whose number ``leaves`` bounds
    step = F.row_number().over(Window.orderBy("height", F.desc("depth"), "node"))
    merges = cut_lineage(own.join(height, "node").join(depth, "node").withColumn("step", step))
    leaves = sum(not c for c in nodes.values())
    ids = merges.select(F.col("node").alias("__node"), (F.col("step") + leaves - 1).alias("__id"))
    for side in ("l", "r"):
        merges = merges.join(ids, F.col(side) == F.col("__node"), "left").withColumn(side, F.coalesce("__id", side)).drop("__node", "__id")
    return merges.select("step", F.col("l").cast("int").alias("left"), F.col("r").cast("int").alias("right"), "height", "size")


def cluster_analysis(data: DataFrame, remove_outliers: bool = False, k: int | None = None,
                     k_values: Sequence[int] = range(2, 11), seed: int = 42, key: str = "CustomerID"):
    """K-means with k by best silhouette, bisecting K-means with the same k, 2-D PCA.

    The hierarchical labels 1..k are the leaves of MLlib's bisecting K-means over
    all rows.
    Returns (assignments DataFrame (key, features..., kmeans_cluster,
    hierarchical_cluster, pc1, pc2), k-search table, k).
    """
    feats, cols = clustering_matrix(data, key=key, remove_outliers=remove_outliers)
    feats = cut_lineage(fit_partitions(feats, feats.count())).persist(StorageLevel.MEMORY_AND_DISK)  # many small jobs follow
    search = None
    if k is None:
        # the search already fitted KMeans(k, seed) for every k: reuse the chosen model
        search, rows, models = _search_k(feats, k_values, seed)
        k = max(rows, key=lambda r: (r[2], -r[0]))[0]
        km = models[k]
    else:
        km = KMeans(k=k, seed=seed, featuresCol="features").fit(feats)
    km.setPredictionCol("kmeans_cluster")
    out = km.transform(feats)
    out = bisecting(out, k, seed)[1]
    out = out.withColumn("hierarchical_cluster", F.col("__leaf") + 1)
    pca = PCA(k=2, inputCol="features", outputCol="__pc").fit(out)
    out = pca.transform(out)
    arr = vector_to_array("__pc")
    keep = [key] if key in out.columns else []
    res = out.select(*keep, *cols, F.col("kmeans_cluster").cast("int"), F.col("hierarchical_cluster").cast("int"),
                     arr[0].alias("pc1"), arr[1].alias("pc2"))
    return res, search, k


def split_dendrogram(data: DataFrame, max_leaves: int | None = None, last: int = 10, seed: int = 42,
                    remove_outliers: bool = False) -> DataFrame:
    """Last ``last`` merges (step, left, right, height, size) of the bisecting K-means tree.

    A merge is no higher than those above it, so the last ones lie in the first
    ``last`` levels; the default 2^last leaves split all of these.
    """
    feats, _ = clustering_matrix(data, key=None, remove_outliers=remove_outliers)
    feats = cut_lineage(fit_partitions(feats, feats.count())).persist(StorageLevel.MEMORY_AND_DISK)  # many small jobs follow
    model, labelled = bisecting(feats, max_leaves or 2 ** last, seed)
    merges = split_table(labelled, bisecting_tree(model, data.sparkSession))
    return merges.orderBy(F.desc("step")).limit(last).orderBy("step")


def write_assignments(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Sink of cluster assignments."""
    df.write.mode("overwrite").format(fmt).option("header", True).save(path)
