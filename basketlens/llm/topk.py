"""Exact top-k inner products by norm-bucketed retrieval.

Candidates are grouped by length (Euclidean norm) into levels, and levels into
blocks of bounded size. Each query starts from a threshold: its k-th best product
with the longest candidates. By the Cauchy-Schwarz inequality a level whose
longest vector times the query's length stays below that threshold is never paired
with the query.

In a task a block of queries meets a block of candidates, longest first, in
buckets. For each query and bucket the local cosine threshold is the query's
current k-th best product over both lengths:

* above 1 the bucket, and all shorter ones, are skipped;
* low ones are pruned by length: candidates whose length times the query's stays
  below the threshold are left out, the others are multiplied;
* high ones are pruned by coordinate: a unit vector p with cosine >= t to the unit
  query q lies within q_f * t -+ sqrt((1 - q_f^2) (1 - t^2)) or further along q_f
  for every coordinate f, so candidates outside that range on the query's largest
  coordinate are left out.

Products of the survivors are exact integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketlens.llm.common import written

#: Vectors of a block of queries or candidates, and of a bucket within a block.
BLOCK_ROWS = 2048
BUCKET_ROWS = 256
#: Longest candidates from which each query takes its first threshold.
SEED_ROWS = 256
#: Levels per doubling of the norm.
LEVELS_PER_OCTAVE = 4
#: Local cosine threshold from which coordinates prune.
COORDINATE_FROM = 0.6
#: Integers in double precision are exact up to here.
EXACT = 2.0**53
SLACK = 1e-9


def _matrix(vectors: list) -> np.ndarray:
    """Rows padded with zeros to the longest."""
    if not vectors:
        return np.zeros((0, 0))
    width = max(map(len, vectors))
    if all(len(v) == width for v in vectors):
        return np.array(vectors, np.float64).reshape(len(vectors), width)
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def _norms(m: np.ndarray) -> np.ndarray:
    """Euclidean norms without overflow."""
    top = np.abs(m).max(axis=1, initial=0.0)
    safe = np.where(top > 0, top, 1.0)
    return safe * np.sqrt(((m / safe[:, None]) ** 2).sum(axis=1))


def _products(a: np.ndarray, b: np.ndarray, pairs: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """Exact integer products of all rows, or of the given pairs of rows, as longs.

    Numbers too large for exact doubles go through Python integers; a product
    beyond a long becomes the nearest long."""
    width = max(1, a.shape[1])
    if np.abs(a).max(initial=0.0) * np.abs(b).max(initial=0.0) * width < EXACT:
        return (a @ b.T if pairs is None else np.einsum("ij,ij->i", a[pairs[0]], b[pairs[1]])).astype(np.int64)
    whole = lambda m: np.array([[int(x) for x in row] for row in m], object).reshape(m.shape)
    exact = whole(a).dot(whole(b).T) if pairs is None else (whole(a)[pairs[0]] * whole(b)[pairs[1]]).sum(axis=1)
    low, high = -(2**63), 2**63 - 1
    return np.array([max(low, min(high, int(x))) for x in np.ravel(exact)], np.int64).reshape(exact.shape)


def _same_width(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    width = max(a.shape[1], b.shape[1])
    return tuple(np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (a, b))


def _best(query: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Indices of the k best distinct ids of each query: by score, then smaller id.

    ``~scores`` falls as scores rise and, unlike ``-scores``, cannot overflow."""
    order = np.lexsort((~scores, ids, query))
    first = np.ones(len(order), bool)
    first[1:] = (query[order][1:] != query[order][:-1]) | (ids[order][1:] != ids[order][:-1])
    order = order[first]
    order = order[np.lexsort((ids[order], ~scores[order], query[order]))]
    begin = np.searchsorted(query[order], query[order], side="left")
    return order[np.arange(len(order)) - begin < k]


def search_block(query_ids: np.ndarray, queries: np.ndarray, thresholds: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best of one block of candidates for each query, if they may reach its
    threshold (-inf: none yet). Returns (query index, candidate id, score)."""
    queries, vectors = _same_width(queries, vectors)
    lengths = _norms(vectors)
    order = np.argsort(-lengths, kind="stable")
    ids, vectors, lengths = ids[order], vectors[order], lengths[order]
    query_lengths, limit = _norms(queries), thresholds.astype(np.float64).copy()
    unit_q = queries / np.where(query_lengths > 0, query_lengths, 1.0)[:, None]
    unit_c = vectors / np.where(lengths > 0, lengths, 1.0)[:, None]
    focus = np.abs(unit_q).argmax(axis=1) if queries.shape[1] else np.zeros(len(queries), np.int64)
    found = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    for at in range(0, len(ids), BUCKET_ROWS):
        bucket = slice(at, at + BUCKET_ROWS)
        reach = query_lengths * lengths[at]
        with np.errstate(divide="ignore", invalid="ignore"):
            local = np.where(limit == -np.inf, -np.inf, np.where(reach > 0, limit / reach, np.where(limit > 0, np.inf, -np.inf)))
        live = local <= 1 + SLACK
        if not live.any():
            break
        by_coordinate = np.flatnonzero(live & (local >= COORDINATE_FROM))
        by_length = np.flatnonzero(live & (local < COORDINATE_FROM))
        pairs = []
        if len(by_coordinate):
            t = np.minimum(local[by_coordinate], 1.0)
            f = unit_q[by_coordinate, focus[by_coordinate]]
            half = np.sqrt(np.maximum(0.0, (1 - f * f) * (1 - t * t))) + SLACK
            # bounds of p_f over all unit p with cosine >= t; beyond the pole they are open
            low = np.where(-f >= t, -1.0, f * t - half)
            high = np.where(f >= t, 1.0, f * t + half)
            value = unit_c[bucket][:, focus[by_coordinate]].T
            q, c = np.nonzero((value >= low[:, None] - SLACK) & (value <= high[:, None] + SLACK))
            pairs.append((by_coordinate[q], c + at, _products(queries, vectors, (by_coordinate[q], c + at))))
        if len(by_length):
            # the longest of the bucket that any of these queries still needs
            with np.errstate(invalid="ignore"):
                need = np.where(limit[by_length] > 0, limit[by_length] / np.maximum(query_lengths[by_length], 1e-300), 0.0).min() * (1 - SLACK)
            size = max(1, int(np.count_nonzero(lengths[bucket] >= need)))
            product = _products(queries[by_length], vectors[at:at + size])
            q, c = np.nonzero(product >= limit[by_length][:, None])
            pairs.append((by_length[q], c + at, product[q, c]))
        q, c, s = (np.concatenate(x) for x in zip(*pairs, strict=True))
        good = (s >= limit[q]) & (ids[c] != query_ids[q])
        q, c, s = np.concatenate([found[0], q[good]]), np.concatenate([found[1], ids[c[good]]]), np.concatenate([found[2], s[good]])
        keep = _best(q, c, s, k)
        found = q[keep], c[keep], s[keep]
        counts = np.bincount(found[0], minlength=len(query_ids))
        full = np.flatnonzero(counts >= k)
        last = np.cumsum(counts)[full] - 1
        limit[full] = np.maximum(limit[full], found[2][last])
    return found


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: float = 256.0) -> DataFrame:
    """(vec_id, v): floor(scale * x) of each component, as doubles that hold
    integers. Rows with a NULL id or vector, or with a NULL or non-finite
    component, take no part."""
    v = F.col("v")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return (vectors.select(F.col(f"`{id_col}`").cast("bigint").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
            .where(F.col("vec_id").isNotNull() & v.isNotNull() & F.coalesce(finite, F.lit(False)))
            .select("vec_id", F.transform("v", lambda x: F.when(F.abs(x) < 1e15, F.floor(x * scale).cast("double")).otherwise(x * scale)).alias("v")))


def _level(norm):
    """Integer level of a norm; all norms of a level lie below 2 ** ((level + 1) / LEVELS_PER_OCTAVE)."""
    return F.when(norm > 0, F.greatest(F.lit(0), F.least(F.lit(5000), F.floor(F.log2(norm) * LEVELS_PER_OCTAVE) + 1))).otherwise(F.lit(-1)).cast("int")


def top_k(vectors: DataFrame, every: int = 50, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """For every row whose id is divisible by ``every`` the k other rows with the
    largest inner products of floor(256 * x): query_id, rank (from 1), vec_id, score.

    All rows but the query's own are candidates; ties go to the smaller id; a query
    with fewer candidates returns all. Rows with a NULL id or vector, or with a NULL
    or non-finite component, take no part. Vectors of different dimension are
    compared as if padded with zeros. Rows that share an id count as one vector with
    several forms: the best product of its forms is its score. A product beyond a
    long becomes the nearest long. Other columns are not read; an empty table gives
    an empty result.

    Queries and candidates meet in blocks of BLOCK_ROWS; a task holds one pair of
    blocks. The driver sees the SEED_ROWS longest vectors and the row counts of the
    levels (at most 5,002).
    """
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    rows = written(quantised(vectors, id_col, vector_col).withColumn("norm", norm).withColumn("level", _level(F.col("norm"))), "vectors")
    queries = rows.where(F.col("vec_id") % every == 0)
    seeds = rows.orderBy(F.desc("norm"), "vec_id").limit(SEED_ROWS).collect()
    seed_ids, seed_vectors = np.array([r["vec_id"] for r in seeds], np.int64), _matrix([r["v"] for r in seeds])
    levels = {r["level"]: r["n"] for r in rows.groupBy("level").agg(F.count("*").alias("n")).collect()}
    n_queries = queries.count()
    query_blocks = -(-n_queries // BLOCK_ROWS)
    blocks = {level: -(-n // BLOCK_ROWS) for level, n in sorted(levels.items(), reverse=True)}
    names = sorted(blocks, reverse=True)
    longest = np.array([0.0 if x < 0 else np.inf if x >= 4000 else 2.0 ** ((x + 1) / LEVELS_PER_OCTAVE) for x in names])

    def seeded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                ids, own = np.array(part.column(0).to_pylist(), np.int64), _matrix(part.column(1).to_pylist())
                found = search_block(ids, own, np.full(len(ids), -np.inf), seed_ids, seed_vectors, k)
                counts = np.bincount(found[0], minlength=len(ids))
                limit = np.full(len(ids), -np.inf)
                full = np.flatnonzero(counts >= k)
                limit[full] = found[2][np.cumsum(counts)[full] - 1]
                # a level is needed if its longest vector may reach the threshold
                with np.errstate(invalid="ignore"):
                    need = [[names[j] for j in np.flatnonzero(~(longest * n * (1 + SLACK) < t))] for n, t in zip(_norms(own), limit, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(limit, pa.float64()), pa.array(need, pa.list_(pa.int32()))],
                                                 names=["vec_id", "v", "threshold", "levels"])

    spread = F.create_map(*[F.lit(x) for pair in blocks.items() for x in pair]) if blocks else F.lit(None).cast("map<int,int>")
    asked = queries.select("vec_id", "v").mapInArrow(seeded, "vec_id bigint, v array<double>, threshold double, levels array<int>")
    asked = (asked.withColumn("query_block", F.pmod(F.xxhash64("vec_id"), F.lit(max(1, query_blocks))))
             .withColumn("level", F.explode("levels")).withColumn("block", F.explode(F.sequence(F.lit(0), F.element_at(spread, F.col("level")) - 1)))
             .select("query_block", "level", "block", "vec_id", "v", "threshold"))
    offered = (rows.withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.element_at(spread, F.col("level"))).cast("int"))
               .withColumn("query_block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(max(1, query_blocks) - 1).cast("bigint"))))
               .select("query_block", "level", "block", "vec_id", "v"))

    def searched(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
        ids = left["vec_id"].to_numpy()
        q, c, s = search_block(ids, _matrix(left["v"].tolist()), left["threshold"].to_numpy(), right["vec_id"].to_numpy(), _matrix(right["v"].tolist()), k)
        return pd.DataFrame({"query_id": ids[q], "vec_id": c, "score": s})

    keys = ["query_block", "level", "block"]
    found = asked.groupBy(*keys).cogroup(offered.groupBy(*keys)).applyInPandas(searched, "query_id bigint, vec_id bigint, score bigint")
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
