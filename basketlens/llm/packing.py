"""Best-fit packing of documents into sequences under several capacities.

A sequence has three capacities: tokens, documents and attention cost (the sum
of squared piece lengths). A piece's demand on each follows from its length
alone, so the choice of bins needs only the histogram of piece lengths, which
has at most ``sequence_tokens`` rows however large the corpus is. Best fit runs
over that histogram, longest pieces first, on ranges of bins in the same state;
it yields steps "the pieces of length s ranked [a, b) go to the bins [c, c + b - a)
at offset o". Every task then looks up its own pieces' steps. The texts, the
token ids and the pieces stay where they are.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlens.llm.common import written
from basketlens.llm.encoding import encoder

#: Texts encoded at a time within a task.
TEXTS_AT_ONCE = 512


@dataclass(frozen=True)
class Capacity:
    """What one sequence holds, and how bins are ranked.

    ``rule`` 'norm' takes the bin whose residual after the piece has the smallest
    weighted squared norm, 'dot' the one with the largest weighted dot product of
    residual and demand; each dimension is a share of its capacity. The default
    document and attention capacities never bind before the tokens do.
    """

    tokens: int = 2048
    documents: int = 2048
    attention: int = 2048 * 2048
    weights: tuple[float, float, float] = (1.0, 0.0, 0.0)
    rule: str = "norm"


def plan_bins(histogram: dict[int, int], cap: Capacity) -> np.ndarray:
    """Steps (length, rank from, rank to, first bin, offset) of vector best fit."""
    if any(n > cap.tokens or n * n > cap.attention or n < 1 for n in histogram) or (histogram and cap.documents < 1):
        raise ValueError("a single piece exceeds the capacity of a sequence")
    full = np.array([cap.tokens, cap.documents, cap.attention], np.float64)
    weights = np.array(cap.weights, np.float64)
    free = np.zeros((0, 3), np.int64)  # what is left in each bin of a range
    bins = np.zeros((0, 2), np.int64)  # first bin and number of bins of a range
    steps, next_bin = [], 0
    shortest = min(histogram, default=0)
    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        item = np.array([length, 1, length * length], np.int64)
        alive = (free >= [shortest, 1, shortest * shortest]).all(axis=1)
        free, bins = free[alive], bins[alive]
        while left:
            fits = np.flatnonzero((free >= item).all(axis=1))
            if len(fits):
                if cap.rule == "norm":
                    score = ((free[fits] - item) / full) ** 2 @ weights
                else:
                    score = -((free[fits] / full) * (item / full)) @ weights
                at = fits[int(score.argmin())]
                room, (first, count) = free[at].copy(), bins[at].tolist()
            else:
                at, room, first, count = -1, full.astype(np.int64), next_bin, left
            each = int((room // item).min()) if cap.rule == "norm" else 1
            each = min(each, left)
            used = min(count, left // each)
            for j in range(each):
                steps.append((length, rank, rank + used, first, cap.tokens - room[0] + j * length))
                rank += used
            left -= used * each
            if at < 0:
                next_bin += used
            elif used < count:
                bins[at] = (first + used, count - used)
            else:
                free, bins = np.delete(free, at, 0), np.delete(bins, at, 0)
            free = np.vstack([free, room - item * each])
            bins = np.vstack([bins, [first, used]])
    return np.array(steps, np.int64).reshape(-1, 5)


def cut_pieces(docs: DataFrame, tokenizer: str, sequence_tokens: int, end_id: int, with_ids: bool) -> DataFrame:
    """Token pieces of every text, with the task and the rank among its pieces of that length."""
    kind = docs.schema["doc_id"].dataType
    schema = T.StructType([
        T.StructField("doc_id", kind), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()), T.StructField("part", T.IntegerType()),
        T.StructField("place", T.LongType()), *([T.StructField("ids", T.BinaryType())] if with_ids else [])])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = encoder(tokenizer), np.array([end_id], "<u4").tobytes()
        part, placed, width = TaskContext.get().partitionId(), np.zeros(sequence_tokens + 1, np.int64), 4 * sequence_tokens
        for whole in batches:
            for at in range(0, whole.num_rows, TEXTS_AT_ONCE):
                batch = whole.slice(at, TEXTS_AT_ONCE)
                rows: list[tuple] = []
                source: list[int] = []
                for i, ids in enumerate(enc.encode([t or "" for t in batch.column(1).to_pylist()])):
                    ids += end
                    for k, a in enumerate(range(0, len(ids), width)):
                        piece = ids[a:a + width]
                        n = len(piece) // 4
                        rows.append((k, a // 4, n, zlib.crc32(piece), part, int(placed[n]), piece))
                        source.append(i)
                        placed[n] += 1
                columns = list(zip(*rows, strict=True))[:6 + with_ids]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(source, pa.int64())), pa.array(columns[0], pa.int32()), *[pa.array(c, pa.int64()) for c in columns[1:4]],
                     pa.array(columns[4], pa.int32()), pa.array(columns[5], pa.int64()), *[pa.array(c, pa.binary()) for c in columns[6:]]],
                    names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(cut, schema)


def pack(docs: DataFrame, tokenizer: str, capacity: Capacity = Capacity(), end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """Pack the texts of ``docs`` into as few sequences as best fit finds.

    A document's ids are those of ``tokenizer`` (a file that every executor has
    at the same path) without special tokens, then ``end_id``. Only documents
    longer than a sequence are cut, into pieces of the full length; the last one
    may be shorter. One row per piece: doc_id, piece, start (ids of the document
    before it), length, ids_crc32, sequence_id, offset, and ``ids`` (little-endian
    unsigned 32-bit integers) if asked for. Sequence numbers run from 0.

    A NULL or empty text is its end id alone. Repeated rows and rows with a NULL
    doc_id are documents of their own. Only doc_id and text are read, so other
    columns cannot clash. An empty table gives no rows. The pieces are written to
    the shared folder once, which fixes their ranks; the driver sees only the
    histogram of lengths.
    """
    pieces = written(cut_pieces(docs, tokenizer, capacity.tokens, end_id, with_ids), "pieces")
    by_part = written(pieces.groupBy("part", "length").agg(F.count("*").alias("n")), "lengths")
    histogram = {r["length"]: r["n"] for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    steps = plan_bins(histogram, capacity)
    order = np.lexsort((steps[:, 1], steps[:, 0]))
    steps = steps[order]
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_part.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    ranked = pieces.join(offsets, ["part", "length"])
    # (length, rank) as one number that grows with both, to find the step by bisection
    span = max(histogram.values(), default=0) + 1
    keys = steps[:, 0] * span + steps[:, 1]

    @F.pandas_udf("sequence_id long, offset long")
    def placed(length, rank):
        import pandas as pd

        at = np.searchsorted(keys, length.to_numpy() * span + rank.to_numpy(), side="right") - 1
        return pd.DataFrame({"sequence_id": steps[at, 3] + rank.to_numpy() - steps[at, 1], "offset": steps[at, 4]})

    return (ranked.withColumn("__bin", placed("length", F.col("before") + F.col("place")))
            .select("doc_id", "piece", "start", "length", "ids_crc32", "__bin.sequence_id", "__bin.offset", *(["ids"] if with_ids else [])))
