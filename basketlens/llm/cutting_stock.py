"""Packing of token ids into padded sequences as a cutting-stock problem.

A sequence is padded to ``sequence_tokens`` unless its length is a power of two, so
powers of two are the stock lengths and their length is their cost. Pieces are whole
documents, or full sequences' worth of longer ones. Their length histogram, in
classes of GRAIN tokens, gives the demands of a linear program over patterns (how
many pieces of each class share a sequence). It is solved by column generation: a
knapsack dynamic program over the classes prices all stock lengths at once. Rounded
patterns take the pieces of a class by rank, so every place follows from a piece's
length and its rank among the pieces of that length.

Pieces of one class differ by less than GRAIN tokens, so sequences are left with
small gaps. A few of the longest pieces, as many tokens as the gaps hold, are kept
out of the program and cut to fill them exactly; what is left of these fills
sequences of its own, the last ones by the binary digits of the rest.

The driver sees the histogram, at most ``sequence_tokens`` rows however large the
corpus is, and the plan made from it; texts, ids and pieces stay in the tasks.
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

#: Tokens by which the lengths of a class differ at most.
GRAIN = 32
#: Texts encoded at a time within a task.
TEXTS_AT_ONCE = 512
#: The linear program stops when its bound shows the cost to be this close to the optimum.
CLOSE = 1e-6
#: Columns generated at most; the plan is whole after any number of them.
COLUMNS = 4000


@dataclass(frozen=True)
class Plan:
    """Where pieces go. ``whole``: (length, rank from, rank to, first sequence, offset),
    by length and rank: ranks [from, to) go to consecutive sequences. Pieces longer than
    ``fill_length``, and of that length from rank ``fill_rank`` on, are cut: end to end,
    longest first, they cover ``gaps``: (first token, tokens of a gap, first sequence,
    gaps, offset), runs of equal gaps in consecutive sequences, in order of first token.
    ``fill_start`` has the first token of each length's cut pieces."""

    whole: np.ndarray
    gaps: np.ndarray
    fill_length: int
    fill_rank: int
    fill_start: dict[int, int]
    sequences: int


def best_patterns(value: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """Unbounded knapsack: the largest value that fits into each room up to ``room``
    (class k takes k + 1 units), and the class taken last, -1 for none."""
    best, last = np.zeros(room + 1), np.full(room + 1, -1)
    for r in range(1, room + 1):
        gain = best[r - 1::-1][:len(value)] + value[:r]
        k = int(gain.argmax())
        best[r], last[r] = (gain[k], k) if gain[k] > best[r - 1] + 1e-15 else (best[r - 1], -1)
    return best, last


def solve_relaxed(demand: np.ndarray, stock: list[int]) -> tuple[np.ndarray, np.ndarray, float]:
    """Cheapest fractional use of patterns that covers ``demand`` (pieces of class k,
    k + 1 units long), by column generation over the primal simplex method. Returns
    (patterns, one row each; use; cost). A pattern costs the least stock that holds it."""
    room, classes = max(stock), np.flatnonzero(demand)
    need, sizes, m = demand[classes].astype(float), classes + 1, len(classes)
    scale = need.sum()
    need = need / scale

    def cost(pattern: np.ndarray) -> float:
        return float(min(w for w in stock if w >= pattern @ sizes))

    columns = np.diag(room // sizes).astype(float)
    costs = np.array([cost(c) for c in columns])
    for _ in range(COLUMNS):
        inverse = np.linalg.inv(columns.T)
        use = np.maximum(inverse @ need, 0)
        duals = costs @ inverse
        worth = np.zeros(room)
        worth[classes] = duals
        best, last = best_patterns(np.maximum(worth, 0), room)
        ratio, width = max((best[w] / w, w) for w in stock)
        if duals.min() < -1e-12:  # a class that is covered too often: let its pieces be fewer
            entering, price = -np.eye(m)[int(duals.argmin())], 0.0
        elif ratio <= 1 + CLOSE:  # Farley's bound: the optimum is at least cost / ratio
            break
        else:
            entering, r = np.zeros(room), width
            while r > 0:
                if last[r] < 0:
                    r -= 1
                else:
                    entering[last[r]] += 1
                    r -= last[r] + 1
            entering, price = entering[classes], float(width)
        direction = inverse @ entering
        down = direction > 1e-11
        if not down.any():
            break
        steps = np.full(m, np.inf)
        steps[down] = use[down] / direction[down]
        # among ties the largest pivot, for a well-conditioned basis
        out = int(np.where(steps <= steps.min() + 1e-15, direction, -np.inf).argmax())
        columns[out], costs[out] = entering, price
    use = np.maximum(np.linalg.solve(columns.T, need), 0) * scale
    patterns = np.zeros((m, room), np.int64)
    patterns[:, classes] = np.round(columns)
    real = costs > 0
    return patterns[real], use[real], float(costs @ use)


def rounded(demand: np.ndarray, stock: list[int]) -> list[tuple[np.ndarray, int]]:
    """(pattern, times) that cover ``demand`` exactly: the linear program's patterns,
    rounded down, then patterns filled from the largest class down for what is left."""
    left, room, out = demand.copy(), max(stock), []
    if left.any():
        patterns, use, _ = solve_relaxed(demand, stock)
        for pattern, times in sorted(zip(patterns, use, strict=True), key=lambda p: -p[1]):
            used = pattern > 0
            times = int(min(times + 1e-6, (left[used] // pattern[used]).min()))
            if times:
                out.append((pattern, times))
                left = left - pattern * times
    while left.any():
        pattern, free = np.zeros(room, np.int64), room
        for k in np.flatnonzero(left)[::-1]:
            pattern[k] = min(left[k], free // (k + 1))
            free -= pattern[k] * (k + 1)
        used = pattern > 0
        times = int((left[used] // pattern[used]).min())
        out.append((pattern, times))
        left = left - pattern * times
    return out


def _laid_out(histogram: dict[int, int], patterns: list[tuple[np.ndarray, int]], stock: list[int], grain: int) -> tuple[list, list, int]:
    """Steps of whole pieces, runs of gaps (tokens, first sequence, gaps, offset), sequences."""
    lengths = sorted(histogram)
    by_class: dict[int, list[list[int]]] = {}
    for n in lengths:  # the pieces of a class by length: [length, rank from, rank to] still to place
        by_class.setdefault(-(-n // grain) - 1, []).append([n, 0, histogram[n]])
    whole, gaps, sequence = [], [], 0
    for pattern, times in patterns:
        slots = [k for k in np.flatnonzero(pattern).tolist()[::-1] for _ in range(int(pattern[k]))]
        width = min(w for w in stock if w >= sum(k + 1 for k in slots)) * grain
        taken = []  # for every slot the runs of lengths that fill it over the ``times`` sequences
        for k in slots:
            runs, want = [], times
            while want:
                run = by_class[k][0]
                some = min(want, run[2] - run[1])
                runs.append((times - want, run[0], run[1], some))
                run[1] += some
                want -= some
                if run[1] == run[2]:
                    by_class[k].pop(0)
            taken.append(runs)
        cuts = sorted({at for runs in taken for at, *_ in runs} | {times})
        offsets = dict.fromkeys(cuts[:-1], 0)
        for runs in taken:
            place = 0
            for a, b in zip(cuts, cuts[1:], strict=False):
                while place + 1 < len(runs) and runs[place + 1][0] <= a:
                    place += 1
                at, n, rank, _ = runs[place]
                whole.append((n, rank + a - at, rank + b - at, sequence + a, offsets[a]))
                offsets[a] += n
        gaps += [(width - offsets[a], sequence + a, b - a, offsets[a]) for a, b in zip(cuts, cuts[1:], strict=False) if width > offsets[a]]
        sequence += times
    return whole, gaps, sequence


def make_plan(histogram: dict[int, int], sequence_tokens: int = 4096, grain: int = GRAIN) -> Plan:
    """The plan for a histogram of piece lengths (at most ``sequence_tokens``, a power of two)."""
    if sequence_tokens & (sequence_tokens - 1) or sequence_tokens < 1:
        raise ValueError("sequence_tokens must be a power of two")
    grain = min(grain, sequence_tokens)
    room = sequence_tokens // grain
    stock = [1 << k for k in range(room.bit_length())]
    total = sum(n * c for n, c in histogram.items())
    wanted = sum((-n % grain) * c for n, c in histogram.items())
    while True:
        left, rest, fill = dict(histogram), wanted, {}
        for n in sorted(histogram, reverse=True):
            some = min(histogram[n], -(-rest // n)) if rest > 0 else 0
            if some:
                fill[n], left[n], rest = some, histogram[n] - some, rest - some * n
        left = {n: c for n, c in left.items() if c}
        demand = np.zeros(room, np.int64)
        for n, c in left.items():
            demand[-(-n // grain) - 1] += c
        whole, gaps, sequences = _laid_out(left, rounded(demand, stock), stock, grain)
        short = sum(g * c for g, _, c, _ in gaps) - sum(n * c for n, c in fill.items())
        if short <= 0 or not left:
            break
        wanted = min(total, sum(n * c for n, c in fill.items()) + short + short // 8)
    over = -short
    if over >= sequence_tokens:
        gaps.append((sequence_tokens, sequences, over // sequence_tokens, 0))
        sequences += over // sequence_tokens
    for k in range(sequence_tokens.bit_length() - 2, -1, -1):
        if over >> k & 1:
            gaps.append((1 << k, sequences, 1, 0))
            sequences += 1
    first, starts = 0, []
    for g, _, c, _ in gaps:
        starts.append(first)
        first += g * c
    fill_start, first = {}, 0
    for n in sorted(fill, reverse=True):
        fill_start[n] = first
        first += n * fill[n]
    least = min(fill, default=sequence_tokens + 1)
    steps = np.array(sorted(whole), np.int64).reshape(-1, 5)
    runs = np.array([(s, *g) for s, g in zip(starts, gaps, strict=True)], np.int64).reshape(-1, 5)
    return Plan(steps, runs, least, histogram.get(least, 0) - fill.get(least, 0), fill_start, sequences)


# --- pieces ---------------------------------------------------------------------

def encoded_pieces(docs: DataFrame, tokenizer: str, sequence_tokens: int, end_id: int) -> DataFrame:
    """Ids of every text and its end id in pieces of at most ``sequence_tokens``, with the
    task and the rank among the task's pieces of that length."""
    kind = docs.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("doc_id", kind), *[T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32", "doc_tokens", "place")],
                           T.StructField("part", T.IntegerType()), T.StructField("ids", T.BinaryType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = encoder(tokenizer), np.array([end_id], "<u4").tobytes()
        part, placed, width = TaskContext.get().partitionId(), np.zeros(sequence_tokens + 1, np.int64).tolist(), 4 * sequence_tokens
        for whole in batches:
            for at in range(0, whole.num_rows, TEXTS_AT_ONCE):
                batch = whole.slice(at, TEXTS_AT_ONCE)
                source, start, length, crc, tokens, place, pieces = [], [], [], [], [], [], []
                for i, ids in enumerate(enc.encode([t or "" for t in batch.column(1).to_pylist()])):
                    ids += end
                    for a in range(0, len(ids), width):
                        piece = ids[a:a + width]
                        n = len(piece) // 4
                        source.append(i)
                        start.append(a // 4)
                        length.append(n)
                        crc.append(zlib.crc32(piece))
                        tokens.append(len(ids) // 4)
                        place.append(placed[n])
                        pieces.append(piece)
                        placed[n] += 1
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(source, pa.int64())), *[pa.array(c, pa.int64()) for c in (start, length, crc, tokens, place)],
                     pa.array([part] * len(source), pa.int32()), pa.array(pieces, pa.binary())], names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(cut, schema)


def fragments(lengths: np.ndarray, ranks: np.ndarray, plan: Plan) -> tuple[np.ndarray, ...]:
    """Where pieces that are cut go: (which piece, first id in it, ids, sequence, offset)."""
    first = np.array([plan.fill_start[n] - (plan.fill_rank * n if n == plan.fill_length else 0) for n in lengths.tolist()], np.int64) + ranks * lengths
    end = first + lengths
    starts, sizes = plan.gaps[:, 0], plan.gaps[:, 1]
    out: list[list[np.ndarray]] = [[] for _ in range(5)]
    which, at = np.arange(len(first)), first
    while len(which):
        run = np.searchsorted(starts, at, side="right") - 1
        gap = (at - starts[run]) // sizes[run]
        begin = starts[run] + gap * sizes[run]
        to = np.minimum(begin + sizes[run], end[which])
        for column, values in zip(out, (which, at - first[which], to - at, plan.gaps[run, 2] + gap, plan.gaps[run, 4] + at - begin), strict=True):
            column.append(values)
        more = to < end[which]
        which, at = which[more], to[more]
    return tuple(np.concatenate(c) if c else np.zeros(0, np.int64) for c in out)


def pack(docs: DataFrame, tokenizer: str, sequence_tokens: int = 4096, end_id: int = 2, with_ids: bool = False, grain: int = GRAIN) -> DataFrame:
    """Pack the texts of ``docs`` into sequences with little padding.

    A document's ids are those of ``tokenizer`` (a file that every executor has at the
    same path) without special tokens, then ``end_id``. One row per piece: doc_id, start
    (ids of the document before it), length, ids_crc32, doc_tokens (ids of the document),
    sequence_id (from 0), offset, and ``ids`` (little-endian unsigned 32-bit integers) if
    asked for. Every sequence holds exactly ``sequence_tokens`` ids (a power of two) or a
    smaller power of two, so none is padded. Documents are cut where they are longer than
    a sequence, and a few of the longest to fill gaps.

    A NULL or empty text is its end id alone; a very long one is encoded whole and cut.
    Repeated rows, and rows with a NULL doc_id, are documents of their own; equal lengths
    are ranked by the place of their rows. Only doc_id and text are read, so other columns
    can't clash. An empty table gives no rows. The pieces are written to the shared folder
    once, which fixes their ranks.
    """
    pieces = written(encoded_pieces(docs, tokenizer, sequence_tokens, end_id), "stock")
    by_part = written(pieces.groupBy("part", "length").agg(F.count("*").alias("n")), "lengths")
    plan = make_plan({r["length"]: r["n"] for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}, sequence_tokens, grain)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_part.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    # (length, rank) as one number that grows with both, to find the step by bisection
    span = int(plan.whole[:, 2].max(initial=0)) + 1
    keys = plan.whole[:, 0] * span + plan.whole[:, 1]

    def ranked(wanted) -> DataFrame:
        return pieces.where(wanted).join(offsets, ["part", "length"]).withColumn("rank", F.col("before") + F.col("place"))

    @F.pandas_udf("sequence_id long, offset long")
    def placed(length, rank):
        import pandas as pd

        at = np.searchsorted(keys, length.to_numpy() * span + rank.to_numpy(), side="right") - 1
        return pd.DataFrame({"sequence_id": plan.whole[at, 3] + rank.to_numpy() - plan.whole[at, 1], "offset": plan.whole[at, 4]})

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *(["ids"] if with_ids else [])]
    length, rank = F.col("length"), F.col("rank")
    whole = (ranked(length <= plan.fill_length).where((length < plan.fill_length) | (rank < plan.fill_rank))
             .withColumn("__at", placed("length", "rank")).select(*names[:5], "__at.sequence_id", "__at.offset", *names[7:]))
    schema = T.StructType([whole.schema["doc_id"], *[T.StructField(c, T.LongType()) for c in names[1:7]], *([T.StructField("ids", T.BinaryType())] if with_ids else [])])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start, lengths, tokens, ranks = (np.asarray(batch.column(c)) for c in (1, 2, 3, 4))
            which, at, size, sequence, offset = fragments(lengths, ranks, plan)
            ids = batch.column(5).to_pylist()
            some = [ids[i][4 * a:4 * (a + n)] for i, a, n in zip(which.tolist(), at.tolist(), size.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(which)), pa.array(start[which] + at), pa.array(size), pa.array([zlib.crc32(x) for x in some], pa.int64()),
                 pa.array(tokens[which]), pa.array(sequence), pa.array(offset), *([pa.array(some, pa.binary())] if with_ids else [])], names=names)

    filling = ranked(length >= plan.fill_length).where((length > plan.fill_length) | (rank >= plan.fill_rank))
    return whole.union(filling.select("doc_id", "start", "length", "doc_tokens", "rank", "ids").mapInArrow(cut, schema))
