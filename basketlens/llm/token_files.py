"""Token-id files: canonical length-limited Huffman coding with block checkpoints.

A file set is a folder with two Parquet tables.

``code``: (id, bits), the code length of every id that occurs. Lengths come from
package-merge over the counts of the whole corpus; codes are canonical: by length,
then by id. So the lengths are all a reader needs.

``blocks``, in folders ``part=N`` that ascend with doc_id: (block, start, doc_ids,
doc_tokens, offsets, payload). A block holds whole documents in ascending order
and decodes by itself. ``start`` counts the ids of all documents before it,
``offsets`` has the bit offset of every CHECKPOINT-th id, ``payload`` the code bits,
high bit first.

A decoder follows all checkpoints of a batch of blocks at once, one table look-up
per id and step.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.llm.common import shared_folder, written
from basketlens.llm.encoding import encoder

#: Ids after which a block is closed, ids between two checkpoints, longest code.
BLOCK_IDS = 65_536
CHECKPOINT = 256
LONGEST_CODE = 18
#: Texts encoded at a time within a task; blocks decoded at a time.
TEXTS_AT_ONCE = 1024
BLOCKS_AT_ONCE = 16


def code_lengths(counts: np.ndarray, longest: int = LONGEST_CODE) -> np.ndarray:
    """Package-merge: optimal code lengths of at most ``longest`` bits; 0 for ids that don't occur."""
    out = np.zeros(len(counts), np.uint8)
    ids = np.flatnonzero(counts)
    if len(ids) < 2:
        out[ids] = 1
        return out
    longest = max(longest, int(len(ids) - 1).bit_length())
    if longest > 24:
        raise ValueError("too many ids for 24-bit codes")
    order = ids[np.argsort(counts[ids], kind="stable")]
    weights = counts[order].astype(np.float64)
    leaves, packages = [], np.zeros(0)
    for _ in range(longest):
        merged = np.concatenate([weights, packages])
        rank = np.argsort(merged, kind="stable")
        leaves.append(np.concatenate([[0], np.cumsum(rank < len(weights))]))
        merged = merged[rank]
        packages = merged[:len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
    lengths, take = np.zeros(len(order), np.int64), 2 * len(order) - 2
    for level in reversed(leaves):
        lengths[:level[take]] += 1
        take = 2 * (take - int(level[take]))
    out[order] = lengths
    return out


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes by length, then by id."""
    codes = np.zeros(len(lengths), np.uint64)
    ids = np.flatnonzero(lengths)
    ids = ids[np.argsort(lengths[ids], kind="stable")]
    code, bits = 0, 0
    for i in ids.tolist():
        code <<= int(lengths[i]) - bits
        bits = int(lengths[i])
        codes[i] = code
        code += 1
    return codes


def encode_ids(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, bytes]:
    """Bit offsets of every CHECKPOINT-th id, and the code bits."""
    bits = lengths[ids].astype(np.int64)
    end = np.cumsum(bits)
    begin = end - bits
    if not len(ids):
        return begin, b""
    # a code of at most 24 bits lies in one or two words of 32; words ascend, so each is one run of sums
    word = begin >> 5
    value = codes[ids] << (64 - (begin & 31) - bits).astype(np.uint64)
    starts = np.concatenate([[0], np.flatnonzero(word[1:] != word[:-1]) + 1])
    out = np.zeros(int(word[-1]) + 2, np.uint64)
    out[word[starts]] = np.add.reduceat(value >> np.uint64(32), starts)
    out[word[starts] + 1] += np.add.reduceat(value & np.uint64(0xFFFFFFFF), starts)
    return begin[::CHECKPOINT], out.astype(">u4").tobytes()[:int(end[-1] + 7) >> 3]


class Decoder:
    """Look-up tables over the next bits: the id and the length of its code."""

    def __init__(self, lengths: np.ndarray):
        self.width = max(1, int(lengths.max(initial=0)))
        self.ids = np.zeros(1 << self.width, np.uint32)
        self.bits = np.ones(1 << self.width, np.uint8)  # small tables stay in the CPU's cache
        codes = canonical_codes(lengths)
        present = np.flatnonzero(lengths)
        present = present[np.argsort(lengths[present], kind="stable")]
        if len(present):
            spans = np.int64(1) << (self.width - lengths[present].astype(np.int64))
            first = codes[present].astype(np.int64) << (self.width - lengths[present].astype(np.int64))
            covered = int(first[-1] + spans[-1])
            self.ids[:covered] = np.repeat(present, spans)
            self.bits[:covered] = np.repeat(lengths[present], spans)

    def decode(self, payloads: list[bytes], offsets: list[np.ndarray], counts: list[int]) -> list[np.ndarray]:
        """The ids of each block; every checkpoint is a lane, all lanes step together."""
        base = np.cumsum([0] + [len(p) + 4 for p in payloads])
        data = np.frombuffer(b"".join(p + b"\0\0\0\0" for p in payloads) + b"\0\0\0\0", np.uint8).astype(np.uint32)
        window = (data[:-3] << 24) | (data[1:-2] << 16) | (data[2:-1] << 8) | data[3:]
        pos = np.concatenate([o.astype(np.int64) + 8 * b for o, b in zip(offsets, base, strict=False)]) if payloads else np.zeros(0, np.int64)
        size = np.concatenate([np.minimum(CHECKPOINT, n - CHECKPOINT * np.arange(len(o))) for o, n in zip(offsets, counts, strict=True)]) if payloads else np.zeros(0, np.int64)
        order = np.argsort(-size, kind="stable")
        pos, lanes = pos[order], len(order)
        out = np.zeros((CHECKPOINT, len(order)), np.uint32)  # a step writes one row
        sizes = size[order]
        for step in range(int(sizes[0]) if lanes else 0):
            while sizes[lanes - 1] <= step:
                lanes -= 1
            now = pos[:lanes]
            look = ((window[now >> 3] << (now & 7).astype(np.uint32)) >> np.uint32(32 - self.width))
            out[step, :lanes] = self.ids[look]
            pos[:lanes] += self.bits[look]
        placed = np.empty((len(order), CHECKPOINT), np.uint32)
        placed[order] = out.T
        flat, result, at = placed, [], 0
        for o, n in zip(offsets, counts, strict=True):
            result.append(flat[at:at + len(o)].reshape(-1)[:n])
            at += len(o)
        return result


def _token_blocks(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Blocks of ids in ascending doc_id order, numbered within their part, and for each
    part a row without block that has the counts of its ids."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = (docs.select("doc_id", "text", F.xxhash64("text").alias("h"))
               .repartitionByRange(partitions, "doc_id", "h").sortWithinPartitions("doc_id", "h").select("doc_id", "text"))
    schema = f"part int, block bigint, before bigint, n_ids bigint, doc_ids array<{kind}>, doc_tokens array<bigint>, ids binary, found array<bigint>, times array<bigint>"

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = encoder(tokenizer), np.array([end_id], "<u4").tobytes()
        part, number, before, size = TaskContext.get().partitionId(), 0, 0, 0
        keys: list = []
        held: list[bytes] = []
        total, longs = np.zeros(0, np.int64), pa.list_(pa.int64())

        def row(block, n, keys, sizes, ids, found, times) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([block], pa.int64()), pa.array([before], pa.int64()), pa.array([n], pa.int64()), pa.array([keys], pa.list_(key_type)),
                 pa.array([sizes], longs), pa.array([ids], pa.binary()), pa.array([found], longs), pa.array([times], longs)],
                names=["part", "block", "before", "n_ids", "doc_ids", "doc_tokens", "ids", "found", "times"])

        def block() -> pa.RecordBatch:
            nonlocal total
            ids = np.frombuffer(b"".join(held), "<u4")
            found = np.bincount(ids)
            total, found = (total, found) if len(total) >= len(found) else (found, total)
            total[:len(found)] += found
            return row(number, len(ids), keys, [len(x) // 4 for x in held], _narrow(ids), None, None)

        for whole in batches:
            key_type = whole.schema.field(0).type
            for at in range(0, whole.num_rows, TEXTS_AT_ONCE):
                batch = whole.slice(at, TEXTS_AT_ONCE)
                encoded = enc.encode([t or "" for t in batch.column(1).to_pylist()])
                for key, ids in zip(batch.column(0).to_pylist(), encoded, strict=True):
                    keys.append(key)
                    held.append(ids + end)
                    size += len(ids) // 4 + 1
                    if size >= BLOCK_IDS:
                        yield block()
                        number, before, size = number + 1, before + size, 0
                        keys, held = [], []
        if held:
            yield block()
        if total.any():
            ids = np.flatnonzero(total)
            yield row(None, 0, None, None, None, ids, total[ids])

    return ordered.mapInArrow(blocks, schema)


def _narrow(ids: np.ndarray) -> bytes:
    """Ids in two bytes each if all fit, else in four."""
    return ids.astype("<u2").tobytes() if int(ids.max(initial=0)) < 1 << 16 else ids.tobytes()


def _ids(packed: bytes, n: int) -> np.ndarray:
    return np.frombuffer(packed, "<u2" if len(packed) == 2 * n else "<u4").astype(np.int64)


def write_token_files(docs: DataFrame, tokenizer: str, folder: str, end_id: int = 0) -> None:
    """Encode every text, append ``end_id``, and write the file set to ``folder``.

    Documents ascend by doc_id (NULL first); repeated ids by a hash of their text.
    A NULL or empty text is its end id alone. Only doc_id and text are read. The
    encoded blocks are kept in the shared folder between counting and coding; ids are
    counted as they are made. The driver sees the counts of ids and of parts only; both
    are bounded, by the vocabulary and by spark.sql.shuffle.partitions.
    """
    spark = docs.sparkSession
    kept = written(_token_blocks(docs, tokenizer, end_id), "token_blocks")
    blocks = kept.where("block IS NOT NULL").drop("found", "times")
    totals = (kept.where("block IS NULL").select(F.explode(F.arrays_zip("found", "times")).alias("z"))
              .groupBy(F.col("z.found").alias("id")).agg(F.sum("z.times").alias("n")).collect())
    counts = np.zeros(max((r["id"] for r in totals), default=-1) + 1, np.int64)
    for r in totals:
        counts[r["id"]] = r["n"]
    lengths = code_lengths(counts)
    codes = canonical_codes(lengths)
    sizes = {r["part"]: r["n"] for r in blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()}
    first = dict(zip(sorted(sizes), np.cumsum([0] + [sizes[p] for p in sorted(sizes)])[:-1].tolist(), strict=True))
    rows = [(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)]
    spark.createDataFrame(rows, "id bigint, bits int").coalesce(1).write.parquet(f"{folder}/code")
    kind = blocks.schema["doc_ids"].dataType.simpleString()

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(whole.num_rows):
                row = whole.slice(i, 1)
                part, before, n, packed = (row.column(k)[0].as_py() for k in (0, 2, 3, 6))
                offsets, payload = encode_ids(_ids(packed, n), lengths, codes)
                yield pa.RecordBatch.from_arrays(
                    [row.column(0), row.column(1), pa.array([first[part] + before], pa.int64()), row.column(4), row.column(5),
                     pa.array([offsets.tolist()], pa.list_(pa.int64())), pa.array([payload], pa.binary())],
                    names=["part", "block", "start", "doc_ids", "doc_tokens", "offsets", "payload"])

    schema = f"part int, block bigint, start bigint, doc_ids {kind}, doc_tokens array<bigint>, offsets array<bigint>, payload binary"
    blocks.mapInArrow(coded, schema).write.partitionBy("part").parquet(f"{folder}/blocks")


def read_token_files(spark: SparkSession, folder: str, key: str = "bigint", with_ids: bool = False) -> DataFrame:
    """The documents of a file set: doc_id, start, n_tokens, ids_crc32, and ``ids``
    (little-endian unsigned 32-bit integers) if asked for. ``key`` is doc_id's type."""
    code = spark.read.parquet(f"{folder}/code").collect()
    lengths = np.zeros(max((r["id"] for r in code), default=-1) + 1, np.uint8)
    for r in code:
        lengths[r["id"]] = r["bits"]
    schema = f"block bigint, start bigint, doc_ids array<{key}>, doc_tokens array<bigint>, offsets array<bigint>, payload binary, part int"
    blocks = spark.read.schema(schema).parquet(f"{folder}/blocks")

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(lengths)
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCKS_AT_ONCE):
                batch = whole.slice(at, BLOCKS_AT_ONCE)
                sizes = [np.array(x.as_py(), np.int64) for x in batch.column(2)]
                texts = decoder.decode([x.as_py() for x in batch.column(4)], [np.array(x.as_py(), np.int64) for x in batch.column(3)], [int(x.sum()) for x in sizes])
                starts, crcs, raws = [], [], []
                for start, size, ids in zip(batch.column(0).to_pylist(), sizes, texts, strict=True):
                    ends = np.cumsum(size)
                    raw = np.ascontiguousarray(ids, "<u4").tobytes()
                    for a, b in zip((ends - size).tolist(), ends.tolist(), strict=True):
                        starts.append(start + a)
                        crcs.append(zlib.crc32(raw[4 * a:4 * b]))
                        raws += [raw[4 * a:4 * b]] * with_ids
                keys = batch.column(1).flatten()
                yield pa.RecordBatch.from_arrays(
                    [keys, pa.array(starts, pa.int64()), pa.array(np.concatenate(sizes), pa.int64()), pa.array(crcs, pa.int64()), *[pa.array(raws, pa.binary())] * with_ids],
                    names=["doc_id", "start", "n_tokens", "ids_crc32", *["ids"] * with_ids])

    return blocks.select("start", "doc_ids", "doc_tokens", "offsets", "payload").mapInArrow(
        decoded, f"doc_id {key}, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids binary" * with_ids)


def token_files(docs: DataFrame, tokenizer: str, end_id: int = 0) -> DataFrame:
    """Write the file set to a fresh place in the shared folder and read it back."""
    folder = f"{shared_folder(docs.sparkSession)}/token_files"
    write_token_files(docs, tokenizer, folder, end_id)
    return read_token_files(docs.sparkSession, folder, docs.schema["doc_id"].dataType.simpleString())
