"""MinHash near-dedup: circulant MinHash, banding, exact Jaccard confirmation.

A document's set is its distinct word shingles, as 64-bit hashes. Two
permutations of UNIVERSE places make the whole signature: sigma moves each shingle
to a place p, and coordinate k is the smallest pi[p + k] over the set, that is, pi
shifted circularly by k. All coordinates of a shingle are one contiguous slice of
pi. BANDS bands of ROWS coordinates make buckets; a pair with Jaccard similarity
0.75 shares none with probability (1 - 0.75^ROWS)^BANDS, about 1e-6.

Documents with equal sets are one class, so buckets hold different sets only. No
bucket emits all its pairs:

1. every class is compared with the member it shares most buckets with among the
   smallest members of its buckets;
2. confirmed links are joined into components;
3. buckets whose members lie in one component are done. In the others, tasks look
   for pairs from different components whose signatures agree in enough coordinates,
   each pair only in the first band that it shares, confirm them on the full sets and
   return the links that join components. Large buckets are split into blocks, and
   tasks hold two blocks.

A pair inside one component needs no comparison: it cannot change the result.
Every link is confirmed on the full sets.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.llm.common import worker_cache, written
from basketlens.llm.components import components

SHINGLE_WORDS = 5
#: Linked when 100 * intersection >= PERCENT * union.
PERCENT = 75
BANDS, ROWS = 36, 4
COORDINATES = BANDS * ROWS
UNIVERSE = 1 << 20
SEED = 20_240_117
#: Coordinates that must agree before sets are compared in step 3; a pair with
#: similarity 0.75 falls below with probability 3e-7 (binomial, 144 trials).
AGREE = 82
#: Members and shingles of a block of a large bucket, on average.
BLOCK_ROWS = 1024
BLOCK_SHINGLES = 1_000_000
#: Shingles whose signature slices are held at once.
SHINGLES_AT_ONCE = 4096
#: Sets of hubs that a worker remembers while confirming.
SETS_KEPT = 64

def _permutations() -> tuple[np.ndarray, np.ndarray]:
    """sigma, and pi as a view whose row p holds coordinates 0.. of place p."""
    tables = worker_cache("minhash")
    if SEED not in tables:
        rng = np.random.default_rng(SEED)
        sigma, pi = rng.permutation(UNIVERSE).astype(np.uint32), rng.permutation(UNIVERSE).astype(np.uint32)
        tables[SEED] = sigma, np.lib.stride_tricks.sliding_window_view(np.concatenate([pi, pi[:COORDINATES]]), COORDINATES)
    return tables[SEED]


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a whole text.

    A-Z are lower-cased; words are runs without ASCII white space. A text with
    fewer words than a shingle is one shingle, one without words has none.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    digest = xxhash.xxh3_64_intdigest
    hashes = np.array([digest(w) for w in words], np.uint64)
    size = min(SHINGLE_WORDS, len(words))
    count = len(words) - size + 1
    total = np.full(count, size, np.uint64)
    for k in range(size):
        total = (total ^ (total >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + hashes[k:k + count]
    total = (total ^ (total >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return np.unique(total ^ (total >> np.uint64(31)))


def similar(one: np.ndarray, two: np.ndarray) -> bool:
    """Whether two full sets reach the threshold."""
    if len(one) > len(two):
        one, two = two, one
    if 100 * len(one) < PERCENT * len(two) or not len(one):
        return False
    at = np.minimum(np.searchsorted(two, one), len(two) - 1)
    both = int(np.count_nonzero(two[at] == one))
    return 100 * both >= PERCENT * (len(one) + len(two) - both)


def signature(hashes: np.ndarray) -> np.ndarray:
    """All coordinates from sigma and the shifts of pi."""
    sigma, shifted = _permutations()
    out = np.full(COORDINATES, UNIVERSE, np.uint32)
    for at in range(0, len(hashes), SHINGLES_AT_ONCE):
        place = sigma[(hashes[at:at + SHINGLES_AT_ONCE] & np.uint64(UNIVERSE - 1)).astype(np.int64)]
        np.minimum(out, shifted[place].min(axis=0), out=out)
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    """One 64-bit bucket key for each band."""
    rows = sig.reshape(BANDS, ROWS).astype(np.uint64)
    key = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for k in range(ROWS):
        key = (key ^ (key >> np.uint64(30)) ^ rows[:, k]) * np.uint64(0xBF58476D1CE4E5B9)
    return (key ^ (key >> np.uint64(32))).view(np.int64)


def _sketches(docs: DataFrame) -> DataFrame:
    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                sizes, prints, bands, signs = [], [], [], []
                for text in batch.column(1):
                    hashes = shingle_set(text.as_py())
                    sizes.append(len(hashes))
                    if len(hashes):
                        sig = signature(hashes)
                        prints.append(xxhash.xxh3_128_digest(hashes.tobytes()))
                        bands.append(band_keys(sig))
                        signs.append(sig.astype(np.uint8).tobytes())
                    else:
                        prints.append(None)
                        bands.append(None)
                        signs.append(None)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(signs, pa.binary())],
                    names=["doc_id", "n_shingles", "set_hash", "bands", "signature"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        sketched, "doc_id bigint, n_shingles bigint, set_hash binary, bands array<bigint>, signature binary")


def _confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold."""
    with_b = pairs.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
    with_both = with_b.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: OrderedDict[str, np.ndarray] = OrderedDict()
        for batch in batches:
            linked = []
            for one, two in zip(batch.column(2), batch.column(3), strict=True):
                left, hub = shingle_set(one.as_py()), two.as_py()
                if hub not in known:
                    known[hub] = shingle_set(hub)
                    if len(known) > SETS_KEPT:
                        known.popitem(last=False)
                linked.append(similar(left, known[hub]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return with_both.select("a", "b", "text_a", "text_b").mapInArrow(check, "a bigint, b bigint").distinct()


class Bucket:
    """Rows of one task of a bucket, by set size, and the components they are in so far."""

    def __init__(self, group: pa.Table):
        rep, comp, n, side = (group.column(c).to_numpy() for c in ("rep", "component", "n", "side"))
        self.order = np.lexsort((rep, n))
        self.rep, self.label, self.n, self.side = rep[self.order], comp[self.order].copy(), n[self.order], side[self.order]
        self.sig = np.frombuffer(b"".join(group.column("signature").to_pylist()), np.uint8).reshape(len(rep), COORDINATES)[self.order]
        self.bands = np.array(group.column("bands").to_pylist(), np.int64)[self.order]
        self.band, self.across = group.column("band")[0].as_py(), group.column("i")[0].as_py() != group.column("j")[0].as_py()

    def __len__(self) -> int:
        return len(self.rep)

    def partners(self, x: int) -> np.ndarray:
        """Later rows that step 3 compares with row ``x``, likeliest first; none of its own component."""
        # sorted by size: partners end where the sizes differ too much
        part = slice(x + 1, int(np.searchsorted(self.n, self.n[x] * 100 // PERCENT, side="right")))
        may = (self.label[part] != self.label[x]) & (self.rep[part] != self.rep[x])
        if self.across:
            may &= self.side[part] != self.side[x]
        at = np.flatnonzero(may) + x + 1
        agree = np.count_nonzero(self.sig[at] == self.sig[x], axis=1)
        at, agree = at[agree >= AGREE], agree[agree >= AGREE]
        if len(at):
            first = (self.bands[at] == self.bands[x]).argmax(axis=1) == self.band
            at = at[first][np.argsort(-agree[first], kind="stable")]
        return at

    def join(self, x: int, y: int) -> None:
        low, high = sorted((self.label[x], self.label[y]))
        self.label[self.label == high] = low


def _by_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows come sorted by (bucket, i, j); one task's rows are held at a time."""
    held: list[pa.RecordBatch] = []
    now = None
    for batch in batches:
        keys = np.stack([batch.column(c).to_numpy() for c in ("bucket", "i", "j")], axis=1)
        edges = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
        for a, b in zip(edges, edges[1:], strict=False):
            if b > a:
                if held and tuple(keys[a]) != now:
                    yield pa.Table.from_batches(held)
                    held = []
                now = tuple(keys[a])
                held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def _in_tasks(rows: DataFrame) -> DataFrame:
    return rows.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")


def _links_across(members: DataFrame, classes: DataFrame, labels: DataFrame, texts: DataFrame) -> DataFrame:
    """Step 3: confirmed links (a, b) between components, enough to join them."""
    own = members.select("bucket", "band", "rep").join(labels.withColumnRenamed("id", "rep"), "rep", "left")
    own = own.withColumn("component", F.coalesce("component", "rep"))
    own = own.join(classes.select("rep", "n"), "rep")
    parts = F.greatest(F.ceil(F.count("*") / BLOCK_ROWS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int")
    undecided = (own.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), parts.alias("parts"))
                 .where("lo < hi").select("bucket", "parts"))
    rows = own.join(undecided, "bucket").withColumn("side", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int"))
    meets = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda o: F.struct(F.least("side", o).alias("i"), F.greatest("side", o).alias("j")))
    rows = rows.withColumn("meets", F.explode(meets)).select("bucket", "meets.i", "meets.j", "band", "side", "rep", "component")
    sketched = rows.join(classes.select("rep", "n", "signature", "bands"), "rep")  # n again: slim rows meet the sketches last
    columns = ["bucket", "i", "j", "band", "side", "rep", "component", "n", "signature", "bands"]

    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _by_task(batches):
            bucket = Bucket(group)
            needed = np.zeros(len(bucket), bool)
            for x in range(len(bucket) - 1):
                at = bucket.partners(x)
                needed[at] = True
                needed[x] |= len(at) > 0
            yield from group.take(pa.array(np.sort(bucket.order[needed]))).combine_chunks().to_batches()

    schema = sketched.select(*columns).schema
    needed = written(_in_tasks(sketched.select(*columns)).mapInArrow(wanted, schema), "needed")
    with_text = needed.join(texts.select(F.col("doc_id").alias("rep"), "text"), "rep").select(*columns, "text")

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _by_task(batches):
            bucket, texts_, sets = Bucket(group), group.column("text"), {}

            def shingles(x: int, bucket: Bucket = bucket, texts_: pa.ChunkedArray = texts_, sets: dict = sets) -> np.ndarray:
                if x not in sets:
                    sets[x] = shingle_set(texts_[int(bucket.order[x])].as_py())
                return sets[x]

            out = []
            for x in range(len(bucket) - 1):
                for y in bucket.partners(x).tolist():
                    if bucket.label[x] != bucket.label[y] and similar(shingles(x), shingles(y)):
                        out.append((int(bucket.rep[x]), int(bucket.rep[y])))
                        bucket.join(x, y)
                sets.pop(x, None)  # later rows are compared among themselves only
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in out], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return _in_tasks(with_text).mapInArrow(linked, "a bigint, b bigint")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Documents are linked when their shingle sets reach a Jaccard similarity of
    0.75; component_id is the smallest doc_id that links reach, and the document
    with that id is kept. Texts without words (also NULL) have no shingles and are
    linked with nothing. Rows with a NULL doc_id are linked with nothing either:
    their component_id is NULL and they are kept. Rows that share a doc_id are one
    document with several texts. Only doc_id and text are read.

    Memory: a class takes one sketch of fixed size; a pair under confirmation two
    texts; a task of step 3 two blocks, bounded by members and by shingles, of
    sketches and, for members with a candidate, texts and sets. A very long text is
    hashed as a whole and is a block of its own size. An empty table gives no rows.
    """
    sketches = written(_sketches(docs), "sketches")
    classes = written(
        sketches.where("set_hash is not null and doc_id is not null").groupBy("set_hash")
        .agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"), F.first("signature").alias("signature")), "classes")
    placed = classes.select("rep", F.posexplode("bands").alias("band", "bucket"))
    shared = placed.groupBy("bucket").agg(F.min("rep").alias("hub"), F.max("rep").alias("hi")).where("hub < hi").select("bucket", "hub")
    members = written(placed.join(shared, "bucket"), "members")
    ids = members.select(F.col("rep").alias("doc_id")).distinct()
    texts = written(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(ids, "doc_id", "left_semi"), "texts")

    pairs = (members.where("rep <> hub").groupBy("rep", "hub").agg(F.count("*").alias("n"))
             .groupBy("rep").agg(F.max_by("hub", F.struct("n", -F.col("hub"))).alias("hub")).select(F.col("hub").alias("a"), F.col("rep").alias("b")))
    links = written(_confirmed(pairs, texts), "links")
    labels = written(components(links), "labels")
    more = written(_links_across(members, classes, labels, texts), "more_links")
    if not more.isEmpty():
        links = links.unionByName(more)
        labels = written(components(links), "labels")
    # classes that share a doc_id are one document: each of its sets is joined with the smallest
    several = (sketches.where("doc_id is not null and set_hash is not null").groupBy("doc_id")
               .agg(F.min("set_hash").alias("least"), F.max("set_hash").alias("most")).where("least <> most").select("doc_id"))
    sets = sketches.select("doc_id", "set_hash").join(several, "doc_id").join(classes.select("set_hash", "rep"), "set_hash").select("doc_id", "rep").distinct()
    least = sets.groupBy("doc_id").agg(F.min("rep").alias("a"))
    same = written(sets.join(least, "doc_id").where("a <> rep").select("a", F.col("rep").alias("b")).distinct(), "same_document")
    if not same.isEmpty():
        labels = written(components(links.unionByName(same)), "labels")

    own = classes.select("set_hash", "rep").join(labels.withColumnRenamed("id", "rep"), "rep", "left")
    own = own.select("set_hash", F.coalesce("component", "rep").alias("component_id"))
    return (sketches.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("set_hash")).alias("set_hash")).join(own, "set_hash", "left")
            .withColumn("component_id", F.coalesce("component_id", "doc_id"))
            .select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept")))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each component of near duplicates, columns unchanged.

    A document goes with all its rows if one of its texts is linked with a smaller
    doc_id. Of the kept one's rows with equal shingle sets the one with the smallest
    text stays; its other texts stay too. Rows with a NULL doc_id stay.
    """
    kept = (near_duplicates(docs).where("doc_id is not null").groupBy("doc_id")
            .agg(F.bool_and("kept").alias("kept"), F.count("*").alias("copies")).where("kept").select(F.col("doc_id").alias("id"), "copies"))
    # the row as one column, so that its own column names can't clash
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("bigint").alias("key"))
    held = rows.join(kept, F.col("key") == F.col("id"))

    @F.pandas_udf("binary")
    def set_key(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: xxhash.xxh3_128_digest(shingle_set(t).tobytes()))

    text = F.coalesce(F.col("row.text"), F.lit(""))
    repeated = held.where("copies > 1").groupBy("id", set_key(text).alias("set")).agg(F.min_by("row", text).alias("row"))
    return held.where("copies = 1").select("row").unionByName(repeated.select("row")).unionByName(rows.where("key is null").select("row")).select("row.*")
