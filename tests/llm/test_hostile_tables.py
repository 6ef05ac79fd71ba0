"""Tables with clashing column names, and every path that splits a group into blocks."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from basketlens.llm import conversation_repair, cover_tree, cutting_stock, minhash, mixing, packing, queries, secrets_scan, token_counts, token_files, topk, toxicity, whitening
from test_llm_operators import brute_components, rows

#: Names that operators use inside, and names of their results.
INSIDE = ["__id", "__copies", "__key", "__kinds", "__row", "__text", "__spans", "__source", "__bin", "__whole", "__set", "__at", "row", "key", "id", "draws", "cdf", "rate", "chars",
          "copy", "shuffle_key", "spans", "copies", "kept", "set_hash", "bands", "bucket", "component_id", "score", "predicted", "held_out", "part", "length", "place", "ids", "at"]


def with_names(df, names=INSIDE):
    """``df`` with a text column of each name, as it is or with capitals."""
    have = {c.lower() for c in df.columns}
    return df.select("*", *[F.lit(f"my {n}").alias(n.upper() if i % 2 else n) for i, n in enumerate(names) if n.lower() not in have])


@pytest.fixture(scope="module")
def docs(spark):
    data = [(1, "one two three four five six seven", "a"), (2, "one two three four five six seven", "a"), (2, "token=abcdef12 again", "b"), (3, None, None), (None, "x", "a"), (4, "", "b")]
    return spark.createDataFrame(data, "doc_id long, text string, source string")


def as_set(df, *drop):
    return sorted(str(sorted(r.asDict().items())) for r in df.drop(*drop).collect())


DOCUMENT_OPERATORS = {
    "counts": lambda d: token_counts.count_tokens(d, queries.BYTE_BPE), "minhash": minhash.near_duplicates, "scan": secrets_scan.scan,
    "files": lambda d: token_files.token_files(d, queries.BYTE_BPE), "stock": lambda d: cutting_stock.pack(d, queries.WORD_BPE).drop("sequence_id", "offset"),
    "pack": lambda d: packing.pack(d, queries.WORD_BPE).drop("sequence_id", "offset")}


@pytest.mark.parametrize("name", sorted(DOCUMENT_OPERATORS))
def test_extra_columns_change_nothing(docs, name):
    operator = DOCUMENT_OPERATORS[name]
    assert as_set(operator(with_names(docs))) == as_set(operator(docs))


ROW_OPERATORS = {"drop": minhash.drop_near_duplicates, "mask": secrets_scan.mask_secrets, "mix": lambda d: mixing.mix(d, epochs=3.0)}


@pytest.mark.parametrize("name", sorted(ROW_OPERATORS))
def test_rows_keep_columns_with_clashing_names(docs, name):
    operator = ROW_OPERATORS[name]
    wide, plain = operator(with_names(docs)), operator(docs)
    own = [c for c in with_names(docs).columns if c not in docs.columns and c.lower() not in ("copy", "shuffle_key")]
    assert set(own) <= set(wide.columns) and all(set(r.asDict().values()) >= {f"my {c.lower()}" for c in own} for r in wide.collect())
    assert as_set(wide.select(*plain.columns)) == as_set(plain)


def test_classifier_with_clashing_names(spark, docs):
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")
    assert as_set(toxicity.score_documents(with_names(docs), with_names(labels))) == as_set(toxicity.score_documents(docs, labels))
    kept = toxicity.drop_toxic(with_names(docs), labels)
    assert kept.columns == with_names(docs).columns


def test_vectors_and_conversations_with_clashing_names(spark):
    rng = np.random.default_rng(1)
    vectors = spark.createDataFrame([(i, rng.standard_normal(4).astype(np.float32).tolist(), i % 2) for i in range(60)], "vec_id long, embedding array<float>, label int")
    for operator in (topk.top_k, cover_tree.near_duplicates):
        assert as_set(operator(with_names(vectors))) == as_set(operator(vectors))
    signless = lambda df: as_set(df.withColumn("whitened", F.round(F.abs("whitened"), 9)), "identity_error")
    assert signless(whitening.whiten(with_names(vectors))) == signless(whitening.whiten(vectors))
    talk = spark.createDataFrame([(c, t, ("user", "assistant")[t % 2], f"Turn {t}.") for c in range(9) for t in range(4)], "conv_id long, turn long, role string, text string")
    assert as_set(conversation_repair.audit(with_names(talk))) == as_set(conversation_repair.audit(talk))


def test_stages_take_hostile_tables(spark, docs, tmp_path):
    labels = spark.createDataFrame([(1, 0), (2, 0)], "doc_id long, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        for table in (with_names(docs, ["__id", "__copies", "__kinds", "draws", "cdf"]), docs.unionByName(docs), docs.where("false")):
            out = stage(spark, table, str(tmp_path))
            found = out.collect()
            assert name == "packing" or out.columns == table.columns
            assert bool(found) == (table.count() > 0)


def chained(rng, n):
    """Texts in which each differs a little from the one before, so that ends of a chain are not alike."""
    words, out = [f"w{i}" for i in range(60)], []
    for i in range(n):
        at = rng.randrange(60)
        words = words[:at] + [f"n{i}"] + words[at + 1:]
        out.append(" ".join(words))
    return out


def test_minhash_splits_buckets_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_ROWS", 4)
    rng = random.Random(5)
    data = list(enumerate(chained(rng, 60) + chained(rng, 60)))
    rng.shuffle(data)
    df = spark.createDataFrame(data, "doc_id long, text string")
    assert rows(minhash.near_duplicates(df), "doc_id", "n_shingles", "component_id", "kept") == brute_components(data)


def test_minhash_splits_buckets_by_shingles(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", 100)
    data = list(enumerate(chained(random.Random(6), 50)))
    df = spark.createDataFrame(data, "doc_id long, text string")
    assert rows(minhash.near_duplicates(df), "doc_id", "n_shingles", "component_id", "kept") == brute_components(data)


def test_top_k_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 32)
    rng = np.random.default_rng(2)
    data = [(i, (rng.standard_normal(5) * 2.0 ** rng.integers(-2, 3)).astype(np.float32).tolist()) for i in range(300)]
    exact = {i: [int(np.floor(256.0 * float(np.float32(x)))) for x in v] for i, v in data}
    expected = []
    for q in (i for i in exact if i % 50 == 0):
        best = sorted((-sum(a * b for a, b in zip(exact[q], exact[c], strict=True)), c) for c in exact if c != q)[:5]
        expected += [(q, k + 1, c, -s) for k, (s, c) in enumerate(best)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    assert rows(topk.top_k(df), "query_id", "rank", "vec_id", "score") == sorted(expected, key=str)


def test_cover_tree_over_many_blocks_of_a_label(spark, monkeypatch):
    monkeypatch.setattr(cover_tree, "BLOCK_ROWS", 32)
    rng = np.random.default_rng(3)
    base = rng.standard_normal((6, 10))
    data = [(i, (base[i % 6] + rng.standard_normal(10) * 0.12).astype(np.float32).tolist(), 1) for i in range(200)]
    links, comp = [0] * 200, list(range(200))
    for x, y in itertools.combinations(range(200), 2):
        v, w = (np.array(data[k][1], np.float64) for k in (x, y))
        if v @ w / (np.sqrt(v @ v) * np.sqrt(w @ w)) >= 0.98:
            links[x], links[y] = links[x] + 1, links[y] + 1
            low, high = sorted((comp[x], comp[y]))
            comp = [low if c == high else c for c in comp]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>, label int")
    assert rows(cover_tree.near_duplicates(df), "vec_id", "n_links", "component_id", "kept") == sorted([(i, links[i], comp[i], comp[i] == i) for i in range(200)], key=str)


def test_token_files_close_blocks_within_a_part(spark, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_IDS", 70)
    data = [(i, " ".join(f"word{j}" for j in range(i % 23))) for i in range(120)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    many = rows(token_files.token_files(df, queries.BYTE_BPE), "doc_id", "start", "n_tokens", "ids_crc32")
    monkeypatch.undo()
    assert many == rows(token_files.token_files(df, queries.BYTE_BPE), "doc_id", "start", "n_tokens", "ids_crc32")
