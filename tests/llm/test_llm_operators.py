"""Small tests of the training-data operators: brute force, round trips and edge cases
(nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns)."""

import hashlib
import itertools
import os
import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from basketlens.llm import cover_tree, encoding, minhash, mixing, packing, queries, secrets_scan, token_counts, token_files, topk, toxicity, url_filter
from basketlens.llm.components import components

SF = "/root/testdata/sf0.001"
WORDS = ["alpha", "Beta", "gamma,", "delta.", "été", "x", "42", "don't", "日本語", " ", "a" * 70, "eta\n\nzeta"]


def texts(seed, n, most=40):
    rng = random.Random(seed)
    return [" ".join(rng.choice(WORDS) for _ in range(rng.randint(0, most))) for _ in range(n)]


@pytest.fixture(scope="module")
def edge_docs(spark):
    rows = [(1, "one two three four five six seven", "a", "x"), (1, "one two three four five six seven", "a", "y"), (2, None, None, None), (3, "", "b", ""),
            (None, "one two three four five six seven", None, "z"), (4, " \n\t ", "a", "w"), (5, "long word " * 4000, "b", "v"), (6, "z" * 5000, "b", "u")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, score string")


def empty_like(df):
    return df.where("false")


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.select(*cols).collect()), key=str)


def test_url_rules_and_edges(spark):
    urls = ["http://WWW.Example.com/en/x", "http://example.com/en/", "http://a.com", "http://a.com?x=/en/", "ftp://b.net/es/?q", "x.com/", None, "", "http://é.net/fr/é",
            "http://evil.org/x.com/", "http://notexample.com/en/a", "http://a.com#f/", "http://u@a.com:80/", "http://" + "s." * 500 + "com/" + "p" * 5000]
    df = spark.createDataFrame([(i, u, "mine", "r") for i, u in enumerate(urls)], "page_id long, url string, host string, rule string")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in url_filter.filter_urls(df).collect()}
    assert [got[i] for i in range(14)] == [
        ("www.example.com/en/", "allow"), ("example.com/en/", "block"), (None, "allow"), (None, "allow"), ("net/es/", "block"), (None, "allow"), (None, "allow"), (None, "allow"),
        ("net/fr/", "block"), (None, "allow"), ("com/", "allow"), (None, "allow"), (None, "allow"), ("com/", "allow")]
    assert url_filter.filter_urls(empty_like(df)).count() == 0
    assert url_filter.keep_allowed(df).columns == df.columns


def test_many_globs_match_fnmatch():
    rng = random.Random(5)
    globs = ["".join(rng.choice("ab*?/") for _ in range(rng.randint(1, 12))).replace("***", "**") for _ in range(60)]
    automaton = url_filter.compile_globs([(g, i) for i, g in enumerate(globs)], [("allow", g) for g in globs])
    assert len(automaton.start) > 1
    shown = [re.compile("".join(".*" if t == "**" else "[^/]*" if t == "*" else "[^/]" if t == "?" else t for t in re.findall(r"\*\*|.", g)), re.S) for g in globs]
    strings = ["".join(rng.choice("ab/c") for _ in range(rng.randint(0, 14))) for _ in range(400)]
    expected = [next((i for i, p in enumerate(shown) if p.fullmatch(s)), -1) for s in strings]
    assert automaton.matches(strings).tolist() == expected


def test_token_counts_match_greedy_split(spark, edge_docs):
    pieces = set(token_counts.byte_level_pieces(queries.BYTE_BPE))
    longest = max(map(len, pieces))

    def greedy(word):
        n = 0
        while word:
            word = word[next(k for k in range(min(longest, len(word)), 0, -1) if word[:k] in pieces):]
            n += 1
        return n

    docs = spark.createDataFrame(list(enumerate(texts(1, 60))), "doc_id long, text string")
    expected = [(i, len(t.encode().split()), sum(greedy(b" " + w) for w in t.encode().split())) for i, t in enumerate(texts(1, 60))]
    assert rows(token_counts.count_tokens(docs, queries.BYTE_BPE), "doc_id", "n_words", "n_tokens") == sorted(expected, key=str)
    got = token_counts.count_tokens(edge_docs, queries.BYTE_BPE)
    assert got.count() == 8 and {r["n_tokens"] for r in got.where("doc_id in (2, 3, 4)").collect()} == {0}
    assert token_counts.count_tokens(empty_like(edge_docs), queries.BYTE_BPE).count() == 0


def test_unknown_words_count_as_one_piece():
    counter = token_counts.PieceCounter([b" ", b"ab", b"abc", b"c", b"d"])
    assert [counter.count(w) for w in (b" abcd", b" abd", b" aab", b" abcc", b"")] == [3, 3, 1, 3, 0]


@pytest.mark.parametrize("path", [queries.BYTE_BPE, queries.WORD_BPE])
def test_remembered_encoding_is_exact(path):
    enc = encoding.Encoder(path)
    odd = ["", " ", "a  b", "x\n y", "\n\n", "'s 's It'S", "١٢ ½ ²", "İI ẞ", "a\x1cb c\x85", "<|endoftext|> hi", "👍🏽 é"]
    for some in (texts(2, 80), odd, texts(2, 80)):
        expected = [np.array(e.ids, "<u4").tobytes() for e in enc.tokenizer.encode_batch(some, add_special_tokens=False)]
        assert enc.encode(some) == expected


@pytest.mark.parametrize("path", [queries.BYTE_BPE, queries.WORD_BPE])
def test_cuts_between_runs_are_exact(path, monkeypatch):
    """Random strings of white space, stops, commas and marks, also when the memo changes generations."""
    monkeypatch.setattr(encoding, "MEMO_RUNS", 500)
    rng, enc, fresh = random.Random(4), encoding.Encoder(path), Tokenizer.from_file(path)
    signs = [*"abAB é.,!' \n\t  019½²'sªµ\x85\xa0\x1c\x1fĀſ-", "  ", "   ", " \n", "don't", "ß", "İ", ", ", ". "]
    odd = ["b²é½,\x85µ \xa0 \xa0", " \xa0,ßA", "'Āb \x85, ²", "s\n\n,", "a ,b", "a. ", "..,", ". . ."]
    odd += ["".join(rng.choice(signs) for _ in range(rng.randint(0, 14))) for _ in range(3000)]
    for at in range(0, len(odd), 300):
        some = odd[at:at + 300]
        assert enc.encode(some) == [np.array(e.ids, "<u4").tobytes() for e in fresh.encode_batch(some, add_special_tokens=False)]
    assert enc.older


def test_new_words_are_encoded_without_a_second_cut():
    """Runs that the pattern cut already go to the model as they are, not through the file's own pattern once more."""
    fresh, enc = Tokenizer.from_file(queries.BYTE_BPE), encoding.Encoder(queries.BYTE_BPE)
    some = ["", " ", *texts(5, 200), "É à\xa0la 12 ½, ¿qué? \xad\x85 naïveté ÿſ", "a.b,c  d\n\n e's"]
    some = [t for t in some if not encoding.OTHER.search(t)]
    assert len(some) > 20
    expected = [np.array(e.ids, "<u4").tobytes() for e in fresh.encode_batch(some, add_special_tokens=False)]
    enc.tokenizer = None
    assert enc.encode(some) == expected
    assert not enc.memo.waiting and enc.encode(some[::-1]) == expected[::-1]


def test_a_unit_is_looked_up_once_for_many_texts():
    """Texts that repeat their words cost a look-up for each distinct unit of a group, not for each word."""
    class Counted(encoding.Memo):
        looked = 0

        def __getitem__(self, unit):
            Counted.looked += 1
            return super().__getitem__(unit)

    fresh, enc = Tokenizer.from_file(queries.BYTE_BPE), encoding.Encoder(queries.BYTE_BPE)
    some = ["one, two. three\nfour é 3.14 a.b,c x's"] * 300 + ["", "one two"]
    expected = [np.array(e.ids, "<u4").tobytes() for e in fresh.encode_batch(some, add_special_tokens=False)]
    enc.memo = Counted({})
    assert enc.encode(some) == expected and Counted.looked < len(some)
    assert all(type(ids) is bytes for ids in enc.memo.values())


ADDED = ["x <|endoftext|> hi", "<|endoftext|>", "a<|startoftext|>b  c<|endoftext|><|endoftext|>", "x <|ENDOFTEXT|> hi", "<|endoftext|", "é <|endoftext|>\n日本語", "plain words"]


@pytest.mark.parametrize("path", [queries.BYTE_BPE, queries.WORD_BPE])
def test_added_tokens_keep_their_ids(path):
    fresh, enc = Tokenizer.from_file(path), encoding.Encoder(path)
    end = fresh.token_to_id("<|endoftext|>")
    for some in (ADDED, texts(2, 40) + ADDED):
        expected = [np.array(e.ids, "<u4") for e in fresh.encode_batch(some, add_special_tokens=False)]
        assert enc.encode(some) == [e.tobytes() for e in expected]
        assert end in expected[some.index(ADDED[0])] and end not in expected[some.index(ADDED[3])]


def brute_components(docs):
    sets = []
    for _, text in docs:
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
        sets.append({tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    comp = {i: i for i, _ in docs}
    for (a, x), (b, y) in itertools.combinations(zip([i for i, _ in docs], sets, strict=True), 2):
        if x and 100 * len(x & y) >= 75 * len(x | y):
            low, high = sorted((comp[a], comp[b]))
            comp = {k: low if v == high else v for k, v in comp.items()}
    return sorted([(i, len(s), comp[i], comp[i] == i) for (i, _), s in zip(docs, sets, strict=True)], key=str)


def test_minhash_matches_brute_force(spark):
    rng = random.Random(7)
    docs = []
    for _ in range(12):
        base = [f"w{rng.randint(0, 400)}" for _ in range(rng.randint(3, 90))]
        for _ in range(9):
            words = [w if rng.random() > 0.04 else f"v{rng.randint(0, 99)}" for w in base]
            docs.append((len(docs) * 3, " ".join(words).upper() if rng.random() < 0.2 else "  ".join(words)))
    docs += [(1000, "Same few words"), (1001, "same  FEW\nwords"), (1002, None), (1003, ""), (1004, "same few")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows(minhash.near_duplicates(df), "doc_id", "n_shingles", "component_id", "kept") == brute_components(docs)


def test_minhash_edges(spark, edge_docs):
    got = minhash.near_duplicates(edge_docs)
    assert got.count() == 8
    assert {(r["component_id"], r["kept"]) for r in got.where("doc_id is null").collect()} == {(None, True)}
    kept = minhash.drop_near_duplicates(edge_docs)
    assert kept.columns == edge_docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "2", "3", "4", "5", "6", "None"]
    assert minhash.near_duplicates(empty_like(edge_docs)).count() == 0


def test_minhash_of_documents_with_several_texts(spark):
    text = {k: " ".join(f"{k}{i}" for i in range(30)) for k in "abcdef"}
    docs = [(3, text["a"]), (5, text["a"]), (5, text["b"]), (6, text["c"]), (6, text["d"]), (6, text["d"]), (8, text["e"]), (8, text["f"]), (9, text["b"]), (7, text["e"]), (5, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    component = {3: 3, 5: 3, 9: 3, 6: 6, 7: 7, 8: 7}
    assert rows(minhash.near_duplicates(df.where("text <> ''")), "doc_id", "component_id") == sorted(((i, component[i]) for i, t in docs if t), key=str)
    assert rows(minhash.drop_near_duplicates(df), "doc_id", "text") == sorted([(3, text["a"]), (6, text["c"]), (6, text["d"]), (7, text["e"])], key=str)


def test_components_of_long_paths(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 200), (200, 150), (7, 7), (300, 299)]
    random.Random(1).shuffle(edges)
    got = dict(rows(components(spark.createDataFrame(edges, "a long, b long")), "id", "component"))
    assert got == {i: 0 for i in range(61)} | {100: 100, 200: 100, 150: 100, 299: 299, 300: 299}


def test_secret_spans_match_python_and_masks(spark, edge_docs):
    rng = random.Random(3)
    bits = ["token", "=", '"', "'", " ", ":", "PassWord", "api_key", "secret", "AKIA", "ABCDEF0123456789", "deadbeef", "0123456789abcdef", "é", "👍", "\n", "xyz", "==", "-"]
    docs = [(i, "".join(rng.choice(bits) for _ in range(rng.randint(0, 50)))) for i in range(300)] + [(900, None), (901, ""), (902, "token=abcdef " * 700)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("spans", F.lit("mine")).withColumn("n_chars", F.length("text").cast("long"))
    got = {r["doc_id"]: r for r in secrets_scan.scan(df).collect()}
    masked = {r["doc_id"]: r for r in secrets_scan.mask_secrets(df).collect()}
    assign = re.compile(secrets_scan.BASE_RULES[0].pattern)
    for i, text in docs:
        t = text or ""
        spans = [(m.start(), 0, m.end()) for m in assign.finditer(t) if len(m[2]) >= 6] + [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        spans = sorted(spans + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24])
        joined = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in spans)
        assert (got[i]["n_assign"], got[i]["n_access"], got[i]["n_hex"]) == tuple(sum(s[1] == k for s in spans) for k in range(3))
        assert got[i]["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest() and got[i]["spans"] == joined
        out, pos = "", 0
        for a, _, b in spans:
            out += t[pos:a] + "<secret>" if a >= pos else ""
            pos = max(pos, b)
        assert masked[i]["text"] == (None if text is None else out + t[pos:])
        assert masked[i]["spans"] == "mine" and masked[i]["n_chars"] == (None if text is None else len(masked[i]["text"]))
    assert secrets_scan.scan(edge_docs).count() == 8 and secrets_scan.scan(empty_like(edge_docs)).count() == 0


def test_secret_plan_has_no_python(spark, edge_docs):
    plan = secrets_scan.scan(edge_docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_trigram_queries():
    assert secrets_scan.trigram_query("[0-9a-f]+") == []
    assert secrets_scan.trigram_query("AKIA[A-Z0-9]+") == [[["aki", "kia"]]]
    assert secrets_scan.trigram_query("(?:abcd|xyz)+q") == [[["abc", "bcd"], ["xyz"]]]
    assert secrets_scan.trigram_query("ab|cd") == []


def vectors(spark, data):
    return spark.createDataFrame(data, "vec_id long, embedding array<float>, label int").withColumn("score", F.lit("mine")).withColumn("rank", F.lit(0))


def test_top_k_matches_brute_force(spark):
    rng = np.random.default_rng(4)
    data = [(i, (rng.standard_normal(6) * 2.0 ** rng.integers(-4, 5)).astype(np.float32).tolist(), 0) for i in range(700)]
    data += [(700 + i, data[i][1], 0) for i in range(0, 100)]  # ties
    data += [(5000, None, 0), (5050, [1.0, None, 1.0, 1.0, 1.0, 1.0], 0), (5100, [float("nan")] * 6, 0), (5150, [0.0] * 6, 0), (None, [1.0] * 6, 0), (5151, [-0.001], 0), (5200, [3e38] * 6, 0)]
    exact = {i: [int(np.floor(256.0 * float(np.float32(x)))) for x in v] for i, v, _ in data if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    expected = []
    for q in (i for i in exact if i % 50 == 0):
        scored = sorted((-max(-2**63, min(2**63 - 1, sum(a * b for a, b in zip(exact[q], exact[c], strict=False)))), c) for c in exact if c != q)[:5]
        expected += [(q, k + 1, c, -s) for k, (s, c) in enumerate(scored)]
    assert rows(topk.top_k(vectors(spark, data)), "query_id", "rank", "vec_id", "score") == sorted(expected, key=str)


def test_top_k_with_few_rows(spark):
    few = vectors(spark, [(0, [1.0, 2.0], 1), (1, [1.0, 2.0], 1), (50, [], 1)])
    assert rows(topk.top_k(few), "query_id", "rank", "vec_id", "score") == sorted(
        [(0, 1, 1, 256 * 256 * 5), (0, 2, 50, 0), (50, 1, 0, 0), (50, 2, 1, 0)], key=str)
    assert topk.top_k(empty_like(few)).count() == 0


def test_cover_tree_matches_brute_force(spark):
    rng = np.random.default_rng(9)
    base = rng.standard_normal((8, 12))
    data = [(i, (base[i % 8] + rng.standard_normal(12) * rng.choice([0.02, 0.1, 0.2])).astype(np.float32).tolist(), int(i % 3)) for i in range(260)]
    data += [(1000 + i, data[i][1], data[i][2]) for i in range(20)] + [(7, data[7][1], data[7][2])]  # equal vectors, a repeated row
    bad = [(2000, None, 1), (2001, [0.0] * 12, 1), (2002, [float("inf")] * 12, 1), (2003, [None] * 12, 1), (2004, data[1][1], None), (2005, [], 1), (2006, [1.0], 1)]
    good = [(i, np.array(v, np.float64), lab) for i, v, lab in data]
    links, comp = [0] * len(good), {i: i for i, _, _ in good}
    for x, y in itertools.combinations(range(len(good)), 2):
        (i, v, a), (j, w, b) = good[x], good[y]
        if a == b and v @ w / (np.sqrt(v @ v) * np.sqrt(w @ w)) >= 0.98:
            links[x] += 1
            links[y] += 1
            low, high = sorted((comp[i], comp[j]))
            comp = {k: low if c == high else c for k, c in comp.items()}
    expected = [(i, links[k], comp[i], comp[i] == i) for k, (i, _, _) in enumerate(good)] + [(i, 0, i, True) for i, _, _ in bad]
    df = vectors(spark, data + bad)
    assert rows(cover_tree.near_duplicates(df), "vec_id", "n_links", "component_id", "kept") == sorted(expected, key=str)
    assert cover_tree.near_duplicates(empty_like(df)).count() == 0


def test_huffman_codes_are_optimal_and_limited():
    counts = np.array([0, 1, 1, 2, 3, 5, 8, 13, 21, 34, 55])
    free, tight = token_files.code_lengths(counts, 20), token_files.code_lengths(counts, 5)
    assert free[0] == 0 and (counts * free).sum() == 363 and tight.max() <= 5
    assert sum(2.0 ** -int(b) for b in tight[1:]) <= 1 and (counts * tight).sum() >= (counts * free).sum()
    assert token_files.code_lengths(np.array([0, 7])).tolist() == [0, 1] and token_files.code_lengths(np.zeros(0, np.int64)).tolist() == []


def test_huffman_round_trip():
    rng = np.random.default_rng(2)
    ids = [np.minimum(rng.geometric(0.01, n), 900) for n in (1, 255, 256, 257, 5000)]
    lengths = token_files.code_lengths(np.bincount(np.concatenate(ids)))
    coded = [token_files.encode_ids(x, lengths, token_files.canonical_codes(lengths)) for x in ids]
    back = token_files.Decoder(lengths).decode([p for _, p in coded], [o for o, _ in coded], [len(x) for x in ids])
    assert all((a == b).all() for a, b in zip(ids, back, strict=True))


def test_token_files_round_trip(spark, edge_docs):
    tokenizer = Tokenizer.from_file(queries.BYTE_BPE)
    docs = [(100 - i, t) for i, t in enumerate(texts(6, 50))]
    start, expected = 0, []
    for i, t in sorted(docs):
        ids = np.array(tokenizer.encode(t, add_special_tokens=False).ids + [0], "<u4")
        expected.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    got = token_files.token_files(spark.createDataFrame(docs, "doc_id long, text string"), queries.BYTE_BPE)
    assert rows(got, "doc_id", "start", "n_tokens", "ids_crc32") == sorted(expected, key=str)
    assert token_files.token_files(edge_docs, queries.BYTE_BPE).count() == 8
    assert token_files.token_files(empty_like(edge_docs), queries.BYTE_BPE).count() == 0


def test_token_files_with_added_tokens(spark):
    tokenizer, start, expected = Tokenizer.from_file(queries.BYTE_BPE), 0, []
    for i, t in enumerate(ADDED):
        ids = np.array(tokenizer.encode(t, add_special_tokens=False).ids + [0], "<u4")
        expected.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    got = token_files.token_files(spark.createDataFrame(list(enumerate(ADDED)), "doc_id long, text string"), queries.BYTE_BPE)
    assert rows(got, "doc_id", "start", "n_tokens", "ids_crc32") == sorted(expected, key=str)


def test_mixing_follows_weights(spark, edge_docs):
    docs = spark.createDataFrame([(i, "x" * 50, "big" if i % 3 else "small") for i in range(3000)], "doc_id long, text string, source string")
    mixed = mixing.mix(docs.withColumn("copy", F.lit("mine")), weights={"big": 1.0, "small": 3.0}, epochs=2.0)
    shares = {r["source"]: r["n"] for r in mixed.groupBy("source").agg(F.count("*").alias("n")).collect()}
    assert abs(shares["small"] - 4500) < 300 and abs(shares["big"] - 1500) < 200
    assert rows(mixed, "doc_id", "copy") == rows(mixing.mix(docs.repartition(7), weights={"big": 1.0, "small": 3.0}, epochs=2.0), "doc_id", "copy")
    heavy = mixing.mix(docs.limit(3), epochs=600.0, alpha=1.0).groupBy("doc_id").count().collect()
    assert all(450 < r["count"] < 750 for r in heavy)
    assert mixing.mix(empty_like(edge_docs)).count() == 0
    assert {r["source"] for r in mixing.mix(edge_docs, epochs=30.0, alpha=1.0).collect()} == {"a", "b", None}


def check_packing(packed, tokenizer_path, docs, cap):
    tokenizer = Tokenizer.from_file(tokenizer_path)
    expected = []
    for i, t in docs:
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        expected += [(i, k, k * cap.tokens, len(p), zlib.crc32(p.tobytes())) for k in range(-(-len(ids) // cap.tokens)) for p in [ids[k * cap.tokens:(k + 1) * cap.tokens]]]
    assert rows(packed, "doc_id", "piece", "start", "length", "ids_crc32") == sorted(expected, key=str)
    bins = {}
    for s, o, n in rows(packed, "sequence_id", "offset", "length"):
        bins.setdefault(s, []).append((o, n))
    for pieces in bins.values():
        pieces.sort()
        assert [o for o, _ in pieces] == [sum(n for _, n in pieces[:k]) for k in range(len(pieces))]
        assert sum(n for _, n in pieces) <= cap.tokens and len(pieces) <= cap.documents and sum(n * n for _, n in pieces) <= cap.attention
    return len(bins)


@pytest.mark.parametrize("cap", [packing.Capacity(64, 64, 64 * 64), packing.Capacity(64, 3, 4500, (1.0, 0.3, 0.5)), packing.Capacity(64, 5, 4096, (1.0, 1.0, 1.0), "dot")])
def test_packing_keeps_every_capacity(spark, cap):
    docs = list(enumerate(texts(8, 120))) + [(500, None), (501, ""), (7, "again")]
    packed = packing.pack(spark.createDataFrame(docs, "doc_id long, text string"), queries.WORD_BPE, cap).persist()
    used = check_packing(packed, queries.WORD_BPE, docs, cap)
    if cap.documents == 64:
        assert used <= -(-sum(r["length"] for r in packed.collect()) // 64) + 2
    packed.unpersist()


def test_packing_with_added_tokens(spark):
    docs, cap = list(enumerate(ADDED * 3)), packing.Capacity(64, 64, 64 * 64)
    check_packing(packing.pack(spark.createDataFrame(docs, "doc_id long, text string"), queries.WORD_BPE, cap), queries.WORD_BPE, docs, cap)


def test_packing_edges(spark, edge_docs):
    assert packing.pack(empty_like(edge_docs), queries.WORD_BPE).count() == 0
    check_packing(packing.pack(edge_docs, queries.WORD_BPE), queries.WORD_BPE, [(r["doc_id"], r["text"]) for r in edge_docs.collect()], packing.Capacity())
    with pytest.raises(ValueError):
        packing.plan_bins({10: 1}, packing.Capacity(10, 5, 99))


def test_toxicity_takes_the_features_of_a_few_texts_at_a_time():
    some = texts(8, 3 * toxicity.TEXTS_AT_ONCE + 5)
    wanted = np.ones(1 << toxicity.FEATURE_BITS, bool)
    wanted[::3] = False
    row, bucket = toxicity.features(some, wanted)
    buckets = np.flatnonzero(wanted)
    whole = pa.RecordBatch.from_arrays([pa.array(some), pa.array([float(i % 2) for i in range(len(some))])], names=["text", "toxic"])
    got = list(toxicity._places(iter([whole]), buckets, wanted))
    assert max(b.num_rows for b in got) == toxicity.TEXTS_AT_ONCE
    assert [x for b in got for x in b.column(0).to_pylist()] == [np.searchsorted(buckets, bucket[row == i]).tolist() for i in range(len(some))]
    assert [x for b in got for x in b.column(1).to_pylist()] == [float(i % 2) for i in range(len(some))]


def test_toxicity_held_out(spark, edge_docs):
    rng = random.Random(11)
    neutral, rude = [f"word{i}" for i in range(60)], ["foulish", "nastig", "vilemente"]
    docs, labels = [], []
    for i in range(500):
        bad = rng.random() < 0.25
        docs.append((i, " ".join([rng.choice(neutral) for _ in range(rng.randint(5, 120))] + [rng.choice(rude)] * bad)))
        labels.append((i, int(bad)))
    df, lab = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels + [(None, 1), (3, None)], "doc_id long, toxic int")
    truth = dict(labels)
    got = toxicity.score_documents(df, lab).collect()
    held = [r for r in got if r["held_out"]]
    assert len(held) == sum(zlib.crc32(str(i).encode()) % 4 == 2 for i in range(500))
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) > 0.97 and all(0 <= r["score"] <= 1 for r in got)
    model = toxicity.fit(df, lab)
    flipped = toxicity.fit(df, lab.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic"))))
    assert model.intercept == flipped.intercept and (model.weights == flipped.weights).all()
    edge = toxicity.with_score(edge_docs, model).collect()
    assert len(edge) == 8 and all(r["score"] is not None for r in edge)
    none = toxicity.score_documents(edge_docs, empty_like(lab))
    assert {r["score"] for r in none.collect()} == {0.5}
    assert toxicity.score_documents(empty_like(edge_docs), lab).count() == 0
    assert toxicity.drop_toxic(edge_docs, lab).columns == edge_docs.columns


def test_pipeline_stages_chain(spark):
    import corpus_pipeline as pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept, now = {}, docs
    for name, stage in pipeline.STAGES[:-1]:
        now = stage(spark, now, SF).persist()
        kept[name] = [r["doc_id"] for r in now.select("doc_id").collect()]
        assert now.columns == docs.columns
    assert set(kept["near_duplicates"]) <= set(kept["toxicity"]) and sorted(kept["secrets"]) == sorted(kept["near_duplicates"]) and set(kept["mixing"]) <= set(kept["secrets"])
    clean = [i for i, t in labels.items() if t == 0]
    assert np.mean([i in set(kept["toxicity"]) for i in clean]) > 0.9
    assert pipeline.run(spark, SF).count() >= len(kept["mixing"])


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages"):
        con.sql(f"create view {table} as select * from '{SF}/{table}.parquet'")
    got, expected = queries.QUERIES[name](spark, SF), con.sql(queries.ORACLES[name])
    cols = sorted(got.columns)
    assert cols == sorted(expected.columns)
    assert rows(got, *cols) == sorted((tuple(r) for r in con.sql(queries.ORACLES[name]).select(*cols).fetchall()), key=str)


def test_nothing_else_imports_the_subpackage():
    top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    for folder, _, names in os.walk(os.path.join(top, "basketlens")):
        for name in names:
            if name.endswith(".py") and os.path.basename(folder) != "llm":
                assert "basketlens.llm" not in open(os.path.join(folder, name)).read()
