"""Conversation repair, cutting-stock packing and whitening against brute force, and their edge cases."""

import hashlib
import heapq
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from basketlens.llm import conversation_repair as repair
from basketlens.llm import cutting_stock, queries, whitening

SF = "/root/testdata/sf0.001"


def empty_like(df):
    return df.where("false")


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.select(*cols).collect()), key=str)


# --- conversations ------------------------------------------------------------------

def cheapest(codes, entry=repair.START, goal=repair.END):
    """Least (cost, edits) by a uniform-cost search over (row, state)."""
    heap, seen = [(0, "", 0, entry)], set()
    while heap:
        cost, edits, i, q = heapq.heappop(heap)
        if i == len(codes) and (q in repair.ENDS if goal == repair.END else q == goal):
            return cost, edits
        if (i, q) in seen or i == len(codes) and goal != repair.END:
            continue
        seen.add((i, q))
        heapq.heappush(heap, (cost + 3, edits + "I", i, repair.PUT_IN[q]))
        if i < len(codes):
            role, fault = codes[i]
            heapq.heappush(heap, (cost + 4, edits + "D", i + 1, q))
            if fault != "x":
                extra = 3 * (fault == "t")
                heapq.heappush(heap, (cost + 3 + extra, edits + "R", i + 1, repair.PUT_IN[q]))
                if (q, role) in repair.FOLLOWS:
                    heapq.heappush(heap, (cost + extra, edits + "K", i + 1, repair.FOLLOWS[q, role]))
    return None


def random_codes(rng, n):
    return "".join(rng.choice("uuaas?") for _ in range(n)), "".join(rng.choice("kkktx") for _ in range(n))


def test_search_finds_the_cheapest_and_least_edits():
    rng = random.Random(2)
    for _ in range(400):
        codes = list(zip(*random_codes(rng, rng.randint(1, 9)), strict=True))
        for entry in repair.STATES:
            for goal in (repair.END, *repair.STATES):
                assert repair.search(codes, entry, goal) == cheapest(codes, entry, goal)


@pytest.mark.parametrize("block", [1, 2, 5])
def test_blocks_give_the_same_edits(monkeypatch, block):
    rng = random.Random(block)
    monkeypatch.setattr(repair, "BLOCK_ROWS", block)
    for _ in range(200):
        initials, faults = random_codes(rng, rng.randint(1, 17))
        assert repair.repair_codes(initials, faults, repair.START, repair.END) == cheapest(list(zip(initials, faults, strict=True)))


def plain_audit(data):
    """The contract, spelled out row by row."""
    damaged, blank = {}, lambda v: " " if v is None else v
    for conv, turn, role, text in sorted(data, key=lambda r: (r[1] is not None, r[1] or 0, blank(r[2]), blank(r[3]))):
        out = damaged.setdefault(conv, [])
        kind = zlib.crc32(f"{blank(conv)}:{blank(turn)}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", blank(text)) if kind == 2 else blank(text)
        out += [(turn, "user" if kind == 4 else blank(role), text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    result = []
    for conv, turns in damaged.items():
        seen, faults = set(), []
        for _, role, text in turns:
            marks = re.findall("[^\x20\x09-\x0D]", text)
            faults.append("b" if not marks else "d" if (role, text) in seen else "k" if marks[-1] in ".!?" else "t")
            seen.add((role, text))
        cost, edits = cheapest([(r[:1], "x" if f in "bd" else f) for (_, r, _), f in zip(turns, faults, strict=True)])
        lines, q, at = [], repair.START, 0
        for e in edits:
            if e in "IR":
                q = repair.PUT_IN[q]
            elif e == "K":
                q = repair.FOLLOWS[q, turns[at][1][:1]]
            if e != "D":
                lines.append((turns[at][1] if e == "K" else {repair.USER: "user", repair.ASSISTANT: "assistant"}[q]) + ":" + ("" if e == "I" else turns[at][2]))
            at += e != "I"
        known = [t for t, _, _ in turns if t is not None]
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:], strict=False))
        result.append((conv, max(known) - min(known) + 1 - len(set(known)) if known else 0, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, edits,
                       hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(result, key=str)


AUDIT = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
TURNS = "conv_id long, turn long, role string, text string"


def talk(seed, conversations, longest):
    rng = random.Random(seed)
    said = ["Yes.", "No", "Why?", "", " \n", "Well. \n", "été!", "a.b", "👍", None]
    return [(c, t if rng.random() > 0.05 else rng.choice([None, t + 3, 0]), rng.choice(["user", "assistant"]) if rng.random() < 0.2 else ("user", "assistant")[t % 2] if t or c % 3 else
             rng.choice(["system", "tool", "", None, "User"]), rng.choice(said) if rng.random() < 0.3 else f"Turn {t} of {c}.") for c in range(conversations) for t in range(rng.randint(1, longest))]


def test_repair_matches_the_plain_audit(spark):
    data = talk(1, 150, 9) + talk(2, 2, 400) + [(None, 0, "user", "Hello."), (None, None, "assistant", None), (901, 0, "user", "x" * 50000 + "."), (901, 1, "assistant", "y" * 50000 + "!")]
    data += data[:40]  # repeated rows
    df = spark.createDataFrame(data, TURNS).withColumn("pos", F.lit("mine")).withColumn("Edit", F.lit(1))
    assert rows(repair.audit(df), *AUDIT) == plain_audit(data)
    given = spark.read.parquet(f"{SF}/conversations.parquet")
    assert rows(repair.audit(given), *AUDIT) == plain_audit([tuple(r) for r in given.select("conv_id", "turn", "role", "text").collect()])


def test_a_conversation_in_many_partitions(spark):
    rng = random.Random(4)
    data = [(7, t, rng.choice(["user", "assistant"]), rng.choice(["Same.", f"Turn {t}.", "cut off"])) for t in range(900)] + [(8, 0, "user", "Hi.")]
    df = spark.createDataFrame(data, TURNS)
    edits, _ = repair.repair(repair.damaged(df))
    turns = repair.ordered(repair.damaged(df))
    assert turns.where("conv_id = 7").select("part").distinct().count() > 3
    assert rows(repair.audit(df), *AUDIT) == plain_audit(data)
    assert set(edits.columns) == {"conv_id", "pos", "step", "edit", "turn", "role", "text"}


def test_repair_of_nothing(spark):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    one = spark.createDataFrame([(gone, 0, "user", "Hi.")], TURNS)
    assert rows(repair.audit(one), *AUDIT) == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())]
    assert repair.audit(empty_like(one)).count() == 0


# --- cutting stock --------------------------------------------------------------------

def check_stock(packed, docs, tokens, end=2):
    tokenizer = Tokenizer.from_file(queries.WORD_BPE)
    ids = {i: np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [end], "<u4") for i, t in docs}
    pieces, places = {}, {}
    for r in packed.collect():
        some = ids[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert len(some) == r["length"] and zlib.crc32(some.tobytes()) == r["ids_crc32"] and r["doc_tokens"] == len(ids[r["doc_id"]])
        pieces.setdefault(r["doc_id"], []).append((r["start"], r["length"]))
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for i, found in pieces.items():
        found.sort()
        assert [a for a, _ in found] == np.cumsum([0, *[n for _, n in found]]).tolist()[:-1] and sum(n for _, n in found) == len(ids[i])
    assert set(pieces) == set(ids)
    for found in places.values():
        found.sort()
        assert [a for a, _ in found] == np.cumsum([0, *[n for _, n in found]]).tolist()[:-1]
        full = sum(n for _, n in found)
        assert full == tokens or full < tokens and full & (full - 1) == 0
    return len(places)


def stock_docs(seed, n):
    rng = random.Random(seed)
    return [(i, " ".join(rng.choice(["alpha", "Beta", "gamma,", "été", "日本語", "42"]) for _ in range(int(rng.lognormvariate(2.5, 1.2))))) for i in range(n)]


@pytest.mark.parametrize(("tokens", "grain"), [(64, 4), (64, 64), (128, 1)])
def test_stock_packing_loses_nothing_and_pads_nothing(spark, tokens, grain):
    docs = stock_docs(5, 200) + [(900, None), (901, ""), (902, "word " * 3000)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("rank", F.lit("mine")).withColumn("Part", F.lit(0)).repartition(5)
    packed = cutting_stock.pack(df, queries.WORD_BPE, tokens, grain=grain, with_ids=True).persist()
    used = check_stock(packed, docs, tokens)
    assert used <= sum(r["length"] for r in packed.collect()) // tokens + 16
    assert all(zlib.crc32(bytes(r["ids"])) == r["ids_crc32"] for r in packed.collect())
    packed.unpersist()


def test_stock_packing_on_the_given_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert len({r["doc_id"] for r in docs.collect()}) == docs.count()
    check_stock(queries.op12_cutting_stock_packing(spark, SF), [(r["doc_id"], r["text"]) for r in docs.collect()], 4096)


def test_stock_packing_edges(spark):
    df = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (None, "d"), (None, None)], "doc_id long, text string")
    packed = cutting_stock.pack(df, queries.WORD_BPE)
    assert packed.agg(F.sum("length")).first()[0] == 4 + 4 + 2 + 1
    assert cutting_stock.pack(empty_like(df), queries.WORD_BPE).count() == 0
    with pytest.raises(ValueError):
        cutting_stock.make_plan({1: 1}, 100)


def test_linear_program_is_optimal_on_known_cases():
    # 3 + 5 fill 8 exactly; 5s alone cannot
    demand = np.zeros(8, np.int64)
    demand[2], demand[4] = 60, 60
    patterns, use, cost = cutting_stock.solve_relaxed(demand, [8])
    assert abs(cost - 60 * 8) < 1e-6 and all(p @ np.arange(1, 9) <= 8 for p in patterns) and (patterns.T @ use >= demand - 1e-6).all()
    demand[2] = 0
    assert abs(cutting_stock.solve_relaxed(demand, [8])[2] - 60 * 8) < 1e-6
    assert abs(cutting_stock.solve_relaxed(np.array([0, 0, 0, 9, 0, 0, 0, 0]), [1, 2, 4, 8])[2] - 36) < 1e-6


def test_linear_program_meets_its_bound_on_random_demands():
    rng = np.random.default_rng(3)
    for _ in range(20):
        demand = rng.integers(0, 2000, 32) * (rng.random(32) < 0.5)
        covered = np.zeros(32, np.int64)
        for pattern, times in cutting_stock.rounded(demand, [1, 2, 4, 8, 16, 32]):
            assert pattern @ np.arange(1, 33) <= 32
            covered += pattern * times
        assert (covered == demand).all()
        if demand.any():
            _, _, cost = cutting_stock.solve_relaxed(demand, [32])
            assert cost >= demand @ np.arange(1, 33) - 1e-3


# --- whitening ------------------------------------------------------------------------

def vectors(spark, data):
    return spark.createDataFrame(data, "vec_id long, embedding array<float>").withColumn("component", F.lit("mine")).withColumn("N", F.lit(0))


def check_whitening(got, good, most=8):
    """Against numpy's eigenvectors in double precision."""
    x = np.floor(1024 * np.array([v for _, v in good], np.float32).astype(np.float64)) + 100_000
    values, basis = np.linalg.eigh(np.cov(x.T, bias=True))
    values, basis = values[::-1], basis[:, ::-1]
    n, total = len(good), x.sum(axis=0)
    deviation = {}
    for (i, _), row in zip(good, x, strict=True):
        deviation.setdefault(i, []).append(sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, total, strict=True)))
    table = got.toPandas()
    assert len(table) == n * most and set(table["n"]) == {n} and sorted(set(table["component"])) == list(range(1, most + 1))
    assert sorted((i, d) for i, d in zip(table["vec_id"], table["deviation"], strict=True)) == sorted((i, d) for i, ds in deviation.items() for d in ds for _ in range(most))
    assert table["identity_error"].nunique() == 1 and table["identity_error"].iloc[0] < 1e-9
    for c in range(most):
        part = table[table["component"] == c + 1].sort_values(["vec_id", "deviation"])
        assert abs(part["explained"].iloc[0] - values[c] / values.sum()) < 1e-9
        plain = sorted(zip([i for i, _ in good], [deviation[i][0] for i, _ in good], ((x - x.mean(axis=0)) @ basis[:, c] / np.sqrt(values[c])).tolist(), strict=True))
        mine, theirs = part["whitened"].to_numpy(), np.array([w for _, _, w in plain])
        assert min(np.abs(mine - theirs).max(), np.abs(mine + theirs).max()) < 1e-7


def test_whitening_matches_numpy(spark):
    rng = np.random.default_rng(6)
    spread = rng.standard_normal((12, 12)) * np.linspace(0.02, 1.5, 12)
    data = [(i, (rng.standard_normal(12) @ spread).astype(np.float32).tolist()) for i in range(300)]
    bad = [(1000, None), (1001, []), (1002, [None] * 12), (1003, [float("nan")] * 12), (1004, [float("inf")] * 12), (1005, [1.0] * 5)]
    check_whitening(whitening.whiten(vectors(spark, data + bad).repartition(6)), data)


def test_whitening_of_few_dimensions_and_repeats(spark):
    rng = np.random.default_rng(7)
    data = [(i, (rng.standard_normal(3) * [1, 2, 5]).astype(np.float32).tolist()) for i in range(60)]
    check_whitening(whitening.whiten(vectors(spark, data + data)), data + data, most=3)
    lines = [(i, [float(i % 5), 2.0 * (i % 5), 1.0]) for i in range(20)]  # rank 1
    got = whitening.whiten(vectors(spark, lines))
    assert got.select("component").distinct().count() == 1 and got.count() == 20
    for few in ([(1, [1.0, 2.0])], [(1, [1.0]), (2, [1.0]), (None, [1.0])], []):
        assert whitening.whiten(vectors(spark, few)).count() == 0


def test_equal_eigenvalues_get_an_orthonormal_basis(spark):
    corners = [(k, [float(a), float(b), float(c), 0.5]) for k, (a, b, c) in enumerate((a, b, c) for a in (0, 1) for b in (0, 1) for c in (0, 1))]
    table = whitening.whiten(vectors(spark, corners)).toPandas()
    white = table.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    assert white.shape == (8, 3) and np.abs(white.T @ white / 8 - np.eye(3)).max() < 1e-12 and set(np.round(table["explained"], 12)) == {round(1 / 3, 12)}


def test_whitening_of_very_large_entries(spark):
    data = [(i, [3e38 * (i % 2), float(i), -1e20 * (i % 3)]) for i in range(12)]
    table = whitening.whiten(vectors(spark, data)).toPandas()
    assert table["deviation"].isna().all() and table["component"].max() == 3 and table["identity_error"].max() < 1e-6


def test_characteristic_polynomial_and_root_count(spark):
    rng = np.random.default_rng(8)
    half = rng.integers(-50, 50, (9, 6))
    matrix = (half @ half.T).astype(object)  # rank 6
    poly = whitening.characteristic_polynomial(spark, matrix)
    assert poly[9] == 1 and poly[8] == -int(np.trace(half @ half.T)) and poly[:3] == [0, 0, 0]
    values = np.sort(np.linalg.eigvalsh((half @ half.T).astype(float)))[::-1]
    assert [whitening.roots_above(poly, int(v) - 1) for v in values[:6]] == [1, 2, 3, 4, 5, 6] and whitening.roots_above(poly, 0) == 6
    s, roots = whitening.largest_roots(poly, 8)
    assert np.allclose([r / 2 ** s for r, _ in roots], values[:6], rtol=1e-9) and [c for _, c in roots] == [1] * 6
