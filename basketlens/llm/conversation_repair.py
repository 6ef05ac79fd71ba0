"""Repair of conversation structure by iterative-deepening A*.

A conversation's role initials must read ``(s?(ua)+)?``. Rows are edited in order:
D(elete) a row, I(nsert) an empty turn before it or at the end, K(eep) it, R(erole) it
to user or assistant. Within a state of the grammar the role of an inserted or reroled
turn is determined, so a string of edit initials is a whole repair.

The search tries edits depth first in ASCII order under a cost bound that grows to the
least estimate it had to leave. A table keeps, for each (row, state), the largest
budget that failed. The estimate adds what blank, duplicate and truncated rows cost
at least and what disjoint pairs of neighbours that cannot follow one another do. The
first accepting path is the cheapest repair, and the ASCII-least of these.

Conversations of any length are searched in blocks of BLOCK_ROWS rows: for each state
at a block's start and end the search gives the cheapest ASCII-least edits of the block.
Strings of one block from the same state end with its last row, so none begins another,
and the ASCII-least cheapest chain of blocks is found from costs and order alone. A
conversation whose rows lie in several partitions is put together in the same way.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlens.llm.common import worker_cache, written

DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
#: Rows searched at a time.
BLOCK_ROWS = 24
#: Blocks whose edits a worker remembers.
REMEMBERED = 100_000

# States of the grammar: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
#: (state, role initial) -> state, and the state after the one turn that may be put in.
FOLLOWS = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
PUT_IN = (USER, USER, ASSISTANT, USER)
INITIAL = " sua"
#: Where a conversation may end.
ENDS = (START, ASSISTANT)
#: Goal of a search that ends the conversation.
END = -1

WHITE = "\\x20\\x09-\\x0D"


# --- the search -------------------------------------------------------------------

def _estimates(rows: list[tuple[str, str]], goal: int) -> list[list[int]]:
    """For each row and state a lower bound of the cost of all that follows. ``rows``:
    (role initial, fault) with fault 'x' for rows that must go, 't' truncated, 'k' none."""
    n = len(rows)
    if goal in (START, SYSTEM):  # all rows go, but for one system row on the way to SYSTEM
        never = 1 << 40
        one = [never] * (n + 1)
        for i in range(n - 1, -1, -1):
            keep = {"x": never, "t": TRUNCATED, "k": 0}[rows[i][1]] if rows[i][0] == "s" else never
            one[i] = min(keep + DELETE * (n - i - 1), DELETE + one[i + 1])
        return [[DELETE * (n - i) if goal == START else one[i], DELETE * (n - i) if goal == SYSTEM else never, never, never] for i in range(n + 1)]
    alive = [i for i in range(n) if rows[i][1] != "x"]
    place = {i: k for k, i in enumerate(alive)}
    # least extra cost between neighbours that can't follow one another: put one in, or
    # rerole or delete one of the two; deleting a truncated one costs 1 beyond its 3
    extra = [DELETE - TRUNCATED if rows[i][1] == "t" else min(INSERT, REROLE, DELETE) for i in alive]

    def ends(state: int) -> bool:
        return state in ENDS if goal == END else state == goal

    def reads(role: str) -> int | None:
        return {"s": SYSTEM, "u": USER, "a": ASSISTANT}.get(role)

    # pairs[k]: extra cost of disjoint bad pairs among alive rows from k on, the end included
    pairs = [0] * (len(alive) + 2)
    for k in range(len(alive) - 1, -1, -1):
        role = rows[alive[k]][0]
        state = reads(role)
        if k + 1 < len(alive):
            bad = state is None or (state, rows[alive[k + 1]][0]) not in FOLLOWS
            cost = min(extra[k], extra[k + 1])
        else:
            bad = state is None or not ends(state)
            # inserts after the last row belong to the end of a conversation
            cost = min(extra[k], INSERT)
        pairs[k] = max(pairs[k + 1], cost + pairs[k + 2] if bad else 0)
    forced = [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        forced[i] = forced[i + 1] + {"x": DELETE, "t": TRUNCATED, "k": 0}[rows[i][1]]
    after = [len(alive)] * (n + 1)
    for i in range(n - 1, -1, -1):
        after[i] = place.get(i, after[i + 1])
    out = []
    for i in range(n + 1):
        k = after[i]
        row = []
        for q in STATES:
            here = pairs[k]
            if k < len(alive):
                if (q, rows[alive[k]][0]) not in FOLLOWS:
                    here = max(here, extra[k] + pairs[k + 1])
            elif not ends(q):
                here = max(here, INSERT if goal == END else 0)
            row.append(forced[i] + here)
        out.append(row)
    return out


def search(rows: list[tuple[str, str]], entry: int, goal: int) -> tuple[int, str] | None:
    """Cheapest and then ASCII-least edits of ``rows`` from state ``entry`` to ``goal``
    (END: any accepting one, with turns put in after the last row); None if there are none."""
    n, estimate = len(rows), _estimates(rows, goal)
    bound, infinite = estimate[0][entry], 1 << 60
    # what no repair can exceed: delete every row, and put in turns to reach the goal
    most = DELETE * n + 3 * INSERT
    if entry > SYSTEM and goal in (START, SYSTEM) or entry == SYSTEM and goal == START:
        return None
    while bound <= most:
        failed: dict[tuple[int, int], int] = {}
        least = infinite
        path: list[str] = []
        # a frame: row, state, cost so far, edits still to try
        stack = [(0, entry, 0, iter("DIKR"))]
        while stack:
            i, q, cost, edits = stack[-1]
            if i == n and (q in ENDS if goal == END else q == goal):
                return cost, "".join(path)
            for edit in edits:
                if edit == "I":
                    if i == n and goal != END:
                        continue
                    to = (i, PUT_IN[q], cost + INSERT)
                elif i == n:
                    continue
                else:
                    role, fault = rows[i]
                    if edit == "D":
                        to = (i + 1, q, cost + DELETE)
                    elif fault == "x":
                        continue
                    elif edit == "K":
                        if (q, role) not in FOLLOWS:
                            continue
                        to = (i + 1, FOLLOWS[q, role], cost + TRUNCATED * (fault == "t"))
                    else:
                        to = (i + 1, PUT_IN[q], cost + REROLE + TRUNCATED * (fault == "t"))
                total = to[2] + estimate[to[0]][to[1]]
                if total > bound:
                    least = min(least, total)
                elif bound - to[2] > failed.get(to[:2], -1):
                    stack.append((*to, iter("DIKR")))
                    path.append(edit)
                    break
            else:
                stack.pop()
                failed[i, q] = bound - cost
                if path:
                    path.pop()
        if least == infinite:
            return None
        bound = least
    return None


def solve(initials: str, faults: str, entry: int, goal: int) -> tuple[int, str] | None:
    """``search`` of a block, remembered by the worker."""
    memo = worker_cache("repair")
    key = (initials, faults, entry, goal)
    if key not in memo:
        if len(memo) >= REMEMBERED:
            memo.clear()
        memo[key] = search(list(zip(initials, faults, strict=True)), entry, goal)
    return memo[key]


def chain(costs: list[dict[tuple[int, int], tuple[int, object]]], entry: int, goals: dict[int, int]) -> tuple[int, list[int]] | None:
    """Cheapest chain of blocks. ``costs``: per block (state before, state after) -> (cost,
    what orders its edits among those from the same state); ``goals``: state -> cost of
    ending there. Returns the cost and the states between the blocks, first and last included."""
    togo = [dict(goals)]
    for block in reversed(costs):
        here: dict[int, int] = {}
        for (p, q), (c, _) in block.items():
            if q in togo[-1]:
                here[p] = min(here.get(p, 1 << 60), c + togo[-1][q])
        togo.append(here)
    togo.reverse()
    if entry not in togo[0]:
        return None
    states = [entry]
    for k, block in enumerate(costs):
        p = states[-1]
        states.append(min((order, q) for (a, q), (c, order) in block.items() if a == p and q in togo[k + 1] and c + togo[k + 1][q] == togo[k][p])[1])
    return togo[0][entry], states


def repair_codes(initials: str, faults: str, entry: int, goal: int) -> tuple[int, str] | None:
    """Cheapest ASCII-least edits of any number of rows, in blocks of BLOCK_ROWS."""
    cuts = list(range(0, len(initials), BLOCK_ROWS))
    if len(cuts) <= 1:
        return solve(initials, faults, entry, goal)
    blocks = []
    for a in cuts:
        i, f = initials[a:a + BLOCK_ROWS], faults[a:a + BLOCK_ROWS]
        last = a == cuts[-1]
        found = {(p, q): solve(i, f, p, q) for p in ([entry] if a == 0 else STATES) for q in ([goal] if last else STATES)}
        blocks.append({k: v for k, v in found.items() if v is not None})
    best = chain(blocks, entry, {goal: 0})
    if best is None:
        return None
    return best[0], "".join(b[p, q][1] for b, p, q in zip(blocks, best[1], best[1][1:], strict=False))


def edits_by_row(initials: str, entry: int, edits: str) -> list[tuple[str, str]]:
    """Per row its edits (turns put in before it, its own, and for the last row those after)
    and the role initial that each leaves, '-' for a deleted row."""
    out: list[tuple[str, str]] = []
    q, some, roles, row = entry, "", "", 0
    for edit in edits:
        if edit in "IR":
            q = PUT_IN[q]
            role = INITIAL[q]
        elif edit == "K":
            role = initials[row]
            q = FOLLOWS[q, role]
        else:
            role = "-"
        some, roles = some + edit, roles + role
        if edit != "I":
            out.append((some, roles))
            some, roles, row = "", "", row + 1
    if some:
        out[-1] = (out[-1][0] + some, out[-1][1] + roles)
    return out


# --- Spark --------------------------------------------------------------------------

def damaged(conversations: DataFrame) -> DataFrame:
    """The rows as the damage leaves them, and ``copy`` (0, or 1 for a repeat)."""
    def filled(name):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(filled("conv_id"), F.lit(":"), filled("turn"))) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(filled("text"), "[.!?]", "")).otherwise(filled("text"))
    return (conversations.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(filled("role")).alias("role"), text.alias("text"),
                                 filled("role").alias("role0"), filled("text").alias("text0"), kind.alias("kind"))
            .where("kind <> 0").select("*", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")))


def ordered(rows: DataFrame) -> DataFrame:
    """Rows sorted by conversation and turn (nulls first; ties by role and text), with
    ``pos`` (ascending in that order) and ``part`` (rows of a partition share it)."""
    keys = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role0"), F.col("text0"), F.col("copy")]
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    return written(placed.select("conv_id", "turn", "role", "text", F.monotonically_increasing_id().alias("pos"), F.spark_partition_id().alias("part")), "turns")


def coded(rows: DataFrame) -> DataFrame:
    """Without texts: conv_id, part, pos, turn, role initial and first fault of each row."""
    last = F.regexp_extract("text", f"([^{WHITE}])[{WHITE}]*$", 1)
    fault = F.when(last == "", "b").when(last.isin(".", "!", "?"), "k").otherwise("t")
    slim = rows.select("conv_id", "part", "pos", "turn", F.substring("role", 1, 1).alias("initial"), fault.alias("own"),
                       F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256).alias("same"))
    first = slim.groupBy(F.col("conv_id").alias("c"), F.col("same").alias("s")).agg(F.min("pos").alias("first"), F.count("*").alias("n")).where("n > 1")
    return (slim.join(first, slim["conv_id"].eqNullSafe(first["c"]) & (slim["same"] == first["s"]), "left")
            .select("conv_id", "part", "pos", "turn", "initial", F.when(F.col("own") == "b", "b").when(F.col("pos") > F.col("first"), "d").otherwise(F.col("own")).alias("fault")))


LEGAL = frozenset(("su", "ua", "au"))
_OPTION = pa.struct([("before", pa.int32()), ("after", pa.int32()), ("cost", pa.int64()), ("place", pa.int32()), ("edits", pa.string())])
_FACTS = pa.schema([("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()),
                    ("head", pa.string()), ("tail", pa.string()), ("options", pa.list_(_OPTION))])
_FACTS_SQL = "blank long, duplicate long, truncated long, illegal long, head string, tail string, options array<struct<before:int,after:int,cost:long,place:int,edits:string>>"


def _codes(rows: list[dict]) -> tuple[str, str]:
    """One character a row; '?' for initials that no repair keeps, 'x' for rows that must go."""
    return "".join(r["initial"] if r["initial"] in ("s", "u", "a") else "?" for r in rows), "".join("x" if r["fault"] in "bd" else r["fault"] for r in rows)


def _facts(rows: list[dict], single: bool) -> dict:
    """Counts of one conversation's rows in one partition, and its cheapest edits: from
    START to the end if these are all its rows, else between all states (``place`` orders
    the edits from one state)."""
    codes, marks = _codes(rows)
    faults = [r["fault"] for r in rows]
    found = []
    for p in [START] if single else STATES:
        some = [(q, *best) for q in ([END] if single else [*STATES, END]) if (best := repair_codes(codes, marks, p, q))]
        order = sorted(edits for _, _, edits in some)
        found += [{"before": p, "after": q, "cost": cost, "place": order.index(edits), "edits": edits} for q, cost, edits in some]
    return {"blank": faults.count("b"), "duplicate": faults.count("d"), "truncated": faults.count("t"), "head": rows[0]["initial"], "tail": rows[-1]["initial"],
            "illegal": sum(a["initial"] + b["initial"] not in LEGAL for a, b in zip(rows, rows[1:], strict=False)), "options": found}


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = [_facts(rows, single) for rows, single in zip(batch.column("rows").to_pylist(), batch.column("single").to_pylist(), strict=True)]
        facts = pa.Table.from_pylist(out, schema=_FACTS).combine_chunks()
        columns = [c.combine_chunks() for c in facts.columns]
        yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *_FACTS.names])


def _chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of conversations in several partitions: the states around each, and whether its
    first row cannot follow the last one before it."""
    for batch in batches:
        source, parts, befores, afters, crosses = [], [], [], [], []
        for i, blocks in enumerate(batch.column("blocks").to_pylist()):
            ways = [{(o["before"], o["after"]): (o["cost"], o["place"]) for o in b["options"] if (o["after"] == END) == (b is blocks[-1])} for b in blocks]
            states = chain(ways, START, {END: 0})[1]
            for k, b in enumerate(blocks):
                source.append(i)
                parts.append(b["part"])
                befores.append(states[k])
                afters.append(states[k + 1])
                crosses.append(int(k > 0 and blocks[k - 1]["tail"] + b["head"] not in LEGAL))
        yield pa.RecordBatch.from_arrays([batch.column("conv_id").take(pa.array(source, pa.int64())), *[pa.array(c, pa.int32()) for c in (parts, befores, afters, crosses)]],
                                         names=["c", "p", "b", "a", "crossing"])


def _row_edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pos, edits, roles = [], [], []
        for rows, before, some in zip(*[batch.column(c).to_pylist() for c in ("rows", "before", "edits")], strict=True):
            for r, (e, left) in zip(rows, edits_by_row(_codes(rows)[0], before, some), strict=True):
                pos.append(r["pos"])
                edits.append(e)
                roles.append(left)
        yield pa.RecordBatch.from_arrays([pa.array(pos, pa.int64()), pa.array(edits, pa.string()), pa.array(roles, pa.string())], names=["at", "edits", "roles"])


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cheapest repairs of conversations: (edits, report).

    ``rows`` has conv_id, turn, role and text (not NULL), the order columns role0 and
    text0, and copy, as ``damaged`` gives them. ``edits``, one row per edit in the order
    of (conv_id, pos, step): conv_id, pos, step, edit (D, I, K or R), turn (NULL for an
    inserted one), role and text, of deleted rows as they were. ``report``, one row per
    conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost.

    A NULL conv_id is a conversation of its own. Rows with equal turns follow one another
    by role and text, so ties don't depend on partitions. An empty table gives empty
    results. Only the columns named are read, so others can't clash.
    """
    turns = ordered(rows)
    kind = turns.schema["conv_id"].dataType.simpleString()
    codes = written(coded(turns), "codes")
    groups = (codes.groupBy("conv_id", "part").agg(F.sort_array(F.collect_list(F.struct("pos", "initial", "fault"))).alias("rows")))
    whole = Window.partitionBy("conv_id")
    groups = groups.withColumn("single", F.min("part").over(whole) == F.max("part").over(whole))
    schema = f"conv_id {kind}, part int, rows array<struct<pos:long,initial:string,fault:string>>, single boolean, {_FACTS_SQL}"
    blocks = written(groups.mapInArrow(_blocks, schema), "blocks")
    lean = F.transform("options", lambda o: F.struct(o["before"].alias("before"), o["after"].alias("after"), o["cost"].alias("cost"), o["place"].alias("place")))
    split = blocks.where("not single")
    chosen = (split.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("part", "head", "tail", lean.alias("options")))).alias("blocks"))
              .mapInArrow(_chosen, f"c {kind}, p int, b int, a int, crossing int"))
    best = F.when(F.col("single"), F.col("options")[0]).otherwise(F.filter("options", lambda o: (o["before"] == F.col("b")) & (o["after"] == F.col("a")))[0])
    solved = written(blocks.join(chosen, blocks["conv_id"].eqNullSafe(chosen["c"]) & (blocks["part"] == chosen["p"]), "left")
                     .select("conv_id", "rows", "blank", "duplicate", "truncated", (F.col("illegal") + F.coalesce("crossing", F.lit(0))).alias("illegal"), best.alias("best"))
                     .select("*", "best.before", "best.edits", "best.cost").drop("best"), "solved")
    each = solved.select("rows", "before", "edits").mapInArrow(_row_edits, "at long, edits string, roles string")
    edits = turns.join(each, turns["pos"] == each["at"]).select("conv_id", "turn", "role", "text", "pos", "roles", F.posexplode(F.split("edits", "")).alias("step", "edit"))
    left = F.substring(F.col("roles"), F.col("step") + 1, F.lit(1))
    inserted = F.col("edit") == "I"
    edits = edits.select("conv_id", "pos", "step", "edit", F.when(~inserted, F.col("turn")).alias("turn"),
                         F.when(F.col("edit").isin("I", "R"), F.when(left == "u", "user").otherwise("assistant")).otherwise(F.col("role")).alias("role"),
                         F.when(inserted, "").otherwise(F.col("text")).alias("text"))
    sums = solved.groupBy("conv_id").agg(*[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")])
    spans = codes.groupBy(F.col("conv_id").alias("c")).agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps"))
    report = sums.join(spans, sums["conv_id"].eqNullSafe(spans["c"])).select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return edits, report


def digests(edits: DataFrame) -> DataFrame:
    """conv_id, audit (edit initials in order) and repaired_sha256 (of the ``role:text``
    lines left) per conversation. A hash of one text is sequential, so the lines of a
    conversation stream through one task, sorted on disk; only its audit is held."""
    n = int(edits.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kind = edits.schema["conv_id"].dataType.simpleString()
    line = F.when(F.col("edit") != "D", F.concat("role", F.lit(":"), "text"))
    lines = edits.select("conv_id", "pos", "step", "edit", line.alias("line")).repartition(n, "conv_id").sortWithinPartitions("conv_id", "pos", "step").select("conv_id", "edit", "line")

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        now, audit, digest, first = None, [], None, True
        done: list[tuple] = []
        field = None

        def flush() -> pa.RecordBatch:
            ids, audits, hashes = zip(*done, strict=True)
            out = pa.RecordBatch.from_arrays([pa.array(ids, field), pa.array(audits, pa.string()), pa.array(hashes, pa.string())], names=["c", "audit", "repaired_sha256"])
            done.clear()
            return out

        for batch in batches:
            field = batch.schema.field(0).type
            for conv, edit, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if digest is None or conv != now:
                    if digest is not None:
                        done.append((now, "".join(audit), digest.hexdigest()))
                    now, audit, digest, first = conv, [], hashlib.sha256(), True
                audit.append(edit)
                if text is not None:
                    digest.update(text.encode() if first else b"\n" + text.encode())
                    first = False
            audit = ["".join(audit)]
            if done:
                yield flush()
        if digest is not None:
            done.append((now, "".join(audit), digest.hexdigest()))
            yield flush()

    return lines.mapInArrow(stream, f"c {kind}, audit string, repaired_sha256 string")


def audit(conversations: DataFrame) -> DataFrame:
    """Damage, repair and digest of every conversation: conv_id, gaps, blank, duplicate,
    truncated, illegal, cost, audit, repaired_sha256.

    NULL turns, roles and texts are read as one space where text is needed; NULL turns
    come first and don't count for gaps. A conversation without rows after the damage has
    zeros, an empty audit and the hash of the empty string."""
    edits, report = repair(damaged(conversations))
    digest = digests(edits)
    ids = conversations.select("conv_id").distinct()
    known = report.withColumnRenamed("conv_id", "r").join(digest, F.col("r").eqNullSafe(F.col("c")))
    empty = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"  # fixed value: SHA-256 of nothing
    return (ids.join(known, ids["conv_id"].eqNullSafe(F.col("r")), "left")
            .select("conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                    F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256")))
