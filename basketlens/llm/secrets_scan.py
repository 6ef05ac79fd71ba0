"""Secret scans through a trigram inverted index, with DataFrame functions only.

Each rule's regular expression yields a Boolean query over lower-cased trigrams:
whatever matches must contain, for every run of literal text in the expression,
all trigrams of one of the run's spellings. Documents post the trigrams that the
rules mention; the postings of a document are intersected by the rules' queries;
only rules whose query holds are verified on the text. A rule without a mandatory
trigram scans every text.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Spellings of a literal run that a query keeps apart; larger runs are cut.
SPELLINGS = 16
#: Characters of a class that count as literal.
CLASS_CHARS = 6
#: Matches whose positions are summed in one step.
BLOCK = 256


@dataclass(frozen=True)
class Rule:
    """A kind of secret. ``group`` and ``shortest``: the part of a match that must
    have so many characters, else the match is dropped."""

    kind: str
    pattern: str
    group: int = 0
    shortest: int = 1


def either_case(words: str) -> str:
    return re.sub("[a-z]", lambda m: f"[{m[0]}{m[0].upper()}]", words)


# The base rules come first and in this order.
BASE_RULES = (
    Rule("assign", f"({either_case('password|passwd|secret|token|api_?key')})[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    Rule("access", "AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", "[0-9a-f]+", 0, 24),
)
MORE_RULES = (
    Rule("github", "gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]+", 0, 20),
    Rule("webtoken", "eyJ[A-Za-z0-9_-]+\\.eyJ[A-Za-z0-9_-]+\\.[A-Za-z0-9_-]+", 0, 32),
    Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
RULES = BASE_RULES + MORE_RULES

#: All of: for each run, one of: all trigrams of a spelling.
Query = list[list[list[str]]]


def trigram_query(pattern: str) -> Query:
    """The mandatory trigrams of a regular expression; empty if there are none."""
    parser = re._parser if sys.version_info >= (3, 11) else re.sre_parse
    query: Query = []
    run = _runs(parser.parse(pattern), {""}, query)
    _close(run, query)
    return query


def _close(run: set[str], query: Query) -> None:
    """End a run of literal text: its trigrams become mandatory if every spelling has some."""
    if run and all(len(s) >= 3 for s in run):
        query.append([sorted({s[i:i + 3] for i in range(len(s) - 2)}) for s in sorted(run)])


def _runs(nodes, run: set[str], query: Query) -> set[str]:
    """Extend the spellings of the current run by the nodes of an expression."""
    for op, value in nodes:
        spellings = _spellings(str(op), value)
        if spellings is not None and len(run) * len(spellings) <= SPELLINGS:
            run = {a + b for a in run for b in spellings}
            continue
        _close(run, query)
        run = {""}
        if spellings is not None and len(spellings) <= SPELLINGS:
            run = spellings
        elif str(op) == "SUBPATTERN" and not value[1] | value[2]:
            run = _runs(value[3], run, query)
        elif str(op) == "MAX_REPEAT" and value[0] >= 1:
            # at least one turn: what one turn must contain is mandatory
            _close(_runs(value[2], {""}, query), query)
    return run


def _spellings(op: str, value) -> set[str] | None:
    """All lower-cased strings of a node if they are few, else None."""
    if op == "LITERAL":
        return {chr(value).lower()}
    if op == "IN":
        out: set[str] = set()
        for kind, x in value:
            span = range(x, x + 1) if str(kind) == "LITERAL" else range(x[0], x[1] + 1) if str(kind) == "RANGE" else range(10**6)
            if len(span) > CLASS_CHARS:
                return None
            out |= {chr(c).lower() for c in span}
        return out if len(out) <= CLASS_CHARS else None
    if op == "SUBPATTERN" and not value[1] | value[2]:
        return _all_spellings(value[3])
    if op == "BRANCH":
        parts = [_all_spellings(p) for p in value[1]]
        return None if None in parts else set().union(*parts)
    if op == "MAX_REPEAT" and value[:2] == (0, 1):
        once = _all_spellings(value[2])
        return None if once is None else once | {""}
    return None


def _all_spellings(nodes) -> set[str] | None:
    out = {""}
    for op, value in nodes:
        part = _spellings(str(op), value)
        if part is None or len(out) * len(part) > SPELLINGS:
            return None
        out = {a + b for a in out for b in part}
    return out


def postings(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """(trigram, key): the inverted index over the trigrams that the rules mention."""
    wanted = sorted({t for r in rules for run in trigram_query(r.pattern) for spelling in run for t in spelling})
    if not wanted:
        return docs.select(F.lit("").alias("trigram"), "__key").limit(0)
    lowered = docs.select("__key", F.lower("text").alias("__lowered"))
    present = F.array_compact(F.array(*[F.when(F.contains("__lowered", F.lit(t)), F.lit(t)) for t in wanted]))
    return lowered.select(F.explode(present).alias("trigram"), F.col("__key"))


def candidates(index: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """(key, kinds): the postings of each document intersected by the rules' queries."""
    def holds(query: Query) -> Column:
        whole = F.lit(True)
        for run in query:
            any_of = F.lit(False)
            for spelling in run:
                all_of = F.lit(True)
                for t in spelling:
                    all_of &= F.array_contains("trigrams", t)
                any_of |= all_of
            whole &= any_of
        return whole

    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    kinds = F.array_compact(F.array(*[F.when(holds(q), F.lit(kind)) for kind, q in queries.items() if q], F.lit(None).cast("string")))
    return (index.groupBy("__key").agg(F.collect_set("trigram").alias("trigrams"))
            .select("__key", kinds.alias("__kinds")).where("size(__kinds) > 0"))


def _starts(gaps: Column, widths: Column) -> Column:
    """gaps[i] plus all widths before i, by sums over blocks and then within one."""
    blocks = F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.size(widths) / BLOCK).cast("int") - 1))

    def total(values: Column) -> Column:
        return F.aggregate(values, F.lit(0).cast("bigint"), lambda a, x: a + x)

    sums = F.transform(blocks, lambda b: total(F.slice(widths, b * BLOCK + 1, BLOCK)))
    before = F.transform(blocks, lambda b: total(F.slice(sums, F.lit(1), b)))
    return F.struct(before.alias("before"), gaps.alias("gaps"), widths.alias("widths"))


def _spans(kind_rank: int, sums: Column, lengths: Column, sizes: Column, shortest: int) -> Column:
    """(start, rank, end) of the matches of one kind whose measured part is long enough."""
    def one(width: Column, i: Column) -> Column:
        block = (i / BLOCK).cast("int")
        inside = F.aggregate(F.slice(sums["widths"], block * BLOCK + 1, i % BLOCK), F.lit(0).cast("bigint"), lambda a, x: a + x)
        start = F.element_at(sums["before"], block + 1) + inside + F.element_at(sums["gaps"], i + 1)
        return F.struct(start.alias("start"), F.lit(kind_rank).alias("rank"), (start + F.element_at(lengths, i + 1)).alias("end"),
                        (F.element_at(sizes, i + 1) >= shortest).alias("long"))

    every = F.when(F.size(lengths) > 0, F.transform(sums["widths"], one))
    kept = F.filter(every, lambda s: s["long"])
    plain = F.transform(kept, lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end")))
    return F.coalesce(plain, F.array().cast("array<struct<start:bigint,rank:int,end:bigint>>"))


def find_secrets(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """(row, spans): each row of ``docs`` as a struct, and (start, rank, end) of all secrets of
    the whole text, by start, then by the rule's rank in ``rules``; code points, end
    exclusive. Matches of a rule are leftmost and do not overlap; a match whose
    measured part is too short is dropped after it has used up its text.

    NULL and empty texts have no spans. Postings are keyed by doc_id, or by a hash
    of the text where that is NULL; rows that share a key share postings, which can
    only add candidates, since each candidate is verified on its own text. Every row
    keeps its columns.
    """
    # the row as one column, so that its own column names can't clash
    key = F.coalesce(F.col("doc_id").cast("bigint"), F.xxhash64("text")).alias("__key")
    found = candidates(postings(docs.select(key, "text"), rules), rules)
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), key)
    rows = keyed.join(found.hint("shuffle_hash"), "__key", "left").select("__row", "__kinds", F.coalesce("__row.text", F.lit("")).alias("__whole"))
    scans_fully = {r.kind for r in rules if not trigram_query(r.pattern)}
    none = F.array().cast("array<string>")
    rows = rows.select("*", *[
        F.when(F.lit(r.kind in scans_fully) | F.coalesce(F.array_contains("__kinds", r.kind), F.lit(False)),
               F.regexp_extract_all("__whole", F.lit(_searched(r)), F.lit(0))).otherwise(none).alias(f"__hits_{r.kind}") for r in rules])
    lengths = lambda values: F.transform(values, lambda x: F.length(x).cast("bigint"))
    some = lambda r, then: F.when(F.size(f"__hits_{r.kind}") > 0, then)
    rows = rows.select("__row", *[c for r in rules for c in (
        lengths(F.col(f"__hits_{r.kind}")).alias(f"__lengths_{r.kind}"),
        some(r, lengths(F.split("__whole", _searched(r), -1))).alias(f"__gaps_{r.kind}"),
        (some(r, lengths(F.regexp_extract_all("__whole", F.lit(r.pattern), F.lit(r.group)))) if r.group
         else lengths(F.col(f"__hits_{r.kind}"))).alias(f"__sizes_{r.kind}"))])
    rows = rows.select("*", *[
        some_sums.alias(f"__sums_{r.kind}") for r in rules for some_sums in [F.when(
            F.size(f"__lengths_{r.kind}") > 0,
            _starts(F.col(f"__gaps_{r.kind}"), F.zip_with(F.slice(f"__gaps_{r.kind}", 1, F.size(f"__lengths_{r.kind}")), F.col(f"__lengths_{r.kind}"), lambda g, h: g + h)))]])
    spans = [_spans(i, F.col(f"__sums_{r.kind}"), F.col(f"__lengths_{r.kind}"), F.col(f"__sizes_{r.kind}"), r.shortest) for i, r in enumerate(rules)]
    return rows.select(F.col("__row").alias("row"), F.array_sort(F.concat(*spans)).alias("spans"))


def _searched(rule: Rule) -> str:
    """A rule that measures whole matches of a prefix and one repeated class may
    look for long ones at once: a match takes the whole run, so a short one hides
    nothing. Other rules are searched as they are."""
    whole_run = re.fullmatch(r"((?:[A-Za-z]{4})?)(\[[^\]]+\])\+", rule.pattern)
    if not whole_run or rule.group:
        return rule.pattern
    return f"{whole_run[1]}{whole_run[2]}{{{rule.shortest - len(whole_run[1])},}}"


def scan(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_assign, n_access, n_hex, base_sha256
    (of the base spans as ``kind:start:end``, comma-joined) and spans (all kinds).

    See find_secrets for the order and for NULLs. Other columns are not read.
    """
    found = find_secrets(docs.select("doc_id", "text"), rules)
    named = F.array(*[F.lit(r.kind) for r in rules])

    def written_out(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(named, s["rank"] + 1), s["start"], s["end"])), ",")

    def count(rank: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["rank"] == rank)).cast("bigint")

    base = F.filter("spans", lambda s: s["rank"] < len(BASE_RULES))
    return found.select("row.doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                        F.sha2(written_out(base), 256).alias("base_sha256"), written_out(F.col("spans")).alias("spans"))


def mask_secrets(docs: DataFrame, rules: Sequence[Rule] = RULES, mask: str = "<secret>") -> DataFrame:
    """``docs`` with every secret span of the text replaced by ``mask``; overlapping
    spans become one mask. A column ``n_chars`` gets the new length of a changed
    text. Texts without secrets, and all other columns, stay as they are."""
    found, text = find_secrets(docs, rules), F.col("row.text")
    state = F.struct(F.lit(0).cast("bigint").alias("pos"), F.array().cast("array<string>").alias("parts"))

    def step(acc: Column, s: Column) -> Column:
        part = F.concat(F.substr(text, (acc["pos"] + 1).cast("int"), (s["start"] - acc["pos"]).cast("int")), F.lit(mask))
        parts = F.when(s["start"] >= acc["pos"], F.concat(acc["parts"], F.array(part))).otherwise(acc["parts"])
        return F.struct(F.greatest(acc["pos"], s["end"]).alias("pos"), parts.alias("parts"))

    masked = F.aggregate("spans", state, step, lambda acc: F.concat(F.array_join(acc["parts"], ""), F.substr(text, (acc["pos"] + 1).cast("int"), F.length(text))))
    changed = F.size("spans") > 0
    fields = {c: F.col(f"row.`{c}`") for c in docs.columns}
    fields["text"] = F.when(changed, masked).otherwise(text)
    if "n_chars" in docs.columns:
        fields["n_chars"] = F.when(changed, F.length(masked).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("row.n_chars"))
    return found.select(*[field.alias(c) for c, field in fields.items()])
