"""URL filters: a bit-parallel wildcard automaton over canonical URLs.

Every rule becomes one or two glob patterns over ``.host/path``. A pattern of m
symbols takes m + 1 adjacent bits: bit i says "the first i symbols are read".
One step for character class c is

    state = ((state << 1) & reads[c]) | (state & stays[c])

with ``reads`` marking the symbols that accept c and ``stays`` the positions
behind a wildcard that accepts c. The masks span as many 64-bit words as the
rules need and one step advances all patterns of all URLs of a batch. Patterns
are packed best rule first, so the lowest accepting bit names the verdict.

In a glob ``*`` reads any run without ``/``, ``**`` any run, ``?`` one character
other than ``/``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.llm.common import ascii_lower

#: (action, host, path prefix)
PRODUCTION_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: Bytes that one batch of automaton states may take.
STATE_BYTES = 1 << 24


def url_host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; empty without ``://`` or for a NULL url."""
    rest = F.expr("substr({u}, instr({u}, '://') + 3)".format(u="__url"))
    return F.when(F.instr(url, "://") > 0, ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0))).otherwise("")


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    rest = F.expr("substr({u}, instr({u}, '://') + 3)".format(u="__url"))
    return F.when(F.instr(url, "://") > 0, F.regexp_extract(rest, r"^[^/?#]*(/[^?#]*)?", 1)).otherwise("")


@dataclass
class Automaton:
    """Packed masks of a rule list; ``rules`` is best first."""

    rules: list[tuple[str, str]]
    alphabet: np.ndarray
    reads: np.ndarray
    stays: np.ndarray
    start: np.ndarray
    accept: np.ndarray
    rule_of_bit: np.ndarray

    def matches(self, texts: Sequence[str]) -> np.ndarray:
        """Index of the best rule that reads each whole text, -1 without one."""
        out = np.full(len(texts), -1, np.int64)
        words = len(self.start)
        step = max(1, STATE_BYTES // (8 * words))
        order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
        for at in range(0, len(order), step):
            part = order[at:at + step]
            sizes = np.array([len(texts[i]) for i in part])
            codes = np.frombuffer("".join(texts[i] for i in part).encode("utf-32-le", "surrogatepass"), np.uint32)
            slot = np.searchsorted(self.alphabet, codes)
            slot[slot == len(self.alphabet)] = 0
            classes = np.where(self.alphabet[slot] == codes, slot + 1, 0)
            begin = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            state = np.repeat(self.start[None, :], len(part), axis=0)
            live = len(part)
            for pos in range(sizes[0] if len(part) else 0):
                while live and sizes[live - 1] <= pos:
                    live -= 1
                cls = classes[begin[:live] + pos]
                now = state[:live]
                moved = now << np.uint64(1)
                moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
                state[:live] = (moved & self.reads[cls]) | (now & self.stays[cls])
            hits = state & self.accept
            word = (hits != 0).argmax(axis=1)
            found = hits[np.arange(len(part)), word]
            lowest = found & (~found + np.uint64(1))
            bit = np.log2(np.maximum(lowest, 1).astype(np.float64)).astype(np.int64)
            out[part] = np.where(found != 0, self.rule_of_bit[np.minimum(word * 64 + bit, len(self.rule_of_bit) - 1)], -1)
        return out


def glob_symbols(glob: str) -> tuple[list[str], list[str]]:
    """(symbols, gaps): gaps[i] is '', '*' or '**', the wildcard after i symbols."""
    symbols, gaps, i = [], [""], 0
    while i < len(glob):
        if glob[i] == "*":
            wide = glob.startswith("**", i)
            gaps[-1] = "**" if wide or gaps[-1] == "**" else "*"
            i += 2 if wide else 1
        else:
            symbols.append(glob[i])
            gaps.append("")
            i += 1
    return symbols, gaps


def compile_globs(globs: Sequence[tuple[str, int]], rules: list[tuple[str, str]]) -> Automaton:
    """Pack (glob, rule index) pairs, best first."""
    parsed = [(*glob_symbols(g), rule) for g, rule in globs]
    alphabet = np.array(sorted({ord(s) for symbols, _, _ in parsed for s in symbols if s != "?"} | {ord("/")}), np.uint32)
    bits = max(1, sum(len(symbols) + 1 for symbols, _, _ in parsed))
    words = -(-bits // 64)
    reads = np.zeros((len(alphabet) + 1, words), np.uint64)
    stays = np.zeros_like(reads)
    start, accept = np.zeros(words, np.uint64), np.zeros(words, np.uint64)
    rule_of_bit = np.full(words * 64, -1, np.int64)
    slash = int(np.searchsorted(alphabet, ord("/"))) + 1
    base = 0
    for symbols, gaps, rule in parsed:
        start[base // 64] |= np.uint64(1 << base % 64)
        for i, gap in enumerate(gaps):
            word, mask = (base + i) // 64, np.uint64(1 << (base + i) % 64)
            if gap:
                stays[:, word] |= mask
                if gap == "*":
                    stays[slash, word] &= ~mask
            if i and symbols[i - 1] == "?":
                reads[:, word] |= mask
                reads[slash, word] &= ~mask
            elif i:
                reads[int(np.searchsorted(alphabet, ord(symbols[i - 1]))) + 1, word] |= mask
        end = base + len(symbols)
        accept[end // 64] |= np.uint64(1 << end % 64)
        rule_of_bit[end] = rule
        base = end + 1
    return Automaton(rules, alphabet, reads, stays, start, accept, rule_of_bit)


def compile_rules(rules: Sequence[tuple[str, str, str]]) -> Automaton:
    """Host rules as globs: the longest rule wins, then the longer host, then block."""
    ranked = sorted(rules, key=lambda r: (-len(r[1] + r[2]), -len(r[1]), r[0] != "block", r[1] + r[2]))
    globs: list[tuple[str, int]] = []
    for i, (_, host, path) in enumerate(ranked):
        tails = [path + "**"] if path.startswith("/") else ["", "/**"]
        globs += [(f"*.{host}{tail}", i) for tail in tails]
    return compile_globs(globs, [(action, host + path) for action, host, path in ranked])


def filter_urls(pages: DataFrame, url: str = "url", rules: Sequence[tuple[str, str, str]] = PRODUCTION_RULES,
                default: str = "allow") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict`` of each url.

    A rule (action, host, path) fits its host and all subdomains if the url's
    path starts with the rule's. The longest fitting rule gives the verdict;
    of equally long ones the one with the longer host, then the blocking one.
    A url that no rule fits has a NULL rule and the verdict ``default``.

    NULL urls and urls without ``://`` have an empty host and path, so no rule
    fits. Hosts keep ports and user parts as they are. Columns of ``pages`` that
    are called like a result column are replaced; repeated rows stay; an empty
    table gives an empty result. Nothing is shuffled. A very long url is matched whole;
    the urls of a batch step together, so it takes as many steps as it has characters.
    """
    automaton = compile_rules(rules)

    @F.pandas_udf("rule string, verdict string")
    def judged(host: pd.Series, path: pd.Series) -> pd.DataFrame:
        best = automaton.matches([f".{h}{p}" for h, p in zip(host, path, strict=True)])
        names = [automaton.rules[i] if i >= 0 else (default, None) for i in best]
        return pd.DataFrame({"rule": [r for _, r in names], "verdict": [v for v, _ in names]}, dtype=object)

    kept = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    parts = (pages.withColumn("__url", F.col(url))
             .select(*[F.col(f"`{c}`") for c in kept], url_host(F.col("__url")).alias("host"), url_path(F.col("__url")).alias("path")))
    return (parts.withColumn("__judged", judged("host", "path"))
            .select(*[F.col(f"`{c}`") for c in kept], "host", "path", "__judged.rule", "__judged.verdict"))


def keep_allowed(pages: DataFrame, **options) -> DataFrame:
    """The rows of ``pages`` whose url is not blocked, with their own columns."""
    judged = filter_urls(pages.withColumn("__row", F.struct(*[F.col(f"`{c}`") for c in pages.columns])), **options)
    return judged.where("verdict <> 'block'").select("__row.*")
