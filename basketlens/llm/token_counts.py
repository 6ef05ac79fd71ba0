"""Token counts: greedy longest-match piece counts by a linear automaton.

The vocabulary is a trie. Each node holds a failure link and the number of
pieces popped when it is followed, so a text is read once, left to right, and a
count is added at each failure; no piece is ever built and no byte read twice.

For a trie node v with string s(v):

* if s(v) is a piece, the link leads to the root and one piece is popped;
* otherwise the links of v's parent are followed, adding what they pop, to the
  first node that has v's last byte as a child; that child is v's link;
* without such a node v has no link, and a word that gets stuck there has no
  split: it counts as one unknown piece.
"""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.llm.common import worker_cache

#: Words of which a worker remembers the count; beyond, it starts afresh.
MEMO_WORDS = 300_000
#: Longer words are counted but not remembered.
MEMO_WORD_BYTES = 64


class PieceCounter:
    """The automaton of a vocabulary of byte strings."""

    def __init__(self, pieces: Iterable[bytes]):
        self.child: list[dict[int, int]] = [{}]
        is_piece = [False]
        for piece in pieces:
            node = 0
            for byte in piece:
                nxt = self.child[node].get(byte)
                if nxt is None:
                    nxt = len(self.child)
                    self.child[node][byte] = nxt
                    self.child.append({})
                    is_piece.append(False)
                node = nxt
            is_piece[node] = node != 0
        self.link: list[int] = [-1] * len(self.child)
        self.pops: list[int] = [0] * len(self.child)
        queue = deque([0])
        while queue:
            node = queue.popleft()
            for byte, nxt in self.child[node].items():
                queue.append(nxt)
                if is_piece[nxt]:
                    self.link[nxt], self.pops[nxt] = 0, 1
                    continue
                at, popped = self.link[node], self.pops[node]
                while at >= 0 and byte not in self.child[at]:
                    popped += self.pops[at]
                    at = self.link[at]
                if at >= 0:
                    self.link[nxt], self.pops[nxt] = self.child[at][byte], popped
        self.memo: dict[bytes, int] = {}

    def count(self, word: bytes) -> int:
        """Pieces of the greedy longest-match split; 1 if there is none."""
        child, link, pops = self.child, self.link, self.pops
        node = total = 0
        for byte in word:
            nxt = child[node].get(byte)
            while nxt is None:
                total += pops[node]
                node = link[node]
                if node < 0:
                    return 1
                nxt = child[node].get(byte)
            node = nxt
        while node:
            total += pops[node]
            node = link[node]
            if node < 0:
                return 1
        return total

    def count_words(self, words: list[bytes]) -> int:
        """Sum over words, each read with a leading space."""
        memo, total = self.memo, 0
        for word in words:
            n = memo.get(word)
            if n is None:
                n = self.count(b" " + word)
                if len(word) <= MEMO_WORD_BYTES:
                    if len(memo) >= MEMO_WORDS:
                        memo.clear()
                    memo[word] = n
            total += n
        return total


def byte_level_pieces(path: str) -> list[bytes]:
    """The vocabulary of a byte-level tokenizer file as byte strings.

    Such files spell each byte as one printable character: bytes that print in
    Latin-1 stand for themselves, the others follow from code point 256 on.
    """
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    with open(path, encoding="utf-8") as f:
        model = json.load(f)
    special = {t["content"] for t in model.get("added_tokens", [])}
    return [bytes(byte_of[ch] for ch in piece) for piece in model["model"]["vocab"] if piece not in special]


def _counter(path: str) -> PieceCounter:
    kept = worker_cache("token_counts")
    if path not in kept:
        kept[path] = PieceCounter(byte_level_pieces(path))
    return kept[path]


def count_tokens(docs: DataFrame, vocabulary: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: the key, ``n_words`` and ``n_tokens``.

    Words are runs without ASCII white space (space, tab to carriage return);
    each is read as a space and its UTF-8 bytes and split greedily into the
    longest pieces of ``vocabulary``, a byte-level tokenizer file that every
    executor has at the same path. All 256 bytes are pieces there, so each word
    has a split. NULL and empty texts have no words and no tokens. Repeated rows
    and NULL keys stay rows of their own; other columns are not read; an empty table
    gives no rows. Nothing is shuffled. A very long text is split whole; the memory it
    takes is in proportion to the text.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(vocabulary)
        for batch in batches:
            words = [(t.as_py() or "").encode("utf-8", "surrogatepass").split() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(map(len, words), pa.int64()), pa.array(map(counter.count_words, words), pa.int64())],
                names=["key", "n_words", "n_tokens"])

    kind = docs.schema[key].dataType.simpleString()
    return (docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
            .mapInArrow(counted, f"key {kind}, n_words bigint, n_tokens bigint").withColumnRenamed("key", key))
