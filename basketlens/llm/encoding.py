"""Whole-text encoding with a public tokenizer file, by remembered runs.

Both kinds of BPE file first cut a text by a fixed pattern into runs of letters,
digits, marks or white space and encode each run by itself, so a worker can
remember the ids of runs and of short rows of runs. Texts whose characters all
lie below U+0180 are cut at spaces, stops and commas into units of whole runs;
only units not met before are cut by the same pattern, spelled out for that range,
and new runs are encoded together in long strings. For a byte-level file the units of
many texts are cut and told apart in Arrow, and each is looked up once for all of
them. A text where such a cut could fall within a run is cut by the pattern as a
whole. Any other text is encoded as one string, and so is a text that holds an added
token of the file (such as <|endoftext|>), which the tokenizer takes out before it cuts.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from basketlens.llm.common import worker_cache

#: Runs and units of a generation. A worker remembers two generations: when the
#: younger is full it becomes the older one, whose entries move up when met again.
MEMO_RUNS = 500_000
#: Longer ones are forgotten after the batch.
MEMO_RUN_CHARS = 48
#: Runs encoded in one call.
JOINED = 256
#: Characters of texts, about, whose units are told apart together.
CHARS_AT_ONCE = 1 << 23

# Letters, numbers and white space below U+0180, and the cutting
# patterns of byte-level and of word-end files.
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ſ"
NUMBERS = "0-9²³¹¼-¾"
SPACES = "\\t-\\r \\x85\\xa0"
BYTE_LEVEL = re.compile(f"'(?:s|t|re|ve|m|ll|d)| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[^{SPACES}{LETTERS}{NUMBERS}]+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+")
WORD_END = re.compile(f"'(?:s|t|re|ve|m|ll|d)|[{LETTERS}]+|[{NUMBERS}]|[^{SPACES}{LETTERS}{NUMBERS}]+")
#: Beyond the range, a capital whose small form is two characters, or a separator
#: that str.split() takes for white space and the patterns do not.
OTHER = re.compile("[^\\x00-\\x1b\\x20-\\u012f\\u0131-\\u017f]")
#: Those of ``OTHER`` that are ASCII.
BETWEENS = "\x1c\x1d\x1e\x1f"


#: A stop or comma beside another mark, with which it is one run, or in a byte-level
#: file after white space; a space before white space or the end.
MARK = f"[^{SPACES}{LETTERS}{NUMBERS}]"
TOUCHING = re.compile(f"[.,](?:(?={MARK})|(?<={MARK}[.,]))")
TOUCHING_OR_SPACED = re.compile(f"[.,](?:(?={MARK})|(?<=[^{LETTERS}{NUMBERS}][.,]))")
RARE_SPACES = "\t\v\f\r\x85\xa0"
#: Stands between units; ``OTHER`` finds it in a text.
BETWEEN = "\x1f"


#: The characters that stand for bytes in a byte-level file, with a blank for the line end between runs.
OWN = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
AS_BYTES = np.arange(256, dtype="<u2")
AS_BYTES[sorted(set(range(256)) - OWN)] = 256 + np.arange(256 - len(OWN))
APART = AS_BYTES.copy()
APART[ord("\n")] = ord(" ")


def _spell(text: str, table: np.ndarray) -> str:
    return table[np.frombuffer(text.encode(), np.uint8)].tobytes().decode("utf-16-le")


class Memo(dict):
    """Ids of units and runs. What an older generation has moves up when looked up; for what
    neither has, it keeps an empty array that ``Encoder`` fills and replaces in the same batch."""

    def __init__(self, older: dict[str, bytes]):
        super().__init__()
        self.older = older
        self.waiting: dict[str, bytearray] = {}

    def __missing__(self, unit: str) -> bytes | bytearray:
        ids = self.older.get(unit)
        if ids is not None:
            self[unit] = ids
            return ids
        ids = self[unit] = self.waiting[unit] = bytearray()
        return ids


class Units:
    """Plain texts cut before spaces, stops and commas, and the ids of each distinct unit."""

    def __init__(self, texts: list[str], memo: Memo):
        cut = pa.array(texts, pa.large_string())
        for mark in " .,":
            cut = pc.replace_substring(cut, mark, BETWEEN + mark)
        rows = pc.split_pattern(cut, BETWEEN)
        coded = rows.flatten().dictionary_encode()
        self.edges, self.units = rows.offsets.to_numpy(), coded.indices.to_numpy()
        self.ids = list(map(memo.__getitem__, coded.dictionary.to_numpy(zero_copy_only=False).tolist()))

    def joined(self) -> list[bytes]:
        """The ids of each text."""
        flat = np.frombuffer(b"".join(self.ids), "<u4")
        sizes = np.fromiter(map(len, self.ids), np.int64, len(self.ids)) // 4
        size = sizes[self.units]
        ends = np.concatenate([[0], np.cumsum(size)])
        places = np.repeat((np.cumsum(sizes) - sizes)[self.units] - ends[:-1], size)
        places += np.arange(ends[-1])
        raw = flat[places].tobytes()
        edges = (4 * ends[self.edges]).tolist()
        return [raw[a:b] for a, b in zip(edges, edges[1:], strict=False)]


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, WhitespaceSplit

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [token.content.lower() for token in self.tokenizer.get_added_tokens_decoder().values()]
        #: Characters one of which is in any text with an added token.
        self.signs = {form for content in self.added for form in (content[0], content[0].upper())}
        vocabulary = self.tokenizer.get_vocab()
        self.byte_level = not any(piece.endswith("</w>") for piece in vocabulary)
        #: Ids that begin with a space in a byte-level file, or end a run in the other kind.
        self.edge = np.zeros(max(vocabulary.values()) + 1, bool)
        self.edge[[i for piece, i in vocabulary.items() if (piece.startswith("Ġ") if self.byte_level else piece.endswith("</w>"))]] = True
        #: The model of a byte-level file, for runs that are cut and spelled as bytes already.
        self.model = self.spelled = None
        before = self.tokenizer.pre_tokenizer
        if self.byte_level and isinstance(before, ByteLevel) and not before.add_prefix_space and self.tokenizer.normalizer is None:
            self.model = self.tokenizer.model
            self.spelled = Tokenizer(self.model)
            self.spelled.pre_tokenizer = WhitespaceSplit()
        self.memo = Memo({})

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    @property
    def older(self) -> dict[str, bytes]:
        return self.memo.older

    def _words(self, runs) -> list[str]:
        """Those that are one run each, which ``edge`` tells from its neighbours."""
        if self.byte_level:
            return [r for r in runs if r[:1] == " " and r[1:].isalpha()]
        return [r for r in runs if r.isalpha()]

    def _learn(self, words: list[str], rest: list[str]) -> None:
        """Put the ids of new runs into the memo. Words are encoded together: ids in ``edge`` show where one ends."""
        for at in range(0, len(words), JOINED):
            some = words[at:at + JOINED]
            if self.spelled is not None:
                encoded = self.spelled.encode_batch_fast([_spell("\n".join(some), APART)], add_special_tokens=False)
            else:
                encoded = self.tokenizer.encode_batch_fast([("" if self.byte_level else " ").join(some)], add_special_tokens=False)
            ids = np.array(encoded[0].ids, "<u4")
            cut = np.flatnonzero(self.edge[ids])
            cut = [*(cut * 4).tolist(), len(ids) * 4] if self.byte_level else [0, *((cut + 1) * 4).tolist()]
            if len(cut) == len(some) + 1:
                raw = ids.tobytes()
                self.memo.update(zip(some, [raw[a:b] for a, b in zip(cut, cut[1:], strict=False)], strict=True))
            else:
                rest = rest + some
        if self.model is not None:
            self.memo.update([(r, np.array([t.id for t in self.model.tokenize(_spell(r, AS_BYTES))], "<u4").tobytes()) for r in rest])
        else:
            encoded = self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)
            self.memo.update([(r, np.array(e.ids, "<u4").tobytes()) for r, e in zip(rest, encoded, strict=True)])

    def _together(self, text: str) -> bool:
        """Whether a text must be encoded as one."""
        if any(sign in text for sign in BETWEENS) if text.isascii() else OTHER.search(text):
            return True
        if any(sign in text for sign in self.signs):
            lower = text.lower()
            return any(content in lower for content in self.added)
        return False

    def _plain(self, text: str) -> bool:
        """Whether in a byte-level file no cut before a space, stop or comma falls within a run."""
        return not (text.endswith(" ") or "  " in text or " \n" in text or any(space in text and " " + space in text for space in RARE_SPACES) or TOUCHING_OR_SPACED.search(text))

    def _cut(self, text: str) -> list[str]:
        """Units of a text, each of whole runs."""
        if self.byte_level:
            return BYTE_LEVEL.findall(text)
        lower = text.lower()
        return WORD_END.findall(lower) if TOUCHING.search(lower) else lower.replace(".", " . ").replace(",", " , ").split()

    def _remember(self) -> list[str]:
        """Put the ids of the units that wait into the memo; gives those to forget after the batch."""
        memo, cut, waiting = self.memo, (BYTE_LEVEL if self.byte_level else WORD_END).findall, self.memo.waiting
        words = self._words(waiting)
        known, rest = set(words), []
        rows = {unit: cut(unit) for unit in waiting if unit not in known}
        for run in set().union(*rows.values()).difference(known):
            if run in memo.older:
                memo[run] = memo.older[run]
            elif run in waiting or run not in memo:
                rest.append(run)
        more = self._words(rest)
        words += more
        more = set(more)
        rest = [r for r in rest if r not in more]
        self._learn(words, rest)
        memo.update([(u, b"".join([memo[r] for r in row])) for u, row in rows.items() if len(row) != 1])
        for unit, ids in waiting.items():
            ids += memo[unit]
        memo.waiting = {}
        return [u for some in (words, rest, rows) for u in some if len(u) > MEMO_RUN_CHARS]

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.memo) > MEMO_RUNS:
            older = self.memo
            older.older = {}
            self.memo = Memo(older)
        out: list[bytes] = [b""] * len(texts)
        plain: list[list[int]] = []
        single, size = {}, CHARS_AT_ONCE
        # one look-up a unit: those not met before share an array that is filled afterwards
        try:
            for i, text in enumerate(texts):
                if self._together(text):
                    out[i] = self.whole(text)
                elif self.byte_level and self._plain(text):
                    if size >= CHARS_AT_ONCE:
                        plain.append([])
                        size = 0
                    plain[-1].append(i)
                    size += len(text)
                else:
                    single[i] = list(map(self.memo.__getitem__, self._cut(text)))
            groups = [(group, Units([texts[i] for i in group], self.memo)) for group in plain]
            forget = self._remember()
        except BaseException:
            self.memo = Memo({})  # never keep arrays that were not filled
            raise
        for i, ids in single.items():
            out[i] = b"".join(ids)
        for group, units in groups:
            for i, ids in zip(group, units.joined(), strict=True):
                out[i] = ids
        for unit in forget:
            self.memo.pop(unit, None)
        return out


def encoder(path: str) -> Encoder:
    """The encoder of this worker for a tokenizer file, which may lie elsewhere here."""
    kept = worker_cache("encoding")
    if path not in kept:
        if not os.path.exists(path):
            import public_tokenizers

            kept[path] = Encoder(public_tokenizers.path(os.path.basename(path)))
        else:
            kept[path] = Encoder(path)
    return kept[path]
