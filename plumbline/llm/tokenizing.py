"""Encoding of a corpus with a public byte-level pair-merge vocabulary, and streaming decoding.

The merges are compiled into a finite-state transducer that reads bytes from left to right. A configuration is (last
finished token, place in the trie of tokens, tokens not yet emitted). One byte moves each configuration down the trie and,
where a token ends that may follow the last one, opens the configuration of the finished prefix; every prefix of a word
has exactly one. States are sets of configurations and are determinised when first met; a transition emits the tokens on
which all configurations agree, so the lookahead is bounded by the longest token. Whether a token may follow another is
decided by undoing the merges of both at their common border, latest first: the pair may stand if no merge across the
border would have come earlier.

Defined cases: null and empty texts have the empty list of ids; texts of any length are encoded whole; strings that look
like special tokens are ordinary text. Memos are bounded and only save time: they are emptied when full.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fixed value: the pattern that splits text into words before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MAX_STATES = 120_000
MAX_WORDS = 400_000
_NEVER = 1 << 60


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    """The installed vocabulary of that name."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in the vocabulary file, reversed."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Transducer:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        letters, vocab = _byte_letters(), model["vocab"]
        self.bytes_of = {i: bytes(letters[c] for c in token) for token, i in vocab.items()}
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}  # token: rank of the merge that makes it, left, right
        for rank, (a, b) in enumerate(m if isinstance(m, list) else m.split(" ") for m in model["merges"]):
            pair, whole = (vocab[a], vocab[b]), vocab[a + b]
            self.merge.setdefault(pair, (rank, whole))
            self.parts.setdefault(whole, (rank, *pair))
        self.children: list[dict[int, int]] = [{}]
        self.ends: list[int] = [-1]
        for token in sorted(self.bytes_of):
            node = 0
            for b in self.bytes_of[token]:
                if b not in self.children[node]:
                    self.children[node][b] = len(self.children)
                    self.children.append({})
                    self.ends.append(-1)
                node = self.children[node][b]
            self.ends[node] = token
        self.pattern = regex.compile(PATTERN)
        self.words: dict[str, tuple[int, ...]] = {}
        self.follows: dict[tuple[int, int], bool] = {}
        self._forget()

    def _forget(self) -> None:
        self.states: list[tuple[tuple[int, int, tuple[int, ...]], ...]] = [((-1, 0, ()),)]
        self.numbers = {self.states[0]: 0}
        self.moves: list[dict[int, tuple[int, tuple[int, ...]]]] = [{}]

    def may_follow(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both tokens leaves exactly these two."""
        known = self.follows.get((left, right))
        if known is not None:
            return known
        a, b, before, result = left, right, _NEVER, True
        while True:
            rank = self.merge.get((a, b), (_NEVER, 0))[0]
            if rank < before:  # this merge would have come while both stood side by side
                result = False
                break
            ra, rb = self.parts.get(a, (-1,))[0], self.parts.get(b, (-1,))[0]
            if ra < 0 and rb < 0:
                break
            if ra > rb:  # if one merge made both, the left one came first, so the right one is undone first
                before, a = ra, self.parts[a][2]
            else:
                before, b = rb + 1, self.parts[b][1]  # the same merge further left takes precedence
        if len(self.follows) > 4_000_000:
            self.follows.clear()
        self.follows[left, right] = result
        return result

    def _determinise(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        configs = []
        for last, node, out in self.states[state]:
            child = self.children[node].get(byte)
            if child is None:
                continue
            token = self.ends[child]
            if token >= 0 and (last < 0 or self.may_follow(last, token)):
                configs.append((token, 0, (*out, token)))
            if self.children[child]:
                configs.append((last, child, out))
        agreed = 0
        outs = [c[2] for c in configs]
        while all(len(o) > agreed for o in outs) and len({o[agreed] for o in outs}) == 1:
            agreed += 1
        key = tuple(sorted((last, node, out[agreed:]) for last, node, out in configs))
        number = self.numbers.get(key)
        if number is None:
            number = self.numbers[key] = len(self.states)
            self.states.append(key)
            self.moves.append({})
        move = self.moves[state][byte] = (number, outs[0][:agreed])
        return move

    def encode_word(self, word: bytes) -> tuple[int, ...]:
        """Ids of one word, a byte at a time."""
        if len(self.states) > MAX_STATES:
            self._forget()
        state, out, moves = 0, [], self.moves
        for byte in word:
            move = moves[state].get(byte) or self._determinise(state, byte)
            state = move[0]
            out += move[1]
        return (*out, *next(rest for _, node, rest in self.states[state] if node == 0))

    def encode(self, text: str) -> list[int]:
        words, out = self.words, []
        for word in self.pattern.findall(text):
            ids = words.get(word)
            if ids is None:
                ids = self.encode_word(word.encode())
                if len(word) <= 64:
                    if len(words) >= MAX_WORDS:
                        words.clear()
                    words[word] = ids
            out += ids
        return out

    def decode(self, ids: list[int]) -> str:
        stream = Utf8Stream()
        return "".join(stream.feed(self.bytes_of[i]) for i in ids) + stream.end()


class Utf8Stream:
    """Incremental UTF-8 decoding: characters come out as soon as their last byte has been read."""

    def __init__(self) -> None:
        self.need, self.value, self.low, self.high = 0, 0, 0x80, 0xBF

    def feed(self, data: bytes) -> str:
        out = []
        for b in data:
            if self.need and not self.low <= b <= self.high:
                out.append("�")
                self.need = 0
            if self.need:
                self.value, self.low, self.high = self.value << 6 | b & 0x3F, 0x80, 0xBF
                self.need -= 1
                if not self.need:
                    out.append(chr(self.value))
            elif b < 0x80:
                out.append(chr(b))
            elif 0xC2 <= b < 0xF5:
                self.need = 1 if b < 0xE0 else 2 if b < 0xF0 else 3
                self.value = b & (0x3F >> self.need)
                self.low, self.high = {0xE0: (0xA0, 0xBF), 0xED: (0x80, 0x9F), 0xF0: (0x90, 0xBF), 0xF4: (0x80, 0x8F)}.get(b, (0x80, 0xBF))
            else:
                out.append("�")
        return "".join(out)

    def end(self) -> str:
        return "�" if self.need else ""


@lru_cache(maxsize=4)
def transducer(path: str) -> Transducer:
    """One compiled vocabulary for each Python worker."""
    return Transducer(path)


def token_ids(df: DataFrame, key: str, text: str, path: str | None = None) -> DataFrame:
    """(key, ids) of every row, by the vocabulary file at ``path`` (the same place on every machine)."""
    path = path or vocabulary_path()

    def encode(texts: pa.Array) -> pa.Array:
        machine, counts, flat = transducer(path), [0], []
        for value in texts:
            flat.append(np.array(machine.encode(s), np.int32) if (s := value.as_py()) else np.empty(0, np.int32))
            counts.append(counts[-1] + len(flat[-1]))
        values = np.concatenate(flat) if flat else np.empty(0, np.int32)
        return pa.ListArray.from_arrays(pa.array(counts, pa.int32()), pa.array(values, pa.int32()))

    return df.select(F.col(f"`{key}`").alias(key), F.arrow_udf(encode, T.ArrayType(T.IntegerType()))(F.col(f"`{text}`")).alias("ids"))
