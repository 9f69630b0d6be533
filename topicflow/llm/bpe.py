"""Byte-level BPE by speculation and verification, and its decoding.

A text is cut into special tokens and words as the tokenizer file says.  A word's tokens
are guessed greedily, the longest vocabulary entry first.  A sequence of tokens is the
word's encoding exactly if every adjacent pair is the encoding of the pair's own bytes,
so all adjacent pairs of a batch's new words are tested together in numpy arrays: undo
the later merge of the two tokens at a boundary again and again, and see whether a merge
across the boundary would have come first.  Only words with a failing pair are merged
step by step.  A task remembers the words it has met, up to a bound.

The vocabulary is read on the driver and sent to the executors; its size is that of the
tokenizer file, whatever the data.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import struct
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import chain, islice

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F

from topicflow.llm.common import T, fresh_name, shared

#: Fixed value: how a byte-level tokenizer cuts text into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same words in a text of ASCII only, for the standard library's quicker matcher.
ASCII_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+"
#: Words a task remembers before it forgets those it has not met since the last time.
MAX_REMEMBERED = 1 << 18
#: Words that are encoded at a time.
BLOCK_WORDS = 1 << 17
#: Characters from which a text's words are not listed all at once.
LONG_TEXT = 1 << 20
#: Words of up to so many bytes are merged side by side or by scanning, longer ones with a heap.
SCAN_BYTES = 48
#: Words are merged side by side with others of up to the same width, so many at a time.
MERGE_WIDTHS = (8, 12, 16, 24, SCAN_BYTES)
MERGE_ROWS = 1 << 12
NEVER = int(np.iinfo(np.int64).max)
#: Between words, as a character that stands for no byte.
GAP = "\u0100"


def byte_letters() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary: itself where printable, else the next free one from 256."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


@dataclass
class Vocabulary:
    """What the tokenizer file holds, in bytes."""

    tokens: dict[bytes, int]
    merges: list[tuple[bytes, bytes]]
    #: Strings that are cut out of a text first, with their ids.
    added: dict[str, int]
    coder: Coder | None = None


def load_vocabulary(path: str) -> Vocabulary:
    """Read a tokenizers JSON file with a byte-level BPE model."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, cutter = spec["model"], spec["pre_tokenizer"]
    plain = (
        model["type"] == "BPE"
        and spec["normalizer"] is None
        and cutter["type"] == "ByteLevel"
        and not cutter["add_prefix_space"]
        and cutter["use_regex"]
        and not model.get("ignore_merges")
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"])
    )
    if not plain:
        raise ValueError(f"{path} is not a plain byte-level BPE")
    byte = {c: b for b, c in byte_letters().items()}

    def as_bytes(token: str) -> bytes:
        return bytes(byte[c] for c in token)

    added = {t["content"]: t["id"] for t in spec["added_tokens"]}
    tokens = {as_bytes(t): i for t, i in model["vocab"].items() if t not in added}
    pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
    return Vocabulary(tokens, [(as_bytes(a), as_bytes(b)) for a, b in pairs], added)


class Coder:
    """Encodes and decodes; built from a vocabulary once per task."""

    def __init__(self, vocabulary: Vocabulary):
        self.tokens = vocabulary.tokens
        self.added = vocabulary.added
        self.pattern, self.ascii_pattern = regex.compile(WORDS), re.compile(ASCII_WORDS)
        self.cut = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        ids = self.tokens
        self.pieces = pieces(vocabulary)
        size = len(self.pieces)
        self.single = [ids.get(bytes([b]), -1) for b in range(256)]
        if -1 in self.single:
            raise ValueError("the vocabulary lacks single bytes")

        #: By pair (first * size + second): rank and outcome as one number, so that the least is the first.
        self.size = size
        self.merged: dict[int, int] = {}
        rank, left, right = np.zeros(size, np.int64), np.arange(size), np.arange(size)
        ordered = True
        for r, (a, b) in enumerate(vocabulary.merges, 1):
            i, j, k = ids[a], ids[b], ids[a + b]
            self.merged.setdefault(i * size + j, r << 32 | k)
            ordered &= not rank[k] and rank[i] < r and rank[j] < r and (len(a) == 1 or rank[i] > 0) and (len(b) == 1 or rank[j] > 0)
            if not rank[k]:
                rank[k], left[k], right[k] = r, i, j
        #: Undoing merges from the latest is only right where parts are made before wholes, one way each.
        self.speculate = ordered
        self.rank, self.left, self.right = rank, left, right
        keys = np.array(list(self.merged), np.int64)
        order = np.argsort(keys)
        self.pair_keys = keys[order]
        self.pair_outcomes = np.array(list(self.merged.values()), np.int64)[order]
        self.pair_ranks = self.pair_outcomes >> 32

        reachable = ids.items()
        if ordered:
            reachable = [(t, i) for t, i in ids.items() if len(t) == 1 or rank[i]]
        self.guesses = dict(reachable)
        if ordered:  # an entry that its own bytes do not encode to must not be guessed
            whole = np.array([i for t, i in self.guesses.items() if len(t) > 1], np.int64)
            for i in whole[~self.compatible(left[whole], right[whole], rank[whole])].tolist():
                del self.guesses[self.pieces[i]]
        #: Finds the longest entry at each place in turn; a byte is one character here.
        self.longest = ahocorasick.Automaton()
        for token, i in self.guesses.items():
            self.longest.add_word(token.decode("latin-1"), i)
        self.longest.make_automaton()
        self.lengths = np.array([len(p) for p in self.pieces])
        #: Words met lately, and those met before them; a word that is met again moves from the second to the first.
        self.remembered: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def compatible(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray | int = NEVER) -> np.ndarray:
        """Whether no merge across the boundary of tokens ``a`` and ``b`` comes before those that make them.

        ``limit``: the first rank at which a merge of the two tokens themselves is no fault.
        """
        good = np.ones(len(a), bool)
        at, limit = np.arange(len(a)), np.broadcast_to(limit, len(a)).copy()
        while len(at):
            bad = self.outcomes(a, b) >> 32 < np.minimum(limit, NEVER >> 32)
            good[at[bad]] = False
            rank_a, rank_b = self.rank[a], self.rank[b]
            left_later = rank_a > rank_b
            more = ~bad & ((rank_a > 0) | (rank_b > 0))
            # equal merges go from left to right: one across the boundary precedes an equal one to its right
            limit = np.where(left_later, rank_a, rank_b + 1)[more]
            a, b = np.where(left_later, self.right[a], a)[more], np.where(left_later, b, self.left[b])[more]
            at = at[more]
        return good

    def outcomes(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank and outcome of merging each ``a`` and ``b``; ``NEVER`` where they do not merge."""
        if not len(self.pair_keys):
            return np.full(len(a), NEVER)
        key = a * self.size + b
        place = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[place] == key, self.pair_outcomes[place], NEVER)

    def guess(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The greedy tokens of all words, one word after the other, and the word each belongs to."""
        found = list(self.longest.iter_long(GAP.join([w.decode("latin-1") for w in words])))
        ends = np.fromiter((e for e, _ in found), np.int64, len(found))
        tokens = np.fromiter((t for _, t in found), np.int64, len(found))
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
        return tokens, np.searchsorted(np.cumsum(sizes), ends, "right")

    def merge(self, word: bytes) -> list[int]:
        """The encoding by merging step by step: the lowest rank first, then the leftmost."""
        parts = [self.single[b] for b in word]
        if len(parts) > SCAN_BYTES:
            return self._merge_long(parts)
        size, get = self.size, self.merged.get
        ranks = [get(a * size + b, NEVER) for a, b in zip(parts, parts[1:])]
        while ranks:
            best = min(ranks)
            if best == NEVER:
                break
            at = ranks.index(best)
            parts[at] = best & 0xFFFFFFFF
            del parts[at + 1], ranks[at]
            if at:
                ranks[at - 1] = get(parts[at - 1] * size + parts[at], NEVER)
            if at < len(ranks):
                ranks[at] = get(parts[at] * size + parts[at + 1], NEVER)
        return parts

    def merge_all(self, words: list[bytes]) -> list[bytes]:
        """The encodings of many words, as ids in four bytes each; words of like length are merged side by side."""
        found = [b""] * len(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        for i in np.flatnonzero(sizes > SCAN_BYTES).tolist():
            parts = self.merge(words[i])
            found[i] = struct.pack(f"<{len(parts)}I", *parts)
        low = -1
        for width in MERGE_WIDTHS:
            at = np.flatnonzero((sizes > low) & (sizes <= width))
            low = width
            for start in range(0, len(at), MERGE_ROWS):
                own = at[start : start + MERGE_ROWS]
                parts = self._merge_rows([words[i] for i in own.tolist()], sizes[own], width)
                live = parts >= 0
                data, ends = parts[live].astype("<u4").tobytes(), (4 * np.cumsum(live.sum(axis=1))).tolist()
                for i, a, b in zip(own.tolist(), [0, *ends], ends):
                    found[i] = data[a:b]
        return found

    def _merge_rows(self, words: list[bytes], sizes: np.ndarray, width: int) -> np.ndarray:
        """The tokens of words of at most ``width`` bytes, a word in each row, -1 where there is none.

        Every round does each word's first merge: the lowest rank, then the leftmost place.
        """
        n, across = len(words), width + 2  # a column at each end stands for no token
        letters = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(n, width)
        parts = np.full((n, across), -1, np.int64)
        parts[:, 1:-1] = np.where(np.arange(width) < sizes[:, None], np.array(self.single, np.int64)[letters], -1)
        first = np.full((n, across), NEVER)
        row, column = np.nonzero(parts[:, 1:] >= 0)
        pair = column + 1 < sizes[row]
        row, column = row[pair], column[pair] + 1
        first[row, column] = self.outcomes(parts[row, column], parts[row, column + 1])
        parts, first = parts.ravel(), first.ravel()
        after, before = np.arange(1, n * across + 1), np.arange(-1, n * across - 1)
        rows = np.arange(n)
        while len(rows):
            best = first.reshape(n, across)[rows].argmin(axis=1)
            at = rows * across + best
            live = first[at] != NEVER
            rows, at = rows[live], at[live]
            gone = after[at]
            parts[at] = first[at] & 0xFFFFFFFF
            parts[gone] = -1
            first[gone] = NEVER
            right, left = after[gone], before[at]
            after[at], before[right] = right, at
            for x, y in ((at, right), (left, at)):
                both = (parts[x] >= 0) & (parts[y] >= 0)
                first[x[~both]] = NEVER
                x, y = x[both], y[both]
                first[x] = self.outcomes(parts[x], parts[y])
        return parts.reshape(n, across)

    def _merge_long(self, parts: list[int]) -> list[int]:
        n, size, merged = len(parts), self.size, self.merged
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pairs = ((i, a, b, a * size + b) for i, (a, b) in enumerate(zip(parts, parts[1:])))
        heap = [(merged[key] >> 32, i, merged[key] & 0xFFFFFFFF, a, b) for i, a, b, key in pairs if key in merged]
        heapq.heapify(heap)
        while heap:
            _, i, k, a, b = heapq.heappop(heap)
            j = after[i]
            if parts[i] != a or j >= n or parts[j] != b:
                continue
            parts[i], parts[j] = k, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n and (m := merged.get(parts[x] * size + parts[y])) is not None:
                    heapq.heappush(heap, (m >> 32, x, m & 0xFFFFFFFF, parts[x], parts[y]))
        return [p for p in parts if p >= 0]

    def learn(self, words: Iterable[str]) -> None:
        """Encode words that are not remembered, all of them together."""
        if len(self.remembered) > MAX_REMEMBERED:
            self.older, self.remembered = self.remembered, {}
        unmet = set(words).difference(self.remembered)
        again = unmet.intersection(self.older)
        self.remembered.update((w, self.older[w]) for w in again)
        new = list(unmet - again)
        if not new:
            return
        as_bytes = [w.encode() for w in new]
        if not self.speculate:
            self.remembered.update(zip(new, self.merge_all(as_bytes)))
            return
        flat, owner = self.guess(as_bytes)
        sizes = np.bincount(owner, minlength=len(new))
        covered = np.bincount(owner, self.lengths[flat], len(new))
        inside = np.flatnonzero(owner[1:] == owner[:-1])
        pairs, back = np.unique(flat[inside] << 32 | flat[inside + 1], return_inverse=True)
        good = self.compatible(pairs >> 32, pairs & 0xFFFFFFFF)[back]
        fails = covered != np.fromiter(map(len, as_bytes), np.int64, len(new))
        fails[owner[inside[~good]]] = True
        data, ends = flat.astype("<u4").tobytes(), (4 * np.cumsum(sizes)).tolist()
        self.remembered.update((w, data[a:b]) for w, a, b in zip(new, [0, *ends], ends))
        failing = np.flatnonzero(fails).tolist()
        self.remembered.update(zip((new[i] for i in failing), self.merge_all([as_bytes[i] for i in failing])))

    def _segments(self, text: str) -> Iterator[tuple[str, int | None]]:
        """(text, None) and (special token, its id) in turn."""
        at = 0
        for found in self.cut.finditer(text) if self.cut else ():
            yield text[at : found.start()], None
            yield found.group(), self.added[found.group()]
            at = found.end()
        yield text[at:], None

    def _parts(self, text: str) -> Iterator[list[str] | int]:
        """The text's blocks of words and special tokens."""
        for segment, special in self._segments(text):
            if special is not None:
                yield special
            elif len(segment) < LONG_TEXT:
                yield (self.ascii_pattern if segment.isascii() else self.pattern).findall(segment)
            else:
                words = (m.group() for m in self.pattern.finditer(segment))
                while block := list(islice(words, BLOCK_WORDS)):
                    yield block

    def encode_all(self, texts: Iterable[str]) -> Iterator[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        done: list[list[bytes]] = []  # what is encoded of each text since the last one handed on
        waiting: list[tuple[int, list[str] | int]] = []
        held = 0

        def encode_waiting() -> None:
            self.learn(chain.from_iterable(p for _, p in waiting if not isinstance(p, int)))
            for i, part in waiting:
                done[i].append(struct.pack("<I", part) if isinstance(part, int) else b"".join(map(self.remembered.__getitem__, part)))
            waiting.clear()

        for text in texts:
            done.append([])
            for part in self._parts(text):
                waiting.append((len(done) - 1, part))
                held += 1 if isinstance(part, int) else len(part)
                if held >= BLOCK_WORDS:
                    encode_waiting()
                    held = 0
            if not waiting:
                yield from map(b"".join, done)
                done.clear()
        encode_waiting()
        yield from map(b"".join, done)

    def encode(self, text: str) -> bytes:
        return next(self.encode_all([text]))

    def decode(self, ids: np.ndarray) -> str:
        return decoded(self.pieces, ids)


def pieces(vocabulary: Vocabulary) -> list[bytes]:
    """The bytes of each id."""
    whole = vocabulary.tokens | {token.encode(): i for token, i in vocabulary.added.items()}
    found = [b""] * (max(whole.values(), default=0) + 1)
    for token, i in whole.items():
        found[i] = token
    return found


def decoded(pieces: list[bytes], ids: np.ndarray) -> str:
    """The text of ids; bytes that are no UTF-8 become replacement characters, ids out of range nothing."""
    ids = np.asarray(ids, np.int64)
    ids = ids[(ids >= 0) & (ids < len(pieces))]
    return b"".join(map(pieces.__getitem__, ids.tolist())).decode("utf-8", "replace")


_SENT: dict[tuple[str, str, str], Callable] = {}


def _sent(spark: SparkSession, path: str, name: str, value: Callable[[Vocabulary], T]) -> Callable[[], T]:
    """A function for tasks that gives what is made of the vocabulary; it is sent once per application."""
    key = (spark.sparkContext.applicationId, path, name)
    if key not in _SENT:
        _SENT[key] = shared(spark, value(load_vocabulary(path)))
    return _SENT[key]


def _coders(spark: SparkSession, path: str) -> Callable[[], Coder]:
    """A function for tasks that gives the coder; a Python worker builds it once, whatever tasks it runs."""
    sent = _sent(spark, path, "vocabulary", lambda v: v)

    def coder() -> Coder:
        vocabulary = sent()
        if vocabulary.coder is None:
            vocabulary.coder = Coder(vocabulary)
        return vocabulary.coder

    return coder


def encode(df: DataFrame, path: str, text: str = "text", out: str = "ids") -> DataFrame:
    """Add the ids of ``text`` as an array of ints: null and empty texts have none.

    Each row is encoded by itself from its whole text.
    """
    coder = _coders(df.sparkSession, path)

    @F.arrow_udf("array<int>")
    def ids(texts: pa.Array) -> pa.Array:
        found = list(coder().encode_all(t.as_py() or "" for t in texts))
        ends = np.cumsum([0, *(len(b) // 4 for b in found)])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(found), "<i4")))

    # Spark repeats a deterministic function in each that uses its result, and handing ids on is cheaper than encoding again
    return df.withColumn(out, ids.asNondeterministic()(F.col(text)))


def decode(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add the text of an array of ids; null for null."""
    known = _sent(df.sparkSession, path, "pieces", pieces)  # all that decoding needs

    @F.arrow_udf("string")
    def texts(found: pa.Array) -> pa.Array:
        of, values, ends = known(), found.values.to_numpy(zero_copy_only=False), found.offsets.to_pylist()
        null = found.is_null().to_pylist()
        return pa.array([None if n else decoded(of, values[a:b]) for n, a, b in zip(null, ends, ends[1:])], pa.string())

    return df.withColumn(out, texts(F.col(ids)))


def with_digests(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Put ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` in the place of ``text``.

    Each text is encoded, and its ids decoded, in one go, so that neither ids nor decoded texts leave the task.  A
    null text is empty.  The columns must not be there already.
    """
    for name in ("n_tokens", "ids_sha256", "decoded_sha256"):
        if fresh_name(df, name) != name:
            raise ValueError(f"the table has a column {name} already")
    coder, found = _coders(df.sparkSession, path), fresh_name(df, "_found")

    @F.arrow_udf("struct<n_tokens: long, ids_sha256: string, decoded_sha256: string>")
    def digests(texts: pa.Array) -> pa.Array:
        own = coder()
        counts, ids, texts_back = [], [], []
        for data in own.encode_all(t.as_py() or "" for t in texts):
            counts.append(len(data) // 4)
            ids.append(hashlib.sha256(data).hexdigest())
            texts_back.append(hashlib.sha256(own.decode(np.frombuffer(data, "<u4")).encode()).hexdigest())
        columns = [pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(texts_back, pa.string())]
        return pa.StructArray.from_arrays(columns, ["n_tokens", "ids_sha256", "decoded_sha256"])

    rest = [F.col(f"`{c}`") for c in df.columns if c != text]
    return df.withColumn(found, digests(F.col(text))).select(*rest, f"{found}.*")
