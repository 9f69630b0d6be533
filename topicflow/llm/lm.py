"""A hashed maximum-entropy language model with a class-factored softmax.

A word's probability is that of its class in the context, times that of the word in its
class.  The most frequent words are classes of their own; all others fall into classes by
a hash of their ending, so words that training has not seen have a class too.  The class
given the context is a softmax over sums of weight rows; a context's features (nothing,
the word before, the word two before as a skip, both words as an n-gram) are hashed to rows.
A word in its class is counted, with absolute discounting: what is taken from the words
seen goes to the one unseen word of the class, as in the base model.

Training goes over all training texts.  A context is the triple of its features' rows, so the
texts are first reduced to a table of counts of (context, class), which Spark keeps and which
grows with the word pairs of the texts.  What the counts give to the gradient is summed once;
each context is then kept once with its tokens, packed in blocks.  Each step sends the weights
out, tasks return the rows of what the model expects that their contexts touch, and the
difference moves the weights.  A step takes about 0.15 microseconds of a core per context: it sorts
contexts by each of their rows in turn, so that a row's sum is one product of a vector with a matrix.

Words are split, hashed and looked up many at a time; within a task they are held equal if their
XXH64 are, and Spark adds up and joins the words themselves.

Only the ``MAX_FREQUENT`` most frequent words travel to the tasks.  Counts of all others
are joined to the texts' rarer words by a shuffle, once per text and word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from topicflow.llm.common import shared, utf8, written

#: Words whose counts are sent to every task, at most.
MAX_FREQUENT = 1 << 16
#: Frequent words that are classes of their own, and classes of all other words.
SINGLES = 48
ENDINGS = 32
CLASSES = SINGLES + ENDINGS
ENDING_BYTES = 3
#: Rows of weights that features are hashed to.
BUCKETS = 1 << 13
#: Contexts: rows of the word before, of the word two before and of the two.
CONTEXTS = BUCKETS**3
STEPS = 30
RATE = 0.2
#: Strength of the pull towards weights of nothing, in tokens: rare contexts stay near the classes' frequencies.
RIDGE = 3.0
#: Contexts that a task of a step sorts at a time, and those of which it holds the classes' products: these stay in a core's cache.
STEP_CONTEXTS = 1 << 20
HELD_CONTEXTS = 1 << 10
#: Tokens whose contexts a task counts at a time, rows of weights in a bucket of contexts, and contexts of a bucket that a task merges at a time.
PIECE_TOKENS = 1 << 20
BUCKET_ROWS = 8
MERGED_CONTEXTS = 1 << 22
#: Contexts in a packed row: 10,000 rows, which Spark hands to Python at once, stay small.
PACKED_CONTEXTS = 1 << 7
#: Tasks of a step, at most: each returns a table of the weights' shape to the driver.
STEP_TASKS = 64
#: Weights' distances from their rows' largest, summed over a context's rows, that are far from where single precision ends.
SINGLE_SPREAD = 60
#: Bytes of texts that a task handles at a time, or one text; and whose words it counts at a time.
BLOCK_BYTES = 1 << 20
COUNTED_BYTES = 1 << 22
HASH_SEED = 42
#: The token after a text's last word: no word is empty.
END = b""


def tokens(text: bytes) -> list[bytes]:
    return [*text.lower().split(), END]  # on bytes: A-Z only, and white space is 0x20 and 0x09-0x0D


def ending_class(word: bytes) -> int:
    return SINGLES + xxhash.xxh64_intdigest(word[-ENDING_BYTES:], HASH_SEED) % ENDINGS


def _ending_column(word: str) -> Column:
    return F.lit(SINGLES) + F.pmod(F.xxhash64(F.substring(word, -ENDING_BYTES, ENDING_BYTES)), F.lit(ENDINGS)).cast("int")


#: What stands for the word before a text's first word; words hash with the seed, this is no word's hash but by chance.
START = np.uint64(0x5EED5EED5EED5EED)


def _rows(keys: np.ndarray) -> np.ndarray:
    keys = keys.astype(np.uint64)
    keys = (keys * np.uint64(0x9E3779B97F4A7C15)) ^ (keys >> np.uint64(7))
    keys = (keys * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(24)
    return (keys & np.uint64(BUCKETS - 1)).astype(np.int64)  # as BUCKETS is a power of two


BIAS = int(_rows(np.zeros(1, np.uint64))[0])


def word_hashes(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """XXH64 of each of the words that begin at ``starts`` in the bytes ``data``: as ``xxhash`` gives, many at a time."""
    out = np.empty(len(starts), np.uint64)
    order = np.argsort(np.minimum(sizes, 32).astype(np.uint8), kind="stable")
    ends = np.searchsorted(sizes[order], np.arange(33), "right") if len(order) else np.zeros(33, np.int64)
    lanes, halves = (np.ndarray((max(0, len(data) - n + 1),), f"<u{n}", data, strides=(1,)) if len(data) >= n else None for n in (8, 4))
    with np.errstate(over="ignore"):
        for size in range(32):
            own = order[ends[size - 1] if size else 0 : ends[size]]
            if not len(own):
                continue
            at = starts[own]
            h = np.full(len(own), HASH_SEED + _P[4] + size, np.uint64)
            for i in range(0, size - 7, 8):
                h = _turned(h ^ (_turned(lanes[at + i] * _U[1], 31) * _U[0]), 27) * _U[0] + _U[3]
            if size & 4:
                h = _turned(h ^ (halves[at + (size & 24)].astype(np.uint64) * _U[0]), 23) * _U[1] + _U[2]
            for i in range(size & 28, size):
                h = _turned(h ^ (data[at + i].astype(np.uint64) * _U[4]), 11) * _U[0]
            h = (h ^ (h >> np.uint64(33))) * _U[1]
            h = (h ^ (h >> np.uint64(29))) * _U[2]
            out[own] = h ^ (h >> np.uint64(32))
    for i in order[ends[31] :].tolist():  # words of 32 bytes and more
        out[i] = xxhash.xxh64_intdigest(data[starts[i] : starts[i] + sizes[i]], HASH_SEED)
    return out


#: The constants of XXH64.
_P = (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)
_U = tuple(np.uint64(p) for p in _P)


def _turned(h: np.ndarray, bits: int) -> np.ndarray:
    return (h << np.uint64(bits)) | (h >> np.uint64(64 - bits))


def feature_rows(contexts: np.ndarray) -> np.ndarray:
    """The rows of each context's four features: nothing, the word before, the word two before, both."""
    contexts = np.asarray(contexts, np.int64)
    one, rest = np.divmod(contexts, BUCKETS * BUCKETS)
    two, both = np.divmod(rest, BUCKETS)
    return np.stack([np.full_like(contexts, BIAS), one, two, both])


def log_classes(weights: np.ndarray, contexts: np.ndarray) -> np.ndarray:
    """Natural log probability of each class in each context."""
    z = weights[feature_rows(contexts)].sum(axis=0)
    z -= z.max(axis=1, keepdims=True)
    return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


class Model:
    """What tasks need of the model; its size has a bound."""

    def __init__(self, frequent: list[tuple[bytes, int]], total: int, distinct: int):
        self.total, self.distinct = total, distinct
        frequent = sorted(frequent, key=lambda x: (-x[1], x[0]))
        self.singles = [w for w, _ in frequent[:SINGLES]]
        self.index = {w: i for i, (w, _) in enumerate(frequent)}
        self.hashes = np.array([xxhash.xxh64_intdigest(w, HASH_SEED) for w in self.index], np.uint64)
        self.counts = np.array([n for _, n in frequent], np.int64)
        self.classes = np.array([i if i < SINGLES else ending_class(w) for i, (w, _) in enumerate(frequent)], np.int64)
        #: Of each class: tokens, words and the discount.
        self.class_tokens = np.zeros(CLASSES)
        self.class_words = np.zeros(CLASSES)
        self.discounts = np.zeros(CLASSES)
        self.weights = np.zeros((BUCKETS, CLASSES), np.float32)

    def set_classes(self, rows: list) -> None:
        """From rows (class, tokens, words, once, twice)."""
        for c, n, v, once, twice in rows:
            self.class_tokens[c], self.class_words[c] = n, v
            if c >= SINGLES:
                self.discounts[c] = min(0.9, max(0.1, once / (once + 2 * twice) if once else 0.1))

    def in_class(self, classes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """log10 probability of words, seen ``counts`` times, in their classes."""
        n, v, d = self.class_tokens[classes], self.class_words[classes], self.discounts[classes]
        p = np.where(counts > 0, counts - d, d * v) / np.maximum(n, 1)
        return np.log10(np.where(n > 0, p, 1.0))


def _grouped(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A place of each run of equal hashes, and how long it is, once they are sorted by their upper bits: equal ones are one
    run, or a few where others share these bits."""
    low = np.uint64((1 << max(1, len(hashes) - 1).bit_length()) - 1)
    order = (np.sort((hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)) & low).astype(np.intp)
    hashes = hashes[order]
    first = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])) if len(hashes) else order
    return order[first], np.diff(np.append(first, len(hashes)))


class _Reader:
    """Gives words' classes and the numbers of the frequent words, or of the ``known`` most frequent, from the words' hashes of 64 bits."""

    def __init__(self, model: Model, known: int | None = None):
        self.hashes = model.hashes[:known]
        self.mask = (1 << max(8, 2 * len(self.hashes)).bit_length()) - 1
        self.table = np.full(self.mask + 1, -1, np.int32)
        left, slots = np.arange(len(self.hashes)), self._slots(self.hashes)
        while len(left):  # each takes the first free place from its own on
            free = self.table[slots] < 0
            self.table[slots[free]] = left[free]
            out = self.table[slots] != left
            left, slots = left[out], (slots[out] + 1) & self.mask

    def _slots(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(20)).astype(np.int64) & self.mask

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """The frequent words' numbers, -1 for others."""
        found, left, slots = np.full(len(hashes), -1, np.int64), np.arange(len(hashes)), self._slots(hashes)
        while len(left):
            held = self.table[slots]
            hit = (held >= 0) & (self.hashes[held] == hashes[left]) if len(self.hashes) else held >= 0
            found[left[hit]] = held[hit]
            on = ~hit & (held >= 0)
            left, slots = left[on], (slots[on] + 1) & self.mask
        return found

    def read(self, words: "_Words") -> tuple[np.ndarray, np.ndarray]:
        """The number and the class of each token."""
        numbers = self.numbers(words.hashes)
        single = (numbers >= 0) & (numbers < SINGLES)
        classes = np.where(single, numbers, ending_class(END))
        other = np.flatnonzero(~single[words.places])
        ending = np.minimum(words.word_sizes[other], ENDING_BYTES)
        hashes = word_hashes(words.data, words.starts[other] + words.word_sizes[other] - ending, ending)
        classes[words.places[other]] = SINGLES + (hashes % np.uint64(ENDINGS)).astype(np.int64)
        return numbers, classes


class _Words:
    """The tokens of texts that lie one after the other in ``data``, as positions and hashes."""

    def __init__(self, data: np.ndarray, begins: np.ndarray):
        """Text i is data[begins[i] : begins[i + 1]]."""
        inside, before = (data != 0x20) & (data - np.uint8(0x09) > 4), np.zeros(len(data) + 1, bool)  # white space is 0x20 and 0x09-0x0D
        before[1:] = inside
        fresh = np.zeros(len(data) + 1, bool)
        fresh[begins] = True
        now = np.append(inside, False)
        self.data = np.frombuffer(data.tobytes().lower(), np.uint8)
        self.starts = np.flatnonzero(now & (~before | fresh))
        self.word_sizes = np.flatnonzero(before & (~now | fresh)) - self.starts
        of_text = np.searchsorted(self.starts, begins)
        #: Tokens of each text, with its end, and the places of the words among the tokens.
        self.sizes = np.diff(of_text) + 1
        self.places = np.arange(len(self.starts)) + np.repeat(np.arange(len(self.sizes)), self.sizes - 1)
        self.hashes = np.full(len(self.starts) + len(self.sizes), xxhash.xxh64_intdigest(END, HASH_SEED), np.uint64)
        self.hashes[self.places] = word_hashes(self.data, self.starts, self.word_sizes)

    def bytes_of(self, tokens_: np.ndarray) -> list[bytes]:
        """The words that the tokens of these numbers are, b"" for a text's end."""
        word = np.full(len(self.hashes), -1, np.int64)
        word[self.places] = np.arange(len(self.places))
        word, data = word[tokens_], self.data.tobytes()
        out, held = [END] * len(word), np.flatnonzero(word >= 0)
        for at, start, size in zip(held.tolist(), self.starts[word[held]].tolist(), self.word_sizes[word[held]].tolist()):
            out[at] = data[start : start + size]
        return out


def context_rows(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The rows of each token's features but nothing, from the words' hashes; texts begin at ``starts`` and have a token at least."""
    one, two = np.empty_like(hashes), np.empty_like(hashes)
    one[1:], two[2:] = hashes[:-1], hashes[:-2]
    one[starts] = two[starts] = START
    second = starts + 1
    two[second[second < len(hashes)]] = START
    with np.errstate(over="ignore"):
        return np.stack([_rows(one * np.uint64(3) + np.uint64(1)), _rows(two * np.uint64(5) + np.uint64(2)), _rows((two * np.uint64(0x9E3779B97F4A7C15)) ^ one)])


def _room(rows: int, kind: np.dtype) -> np.ndarray:
    """An empty table of classes whose rows begin at a cache line's start: reading them takes a tenth less time."""
    size = rows * CLASSES * np.dtype(kind).itemsize
    held = np.empty(size + 64, np.uint8)
    start = -held.ctypes.data % 64
    return held[start : start + size].view(kind).reshape(rows, CLASSES)


def _placed(values: np.ndarray) -> np.ndarray:
    held = _room(len(values), values.dtype)
    held[:] = values
    return held


def scaled_exps(weights: np.ndarray) -> np.ndarray:
    """The exps of the weights, each row's from its largest on: the exp of a sum of rows is the product of the
    rows' exps, and what is taken from all of a row cancels in a context's sum."""
    return np.exp(weights.astype(np.float64) - weights.max(axis=1, keepdims=True))


def _kind(exps: np.ndarray) -> type:
    """The type that tasks take products of exps in: single precision, unless a context's product could vanish there."""
    least = np.sort(np.maximum(exps.min(axis=1), 1e-300))
    return np.float32 if -np.log(least[:3]).sum() - np.log(np.maximum(exps[BIAS].min(), 1e-300)) < SINGLE_SPREAD else np.float64


class _ClassScores:
    """log10 probabilities of tokens' classes in their contexts."""

    def __init__(self, weights: np.ndarray):
        exps = scaled_exps(weights)
        self.exps = _placed(exps.astype(_kind(exps)))
        self.biased = _placed(self.exps * self.exps[BIAS])
        self.weights = weights.astype(np.float64) - weights.max(axis=1, keepdims=True)
        self.held = [_room(HELD_CONTEXTS, self.exps.dtype) for _ in range(2)]
        self.ones = np.ones(CLASSES, self.exps.dtype)

    def log10(self, rows: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """Contexts are given as ``context_rows`` does."""
        sums = np.empty(len(classes))
        for low in range(0, len(sums), HELD_CONTEXTS):
            high = min(low + HELD_CONTEXTS, len(sums))
            q, other = (h[: high - low] for h in self.held)
            np.take(self.biased, rows[0, low:high], axis=0, out=q, mode="clip")  # other modes copy what they give
            for row in rows[1:]:
                np.take(self.exps, row[low:high], axis=0, out=other, mode="clip")
                q *= other
            sums[low:high] = q @ self.ones
        own = self.weights[BIAS].take(classes)
        for row in rows:
            own += self.weights.take(row * CLASSES + classes)
        return (own - np.log(sums)) / np.log(10)


def _blocks(batch: pa.RecordBatch, column: int, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int, _Words]]:
    """(first row, end row, their words) of runs of rows that hold about ``size`` bytes, or of one row."""
    texts = batch.column(column).cast(pa.large_binary())
    _, offsets, values = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    values, at = np.frombuffer(values or b"", np.uint8), 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        yield at, end, _Words(values[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at])
        at = end


# --- training ---------------------------------------------------------------------


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) over the bytes column ``text``; the end of a text is the empty word.

    In a block of texts, words are held equal if their hashes of 64 bits are; Spark adds up the words themselves.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, words in _blocks(batch, 0, COUNTED_BYTES):
                found, n = _grouped(words.hashes)
                yield pa.RecordBatch.from_arrays([pa.array(words.bytes_of(found), pa.binary()), pa.array(n, pa.int64())], names=["word", "n"])

    return texts.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _frequent(counts: DataFrame) -> list[tuple[bytes, int]]:
    """The most frequent words, ``MAX_FREQUENT`` at most: all from some count on."""
    level = F.floor(16 * F.log2("n")).cast("int")  # a level is a few per cent; there are a thousand at most
    sizes = {r["level"]: r["count"] for r in counts.groupBy(level.alias("level")).count().collect()}
    least, held = max(sizes, default=0) + 1, 0
    for at in sorted(sizes, reverse=True):
        held += sizes[at]
        if held > MAX_FREQUENT:
            break
        least = at
    return [(bytes(r["word"]), r["n"]) for r in counts.where(level >= least).collect()]


def _read_events(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The rows of each token's context and its class, a block of texts at a time."""
    reader = _Reader(model, SINGLES)
    for batch in batches:
        for _, _, words in _blocks(batch, 0):
            yield context_rows(words.hashes, np.cumsum(words.sizes) - words.sizes), reader.read(words)[1]


def _events(texts: DataFrame, model: Model) -> DataFrame:
    """(context, class, n) over all tokens: as rows, what ``_counted`` holds packed."""
    sent = shared(texts.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (one, two, both), classes in _read_events(batches, sent()):
            seen, n = np.unique(((one * BUCKETS + two) * BUCKETS + both) * CLASSES + classes, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(seen // CLASSES), pa.array((seen % CLASSES).astype(np.int32)), pa.array(n.astype(np.int64))], names=["context", "class", "n"])

    rows = texts.select("text").mapInArrow(run, "context long, class int, n long")
    return rows.groupBy("context", "class").agg(F.sum("n").alias("n"))


def _event_table(texts: DataFrame, model: Model) -> DataFrame:
    """The counts of (context, class), stored as the shuffle of their sums deals them: a task's share stays
    bounded as the texts grow, where a fixed number of tasks would each take a growing share."""
    return written(_events(texts, model), "events")


def _summed(rows: DataFrame) -> np.ndarray:
    """The sum of the (row, gradient) rows that tasks return, a table of weights' shape."""
    total = np.zeros((BUCKETS, CLASSES))
    for batch in rows.toArrow().to_batches():
        values = batch.column(1).flatten().to_numpy().reshape(-1, CLASSES)
        np.add.at(total, batch.column(0).to_numpy(), values)
    return total


def _touched(found: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The rows of a task's sums that are not all zero: what a task returns has a bound."""
    found = found.reshape(BUCKETS, CLASSES)
    touched = np.flatnonzero(found.any(axis=1))
    if not len(touched):
        return
    flat = pa.ListArray.from_arrays(pa.array(np.arange(len(touched) + 1) * CLASSES, pa.int32()), pa.array(found[touched].ravel()))
    yield pa.RecordBatch.from_arrays([pa.array(touched), flat], names=["row", "gradient"])


def _observed(events: DataFrame) -> np.ndarray:
    """The counted part of the gradient, which no step changes: the tokens of each class that each row's contexts hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(BUCKETS * CLASSES)
        for batch in batches:
            context, cls, n = (c.to_numpy() for c in batch.columns)
            flat = (feature_rows(context) * CLASSES + cls).ravel()
            found += np.bincount(flat, weights=np.tile(n.astype(np.float64), 4), minlength=BUCKETS * CLASSES)
        yield from _touched(found)

    return _summed(events.mapInArrow(run, "row long, gradient array<double>"))


def _cut(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """Binary values that lie one after the other in ``values``, from each of ``cuts`` to the next."""
    offsets = (cuts * values[:1].nbytes).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def _joined(column: pa.Array, kind: type) -> np.ndarray:
    """The values of a binary column, one after the other, where they lie."""
    column = column.cast(pa.large_binary())
    _, offsets, values = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(values or b"", np.uint8)[offsets[0] : offsets[-1]].view(kind) if len(offsets) else np.zeros(0, kind)


def _packed_arrays(rows: np.ndarray, n: np.ndarray) -> list[pa.Array]:
    """Contexts' rows (16 bits each, as ``BUCKETS`` is below 2**15), context by context, and their tokens."""
    cuts = np.append(np.arange(0, max(1, n.size), PACKED_CONTEXTS), n.size)
    return [_cut(np.ascontiguousarray(rows.T.astype(np.int16)), cuts), _cut(n, cuts)]


def _packed(events: DataFrame) -> DataFrame:
    """Each context once with its tokens, many in a row: the rows of its features but nothing, and its tokens, so that
    steps read few rows.  ``train`` takes them from ``_counted``, which packs the same from the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            context, n = (c.to_numpy() for c in batch.columns)
            yield pa.RecordBatch.from_arrays(_packed_arrays(feature_rows(context)[1:], n.astype(np.float64)), names=["rows", "tokens"])

    return events.groupBy("context").agg(F.sum("n").alias("n")).mapInArrow(run, "rows binary, tokens binary")


def _pieces(contexts: list[np.ndarray]) -> pa.RecordBatch:
    """What a task has of each bucket of contexts: the contexts in order, the row of the two words first, and their tokens."""
    keys = np.sort(np.concatenate(contexts))
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    n = np.diff(np.append(first, len(keys))).astype(np.int32)
    keys = keys[first]
    ends = np.searchsorted(keys, np.arange(1, BUCKETS // BUCKET_ROWS + 1) * (CONTEXTS // BUCKETS * BUCKET_ROWS))
    held = np.flatnonzero(np.diff(ends, prepend=0))

    cuts = np.append(0, ends[held])
    return pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), _cut(keys, cuts), _cut(n, cuts), pa.nulls(len(held), pa.binary())], names=_PIECE)


_PIECE = ["bucket", "contexts", "n", "observed"]
_PACKED = "bucket int, rows binary, tokens binary, observed binary"


def _merged(bucket: int, contexts: list[bytes], n: list[bytes], observed: np.ndarray | None) -> pa.RecordBatch:
    """A bucket's contexts, each once with its tokens, as ``_packed`` has them but for single precision, which steps take them in."""
    keys, n = np.frombuffer(b"".join(contexts), np.int64), np.frombuffer(b"".join(n), np.int32)
    order = np.argsort(keys, kind="stable")  # the pieces are in order: runs are merged
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    tokens_ = np.add.reduceat(n[order].astype(np.float64), first) if len(keys) else np.zeros(0)
    both, words = np.divmod(keys[first], BUCKETS * BUCKETS)
    rows, tokens_ = _packed_arrays(np.stack([*np.divmod(words, BUCKETS), both]), tokens_.astype(np.float32))
    observed = [None if observed is None else observed.tobytes()] + [None] * (len(rows) - 1)
    return pa.RecordBatch.from_arrays([pa.array([bucket] * len(rows), pa.int32()), rows, tokens_, pa.array(observed, pa.binary())], names=["bucket", "rows", "tokens", "observed"])


def _counted(texts: DataFrame, model: Model) -> DataFrame:
    """(bucket, rows, tokens, observed): packed contexts as ``_packed`` has them, and what the counts give to the gradient.

    Contexts are dealt by buckets of the row of their two words, a hash, which no frequent word makes
    large; ``observed`` holds the counted gradient of as many rows as a bucket has.  Tasks send pieces of
    buckets, not rows, so Spark shuffles few rows.  A bucket of more than ``MERGED_CONTEXTS`` is merged in
    parts: a context that is in two of them is worked on twice, and counts as often as it should.
    """
    sent = shared(texts.sparkSession, model)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, observed = [], 0, np.zeros(BUCKETS * CLASSES)
        for rows, classes in _read_events(batches, sent()):
            for row in rows:
                np.add.at(observed, row * CLASSES + classes, 1.0)
            observed[BIAS * CLASSES : (BIAS + 1) * CLASSES] += np.bincount(classes, minlength=CLASSES)
            one, two, both = rows
            held.append((both * BUCKETS + one) * BUCKETS + two)
            n += len(classes)
            if n >= PIECE_TOKENS:
                yield _pieces(held)
                held, n = [], 0
        if n:
            yield _pieces(held)
        observed = observed.reshape(-1, BUCKET_ROWS * CLASSES)
        touched = np.flatnonzero(observed.any(axis=1))
        arrays = [pa.array(touched.astype(np.int32)), *(pa.nulls(len(touched), pa.binary()) for _ in range(2)), pa.array([observed[b].tobytes() for b in touched.tolist()], pa.binary())]
        yield pa.RecordBatch.from_arrays(arrays, names=_PIECE)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, contexts, n, size, observed = None, [], [], 0, None
        for batch in batches:
            for bucket, own, own_n, gradient in zip(*(c.to_pylist() for c in batch.columns)):
                if at is not None and (bucket != at or size >= 8 * MERGED_CONTEXTS):
                    yield _merged(at, contexts, n, observed)
                    contexts, n, size, observed = [], [], 0, None
                at = bucket
                if gradient is not None:
                    observed = np.frombuffer(gradient) + (0 if observed is None else observed)
                if own is not None:
                    contexts.append(own)
                    n.append(own_n)
                    size += len(own)
        if at is not None:
            yield _merged(at, contexts, n, observed)

    pieces = texts.select("text").mapInArrow(count, "bucket int, contexts binary, n binary, observed binary")
    return pieces.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(merge, _PACKED)


def _observed_of(counted: DataFrame) -> np.ndarray:
    """The counted part of the gradient, which no step changes, from the buckets' shares."""
    total = np.zeros((BUCKETS // BUCKET_ROWS, BUCKET_ROWS * CLASSES))
    for batch in counted.where("observed is not null").select("bucket", "observed").toArrow().to_batches():
        for bucket, observed in zip(*(c.to_pylist() for c in batch.columns)):
            total[bucket] += np.frombuffer(observed)
    return total.reshape(BUCKETS, CLASSES)


class _Expectation:
    """Sums what the model expects of contexts: their tokens times their classes' probabilities, for each row.

    A row's sum is its own exps times the sum, over its contexts, of the context's share (its tokens by the
    sum of its products) times the product of the exps of its other rows.  So contexts are sorted by each of
    their three rows in turn; nothing is scattered, and no exp is taken per context.  ``found`` lacks the factor
    that a row's contexts share: its own exps and those of the row that all contexts have.
    """

    def __init__(self, exps: np.ndarray):
        self.exps, self.biased = _placed(exps), _placed(exps * exps[BIAS])
        self.found = np.zeros((BUCKETS, CLASSES))
        self.held = [_room(HELD_CONTEXTS, exps.dtype) for _ in range(2)]

    def add(self, pieces: list[list[np.ndarray]]) -> None:
        """Pieces of contexts, as the rows of the word before, of the word two before and of the two, and the tokens; empties the list."""
        *rows, tokens = (x[0] if len(x) == 1 else np.concatenate(x) for x in zip(*pieces))
        pieces.clear()
        shares = None
        for own, x, y in ((2, 0, 1), (0, 1, 2), (1, 0, 2)):
            key, order = rows[own], slice(None)
            if (key[1:] < key[:-1]).any():
                order = np.argsort(key, kind="stable")  # 16 bits each: a radix sort
                key = key[order]
            x, y = rows[x][order], rows[y][order]
            if shares is None:
                shares = np.empty(len(key), self.exps.dtype)
                held = tokens[order]
                self._sums(key, x, y, held, shares)
                shares[order] = held
                del held, tokens
            else:
                self._sums(key, x, y, shares[order])

    def _sums(self, key: np.ndarray, x: np.ndarray, y: np.ndarray, shares: np.ndarray, sums: np.ndarray | None = None) -> None:
        """Adds the rows' sums over contexts that are sorted by ``key``.  Where there is room for the contexts'
        ``sums`` of products, ``shares`` are their tokens as yet and are made shares."""
        starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        blocks = np.arange(0, len(key) + HELD_CONTEXTS, HELD_CONTEXTS)
        cuts = np.union1d(starts, blocks[:-1])
        lows, highs = (cuts % HELD_CONTEXTS).tolist(), ((np.append(cuts[1:], len(key)) - 1) % HELD_CONTEXTS + 1).tolist()
        of_block, keys = np.searchsorted(cuts, blocks).tolist(), key[cuts].tolist()
        parts = _room(len(cuts), self.exps.dtype)
        for block, low in enumerate(blocks[:-1].tolist()):
            high = min(low + HELD_CONTEXTS, len(key))
            q, other = (h[: high - low] for h in self.held)
            self.exps.take(x[low:high].astype(np.intp), axis=0, out=q, mode="clip")  # other modes copy what they give
            self.exps.take(y[low:high].astype(np.intp), axis=0, out=other, mode="clip")
            q *= other
            own, runs = shares[low:high], slice(of_block[block], of_block[block + 1])
            if sums is not None:
                total = sums[low:high]
                for a, b, row in zip(lows[runs], highs[runs], keys[runs]):
                    q[a:b].dot(self.biased[row], out=total[a:b])
                own /= total
            for a, b, part in zip(lows[runs], highs[runs], parts[runs]):
                own[a:b].dot(q[a:b], out=part)
        self.found[key[starts]] += np.add.reduceat(parts, np.searchsorted(cuts, starts), axis=0, dtype=np.float64)


def _expected(packed: DataFrame, weights: np.ndarray) -> np.ndarray:
    """The part of the gradient that the model expects: each context's tokens times its classes' probabilities."""
    context = packed.sparkSession.sparkContext
    exps = scaled_exps(weights)
    kind = _kind(exps)
    sent = context.broadcast(exps.astype(kind))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a context's gradient is linear in its tokens, so tasks and blocks that each hold part of them add up
        expectation, held, n = _Expectation(sent.value), [], 0
        for batch in batches:
            rows, counts = _joined(batch.column(0), np.int16), _joined(batch.column(1), np.uint8)
            counts = counts.view(np.float64 if counts.size * 3 == rows.size * 8 else np.float32)
            held.append([*(rows[r::3].copy() for r in range(3)), counts.astype(kind)])  # a batch is let go before it is worked on
            n += counts.size
            del batch, rows, counts
            if n >= STEP_CONTEXTS:
                expectation.add(held)
                n = 0
        if n:
            expectation.add(held)
        yield from _touched(expectation.found.astype(kind))

    tasks = min(STEP_TASKS, context.defaultParallelism)
    total = _summed(packed.coalesce(tasks).mapInArrow(run, f"row long, gradient array<{'float' if kind is np.float32 else 'double'}>"))
    sent.destroy()  # each step has weights of its own, and what is sent lies on disks
    total *= exps * exps[BIAS]
    total[BIAS] += total.sum(axis=0) / 3  # each context has three other rows
    return total


def train(texts: DataFrame, steps: int = STEPS) -> tuple[Model, DataFrame]:
    """The model of the bytes column ``text`` and the table of all its words' counts."""
    counts = written(word_counts(texts), "words")
    total, distinct = counts.agg(F.sum("n"), F.count(F.lit(1))).first()
    model = Model(_frequent(counts), int(total or 0), int(distinct))
    if not model.total:
        return model, counts

    singles = texts.sparkSession.createDataFrame([(w, i) for i, w in enumerate(model.singles)], "word binary, single int")
    classed = counts.join(F.broadcast(singles), "word", "left").withColumn("class", F.coalesce("single", _ending_column("word")))
    model.set_classes(
        classed.groupBy("class").agg(F.sum("n"), F.count(F.lit(1)), F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2)).collect()
    )

    counted = written(_counted(texts, model), "contexts", compression="none")  # each step reads it
    observed, packed = _observed_of(counted), counted.select("rows", "tokens")
    weights = np.zeros((BUCKETS, CLASSES))
    bias, tokens_ = BIAS, observed.sum(axis=1)
    weights[bias] = np.log(np.maximum(model.class_tokens, 0.1) / model.total)
    mean, square = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, steps + 1):
        pull = RIDGE * weights
        pull[bias] = 0
        expected = _expected(packed, weights)
        # a row expects as many tokens as it has: single precision's share in its sum, which steps would take for a gradient, goes
        expected *= (tokens_ / np.maximum(expected.sum(axis=1), 1e-300))[:, None]
        gradient = (observed - expected - pull) / model.total
        mean, square = 0.9 * mean + 0.1 * gradient, 0.99 * square + 0.01 * gradient**2
        rate = RATE * (1 - 0.9 * (step - 1) / steps)
        weights += rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-10)
    model.weights = weights.astype(np.float32)
    return model, counts


# --- scoring ----------------------------------------------------------------------

_PARTS = "rid long, word binary, class int, tf long, own struct<n_tokens: long, known: long, base: double, score: double, train: boolean, doc_id: {}>"


def _score_parts(rows: DataFrame, model: Model) -> DataFrame:
    """A row for each text with what frequent words and classes give, and one for each of its other words.

    The id and ``train`` travel with the text's own row: numbering the texts once more could number
    them otherwise.

    A text's own row has a ``word`` that no text can hold, so a join on words leaves it alone; the others have no ``own``.
    """
    sent = shared(rows.sparkSession, model)
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent()
        reader = _Reader(model)
        base = np.append(np.log10(model.counts + 1.0), 0.0)  # the last for words that are not frequent
        inside = np.append(model.in_class(model.classes, model.counts), 0.0)
        log_all = np.log10(model.total + model.distinct + 1.0)
        scores = _ClassScores(model.weights)
        for batch in batches:
            rids = batch.column(0).to_numpy()
            for first, end, words in _blocks(batch, 1):
                sizes = words.sizes
                starts = np.cumsum(sizes) - sizes
                numbers, classes = reader.read(words)
                sums = [
                    np.add.reduceat(v, starts)
                    for v in ((numbers >= 0).astype(np.int64), base[numbers], scores.log10(context_rows(words.hashes, starts), classes) + inside[numbers])
                ]
                own = rids[first:end]
                rare = np.flatnonzero(numbers < 0)
                owner = np.repeat(np.arange(len(sizes)), sizes)[rare]
                with np.errstate(over="ignore"):
                    found, times = _grouped(words.hashes[rare] + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                rare, owner = rare[found], owner[found]
                texts = [pa.array(v) for v in (sizes, sums[0], sums[1] - sizes * log_all, sums[2])]
                texts += [batch.column(c).slice(first, end - first) for c in (2, 3)]
                texts = pa.StructArray.from_arrays(texts, names=["n_tokens", "known", "base", "score", "train", "doc_id"])
                columns = [
                    pa.array(np.concatenate([own, own[owner]])),
                    pa.array([b" %d" % r for r in own] + words.bytes_of(rare), pa.binary()),
                    pa.array(np.concatenate([np.full(len(own), -1), classes[rare]]), pa.int32()),
                    pa.array(np.concatenate([np.zeros(len(own), np.int64), times])),
                    pa.concat_arrays([texts, pa.nulls(len(rare), texts.type)]),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["rid", "word", "class", "tf", "own"])

    return rows.select("rid", "text", "train", "doc_id").mapInArrow(run, _PARTS.format(id_type))


def score_texts(df: DataFrame, train_on: Column, text: str = "text", id: str = "doc_id", steps: int = STEPS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), a row for each row of ``df``.

    The model learns from the rows where ``train_on`` is true; a null there counts as true.
    A null text is empty: one token, its end.  Repeated rows are learned from and scored each
    time.  Without training texts every probability is 1, as nothing has been counted.
    """
    rows = df.select(F.col(id).alias("doc_id"), F.coalesce(train_on, F.lit(True)).alias("train"), utf8(text).alias("text"))
    model, counts = train(rows.where("train"), steps)
    numbered = rows.withColumn("rid", F.monotonically_increasing_id())
    # each word has one count, so a task's part of the counts fits its memory, and neither side need be sorted
    parts = _score_parts(numbered, model).join(counts.hint("shuffle_hash"), "word", "left")

    def of_class(values: np.ndarray) -> Column:
        return F.get(F.array(*[F.lit(float(x)) for x in values]), F.col("class"))

    n, tokens_, discount = F.coalesce("n", F.lit(0)), of_class(model.class_tokens), of_class(model.discounts)
    p = F.when(n > 0, n - discount).otherwise(discount * of_class(model.class_words)) / F.greatest(tokens_, F.lit(1.0))
    rare = F.col("class") >= 0
    inside = F.when(tokens_ > 0, F.log10(p)).otherwise(0.0)
    sums = parts.groupBy("rid").agg(
        F.max("own.doc_id").alias("doc_id"),
        (~F.max("own.train")).alias("held_out"),
        F.sum("own.n_tokens").alias("n_tokens"),
        F.sum(F.coalesce("own.known", F.lit(0)) + F.when(rare & (n > 0), F.col("tf")).otherwise(0)).alias("n_known"),
        F.sum(F.coalesce("own.base", F.lit(0.0)) + F.when(rare, F.col("tf") * F.log10(n + 1.0)).otherwise(0.0)).alias("base_score"),
        F.sum(F.coalesce("own.score", F.lit(0.0)) + F.when(rare, F.col("tf") * inside).otherwise(0.0)).alias("score"),
    )
    return sums.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(model.total).cast("long").alias("train_tokens"), "base_score", "score"
    )
