"""Packing: order-preserving dynamic programming over cut positions.

Documents are tokenized, closed with an end id and laid end to end in the order in which a
task reads them. A window of at most ``window`` ids may end at a document end (free), at a
sentence end or, inside a long sentence, at fixed steps (both at a penalty). Let P be the
cut positions and f[j] the least cost of all ids before P[j]. A window (i, j] costs its
padding, ``window - (P[j] - P[i])``, so

    f[j] = penalty[j] + window - P[j] + min(f[i] + P[i])  over  P[j] - P[i] <= window

and the minimum slides over a monotone queue: every position enters and leaves it once.
Windows whose length is a power of two need no padding and are met as extra transitions.

Memory is bounded by the ids of one document: after ``HORIZON`` ids, which may end inside a
document, the best path is fixed except for its last few windows, whose ids are carried into
the next round. Nothing is shuffled, and a task that is run again reads the same split and
yields the same sequences.

Text is cut at blanks and every distinct chunk of some megabytes of text is tokenized once; neither the
normalizer nor the pre-tokenizer of the vocabulary looks across a blank.

Defined results: a null or empty text has its end id only; a null doc_id is carried along;
repeated rows are separate documents; other columns, whatever their names, are ignored; an
empty table yields no pieces.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

WINDOW = 2048
END_ID = 1
SENTENCE_CUT = 8.0
INNER_CUT = 64.0
STEP = 64
PIECES_AT_ONCE = 512
KNOWN_WORDS = 200_000
HORIZON = 1 << 20
CARRIED = 4
BYTES_AT_ONCE = 1 << 22
ROW_BYTES = 16  # counted for a row besides its text


# Chunks of one run of Latin letters, perhaps with marks behind it: no rule of the vocabulary's
# normalizer but lower case applies to them, and its pre-tokenizer cuts before the marks.
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
_PLAIN = "^[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+[!-&(-/:-@\\[-`{-~]*$"
# Byte-level vocabularies write a byte as the character of its number if that is printable,
# else as the next free character from 256 on.
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_SIGNS = {b: chr(b) for b in _SHOWN} | {
    b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in set(_SHOWN))
}


class ChunkCoder:
    """Ids of whole texts, many texts at a time; every distinct chunk is coded once."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.words: dict[str, bytes] = {}

    def _letters(self, words: list[str]) -> list[bytes]:
        """Ids of runs of plain lower-case letters: each is one pre-token in normal form."""
        known, out = self.words, []
        if len(known) > KNOWN_WORDS:
            known.clear()
        for word in words:
            ids = known.get(word)
            if ids is None:
                signs = word if word.isascii() else "".join(map(_BYTE_SIGNS.__getitem__, word.encode()))
                ids = known[word] = array("I", [x.id for x in self.model.tokenize(signs)]).tobytes()
            out.append(ids)
        return out

    def _others(self, texts: list[str]) -> list[bytes]:
        return [array("I", x.ids).tobytes() for x in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _distinct(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of every chunk: all values, and where each chunk's start and how many they are."""
        plain = pc.match_substring_regex(chunks, _PLAIN)
        letters = chunks.filter(plain)
        stems = pc.utf8_lower(pc.utf8_rtrim(letters, _MARKS)).dictionary_encode()
        tails = pc.replace_substring_regex(letters, "^[^" + re.escape(_MARKS) + "]+", "").dictionary_encode()
        is_plain = np.asarray(plain)
        runs = [*self._letters(stems.dictionary.to_pylist()), *self._others(chunks.filter(pc.invert(plain)).to_pylist())]
        head = np.empty(len(chunks), np.int64)
        head[is_plain] = np.asarray(stems.indices)
        head[~is_plain] = np.arange(len(stems.dictionary), len(runs))
        tail = np.full(len(chunks), len(runs) + len(tails.dictionary))
        tail[is_plain] = np.asarray(tails.indices) + len(runs)
        runs += [*self._others(tails.dictionary.to_pylist()), b""]
        values = np.frombuffer(b"".join(runs), np.uint32)
        size = np.fromiter(map(len, runs), np.int64, len(runs)) // 4
        place, last = spread(np.cumsum(size) - size, size, np.stack([head, tail], 1).ravel())
        size = size[head] + size[tail]
        return values[place], (last[1::2] - size).astype(np.int32), size.astype(np.int32)

    def __call__(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each text its ids and the positions after sentence ends."""
        split = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        coded = split.flatten().dictionary_encode()
        values, start, size = self._distinct(coded.dictionary)
        ends = np.asarray(pc.match_substring_regex(coded.dictionary, "[.!?]$"))
        which = np.asarray(coded.indices)
        bounds = np.asarray(split.offsets) - split.offsets[0].as_py()
        for begin, end in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            place, last = spread(start, size, which[begin:end])
            closing = last[ends[which[begin:end]]]
            yield values[place], closing[(closing > 0) & (closing < len(place))]


def portions(batches: Iterable[pa.RecordBatch], text: str = "text", size: int = BYTES_AT_ONCE) -> Iterator[pa.Table]:
    """The rows of ``batches`` in order, in tables of at most ``size`` bytes of text or of one row.

    Arrow's pool gives back what the last table took, else a worker keeps it for good.
    """
    held, total = [], 0
    for batch in batches:
        ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch[text]), 0)).astype(np.int64) + ROW_BYTES)
        begin = 0
        while begin < len(ends):
            done = int(ends[begin - 1]) if begin else 0
            stop = int(np.searchsorted(ends, done + size - total, "right"))
            if not held:
                stop = max(begin + 1, stop)
            if stop > begin:
                held.append(batch.slice(begin, stop - begin))
                total += int(ends[stop - 1]) - done
                begin = stop
            if begin < len(ends):
                yield pa.Table.from_batches(held)
                held, total = [], 0
                pa.default_memory_pool().release_unused()
    if held:
        yield pa.Table.from_batches(held)
    pa.default_memory_pool().release_unused()


def spread(start: np.ndarray, size: np.ndarray, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all values of ``runs`` in order, and the number of values up to each run's end."""
    sizes = size[runs]
    last = np.cumsum(sizes)
    total = int(last[-1]) if len(last) else 0
    return np.arange(total) + np.repeat(start[runs] - last + sizes, sizes), last


def cut_positions(lengths: np.ndarray, sentence_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Increasing cut positions after 0, and the penalty of each."""
    total = int(lengths.sum())
    penalty = np.full(total + 1, np.inf)
    penalty[sentence_ends] = SENTENCE_CUT
    penalty[np.cumsum(lengths)] = 0.0
    marks = np.concatenate([[0], np.flatnonzero(penalty[1:] < np.inf) + 1])
    gaps = np.diff(marks)
    long = gaps > STEP
    inner = (gaps[long] - 1) // STEP
    step = np.arange(1, int(inner.sum()) + 1) - np.repeat(np.cumsum(inner) - inner, inner)
    penalty[np.repeat(marks[:-1][long], inner) + STEP * step] = INNER_CUT
    positions = np.flatnonzero(penalty[1:] < np.inf) + 1
    return positions, penalty[positions]


def best_windows(positions: np.ndarray, penalty: np.ndarray, window: int = WINDOW) -> list[int]:
    """Window ends (values of ``positions``) of the cheapest path from 0 to the last one."""
    place = np.concatenate([[0], positions])
    n = len(place)
    index = np.full(int(place[-1]) + 1, -1, np.int64)
    index[place] = np.arange(n)
    full = [1 << k for k in range(window.bit_length()) if 1 << k < window]
    ends, starts = [], []
    for length in full:
        first = int(np.searchsorted(place, length))
        begins = index[place[first:] - length]
        found = np.flatnonzero(begins >= 0)
        ends.append(found + first)
        starts.append(begins[found])
    ends, starts = np.concatenate([*ends, [n]]), np.concatenate([*starts, [0]])
    order = np.argsort(ends, kind="stable")
    exact_end, exact_start, met = ends[order].tolist(), starts[order].tolist(), 0
    # value[i] = f[i] + P[i]; the queue holds positions in order, their values increasing
    at, cost_of_cut = place.tolist(), [0.0, *penalty.tolist()]
    value, back, queue = [0.0] * n, [0] * n, [0] * n
    head = tail = 0
    for j in range(1, n):
        here = at[j]
        least = here - window
        while at[queue[head]] < least:
            head += 1
        i = queue[head]
        best = value[i] + window
        while exact_end[met] == j:
            other = exact_start[met]
            if value[other] - at[other] + here < best:
                best, i = value[other] - at[other] + here, other
            met += 1
        back[j] = i
        best += cost_of_cut[j]
        value[j] = best
        while tail >= head and value[queue[tail]] >= best:
            tail -= 1
        tail += 1
        queue[tail] = j
    ends, j = [], n - 1
    while j:
        ends.append(at[j])
        j = back[j]
    return ends[::-1]


def _pieces(docs: Iterable[tuple[object, np.ndarray, np.ndarray]], first: int, window: int, horizon: int) -> Iterator[tuple]:
    """Pieces of documents (key, ids, sentence ends); sequences are numbered from ``first``."""
    held: list[list] = []  # key, ids, sentence ends, ids already placed, ids at hand
    pending, sequence = 0, first

    def place(last: bool) -> Iterator[tuple]:
        nonlocal held, pending, sequence
        lengths = np.array([stop - done for _, _, _, done, stop in held])
        starts = np.cumsum(lengths) - lengths
        inner = [
            ends[(ends > done) & (ends < stop)] - done + start
            for (_, _, ends, done, stop), start in zip(held, starts, strict=True)
        ]
        ends = best_windows(*cut_positions(lengths, np.concatenate(inner)), window)
        if not last:
            ends = ends[:-CARRIED]
        begin, doc = 0, 0
        for end in ends:
            at = begin
            while at < end:
                while held[doc][3] == held[doc][4]:
                    doc += 1
                key, ids, _, done, stop = held[doc]
                size = min(end - at, stop - done)
                yield key, done, size, len(ids), sequence, at - begin, ids[done:done + size].tobytes()
                held[doc][3] += size
                at += size
            begin, sequence = end, sequence + 1
        held = [x for x in held[doc:] if x[3] < x[4]]
        pending = sum(stop - done for _, _, _, done, stop in held)

    for key, ids, ends in docs:
        for begin in range(0, len(ids), horizon):
            stop = min(begin + horizon, len(ids))
            if begin and held:  # the rest of the document's last slice, which is carried
                held[-1][4] = stop
            else:
                held.append([key, ids, ends, begin, stop])
            pending += stop - begin
            if pending > horizon:
                yield from place(last=False)
    if held:
        yield from place(last=True)


def pack(
    docs: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text",
    window: int = WINDOW, end_id: int = END_ID, horizon: int = HORIZON,
) -> DataFrame:
    """One row per piece: key, start, length, doc_tokens, sequence_id, offset, ids.

    ``ids`` holds the piece as little-endian unsigned 32-bit integers. ``sequence_id`` joins
    the number of the task with a running number.
    """
    picked = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def run(batches):
        code = ChunkCoder(tokenizer_path)

        def coded():
            for rows in portions(batches):
                texts = pc.fill_null(rows["text"], "").combine_chunks()
                for key, (ids, ends) in zip(rows["key"].to_pylist(), code(texts), strict=True):
                    yield key, np.append(ids, np.uint32(end_id)).astype("<u4"), ends

        pieces = _pieces(coded(), TaskContext.get().partitionId() << 36, window, horizon)
        while rows := list(islice(pieces, PIECES_AT_ONCE)):
            columns = zip(zip(*rows, strict=True), out_types, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in columns], out_names)

    kind = picked.schema["key"].dataType.simpleString()
    shape = f"key {kind}, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
    schema = to_arrow_schema(_parse_datatype_string(shape))
    out_names, out_types = schema.names, schema.types
    return picked.mapInArrow(run, shape).withColumnRenamed("key", key)


def digest(pieces: DataFrame, key: str = "doc_id") -> DataFrame:
    return pieces.select(
        key, "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset",
    )
