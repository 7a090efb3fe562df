r"""SentencePiece encoding and decoding with a batched Viterbi search in numpy.

A text is cut into chunks, each a run of blanks with what follows it; no piece reaches over
the start of a chunk. Distinct chunks are grouped by length, and all chunks of a length
advance together: at every position the hashes of the substrings that end there probe the
sorted hashes of the pieces, the allowed steps get their scores, and the maximum over them
and its backpointer are stored for the whole group at once.

Two kinds of model differ in what a step is allowed and worth. In a unigram model every
piece is allowed and worth its score. In a byte-pair model a piece is allowed if it stands
its ground next to the piece before it, that is if merging the two pieces' characters by
score gives these two pieces again; a sequence is the model's encoding just if all its
neighbours do, so at every position one step survives. Verdicts on pairs of pieces are
looked up in a sorted table, which grows as new pairs turn up. Characters without a piece
fall back to the pieces of their bytes.

A chunk of more than ``SPAN`` characters, such as a text without blanks, is cut first, where
no piece that occurs in it lies across: no step and no merge can do so either, so its parts
are encoded like chunks of their own. In a part that stays as long, the probes of many
positions are made at once instead of those of many chunks.

Only models with identity normalization are read; spaces are written as U+2581, so that sign
comes back as a space, and everything else comes back as it was.

Defined results: a null text is encoded as an empty one; an empty text has no ids; a null
key is carried along; repeated rows are encoded once per row; other columns, whatever their
names, are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import sys
import types
from array import array
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweir.llm.packing import spread

BLANK = "▁"
KNOWN_CHUNKS = 300_000
KNOWN_PAIRS = 1_000_000
SPAN = 256
PROBED_AT_ONCE = 1 << 16
BYTES_AT_ONCE = 1 << 23
GROUP_CELLS = 1 << 20
_CUT = "\x1f"  # set before chunks; texts that hold it are cut by another path
_BASE = np.uint64(0x9E3779B97F4A7C15)
_COARSE = np.uint64(43)

# Fixed values of the format: kinds of models and of pieces.
UNIGRAM, BPE = 1, 2
NORMAL, USER, BYTE = 1, 4, 6


class Pieces:
    """The pieces of a model, their hashes in order, and what has been learnt about them."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as formats

        model = formats.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        if model.normalizer_spec.precompiled_charsmap or model.normalizer_spec.remove_extra_whitespaces:
            raise ValueError("only models with identity normalization are read")
        self.kind = model.trainer_spec.model_type
        self.prefix = BLANK if model.normalizer_spec.add_dummy_prefix else ""
        self.names = [p.piece for p in model.pieces]
        self.scores = np.array([p.score for p in model.pieces])
        usable = [i for i, p in enumerate(model.pieces) if p.type in (NORMAL, USER)]
        self.ids = {self.names[i]: i for i in usable}
        self.longest = max(map(len, self.ids))
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == BYTE}
        self.unknown = next((i for i, p in enumerate(model.pieces) if p.type == 2), 0)
        hashes = np.array([int(self.hash(self.names[i])) for i in usable], np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.by_hash = hashes[order], np.array(usable)[order]
        if (self.hashes[1:] == self.hashes[:-1]).any():
            raise ValueError("two pieces have the same hash")
        self.maybe = np.zeros(1 << (64 - int(_COARSE)), bool)  # spares most probes the search
        self.maybe[self.hashes >> _COARSE] = True
        self.pair_keys = np.zeros(0, np.int64)
        self.pair_stands = np.zeros(0, bool)
        self.verdicts: dict[int, bool] = {}
        self.chunks: dict[str, bytes] = {}
        texts = [bytes([int(p.piece[3:5], 16)]) if p.type == BYTE else p.piece.replace(BLANK, " ").encode() if p.type in (NORMAL, USER) else b"" for p in model.pieces]
        self.out_size = np.array(list(map(len, texts)))
        self.out_start = np.cumsum(self.out_size) - self.out_size
        self.out = np.frombuffer(b"".join(texts), np.uint8)

    @staticmethod
    def hash(text: str) -> np.uint64:
        code = 0
        for char in text:
            code = (code * int(_BASE) + ord(char) + 1) & 0xFFFFFFFFFFFFFFFF
        return np.uint64(code)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Piece ids of substring hashes; -1 where there is none."""
        found = np.full(len(hashes), -1, np.int64)
        likely = np.flatnonzero(self.maybe[hashes >> _COARSE])
        probe = hashes[likely]
        at = np.minimum(np.searchsorted(self.hashes, probe), len(self.hashes) - 1)
        exact = self.hashes[at] == probe
        found[likely[exact]] = self.by_hash[at[exact]]
        return found

    def merged(self, text: str) -> list[str]:
        """What merging neighbours, best score and then leftmost first, makes of ``text``."""
        parts = list(text)
        while len(parts) > 1:
            best, place = -np.inf, -1
            for i in range(len(parts) - 1):
                piece = self.ids.get(parts[i] + parts[i + 1])
                if piece is not None and self.scores[piece] > best:
                    best, place = self.scores[piece], i
            if place < 0:
                break
            parts[place:place + 2] = [parts[place] + parts[place + 1]]
        return parts

    def stands(self, before: np.ndarray, piece: np.ndarray) -> np.ndarray:
        """Whether each piece is what merging leaves behind ``before`` (-1: the chunk's start)."""
        keys, back = np.unique((before + 1) * len(self.names) + piece, return_inverse=True)
        at = np.searchsorted(self.pair_keys, keys)
        known = np.zeros(len(keys), bool)
        inside = at < len(self.pair_keys)
        known[inside] = self.pair_keys[at[inside]] == keys[inside]
        stands = np.empty(len(keys), bool)
        stands[known] = self.pair_stands[at[known]]
        if not known.all():
            missing, verdicts = keys[~known], []
            for key in missing.tolist():
                left, right = divmod(key, len(self.names))
                parts = [self.names[right]] if left == 0 else [self.names[left - 1], self.names[right]]
                verdicts.append(self.merged("".join(parts)) == parts)
            stands[~known] = verdicts
            self.pair_keys = np.insert(self.pair_keys, at[~known], missing)
            self.pair_stands = np.insert(self.pair_stands, at[~known], verdicts)
        return stands[back]


def loaded(path: str) -> Pieces:
    """The model of ``path``, kept by a worker process for its next tasks."""
    shelf = vars(sys.modules.setdefault("_clickweir_kept", types.ModuleType("_clickweir_kept")))
    if path not in shelf:
        shelf[path] = Pieces(path)
    return shelf[path]


def viterbi(pieces: Pieces, chunks: list[str]) -> list[list[int]]:
    """Best pieces of chunks of one length. An unknown character c is len(names) + c."""
    count, length, names = len(chunks), len(chunks[0]), len(pieces.names)
    codes = np.frombuffer("".join(chunks).encode("utf-32-le"), np.uint32).reshape(count, length).astype(np.uint64)
    prefix = np.zeros((length + 1, count), np.uint64)
    for i in range(length):
        prefix[i + 1] = prefix[i] * _BASE + codes[:, i] + np.uint64(1)
    powers = [np.uint64(pow(int(_BASE), size, 1 << 64)) for size in range(pieces.longest + 1)]
    best = np.full((length + 1, count), -np.inf)
    best[0] = 0
    last = np.full((length + 1, count), -1, np.int64)  # the piece that ends here on the best path
    step = np.zeros((length + 1, count), np.int32)
    worst = float(pieces.scores.min()) - 10
    for end in range(1, length + 1):
        for size in range(1, min(end, pieces.longest) + 1):
            begin = end - size
            found = pieces.find(prefix[end] - prefix[begin] * powers[size])
            if size == 1:
                at = np.flatnonzero((found < 0) & (best[begin] > -np.inf))
                best[end, at] = best[begin, at] + (worst if pieces.kind == UNIGRAM else 0)
                last[end, at] = names + codes[at, begin].astype(np.int64)
                step[end, at] = 1
            at = np.flatnonzero((found >= 0) & (best[begin] > -np.inf))
            if not len(at):
                continue
            piece, before = found[at], last[begin, at]
            if pieces.kind == UNIGRAM:
                value = best[begin, at] + pieces.scores[piece]
            else:
                known = before < names  # an unknown character never merges
                allowed = np.ones(len(at), bool)
                allowed[known] = pieces.stands(before[known], piece[known])
                if not known.all():
                    allowed[~known] = pieces.stands(np.full((~known).sum(), -1), piece[~known])
                at, piece = at[allowed], piece[allowed]
                value = best[begin, at]
            better = value > best[end, at]
            at = at[better]
            best[end, at], last[end, at], step[end, at] = value[better], piece[better], size
    tokens: list[list[int]] = [[] for _ in chunks]
    at = np.full(count, length)
    rows = np.arange(count)
    while (going := rows[at[rows] > 0]).size:
        for row, piece in zip(going.tolist(), last[at[going], going].tolist(), strict=True):
            tokens[row].append(piece)
        at[going] -= step[at[going], going]
        rows = going
    return [t[::-1] for t in tokens]


def _with_bytes(pieces: Pieces, tokens: list[int]) -> list[int]:
    """Unknown characters as the pieces of their bytes, or as the unknown piece."""
    if max(tokens) < len(pieces.names):
        return tokens
    out = []
    for token in tokens:
        if token < len(pieces.names):
            out.append(token)
        elif pieces.bytes:
            out += [pieces.bytes[b] for b in chr(token - len(pieces.names)).encode()]
        else:
            out.append(pieces.unknown)
    return out


def _occurrences(pieces: Pieces, chunk: str) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Ends, sizes and ids of all pieces found in ``chunk``, by end and then size, in batches."""
    base, mask = int(_BASE), (1 << 64) - 1
    hashes = accumulate(map(ord, chunk), lambda code, char: (code * base + char + 1) & mask, initial=0)
    prefix = np.fromiter(hashes, np.uint64, len(chunk) + 1)
    for begin in range(1, len(chunk) + 1, PROBED_AT_ONCE):
        stop = min(begin + PROBED_AT_ONCE, len(chunk) + 1)
        ends, sizes, ids = [], [], []
        for size in range(1, min(stop - 1, pieces.longest) + 1):
            first = max(begin, size)
            power = np.uint64(pow(base, size, 1 << 64))
            found = pieces.find(prefix[first:stop] - prefix[first - size:stop - size] * power)
            at = np.flatnonzero(found >= 0)
            ends.append(at + first)
            sizes.append(np.full(len(at), size))
            ids.append(found[at])
        ends, sizes, ids = np.concatenate(ends), np.concatenate(sizes), np.concatenate(ids)
        order = np.argsort(ends, kind="stable")
        yield ends[order], sizes[order], ids[order]


def parts_of(pieces: Pieces, chunk: str) -> list[str]:
    """``chunk`` cut wherever none of the pieces that occur in it lies across."""
    across = np.zeros(len(chunk) + 2, np.int64)
    for ends, sizes, _ in _occurrences(pieces, chunk):
        np.add.at(across, ends - sizes + 1, 1)
        np.add.at(across, ends, -1)
    cuts = np.flatnonzero(np.cumsum(across)[1:len(chunk)] == 0) + 1
    bounds = [0, *cuts.tolist(), len(chunk)]
    return [chunk[i:j] for i, j in zip(bounds[:-1], bounds[1:], strict=True)]


def viterbi_long(pieces: Pieces, chunk: str) -> list[int]:
    """What ``viterbi`` gives for one long chunk: many positions are probed at once."""
    names, unigram = len(pieces.names), pieces.kind == UNIGRAM
    verdicts, scores = pieces.verdicts, pieces.scores.tolist()
    if len(verdicts) > KNOWN_PAIRS:
        verdicts.clear()
    worst = float(pieces.scores.min()) - 10
    best = array("d", [0.0]) + array("d", [-np.inf]) * len(chunk)
    last = array("q", [-1]) * (len(chunk) + 1)
    step = array("i", [0]) * (len(chunk) + 1)

    def stands(before: int, piece: int) -> bool:
        key = (before + 1 if before < names else 0) * names + piece
        verdict = verdicts.get(key)
        if verdict is None:
            left, right = divmod(key, names)
            parts = [pieces.names[right]] if left == 0 else [pieces.names[left - 1], pieces.names[right]]
            verdict = verdicts[key] = pieces.merged("".join(parts)) == parts
        return verdict

    begin = 1
    for ends, sizes, ids in _occurrences(pieces, chunk):
        stop = min(begin + PROBED_AT_ONCE, len(chunk) + 1)
        bounds = np.searchsorted(ends, np.arange(begin, stop + 1)).tolist()
        sizes, ids = sizes.tolist(), ids.tolist()
        for end, low, high in zip(range(begin, stop), bounds[:-1], bounds[1:], strict=True):
            if low == high or sizes[low] > 1:  # a character without a piece
                best[end] = best[end - 1] + (worst if unigram else 0)
                last[end], step[end] = names + ord(chunk[end - 1]), 1
            for i in range(low, high):
                size, piece = sizes[i], ids[i]
                value = best[end - size]
                if unigram:
                    value += scores[piece]
                if value > best[end] and (unigram or stands(last[end - size], piece)):
                    best[end], last[end], step[end] = value, piece, size
        begin = stop
    tokens, at = [], len(chunk)
    while at:
        tokens.append(last[at])
        at -= step[at]
    return tokens[::-1]


def _encoded(pieces: Pieces, chunks: list[str]) -> list[bytes]:
    """Ids of distinct chunks as 32-bit integers."""
    known = pieces.chunks
    if len(known) > KNOWN_CHUNKS:
        known.clear()
    parts = {chunk: parts_of(pieces, chunk) for chunk in chunks if len(chunk) > SPAN}
    long: dict[str, bytes] = {}
    by_length: dict[int, list[str]] = {}
    wanted = dict.fromkeys(chunk for chunk in chunks if len(chunk) <= SPAN)
    wanted.update(dict.fromkeys(part for some in parts.values() for part in some))
    for chunk in wanted:
        if len(chunk) > SPAN:
            long[chunk] = array("I", _with_bytes(pieces, viterbi_long(pieces, chunk))).tobytes()
        elif chunk not in known:
            by_length.setdefault(len(chunk), []).append(chunk)
    for length, group in by_length.items():
        if length == 0:
            known[""] = b""
            continue
        most = max(1, GROUP_CELLS // length)
        for begin in range(0, len(group), most):
            part = group[begin:begin + most]
            for chunk, tokens in zip(part, viterbi(pieces, part), strict=True):
                known[chunk] = array("I", _with_bytes(pieces, tokens)).tobytes()
    for chunk, some in parts.items():
        long[chunk] = b"".join([long[part] if len(part) > SPAN else known[part] for part in some])
    return [long[chunk] if len(chunk) > SPAN else known[chunk] for chunk in chunks]


def _chunk_lists(pieces: Pieces, texts: pa.Array) -> pa.Array:
    """Chunks of every text, as lists."""
    blank = pc.replace_substring(texts, " ", BLANK)
    started = pc.if_else(pc.equal(texts, ""), "", pc.binary_join_element_wise(pieces.prefix, blank, ""))
    cut = pc.replace_substring(started, "\n", f"{_CUT}\n{_CUT}") if "\n" not in "".join(pieces.ids) else started
    cut = pc.replace_substring_regex(cut, f"({BLANK}+)", f"{_CUT}\\1")
    return pc.split_pattern(cut, _CUT)


def encode_texts(pieces: Pieces, texts: pa.Array) -> list[np.ndarray]:
    """Ids of every text of an array without nulls."""
    # A text that holds the mark between chunks is one chunk: slower, and the same result.
    odd = np.asarray(pc.match_substring(texts, _CUT))
    lists = _chunk_lists(pieces, pc.if_else(pa.array(odd), "", texts))
    coded = lists.flatten().dictionary_encode()
    runs = _encoded(pieces, coded.dictionary.to_pylist())
    values = np.frombuffer(b"".join(runs), np.uint32)
    size = np.fromiter(map(len, runs), np.int64, len(runs)) // 4
    start = np.cumsum(size) - size
    which = np.asarray(coded.indices)
    bounds = np.asarray(lists.offsets) - lists.offsets[0].as_py()
    out = []
    for i, (begin, end) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
        if odd[i]:
            whole = pieces.prefix + texts[i].as_py().replace(" ", BLANK)
            out.append(np.frombuffer(_encoded(pieces, [whole])[0], np.uint32))
        else:
            out.append(values[spread(start, size, which[begin:end])[0]])
    return out


def decode_ids(pieces: Pieces, ids: np.ndarray) -> str:
    place, _ = spread(pieces.out_start, pieces.out_size, ids)
    text = pieces.out[place].tobytes().decode(errors="replace")
    return text[1:] if pieces.prefix and text[:1] == " " else text


def encode(docs: DataFrame, model_path: str, key: str = "doc_id", text: str = "text", verify: bool = False) -> DataFrame:
    """key and ids (little-endian unsigned 32-bit integers) of every row.

    ``verify`` decodes the ids at once and adds the number of characters that come back, and
    whether they are the text.
    """
    picked = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = picked.schema["key"].dataType.simpleString()

    def run(batches):
        pieces = loaded(model_path)
        for batch in batches:
            texts = pc.fill_null(batch["text"], "")
            sizes = np.cumsum(np.asarray(pc.binary_length(texts)))
            begin = 0
            while begin < batch.num_rows:
                end = max(begin + 1, int(np.searchsorted(sizes, (sizes[begin - 1] if begin else 0) + BYTES_AT_ONCE)))
                part = texts.slice(begin, end - begin)
                ids = encode_texts(pieces, part)
                columns = {"key": batch["key"].slice(begin, end - begin), "ids": pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary())}
                if verify:
                    back = [decode_ids(pieces, x) for x in ids]
                    columns["decoded_chars"] = pa.array(list(map(len, back)), pa.int64())
                    columns["round_trip"] = pa.array([x == y.replace(BLANK, " ") for x, y in zip(back, part.to_pylist(), strict=True)], pa.bool_())
                yield pa.RecordBatch.from_pydict(columns)
                begin = end

    shape = f"key {kind}, ids binary" + ", decoded_chars long, round_trip boolean" * verify
    return picked.mapInArrow(run, shape).withColumnRenamed("key", key)


def decoded(ids: Column, model_path: str) -> Column:
    """The texts of a column of ids as ``encode`` gives them; null for null."""
    @F.pandas_udf("string")
    def run(column):
        pieces = loaded(model_path)
        return column.map(lambda x: None if x is None else decode_ids(pieces, np.frombuffer(x, "<u4")))

    return run(ids)


def digest(coded: DataFrame, key: str = "doc_id") -> DataFrame:
    """Number and hash of the ids of verified rows, and whether they give the text back."""
    return coded.select(
        key, (F.octet_length("ids") / 4).cast("long").alias("n_ids"), F.crc32("ids").alias("ids_crc32"),
        "decoded_chars", "round_trip",
    )
