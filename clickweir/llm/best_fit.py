"""Best-fit packing in bulk-synchronous rounds.

Documents are tokenized and closed with an end id; only one longer than the window is cut,
into full windows and a rest. Full pieces are sequences of their own. All others are placed by
decreasing size into the gaps of open sequences, best fit first, one round for each halving
of size:

1. Range sort. Pieces are sorted by size over all tasks and numbered within each size; gaps
   are numbered within each room. Only the counts by size, at most ``window`` numbers, leave
   the executors, whatever the number of documents.
2. Successor sweep. From large to small, the pieces of a size go to the smallest room that
   takes them, ``room // size`` of them to each gap, as long as there are gaps; where no gap is
   left, sequences are opened. A step is a run of gaps of one room that take a run of pieces of
   one size.
3. Ranks settle conflicts. All pieces of a size want the same gaps: the step's first gap gets
   the first pieces in order of rank, and so on. Every task follows the steps for its own gaps
   and yields (size, rank) of each piece they take; neither is moved or compared row by row.
4. Update. Filled gaps get a new room and a rank there; the round's gaps and placements are
   written, and the next round reads them.

At the end pieces and placements meet by (size, rank), a key without repeats. A round does for
its sizes exactly what best-fit decreasing does one by one, since a gap that has taken a piece
and has room for another of that size is then the smallest that fits; so the number of
sequences is that of best-fit decreasing over all documents.

Defined results: a null or empty text has its end id only; a null key is carried along;
repeated rows are separate documents; other columns, whatever their names, are ignored; an
empty table yields no pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweir.llm.frames import numbered, saved
from clickweir.llm.packing import END_ID, ChunkCoder, portions

WINDOW = 4096
# Sequences a task follows at a time.
GAPS_AT_ONCE = 1 << 17
_PLACED = "size int, rank long, sequence_id long, at long"


def pieces(docs: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text", window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """key, piece, start, length, ids_crc32 of every document, cut at multiples of ``window`` only."""
    picked = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def coded(rows: pa.Table, code: ChunkCoder) -> pa.RecordBatch:
        of, part, start, length, crc = [], [], [], [], []
        texts = pc.fill_null(rows["text"], "").combine_chunks()
        for i, (ids, _) in enumerate(code(texts)):
            ids = np.append(ids, np.uint32(end_id)).astype("<u4")
            for number, begin in enumerate(range(0, len(ids), window)):
                cut = ids[begin:begin + window]
                of.append(i)
                part.append(number)
                start.append(begin)
                length.append(len(cut))
                crc.append(zlib.crc32(cut.tobytes()))
        keys = rows["key"].combine_chunks().take(pa.array(of, pa.int64()))
        return pa.RecordBatch.from_arrays(
            [keys, pa.array(part, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))],
            ["key", "piece", "start", "length", "ids_crc32"],
        )

    def run(batches):
        code = ChunkCoder(tokenizer_path)
        for rows in portions(batches):
            yield coded(rows, code)

    kind = picked.schema["key"].dataType.simpleString()
    return picked.mapInArrow(run, f"key {kind}, piece int, start long, length long, ids_crc32 long")


class Sweep:
    """Counts of gaps by room, and the steps that a round's pieces take through them."""

    def __init__(self, window: int):
        self.window, self.opened = window, 0
        self.gaps = np.zeros(window + 1, np.int64)
        self.rooms = 0  # bit r is set while there are gaps of room r

    def _change(self, room: int, by: int) -> None:
        self.gaps[room] += by
        self.rooms = self.rooms | 1 << room if self.gaps[room] else self.rooms & ~(1 << room)

    def _fill(self, room: int, size: int, gaps: int, each: int, rank: int) -> tuple:
        first = int(self.gaps[room]) - gaps  # the last ranks of a room go first
        left = room - each * size
        self._change(room, -gaps)
        step = (room, first, size, rank, each, left, int(self.gaps[left]))
        self._change(left, gaps)
        return step

    def round(self, counts: list[tuple[int, int]]) -> list[tuple]:
        """Steps for (size, number of pieces), sizes decreasing.

        A step is (room, first rank, size, first piece's rank, pieces a gap, new room, first
        rank there), or, where sequences are opened, (window, first rank, 0, first id, how
        many, 0, 0).
        """
        steps = []
        for size, n in counts:
            rank = 0
            while rank < n:
                fitting = self.rooms >> size
                if not fitting:
                    more = -(-(n - rank) // (self.window // size))
                    steps.append((self.window, int(self.gaps[self.window]), 0, self.opened, more, 0, 0))
                    self._change(self.window, more)
                    self.opened += more
                    continue
                room = size + (fitting & -fitting).bit_length() - 1
                each = room // size
                full = min(int(self.gaps[room]), (n - rank) // each)
                if full:
                    steps.append(self._fill(room, size, full, each, rank))
                    rank += full * each
                if rank < n and self.gaps[room]:  # the rest takes one more gap
                    part = min(each, n - rank)
                    steps.append(self._fill(room, size, 1, part, rank))
                    rank += part
        return steps


def follow(steps: list[tuple], window: int, sequence: np.ndarray, room: np.ndarray, rank: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Placements in some gaps, and the gaps as they are afterwards.

    Gaps with room -1 are those that the round opens. ``held`` has for each room the places
    of its gaps in order of rank, as runs that are sorted among themselves.
    """
    held: dict[int, list[np.ndarray]] = {}
    old = np.flatnonzero(room >= 0)
    old = old[np.lexsort([rank[old], room[old]])]
    edge = np.flatnonzero(np.diff(room[old])) + 1
    for places in np.split(old, edge):
        if len(places):
            held[int(room[places[0]])] = [places]
    fresh = np.flatnonzero(room < 0)
    fresh = fresh[np.argsort(sequence[fresh])]
    numbers = sequence[fresh]
    out: list[tuple[np.ndarray, ...]] = []
    for at, first, size, piece, each, left, then in steps:
        if not size:
            low, high = np.searchsorted(numbers, [piece, piece + each])
            places = fresh[low:high]
            room[places], rank[places] = at, first + numbers[low:high] - piece
            if len(places):
                held.setdefault(at, []).append(places)
            continue
        runs = held.get(at)
        moved = []
        while runs:
            cut = int(np.searchsorted(rank[runs[-1]], first))
            if cut < len(runs[-1]):
                moved.append(runs[-1][cut:])
            if cut:
                runs[-1] = runs[-1][:cut]
                break
            runs.pop()
        if not moved:
            continue
        places = np.concatenate(moved[::-1])
        turn = rank[places] - first
        inner = np.tile(np.arange(each), len(places))
        out.append((
            np.full(len(inner), size), np.repeat(piece + turn * each, each) + inner,
            np.repeat(sequence[places], each), window - at + inner * size,
        ))
        room[places], rank[places] = left, then + turn
        held.setdefault(left, []).append(places)
    for rows in out:
        yield _batch(*rows)
    open_ = room > 0
    yield _batch(None, rank[open_], sequence[open_], room[open_])


def _batch(size: np.ndarray | None, rank: np.ndarray, sequence: np.ndarray, at: np.ndarray) -> pa.RecordBatch:
    sizes = pa.nulls(len(rank), pa.int32()) if size is None else pa.array(size, pa.int32())
    return pa.RecordBatch.from_arrays([sizes, *(pa.array(x, pa.int64()) for x in (rank, sequence, at))], ["size", "rank", "sequence_id", "at"])


def _round(gaps: DataFrame, steps: list[tuple], window: int) -> DataFrame:
    def run(batches):
        def columns(rows: pa.Table):
            return (np.asarray(rows[c]).astype(np.int64) for c in ("sequence_id", "at", "rank"))

        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += len(batch)
            if size >= GAPS_AT_ONCE:
                yield from _joined(follow(steps, window, *columns(pa.Table.from_batches(held))))
                held, size = [], 0
        if held:
            yield from _joined(follow(steps, window, *columns(pa.Table.from_batches(held))))

    return gaps.mapInArrow(run, _PLACED)


def _joined(batches: Iterator[pa.RecordBatch], rows: int = 1 << 16) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of some size."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += len(batch)
        if size >= rows:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if size:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def pack(
    docs: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text",
    window: int = WINDOW, end_id: int = END_ID,
) -> DataFrame:
    """key, piece, start, length, ids_crc32, sequence_id, offset of every piece.

    Sequences of one full piece have negative numbers.
    """
    cut = saved(pieces(docs, tokenizer_path, key, text, window, end_id).withColumn("place", F.monotonically_increasing_id()), "best-fit-pieces")
    names = ["key", "piece", "start", "length", "ids_crc32"]
    whole = cut.where(F.col("length") == window).select(*names, (-1 - F.col("place")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    placed = place(cut.where(F.col("length") < window).withColumn("size", F.col("length").cast("int")), window)
    return whole.unionByName(placed.select(*names, "sequence_id", "offset")).withColumnRenamed("key", key)


def place(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``items`` (size, a unique ``place``, further columns) with sequence_id and offset."""
    spark = items.sparkSession
    ranked = numbered(items, "size", "place", "best-fit-sorted")
    counts = sorted(((r["size"], r["n"]) for r in ranked.groupBy("size").agg(F.count("*").alias("n")).collect()), reverse=True)
    sweep, gaps, rounds = Sweep(window), spark.createDataFrame([], _PLACED), []
    low = window
    while counts:
        low = min(low // 2, counts[0][0] - 1)
        due = [x for x in counts if x[0] > low]
        counts = counts[len(due):]
        first = sweep.opened
        steps = sweep.round(due)
        if opened := sweep.opened - first:
            parts = -(-opened // GAPS_AT_ONCE)
            fresh = spark.range(first, sweep.opened, 1, parts).select(
                F.lit(None).cast("int").alias("size"), F.lit(0).cast("long").alias("rank"), F.col("id").alias("sequence_id"), F.lit(-1).cast("long").alias("at"),
            )
            gaps = gaps.unionByName(fresh) if rounds else fresh
        done = saved(_round(gaps, steps, window), "best-fit-round")
        rounds.append(done.where("size IS NOT NULL"))
        gaps = done.where("size IS NULL")
    if not rounds:
        return items.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")}).where("false")
    placed = rounds[0]
    for more in rounds[1:]:
        placed = placed.unionByName(more)
    return ranked.join(placed.withColumnRenamed("at", "offset"), ["size", "rank"]).drop("rank")
