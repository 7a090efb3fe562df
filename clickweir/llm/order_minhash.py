r"""MinHash near-dedup by Order MinHash, with candidates verified by banded alignment.

A text is its sequence of five-word shingles (words in lower case). Shingles are labelled
with the number of their occurrence, and each of ``SLOTS`` samples takes the ``PICKED``
labelled shingles with the smallest hashes and keeps them in text order: two texts share a
slot's key if they share those shingles in that order, so keys follow edit similarity. Texts
that have s of all their u shingles in common share a slot with probability C(s, PICKED) /
C(u, PICKED); at similarity 0.8 and from 16 shingles on they miss all slots less than once in
50,000. Of short texts this is not enough, so texts of up to ``SHORT`` shingles have further
keys: by one order of hashes their first shingles, as many as may not be lacking in the other
text plus one. Two such texts of similarity 0.8 have one of these in common for certain.

The similarity of two texts is matches / (shingles of both - matches), where the matches are
those of the best alignment of the two sequences (of texts without moved parts: the Jaccard
similarity of their shingles; it is never more).

Equal texts are one node, and the nodes of a bucket are not met pair by pair. All of them are
aligned with two pivots, the nodes that share most keys with others, which joins a crowd of
near copies to one component. Nodes of buckets with more than one component are then met by
their rarest labelled shingles (``rare_pairs``), which loses no linked pair. In a crowd of
texts that were edited apart the edits are the rare shingles, and no two texts share them; so
such texts hardly meet, however many share a key.

Texts are read once; what is shuffled are keys and, for candidates only, word hashes. Every
intermediate table is written to the shared folder.

Defined results: a null text counts as an empty one; texts without words are copies only of
equal texts; texts of fewer than five words are one shingle; a class is its component, named by
its smallest id, by null if it has none, and by its root besides where ids repeat; one row of
each is kept; rows repeated in full are copies; other columns, whatever
their names, are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import add

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweir.llm.frames import components, packed, saved

SHINGLE = 5
SIMILARITY = 0.8
SLOTS = 24
PICKED = 4
SHORT = 15
PARITY_BITS = 2048
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_BYTES_AT_ONCE = 1 << 23
_CELLS_AT_ONCE = 1 << 13


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that scatters them (the finalizer of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Hashes of all runs of ``size`` words; one of the whole text if it is shorter."""
    if len(words) == 0:
        return np.zeros(0, np.uint64)
    words = words.astype(np.uint64)
    runs = max(1, len(words) - size + 1)
    code = np.full(runs, min(size, len(words)), np.uint64)
    for k in range(min(size, len(words))):
        code = (code + words[k:k + runs] + np.uint64(1)) * _MULTIPLIER
        code ^= code >> np.uint64(29)
    return _mixed(code)


def _labelled(codes: np.ndarray) -> np.ndarray:
    """Shingle hashes made distinct by the number of their occurrence."""
    order = np.argsort(codes, kind="stable")
    ranked = codes[order]
    fresh = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    if fresh.all():
        return codes
    first = np.maximum.accumulate(np.where(fresh, np.arange(len(codes)), 0))
    label = np.empty(len(codes), np.uint64)
    label[order] = (np.arange(len(codes)) - first).astype(np.uint64)
    return _mixed(codes + label * _MULTIPLIER)


def sketch(words: np.ndarray, slots: int = SLOTS, picked: int = PICKED) -> np.ndarray:
    """One key per slot, and those of a short text behind them; none for a text without words."""
    codes = shingles(words)
    if len(codes) == 0:
        return np.zeros(0, np.int64)
    labelled = _labelled(codes)
    keys = np.arange(1, slots + 1, dtype=np.uint64)
    take = min(picked, len(codes))
    at_once = max(1, _CELLS_AT_ONCE // len(codes))
    for begin in range(0, slots, at_once):  # all slots of a text together, unless it is very long
        part = slice(begin, begin + at_once)
        order = _mixed(labelled[None, :] ^ _mixed(keys[part] * _MULTIPLIER)[:, None])
        chosen = np.sort(np.argpartition(order, take - 1, axis=1)[:, :take], axis=1)
        for column in codes[chosen].T:
            keys[part] = keys[part] * _MULTIPLIER + column
    if len(codes) <= SHORT:
        needed = math.ceil(SIMILARITY * len(codes) - 1e-9)
        keys = np.concatenate([keys, np.sort(labelled)[:len(codes) - needed + 1]])
    return _mixed(keys).view(np.int64)


def alignment_distance(a: np.ndarray, b: np.ndarray, limit: float) -> float | None:
    """One minus the similarity of two shingle sequences; None if it exceeds ``limit``.

    Common ends are taken off, then the longest common subsequence is counted in the band
    of diagonals that a distance within ``limit`` can reach, a row at a time in one integer.
    """
    n, m = len(a), len(b)
    most = int(limit * (n + m) / (2 - limit))  # insertions and deletions at that distance
    if abs(n - m) > most:
        return None
    short = min(n, m)
    differs = np.flatnonzero(a[:short] != b[:short])
    head = int(differs[0]) if len(differs) else short
    a, b, short = a[head:], b[head:], short - head
    differs = np.flatnonzero(a[::-1][:short] != b[::-1][:short])
    tail = int(differs[0]) if len(differs) else short
    a, b = a[:len(a) - tail], b[:len(b) - tail]
    matches = head + tail
    if len(a) and len(b):
        values, count_a = np.unique(a, return_counts=True)
        others, count_b = np.unique(b, return_counts=True)
        _, at, bt = np.intersect1d(values, others, assume_unique=True, return_indices=True)
        if n + m - 2 * (matches + int(np.minimum(count_a[at], count_b[bt]).sum())) > most:
            return None
        matches += _common(a, b, most)
    steps = n + m - 2 * matches
    return 2 * steps / (n + m + steps) if steps <= most else None


def _common(a: np.ndarray, b: np.ndarray, band: int) -> int:
    """Length of the longest common subsequence within ``band`` diagonals of the main one."""
    places: dict[int, list[int]] = {}
    for i, code in enumerate(a.tolist()):
        places.setdefault(code, []).append(i)
    low, high, found = 0, min(len(a), band + 1), 0
    row = (1 << high) - 1  # bits of a[low:high]; a zero is a match on the best path so far
    for j, code in enumerate(b.tolist()):
        new_low, new_high = max(0, j - band), min(len(a), j + band + 1)
        if new_low >= len(a):
            break
        if new_low > low:
            gone = new_low - low
            found += gone - (row & ((1 << gone) - 1)).bit_count()
            row >>= gone
        if new_high > high:
            row |= ((1 << (new_high - high)) - 1) << (high - new_low)
        low, high = new_low, new_high
        mask = 0
        for i in places.get(code, ()):
            if low <= i < high:
                mask |= 1 << (i - low)
        if mask:
            hit = row & mask
            row = ((row + hit) | (row - hit)) & ((1 << (high - low)) - 1)
    return found + (high - low) - row.bit_count()


def _word_codes(texts: pa.Array):
    """For each text the 32-bit hashes of its words."""
    import xxhash

    plain = pc.utf8_lower(pc.replace_substring_regex(texts, "[\\x09-\\x0D]", " "))
    split = pc.split_pattern(plain, " ")
    coded = split.flatten().dictionary_encode()
    hashes = np.fromiter((xxhash.xxh32_intdigest(w) for w in coded.dictionary.to_pylist()), np.uint32, len(coded.dictionary))
    empty = pc.index(coded.dictionary, "").as_py()
    which = np.asarray(coded.indices)
    bounds = np.asarray(split.offsets) - split.offsets[0].as_py()
    for begin, end in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        part = which[begin:end]
        yield hashes[part if empty < 0 else part[part != empty]]


def sketches(docs: DataFrame, key: str = "doc_id", text: str = "text", slots: int = SLOTS, picked: int = PICKED) -> DataFrame:
    """One row per row of ``docs``: doc, node (of its text), keys, words (32-bit hashes, compressed)."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).alias("doc"), F.unhex(F.md5(body)).alias("node"), body.alias("text"))
    key_list = pa.list_(pa.int64())

    def run(batches):
        import zstandard

        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            begin, count = 0, batch.num_rows
            sizes = np.cumsum(np.asarray(pc.binary_length(batch["text"])))
            while begin < count:
                end = max(begin + 1, int(np.searchsorted(sizes, (sizes[begin - 1] if begin else 0) + _BYTES_AT_ONCE)))
                part = batch.slice(begin, end - begin)
                coded = list(_word_codes(part["text"]))
                yield pa.RecordBatch.from_arrays([
                    part["doc"], part["node"], pa.array([sketch(w, slots, picked) for w in coded], key_list),
                    pa.array([packer.compress(w.tobytes()) for w in coded], pa.binary()),
                ], ["doc", "node", "keys", "words"])
                begin = end

    kind = rows.schema["doc"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc {kind}, node binary, keys array<bigint>, words binary")


def aligned(pairs: DataFrame, texts: DataFrame, limit: float) -> DataFrame:
    """(a, b, distance) of every pair of nodes; the distance is null beyond ``limit``."""
    joined = (
        pairs.join(texts.select(F.col("node").alias("a"), F.col("words").alias("words_a")).hint("merge"), "a")
        .join(texts.select(F.col("node").alias("b"), F.col("words").alias("words_b")).hint("merge"), "b")
        .select("a", "b", "words_a", "words_b")
    )

    def run(batches):
        import zstandard

        unpacker = zstandard.ZstdDecompressor()

        def read(words):
            return shingles(np.frombuffer(unpacker.decompress(words), np.uint32))

        for batch in batches:
            found = [alignment_distance(read(x), read(y), limit) for x, y in zip(batch["words_a"], batch["words_b"], strict=True)]
            yield pd.DataFrame({"a": batch["a"], "b": batch["b"], "distance": pd.array(found, "Float64")})

    return joined.mapInPandas(run, "a binary, b binary, distance double")


def rare_pairs(nodes: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """(a, b) of the ``nodes`` (node, root, minor) of different roots that can be linked.

    Of two linked texts of n <= m shingles each lacks few of the other's: both together at most
    r * (n + m) with r = (1 - similarity) / (1 + similarity), the one with n at most r * n, the
    other at most (1 - similarity) * m. In one order of all labelled shingles, rarest first,
    their first common one is therefore among the first r * n + 1 of the one and the first
    (1 - similarity) * m + 1 of the other. What stands before it in either is lacking, so the
    two places add up to no more than r * (n + m); a text with too many shingles that no other
    node has takes no part. Each text also has a bitmap of the parities of its shingles' hashes:
    every bit in which two differ takes a shingle that one of them lacks, so more than
    r * (n + m) of them rule a pair out.
    """
    ratio, share = (1 - similarity) / (1 + similarity) + 1e-9, 1 - similarity + 1e-9
    code_list = pa.list_(pa.int64())

    def coded(batches):
        import zstandard

        unpacker = zstandard.ZstdDecompressor()
        for batch in batches:
            found = [_labelled(shingles(np.frombuffer(unpacker.decompress(w), np.uint32))) for w in batch["words"].to_pylist()]
            odd = [np.packbits(np.bincount(x % np.uint64(PARITY_BITS), minlength=PARITY_BITS).astype(np.uint8) & 1).view(np.int64) for x in found]
            yield pa.RecordBatch.from_arrays(
                [batch["node"], pa.array([x.view(np.int64) for x in found], code_list), pa.array(odd, code_list)], ["node", "codes", "parity"],
            )

    chosen = texts.join(nodes.select("node").hint("merge"), "node", "left_semi").select("node", "words")
    read = saved(chosen.mapInArrow(coded, "node binary, codes array<bigint>, parity array<bigint>"), "omh-codes")
    codes = read.select("node", F.explode("codes").alias("code"))
    common = codes.groupBy("code").agg(F.count("*").alias("uses"))
    ranked = saved(
        codes.join(common.hint("merge"), "code").groupBy("node").agg(
            F.count("*").alias("n"), F.count_if(F.col("uses") == 1).alias("own"), F.sort_array(F.collect_list(F.struct("uses", "code"))).alias("codes"),
        )
        .where(F.col("own") <= F.col("n") * share)
        .select("node", "n", "own", F.slice("codes.code", F.lit(1), (F.col("n") * share).cast("int") + 1).alias("codes"))
        .join(nodes.hint("merge"), "node").join(read.select("node", "parity").hint("merge"), "node"), "omh-rare",
    )

    def side(mark: str, rows: DataFrame, codes: Column) -> DataFrame:
        names = ["node", "root", "minor", "n", "parity"]
        return rows.select(F.posexplode(codes).alias(f"{mark}_at", "code"), *(F.col(c).alias(f"{mark}_{c}") for c in names))

    less = side("s", ranked.where(F.col("own") <= F.col("n") * ratio), F.slice("codes", F.lit(1), (F.col("n") * ratio).cast("int") + 1))
    more = side("l", ranked, F.col("codes"))
    unlike = [F.bit_count(F.get("s_parity", F.lit(i)).bitwiseXOR(F.get("l_parity", F.lit(i)))) for i in range(PARITY_BITS // 64)]
    fits = (
        (F.col("s_root") != F.col("l_root")) & (F.col("s_minor") | F.col("l_minor"))
        & (F.col("s_n") <= F.col("l_n")) & (F.col("l_n") * (1 - share) <= F.col("s_n"))
        & (F.col("s_at") + F.col("l_at") <= (F.col("s_n") + F.col("l_n")) * ratio)
        & (reduce(add, unlike) <= (F.col("s_n") + F.col("l_n")) * ratio)
    )
    return less.join(more.hint("merge"), "code").where(fits).select(
        F.least("s_node", "l_node").alias("a"), F.greatest("s_node", "l_node").alias("b"),
    ).distinct()


def links(rows: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(a, b) of linked nodes: enough of them to hold every component together.

    ``rows`` are those of ``sketches``; rows of the same node are equal.
    """
    near = 1 - similarity + 1e-9
    nodes = saved(rows.select("node", "keys").groupBy("node").agg(F.first("keys").alias("keys")), "omh-nodes")
    # A key tells its slot; those of short texts meet at any place.
    every = nodes.select("node", F.explode_outer("keys").alias("key")).where("key is not null").select(
        "node", "key", F.xxhash64("key").alias("bucket"),
    )
    shared = saved(every.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1").select("bucket"), "omh-shared")
    members = saved(every.join(shared.hint("merge"), "bucket", "left_semi"), "omh-members")
    wanted = saved(members.select("node").distinct(), "omh-wanted")
    # From here on only texts that share a key with another one matter.
    texts = saved(
        rows.select("node", "words").join(wanted.hint("merge"), "node", "left_semi").groupBy("node").agg(F.first("words").alias("words")), "omh-texts",
    )
    # The pivots of a bucket are its most central nodes, those with the most company in all
    # their buckets: the text that a crowd was copied from is close to all of the crowd.
    sizes = members.groupBy("bucket").agg(F.count("*").alias("size"))
    central = members.join(sizes.hint("merge"), "bucket").groupBy("node").agg(F.sum("size").alias("central"))
    ranked = saved(members.join(saved(central, "omh-central").hint("merge"), "node"), "omh-ranked")
    best = F.max(F.struct("central", "node"))
    low = ranked.groupBy("bucket").agg(best.alias("best"), F.count("*").alias("size")).where("size > 1")
    first = saved(ranked.join(low.select("bucket", F.col("best.node").alias("low")).hint("merge"), "bucket"), "omh-pivots")
    high = first.where("node <> low").groupBy("bucket").agg(best.alias("best"))
    met = saved(
        first.select("bucket", "node", "low").join(high.select("bucket", F.col("best.node").alias("high")).hint("merge"), "bucket"), "omh-met",
    )
    pairs = met.where("node <> low").select(F.col("low").alias("p"), F.col("node").alias("q")).union(
        met.where("node <> high and node <> low").select(F.col("high").alias("p"), F.col("node").alias("q")),
    ).select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b"))
    known = saved(aligned(saved(pairs.distinct(), "omh-pairs"), texts, near), "omh-aligned")
    linked = known.where(f"distance <= {near}").select("a", "b")
    roots = saved(components(linked, "omh-first"), "omh-roots")

    # What is left are pairs of a bucket in different components. In the common case a bucket
    # is one component but for a few nodes.
    placed = saved(
        met.select("bucket", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "omh-placed",
    )
    main = placed.groupBy("bucket", "root").agg(F.count("*").alias("size")).groupBy("bucket").agg(
        F.max(F.struct("size", "root")).alias("main"), F.count("*").alias("parts"),
    ).where("parts > 1").select("bucket", F.col("main.root").alias("main"))
    split = placed.join(saved(main, "omh-main").hint("merge"), "bucket").groupBy("node", "root").agg(
        F.bool_or(F.col("root") != F.col("main")).alias("minor"),
    )
    apart = rare_pairs(saved(split, "omh-split"), texts, similarity)
    apart = saved(apart.join(known.select("a", "b"), ["a", "b"], "left_anti"), "omh-apart")
    if apart.isEmpty():
        return linked
    found = aligned(apart, texts, near).where(f"distance <= {near}").select("a", "b")
    return linked.union(saved(found, "omh-across"))


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """One row per row of ``docs``: key, class_id, ``node``, which names its text, and ``root``.

    Classes whose smallest ids are the same id differ in ``root``.
    """
    rows = saved(sketches(docs, key, text), "omh-sketches")
    roots = saved(components(links(rows, similarity), "omh"), "omh-classes")
    placed = rows.select("doc", "node").join(roots, "node", "left").select(
        "doc", "node", F.coalesce("root", "node").alias("root"),
    )
    placed = saved(placed, "omh-placed")
    names = saved(placed.groupBy("root").agg(F.min("doc").alias("class_id")), "omh-names")
    return placed.join(names, "root").select(F.col("doc").alias(key), "class_id", "node", "root")


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """The row of each class whose id is its smallest; one of them if several have that id."""
    found = saved(classes(docs, key, text, similarity), "omh-found")
    first = F.min(F.struct(F.col(key).isNull().alias("last"), F.col(key).alias("who"), "node", "n"))
    kept = saved(
        found.groupBy(key, "root", "node").agg(F.count("*").alias("n")).groupBy("root").agg(first.alias("first"))
        .select("first.who", "first.node", "first.n"), "omh-kept",
    )
    rows = docs.select(
        packed(docs).alias("row"), F.col(key).alias("own"), F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")))).alias("own_node"),
    )
    left = rows.join(kept, (F.col("own_node") == F.col("node")) & F.col("own").eqNullSafe(F.col("who")))
    # Rows that repeat both id and text are one document.
    single = left.where("n = 1").select("row")
    if not kept.where("n > 1").isEmpty():
        single = single.union(left.where("n > 1").groupBy("own", "own_node").agg(F.first("row").alias("row")).select("row"))
    return single.select(*(F.col("row")[c].alias(c) for c in docs.columns))
