"""Conversation prefix trie: balanced parentheses by shard, spines of shards merged.

Conversations are put in order by turn; a conversation c is rebuilt from the first h turns of
conversation c - c % 5 and its own turns after its first h. A node is a distinct sequence of
first turns of rebuilt conversations.

Digests. Turns are numbered by one range sort with positions and prefix digests carried over
the borders of partitions, so a conversation of any length is spread over tasks. The digest of
a prefix is the polynomial sum of its turns' hashes in two 64-bit halves, which can be shifted:
a rebuilt prefix follows from the head's digest and the difference of two own ones.

Shards. A turn that no other conversation shares begins a private tail, whose nodes have one
member, one leaf and nothing to save; only the shared part of a path and the first private
turn enter the trie. Of conversations with equal paths the smallest stands for all. Paths are
range-sorted over tasks, and each task writes its paths' trie as a sequence of parentheses.
Blocks of the excess (opening less closing ones) with their minima form a tree that is climbed
to find the closing parenthesis of every node (``findclose``); a subtree is what lies between.
The rank of leaf pairs ``()`` counts its leaves, and cumulative arrays over the nodes in order
give its members and savings.

Spines. A node on the first or last path of a shard may go on in the next one. Its counts add
up over shards: members and leaves as they are, a node's bytes and its place among its parent's
children only where the path of its smallest member lies. Savings are the sum of members times
bytes, less bytes of each node once, so they add up too. All other nodes are final.

Member hashes. The ids that end at a node are sorted over tasks and joined to pieces of text;
one stream hashes a node's pieces, as the hash is defined over all of them in order.

Defined results: null role and text are empty; rows with a null conversation id are left out;
equal turn numbers are ordered by role, then text, null numbers first; repeated rows are
repeated turns; other columns, whatever their names, are ignored; an empty table has no nodes.
A task holds the trie part of its shard; a path that several conversations share is one row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweir.llm.frames import saved

GROUP = 5
HEADS = 9
# Odd multipliers of the two halves of a digest.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
BLOCK = 64
PIECE = 1 << 16
_EMPTY = hashlib.sha256(b"").hexdigest()
_KEY = ["depth", "k1", "k2"]
_NODE = "depth long, k1 long, k2 long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"


def power(base: int, exponent: np.ndarray) -> np.ndarray:
    """base ** exponent modulo 2 ** 64; negative exponents use the inverse."""
    out = np.ones(len(exponent), np.uint64)
    for sign, factor in ((1, base), (-1, pow(base, -1, 1 << 64))):
        left = np.maximum(sign * exponent, 0)
        while left.any():
            out[(left & 1) == 1] *= np.uint64(factor)
            left, factor = left >> 1, factor * factor % (1 << 64)
    return out


def _u64(column) -> np.ndarray:
    return np.asarray(column).astype(np.int64).view(np.uint64)


def _table(names: list[str], *columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64) if x.dtype == np.uint64 else x) for x in columns], names)


def numbered_turns(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, pos, bytes, q1, q2): every turn's place and the digest of all turns up to it."""
    said = rows.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"),
    ).withColumn("row", F.monotonically_increasing_id())
    order = ["conv", F.col("turn").asc_nulls_first(), "role", "text", "row"]
    hashed = said.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv", F.xxhash64("role", "text").alias("t1"), F.xxhash64(F.lit(1), "text", "role").alias("t2"),
        F.octet_length("text").cast("long").alias("bytes"),
    )
    names = ["part", "conv", "pos", "bytes", "q1", "q2"]

    def local(batches):
        part, held = TaskContext.get().partitionId(), (None, 0, 0, 0)
        for batch in batches:
            if not len(batch):
                continue
            key, size = np.asarray(batch["conv"]), np.asarray(batch["bytes"])
            head = np.flatnonzero(np.concatenate([[True], np.diff(key) != 0]))
            run = np.repeat(np.arange(len(head)), np.diff(np.append(head, len(key))))
            pos = np.arange(len(key)) - head[run]
            goes_on = key[0] == held[0]
            if goes_on:
                pos[run == 0] += held[1]
            sums = []
            for base, name, before in ((BASES[0], "t1", held[2]), (BASES[1], "t2", held[3])):
                total = np.cumsum(_u64(batch[name]) * power(base, pos), dtype=np.uint64)
                skip = np.concatenate([np.zeros(1, np.uint64), total])[head]
                if goes_on:
                    skip[0] = np.uint64(0) - np.uint64(before)
                sums.append(total - skip[run])
            held = (key[-1], int(pos[-1]) + 1, int(sums[0][-1]), int(sums[1][-1]))
            yield _table(names, np.full(len(key), part), key, pos, size, *sums)

    placed = saved(hashed.mapInArrow(local, ", ".join(f"{x} long" for x in names)), "trie-turns")
    # One row for each task: its first conversation, and the last with its length and digest.
    borders = placed.groupBy("part").agg(F.min("conv").alias("first"), F.max(F.struct("conv", "pos", "q1", "q2")).alias("last")).orderBy("part").collect()
    carry, running = {}, (None, 0, 0, 0)
    for row in borders:
        last = row["last"]
        n, q1, q2 = last["pos"] + 1, last["q1"], last["q2"]
        if row["first"] == running[0]:
            carry[row["part"]] = running
        if last["conv"] == running[0]:
            shift = [pow(base, running[1], 1 << 64) for base in BASES]
            n, q1, q2 = n + running[1], running[2] + shift[0] * q1, running[3] + shift[1] * q2
        running = (last["conv"], n, q1 % (1 << 64), q2 % (1 << 64))

    def whole(batches):
        for batch in batches:
            part, key, pos, size = (np.array(batch[x]) for x in names[:4])
            sums = [np.array(_u64(batch[x])) for x in names[4:]]
            for number in set(part.tolist()) & carry.keys():
                conv, n, *before = carry[number]
                here = (part == number) & (key == conv)
                pos[here] += n
                for total, base, q in zip(sums, BASES, before, strict=True):
                    total[here] = total[here] * np.uint64(pow(base, n, 1 << 64)) + np.uint64(q)
            yield _table(names[1:], key, pos, size, *sums)

    return placed.mapInArrow(whole, ", ".join(f"{x} long" for x in names[1:]))


def rebuilt(turns: DataFrame, group: int = GROUP, heads: int = HEADS) -> tuple[DataFrame, DataFrame]:
    """Rebuilt turns (c, depth, k1, k2, bytes, last), and the length of every conversation (conv, total)."""
    first = F.when(F.col("pos") < heads - 1, F.struct("pos", "bytes", "q1", "q2"))
    convs = saved(
        turns.groupBy("conv").agg((F.max("pos") + 1).alias("n"), F.sort_array(F.collect_list(first)).alias("firsts")), "trie-convs",
    )
    bases = convs.where(F.col("conv") % group == 0).select(F.col("conv").alias("base"), F.col("firsts").alias("head"))
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % heads).cast("int")
    plan = convs.withColumns({"h": h, "base": F.col("conv") - F.col("conv") % group}).join(bases, "base", "left")
    plan = plan.withColumn("head", F.slice(F.coalesce("head", F.array().cast(convs.schema["firsts"].dataType)), F.lit(1), F.col("h")))
    n_head, own = F.size("head"), F.least("h", "n").cast("int")
    plan = saved(plan.select(
        "conv", "h", "head", n_head.cast("long").alias("n_head"), (n_head + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("total"),
        *(F.coalesce(F.get("head", n_head - 1)[q], F.lit(0)).alias(f"head_{q}") for q in ("q1", "q2")),
        *(F.coalesce(F.get("firsts", own - 1)[q], F.lit(0)).alias(f"own_{q}") for q in ("q1", "q2")),
    ), "trie-plan")
    shape = "c long, depth long, k1 long, k2 long, bytes long, last boolean"

    def shifted(batches):
        for batch in batches:
            n_head, h, pos, total = (np.asarray(batch[x]).astype(np.int64) for x in ("n_head", "h", "pos", "total"))
            depth = n_head + pos - h + 1
            keys = [
                _u64(batch[f"head_{q}"]) + power(base, n_head - h) * (_u64(batch[q]) - _u64(batch[f"own_{q}"]))
                for base, q in zip(BASES, ("q1", "q2"), strict=True)
            ]
            yield _table(["c", "depth", "k1", "k2", "bytes", "last"], np.asarray(batch["conv"]), depth, *keys, np.asarray(batch["bytes"]), depth == total)

    behind = turns.join(plan.drop("head"), "conv").where("pos >= h").mapInArrow(shifted, shape)
    front = plan.select("conv", "total", F.explode("head").alias("x")).select(
        F.col("conv").alias("c"), (F.col("x.pos") + 1).alias("depth"), F.col("x.q1").alias("k1"), F.col("x.q2").alias("k2"),
        "x.bytes", (F.col("x.pos") + 1 == F.col("total")).alias("last"),
    )
    return front.unionByName(behind), plan.select("conv", "total")


class Parentheses:
    """A sequence of balanced parentheses with a tree of block minima of its excess."""

    def __init__(self, opening: np.ndarray):
        self.excess = np.cumsum(np.where(opening, 1, -1))
        blocks = -(-len(opening) // BLOCK)
        padded = np.full(blocks * BLOCK, np.iinfo(np.int64).max)
        padded[:len(opening)] = self.excess
        self.padded, level = padded, padded.reshape(blocks, BLOCK).min(1)
        self.levels = [level]
        while len(level) > 1:
            level = np.append(level, np.iinfo(np.int64).max) if len(level) % 2 else level
            self.levels[-1] = level
            level = level.reshape(-1, 2).min(1)
            self.levels.append(level)

    def findclose(self, at: np.ndarray) -> np.ndarray:
        """Place of the parenthesis that closes the one opened at each of ``at``."""
        below = self.excess[at] - 1
        close = np.full(len(at), -1)
        self._scan(np.arange(len(at)), at // BLOCK, at, below, close)
        left = np.flatnonzero(close < 0)
        node, level = at[left] // BLOCK, 0
        found_level, found = np.zeros(len(left), np.int64), np.full(len(left), -1)
        while (found < 0).any():  # climb to the first block to the right that goes low enough
            lows = self.levels[level]
            right = np.minimum(node + 1, len(lows) - 1)
            hit = (found < 0) & (node % 2 == 0) & (node + 1 < len(lows)) & (lows[right] <= below[left])
            found[hit], found_level[hit] = node[hit] + 1, level
            node, level = node // 2, level + 1
        for level in range(len(self.levels) - 1, 0, -1):  # and down to its first low block
            here = found_level == level
            child = found[here] * 2
            found[here] = np.where(self.levels[level - 1][child] <= below[left][here], child, child + 1)
            found_level[here] = level - 1
        self._scan(left, found, found * BLOCK - 1, below, close)
        return close

    def _scan(self, which: np.ndarray, block: np.ndarray, after: np.ndarray, below: np.ndarray, close: np.ndarray) -> None:
        for i in range(BLOCK):
            place = block * BLOCK + i
            hit = (close[which] < 0) & (place > after) & (self.padded[place] == below[which])
            close[which[hit]] = place[hit]


def shard_nodes(size: np.ndarray, k1: np.ndarray, k2: np.ndarray, bytes_: np.ndarray, owner: np.ndarray,
                conv: np.ndarray, n_end: np.ndarray, leaf: np.ndarray, more: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Nodes of a shard's sorted paths, the root first, and which of them may go on elsewhere.

    ``size`` counts the turns of each path; the next four hold its turns one after another,
    ``owner`` the smallest member of each; the rest is by path: its smallest conversation, how
    many end with it, whether it has no longer path, whether a private tail goes on.
    """
    n = len(size)
    start = np.cumsum(size) - size
    path = np.repeat(np.arange(n), size)
    at = np.arange(len(path)) - start[path]
    above = start[path - 1] + at
    shared = (path > 0) & (at < size[path - 1])
    above = np.where(shared, above, 0)
    shared &= (k1 == k1[above]) & (k2 == k2[above])
    common = np.bincount(path[shared], minlength=n)
    new = np.flatnonzero(~shared)
    count = len(new) + 1
    # the parentheses: before a path those of the last one close down to what both share
    closed = np.cumsum(np.concatenate([[0], size[:-1]]) - common)
    open_at = np.concatenate([[0], 1 + np.arange(len(new)) + closed[path[new]]])
    opening = np.zeros(2 * count, bool)
    opening[open_at] = True
    close_at = Parentheses(opening).findclose(open_at)
    # node of every turn of every path: the last one opened at its depth
    node = np.zeros(len(path), np.int64)
    node[new] = np.arange(1, count)
    order = np.lexsort([path, at])
    node[order] = np.maximum.accumulate(node[order] + at[order] * (count + 1)) - at[order] * (count + 1)
    parent = np.where(at[new] > 0, node[new - 1], 0)
    ends = np.zeros(n, np.int64)
    ends[:] = node[start + size - 1]

    # cumulative arrays over nodes in order; a subtree is the nodes opened before it closes
    upto = np.arange(count) + (close_at - open_at + 1) // 2

    def subtree(value: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(value)])
        return total[upto] - total[:count]

    ending = np.zeros(count, np.int64)
    ending[ends] = n_end
    convs = subtree(ending)
    true_leaf = np.zeros(count, bool)
    true_leaf[ends] = leaf
    pair = np.zeros(2 * count + 1, np.int64)
    pair[1:-1] = np.cumsum(opening[:-1] & ~opening[1:] & _at(open_at, true_leaf, 2 * count - 1))
    pair[-1] = pair[-2]
    leaves = pair[close_at] - pair[open_at]
    size_of = np.concatenate([[0], bytes_[new]])
    mine = np.zeros(count, bool)
    mine[node[owner == conv[path]]] = True
    savings = subtree(convs * size_of - mine * size_of)
    children = np.bincount(parent[mine[1:]], minlength=count)
    children[ends] += more
    spine = np.zeros(count, bool)
    spine[0] = True
    for edge in (0, n - 1):
        spine[node[start[edge]:start[edge] + size[edge]]] = True
    zero = np.zeros(1, np.int64)
    owners = np.concatenate([zero, owner[new]])
    return {
        "depth": np.concatenate([zero, at[new] + 1]), "k1": np.concatenate([zero, k1[new]]), "k2": np.concatenate([zero, k2[new]]),
        "conv_id": owners, "parent_conv_id": owners[np.concatenate([zero, parent])], "n_convs": convs,
        "n_children": children, "n_leaves": leaves, "saved_tokens": savings,
    }, spine


def _at(places: np.ndarray, values: np.ndarray, length: int) -> np.ndarray:
    out = np.zeros(length + 1, bool)
    out[places] = values
    return out[:length]


def trie_parts(paths: DataFrame) -> DataFrame:
    """Nodes of each shard of ``paths`` (path, rep, n_end, leaf, more), and whether they are on a spine."""
    turn = ["k1", "k2", "bytes", "owner"]

    def run(batches):
        held = [x for x in batches if len(x)]
        if not held:
            return
        rows = pa.Table.from_batches(held).combine_chunks()
        lists = rows["path"].combine_chunks()
        size = np.diff(np.asarray(lists.offsets)).astype(np.int64)
        flat = lists.flatten()
        nodes, spine = shard_nodes(
            size, *(np.asarray(flat.field(x)) for x in turn),
            *(np.asarray(rows[x]) for x in ("rep", "n_end")), *(rows[x].to_numpy() for x in ("leaf", "more")),
        )
        yield from pa.table({**nodes, "spine": spine}).to_batches(max_chunksize=1 << 16)

    ordered = paths.repartitionByRange("path").sortWithinPartitions("path")
    return ordered.mapInArrow(run, _NODE + ", spine boolean")


def member_hashes(ends: DataFrame) -> DataFrame:
    """depth, k1, k2, ends_sha256 of (depth, k1, k2, c): the hash of all c of a node in order."""
    order = [*_KEY, "c"]

    def joined(batches):
        for batch in batches:
            keys, c = [np.asarray(batch[x]) for x in _KEY], batch["c"].to_pylist()
            edge = np.zeros(max(0, len(c) - 1), bool)
            for x in keys:
                edge |= np.diff(x) != 0
            cuts = [0, *(np.flatnonzero(edge) + 1).tolist(), len(c)]
            firsts = [x for a, b in zip(cuts[:-1], cuts[1:], strict=True) for x in range(a, b, PIECE)]
            bounds = [*firsts, len(c)]
            texts = [",".join(map(str, c[a:b])) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            if texts:
                yield pa.RecordBatch.from_arrays([*(pa.array(x[firsts]) for x in keys), pa.array([c[i] for i in firsts], pa.int64()), pa.array(texts)], [*_KEY, "c", "text"])

    def hashed(batches) -> Iterator[pa.RecordBatch]:
        key, state, done = None, None, []
        for batch in batches:
            for *now, text in zip(*(batch[x].to_pylist() for x in (*_KEY, "text")), strict=True):
                if now != key:
                    if key is not None:
                        done.append((*key, state.hexdigest()))
                    key, state = now, hashlib.sha256(text.encode())
                else:
                    state.update(b"," + text.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done, strict=True)], [*_KEY, "ends_sha256"])
                done = []
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*key, state.hexdigest())], [*_KEY, "ends_sha256"])

    shape = "depth long, k1 long, k2 long, "
    pieces = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(joined, shape + "c long, text string")
    return pieces.repartition(*_KEY).sortWithinPartitions(*order).mapInArrow(hashed, shape + "ends_sha256 string")


def nodes(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    group: int = GROUP, heads: int = HEADS,
) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    turns, lengths = rebuilt(numbered_turns(rows, conv, turn, role, text), group, heads)
    turns = saved(turns, "trie-rebuilt")
    counted = turns.groupBy(*_KEY).agg(
        F.count("*").alias("n"), F.min("c").alias("owner"), F.min(F.when(F.col("last"), F.col("c"))).alias("rep"), F.count_if("last").alias("n_end"),
    )
    turns = saved(turns.join(counted, _KEY), "trie-counted")
    shared = F.col("n") > 1
    ways = saved(turns.groupBy("c").agg(
        F.sort_array(F.collect_list(F.when(shared, F.struct("depth", "k1", "k2", "bytes", "owner")))).alias("path"),
        F.max(F.when(shared, F.struct("depth", "last", "rep", "n_end", "n"))).alias("end"),
        F.min(F.when(~shared, F.struct("depth", "k1", "k2", "bytes", "owner", "last"))).alias("own"),
    ), "trie-paths")
    step = F.transform("path", lambda x: F.struct(x["k1"].alias("k1"), x["k2"].alias("k2"), x["bytes"].alias("bytes"), x["owner"].alias("owner")))
    private = F.col("own").isNotNull()
    paths = ways.where(private | (F.col("end.rep") == F.col("c"))).select(
        F.when(private, F.concat(step, F.array(F.struct("own.k1", "own.k2", "own.bytes", "own.owner")))).otherwise(step).alias("path"),
        F.col("c").alias("rep"), F.when(private, 1).otherwise(F.col("end.n_end")).cast("long").alias("n_end"),
        (private | F.coalesce(F.col("end.n") == F.col("end.n_end"), F.lit(False))).alias("leaf"),
        F.coalesce(~F.col("own.last"), F.lit(False)).alias("more"),
    )
    parts = saved(trie_parts(paths), "trie-parts")
    total = lengths.agg(F.min("conv").alias("least"), F.count_if(F.col("total") == 0).alias("turnless"), F.count_if(F.col("total") > 0).alias("others")).first()
    zero = F.lit(0).cast("long")
    root = lengths.sparkSession.createDataFrame(
        [(0, 0, 0, total["least"], None, total["turnless"], 0, int(not total["others"]), 0)] if total["least"] is not None else [], _NODE,
    )
    spine = parts.where("spine").drop("spine").unionByName(root).groupBy(*_KEY).agg(
        F.min("conv_id").alias("conv_id"), F.min("parent_conv_id").alias("parent_conv_id"),
        *(F.sum(x).alias(x) for x in ("n_convs", "n_children", "n_leaves", "saved_tokens")),
    )
    inner = parts.where("NOT spine").drop("spine").unionByName(spine.select(parts.drop("spine").columns))
    least = F.lit(total["least"]).cast("long")
    inner = inner.withColumns({
        "conv_id": F.when(F.col("depth") == 0, least).otherwise(F.col("conv_id")),
        "parent_conv_id": F.when(F.col("depth") == 0, F.lit(None).cast("long")).when(F.col("depth") == 1, least).otherwise(F.col("parent_conv_id")),
    })
    ends = turns.where("last AND n_end > 1").select(*_KEY, "c").unionByName(
        lengths.where("total = 0").select(zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), F.col("conv").alias("c")),
    )
    alone = F.sha2(F.col("c").cast("string").cast("binary"), 256)
    hashes = member_hashes(ends).unionByName(turns.where("last AND n_end = 1").select(*_KEY, alone.alias("ends_sha256")))
    inner = inner.join(hashes, _KEY, "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_EMPTY)))
    begins = ways.where(private).select("c", F.col("own.depth").alias("begin"))
    one = F.lit(1).cast("long")
    tails = turns.where("n = 1").join(begins, "c").where("depth > begin").select(
        F.col("c").alias("conv_id"), "depth", F.col("c").alias("parent_conv_id"), one.alias("n_convs"),
        F.when(F.col("last"), zero).otherwise(one).alias("n_children"), one.alias("n_leaves"), zero.alias("saved_tokens"),
        F.when(F.col("last"), alone).otherwise(F.lit(_EMPTY)).alias("ends_sha256"),
    )
    return inner.select(tails.columns).unionByName(tails)
