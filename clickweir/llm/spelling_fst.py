r"""Spelling variants: the vocabulary acceptor, a one-edit transducer, and the acceptor again.

Words are maximal runs of letters, in lower case, with enough letters and occurrences. Two
words are near if one code point is inserted, deleted or replaced between them. Near pairs are
the strings accepted by A . E . A, where A is the minimised acyclic acceptor of the vocabulary
and E the transducer of exactly one edit.

Partitions by initial state. Let c be the length of a pair's shorter word and l the number of
code points that both begin with. For a range a <= l < b the words share their first a and
their last c - b code points, so every word is dealt once for each c it can belong to (its
length, and one less) and each half of 0 .. c; the state behind the shared prefix is the
initial state of its group, and only the middle between prefix and suffix is left to accept. A
group whose middles hold more than ``GROUP_LETTERS`` is dealt again by halves of its range,
until it is small or the range holds one position, where a group has at most two words for
each letter: no group grows with the vocabulary. Each pair has one c and one l, so it is met
exactly once.

Composition. A task builds the trie of its sorted middles level by level in numpy, merges
nodes with equal right languages (hashed bottom up, then compared transition by transition),
and forms the reachable states of the product: before the edit both copies are in the same
state; an edit leads to (x, y) by two different labels, or to (x, s) by a label that the other
word lacks here; behind it both read the same labels. States that reach no accepting one are
cut, so that the enumeration that follows meets accepted pairs only. Tasks emit for each word
its count of near words and the best of them, combined by word afterwards.

Defined results: null or empty texts have no words; a null document id counts as an empty one;
repeated rows count as often as they stand; runs of any length are whole; other columns,
whatever their names, are ignored; an empty table gives no words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweir.llm.frames import saved

MIN_LENGTH = 7
MIN_COUNT = 2
DROP_EVERY = 31
RATIO = 10
GROUP_LETTERS = 1 << 20
# Letters of middles that a task holds at a time.
CHUNK_LETTERS = 1 << 21
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def vocabulary(
    docs: DataFrame, key: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT, drop_every: int = DROP_EVERY,
) -> DataFrame:
    """(word, n): words of at least so many letters and occurrences; one run in ``drop_every`` loses a letter."""
    runs = docs.select(
        F.coalesce(F.col(key).cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(F.col(text), F.lit(r"[A-Za-zÀ-ÿ]{%d,}" % min_length), F.lit(0))).alias("run"),
    ).select("id", F.translate("run", _UPPER, _LOWER).alias("run"))
    runs = runs.withColumn("h", F.crc32(F.encode(F.concat("id", F.lit(":"), "run"), "utf-8")))
    at = (F.col("h") % F.length("run")).cast("int")
    word = F.when(
        F.col("h") % drop_every == 0,
        F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.length("run"))),
    ).otherwise(F.col("run"))
    return (
        runs.select(word.alias("word")).groupBy("word").agg(F.count("*").alias("n"))
        .where((F.length("word") >= min_length) & (F.col("n") >= min_count))
    )


def _dealt(rows: DataFrame) -> DataFrame:
    """Key and middle of (word, n, c, a, b)."""
    size = F.length("word")
    behind = F.greatest(F.col("c") - F.col("b"), F.lit(0))
    return rows.select(
        "c", "a", "b",
        F.concat(F.col("word").substr(F.lit(1), F.col("a")), F.lit("\0"), F.col("word").substr(size - behind + 1, behind)).alias("key"),
        F.col("word").substr(F.col("a") + 1, size - behind - F.col("a")).alias("middle"),
        "word", "n",
    )


def _halves(first, end):
    """Both halves of a range of positions, as (a, b)."""
    mid = F.floor((first + end) / 2).cast("int")
    return F.array(F.struct(first.alias("a"), mid.alias("b")), F.struct(mid.alias("a"), end.alias("b")))


def groups(words: DataFrame, min_length: int = MIN_LENGTH, group_letters: int = GROUP_LETTERS) -> DataFrame:
    """Words dealt to groups of bounded size: c, a, b, key, middle, word, n."""
    size = F.length("word")
    c = F.explode(F.when(size > min_length, F.array(size, size - 1)).otherwise(F.array(size)))
    rows = words.select("word", "n", c.alias("c"))
    rows = rows.select("word", "n", "c", F.explode(_halves(F.lit(0), F.col("c") + 1)).alias("r"))
    rows = _dealt(rows.select("word", "n", "c", "r.a", "r.b"))
    keys = ["c", "a", "b", "key"]
    done = None
    while True:
        large = saved(
            rows.groupBy(*keys).agg(F.sum(F.length("middle")).alias("letters"))
            .where((F.col("letters") > group_letters) & (F.col("b") - F.col("a") > 1)).select(*keys),
            "spelling-large",
        )
        if large.isEmpty():
            return rows if done is None else done.unionByName(rows)
        small = rows.join(large, keys, "left_anti").select(rows.columns)
        done = small if done is None else done.unionByName(small)
        split = rows.join(large, keys, "left_semi").select("word", "n", "c", F.explode(_halves(F.col("a"), F.col("b"))).alias("r"))
        rows = saved(_dealt(split.select("word", "n", "c", "r.a", "r.b")), "spelling-split")


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _ranges(start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All integers of the ranges [start, start + size), and the range each is of."""
    which = np.repeat(np.arange(len(size)), size)
    return np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size) + start[which], which


class Trie:
    """Trie of the sorted strings of many groups, one root each, and its minimal states."""

    def __init__(self, group: np.ndarray, letters: np.ndarray, size: np.ndarray, longer: np.ndarray):
        n, width = letters.shape
        same = np.zeros(n, np.int64)
        equal = letters[1:] == letters[:-1]
        unlike = np.concatenate([~equal, np.ones((n - 1, 1), bool)], 1)
        same[1:] = np.minimum(unlike.argmax(1), np.minimum(size[1:], size[:-1]))
        kin = np.concatenate([[False], group[1:] == group[:-1]])
        # a node for every row and depth that the row before does not have; depth 0 is the root
        depth = np.arange(width + 1)
        new = (depth[None, :] > np.where(kin, same, -1)[:, None]) & (depth[None, :] <= size[:, None])
        node = np.zeros((n, width + 1), np.int64)
        node[new] = np.arange(int(new.sum()))
        node = np.maximum.accumulate(node, axis=0)
        row, at = np.nonzero(new)
        inner = at > 0
        self.count = len(row)
        self.parent = np.full(self.count, -1)
        self.parent[inner] = node[row[inner], at[inner] - 1]
        self.label = np.zeros(self.count, np.int64)
        self.label[inner] = letters[row[inner], at[inner] - 1]
        # what ends at a node: 1 a shorter word of a pair, 2 a longer one
        last = node[np.arange(n), size]
        self.ends = np.zeros(self.count, np.uint64)
        self.ends[last] = np.where(longer, 2, 1)
        self.row = np.full(self.count, -1)
        self.row[last] = np.arange(n)
        # children in label order, as the rows are sorted
        self.child = np.argsort(self.parent, kind="stable")
        self.degree = np.bincount(self.parent[inner], minlength=self.count)
        self.first = np.cumsum(self.degree) - self.degree + int((~inner).sum())
        self._minimise(at)

    def _minimise(self, at: np.ndarray) -> None:
        """Equal right languages become one state."""
        sums, code = np.zeros(self.count, np.uint64), np.zeros(self.count, np.uint64)
        by_depth = np.argsort(-at, kind="stable")
        for nodes in np.split(by_depth, np.flatnonzero(np.diff(at[by_depth])) + 1):
            code[nodes] = _mixed(sums[nodes] * np.uint64(4) + self.ends[nodes] + np.uint64(1))
            above = self.parent[nodes]
            if above[0] < 0:
                break
            value = _mixed(code[nodes] + self.label[nodes].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            order = np.argsort(above, kind="stable")
            start = np.flatnonzero(np.concatenate([[True], np.diff(above[order]) > 0]))
            sums[above[order][start]] = np.add.reduceat(value[order], start)
        _, example, self.state = np.unique(code, return_index=True, return_inverse=True)
        like = example[self.state]
        kept, whose = _ranges(self.first, self.degree)
        mine, other = self.child[kept], self.child[_ranges(self.first[like], self.degree)[0]]
        if not (np.array_equal(self.degree, self.degree[like]) and np.array_equal(self.ends, self.ends[like])
                and np.array_equal(self.label[mine], self.label[other]) and np.array_equal(self.state[mine], self.state[other])):
            raise RuntimeError("two right languages share a hash")
        # transitions of states, and a sorted index of (state, label)
        self.states = len(example)
        self.final, self.deg = self.ends[example], self.degree[example]
        self.start = np.cumsum(self.deg) - self.deg
        arcs, of = _ranges(self.first[example], self.deg)
        self.arc_label, self.arc_to, self.arc_from = self.label[self.child[arcs]], self.state[self.child[arcs]], of
        self.arc_key = of * (1 << 21) + self.arc_label

    def step(self, state: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which have a transition, and its place."""
        key = state * (1 << 21) + label
        place = np.searchsorted(self.arc_key, key)
        place[place == len(self.arc_key)] = 0
        found = self.arc_key[place] == key if len(self.arc_key) else np.zeros(len(key), bool)
        return found, place


def near_rows(trie: Trie, last: bool) -> tuple[np.ndarray, np.ndarray]:
    """Rows of all accepted pairs. ``last``: the range of positions includes the words' ends."""
    t = trie
    none = np.zeros(0, np.int64)
    if not len(t.arc_to):
        return none, none
    # Edits at a state: by two labels (kind 0), or by a label of the longer word (kind 1), behind
    # which both read a label that is not the same again.
    here = np.arange(len(t.arc_to)) - t.start[t.arc_from]
    second, first = _ranges(np.arange(len(t.arc_to)) + 1, t.deg[t.arc_from] - here - 1)
    by_two = np.stack([t.arc_to[first], t.arc_to[second], np.zeros(len(first), np.int64)], 1)
    two_at = np.stack([t.arc_from[first], here[first], here[second]], 1)
    other, arc = _ranges(t.start[t.arc_from], t.deg[t.arc_from])
    found, place = t.step(t.arc_to[arc], t.arc_label[other])
    found &= t.arc_label[other] != t.arc_label[arc]
    arc, other, place = arc[found], other[found], place[found]
    by_one = np.stack([t.arc_to[place], t.arc_to[other], np.ones(len(arc), np.int64)], 1)
    one_at = np.stack([t.arc_from[arc], here[arc], place - t.start[t.arc_to[arc]], here[other]], 1)

    # Reachable states of the product, by rounds of unique ones.
    def code(x, y, kind):
        return (x * t.states + y) * 2 + kind

    codes = np.concatenate([code(*by_two.T), code(*by_one.T)])
    layers, known, frontier = [], none, np.unique(codes)
    links = []
    while len(frontier):
        layers.append(frontier)
        known = np.union1d(known, frontier)
        kind, pair = frontier % 2, frontier // 2
        x, y = pair // t.states, pair % t.states
        arcs, which = _ranges(t.start[x], t.deg[x])
        found, place = t.step(y[which], t.arc_label[arcs])
        arcs, which, place = arcs[found], which[found], place[found]
        to = code(t.arc_to[arcs], t.arc_to[place], kind[which])
        links.append((frontier[which], arcs - t.start[x[which]], place - t.start[y[which]], to))
        frontier = np.setdiff1d(np.unique(to), known, assume_unique=True)
    if not len(known):
        return _direct(t, last, none, none)
    kind, pair = known % 2, known // 2
    accepts = ((t.final[pair // t.states] & np.where(kind == 1, 2, 1).astype(np.uint64)) > 0) & ((t.final[pair % t.states] & np.uint64(1)) > 0)
    source, step_x, step_y, to = (np.concatenate(x) for x in zip(*links, strict=True))
    source, to = np.searchsorted(known, source), np.searchsorted(known, to)
    # cut what accepts nothing: backwards from accepting states until nothing is added
    useful = accepts.copy()
    while True:
        more = useful.copy()
        more[source[useful[to]]] = True
        if np.array_equal(more, useful):
            break
        useful = more
    kept = useful[to]
    source, step_x, step_y, to = source[kept], step_x[kept], step_y[kept], to[kept]
    order = np.argsort(source, kind="stable")
    source, step_x, step_y, to = source[order], step_x[order], step_y[order], to[order]
    fan = np.bincount(source, minlength=len(known))
    begin = np.cumsum(fan) - fan

    # Enumeration: nodes of a state take its edits, then the arcs of the product.
    def starts(at, product):
        good = useful[product]
        at, product = at[good], product[good]
        order = np.argsort(at[:, 0], kind="stable")
        at, product = at[order], product[order]
        size = np.bincount(at[:, 0], minlength=t.states) if len(at) else np.zeros(t.states, np.int64)
        place, node = _ranges((np.cumsum(size) - size)[t.state], size[t.state])
        return node, at[place], product[place]

    node, at, p2 = starts(two_at, np.searchsorted(known, code(*by_two.T)))
    u2, v2 = t.child[t.first[node] + at[:, 1]], t.child[t.first[node] + at[:, 2]]
    node, at, p1 = starts(one_at, np.searchsorted(known, code(*by_one.T)))
    u1 = t.child[t.first[t.child[t.first[node] + at[:, 1]]] + at[:, 2]]
    v1 = t.child[t.first[node] + at[:, 3]]
    u, v, p = np.concatenate([u2, u1]), np.concatenate([v2, v1]), np.concatenate([p2, p1])
    left, right = [], []
    while len(u):
        done = accepts[p]
        left.append(t.row[u[done]])
        right.append(t.row[v[done]])
        arcs, which = _ranges(begin[p], fan[p])
        u, v = t.child[t.first[u[which]] + step_x[arcs]], t.child[t.first[v[which]] + step_y[arcs]]
        p = to[arcs]
    return _direct(t, last, np.concatenate([none, *left]), np.concatenate([none, *right]))


def _direct(t: Trie, last: bool, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """With the pairs whose longer word has one letter more at its end, where that is in range."""
    if last:
        ends = np.flatnonzero((t.parent >= 0) & (t.ends == 2))
        ends = ends[t.ends[t.parent[ends]] == 1]
        left, right = np.concatenate([left, t.row[ends]]), np.concatenate([right, t.row[t.parent[ends]]])
    return left, right


def _near_of(rows: pa.Table, last: bool) -> pa.Table:
    """Near words of rows that share c, a and b and are sorted by key and middle."""
    keys = rows["key"].combine_chunks().dictionary_encode().indices
    middles = rows["middle"].combine_chunks()
    size = np.asarray(pc.utf8_length(middles)).astype(np.int64)
    c = rows["c"][0].as_py()
    words = rows["word"].combine_chunks()
    longer = np.asarray(pc.utf8_length(words)) > c
    flat = np.frombuffer("".join(middles.to_pylist()).encode("utf-32-le"), np.uint32)
    letters = np.zeros((len(size), max(1, int(size.max()))), np.int64)
    letters[np.arange(letters.shape[1])[None, :] < size[:, None]] = flat
    left, right = near_rows(Trie(np.asarray(keys), letters, size, longer), last)
    source, other = np.concatenate([left, right]), np.concatenate([right, left])
    n = np.asarray(rows["n"])
    rank = np.empty(len(words), np.int64)
    rank[np.asarray(pc.sort_indices(words))] = np.arange(len(words))
    order = np.lexsort([rank[other], -n[other], source])
    source, other = source[order], other[order]
    head = np.flatnonzero(np.concatenate([[True], np.diff(source) > 0])) if len(source) else np.zeros(0, np.int64)
    near = np.diff(np.append(head, len(source)))
    return pa.table({
        "word": words.take(pa.array(source[head])), "near": pa.array(near, pa.int64()),
        "best_n": pa.array(n[other[head]], pa.int64()), "best": words.take(pa.array(other[head])),
    })


def _whole_groups(batches: Iterator[pa.RecordBatch], letters: int) -> Iterator[pa.Table]:
    """Sorted rows in tables that share (c, a, b) and cut no group, of some ``letters`` each."""
    held, size = None, 0
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        held = rows if held is None else pa.concat_tables([held, rows])
        size += pc.sum(pc.utf8_length(batch["middle"])).as_py() or 0
        if size < letters or not len(held):
            continue
        *full, held = _by_range(held)
        yield from full
        key = held["key"].combine_chunks()
        other = pc.not_equal(key, key[len(key) - 1]).to_numpy(zero_copy_only=False)
        if other.any():
            cut = len(key) - int(np.argmax(other[::-1]))
            yield held.slice(0, cut)
            held = held.slice(cut)
        size = pc.sum(pc.utf8_length(held["middle"])).as_py()
    if held is not None and len(held):
        yield from _by_range(held)


def _by_range(rows: pa.Table) -> list[pa.Table]:
    c, a, b = (np.asarray(rows[x]) for x in ("c", "a", "b"))
    edge = np.flatnonzero((np.diff(c) != 0) | (np.diff(a) != 0) | (np.diff(b) != 0)) + 1
    cuts = [0, *edge.tolist(), len(rows)]
    return [rows.slice(x, y - x) for x, y in zip(cuts[:-1], cuts[1:], strict=True)]


def near_words(words: DataFrame, min_length: int = MIN_LENGTH, group_letters: int = GROUP_LETTERS) -> DataFrame:
    """(word, n_near, best_n, best) of words with a near one; ``best``: the most frequent, then smallest, near word."""

    def run(batches):
        for rows in _whole_groups(batches, CHUNK_LETTERS):
            last = rows["b"][0].as_py() > rows["c"][0].as_py()
            if len(rows) > 1:
                yield from _near_of(rows, last).to_batches()

    dealt = groups(words, min_length, group_letters).repartition("c", "a", "b", "key")
    parts = dealt.sortWithinPartitions("c", "a", "b", "key", "middle").mapInArrow(run, "word string, near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("minus_n"), F.col("best").alias("word")))
    return parts.groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("found")).select(
        "word", "n_near", (-F.col("found.minus_n")).alias("best_n"), F.col("found.word").alias("best"),
    )


def variants(words: DataFrame, ratio: int = RATIO, min_length: int = MIN_LENGTH, group_letters: int = GROUP_LETTERS) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of (word, n).

    Forms are followed by doubling: counts grow by ``ratio`` at each step, so a chain of
    forms is short and its doublings are few.
    """
    words = saved(words, "spelling-words")
    found = words.join(near_words(words, min_length, group_letters), "word", "left")
    has = F.col("best_n") >= ratio * F.col("n")
    formed = saved(found.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(has, F.col("best")).alias("form"), F.when(has, F.col("best_n")).alias("form_n"),
    ), "spelling-forms")
    jumps = formed.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        on = jumps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        jumps = saved(jumps.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "spelling-roots")
        if jumps.where("moved").isEmpty():
            break
        jumps = jumps.drop("moved")
    return formed.join(jumps.select("word", "root"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n",
    )
