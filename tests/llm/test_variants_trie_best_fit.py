"""Spelling variants, the conversation trie and best-fit packing against brute force and odd input."""

import bisect
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clickweir.llm import best_fit, prefix_trie, spelling_fst

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


# 11 spelling variants

def near(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:]


def forms(counts: dict[str, int]) -> set[tuple]:
    found = {}
    for word, n in counts.items():
        others = [(-counts[x], x) for x in counts if near(word, x)]
        best = min(others, default=(0, None))
        found[word] = (best[1] if -best[0] >= 10 * n else None, len(others))
    out = set()
    for word, (form, n_near) in found.items():
        root = word
        while found[root][0]:
            root = found[root][0]
        out.add((word, form, root, counts[word], n_near, counts.get(form)))
    return out


@pytest.mark.parametrize("letters", [8, 1 << 20])
def test_spelling_equals_brute_force(spark, letters):
    rnd = random.Random(letters)
    words = {"".join(rnd.choice("aabcé\U0001f600") for _ in range(rnd.randint(2, 7))) for _ in range(400)}
    words |= {"x" * n for n in range(2, 40)}
    counts = {w: rnd.choice([1, 2, 25, 300, 4000]) for w in words}
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = spelling_fst.variants(frame, min_length=2, group_letters=letters)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(counts) and set(rows) == forms(counts)


def test_spelling_vocabulary(spark):
    rows = [(1, "Straßenbahn straßenbahn Straßenbahn, kurz"), (2, None), (3, ""), (None, "STRAßENBAHN x"), (5, "abcdefg " * 40), (5, "abcdefg " * 40), (6, "q" * 30_000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("clash") for c in ("word", "n", "run", "id", "h", "key")})
    want = Counter()
    for doc, text in rows:
        for run in "".join(c if c.isalpha() else " " for c in text or "").split():
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            at = h % len(run)
            word = run[:at] + run[at + 1:] if h % 31 == 0 else run
            want[word] += len(word) >= 7
    got = {r["word"]: r["n"] for r in spelling_fst.vocabulary(frame).collect()}
    assert got == {w: n for w, n in want.items() if n >= 2}


def test_spelling_of_nothing(spark):
    docs = spark.createDataFrame([(1, None), (2, "short words only")], "doc_id long, text string")
    assert spelling_fst.variants(spelling_fst.vocabulary(docs)).collect() == []
    assert spelling_fst.variants(spelling_fst.vocabulary(docs.limit(0))).collect() == []


# 12 conversation trie

def trie(rows) -> set[tuple]:
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            convs[conv].append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [t[2:] for t in sorted(x)] for c, x in convs.items()}
    rebuilt = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = convs.get(c - (abs(c) % 5 if c >= 0 else -(abs(c) % 5)), [])[:h] + own[h:]
    members = defaultdict(list)
    for c, path in rebuilt.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for path, who in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += not children[path]
            saved[path[:d]] += (len(who) - 1) * len(path[-1][1].encode()) if path else 0
    return {
        (min(who), len(p), min(members[p[:-1]]) if p else None, len(who), children[p], leaves[p], saved[p],
         hashlib.sha256(",".join(str(c) for c in sorted(who) if len(rebuilt[c]) == len(p)).encode()).hexdigest())
        for p, who in members.items()
    }


def conversations(seed: int, count: int):
    rnd, rows = random.Random(seed), []
    for c in rnd.sample(range(-20, 4 * count), count):
        if rnd.random() < 0.05:
            path = [("user", "copy"), ("assistant", "of many")]
        else:
            path = [(rnd.choice(["user", "assistant", None]), rnd.choice(["a", "b", "é", "", None])) for _ in range(rnd.choice([1, 2, 3, 5, 8, 14]))]
        rows += [(c, rnd.choice([None, i, i]), role, text) for i, (role, text) in enumerate(path)]
    return rows


@pytest.mark.parametrize("seed", range(1))
def test_trie_equals_brute_force(spark, seed):
    rows = conversations(seed, 400) + [(7, i, "user", f"long {i % 3}") for i in range(3000)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    frame = frame.withColumns({c: F.lit("clash") for c in ("conv", "c", "depth", "k1", "part", "row", "path", "bytes")})
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")  # so that subtrees and conversations span tasks
    try:
        got = [tuple(r) for r in prefix_trie.nodes(frame.repartition(7)).select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()]
    finally:
        spark.conf.unset(key)
    want = trie(rows)
    assert len(got) == len(want) and set(got) == want


def test_trie_of_few_conversations(spark):
    shape = "conv_id long, turn long, role string, text string"
    for rows in ([(None, 0, "user", "x")], [(c, 0, "u", "t") for c in range(-9, 9)]):
        got = {tuple(r) for r in prefix_trie.nodes(spark.createDataFrame(rows, shape)).select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()}
        assert got == trie(rows)


def test_findclose_over_many_blocks():
    rnd = random.Random(1)
    bits, depth = [], 0
    for left in range(20_000, 0, -1):
        up = depth == 0 or (depth < left and rnd.random() < 0.55)
        bits.append(up)
        depth += 1 if up else -1
    bits = [True, *bits, *[False] * (depth + 1)]
    stack, want = [], {}
    for i, up in enumerate(bits):
        if up:
            stack.append(i)
        else:
            want[stack.pop()] = i
    at = np.flatnonzero(np.array(bits))
    assert prefix_trie.Parentheses(np.array(bits)).findclose(at).tolist() == [want[i] for i in at.tolist()]


# 13 best-fit packing

def best_fit_decreasing(sizes, window: int) -> int:
    gaps, opened = [], 0
    for size in sorted(sizes, reverse=True):
        i = bisect.bisect_left(gaps, size)
        room = gaps.pop(i) if i < len(gaps) else window
        opened += room == window
        if room > size:
            bisect.insort(gaps, room - size)
    return opened


@pytest.mark.parametrize("seed", range(2))
def test_rounds_use_as_many_sequences_as_one_by_one(spark, seed):
    rnd = random.Random(seed)
    window = rnd.choice([16, 100, 500])
    sizes = [min(window - 1, 1 + int(rnd.expovariate(1 / rnd.choice([3, 20, 90])))) for _ in range(3000)] + [7] * 1500
    items = spark.createDataFrame(list(enumerate(sizes)), "place long, size int").repartition(5)
    rows = best_fit.place(items, window).collect()
    assert sorted(r["place"] for r in rows) == list(range(len(sizes)))
    assert check_sequences([(r["sequence_id"], r["offset"], r["size"]) for r in rows], window) == best_fit_decreasing(sizes, window)


def check_sequences(rows, window: int) -> int:
    held = defaultdict(list)
    for sequence, offset, size in rows:
        held[sequence].append((offset, size))
    for pieces in held.values():
        at = 0
        for offset, size in sorted(pieces):
            assert offset == at
            at += size
        assert at <= window
    return len(held)


def test_best_fit_pieces(spark):
    rows = [(1, None), (2, ""), (None, "some text"), (3, "word " * 9000), (4, "one two"), (4, "one two"), (5, "x" * 20_000), (6, "\x1f é漢\U0001f600 <|endoftext|>")]
    rows += [(10 + i, f"filler {i} " * (i % 50)) for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("clash") for c in ("key", "size", "rank", "place", "piece", "row_", "part_")})
    got = best_fit.pack(frame, TOKENIZER, window=512).collect()
    tokenizer, want = Tokenizer.from_file(TOKENIZER), []
    for doc, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        want += [(str(doc), i, a, len(ids[a:a + 512]), zlib.crc32(ids[a:a + 512].tobytes())) for i, a in enumerate(range(0, len(ids), 512))]
    assert sorted((str(r["doc_id"]), *r[1:5]) for r in got) == sorted(want)
    assert check_sequences([(r["sequence_id"], r["offset"], r["length"]) for r in got], 512) == best_fit_decreasing([x[3] for x in want], 512)


def test_best_fit_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    got = best_fit.pack(empty, TOKENIZER)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and got.collect() == []
    full = spark.createDataFrame([(1, "word " * 4095)], "doc_id long, text string")
    assert [r["length"] for r in best_fit.pack(full, TOKENIZER).collect()] == [4096]
