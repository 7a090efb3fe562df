r"""Quality rules as a short-circuit cascade, all of it in built-in functions.

The counts of a document (words, symbols, repeated lines, repeated three-word windows) are
computed inside its row, without a shuffle. Rules are conditions that reject a document. On
a sample of bounded size the cost of each rule is timed and its rejections are counted; rules
are then put in the order of rejections per second and become branches of one CASE, so that a document is
left alone by all rules behind the one that rejects it. The order changes the time, never
the verdict.

Repeated windows: every window of three words gets a 40-bit hash above its 24-bit position;
after one sort of these numbers equal windows are neighbours, whose words are then compared.
Where neighbours of one hash have different words, or positions need more than 24 bits, the
windows of that document are sorted by their words instead, so a collision of hashes neither
counts nor hides anything.

Defined results: a null, empty or blank text has no words, zero counts and fails the base
rule; a null doc_id stays null; repeated rows are judged alike, once per row; other columns,
whatever their names, are ignored; an empty table gives no rows (and an arbitrary order of
rules).
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweir.llm.frames import words

MIN_WORDS = 50
SAMPLE_ROWS = 2000
# Variants of a text that a rule is timed on, and times each query is run.
REPEATS = 16
ROUNDS = 2
LEAST_SECONDS = 0.005
POSITION_BITS = 24


@dataclass(frozen=True)
class Rule:
    """``rejects`` is a condition on a document's text and counts."""

    name: str
    rejects: str


# What the cascade rejects besides the base rule.
RULES = [
    Rule("symbols", "n_symbols > 0.1 * n_words"),
    Rule("repeated_lines", "n_dup_lines > 0.3 * n_lines"),
    Rule("word_length", "word_chars < 2 * n_words OR word_chars > 15 * n_words"),
    Rule("no_letters", "length(regexp_replace(text, '[^\\\\p{L}]', '')) < 0.5 * word_chars"),
    Rule("bullets", r"regexp_count(text, '(?m)^[\\x20\\t]*[-*•]') > 0.9 * n_lines"),
    Rule("ellipses", r"regexp_count(text, '(?m)(\\.\\.\\.|…)[\\x20\\t]*$') > 0.3 * n_lines"),
]


def counted(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, text and the counts of every document; ``n_lines`` counts lines with a word."""
    low = (1 << POSITION_BITS) - 1
    body = docs.select(F.col(key).alias("key"), F.coalesce(text, F.lit("")).alias("text"))
    split = body.withColumn("words", words(F.col("text"))).withColumn(
        "lines", F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
    )
    basic = split.select(
        "key", "text", "words",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.regexp_replace("text", r"[\x20\x09-\x0D]", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", r"[^#*$%&|<>]", "")).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
    )
    w = F.col("words")
    places = F.when(F.col("n_words") > 2, F.sequence(F.lit(1), F.col("n_words").cast("int") - 2)).otherwise(F.array().cast("array<int>"))
    # The sort is ascending over longs without nulls: one primitive sort per document.
    keyed = basic.withColumn("windows", F.sort_array(F.transform(
        places, lambda i: F.shiftleft(F.xxhash64(F.get(w, i - 1), F.get(w, i), F.get(w, i + 1)), POSITION_BITS).bitwiseOR(i.cast("long")),
    )))

    def same(a: Column, b: Column) -> Column:
        i, j = a.bitwiseAND(low).cast("int") - 1, b.bitwiseAND(low).cast("int") - 1
        return (
            (F.shiftright(a, POSITION_BITS) == F.shiftright(b, POSITION_BITS))
            & (F.get(w, i) == F.get(w, j)) & (F.get(w, i + 1) == F.get(w, j + 1)) & (F.get(w, i + 2) == F.get(w, j + 2))
        )

    def hash_of(a: Column) -> Column:
        return F.shiftright(a, POSITION_BITS)

    v = F.col("windows")
    collided = F.filter(v, lambda x, i: F.coalesce((hash_of(x) == hash_of(F.get(v, i + 1))) & ~same(x, F.get(v, i + 1)), F.lit(False)))
    sure = keyed.withColumn("exact", (F.col("n_words") > low) | (F.size(collided) > 0))
    found = F.filter(v, lambda x, i: F.coalesce(same(x, F.get(v, i + 1)), F.lit(False)) | ((i > 0) & F.coalesce(same(x, F.get(v, i - 1)), F.lit(False))))
    by_words = sure.withColumn("windows_by_words", F.when(F.col("exact"), F.sort_array(F.transform(
        places, lambda i: F.struct(F.get(w, i - 1).alias("a"), F.get(w, i).alias("b"), F.get(w, i + 1).alias("c"), i.cast("long").alias("i")),
    ))))
    u = F.col("windows_by_words")

    def equal(x: Column, y: Column) -> Column:
        return F.coalesce((x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"]), F.lit(False))

    found_by_words = F.filter(u, lambda x, i: equal(x, F.get(u, i + 1)) | ((i > 0) & equal(x, F.get(u, i - 1))))
    starts = by_words.withColumn("starts", F.when(
        F.col("exact"), F.transform(found_by_words, lambda x: x["i"]),
    ).otherwise(F.transform(found, lambda x: x.bitwiseAND(low))))
    covered = F.when(F.size("starts") == 0, F.lit(0)).otherwise(F.size(F.array_distinct(F.concat(
        F.col("starts"), F.transform("starts", lambda s: s + 1), F.transform("starts", lambda s: s + 2),
    ))))
    # As a generated column the counts are computed once, whatever is asked of them later: the
    # optimizer would otherwise put their expressions into every condition on them.
    return starts.select("key", "text", F.inline(F.array(F.struct(
        "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", covered.cast("long").alias("n_repeat_words"),
    ))))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def ordered_rules(counts: DataFrame, rules: list[Rule] | None = None, sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Rules by rejections per second on the first ``sample_rows`` rows of ``counts``, best first.

    Each query below ends in a limit, so Spark starts with one task and takes more only until
    there are enough rows, whatever the number of tasks; flags and sizes come back, no texts.
    A rule is evaluated on ``REPEATS`` variants of each text, so that its own time stands out
    from that of computing the counts, which a query with an empty rule measures alike.
    """
    rules = RULES if rules is None else rules
    flags = [F.coalesce(F.expr(rule.rejects), F.lit(False)).cast("int").alias(f"rule{i}") for i, rule in enumerate(rules)]
    seen = counts.select(*flags).limit(sample_rows).collect()
    if not seen:
        return list(rules)
    rejected = [sum(row[i] for row in seen) for i in range(len(rules))]
    variants = f"transform(sequence(1, {REPEATS}), i -> concat(text, cast(i AS string)))"
    read = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]

    def seconds(condition: str) -> float:
        # within the lambda ``text`` is the variant
        hits = F.expr(f"size(filter({variants}, text -> coalesce({condition}, false)))")
        query = counts.select(F.least(hits, *(F.col(c).cast("int") for c in read)).alias("x")).limit(sample_rows)
        times = []
        for _ in range(ROUNDS):
            start = time.perf_counter()
            query.collect()
            times.append(time.perf_counter() - start)
        return min(times)

    empty = seconds("text IS NULL")
    rated = [(hits / max(seconds(rule.rejects) - empty, LEAST_SECONDS), rule) for hits, rule in zip(rejected, rules, strict=True)]
    return [rule for _, rule in sorted(rated, key=lambda x: -x[0])]


def cascade(counts: DataFrame, rules: list[Rule]) -> DataFrame:
    """``counts`` with ``rejected_by``: the first rule, in this order, that rejects; else null."""
    verdict = F.when(base_failed(), F.lit("base"))
    for rule in rules:
        verdict = verdict.when(F.expr(rule.rejects), F.lit(rule.name))
    return counts.withColumn("rejected_by", verdict)


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text", rules: list[Rule] | None = None) -> DataFrame:
    """Counts of every document, ``base_failed`` and ``kept``."""
    counts = counted(docs, key, text)
    judged = cascade(counts, ordered_rules(counts, rules))
    return judged.select(
        F.col("key").alias(key), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed().alias("base_failed"), F.col("rejected_by").isNull().alias("kept"),
    )
