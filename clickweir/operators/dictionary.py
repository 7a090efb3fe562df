"""Per-language title dictionary: surrogate ids, encoding and decoding.

Titles get ids 1..N within a language in the order (first month seen, title). Ids are
never changed once given; later titles are numbered after the largest id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickweir.functions.periods import month_index
from clickweir.session import stage

# Fewer than this many titles can each hold more than 1/HOT_TITLES of all uses, so the
# hot-title frame has a proven size bound (a few MB) and is safe to broadcast. A title
# below the bound has too few rows to slow one task down.
HOT_TITLES = 100_000
# Hot and missing keys are spread over this many stand-in keys that match nothing.
STAND_INS = 1 << 20
# A sieve has at most this many words of 64 bits, some 80 MB as a broadcast frame.
SIEVE_WORDS = 1 << 21
# This many keys share a word. With three bits each, some 2 % of other keys pass.
SIEVE_KEYS = 4
# monotonically_increasing_id() keeps the partition number above this bit.
_ROW_BITS = 33


def title_stats(silver: DataFrame) -> DataFrame:
    """(lang, title, first_ym, uses) over both ends of every edge, in one pass.

    Uses are combined before the shuffle, so a title on a third of all rows sends one
    row per task.
    """
    return (
        silver.select(
            "lang",
            month_index().alias("ym"),
            F.explode(F.array("curr_title", "prev_title")).alias("title"),
        )
        .filter(F.col("title").isNotNull())
        .groupBy("lang", "title")
        .agg(F.min("ym").alias("first_ym"), F.count("*").alias("uses"))
    )


def _sieve_place(by: list[str], words: int) -> tuple[Column, Column]:
    """A key's word in a sieve, and its three bits there."""
    code = F.xxhash64(*by)
    one = F.lit(1).cast("long")
    bits = [
        F.call_function("shiftleft", one, F.shiftright(code, start).bitwiseAND(63).cast("int"))
        for start in (24, 34, 44)
    ]
    return F.pmod(code, F.lit(words)), bits[0].bitwiseOR(bits[1]).bitwiseOR(bits[2])


def sifted(dictionary: DataFrame, wanted: DataFrame, by: list[str]) -> DataFrame:
    """The dictionary without most of the entries whose key ``wanted`` does not hold.

    A Bloom filter of one word for each key, ahead of an exact join on ``by``: what it
    drops is in no row of ``wanted``. Made of ``wanted``, a written table, and broadcast;
    its size is checked, and with too many keys for it the dictionary stays as it is.
    """
    keys, words = wanted.count(), 1
    while words * SIEVE_KEYS < keys:
        words *= 2
    if words > SIEVE_WORDS:
        return dictionary
    word, bits = _sieve_place(by, words)
    sieve = wanted.groupBy(word.alias("_word")).agg(F.bit_or(bits).alias("_bits"))
    place, asked = _sieve_place(by, words)
    return (
        dictionary.withColumns({"_place": place, "_asked": asked})
        .join(F.broadcast(sieve), F.col("_place") == F.col("_word"))
        .filter(F.col("_bits").bitwiseAND(F.col("_asked")) == F.col("_asked"))
        .select(*dictionary.columns)
    )


def match_titles(stats: DataFrame, dictionary: DataFrame) -> DataFrame:
    """The statistics with the ids already given; ``id`` is NULL for a new title."""
    return stats.join(dictionary, ["lang", "title"], "left")


def largest_ids(dictionary: DataFrame) -> DataFrame:
    return dictionary.groupBy("lang").agg(F.max("id").alias("base"))


def number_titles(fresh: DataFrame, dictionary: DataFrame | None = None) -> DataFrame:
    """Give ids to (lang, first_ym, title) rows, after the ids of ``dictionary``.

    Equal to ``row_number()`` per language, but no language passes through one task:
    the titles are range-partitioned and sorted in parallel, the sorted copy is written
    with its positions, and one count per (partition, language) turns positions into
    ids. The written copy is used for both, so range boundaries cannot shift between.
    """
    order = ["lang", "first_ym", "title"]
    placed = stage(
        fresh.select(*order)
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("place", F.monotonically_increasing_id()),
        "title-order",
    )
    part = F.shiftright("place", _ROW_BITS)
    before = Window.partitionBy("lang").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per (partition, language): the languages are sorted, so there are fewer
    # rows than partitions plus languages.
    slices = (
        placed.groupBy("lang", part.alias("part"))
        .agg(F.count("*").alias("size"), F.min("place").alias("start"))
        .withColumn("skip", F.coalesce(F.sum("size").over(before), F.lit(0)))
    )
    if dictionary is not None:
        slices = slices.join(largest_ids(dictionary), "lang", "left")
        slices = slices.withColumn("skip", F.col("skip") + F.coalesce("base", F.lit(0)))
    slices = slices.select("lang", "part", "start", "skip")
    return (
        placed.withColumn("part", part)
        .join(F.broadcast(slices), ["lang", "part"])
        .select("lang", (F.col("place") - F.col("start") + F.col("skip") + 1).alias("id"), "title")
    )


def backfill(stats: DataFrame) -> DataFrame:
    """The whole dictionary in one go, from the statistics of all months."""
    return number_titles(stats)


def hot_titles(stats: DataFrame, dictionary: DataFrame, limit: int = HOT_TITLES) -> DataFrame:
    """Dictionary rows of titles that hold more than 1/``limit`` of all uses.

    By counting there are fewer than ``limit`` of them.
    """
    total = stats.agg(F.sum("uses")).scalar()
    heavy = stats.filter(F.col("uses") * limit > total).select("lang", "title")
    return dictionary.join(F.broadcast(heavy), ["lang", "title"], "left_semi")


def hot_ids(rows: DataFrame, dictionary: DataFrame, limit: int = HOT_TITLES) -> DataFrame:
    """Dictionary rows of ids found in more than 1/``limit`` of the id cells of ``rows``.

    Reads ``rows`` twice, so it should be a written table.
    """
    sides = [F.col(c) for c in ("curr_id", "prev_id") if c in rows.columns]
    used = rows.select("lang", F.explode(F.array(*sides)).alias("id"))
    counted = used.groupBy("lang", "id").agg(F.count("*").alias("uses"))
    total = used.agg(F.count("*")).scalar()
    heavy = counted.filter(F.col("uses") * limit > total).select("lang", "id")
    return dictionary.join(F.broadcast(heavy), ["lang", "id"], "left_semi")


def spread_keys(rows: DataFrame, by: str, take: str, using: str, hot: DataFrame | None) -> DataFrame:
    """Add ``_key``, the key to look ``using`` up with, and ``_quick``, a ready answer.

    Rows whose key is hot get their answer from a small broadcast frame; those rows and
    rows with a NULL key then carry a spread-out stand-in key, so the shuffle of the
    lookup never puts one key's rows into one task.
    """
    spread = F.pmod(F.xxhash64(*rows.columns), F.lit(STAND_INS))
    stand_in = F.concat(F.lit("\u0000"), spread.cast("string")) if by == "title" else -1 - spread
    if hot is None:
        kind = "long" if take == "id" else "string"
        rows = rows.withColumn("_quick", F.lit(None).cast(kind))
    else:
        quick = hot.select(
            F.col("lang").alias("_hot_lang"), F.col(by).alias("_hot_key"), F.col(take).alias("_quick")
        )
        matches = (F.col("lang") == F.col("_hot_lang")) & (F.col(using) == F.col("_hot_key"))
        rows = rows.join(F.broadcast(quick), matches, "left").drop("_hot_lang", "_hot_key")
    cold = F.when(F.col("_quick").isNull(), F.col(using))
    return rows.withColumn("_key", F.coalesce(cold, stand_in))


def _attach(
    rows: DataFrame,
    dictionary: DataFrame,
    by: str,
    take: str,
    using: str,
    name: str,
    hot: DataFrame | None,
) -> DataFrame:
    """Add ``name``: the dictionary's ``take`` for the row's ``using`` value, or NULL.

    Stand-in keys match no entry, and the answer does not depend on the second join for
    rows that carry one.
    """
    entries = dictionary.select(
        F.col("lang").alias("_lang"), F.col(by).alias("_entry"), F.col(take).alias("_found")
    )
    matched = spread_keys(rows, by, take, using, hot).join(
        entries, (F.col("lang") == F.col("_lang")) & (F.col("_key") == F.col("_entry")), "left"
    )
    answer = F.when(F.col(using).isNotNull(), F.coalesce("_quick", "_found"))
    return matched.select(*rows.columns, answer.alias(name))


def encode_ids(
    silver: DataFrame,
    dictionary: DataFrame,
    hot: DataFrame | None = None,
    row_no: str | None = None,
) -> DataFrame:
    """Silver edges with ids for titles; an unknown or missing referrer stays NULL.

    Rows are spread by their values. Where a large share of the rows may be copies of
    one row, ``row_no`` names a column of the written input that tells them apart; it
    has to be stored, as a number made up during the join could change on a retry.
    """
    silver = silver.select(
        "lang", "year", "month", "prev_title", "curr_title", "n", *([row_no] if row_no else [])
    )
    with_target = _attach(silver, dictionary, "title", "id", "curr_title", "curr_id", hot)
    known = with_target.filter(F.col("curr_id").isNotNull()).drop("curr_title")
    both = _attach(known, dictionary, "title", "id", "prev_title", "prev_id", hot)
    return both.select(
        "lang", "year", "month", "prev_id", "curr_id", F.col("n").cast("long").alias("n")
    )


def decode_ids(rows: DataFrame, dictionary: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Replace every ``<side>_id`` column by ``<side>_title``, for rows as many as Gold's.

    Both sides are shuffled, with the hot titles taken out first.
    """
    sides = [side for side in ("curr", "prev") if f"{side}_id" in rows.columns]
    for side in sides:
        rows = _attach(rows, dictionary, "id", "title", f"{side}_id", f"{side}_title", hot)
    return rows.drop(*[f"{side}_id" for side in sides])


def used_entries(frames: list[DataFrame], dictionary: DataFrame) -> DataFrame:
    """Dictionary entries of all ids in ``frames``; the dictionary is read once for them."""
    used = [
        frame.select("lang", F.col(c).alias("id"))
        for frame in frames for c in ("curr_id", "prev_id") if c in frame.columns
    ]
    wanted = used[0]
    for more in used[1:]:
        wanted = wanted.union(more)
    wanted = stage(wanted.filter(F.col("id").isNotNull()).distinct(), "used-ids")
    return sifted(dictionary, wanted, ["lang", "id"]).join(wanted, ["lang", "id"], "left_semi")


def label_ids(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Replace every ``<side>_id`` column by the title that ``labels`` has for it.

    For ranked rows, which hold an id a few times at most; which side is sent where is the
    planner's choice, as written tables have known sizes.
    """
    for side in ("curr", "prev"):
        if f"{side}_id" in rows.columns:
            entries = labels.withColumnsRenamed({"id": f"{side}_id", "title": f"{side}_title"})
            rows = rows.join(entries, ["lang", f"{side}_id"], "left").drop(f"{side}_id")
    return rows
