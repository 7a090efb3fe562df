r"""Line dedup: a log-template tree of fixed depth, in built-in functions only.

A line is a list of tokens; a token with a digit is a variable field and becomes ``<*>``. The
tree sorts lines by their number of tokens, then by their first ``DEPTH`` tokens. In a leaf,
where all lines have the same length, a template is the masked line, or, for lines of
``GENERAL`` tokens or more, the masked line with one of ``SEGMENTS`` equal parts of the rest
left open, which generalises fields that hold no digit. A template that occurs in at least
``MIN_DOCS`` documents recurs: its first line by document and place stays, all others go.
With ``long_docs`` the masked line of a long line recurs from that many documents on; long are
lines of ``GENERAL`` tokens, at least half of them fixed, or of ``LONG_CHARS`` fixed characters,
as such lines hardly repeat by chance. With ``min_chars`` lines of fewer than ``MIN_TOKENS``
tokens (a script without blanks, a URL) are counted too if they have that many characters; in
these only the digits of a token vary. With ``cuts`` the open parts are as long but start at
every ``cuts``-th of their length, so that a field across the border of two parts is in a third
one. ``PASSAGES`` sets these for the query and the pipeline.

What still escapes: fields without a digit that lie in different parts or are longer than one,
among the first ``DEPTH`` tokens, that change the number of tokens, and those of lines of fewer
than ``GENERAL`` tokens, where one open word would also join sentences that are merely alike.

Templates are hashed, counted with partial aggregation by (template, document) and then by
template, so a line that every third document holds is one row a task. Texts are shuffled
once, to meet the numbers of the lines they lose.

Defined results: a document is its id and text, so rows repeated in full count once and all
get the same result; a null text stays null and an empty one empty; a null id is ordered
after all others; lines of fewer than ``MIN_TOKENS`` tokens always stay, with ``min_chars``
only if they are shorter; ties cannot occur, as places differ; other columns are carried along whatever their names; an empty table gives
no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweir.llm.frames import BLANKS, packed, saved, words, written
from clickweir.session import scratch, staging_dir

DEPTH = 2
SEGMENTS = 4
GENERAL = 12
MIN_TOKENS = 3
MIN_DOCS = 3
LONG_CHARS = 60
MIN_CHARS = 30
PASSAGES = {"long_docs": 2, "min_chars": MIN_CHARS, "cuts": 2}
FIELD = "<*>"
TOKEN = r"[^\x20\x09-\x0D]++"

# A token with a digit, met at the token's start only, so that long tokens cost linear time.
VARIABLE = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9]*+[0-9][^\x20\x09-\x0D]*+"


def _occurrences(
    docs: DataFrame, key: str, text: str, depth: int, segments: int, general: int, min_tokens: int,
    long_docs: int | None, min_chars: int | None, cuts: int,
) -> DataFrame:
    """doc, text_hash, line and template: a row for every template of every line.

    A line's parts are hashed once, and its templates are hashes of those. The outer form of
    explode keeps the optimizer from computing what is exploded twice, for a filter on size.
    With ``long_docs`` the lowest bit of a template tells whether it is of a whole long line.
    """
    n_parts = segments * cuts

    def bound(j: int) -> Column:
        return F.lit(depth) + F.floor((F.col("n") - depth) * j / n_parts).cast("int")

    lines = docs.select(
        F.col(key).alias("doc"), F.xxhash64(text).alias("text_hash"), F.posexplode_outer(F.split(text, "\n")).alias("line", "body"),
    )
    has_digit, counted = F.col("body").rlike("[0-9]"), F.col("n") >= min_tokens
    masked = F.when(has_digit, F.regexp_replace("body", VARIABLE, FIELD)).otherwise(F.col("body"))
    if min_chars is not None:
        # One or two tokens, as many as min_tokens leaves out.
        few = F.col("body").rlike(rf"^(?:{BLANKS}+)?+(?:{TOKEN}{BLANKS}+){{0,{max(min_tokens - 2, 0)}}}{TOKEN}(?:{BLANKS}+)?+$")
        masked = F.when(has_digit & few, F.regexp_replace("body", "[0-9]++", FIELD)).otherwise(masked)
        counted = counted | ((F.col("n") > 0) & (F.col("size") >= min_chars))
    read = lines.select("doc", "text_hash", "line", F.length(F.btrim("body", F.lit(" \t\n\x0b\f\r"))).alias("size"), masked.alias("masked"))
    n_chars, fixed_chars = F.length("masked"), F.length(F.replace("masked", F.lit(FIELD), F.lit("")))
    tokens = read.select(
        "doc", "text_hash", "line", "size", words(F.col("masked")).alias("tokens"),
        fixed_chars.alias("fixed_chars"), ((n_chars - fixed_chars) / len(FIELD)).cast("int").alias("fields"),
    ).withColumn("n", F.size("tokens"))
    long = ((F.col("n") >= general) & (2 * F.col("fields") <= F.col("n"))) | (F.col("fixed_chars") >= LONG_CHARS)
    hashed = tokens.select(
        "doc", "text_hash", "line", "n", "size", long.alias("long"), F.xxhash64(F.slice("tokens", 1, depth)).alias("head"),
        *(F.xxhash64(F.slice(F.col("tokens"), bound(j) + 1, F.greatest(bound(j + 1) - bound(j), F.lit(0)))).alias(f"part{j}") for j in range(n_parts)),
    )
    parts = [f"part{j}" for j in range(n_parts)]
    exact = F.xxhash64(F.col("n"), F.lit(-1), F.col("head"), *map(F.col, parts))
    opened = [
        F.xxhash64(F.col("n"), F.lit(j), F.col("head"), *map(F.col, parts[:j] + parts[j + cuts:])) for j in range(n_parts - cuts + 1)
    ]
    if long_docs is not None:
        even = F.lit(-2).cast("long")
        exact = exact.bitwiseAND(even).bitwiseOR(F.col("long").cast("long"))
        opened = [x.bitwiseAND(even) for x in opened]
    templates = F.when(F.col("n") >= general, F.array(exact, *opened)).when(counted, F.array(exact))
    return hashed.select("doc", "text_hash", "line", F.explode_outer(templates).alias("template")).where("template is not null")


def recurring_lines(
    docs: DataFrame, key: str = "doc_id", text: str = "text", min_docs: int = MIN_DOCS,
    depth: int = DEPTH, segments: int = SEGMENTS, general: int = GENERAL, min_tokens: int = MIN_TOKENS,
    long_docs: int | None = None, min_chars: int | None = None, cuts: int = 1,
) -> DataFrame:
    """One row per document that loses lines: doc, text_hash, dropped (numbers from 0)."""
    dropped = staging_dir(docs.sparkSession, "line-dropped")
    with scratch(docs.sparkSession):  # occurrences and templates go once their lines are found
        occurrences = saved(_occurrences(docs, key, text, depth, segments, general, min_tokens, long_docs, min_chars, cuts), "line-occurrences")
        first = F.struct(F.col("doc").isNull().alias("last"), "doc", "text_hash", "line")
        needed = F.lit(min_docs)
        if long_docs is not None:
            needed = F.when(F.col("template").bitwiseAND(F.lit(1)) == 1, long_docs).otherwise(min_docs)
        recurring = saved(
            occurrences.groupBy("template", "doc", "text_hash").agg(F.min("line").alias("line"))
            .groupBy("template").agg(F.count("*").alias("docs"), F.min(first).alias("first"))
            .where(F.col("docs") >= needed)
            .select("template", F.col("first.doc").alias("first_doc"), F.col("first.text_hash").alias("first_hash"), F.col("first.line").alias("first_line")),
            "line-templates",
        )
        is_first = (
            F.col("doc").eqNullSafe(F.col("first_doc")) & (F.col("text_hash") == F.col("first_hash")) & (F.col("line") == F.col("first_line"))
        )
        return written(
            occurrences.join(recurring.hint("merge"), "template").where(~is_first)
            .groupBy("doc", "text_hash").agg(F.sort_array(F.collect_set("line")).alias("dropped")),
            dropped,
        )


def drop_recurring(docs: DataFrame, key: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """All rows of ``docs`` with recurring lines taken out of ``text``."""
    lost = recurring_lines(docs.select(key, text), key, text, **settings)
    body, who = F.col("row")[text], F.col("row")[key]
    # One way of joining at every size: what is lost grows with the documents.
    joined = docs.select(packed(docs).alias("row")).join(
        lost.hint("merge"), who.eqNullSafe(F.col("doc")) & (F.xxhash64(body) == F.col("text_hash")), "left",
    )
    joined = joined.withColumn("lines", F.when(F.col("dropped").isNotNull(), F.split(body, "\n")))
    left = F.transform(
        F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("dropped")), lambda i: F.get(F.col("lines"), i),
    )
    shorter = F.when(F.col("dropped").isNull(), body).otherwise(F.array_join(left, "\n"))
    return joined.select(*(
        (shorter if c == text else F.col("row")[c]).alias(c) for c in docs.columns
    ))
