r"""WARC: archives written by Spark's text sink, read back by verifying record boundaries.

Writing. Every page becomes one record, whose block is an HTTP response with the page's HTML
as payload; the text sink ends every row with CRLF CRLF, as the format asks. Of pages with
equal payloads of at least ``MIN_DEDUP`` bytes the one with the smallest id is written in
full and the others as ``revisit`` records, which keep the headers, the digest and the id of
the full record.

Reading. Tasks cut their splits of the files at the format's magic, wherever it stands, also
inside payloads. Each piece whose header can be read proposes a record and, by its content
length, the offset of its successor. Runs of candidates in which each ends where the next
one begins are contracted to one node; between nodes, pointer jumping from the start of each
file (the set reached and the jump length double in each round) finds the nodes that the
chain of true records visits. All other candidates are text inside payloads. The number of
rounds is the logarithm of the breaks in a file, none if no payload holds the magic.

Files that aren't compressed may be split anywhere. The text sink and source are Spark's, so
any store that Spark reads will do. Offsets are bytes of the uncompressed text.

Defined results: null HTML is an empty payload; a null page_id comes back as null and is
nobody's original unless all copies have null ids; rows that repeat a page_id with equal
payload are each ``response`` if that id is the smallest; all but printable ASCII in a URL is
percent-escaped; an empty table gives no records; other columns, whatever their names, are
ignored. Reading ends a file's chain at the first record that doesn't lead to another one; a
file that doesn't begin with the magic has no records. With ``strict`` a file whose chain
does not reach its end is an error. A compressed file is one stream, not a member for each
record; offsets are of the uncompressed text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickweir.llm.frames import saved

MIN_DEDUP = 100

# Fixed values of the format.
MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"


def _escaped(url: Column) -> Column:
    """``url`` with everything but printable ASCII as percent-escaped UTF-8, so that no header line can end in it."""
    plain = F.coalesce(url, F.lit(""))
    one = F.transform(F.split(plain, ""), lambda c: F.when(c.rlike("[!-~]"), c).otherwise(
        F.regexp_replace(F.hex(F.encode(c, "utf-8")), "(..)", "%$1")))
    return F.when(plain.rlike("[^!-~]"), F.array_join(one, "")).otherwise(plain)


def _urn(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def write_warc(pages: DataFrame, path: str, min_dedup: int = MIN_DEDUP, compression: str = "gzip") -> None:
    """Write one record per row of ``pages`` (page_id, url, html) below ``path``.

    Compressed files are a third as large, and each is read by one task; files written with
    ``compression="none"`` are read in splits.
    """
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("payload")).select(
        "*", F.octet_length("payload").alias("size"), F.sha2("payload", 256).alias("digest"),
    )
    # Groups of copies only, without payloads; written first, so that the planner knows their
    # size and can spare the payloads a shuffle if they are few.
    originals = saved(
        rows.where(F.col("size") >= min_dedup).groupBy("digest")
        .agg(F.min("page_id").alias("original"), F.count("*").alias("copies")).where("copies > 1")
        .select(F.col("digest").alias("copied"), "original"),
        "warc-originals",
    )
    revisit = F.col("original").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("original"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("size"), F.lit(END),
    )
    shared = [
        F.lit("\r\nWARC-Record-ID: "), _urn(F.col("page_id")),
        F.lit("\r\nWARC-Target-URI: "), _escaped(F.col("url")),
        F.lit(f"\r\nWARC-Date: {DATE}\r\nWARC-Payload-Digest: sha256:"), F.col("digest"),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
    ]
    record = F.when(
        revisit,
        F.concat(
            F.lit(f"{MAGIC}WARC-Type: revisit\r\nWARC-Profile: {PROFILE}\r\nWARC-Refers-To: "),
            _urn(F.col("original")), *shared, F.octet_length("http"), F.lit(END), F.col("http"),
        ),
    ).otherwise(
        F.concat(
            F.lit(f"{MAGIC}WARC-Type: response"), *shared,
            F.octet_length("http") + F.col("size"), F.lit(END), F.col("http"), F.col("payload"),
        )
    )
    joined = rows.join(originals, rows["digest"] == originals["copied"], "left")
    joined.withColumn("http", http).select(record.alias("value")).write.option("lineSep", END).option("compression", compression).text(path)


def _field(name: str, value: str, head: str | Column = "head") -> Column:
    """A header's value; only CRLF ends a line."""
    return F.regexp_extract(head, rf"(?i)(?:^|\r\n){name}: *({value}) *(?:\r\n|\z)", 1)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """Every stretch of text between two magics, with what its header says.

    ``digest`` and ``payload_bytes`` are those of the payload if the piece is a whole record.
    """
    text = spark.read.option("lineSep", MAGIC).text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"),
    )
    head = text.withColumn("head", F.when(F.col("value").contains(END), F.substring_index("value", END, 1)))
    fields = head.select(
        "file", "block", "pos", "value",
        F.octet_length("value").cast("long").alias("size"),
        F.when(_field("WARC-Type", "[a-z]+") != "", (F.octet_length("head") + 2 * len(END)).cast("long") + _field("Content-Length", "[0-9]+").try_cast("long")).alias("record"),
        F.length("head").alias("head_chars"),
        F.lower(_field("WARC-Type", "[a-z]+")).alias("record_type"),
        _field("WARC-Record-ID", r"<[^>]*>").alias("id"),
        _field("WARC-Refers-To", r"<[^>]*>").alias("refers"),
        _field("WARC-Payload-Digest", r"sha256:[0-9a-f]+").alias("declared"),
        _field("WARC-Target-URI", r"\S*").alias("url"),
    )
    return fields.withColumn("whole", F.coalesce(F.col("record") == F.col("size"), F.lit(False)))


def _with_payload(records: DataFrame) -> DataFrame:
    """Records whose ``value`` is complete, with their payload's text, size and digest."""
    body = F.substring(F.col("value"), F.col("head_chars") + len(END) + 1, F.length("value"))
    http = F.instr("body", END)
    declared = _field("Content-Length", "[0-9]+", F.substring(F.col("body"), F.lit(1), F.col("http") - 1)).try_cast("long")
    full = (
        records.withColumn("body", body).withColumn("http", http)
        .withColumn("payload", F.when(
            F.col("record_type") != "revisit",
            F.substring(F.col("body"), F.col("http") + len(END), F.length("body") - F.col("http") + 1 - 2 * len(END)),
        ))
    )
    return full.withColumns({
        "payload_bytes": F.when(F.col("record_type") == "revisit", declared).otherwise(F.octet_length("payload").cast("long")),
        "payload_digest": F.when(F.col("record_type") == "revisit", F.substring(F.col("declared"), 8, 64)).otherwise(F.sha2("payload", 256)),
    }).drop("body", "http")


def _reached(nodes: DataFrame, pieces: DataFrame) -> DataFrame:
    """(file, node, entry): nodes on the chain from offset 0, and where it enters them."""
    start = pieces.where("offset = 0").select("file", "node", F.lit(0).cast("long").alias("entry"))
    target = pieces.where("record is not null").select(
        "file", F.col("offset").alias("successor"), F.col("node").alias("to"),
    )
    jumps = saved(
        nodes.join(target, ["file", "successor"]).select("file", "node", "to", F.col("successor").alias("entry")),
        "warc-jumps",
    )
    reached = start
    while not jumps.isEmpty():
        further = reached.select("file", "node").join(jumps, ["file", "node"]).select("file", F.col("to").alias("node"), "entry")
        reached = saved(reached.union(further).distinct(), "warc-reached")
        then = jumps.select("file", F.col("node").alias("to"), F.col("to").alias("last"), F.col("entry").alias("last_entry"))
        jumps = saved(
            jumps.drop("entry").join(then, ["file", "to"])
            .select("file", "node", F.col("last").alias("to"), F.col("last_entry").alias("entry")),
            "warc-jumps",
        )
    return reached


def read_warc(spark: SparkSession, path: str, payloads: bool = True, strict: bool = False) -> DataFrame:
    """The true records below ``path``: file, offset, record_type, id, refers, url, payload
    (null for revisits), payload_bytes, payload_digest. ``payloads=False`` leaves the text out;
    ``strict`` refuses files with something behind their last record.
    """
    # The text of every piece is kept: it may be part of another record's payload. Figures of
    # the payload hold where the piece is a whole record.
    pieces = saved(_with_payload(_pieces(spark, path)).drop("payload"), "warc-pieces")

    in_file = Window.partitionBy("file").orderBy("block", "pos")
    magic = len(MAGIC)
    placed = pieces.select(
        "file", "block", "pos", "size", "record", "whole",
        (F.sum(F.col("size") + magic).over(in_file.rowsBetween(Window.unboundedPreceding, -1)) - magic).alias("offset"),
    ).where("offset is not null")
    by_offset = Window.partitionBy("file").orderBy("offset")
    linked = placed.withColumn("successor", F.col("offset") + F.col("record") + magic)
    joint = F.lag("successor").over(by_offset).eqNullSafe(F.col("offset"))
    chained = linked.withColumn("broken", (~joint).cast("long")).withColumn(
        "node", F.sum("broken").over(by_offset.rowsBetween(Window.unboundedPreceding, 0)),
    ).drop("broken")
    chained = saved(chained, "warc-chain")
    nodes = chained.groupBy("file", "node").agg(F.max_by("successor", "offset").alias("successor")).where("successor is not null")
    reached = _reached(nodes, chained)
    true = chained.join(reached, ["file", "node"]).where("offset >= entry and record is not null").drop("entry")

    if strict:
        length = chained.groupBy("file").agg(F.max(F.col("offset") + F.col("size") + magic).alias("length"))
        chain = true.groupBy("file").agg(F.max("successor").alias("end"))
        cut = length.join(chain, "file", "left").where(~F.col("length").eqNullSafe(F.col("end"))).select("file").take(5)
        if cut:
            raise ValueError(f"the chain of records ends before the file does: {', '.join(r['file'] for r in cut)}")
    names = ["file", "offset", "record_type", "id", "refers", "url", "payload_bytes", "payload_digest", *(["payload"] if payloads else [])]
    place = ["file", "block", "pos"]
    plain = true.where("whole").select(*place, "offset").join(pieces, place)
    plain = (_with_payload(plain) if payloads else plain).select(*names)
    open_records = saved(true.where("not whole").select("file", "offset", "successor"), "warc-open")
    if open_records.isEmpty():
        return plain
    return plain.unionByName(_assembled(open_records, chained, pieces, place).select(*names))


def _assembled(open_records: DataFrame, chained: DataFrame, pieces: DataFrame, place: list[str]) -> DataFrame:
    """Records whose payload holds the magic, put together from their pieces."""
    ends = open_records.select("file", "offset", F.col("successor").alias("end"), F.lit(0).alias("kind"))
    parts = chained.select("file", "offset", F.lit(None).cast("long").alias("end"), F.lit(1).alias("kind"), "block", "pos")
    order = Window.partitionBy("file").orderBy("offset", "kind").rowsBetween(Window.unboundedPreceding, 0)
    owned = (
        parts.unionByName(ends, allowMissingColumns=True)
        .withColumn("owner", F.last(F.when(F.col("kind") == 0, F.col("offset")), ignorenulls=True).over(order))
        .withColumn("until", F.last("end", ignorenulls=True).over(order))
        .where("kind = 1 and offset < until").select(*place, "owner", "offset")
    )
    texts = owned.join(pieces.select(*place, "value", "record", "record_type", "head_chars", "id", "refers", "declared", "url"), place)
    first = F.col("owner") == F.col("offset")
    whole = texts.groupBy("file", "owner").agg(
        F.array_sort(F.collect_list(F.struct("offset", "value"))).alias("parts"),
        *(F.max(F.when(first, F.col(c))).alias(c) for c in ("record", "record_type", "head_chars", "id", "refers", "declared", "url")),
    ).select("*", F.array_join(F.col("parts.value"), MAGIC).alias("value"), F.col("owner").alias("offset")).drop("parts", "owner")
    complete = whole.where(F.octet_length("value") == F.col("record"))
    return _with_payload(complete)


def page_rows(records: DataFrame) -> DataFrame:
    """What the archives say about each page."""
    def page(c: str) -> Column:
        return F.expr(f"try_cast(regexp_extract({c}, '^<urn:page:(-?[0-9]+)>$', 1) as bigint)")

    return records.select(
        page("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page("refers").alias("refers_to"),
    )
