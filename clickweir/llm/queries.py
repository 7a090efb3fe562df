"""Registered queries of this package, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweir.llm import best_fit, byte_gru, chat_schema, line_templates, norm_topk, order_minhash, packing, pii_spans, prefix_trie, quality_cascade, spelling_fst, viterbi_pieces, warc_chain
from clickweir.llm.frames import table
from clickweir.session import fresh_dir


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_lines(spark: SparkSession, folder: str) -> DataFrame:
    n_chars = F.coalesce(F.length("text"), F.lit(0))
    docs = table(spark, folder, "documents").select("doc_id", "text", n_chars.alias("before"))
    cut = line_templates.drop_recurring(docs, **line_templates.PASSAGES)
    return cut.select("doc_id", "text", (F.col("before") - n_chars).cast("long").alias("chars_dropped"))


def op2_packing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return packing.digest(packing.pack(docs, tokenizer_path("word_bpe_49k.json")))


def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality_cascade.judge(table(spark, folder, "documents"))


def op4_chat(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], rows.schema)
    turns = chat_schema.turns_of_table(rows.unionByName(more))
    return chat_schema.digest(chat_schema.format_turns(turns))


def op5_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return order_minhash.classes(table(spark, folder, "documents")).select("doc_id", "class_id")


def op6_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii_spans.digest(pii_spans.find_spans(table(spark, folder, "documents")))


def op7_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    model = tokenizer_path("piece_bpe_32k.model")
    return viterbi_pieces.digest(viterbi_pieces.encode(table(spark, folder, "documents"), model, verify=True))


def op8_topk(spark: SparkSession, folder: str) -> DataFrame:
    return norm_topk.top_k(table(spark, folder, "embeddings"), F.col("id") % 50 == 0)


def op9_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    languages, net = byte_gru.fit(docs, ~byte_gru.held_out())
    found = byte_gru.predict(docs, languages, net)
    return found.select("doc_id", byte_gru.held_out().alias("held_out"), "lang_pred", "score")


def op10_warc(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_dir(spark, "warc")
    warc_chain.write_warc(table(spark, folder, "pages"), path)
    return warc_chain.page_rows(warc_chain.read_warc(spark, path, payloads=False, strict=True))


def op11_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_fst.variants(spelling_fst.vocabulary(table(spark, folder, "documents")))


def op12_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.nodes(table(spark, folder, "conversations"))


def op13_best_fit(spark: SparkSession, folder: str) -> DataFrame:
    return best_fit.pack(table(spark, folder, "documents"), tokenizer_path("word_bpe_49k.json"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lines": op1_lines,
    "op2_packing": op2_packing,
    "op3_quality": op3_quality,
    "op4_chat": op4_chat,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_pii": op6_pii,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_topk": op8_topk,
    "op9_language": op9_language,
    "op10_warc": op10_warc,
    "op11_spelling": op11_spelling,
    "op12_trie": op12_trie,
    "op13_best_fit": op13_best_fit,
}

ORACLES: dict[str, str] = {
    "op1_lines": r"""
        WITH docs AS (
            SELECT row_number() OVER () AS row, doc_id, text FROM documents
        ), same AS (
            SELECT *, min(row) OVER (PARTITION BY doc_id, text) AS doc FROM docs
        ), split AS (
            SELECT doc, doc_id, string_split(text, chr(10)) AS lines FROM same WHERE row = doc AND text IS NOT NULL
        ), lines AS (
            SELECT doc, doc_id, unnest(lines) AS body, unnest(range(len(lines))) AS line FROM split
        ), masked AS (
            SELECT *, CASE WHEN len(regexp_extract_all(body, '[^\x20\x09-\x0D]+')) < 3 THEN regexp_replace(body, '[0-9]+', '<*>', 'g')
                ELSE regexp_replace(body, '[^\x20\x09-\x0D0-9]*[0-9][^\x20\x09-\x0D]*', '<*>', 'g') END AS m
            FROM lines
        ), measured AS (
            SELECT doc, doc_id, line, regexp_extract_all(m, '[^\x20\x09-\x0D]+') AS t, length(replace(m, '<*>', '')) AS fixed,
                (length(m) - length(replace(m, '<*>', ''))) // 3 AS fields,
                length(trim(body, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))) AS size
            FROM masked
        ), tokens AS (
            SELECT *, len(t) AS n_tokens, (len(t) >= 12 AND 2 * fields <= len(t)) OR fixed >= 60 AS long FROM measured
        ), occurrences AS (
            SELECT doc, doc_id, line, n_tokens, long, -1 AS part, t AS template
            FROM tokens WHERE n_tokens >= 3 OR (n_tokens > 0 AND size >= 30)
            UNION ALL
            SELECT doc, doc_id, line, n_tokens, false, part,
                t[:2 + (n_tokens - 2) * part // 8] || ['<open>'] || t[2 + (n_tokens - 2) * (part + 2) // 8 + 1:]
            FROM tokens, (SELECT unnest(range(7)) AS part) WHERE n_tokens >= 12
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY part, template, n_tokens, long ORDER BY doc_id NULLS LAST, doc, line) AS place,
                dense_rank() OVER (PARTITION BY part, template, n_tokens, long ORDER BY doc) AS r
            FROM occurrences
        ), recurring AS (
            SELECT *, max(r) OVER (PARTITION BY part, template, n_tokens, long) AS docs FROM ranked
        ), lost AS (
            SELECT DISTINCT doc, line FROM recurring WHERE docs >= CASE WHEN long THEN 2 ELSE 3 END AND place > 1
        ), kept AS (
            SELECT l.doc, string_agg(body, chr(10) ORDER BY line) FILTER (lost.doc IS NULL) AS text
            FROM lines l LEFT JOIN lost USING (doc, line) GROUP BY l.doc
        )
        SELECT s.doc_id, CASE WHEN s.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
            (coalesce(length(s.text), 0) - coalesce(length(k.text), 0))::BIGINT AS chars_dropped
        FROM same s LEFT JOIN kept k USING (doc)
    """,
    "op3_quality": r"""
        WITH docs AS (
            SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents
        ), split AS (
            SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
                list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
            FROM docs
        ), windows AS (
            SELECT row, unnest(range(1, len(words) - 1)) AS i, words FROM split WHERE len(words) > 2
        ), marked AS (
            SELECT row, i, count(*) OVER (PARTITION BY row, words[i], words[i + 1], words[i + 2]) AS n FROM windows
        ), repeats AS (
            SELECT row, count(DISTINCT p) AS n_repeat_words
            FROM (SELECT row, unnest([i, i + 1, i + 2]) AS p FROM marked WHERE n > 1) GROUP BY row
        ), counts AS (
            SELECT doc_id, text, len(words)::BIGINT AS n_words,
                length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
                length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
                len(lines) AS n_lines,
                (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
                coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
            FROM split LEFT JOIN repeats USING (row)
        )
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
            n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
            NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words
                OR n_symbols > 0.1 * n_words OR n_dup_lines > 0.3 * n_lines
                OR word_chars < 2 * n_words OR word_chars > 15 * n_words
                OR length(regexp_replace(text, '[^\p{L}]', '', 'g')) < 0.5 * word_chars
                OR len(regexp_extract_all(text, '(?m)^[\x20\t]*[-*\x{2022}]')) > 0.9 * n_lines
                OR len(regexp_extract_all(text, '(?m)(\.\.\.|\x{2026})[\x20\t]*$')) > 0.3 * n_lines) AS kept
        FROM counts
    """,
    # formatted_chars follows from the template: marks around every text, and a backslash
    # before each backslash and control string in it.
    "op4_chat": r"""
        WITH rows AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
        ), sized AS (
            SELECT *, length(regexp_replace(text, '(\\|\[/?(?:INST|OUT|ROLE)\]|</?s>)', '+\1', 'g')) AS n,
                length(regexp_replace(role, '(\\|\[/?(?:INST|OUT|ROLE)\]|</?s>)', '+\1', 'g')) AS r
            FROM rows
        )
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
            coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
            sum(n + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 10 ELSE 18 + r END)::BIGINT AS formatted_chars
        FROM sized GROUP BY conv_id
    """,
    "op8_topk": """
        WITH usable AS (
            SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND len(embedding) > 0
                AND len(list_filter(embedding, lambda c: c IS NOT NULL AND isfinite(c))) = len(embedding)
        ), scored AS (
            SELECT q.row, q.vec_id AS query_id, x.vec_id, list_inner_product(q.v, x.v)::BIGINT AS score
            FROM usable q JOIN usable x ON q.vec_id % 50 = 0 AND q.row <> x.row AND len(q.v) = len(x.v)
        )
        SELECT query_id, (row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
        FROM scored QUALIFY rank <= 5
    """,
    "op10_warc": """
        WITH rows AS (
            SELECT page_id, coalesce(html, '') AS html FROM pages
        ), sized AS (
            SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha256(html) AS payload_digest FROM rows
        ), firsts AS (
            SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM sized
        )
        SELECT page_id, payload_bytes, payload_digest,
            CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
        FROM firsts
    """,
    # The CRC runs over UTF-8 bytes: runs hold letters up to U+00FF, of one or two bytes each.
    "op11_spelling": r"""
        WITH RECURSIVE crc_table AS (
            SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]),
                lambda r, x: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END)) AS t
        ), runs AS (
            SELECT coalesce(doc_id::VARCHAR, '') AS id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents
        ), hashed AS (
            SELECT run, xor(4294967295, list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(id || ':' || run, ''),
                lambda ch: CASE WHEN ord(ch) < 128 THEN [ord(ch)::BIGINT] ELSE [195::BIGINT, ord(ch)::BIGINT - 64] END))),
                lambda r, b: xor(r >> 8, t[(xor(r, b) & 255) + 1]))) AS h
            FROM runs, crc_table WHERE length(run) >= 7
        ), words AS (
            SELECT CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, count(*) AS n
            FROM hashed GROUP BY 1 HAVING length(word) >= 7 AND n >= 2
        ), places AS (
            SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words
        ), cut AS (
            SELECT DISTINCT word, n, left(word, i - 1) || substr(word, i + 1) AS rest FROM places
        ), gaps AS (
            SELECT word, n, left(word, i - 1) || chr(1) || substr(word, i + 1) AS rest FROM places
        ), near AS (
            SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM gaps a JOIN gaps b ON a.rest = b.rest AND a.word <> b.word
            UNION ALL SELECT a.word, a.n, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
            UNION ALL SELECT b.word, b.n, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word
        ), best AS (
            SELECT *, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) AS r FROM near
        ), forms AS (
            SELECT w.word, w.n, coalesce(b.n_near, 0)::BIGINT AS n_near, CASE WHEN other_n >= 10 * w.n THEN other END AS form,
                CASE WHEN other_n >= 10 * w.n THEN other_n END AS form_n
            FROM words w LEFT JOIN best b ON b.word = w.word AND r = 1
        ), chain AS (
            SELECT word, word AS at FROM forms
            UNION ALL SELECT c.word, f.form FROM chain c JOIN forms f ON f.word = c.at WHERE f.form IS NOT NULL
        )
        SELECT f.word, f.form, c.at AS root, f.n, f.n_near, f.form_n
        FROM forms f JOIN chain c USING (word) JOIN forms last ON last.word = c.at WHERE last.form IS NULL
    """,
    "op12_trie": r"""
        WITH crc_table AS (
            SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]),
                lambda r, x: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END)) AS t
        ), turns AS (
            SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
                row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos
            FROM conversations WHERE conv_id IS NOT NULL
        ), convs AS (
            SELECT c, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(c::VARCHAR, ''), lambda ch: ord(ch)::BIGINT)),
                lambda r, b: xor(r >> 8, t[(xor(r, b) & 255) + 1]))) % 9 AS h
            FROM (SELECT DISTINCT c FROM turns), crc_table
        ), rebuilt AS (
            SELECT v.c, 0 AS half, t.pos, t.role, t.text FROM convs v JOIN turns t ON t.c = v.c - v.c % 5 AND t.pos < v.h
            UNION ALL SELECT v.c, 1, t.pos, t.role, t.text FROM convs v JOIN turns t ON t.c = v.c AND t.pos >= v.h
        ), paths AS (
            SELECT c, row_number() OVER w AS depth, strlen(text) AS bytes,
                md5(string_agg(length(role) || ':' || role || length(text) || ':' || text, '') OVER w) AS node
            FROM rebuilt WINDOW w AS (PARTITION BY c ORDER BY half, pos)
            UNION ALL SELECT c, 0, 0, '' FROM convs
        ), linked AS (
            SELECT *, lag(node) OVER (PARTITION BY c ORDER BY depth) AS above, max(depth) OVER (PARTITION BY c) = depth AS last FROM paths
        ), nodes AS (
            SELECT depth, node, min(c) AS conv_id, count(*) AS n_convs, any_value(above) AS above, any_value(bytes) AS bytes,
                sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (last), '')) AS ends_sha256
            FROM linked GROUP BY depth, node
        ), children AS (
            SELECT depth - 1 AS depth, above AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL
        ), counted AS (
            SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN children USING (depth, node)
        ), sums AS (
            SELECT up.depth, up.node, count(*) FILTER (n.n_children = 0) AS n_leaves, sum((n.n_convs - 1) * n.bytes) AS saved_tokens
            FROM counted n JOIN paths up ON up.c = n.conv_id AND up.depth <= n.depth GROUP BY ALL
        )
        SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, n_leaves, saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
        FROM counted n JOIN sums USING (depth, node) LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.node = n.above
    """,
}
