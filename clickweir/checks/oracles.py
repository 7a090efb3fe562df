"""The registered queries as single SQL statements over the input tables.

Each statement carries the layers it needs as common table expressions.
"""

from __future__ import annotations

# name -> (CTEs it reads, SQL)
_LAYERS: dict[str, tuple[list[str], str]] = {
    "clicks_raw": ([], """
        SELECT lower(substr(r_name, 1, 2)) AS lang,
               CAST(year(l_shipdate) AS INT) AS year, CAST(month(l_shipdate) AS INT) AS month,
               CASE WHEN l_linenumber = 7 THEN NULL
                    WHEN l_linenumber = 6 THEN replace(p_name, ' ', '_')
                    ELSE replace(s_name, '#', '_') END AS prev,
               CASE p_size WHEN 1 THEN 'Special:' WHEN 2 THEN 'User:' WHEN 3 THEN 'File:'
                           WHEN 4 THEN 'Talk:' WHEN 5 THEN 'Category:' ELSE '' END
                 || CASE p_size WHEN 7 THEN '' ELSE replace(p_name, ' ', '_') END
                 || CASE p_size WHEN 6 THEN '_404' ELSE '' END AS curr,
               CASE WHEN l_returnflag = 'A' THEN 'link' WHEN l_returnflag = 'N' THEN 'external'
                    WHEN l_linestatus = 'O' THEN 'other' ELSE 'redlink' END AS type,
               CAST(l_quantity AS INT) - 1 AS n
        FROM lineitem
        JOIN part ON l_partkey = p_partkey
        JOIN supplier ON l_suppkey = s_suppkey
        JOIN nation ON s_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey"""),
    "kept": (["clicks_raw"], """
        SELECT * FROM clicks_raw
        WHERE n >= 1 AND curr <> '' AND curr <> prev
          AND list_contains(['link', 'external', 'other'], type)
          AND NOT regexp_matches(curr, '^(Special|User|File|Talk|Category):|404')"""),
    "silver": (["kept"], """
        SELECT lang, year, month, trim(replace(prev, '_', ' '), ' ') AS prev_title,
               trim(replace(curr, '_', ' '), ' ') AS curr_title, type, max(n) AS n
        FROM kept GROUP BY ALL"""),
    "lenient": (["clicks_raw"], """
        SELECT lang, year, month, prev AS prev_title, curr AS curr_title, type, n
        FROM clicks_raw
        WHERE n >= 1 AND curr <> '' AND curr <> 'curr' AND prev IS NOT NULL
          AND list_contains(['link', 'external', 'other'], type)"""),
    "mixed": (["silver", "lenient"], """
        SELECT * FROM silver WHERE year < 2000 UNION ALL SELECT * FROM lenient WHERE year >= 2000"""),
    "title_uses": (["silver"], """
        SELECT lang, title, min(year * 12 + month) AS first_ym, count(*) AS uses
        FROM (SELECT lang, year, month, unnest([curr_title, prev_title]) AS title FROM silver)
        GROUP BY lang, title"""),
    "articles": (["title_uses"], """
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY first_ym, title) AS id, title
        FROM title_uses"""),
    "ids": (["silver", "articles"], """
        SELECT s.lang, s.year, s.month, p.id AS prev_id, c.id AS curr_id, CAST(s.n AS BIGINT) AS n
        FROM silver s
        JOIN articles c ON c.lang = s.lang AND c.title = s.curr_title
        LEFT JOIN articles p ON p.lang = s.lang AND p.title = s.prev_title"""),
    "pairs": (["ids"], """
        SELECT lang, year, month, prev_id, curr_id, CAST(sum(n) AS BIGINT) AS n
        FROM ids GROUP BY lang, year, month, prev_id, curr_id"""),
    "popularity": (["ids"], """
        SELECT lang, year, month, curr_id, CAST(sum(n) AS BIGINT) AS total_clicks
        FROM ids GROUP BY lang, year, month, curr_id"""),
    "edges": (["pairs"], """
        SELECT lang, year, month, prev_id, curr_id, n AS total_transitions
        FROM pairs WHERE prev_id IS NOT NULL AND n >= 10"""),
    "referred": (["pairs"], """
        SELECT lang, year, month, prev_id, curr_id, n AS total_transitions
        FROM pairs WHERE prev_id IS NOT NULL AND n >= 7"""),
    "foreign_pairs": (["foreign_rows", "articles"], """
        SELECT f.lang, f.year, f.month, p.id AS prev_id, c.id AS curr_id, CAST(sum(f.n) AS BIGINT) AS n
        FROM foreign_rows f
        JOIN articles c ON c.lang = f.lang AND c.title = f.curr_title
        JOIN articles p ON p.lang = f.lang AND p.title = f.prev_title
        GROUP BY ALL"""),
    "readings": (["clicks_raw"], """
        SELECT lang, year, month, count(*) FILTER (n >= 1 AND curr <> '') AS rows_read,
               count(*) FILTER (n >= 1 AND curr <> '' AND curr <> prev
                 AND list_contains(['link', 'external', 'other'], type)
                 AND NOT regexp_matches(curr, '^(Special|User|File|Talk|Category):|404')) AS rows_clean
        FROM clicks_raw GROUP BY lang, year, month"""),
    "yearly": (["popularity"], """
        SELECT lang, year, curr_id, CAST(sum(total_clicks) AS BIGINT) AS clicks_year
        FROM popularity GROUP BY lang, year, curr_id"""),
    "yearly_ranked": (["yearly"], """
        SELECT lang, year, curr_id, clicks_year,
               row_number() OVER (PARTITION BY lang, year ORDER BY clicks_year DESC, curr_id) AS rn
        FROM yearly"""),
    "top10": (["yearly_ranked", "articles"], """
        SELECT r.lang, year, title AS curr_title, clicks_year, rn
        FROM yearly_ranked r JOIN articles a ON a.lang = r.lang AND a.id = r.curr_id
        WHERE rn <= 10"""),
    "all_time": (["popularity", "articles"], """
        SELECT t.lang, title AS curr_title, clicks_all_time
        FROM (SELECT lang, curr_id, CAST(sum(total_clicks) AS BIGINT) AS clicks_all_time,
                     row_number() OVER (PARTITION BY lang
                                        ORDER BY sum(total_clicks) DESC, curr_id) AS place
              FROM popularity GROUP BY lang, curr_id) t
        JOIN articles a ON a.lang = t.lang AND a.id = t.curr_id
        WHERE place <= 20"""),
    "edge_last": (["edges"], """
        SELECT lang, max(year * 12 + month) AS last FROM edges GROUP BY lang"""),
    "edge_window": (["edges", "edge_last"], """
        SELECT e.lang, last, prev_id, curr_id, CAST(sum(total_transitions) AS BIGINT) AS total
        FROM edges e JOIN edge_last l ON l.lang = e.lang AND year * 12 + month > last - 6
        GROUP BY e.lang, last, prev_id, curr_id"""),
    "popularity_last": (["popularity"], """
        SELECT lang, max(year * 12 + month) AS last FROM popularity GROUP BY lang"""),
    "growth": (["popularity", "popularity_last"], """
        SELECT now.lang, last, now.curr_id, now.total_clicks AS clicks_now,
               old.total_clicks AS clicks_prev,
               now.total_clicks - old.total_clicks AS abs_delta,
               CAST(now.total_clicks - old.total_clicks AS DOUBLE) * 100.0 / old.total_clicks AS pct_delta
        FROM popularity now
        JOIN popularity_last l ON l.lang = now.lang AND now.year * 12 + now.month = last
        JOIN popularity old ON old.lang = now.lang AND old.curr_id = now.curr_id
                           AND old.year * 12 + old.month = last - 1"""),
    "trending": (["growth", "articles"], """
        SELECT g.lang, CAST((last - 1) // 12 AS INT) AS year, CAST((last - 1) % 12 + 1 AS INT) AS month,
               title AS curr_title, clicks_now, clicks_prev, abs_delta, pct_delta
        FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY pct_delta DESC NULLS LAST,
                                           abs_delta DESC, curr_id) AS place FROM growth) g
        JOIN articles a ON a.lang = g.lang AND a.id = g.curr_id
        WHERE place <= 5"""),
    "period_keys": (["clicks_raw"], """
        SELECT DISTINCT lang, year, month, printf('%04d-%02d', year, month) AS ym FROM clicks_raw"""),
    "paths": (["period_keys"], """
        SELECT unnest(['/bronze/' || ym || '/clickstream-' || lang || 'wiki-' || ym || '.tsv.gz',
                       '/bronze/misc/clickstream-' || lang || 'wiki-' || ym || '.tsv',
                       '/bronze/misc/clickstream-' || lang || '-' || ym || '.tsv',
                       '/bronze/bad-dir/clickstream-' || lang || 'wiki-' || ym || '.tsv',
                       '/bronze/' || ym || '/other-' || lang || '.tsv']) AS path
        FROM period_keys"""),
    "manifest": (["paths"], r"""
        SELECT path, regexp_extract(path, form, 1) AS lang,
               CAST(regexp_extract(path, '(\d{4})-(\d{2})\.tsv', 1) AS INT) AS year,
               CAST(regexp_extract(path, '(\d{4})-(\d{2})\.tsv', 2) AS INT) AS month
        FROM (SELECT path, '/[0-9]{4}-[0-9]{2}/clickstream-([a-z]+)wiki|'
                        || '/misc/clickstream-([a-z]+)-' AS form_any,
                     CASE WHEN path LIKE '/bronze/misc/%' THEN 'clickstream-([a-z]{2})(?:wiki)?-'
                          ELSE 'clickstream-([a-z]+)wiki-' END AS form
              FROM paths)
        WHERE regexp_matches(path, form_any)"""),
    "manifest_all": (["paths", "manifest"], """
        SELECT p.path, lang, year, month, lang IS NOT NULL AS accepted
        FROM paths p LEFT JOIN manifest m ON m.path = p.path"""),
    "files": (["period_keys"], """
        SELECT 'clickstream-' || lang || 'wiki-' || ym || '.tsv.gz' AS file,
               lang || 'wiki' AS site, ym AS dump_month
        FROM period_keys"""),
    "months": (["period_keys"], """
        SELECT ym AS dump_month FROM period_keys
        UNION SELECT strftime(make_date(year, month, 1) + INTERVAL 1 MONTH, '%Y-%m') FROM period_keys"""),
    "known_uses": (["silver"], """
        SELECT lang, title, min(year * 12 + month) FILTER (year >= 1998) AS early_ym,
               min(year * 12 + month) FILTER (year < 1998) AS late_ym
        FROM (SELECT lang, year, month, unnest([curr_title, prev_title]) AS title FROM silver)
        GROUP BY lang, title"""),
    "foreign_rows": (["clicks_raw"], """
        SELECT lang, year, month, replace(prev, '_', ' ') AS prev_title,
               replace(curr, '_', ' ') AS curr_title, CAST(n AS BIGINT) AS n
        FROM clicks_raw WHERE n > 0"""),
}

_QC = """
    SELECT lang, year, month, rows_read, rows_clean, rows_read - rows_clean AS rows_filtered,
           rows_clean = 0 AS is_empty
    FROM (SELECT lang, year, month, count(*) FILTER ({read}) AS rows_read,
                 count(*) FILTER ({keep}) AS rows_clean
          FROM clicks_raw GROUP BY lang, year, month)"""

# name -> (CTEs it reads, SQL)
_QUERIES: dict[str, tuple[list[str], str]] = {
    "bronze_scan_strict": (["clicks_raw"], """
        SELECT lang, year, month, prev, nullif(curr, '') AS curr, type, CAST(n AS VARCHAR) AS n
        FROM clicks_raw"""),
    "bronze_scan_lenient": (["clicks_raw"], """
        SELECT lang, year, month, prev, curr, type, n FROM clicks_raw WHERE curr <> ''"""),
    "bronze_manifest": (["manifest_all"], "SELECT * FROM manifest_all"),
    "bronze_manifest_folder_form": (["paths", "manifest"], """
        SELECT p.path, lang, year, month, lang IS NOT NULL AS accepted
        FROM paths p LEFT JOIN (SELECT * FROM manifest WHERE path LIKE '%.gz') m ON m.path = p.path"""),
    "bronze_rejects": (["manifest_all"], "SELECT path FROM manifest_all WHERE NOT accepted"),
    "bronze_select_partitions": (["manifest"], """
        SELECT path, lang, year, month FROM manifest WHERE lang = 'eu' AND year = 2000"""),
    "bronze_first_files": (["paths"], "SELECT path FROM paths ORDER BY path LIMIT 25"),
    "bronze_last_file": (["manifest"], """
        SELECT max(path) AS path, lang, year, month FROM manifest GROUP BY lang, year, month"""),
    "listing_links": ([], """
        SELECT href, count(*) AS uses
        FROM (SELECT unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)) AS href FROM pages)
        GROUP BY href"""),
    "listing_months": (["months"], "SELECT dump_month FROM months"),
    "listing_files": (["files"], """
        SELECT file, site, dump_month, 'http://dumps.example/' || dump_month || '/' || file AS file_url FROM files"""),
    "acquisition_plan": (["files", "months", "silver"], """
        SELECT dump_month, file, site, 'http://dumps.example/' || dump_month || '/' || file AS file_url,
               dump_month || '/' || file AS target
        FROM files
        WHERE dump_month >= '1996-07' AND site IN ('euwiki', 'afwiki', 'amwiki')
          AND dump_month IN (SELECT dump_month FROM months WHERE dump_month >= '1996-07'
                             ORDER BY dump_month DESC LIMIT 40)
          AND file NOT IN (SELECT 'clickstream-' || lang || 'wiki-'
                                  || printf('%04d-%02d', year, month) || '.tsv.gz'
                           FROM silver WHERE n >= 49)"""),
    "silver_table_scan": (["silver"], "SELECT * FROM silver"),
    "silver_partition_scan": (["silver"], """
        SELECT lang, year, month, prev_title, curr_title, CAST(n AS BIGINT) AS n
        FROM silver WHERE lang = 'eu' AND year = 2000"""),
    "language_list": (["popularity", "edges"], """
        SELECT lang FROM popularity UNION SELECT lang FROM edges"""),
    "silver_strict": (["silver"], "SELECT * FROM silver"),
    "silver_lenient": (["lenient"], "SELECT * FROM lenient"),
    "silver_from_dumps": (["silver"], "SELECT * FROM silver"),
    "silver_dedup_max": (["lenient"], """
        SELECT lang, year, month, prev_title, curr_title, type, max(n) AS n
        FROM lenient GROUP BY ALL"""),
    "qc_counts_strict": (["clicks_raw"], _QC.format(
        read="n >= 1 AND curr IS NOT NULL",
        keep="n >= 1 AND curr <> '' AND curr <> prev AND list_contains(['link', 'external', 'other'], type) AND NOT "
             "regexp_matches(curr, '^(Special|User|File|Talk|Category):|404')")),
    "qc_counts_lenient": (["clicks_raw"], _QC.format(
        read="curr IS NOT NULL AND n IS NOT NULL AND curr <> 'curr'",
        keep="n >= 1 AND curr <> '' AND curr <> 'curr' AND prev IS NOT NULL "
             "AND list_contains(['link', 'external', 'other'], type)")),
    "partition_row_counts": (["silver"], """
        SELECT lang, year, month, count(*) AS row_count FROM silver GROUP BY lang, year, month"""),
    "profile_lang": (["silver"], """
        SELECT lang, count(*) AS records, CAST(sum(n) AS BIGINT) AS total_clicks,
               count(DISTINCT curr_title) AS unique_articles
        FROM silver GROUP BY lang"""),
    "profile_range": (["silver"], """
        SELECT min(year) AS min_year, max(year) AS max_year, min(month) AS min_month,
               max(month) AS max_month, count(DISTINCT (year, month)) AS num_months FROM silver"""),
    "profile_type": (["silver"], """
        SELECT type, records, total_clicks,
               CAST(records AS DOUBLE) / (SELECT count(*) FROM silver) * 100.0 AS pct
        FROM (SELECT type, count(*) AS records, CAST(sum(n) AS BIGINT) AS total_clicks
              FROM silver GROUP BY type)"""),
    "profile_top_global": (["silver"], """
        SELECT curr_title, CAST(sum(n) AS BIGINT) AS total_clicks, count(DISTINCT lang) AS languages
        FROM silver GROUP BY curr_title ORDER BY total_clicks DESC, curr_title LIMIT 10"""),
    "title_functions": (["clicks_raw"], """
        SELECT DISTINCT curr, type, trim(translate(curr, '_', ' '), ' ') AS title, type AS kind,
               regexp_matches(curr, '^(Special|User|File|Talk|Category):|404') AS is_noise,
               curr <> '' AS has_title,
               list_contains(['link', 'external', 'other'], type) AS known_type
        FROM clicks_raw"""),
    "period_functions": (["period_keys"], """
        SELECT lang, year, month, ym AS month_text, year * 12 + month AS month_index,
               CAST(year(first_day - INTERVAL 5 MONTH) AS INT) AS from_year,
               CAST(month(first_day - INTERVAL 5 MONTH) AS INT) AS from_month,
               strftime(first_day + INTERVAL 1 MONTH, '%Y-%m-%d') AS next_start,
               lang || '/' || year || '/' || month AS partition_key
        FROM (SELECT *, make_date(year, month, 1) AS first_day FROM period_keys)"""),
    "pending_partitions": (["silver"], """
        SELECT DISTINCT lang, year, month FROM silver WHERE NOT (lang = 'eu' AND year = 2000)"""),
    "catalog_views": (["top10", "all_time"], """
        SELECT t.lang, t.year, t.curr_title, t.clicks_year, a.clicks_all_time
        FROM top10 t JOIN all_time a ON a.lang = t.lang AND a.curr_title = t.curr_title
        WHERE t.rn <= 5"""),
    "partition_replace": (["mixed", "silver", "lenient"], """
        SELECT * FROM mixed UNION ALL
        SELECT * FROM silver s WHERE year >= 2000 AND NOT EXISTS (
          SELECT 1 FROM lenient l WHERE l.lang = s.lang AND l.year = s.year AND l.month = s.month)"""),
    "partition_export": (["silver"], "SELECT * FROM silver WHERE lang = 'eu' AND year = 2000"),
    "catalog_refresh": (["silver"], """
        SELECT lang, year, month, count(*) AS row_count FROM silver GROUP BY lang, year, month"""),
    "title_statistics": (["title_uses"], "SELECT lang, title, first_ym, uses FROM title_uses"),
    "dictionary_backfill": (["articles"], "SELECT lang, id, title FROM articles"),
    "dictionary_increment": (["known_uses"], """
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY early_ym IS NULL,
                                        coalesce(early_ym, late_ym), title) AS id, title
        FROM known_uses"""),
    "new_titles": (["lenient", "articles"], """
        SELECT lang, title
        FROM (SELECT lang, unnest([prev_title, curr_title]) AS title FROM lenient)
        EXCEPT SELECT lang, title FROM articles"""),
    "largest_ids": (["articles"], "SELECT lang, count(*) AS base FROM articles GROUP BY lang"),
    "hot_titles": (["articles", "title_uses"], """
        SELECT lang, id, title FROM articles JOIN title_uses USING (lang, title)
        WHERE uses * 512 > (SELECT sum(uses) FROM title_uses)"""),
    "silver_reingest_noise_only": (["silver"], "SELECT * FROM silver WHERE year < 2000"),
    "ingest_split_dumps": (["silver"], "SELECT * FROM silver"),
    "ingest_last_file_empty": (["silver"], "SELECT * FROM silver"),
    "ingest_lenient": (["lenient"], "SELECT * FROM lenient"),
    "ingest_report": (["readings"], """
        SELECT *, rows_read - rows_clean AS rows_filtered FROM readings WHERE rows_read > 0"""),
    "ingest_header_rows": (["lenient"], "SELECT * FROM lenient"),
    "ingest_truncated_file": (["silver"], "SELECT * FROM silver"),
    "stream_ingest": (["silver"], "SELECT * FROM silver"),
    "ingest_file_log": (["readings"], """
        SELECT state, count(*) AS dumps, CAST(sum(rows_read) AS BIGINT) AS rows_read, CAST(sum(rows_clean) AS BIGINT) AS rows_clean
        FROM (SELECT CASE WHEN rows_read > 0 THEN 'taken' ELSE 'empty' END AS state, rows_read, rows_clean FROM readings
              UNION ALL
              SELECT CASE WHEN rows_read > 0 THEN 'superseded' ELSE 'empty' END, rows_read, rows_clean
              FROM readings WHERE year >= 2000
              UNION ALL SELECT 'unreadable', 0, 0 FROM readings WHERE lang = 'eu' AND year = 2000 AND month <= 3)
        GROUP BY state"""),
    "gold_latest_month": (["silver"], """
        SELECT lang, year, month, curr_title, CAST(sum(n) AS BIGINT) AS total_clicks FROM silver
        WHERE year * 12 + month = (SELECT max(year * 12 + month) FROM silver) GROUP BY ALL"""),
    "gold_rebuilt_higher_threshold": (["pairs"], """
        SELECT lang, year, month, prev_id, curr_id, n AS total_transitions
        FROM pairs WHERE prev_id IS NOT NULL AND n >= 40"""),
    "referrers_top_foreign": (["foreign_pairs"], """
        SELECT * FROM (SELECT lang, year, month, curr_id, prev_id, n AS clicks_from_prev,
                              row_number() OVER (PARTITION BY lang, year, month, curr_id
                                                 ORDER BY n DESC, prev_id) AS rn
                       FROM foreign_pairs WHERE n >= 7) WHERE rn <= 2"""),
    "edges_monthly_foreign": (["foreign_pairs"], """
        SELECT lang, year, month, prev_id, curr_id, n AS total_transitions FROM foreign_pairs WHERE n >= 10"""),
    "decode_ids_cold": (["edges", "articles"], """
        SELECT e.lang, year, month, p.title AS prev_title, c.title AS curr_title, total_transitions
        FROM edges e JOIN articles p ON p.lang = e.lang AND p.id = prev_id
        JOIN articles c ON c.lang = e.lang AND c.id = curr_id"""),
    "encode_ids": (["ids"], "SELECT * FROM ids"),
    "encode_ids_cold": (["ids"], "SELECT * FROM ids"),
    "encode_ids_mixed": (["ids"], "SELECT * FROM ids"),
    "encode_ids_foreign": (["foreign_rows", "articles"], """
        SELECT f.lang, f.year, f.month, p.id AS prev_id, c.id AS curr_id, f.n
        FROM foreign_rows f
        JOIN articles c ON c.lang = f.lang AND c.title = f.curr_title
        LEFT JOIN articles p ON p.lang = f.lang AND p.title = f.prev_title"""),
    "decode_ids": (["silver"], """
        SELECT lang, year, month, curr_title, CAST(sum(n) AS BIGINT) AS total_clicks
        FROM silver GROUP BY lang, year, month, curr_title"""),
    "pair_totals": (["pairs"], "SELECT * FROM pairs"),
    "article_popularity": (["popularity"], "SELECT * FROM popularity"),
    "article_top": (["popularity"], """
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, year, month
                                                    ORDER BY total_clicks DESC, curr_id) AS rn
                       FROM popularity) WHERE rn <= 20"""),
    "gold_after_failed_rebuild": (["referred"], """
        SELECT lang, year, month, curr_id, prev_id, total_transitions AS clicks_from_prev, rn
        FROM (SELECT *, row_number() OVER (PARTITION BY lang, year, month, curr_id
                                           ORDER BY total_transitions DESC, prev_id) AS rn
              FROM referred) WHERE rn <= 2"""),
    "insights_rebuilt_empty": (["top10", "all_time", "trending"], """
        SELECT 'top10_by_year' AS topic, count(*) AS row_count FROM top10
        UNION ALL SELECT 'all_time_top', count(*) FROM all_time
        UNION ALL SELECT 'trending_mom', count(*) FROM trending
        UNION ALL SELECT 'edges_6m', 0 UNION ALL SELECT 'referrers_6m', 0"""),
    "referrers_top": (["referred"], """
        SELECT lang, year, month, curr_id, prev_id, total_transitions AS clicks_from_prev, rn
        FROM (SELECT *, row_number() OVER (PARTITION BY lang, year, month, curr_id
                                           ORDER BY total_transitions DESC, prev_id) AS rn
              FROM referred) WHERE rn <= 2"""),
    "edges_monthly": (["edges"], "SELECT * FROM edges"),
    "latest_month_only": (["silver"], """
        SELECT * FROM silver
        WHERE year * 12 + month = (SELECT max(year * 12 + month) FROM silver)"""),
    "latest_period": (["popularity_last"], """
        SELECT lang, CAST((last - 1) // 12 AS INT) AS year, CAST((last - 1) % 12 + 1 AS INT) AS month
        FROM popularity_last"""),
    "window_periods": (["edge_last"], """
        SELECT lang, CAST((m - 1) // 12 AS INT) AS year, CAST((m - 1) % 12 + 1 AS INT) AS month
        FROM (SELECT lang, unnest(range(last - 5, last + 1)) AS m FROM edge_last)"""),
    "years_listed": (["popularity"], "SELECT DISTINCT lang, year FROM popularity"),
    "top10_by_year": (["top10"], "SELECT * FROM top10"),
    "top10_by_year_ids": (["yearly_ranked"], """
        SELECT lang, year, CAST(curr_id AS VARCHAR) AS curr_title, clicks_year, rn
        FROM yearly_ranked WHERE rn <= 10"""),
    "all_time_top": (["all_time"], "SELECT * FROM all_time"),
    "edges_6m": (["edge_window", "articles"], """
        SELECT w.lang, CAST((last - 1) // 12 AS INT) AS year, CAST((last - 1) % 12 + 1 AS INT) AS month,
               p.title AS prev_title, c.title AS curr_title, total AS transitions_6m
        FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY total DESC, prev_id, curr_id)
                        AS place FROM edge_window) w
        JOIN articles p ON p.lang = w.lang AND p.id = w.prev_id
        JOIN articles c ON c.lang = w.lang AND c.id = w.curr_id
        WHERE place <= 150"""),
    "trending_mom": (["trending"], "SELECT * FROM trending"),
    "referrers_6m": (["edge_window", "articles"], """
        SELECT w.lang, CAST((last - 1) // 12 AS INT) AS year, CAST((last - 1) % 12 + 1 AS INT) AS month,
               c.title AS curr_title, p.title AS prev_title, total AS clicks_6m, rn
        FROM (SELECT *, row_number() OVER (PARTITION BY lang, curr_id ORDER BY total DESC, prev_id)
                        AS rn FROM edge_window) w
        JOIN articles p ON p.lang = w.lang AND p.id = w.prev_id
        JOIN articles c ON c.lang = w.lang AND c.id = w.curr_id
        WHERE rn <= 3"""),
    "n01_top_of_year": (["top10"], """
        SELECT rn, curr_title, clicks_year FROM top10 WHERE lang = 'eu' AND year = 2000"""),
    "n02_top_of_years": (["top10"], """
        SELECT year, rn, curr_title, clicks_year FROM top10
        WHERE lang = 'eu' AND year BETWEEN 1999 AND 2000"""),
    "n03_all_time": (["all_time"], """
        SELECT curr_title AS title, clicks_all_time AS clicks FROM all_time WHERE lang = 'eu'
        ORDER BY clicks DESC, title LIMIT 10"""),
    "n04_compare_languages": (["top10"], """
        SELECT lang, rn, curr_title, clicks_year FROM top10
        WHERE year = 2000 AND lang IN ('af', 'as', 'eu')"""),
    "n05_new_in_top": (["top10"], """
        SELECT curr_title AS new_in_top10 FROM top10 WHERE lang = 'eu' AND year = 2000
        EXCEPT SELECT curr_title FROM top10 WHERE lang = 'eu' AND year = 1999"""),
    "n06_fastest_growth": (["trending"], """
        SELECT year, month, curr_title, clicks_prev, clicks_now, abs_delta, pct_delta
        FROM trending WHERE lang = 'mi'
        ORDER BY pct_delta DESC NULLS LAST, abs_delta DESC, curr_title LIMIT 20"""),
    "n07_most_years": (["top10"], """
        SELECT curr_title, count(*) AS years_in_top10 FROM top10 WHERE lang = 'eu'
        GROUP BY curr_title ORDER BY years_in_top10 DESC, curr_title LIMIT 20"""),
    "n08_popular_in_both": (["top10"], """
        SELECT a.curr_title, a.clicks_year AS clicks_a, b.clicks_year AS clicks_b
        FROM top10 a JOIN top10 b ON b.curr_title = a.curr_title AND b.year = a.year
        WHERE a.lang = 'eu' AND b.lang = 'as' AND a.year = 2000
        ORDER BY a.clicks_year + b.clicks_year DESC, a.curr_title LIMIT 20"""),
    "n09_leaders": (["top10"], """
        SELECT year, curr_title, clicks_year FROM top10 WHERE lang = 'eu' AND rn = 1"""),
    "n10_comebacks": (["top10"], """
        SELECT curr_title, last_seen_year, comeback_year
        FROM (SELECT t.curr_title, t.year AS comeback_year,
                     (SELECT max(o.year) FROM top10 o WHERE o.lang = 'eu'
                        AND o.curr_title = t.curr_title AND o.year < t.year) AS last_seen_year
              FROM top10 t WHERE t.lang = 'eu')
        WHERE comeback_year - last_seen_year > 1"""),
    "n11_leader_margin": (["top10"], """
        SELECT a.curr_title AS leader, a.clicks_year AS leader_clicks, b.curr_title AS runner_up,
               b.clicks_year AS runner_up_clicks, a.clicks_year - b.clicks_year AS margin
        FROM top10 a JOIN top10 b ON b.lang = a.lang AND b.year = a.year AND b.rn = 2
        WHERE a.lang = 'eu' AND a.year = 2000 AND a.rn = 1"""),
}
_QUERIES["decode_ids_mixed"] = _QUERIES["decode_ids_cold"]
_QUERIES["profile_lang_merged"] = _QUERIES["profile_lang"]
_QUERIES["top10_by_year_incremental"] = _QUERIES["top10_by_year"]
_QUERIES["all_time_top_incremental"] = _QUERIES["all_time_top"]
_QUERIES |= {f"{name}_sql": query for name, query in _QUERIES.items() if name[0] == "n" and name[1:3].isdigit()}
_QUERIES["partition_overwrite"] = _QUERIES["partition_replace"]
_QUERIES["skip_existing"] = (["silver", "lenient"], """
    SELECT * FROM lenient WHERE year >= 2000 UNION ALL
    SELECT * FROM silver s WHERE NOT EXISTS (
      SELECT 1 FROM lenient l
      WHERE l.year >= 2000 AND l.lang = s.lang AND l.year = s.year AND l.month = s.month)""")


def _needed(names: list[str], found: dict[str, str]) -> dict[str, str]:
    """The CTEs ``names`` depend on, each after those it reads."""
    for name in names:
        if name not in found:
            reads, text = _LAYERS[name]
            _needed(reads, found)
            found[name] = text
    return found


def all_oracles() -> dict[str, str]:
    statements = {}
    for query, (reads, text) in _QUERIES.items():
        layers = _needed(reads, {})
        prefix = ",\n".join(f"{name} AS MATERIALIZED ({body})" for name, body in layers.items())
        statements[query] = f"WITH {prefix}\n{text}" if prefix else text
    return statements
