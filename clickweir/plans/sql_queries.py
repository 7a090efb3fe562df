"""The analytical queries as table functions of SQL, with their parameters.

``SELECT * FROM top_of_year('es', 2024)`` and the like, over the views of the insight tables.
The bodies are plain SQL, so the planner puts them into the calling query: partitions are
pruned by the arguments, and callers may join, filter and order as they like. Arguments are
constants or columns (``LATERAL``); lists are arrays, as in ``top_of_years('es', array(2023, 2024))``.
"""

from __future__ import annotations


def _function(name: str, parameters: str, columns: str, body: str) -> str:
    return f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS TABLE({columns}) RETURN {body}"


_TOP = "rn BIGINT, curr_title STRING, clicks_year BIGINT"

FUNCTIONS = {
    "top_of_year": _function(
        "top_of_year", "of_lang STRING, of_year INT", _TOP,
        "SELECT rn, curr_title, clicks_year FROM gs_top10_by_year WHERE lang = of_lang AND year = of_year",
    ),
    "top_of_years": _function(
        "top_of_years", "of_lang STRING, years ARRAY<INT>", f"year INT, {_TOP}",
        "SELECT year, rn, curr_title, clicks_year FROM gs_top10_by_year WHERE lang = of_lang AND array_contains(years, year)",
    ),
    "all_time_leaders": _function(
        "all_time_leaders", "of_lang STRING, k INT DEFAULT 10", "title STRING, clicks BIGINT",
        """SELECT curr_title, clicks_all_time FROM (
            SELECT *, row_number() OVER (ORDER BY clicks_all_time DESC, curr_title ASC NULLS LAST) AS place
            FROM gs_all_time_top WHERE lang = of_lang) WHERE place <= k""",
    ),
    "compare_languages": _function(
        "compare_languages", "langs ARRAY<STRING>, of_year INT", f"lang STRING, {_TOP}",
        "SELECT lang, rn, curr_title, clicks_year FROM gs_top10_by_year WHERE array_contains(langs, lang) AND year = of_year",
    ),
    "new_in_top": _function(
        "new_in_top", "of_lang STRING, of_year INT, base_year INT", "new_in_top10 STRING",
        """SELECT now.curr_title FROM gs_top10_by_year now
            LEFT ANTI JOIN (SELECT curr_title FROM gs_top10_by_year WHERE lang = of_lang AND year = base_year) before
            ON before.curr_title = now.curr_title
            WHERE now.lang = of_lang AND now.year = of_year""",
    ),
    "fastest_growth": _function(
        "fastest_growth", "of_lang STRING, k INT DEFAULT 20",
        "year INT, month INT, curr_title STRING, clicks_prev BIGINT, clicks_now BIGINT, abs_delta BIGINT, pct_delta DOUBLE",
        """SELECT year, month, curr_title, clicks_prev, clicks_now, abs_delta, pct_delta FROM (
            SELECT *, row_number() OVER (ORDER BY pct_delta DESC NULLS LAST, abs_delta DESC, curr_title ASC NULLS LAST) AS place
            FROM (SELECT *, rank() OVER (ORDER BY year DESC, month DESC) AS age FROM gs_trending_mom WHERE lang = of_lang)
            WHERE age = 1) WHERE place <= k""",
    ),
    "most_years_in_top": _function(
        "most_years_in_top", "of_lang STRING, k INT DEFAULT 20", "curr_title STRING, years_in_top10 BIGINT",
        """SELECT curr_title, years FROM (
            SELECT curr_title, count(*) AS years, row_number() OVER (ORDER BY count(*) DESC, curr_title ASC NULLS LAST) AS place
            FROM gs_top10_by_year WHERE lang = of_lang GROUP BY curr_title) WHERE place <= k""",
    ),
    "popular_in_both": _function(
        "popular_in_both", "lang_a STRING, lang_b STRING, of_year INT, k INT DEFAULT 20",
        "curr_title STRING, clicks_a BIGINT, clicks_b BIGINT",
        """SELECT curr_title, clicks_a, clicks_b FROM (
            SELECT a.curr_title, a.clicks_year AS clicks_a, b.clicks_year AS clicks_b,
                row_number() OVER (ORDER BY a.clicks_year + b.clicks_year DESC, a.curr_title) AS place
            FROM gs_top10_by_year a JOIN gs_top10_by_year b ON a.curr_title = b.curr_title
            WHERE a.lang = lang_a AND b.lang = lang_b AND a.year = of_year AND b.year = of_year) WHERE place <= k""",
    ),
    "leader_of_each_year": _function(
        "leader_of_each_year", "of_lang STRING", "year INT, curr_title STRING, clicks_year BIGINT",
        "SELECT year, curr_title, clicks_year FROM gs_top10_by_year WHERE lang = of_lang AND rn = 1",
    ),
    "comebacks": _function(
        "comebacks", "of_lang STRING", "curr_title STRING, last_seen_year INT, comeback_year INT",
        """SELECT curr_title, last_seen, year FROM (
            SELECT curr_title, year, lag(year) OVER (PARTITION BY curr_title ORDER BY year) AS last_seen
            FROM gs_top10_by_year WHERE lang = of_lang AND rn <= 10) WHERE year - last_seen > 1""",
    ),
    "leader_margin": _function(
        "leader_margin", "of_lang STRING, of_year INT",
        "leader STRING, leader_clicks BIGINT, runner_up STRING, runner_up_clicks BIGINT, margin BIGINT",
        """SELECT leader, leader_clicks, runner_up, runner_up_clicks, leader_clicks - runner_up_clicks FROM (
            SELECT max(CASE WHEN rn = 1 THEN curr_title END) AS leader, max(CASE WHEN rn = 1 THEN clicks_year END) AS leader_clicks,
                max(CASE WHEN rn = 2 THEN curr_title END) AS runner_up, max(CASE WHEN rn = 2 THEN clicks_year END) AS runner_up_clicks
            FROM gs_top10_by_year WHERE lang = of_lang AND year = of_year)""",
    ),
}
