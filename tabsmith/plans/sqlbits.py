"""SQL fragments shared by the oracle texts (DuckDB dialect)."""

from tabsmith.functions.draws import sql_pick_index, sql_rand_int, sql_shuffled, sql_u  # noqa: F401

BRANDS = ("(SELECT CAST(row_number() OVER (ORDER BY p_brand) - 1 AS BIGINT) AS idx, p_brand AS value "
          "FROM (SELECT DISTINCT p_brand FROM part WHERE p_brand IS NOT NULL))")

WORDS = (r"(SELECT CAST(row_number() OVER (ORDER BY w) - 1 AS BIGINT) AS idx, w AS value FROM "
         r"(SELECT DISTINCT t.w FROM part, unnest(regexp_split_to_array(trim(p_name), '\s+')) AS t(w) "
         r"WHERE t.w IS NOT NULL))")


def tokens(col: str) -> str:
    return rf"regexp_split_to_array(trim({col}), '\s+')"
