"""Domain tables derived from the given tables, in SQL that Spark and DuckDB both run.

Every domain table grows with the table it is made of.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dyelake.sources.tables import table

#: Each domain table over given tables or domain tables named earlier.
VIEWS = {
    # One call per line: which peptide it truly is, which was called, how surely.
    "calls": """SELECT CAST(l_orderkey % 5 AS INT) AS run_i, CAST(l_partkey + 1 AS INT) AS true_pep_i,
        CAST(CASE WHEN l_linenumber % 3 > 0 THEN l_partkey + 1 ELSE l_suppkey + 1 END AS INT) AS pred_pep_i, l_quantity / 50 AS score FROM lineitem""",
    "calls_k": """SELECT CAST(l_partkey + 1 AS INT) AS peak_i, CAST(l_suppkey % 50 AS INT) AS dyt_i, CAST(CASE WHEN l_suppkey % 50 = 0 THEN 0 ELSE l_partkey + 1 END AS INT) AS pep_i,
        l_quantity / 50 AS score, 1 + l_tax AS k FROM lineitem""",
    "pros": """SELECT CAST(s_suppkey + 1 AS INT) AS pro_i, s_name AS pro_id, s_nationkey % 2 = 1 AS pro_is_decoy, CASE WHEN s_suppkey % 3 = 0 THEN 1 ELSE 0 END AS pro_report,
        CAST(1 + s_suppkey % 7 AS DOUBLE) AS abundance, concat(CAST(1 + s_suppkey % 5 AS STRING), ';', CAST(8 + s_suppkey % 9 AS STRING)) AS pro_ptm_locs FROM supplier
        UNION ALL SELECT 0, '', FALSE, 0, CAST(0 AS DOUBLE), ''""",
    "part_source": "SELECT l_partkey, min(l_suppkey) AS l_suppkey FROM lineitem GROUP BY l_partkey",
    "peps": """SELECT CAST(p_partkey + 1 AS INT) AS pep_i, CAST(p_partkey % 7 AS INT) AS pep_start, CAST(p_partkey % 7 + p_size AS INT) AS pep_stop, CAST(coalesce(l_suppkey + 1, 0) AS INT) AS pro_i
        FROM part LEFT JOIN part_source ON p_partkey = l_partkey UNION ALL SELECT 0, 0, 1, 0""",
    "pep_strings": """SELECT CAST(p_partkey + 1 AS INT) AS pep_i, upper(regexp_replace(concat(p_name, p_type), '[^A-Za-z]', ''{g})) AS seq FROM part UNION ALL SELECT 0, '.'""",
    "prices": "SELECT CAST(p_partkey + 1 AS INT) AS pep_i, CAST(p_partkey % 4 AS DOUBLE) AS abundance FROM part UNION ALL SELECT 0, CAST(0 AS DOUBLE)",
    "priors": "SELECT CAST(p_partkey + 1 AS INT) AS pep_i, (p_size % 10 + 1) / CAST(10 AS DOUBLE) AS prior FROM part UNION ALL SELECT 0, CAST(-1 AS DOUBLE)",
    "specs": """SELECT doc_id, concat('doc', CAST(doc_id AS STRING)) AS name, upper(regexp_replace(coalesce(text, ''), '[^A-Za-z]', ''{g})) AS sequence FROM documents""",
    # One peak per order, one cycle per line of it.
    "radmat": """SELECT CAST(l_orderkey AS INT) AS peak_i, 0 AS channel_i,
        CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice) - 1 AS INT) AS cycle_i,
        CAST(l_orderkey % 20 AS INT) AS field_i, CAST(floor(l_extendedprice) AS DOUBLE) AS signal, l_quantity AS noise, 1 + floor(abs(l_discount) * 100 + 0.5) / 20 AS aspect_ratio FROM lineitem""",
    "peaks": """SELECT CAST(o_orderkey AS INT) AS peak_i, CAST(o_orderkey % 20 AS INT) AS field_i, CAST(floor(o_orderkey / 20) AS INT) AS field_peak_i,
        CAST(o_custkey % 512 AS DOUBLE) AS aln_x, CAST(floor(o_totalprice) % 512 AS DOUBLE) AS aln_y FROM orders""",
    "fields": """SELECT DISTINCT CAST(l_orderkey % 20 AS INT) AS field_i, 0 AS channel_i, CAST(l_linenumber - 1 AS INT) AS cycle_i,
        CAST(l_orderkey % 20 * 3 - 20 AS DOUBLE) AS aln_y, CAST(l_linenumber * 4 - l_orderkey % 20 AS DOUBLE) AS aln_x FROM lineitem""",
    "metadata": """SELECT DISTINCT CAST(l_orderkey % 20 AS INT) AS field_i, CAST(l_linenumber - 1 AS INT) AS cycle_i,
        CAST(l_orderkey % 20 * 1000 AS DOUBLE) AS stage_x, CAST(l_orderkey % 20 * 500 + l_linenumber AS DOUBLE) AS stage_y, CAST(10 + l_linenumber AS DOUBLE) AS exposure_time FROM lineitem""",
    "qualities": """SELECT CAST(l_orderkey % 20 AS INT) AS field_i, 0 AS channel_i, CAST(l_linenumber - 1 AS INT) AS cycle_i, CAST(sum(floor(l_quantity)) AS DOUBLE) AS quality FROM lineitem GROUP BY 1, 2, 3""",
    "rects": """SELECT CAST(c_custkey % 20 AS INT) AS field_i, CAST(c_custkey % 480 AS INT) AS l, CAST(c_custkey % 480 + 8 AS INT) AS r, CAST(c_custkey * 7 % 480 AS INT) AS b, CAST(c_custkey * 7 % 480 + 8 AS INT) AS t FROM customer""",
    "dyepeps": """SELECT CAST(l_suppkey % 50 + 1 AS INT) AS dyt_i, CAST(l_partkey + 1 AS INT) AS pep_i, CAST(count(*) AS BIGINT) AS n_reads FROM lineitem GROUP BY 1, 2""",
    "reads": """SELECT CAST(l_partkey + 1 AS INT) AS pep_i, CAST(l_linenumber % 3 AS INT) AS d0, CAST(floor(l_quantity / 25) AS INT) AS d1, CAST(l_suppkey % 2 AS INT) AS d2 FROM lineitem""",
    "survey": """SELECT peps.pro_i, peps.pep_i, peps.pep_start, peps.pep_stop, peps.pep_stop - peps.pep_start - 1 AS pep_len, CAST(p_partkey % 9 = 0 AS INT) AS p2,
        substr(p_type, 1, 3) AS flustr, CAST(p_size % 4 AS INT) AS n_dyes_max_any_ch, CAST(count(*) OVER (PARTITION BY substr(p_type, 1, 3), p_size) AS INT) AS flu_count,
        CAST(p_size % 13 AS DOUBLE) AS nn_dist, CAST(p_partkey % 3 AS INT) AS run_i FROM peps JOIN part ON peps.pep_i = p_partkey + 1""",
    "prs": """SELECT CAST(l_orderkey % 5 AS INT) AS run_i, CAST(l_partkey + 1 AS INT) AS pep_i, l_quantity / 50 AS score, floor(l_extendedprice) % 100 / CAST(100 AS DOUBLE) AS prec, l_tax * 10 AS recall FROM lineitem""",
    "locs": """SELECT CAST(c_custkey % 10 AS INT) AS field_i, CAST(c_custkey % 7 AS INT) AS cycle_i, CAST(c_custkey % 61 AS INT) AS x, CAST(floor(abs(c_acctbal)) % 61 AS INT) AS y FROM customer""",
    "runs": """SELECT CAST(o_custkey % 50 AS INT) AS run_i, concat('run', CAST(o_custkey % 50 AS STRING)) AS run_name, CAST(o_orderkey AS INT) AS job_i, o_orderstatus AS status FROM orders""",
}


def _needs(sql: str) -> list[str]:
    """The domain tables that an SQL text names, with what they need first."""
    found: list[str] = []
    for name, body in VIEWS.items():
        if re.search(rf"\b{name}\b", sql):
            found += [n for n in [*_needs(body), name] if n not in found]
    return found


def duck(sql: str) -> str:
    """``sql`` over domain tables for DuckDB, with their definitions before it."""
    held = ", ".join(f"{n} AS ({VIEWS[n].replace('{g}', ", 'g'")})" for n in _needs(sql))
    # A recursive or plain WITH of the text itself joins the list.
    own = sql.strip()
    if own.startswith("WITH "):
        return f"WITH {held}, {own[5:]}" if held else own
    return f"WITH {held} {own}" if held else own


_GIVEN = ("lineitem", "orders", "customer", "supplier", "part", "documents", "embeddings", "events")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A domain table; only the given tables that it is made of are read."""
    return over(spark, sf_dir, f"SELECT * FROM {name}")


def over(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """The rows of ``sql`` over given and domain tables."""
    names = _needs(sql)
    text = sql if not names else "WITH " + ", ".join(f"{n} AS ({VIEWS[n].replace('{g}', '')})" for n in names) + " " + sql
    given = {t: table(spark, sf_dir, t) for t in _GIVEN if re.search(rf"\b{t}\b", text)}
    for t in given:
        text = re.sub(rf"(FROM|JOIN) {t}\b", rf"\1 {{{t}}}", text)
    return spark.sql(text, **given)


def fields_of(radmat: DataFrame) -> DataFrame:
    """The ``fields`` table of every field, channel and cycle of ``radmat``; the view of that name ends with the seventh cycle."""
    own = radmat.select("field_i", "channel_i", "cycle_i").distinct()
    return own.withColumns({"aln_y": (F.col("field_i") * 3 - 20).cast("double"), "aln_x": ((F.col("cycle_i") + 1) * 4 - F.col("field_i")).cast("double")})
