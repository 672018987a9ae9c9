"""Gazetteer views over the test tables: one text for Spark (DataFrames in braces) and for DuckDB."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    "p_base": """
SELECT concat('su:', cast(s_suppkey AS varchar(20))) AS place_id, 'su' AS namespace, s_name AS title, n_name AS ccode, 'SUPPLIER' AS type_identifier, 'su' AS type_label, s_suppkey AS k
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey
UNION ALL
SELECT concat('cu:', cast(c_custkey AS varchar(20))), 'cu', c_name, n_name, c_mktsegment, 'cu', c_custkey FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey
UNION ALL
SELECT concat('pa:', cast(p_partkey AS varchar(20))), 'pa', p_name, CAST(NULL AS varchar(20)), p_type, 'pa', p_partkey FROM {part}""",
    "p_pt": """
SELECT place_id, namespace, title, ccode, type_identifier, type_label, k, CAST((k * 37) % 360 - 180 AS double) + CAST(k % 7 AS double) * 0.125 AS lon,
  CAST((k * 17) % 160 - 80 AS double) + CAST(k % 5 AS double) * 0.125 AS lat FROM {p_base}""",
    "ts_flat": """
SELECT concat('cu:', cast(o_custkey AS varchar(20))) AS place_id, CAST(min(year(o_orderdate)) AS bigint) AS s_in, CAST(NULL AS bigint) AS s_earliest, CAST(NULL AS bigint) AS s_latest,
  CAST(CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE max(year(o_orderdate)) END AS bigint) AS e_in, CAST(NULL AS bigint) AS e_earliest, CAST(NULL AS bigint) AS e_latest FROM {orders} GROUP BY o_custkey
UNION ALL
SELECT concat('pa:', cast(l_partkey AS varchar(20))), NULL, NULL, CAST(max(year(l_shipdate)) AS bigint), NULL, CAST(min(year(l_shipdate)) AS bigint), NULL FROM {lineitem} GROUP BY l_partkey
UNION ALL
SELECT concat('su:', cast(l_suppkey AS varchar(20))), NULL, NULL, CAST(max(year(l_shipdate)) AS bigint), NULL, CAST(max(year(l_shipdate)) AS bigint), NULL FROM {lineitem} GROUP BY l_suppkey""",
    "t_att": """
SELECT concat(title, '@', CASE k % 3 WHEN 0 THEN 'und' WHEN 1 THEN 'en' ELSE 'de' END) AS toponym_id, title AS name, CASE k % 3 WHEN 0 THEN 'und' WHEN 1 THEN 'en' ELSE 'de' END AS lang, namespace, place_id
FROM {p_base}""",
    "x_path": "SELECT concat('pa:', cast(p_partkey AS varchar(20))) AS place_id, concat(p_type, '.', p_brand, '.', cast(p_size AS varchar(20))) AS path FROM {part}",
    "e_edges": """
SELECT DISTINCT concat('cu:', cast(o_custkey AS varchar(20))) AS place_a, concat('pa:', cast(l_partkey AS varchar(20))) AS place_b,
  CASE (l_partkey + o_custkey) % 4 WHEN 0 THEN 'sameAs' WHEN 1 THEN 'exactMatch' WHEN 2 THEN 'closeMatch' ELSE 'distinct' END AS relation_type,
  CASE l_suppkey % 2 WHEN 0 THEN 'authority' ELSE 'contributor' END AS source_category, concat('src', cast(l_suppkey % 5 AS varchar(20))) AS source_id
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey WHERE l_linenumber = 1 AND l_orderkey % 5 = 0""",
}


class Views:
    """Tables of a folder and the views over them, as attributes, built when asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self._dir = spark, sf_dir

    def path(self, name: str) -> str:
        """Where a table is. A stream can't start from a single file, but can from a pattern that it matches."""
        return f"{self._dir}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name in VIEWS:
            text = VIEWS[name].replace("varchar(20)", "string")
            out = self.spark.sql(text, **{n: getattr(self, n) for n in set(re.findall(r"\{(\w+)\}", text))})
        else:
            out = self.spark.read.parquet(self.path(name))
        self.__dict__[name] = out
        return out


def with_views(sql: str) -> str:
    """DuckDB SQL with the views that it names before it."""
    need: list[str] = []

    def add(text: str) -> None:
        for name in VIEWS:
            if re.search(rf"\b{name}\b", text) and name not in need:
                add(VIEWS[name])
                need.append(name)

    add(sql)
    if not need:
        return sql
    views = ", ".join(f"{n} AS ({re.sub(r'[{}]', '', VIEWS[n])})" for n in need)
    body = sql.strip()
    if body[:14].upper() == "WITH RECURSIVE":
        return f"WITH RECURSIVE {views}, {body[14:]}"
    return f"WITH {views}, {body[4:]}" if body[:5].upper() == "WITH " else f"WITH {views} {body}"
