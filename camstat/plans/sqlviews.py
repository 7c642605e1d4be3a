"""SQL twins of ``camstat.sources.adapters`` for the DuckDB oracle (ANSI SQL
over the driver's registered views)."""

from __future__ import annotations

VIEWS = {
    "observations": """
  SELECT event_id AS obs_id, CAST(event_id AS VARCHAR) AS image_id, user_id AS camera_id,
         CAST(floor(user_id / 4) AS BIGINT) AS plot_id, event_type AS species, ts AS date_time,
         value / 500 AS confidence, year(ts) AS year, strftime(ts, '%b') AS month,
         dayofmonth(ts) AS day, concat_ws('_', year(ts), strftime(ts, '%b'), dayofmonth(ts)) AS ymd
  FROM events""",
    "long_observations": """
  SELECT o_orderkey AS obs_id, o_custkey AS camera_id, CAST(floor(o_custkey / 4) AS BIGINT) AS plot_id,
         o_orderpriority AS species, o_orderdate AS date_time, year(o_orderdate) AS year,
         strftime(o_orderdate, '%b') AS month, dayofmonth(o_orderdate) AS day,
         concat_ws('_', year(o_orderdate), strftime(o_orderdate, '%b'), dayofmonth(o_orderdate)) AS ymd
  FROM orders""",
    "cameras": """
  SELECT c_custkey AS camera_id, CAST(floor(c_custkey / 4) AS BIGINT) AS plot_id, c_nationkey AS site_id,
         -90.0 + (c_custkey % 700) / 100 AS lon, 50.0 + ((c_custkey * 7) % 550) / 100 AS lat,
         c_mktsegment AS habitat
  FROM customer""",
    "deployments": """
  SELECT o_custkey AS camera_id, CAST(min(o_orderdate) AS DATE) AS date_deployed,
         CAST(max(CASE WHEN o_orderstatus = 'F' THEN o_orderdate END) AS DATE) AS date_retrieved
  FROM orders GROUP BY o_custkey""",
    "boxes": """
  SELECT concat_ws('_', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS box_id,
         l_orderkey AS image_id, l_suppkey AS folder, l_linenumber AS box, l_quantity AS x,
         CAST(l_partkey % 100 AS DOUBLE) AS y, 1.0 + l_discount * 100 AS w, 1.0 + l_tax * 100 AS h,
         l_discount * 10 AS confidence, l_linenumber % 4 AS category_id, (l_orderkey % 7) = 0 AS isempty,
         CASE WHEN l_returnflag = 'R' THEN NULL ELSE
           ['Moose', 'Caribou', 'Black Bear', 'Gray Wolf', 'Sandhill Crane', 'Human', 'Vehicle',
            'Unknown', 'Other [See more species]'][CAST(l_partkey % 9 AS INTEGER) + 1] END AS species,
         l_linenumber = 7 AS manual,
         CASE WHEN l_returnflag = 'R' THEN 'manual' WHEN l_returnflag = 'A' THEN 'prediction,manual'
              ELSE 'prediction' END AS origin,
         l_shipdate AS date_time
  FROM lineitem""",
    "annotation_ids": """
  SELECT 'P' || CAST(l_suppkey AS VARCHAR) || '-' || CAST(l_orderkey % 3 + 1 AS VARCHAR)
         || '_CAM-' || CAST(l_partkey % 4 + 1 AS VARCHAR) || '_DCIM_100RECNX_RCNX'
         || CAST(l_orderkey AS VARCHAR) || 'x' || CAST(l_partkey AS VARCHAR) || '_'
         || CASE WHEN l_linenumber = 7 THEN 'M1' ELSE CAST(l_linenumber AS VARCHAR) END AS id,
         l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus, l_shipdate
  FROM lineitem""",
    "cells": """
  SELECT p_partkey AS cell_id, CASE WHEN p_partkey % 2 = 0 THEN 16 ELSE 17 END AS utm,
         -90.0 + (p_partkey % 70) / 10 AS cx, 50.0 + (CAST(floor(p_partkey / 70) AS BIGINT) % 56) / 10 AS cy,
         p_size % 13 AS value, (p_retailprice % 100) / 100 AS coverage_fraction
  FROM part""",
}


def with_views(names: list[str], body: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``body`` with a WITH clause defining the named adapter views (and
    any extra CTEs, in order)."""
    parts = [f"{n} AS ({VIEWS[n]}\n)" for n in names]
    parts += [f"{k} AS ({v}\n)" for k, v in (extra or {}).items()]
    b = body.lstrip()
    if b[:5].upper() == "WITH " and parts:
        return "WITH " + ",\n".join(parts) + ",\n" + b[5:]
    return ("WITH " + ",\n".join(parts) + "\n" + body) if parts else body
