"""Comparison of two states of a table."""

from __future__ import annotations

from .. import views
from ..operators.lineage import Scratch, cut_lineage
from ..operators.tablediff import diff_tables
from .catalog import query

#: The later state: some orders gone, dearer, without a priority, there twice, or new.
_LATER = """
SELECT CASE WHEN copy = 3 THEN -o_orderkey ELSE o_orderkey END AS o_orderkey, o_custkey, o_orderstatus,
 CASE WHEN o_orderkey % 89 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, o_orderdate,
 CASE WHEN o_orderkey % 83 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority
FROM (SELECT *, {copies} AS copy FROM {orders})
WHERE o_orderkey % 97 <> 0 AND (copy = 1 OR copy = 2 AND o_orderkey % 79 = 0 OR copy = 3 AND o_orderkey % 73 = 0)"""

_DIFF = f"""
WITH later AS ({_LATER.format(orders="orders", copies="unnest([1, 2, 3])")}),
bags AS (
 SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, sum(l)::bigint AS l, sum(r)::bigint AS r
 FROM (SELECT *, 1 AS l, 0 AS r FROM orders UNION ALL SELECT *, 0, 1 FROM later) GROUP BY ALL)
SELECT o_orderkey, CASE WHEN sum(r) = 0 THEN 'missing' WHEN sum(l) = 0 THEN 'added'
  WHEN count(*) FILTER (l = 0 OR r = 0) = 0 THEN 'repeated' ELSE 'changed' END AS change,
 sum(greatest(l - r, 0))::bigint AS left_more, sum(greatest(r - l, 0))::bigint AS right_more
FROM bags GROUP BY o_orderkey HAVING sum(abs(l - r)) > 0"""


@query(_DIFF)
def table_diff(spark, sf_dir):
    """The orders in which two states of the table differ, and how."""
    orders = views.read_table(spark, sf_dir, "orders")
    later = spark.sql(_LATER.replace("{copies}", "explode(array(1, 2, 3))"), orders=orders)
    with Scratch(spark) as scratch:
        return cut_lineage(diff_tables(orders, later, ["o_orderkey"], scratch).keys, "table")
