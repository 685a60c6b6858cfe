"""Registered queries of problem 6 and their SQL."""

from __future__ import annotations

from graphloom.operators import references as R
from graphloom.runtime import read


def _orphans(spark, d):
    return R.orphans(read(spark, d, "relationships"), {t: read(spark, d, t) for t in R.PARENT_TABLES.values()})


def p6_found(spark, d):
    return _orphans(spark, d).select("rel_id", "side", "reason")


def p6_report(spark, d):
    return R.orphan_report(_orphans(spark, d))


_SQL = r"""
WITH parents AS (
  SELECT t, replace(lower(id), '-', '') AS k, min(loaded_at) AS first_loaded, min(deleted_at) AS deleted_at
  FROM (SELECT 'actors' AS t, id, loaded_at, deleted_at FROM actors
        UNION ALL SELECT 'event_records', id, loaded_at, deleted_at FROM event_records
        UNION ALL SELECT 'concepts', id, loaded_at, deleted_at FROM concepts
        UNION ALL SELECT 'publications', id, loaded_at, deleted_at FROM publications
        UNION ALL SELECT 'locations', id, loaded_at, deleted_at FROM locations) u
  WHERE id IS NOT NULL GROUP BY 1, 2),
ends AS (
  SELECT rel_id, created_at, 'source' AS side, source AS ref, source_type AS rt FROM relationships
  UNION ALL SELECT rel_id, created_at, 'target', target, target_type FROM relationships),
keyed AS (
  SELECT rel_id, created_at, side,
    CASE regexp_replace(lower(trim(rt)), 's$', '') WHEN 'actor' THEN 'actors' WHEN 'event' THEN 'event_records'
      WHEN 'concept' THEN 'concepts' WHEN 'publication' THEN 'publications' WHEN 'location' THEN 'locations' END AS t,
    regexp_replace(regexp_replace(lower(ref), '[^0-9a-z:]', '', 'g'), '^(urn:)?(uuid:)?', '') AS k
  FROM ends WHERE regexp_replace(ref, '\s', '', 'g') <> ''),
judged AS (
  SELECT rel_id, created_at, side, keyed.t,
    CASE WHEN p.k IS NULL THEN 'missing' WHEN p.deleted_at <= created_at THEN 'deleted'
         WHEN created_at < p.first_loaded THEN 'late' END AS reason
  FROM keyed LEFT JOIN parents p ON p.t = keyed.t AND p.k = keyed.k)
"""

QUERIES = {"p6_found": p6_found, "p6_report": p6_report}
SQL = {
    "p6_found": _SQL + "SELECT rel_id, side, reason FROM judged WHERE reason IS NOT NULL",
    "p6_report": _SQL
    + "SELECT coalesce(t, '(unknown)') AS table_name, coalesce(strftime(created_at, '%Y-%m'), '(none)') AS month, reason, count(*) AS n"
    " FROM judged WHERE reason IS NOT NULL GROUP BY 1, 2, 3",
}
