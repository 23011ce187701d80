"""SQL for those of the numbered problems that it can express on whole tables."""

from __future__ import annotations

_IDS = "'nextQuestInChain', 'parentQuest', 'startQuest', 'preQuestSingle', 'questStarts', 'startsQuestIds'"
#: The kind of a member of a JSON value: one for numbers, however stored.
_KIND = "replace(replace(replace(j.type, 'UBIGINT', 'NUMBER'), 'BIGINT', 'NUMBER'), 'DOUBLE', 'NUMBER')"

_REFS = f"""latest AS (SELECT entity_type, entity_id, source, arg_max(record_status, (generated_at, delivered_at)) AS status FROM source_records GROUP BY ALL),
live AS (SELECT DISTINCT entity_type AS t, entity_id AS i FROM latest WHERE status = 'present' AND entity_type <> 'zone' UNION SELECT 'zone', CAST(area_id AS VARCHAR) FROM zones),
fields AS (SELECT row_id, delivered_at, unnest(map_entries(attributes)) AS e FROM source_records WHERE record_status = 'present'),
named AS (
  SELECT 'relationships' AS ref_table, edge_id AS ref_id, observed_at AS made, from_type AS target_type, from_id AS target_id FROM relationships
  UNION SELECT 'relationships', edge_id, observed_at, to_type, to_id FROM relationships
  UNION SELECT 'containments', containment_id, observed_at, child_type, CAST(child_id AS VARCHAR) FROM containments
  UNION SELECT 'source_records', row_id, delivered_at, 'quest', CAST(CAST(CAST(unnest(CASE WHEN e.value LIKE '[%' THEN CAST(CAST(e.value AS JSON) AS JSON[]) ELSE [CAST(e.value AS JSON)] END) AS DOUBLE) AS BIGINT) AS VARCHAR) FROM fields WHERE e.key IN ({_IDS}) AND e.value <> 'null'
  UNION SELECT 'source_records', row_id, delivered_at, x ->> '$.type', CAST(CAST(CAST(x ->> '$.id' AS DOUBLE) AS BIGINT) AS VARCHAR) FROM (SELECT row_id, delivered_at, unnest(CAST(CAST(e.value AS JSON) AS JSON[])) AS x FROM fields WHERE e.key = 'startedBy' AND e.value LIKE '[%')),
refs AS (SELECT * FROM named WHERE target_type IS NOT NULL AND target_id IS NOT NULL AND target_id NOT IN ('', '0'))"""
#: Changes of who has an entity: at each time of a source, whether it has it, and whether it had before.
_STEPS = """told AS (SELECT entity_type AS t, entity_id AS i, source, coalesce(generated_at, TIMESTAMP '0001-01-01') AS made, arg_max(record_status = 'present', (coalesce(delivered_at, TIMESTAMP '0001-01-01'), record_status <> 'present')) AS has FROM source_records WHERE entity_type IS NOT NULL AND entity_id IS NOT NULL GROUP BY ALL),
moments AS (SELECT DISTINCT t, i, made FROM told),
known AS (SELECT m.t, m.i, m.made, s.source, arg_max(s.has, s.made) AS has FROM moments m JOIN told s ON s.t = m.t AND s.i = m.i AND s.made <= m.made GROUP BY ALL),
timeline AS (SELECT t, i, made, bool_or(has) AS present FROM known GROUP BY ALL)"""

#: Steps up from every node, and the last step of those that come to an end.
_WALK = """WITH RECURSIVE up AS (SELECT child_type AS t, child_id AS i, arg_max(parent_type, observed_at) AS pt, arg_max(parent_id, observed_at) AS pi FROM containments WHERE parent_id IS NOT NULL GROUP BY ALL),
n AS (SELECT count(*) AS n FROM up),
walk AS (SELECT t, i, pt, pi, 1 AS d FROM up UNION ALL SELECT w.t, w.i, u.pt, u.pi, d + 1 FROM walk w JOIN up u ON u.t = w.pt AND u.i = w.pi, n WHERE d <= n.n),
ends AS (SELECT w.t, w.i, w.pt, w.pi, w.d FROM walk w LEFT JOIN up u ON u.t = w.pt AND u.i = w.pi WHERE u.t IS NULL)"""
#: Complete documents of raw files, in order: a text is one, an array of them, or one a line.
_DOCUMENTS = """WITH texts AS (SELECT file_id, replace(replace(file_text, chr(65279), ''), chr(13), '') AS t FROM raw_files WHERE length(trim(file_text)) > 0),
whole AS (SELECT file_id, CAST(t AS JSON) AS j FROM texts WHERE json_valid(t)),
listed AS (SELECT file_id, CASE WHEN json_type(j) = 'ARRAY' THEN CAST(j AS JSON[]) ELSE [j] END AS ds FROM whole),
lines AS (SELECT file_id, unnest(string_split(t, chr(10))) AS x, unnest(range(len(string_split(t, chr(10))))) AS pos FROM texts WHERE NOT json_valid(t)),
parts AS (SELECT file_id, unnest(ds) AS d, unnest(range(len(ds))) AS pos FROM listed UNION ALL SELECT file_id, CAST(rtrim(ltrim(x, '['), ',]') AS JSON), pos FROM lines WHERE json_valid(rtrim(ltrim(x, '['), ',]')) AND ltrim(x, '[') LIKE '{%'),
documents AS (SELECT * FROM parts WHERE d ->> '$.questId' IS NOT NULL OR (d ->> '$.kind' = 'object' AND d ->> '$.id' IS NOT NULL))"""


def _latest(side: str) -> str:
    return f"{side}_side AS (SELECT coalesce(flavor, '') AS f, coalesce(entity_type, '') AS t, coalesce(entity_id, '') AS i, arg_max(attributes, (loaded_at, md5(attributes))) AS a, arg_max(field_states, (loaded_at, md5(attributes))) AS s FROM dataset_{side} GROUP BY ALL)"


def _copies(near: str = "FALSE") -> str:
    """entity_type, entity_id, status, diff_path; near says when two numbers x and y under m are equal all the same."""
    return f"""WITH RECURSIVE {_latest("left")}, {_latest("right")},
both_ AS (SELECT coalesce(l.f, r.f) AS f, coalesce(l.t, r.t) AS t, coalesce(l.i, r.i) AS i, l.f IS NOT NULL AS in_left, r.f IS NOT NULL AS in_right, l.a AS la, r.a AS ra, l.s AS ls, r.s AS rs FROM left_side l FULL JOIN right_side r ON l.f = r.f AND l.t = r.t AND l.i = r.i),
walk AS (SELECT f, t, i, '' AS path, '' AS m, CAST(la AS JSON) AS x, CAST(ra AS JSON) AS y, NULL::JSON AS above, NULL::JSON AS beside FROM both_ WHERE in_left AND in_right
  UNION ALL SELECT f, t, i, CASE WHEN path = '' THEN m ELSE path || '.' || m END, m, json_extract(x, '$."' || m || '"'), json_extract(y, '$."' || m || '"'), x, y FROM (SELECT f, t, i, path, x, y, unnest(list_distinct(list_concat(json_keys(x), json_keys(y)))) AS m FROM walk WHERE json_type(x) = 'OBJECT' AND json_type(y) = 'OBJECT') AS members),
leaves AS (SELECT * FROM walk WHERE NOT coalesce(json_type(x) = 'OBJECT' AND json_type(y) = 'OBJECT', FALSE)),
texts AS (SELECT v, string_agg(j.fullkey || '=' || {_KIND} || CASE WHEN j.type IN ('UBIGINT', 'BIGINT', 'DOUBLE') THEN CAST(CAST(j.atom AS DOUBLE) AS VARCHAR) WHEN j.type IN ('VARCHAR', 'BOOLEAN') THEN j.atom ->> '$' ELSE '' END, ';' ORDER BY j.fullkey) AS c FROM (SELECT x AS v FROM leaves WHERE x IS NOT NULL UNION SELECT y FROM leaves WHERE y IS NOT NULL) d, json_tree(d.v) j GROUP BY v),
states AS (SELECT f, t, i, ls, rs, unnest(list_distinct(list_concat(coalesce(map_keys(ls), []), coalesce(map_keys(rs), [])))) AS k FROM both_ WHERE in_left AND in_right)
SELECT t AS entity_type, i AS entity_id, CASE WHEN in_left THEN 'leftOnly' ELSE 'rightOnly' END AS status, '' AS diff_path FROM both_ WHERE NOT (in_left AND in_right)
UNION ALL SELECT t, i, 'changed', path FROM leaves LEFT JOIN texts a ON a.v = x LEFT JOIN texts b ON b.v = y WHERE a.c IS DISTINCT FROM b.c AND NOT coalesce({near}, FALSE)
UNION ALL SELECT t, i, 'changed', '$fieldStates.' || k FROM states WHERE ls[k] IS DISTINCT FROM rs[k]"""


_SAME_MAP = " OR ".join(f"CAST(above ->> '$.{n}' AS VARCHAR) = CAST(beside ->> '$.{n}' AS VARCHAR)" for n in ("zone", "zoneId", "map", "mapId", "uiMapId"))
_NEAR = f"m IN ('x', 'y') AND ({_SAME_MAP}) AND abs(TRY_CAST(x ->> '$' AS DECIMAL(18, 6)) - TRY_CAST(y ->> '$' AS DECIMAL(18, 6))) <= 0.5"

SQL = {
    "p4_found": _copies(),
    "p4_near": f"SELECT entity_type, status, diff_path, count(*) AS n_entities FROM ({_copies(_NEAR)}) GROUP BY ALL",
    "p3_found": f"WITH {_REFS} SELECT ref_table, ref_id, target_type, target_id FROM refs WHERE (target_type, target_id) NOT IN (SELECT (t, i) FROM live)",
    "p3_intervals": f"""WITH {_STEPS},
marks AS (SELECT *, coalesce(present <> lag(present) OVER w, TRUE) AS starts FROM timeline WINDOW w AS (PARTITION BY t, i ORDER BY made)),
spans AS (SELECT *, lead(made) OVER (PARTITION BY t, i ORDER BY made) AS until FROM marks WHERE starts)
SELECT t AS entity_type, i AS entity_id, made AS valid_from, until AS valid_to FROM spans WHERE present""",
    "p3_report": f"""WITH {_REFS}, {_STEPS},
arrived AS (SELECT entity_type AS t, entity_id AS i, min(delivered_at) FILTER (record_status = 'present') AS first_delivered FROM source_records GROUP BY ALL),
then_ AS (SELECT r.ref_table, r.ref_id, r.target_type, r.target_id, count(m.made) AS n, arg_max(m.present, m.made) AS present FROM refs r LEFT JOIN timeline m ON m.t = r.target_type AND m.i = r.target_id AND (r.made IS NULL OR m.made <= r.made) GROUP BY ALL),
states AS (SELECT r.*, CASE
  WHEN r.target_type = 'zone' THEN CASE WHEN l.i IS NULL THEN 'missing' ELSE 'live' END
  WHEN a.i IS NULL THEN 'missing'
  WHEN l.i IS NULL THEN CASE WHEN h.n = 0 OR h.present THEN 'deleted' ELSE 'stale' END
  WHEN h.n = 0 OR NOT h.present OR coalesce(a.first_delivered > r.made, FALSE) THEN 'late' ELSE 'live' END AS ref_state
  FROM refs r JOIN then_ h USING (ref_table, ref_id, target_type, target_id) LEFT JOIN live l ON l.t = r.target_type AND l.i = r.target_id LEFT JOIN arrived a ON a.t = r.target_type AND a.i = r.target_id)
SELECT ref_table, strftime(made, '%Y-%m') AS period, ref_state, count(*) AS n_references, count(DISTINCT (target_type, target_id)) AS n_targets FROM states GROUP BY ALL""",
    "p6_found": f"""
WITH whole AS (SELECT source, source_revision, min(generated_at) AS made_at FROM manifests GROUP BY ALL HAVING bool_and(status = 'complete')),
revs AS (SELECT source, source_revision, row_number() OVER (PARTITION BY source ORDER BY made_at) AS n FROM whole),
cells AS (SELECT DISTINCT s.source, r.n, s.entity_type, s.entity_id, e.key AS field, e.value AS v FROM (SELECT source, source_revision, entity_type, entity_id, unnest(map_entries(attributes)) AS e FROM snapshot_rows) s JOIN revs r USING (source, source_revision) WHERE e.key <> 'fetchedAt'),
texts AS (SELECT v, string_agg(j.fullkey || '=' || {_KIND} || CASE WHEN j.type IN ('UBIGINT', 'BIGINT', 'DOUBLE') THEN CAST(CAST(j.atom AS DOUBLE) AS VARCHAR) WHEN j.type IN ('VARCHAR', 'BOOLEAN') THEN j.atom ->> '$' ELSE '' END, ';' ORDER BY j.fullkey) AS c FROM (SELECT DISTINCT v FROM cells) d, json_tree(d.v) j GROUP BY v),
flat AS (SELECT DISTINCT source, n, entity_type, entity_id, field, c FROM cells JOIN texts USING (v)),
held AS (SELECT source, n, entity_type, entity_id, string_agg(field || ':' || c, '|' ORDER BY field) AS h FROM flat GROUP BY ALL),
pairs AS (SELECT a.source, a.n, b.n AS m, b.source_revision FROM revs a JOIN revs b ON a.source = b.source AND b.n = a.n + 1),
before AS (SELECT p.source, p.m, p.source_revision, h.entity_type, h.entity_id, h.h FROM pairs p JOIN held h ON h.source = p.source AND h.n = p.n),
after AS (SELECT p.source, p.m, p.source_revision, h.entity_type, h.entity_id, h.h FROM pairs p JOIN held h ON h.source = p.source AND h.n = p.m)
SELECT source, source_revision, entity_type, entity_id, CASE WHEN b.h IS NULL THEN 'added' WHEN a.h IS NULL THEN 'removed' ELSE 'changed' END AS change_kind FROM before b FULL JOIN after a USING (source, source_revision, entity_type, entity_id) WHERE b.h IS DISTINCT FROM a.h""",
    "p7_found": f"""{_WALK}
SELECT up.t AS node_type, up.i AS node_id, coalesce(e.pt, 'cycle') AS root_type, coalesce(e.pi, -1) AS root_id, coalesce(e.d, -1) AS depth FROM up LEFT JOIN ends e ON e.t = up.t AND e.i = up.i""",
    "p7_descendants": f"{_WALK} SELECT w.pt AS node_type, w.pi AS node_id, w.t AS descendant_type, w.i AS descendant_id, w.d AS distance FROM walk w JOIN ends e ON e.t = w.t AND e.i = w.i",
    "p7_paths": f"""{_WALK}, ways AS (SELECT w.t, w.i, string_agg(w.pt || ':' || w.pi, '/' ORDER BY w.d DESC) || '/' || w.t || ':' || w.i AS path, max(w.d) AS depth FROM walk w JOIN ends e ON e.t = w.t AND e.i = w.i GROUP BY w.t, w.i)
SELECT up.t AS node_type, up.i AS node_id, path, coalesce(depth, -1) AS depth FROM up LEFT JOIN ways w ON w.t = up.t AND w.i = up.i""",
    "p1_found": f"""{_DOCUMENTS},
numbered AS (SELECT file_id, d, row_number() OVER (PARTITION BY file_id ORDER BY pos) - 1 AS child_no FROM documents),
flags AS (SELECT file_id, child_no, CASE WHEN json_type(f) = 'VARCHAR' THEN TRY_CAST(f ->> '$' AS JSON) ELSE f END AS f FROM (SELECT file_id, child_no, unnest([d -> '$.infoboxFlags', d -> '$.detail.infoboxFlags']) AS f FROM numbered WHERE d ->> '$.questId' IS NOT NULL)),
sources AS (SELECT row_id, unnest(map_entries(provenance)) AS e FROM source_records)
SELECT 'provenance_source' AS child_table, row_id AS parent_id, e.key AS child_name, CAST(unnest(range(len(e.value.sources))) AS INTEGER) AS child_no FROM sources
UNION ALL SELECT 'candidate', conflict_id, c.source, CAST(n AS INTEGER) FROM (SELECT conflict_id, unnest(candidates) AS c, unnest(range(len(candidates))) AS n FROM conflicts) WHERE c IS NOT NULL
UNION ALL SELECT DISTINCT 'daily', file_id, 'daily', CAST(child_no AS INTEGER) FROM flags WHERE lower(trim(f ->> '$.daily')) IN ('true', 'yes', 'y', 'on', 't') OR TRY_CAST(f ->> '$.daily' AS DOUBLE) <> 0""",
    "p5_spawns": f"""{_DOCUMENTS},
newest AS (SELECT CAST(d ->> '$.id' AS BIGINT) AS i, arg_max(d, (coalesce(d ->> '$.fetchedAt', ''), coalesce(modified_at, TIMESTAMP '0001-01-01'))) AS d FROM documents JOIN raw_files USING (file_id) WHERE d ->> '$.questId' IS NULL GROUP BY 1),
zones_of AS (SELECT DISTINCT i, CAST(CAST(unnest(CAST(d -> '$.spawns[*].zoneId' AS JSON[])) ->> '$' AS DOUBLE) AS BIGINT) AS zone_id FROM newest)
SELECT zone_id, count(*) AS n_objects FROM zones_of GROUP BY 1""",
    "p5_found": r"""
WITH docs AS (SELECT replace(replace(file_text, chr(65279), ''), chr(13), '') AS t FROM raw_files WHERE length(trim(file_text)) > 0),
whole AS (SELECT CAST(t AS JSON) AS j FROM docs WHERE json_valid(t)),
parts AS (SELECT unnest(CASE WHEN json_type(j) = 'ARRAY' THEN CAST(j AS JSON[]) ELSE [j] END) AS d FROM whole
  UNION ALL SELECT CAST(x AS JSON) FROM (SELECT rtrim(ltrim(unnest(string_split(t, chr(10))), '['), ',') AS x FROM docs WHERE NOT json_valid(t)) WHERE json_valid(x) AND x LIKE '{%')
SELECT DISTINCT CASE WHEN d ->> '$.questId' IS NOT NULL THEN 'details' ELSE 'object' END AS kind, CAST(coalesce(d ->> '$.questId', d ->> '$.id') AS BIGINT) AS record_id FROM parts WHERE d ->> '$.questId' IS NOT NULL OR (d ->> '$.kind' = 'object' AND d ->> '$.id' IS NOT NULL)""",
}
