"""Inputs of the layers' kinds, derived from the given tables by SQL.

The text runs unchanged in Spark and in the SQL engine results are compared with, so
both start from the same rows; ``{q}`` is the identifier quote.  The first four are
described in FIXTURES.md.  The source-database tables come from supplier, part, orders
and lineitem, so that the export grows with the data.
"""

RAW_ADDRESSES = """
SELECT cast(o_orderkey AS varchar(20)) AS uprn,
       concat('Flat ', cast(o_orderkey % 40 AS varchar(20)), ', ', o_orderpriority) AS address,
       concat(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ', cast(o_orderkey % 26 AS int) + 1, 1),
              cast(o_orderkey % 9 + 1 AS varchar(20)),
              CASE WHEN o_orderkey % 97 = 0 THEN '' ELSE ' ' END,
              cast(o_orderkey % 10 AS varchar(20)), 'AA') AS postcode,
       concat(CASE WHEN o_orderkey % 101 = 0 THEN '' ELSE 'SRID=4326;' END, 'POINT(',
              cast(cast(floor(((o_orderkey * 7919) % 4999) / 1000.0) AS int) AS varchar(20)), '.',
              lpad(cast(((o_orderkey * 7919) % 4999) % 1000 AS varchar(20)), 3, '0'), ' ',
              cast(cast(floor(((o_orderkey * 104729) % 5003) / 1000.0) AS int) AS varchar(20)), '.',
              lpad(cast(((o_orderkey * 104729) % 5003) % 1000 AS varchar(20)), 3, '0'), ')') AS location,
       o_orderstatus AS address_type
FROM orders
"""

BALLOTS = """
WITH g AS (SELECT n_nationkey AS n, n_name, cast(n_nationkey % 5 AS int) AS i,
                  cast(floor(n_nationkey / 5.0) AS int) AS j, n_nationkey % 7 = 6 AS small FROM nation)
SELECT concat('local.', n_name) AS election_id, cast(n AS varchar(20)) AS division_id,
       concat('POLYGON((', i, ' ', j, ',', i + 1, ' ', j, ',', i + 1, ' ', j + 1, ',', i, '.5 ', j, '.75,',
              i, ' ', j + 1, ',', i, ' ', j, '),(', i, '.125 ', j, '.125,', i, '.375 ', j, '.125,',
              i, '.25 ', j, '.375,', i, '.125 ', j, '.125))') AS geometry, 'Division' AS source_table
FROM g WHERE n % 3 <> 0 AND NOT small
UNION ALL
SELECT concat('local.', n_name), cast(n AS varchar(20)),
       concat('POLYGON((', i, '.25 ', j, '.25,', i, '.5 ', j, '.25,', i, '.25 ', j, '.5,', i, '.25 ', j, '.25))'), 'Division'
FROM g WHERE small
UNION ALL
SELECT concat('local.', n_name), cast(n AS varchar(20)),
       concat('POLYGON((', i, ' ', j, ',', i, '.5 ', j, ',', i, '.5 ', j + 1, ',', i, ' ', j + 1, ',', i, ' ', j, '))'), 'Division'
FROM g WHERE n % 3 = 0 AND NOT small
UNION ALL
SELECT concat('local.', n_name), cast(n AS varchar(20)),
       concat('POLYGON((', i, '.5 ', j, ',', i + 1, ' ', j, ',', i + 1, ' ', j + 1, ',', i, '.5 ', j + 1, ',', i, '.5 ', j, '))'), 'Division'
FROM g WHERE n % 3 = 0 AND NOT small
UNION ALL
SELECT concat('parl.', r_name), concat('o', cast(r_regionkey AS varchar(20))),
       concat('POLYGON((', r_regionkey, ' 0,', r_regionkey + 1, ' 0,', r_regionkey + 1, ' 4,', r_regionkey, ' 4,', r_regionkey, ' 0))'), 'Organisation'
FROM region
UNION ALL
SELECT concat('none.', r_name), CAST(NULL AS varchar(20)), CAST(NULL AS varchar(20)), 'None' FROM region
"""

BOUNDARY_CHANGES = """
WITH t AS (SELECT 'WAC' AS division_type UNION ALL SELECT 'CED'),
g AS (SELECT cast(n_nationkey % 5 AS int) AS i, cast(floor(n_nationkey / 5.0) AS int) AS j, division_type
      FROM nation CROSS JOIN t),
d AS (
SELECT i, j, division_type, 'old' AS gen, concat('ward-', j) AS slug, concat(j, '.0') AS y0, concat(j + 1, '.0') AS y1 FROM g
UNION ALL
SELECT i, j, division_type, 'new', CASE WHEN j = 1 THEN 'ward-1-renamed' ELSE concat('ward-', j) END,
       CASE WHEN j = 3 THEN '3.25' ELSE concat(j, '.0') END, CASE WHEN j = 2 THEN '3.25' ELSE concat(j + 1, '.0') END FROM g)
SELECT i + 1 AS boundary_review_id, gen AS divisionset_generation, division_type, slug AS division_slug,
       concat('Ward ', j, ' ', gen) AS division_name, concat('gss:E', i, j) AS division_official_identifier,
       concat('https://tiles.example/', i, '_', gen, '.pmtiles') AS divisionset_pmtiles_url,
       CASE WHEN i = 0 THEN NULL ELSE concat('https://consult.example/', i) END AS consultation_url,
       concat('Order "', i, '"') AS legislation_title, '2026-05-07' AS effective_date,
       concat('Org ', i) AS organisation_name, concat('Org ', i, ' Council') AS organisation_official_name,
       concat('E0', i) AS organisation_gss,
       concat('POLYGON((', i, ' ', y0, ',', i + 1, ' ', y0, ',', i + 1, ' ', y1, ',', i, ' ', y1, ',', i, ' ', y0, '))') AS division_boundary_wkt
FROM d
"""

ELECTIONS = """
SELECT concat('e.', cast(p_partkey AS varchar(20))) AS election_id,
       CASE WHEN p_partkey % 4 = 0 THEN 'Suggested' ELSE 'Approved' END AS current_status,
       CASE WHEN p_size % 2 = 0 THEN DATE '2026-06-01' ELSE DATE '2026-01-01' END AS poll_open_date,
       CASE WHEN p_partkey % 3 = 0 THEN true WHEN p_partkey % 3 = 1 THEN false END AS {q}current{q},
       CASE WHEN p_partkey % 5 = 0 THEN 'organisation' END AS group_type,
       CASE WHEN p_partkey % 2 = 0 THEN p_partkey % 25 END AS division_geography_id,
       CASE WHEN p_partkey % 7 < 2 THEN p_partkey % 5 END AS organisation_geography_id
FROM part
"""

# Ballots as they were before: one outline larger, one election more on an area, one
# area gone and one that is no longer there.
BALLOTS_BEFORE = """
SELECT election_id, division_id,
       CASE WHEN division_id = '4' THEN 'POLYGON((3.5 0,5 0,5 1.5,3.5 1.5,3.5 0))' ELSE geometry END AS geometry, source_table
FROM (""" + BALLOTS + """) b WHERE coalesce(division_id, '') <> '11'
UNION ALL
SELECT concat('former.', election_id), division_id, geometry, source_table FROM (""" + BALLOTS + """) b WHERE division_id = '16'
UNION ALL
SELECT 'former', 'f', 'POLYGON((0.5 3.5,1.5 3.5,1.5 4.5,0.5 4.5,0.5 3.5))', 'Division'
"""

# The layer's rows as (outcode, postcode, uprn, ballot_ids text) before a refresh of its units: some
# addresses have moved since, some ballots are gone, an outcode is new and another empty.
FORMER_UNITS = """
SELECT outcode, concat(outcode, substr(postcode, length(split_part(postcode, ' ', 1)) + 1)) AS postcode, uprn,
       CASE WHEN uprn IN ('40', '400') THEN 'gone' WHEN outcode = 'D2' THEN '' ELSE ballot_ids END AS ballot_ids
FROM (SELECT uprn, postcode, ballot_ids,
             CASE WHEN split_part(postcode, ' ', 1) = 'C3' THEN 'Z99' ELSE split_part(postcode, ' ', 1) END AS outcode FROM layer) u
"""

# Small concave areas, one per supplier, spread over the addresses and overlapping.
WARD_BALLOTS = """
SELECT concat('ward.', cast(k AS varchar(20))) AS election_id, cast(k AS varchar(20)) AS division_id,
       concat('POLYGON((', x, ' ', y, ', ', x + 3, ' ', y, ', ', x + 3, '.5 ', y + 2, ', ', x + 1, '.25 ', y + 1, '.5, ',
              x, '.25 ', y + 3, ', ', x, ' ', y, '))') AS geometry,
       CASE WHEN k % 3 = 0 THEN 'Organisation' ELSE 'Division' END AS source_table
FROM (SELECT s_suppkey AS k, cast((s_suppkey * 37) % 50 AS int) AS x, cast((s_suppkey * 53) % 47 AS int) AS y FROM supplier) s
"""

# Ballots of the elections export: its area tables are the pieces of BALLOTS.
DIVISION_PIECES = """
SELECT cast(division_id AS bigint) * 10 + 1 AS id, cast(division_id AS bigint) AS division_geography_id, geometry AS geography
FROM (""" + BALLOTS + """) b WHERE source_table = 'Division'
"""

ORGANISATION_PIECES = """
SELECT cast(substr(division_id, 2) AS bigint) * 10 + 7 AS id, cast(substr(division_id, 2) AS bigint) AS organisation_geography_id,
       geometry AS geography
FROM (""" + BALLOTS + """) b WHERE source_table = 'Organisation'
"""

ORGANISATIONS = """
SELECT s_suppkey AS id, s_name AS common_name, concat('org-', cast(s_suppkey AS varchar(20))) AS slug,
       concat(s_name, ' Council') AS official_name
FROM supplier
"""

# Every tenth organisation has two geographies.
ORGANISATION_GEOGRAPHIES = """
SELECT s_suppkey AS organisation_id, concat('E', cast(s_suppkey AS varchar(20))) AS gss FROM supplier
UNION ALL
SELECT s_suppkey, concat('W', cast(s_suppkey AS varchar(20))) FROM supplier WHERE s_suppkey % 10 = 4
"""

# For some organisations the new divisionset is the one that is current.
REVIEWS = """
SELECT s_suppkey + 1 AS id, s_suppkey AS organisation_id, concat('review-', cast(s_suppkey AS varchar(20))) AS slug,
       CASE WHEN s_suppkey % 4 = 0 THEN 'Current' ELSE 'Completed' END AS status,
       'Final recommendations' AS latest_event,
       CASE WHEN s_suppkey % 3 <> 0 THEN concat('https://consult.example/', cast(s_suppkey AS varchar(20))) END AS consultation_url,
       concat('Order "', cast(s_suppkey AS varchar(20)), '", part 1') AS legislation_title,
       DATE '2026-05-07' AS effective_date, DATE '2025-01-01' AS created, DATE '2025-06-01' AS modified,
       CASE WHEN s_suppkey % 6 = 0 THEN s_suppkey * 20 ELSE s_suppkey * 20 + 19 END AS divisionset_id
FROM supplier
"""

# Twenty per organisation, with open ends, ties and organisations with open ends only.
DIVISIONSETS = """
SELECT p_partkey AS id, cast(floor(p_partkey / 20.0) AS bigint) AS organisation_id,
       CASE WHEN p_partkey % 20 NOT IN (0, 19) AND cast(floor(p_partkey / 20.0) AS bigint) % 7 <> 0
            THEN DATE '2000-01-01' + p_size END AS end_date,
       CASE WHEN p_partkey % 11 <> 0 THEN concat('md5-', cast(p_partkey AS varchar(20))) END AS pmtiles_md5_hash
FROM part
"""

DIVISIONS = """
SELECT o_orderkey AS id, cast(floor(o_orderkey * 2 / 15.0) AS bigint) AS divisionset_id,
       concat('ward-', cast(o_orderkey % 7 AS varchar(20))) AS slug, concat('Ward ', cast(o_orderkey % 7 AS varchar(20))) AS name,
       CASE WHEN o_orderkey % 5 <> 0 THEN concat('gss:E', cast(o_orderkey AS varchar(20))) END AS official_identifier,
       CASE WHEN o_orderkey % 3 = 0 THEN 'CED' ELSE 'WAC' END AS division_type
FROM orders
"""

DIVISION_GEOGRAPHIES = """
SELECT o_orderkey + 1000000 AS id, o_orderkey AS division_id FROM orders
"""

REVIEW_PIECES = """
SELECT l_orderkey + 1000000 AS division_geography_id,
       concat('POLYGON((', cast(l_partkey AS varchar(20)), ' 0,', cast(l_partkey + 1 AS varchar(20)), ' 0,',
              cast(l_partkey AS varchar(20)), ' ', cast(l_linenumber AS varchar(20)), ',', cast(l_partkey AS varchar(20)), ' 0))') AS geography
FROM lineitem
"""

CHANGE_EVENTS = """
SELECT event_id, ts,
       CASE event_type WHEN 'purchase' THEN 'elections_set_changed' WHEN 'signup' THEN 'boundary_change_set_changed'
            ELSE event_type END AS event_type,
       props AS content
FROM events
"""

TABLES = (
    "region nation customer supplier part orders lineitem events documents"
    " embeddings pages benchmark labels conversations"
).split()


def spark_text(text):
    return text.replace("{q}", "`")


def ansi_text(text):
    return text.replace("{q}", '"')


# Every group holds one common member, all groups stand under one key, and few are equal.
CROWDED_GROUPS = """
SELECT 'all' AS flag, concat('a', cast(o AS varchar(20))) AS part,
       concat('b', cast(o - CASE WHEN o % 5 = 1 THEN 1 ELSE 0 END AS varchar(20))) AS pair, member
FROM (SELECT l_orderkey AS o, cast(l_partkey AS varchar(20)) AS member FROM lineitem
      UNION ALL SELECT DISTINCT l_orderkey, 'everyone' FROM lineitem) held
"""
