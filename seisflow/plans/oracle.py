"""Oracle SQL for the registered queries (DuckDB dialect, also valid Spark SQL
for most texts).  Every text starts from the same ``quakes`` view over the
``events`` table that :func:`seisflow.sources.fixture.catalogue_from_events`
builds with the DataFrame API.  Double literals use ``e`` notation (``1e2``)
because ``100.0`` is a decimal in Spark SQL.
"""

QUAKES = """WITH b AS (SELECT event_id, ts, event_type, user_id, (user_id * 7) % 12 AS c FROM events),
quakes AS (
 SELECT event_id, concat('ev', CAST(event_id AS VARCHAR)) AS id,
  CASE WHEN event_id % 50 = 0 THEN NULL ELSE ((event_id * 13) % 95) / 1e1 - 5e-1 END AS magnitude,
  concat(CAST((user_id * 3) % 90 AS VARCHAR), ' km S of ', event_type) AS place,
  ts AS time,
  CASE WHEN event_id % 97 = 0 THEN NULL
       WHEN event_id % 10 = 0 THEN ((event_id * 7919) % 36000) / 1e2 - 18e1
       ELSE c * 3e1 - 175e0 + ((event_id * 37) % 400) / 1e2 END AS longitude,
  CASE WHEN event_id % 10 = 0 THEN ((event_id * 104729) % 18000) / 1e2 - 9e1
       ELSE ((c * 5) % 12) * 12e0 - 65e0 + ((event_id * 53) % 400) / 1e2 END AS latitude,
  CASE WHEN event_id % 83 = 0 THEN NULL ELSE ((event_id * 31) % 7000) / 1e1 END AS depth,
  ts AS updated FROM b)"""


def q(body: str, extra_ctes: str = "") -> str:
    """Prefix a query body with the fixture view (and optional extra CTEs)."""
    ctes = QUAKES + ("," + extra_ctes if extra_ctes else "")
    return ctes + "\n" + body


# The region boxes, first match wins.
REGION_FIRST = """(CASE WHEN longitude BETWEEN -170 AND -30 AND latitude BETWEEN 15 AND 90 THEN 1
 WHEN longitude BETWEEN -85 AND -30 AND latitude BETWEEN -60 AND 15 THEN 2
 WHEN longitude BETWEEN -30 AND 40 AND latitude BETWEEN 35 AND 90 THEN 3
 WHEN longitude BETWEEN 40 AND 180 AND latitude BETWEEN 0 AND 90 THEN 4
 WHEN longitude BETWEEN -30 AND 60 AND latitude BETWEEN -40 AND 35 THEN 5
 WHEN longitude BETWEEN 110 AND 180 AND latitude BETWEEN -50 AND 0 THEN 6
 WHEN NOT (longitude BETWEEN -170 AND 180 AND latitude BETWEEN -60 AND 90) THEN 7
 ELSE 0 END)"""


def zones(eps: float, min_samples: int = 3, rounds: int = 12) -> str:
    """CTEs that end in ``zoned``: quakes with coordinates and their DBSCAN zone.

    Neighbours through a grid join, core rows by count, then rounds of min-label steps with a jump to the label's
    own label; border rows take the smallest zone among their core neighbours.
    """
    ctes = [f"""st AS (SELECT avg(latitude) AS ma, stddev_pop(latitude) AS sa, avg(longitude) AS mo, stddev_pop(longitude) AS so
 FROM quakes WHERE latitude IS NOT NULL AND longitude IS NOT NULL),
zc AS MATERIALIZED (SELECT quakes.*, (latitude - ma) / sa AS zx, (longitude - mo) / so AS zy, CAST(floor((latitude - ma) / sa / {eps}) AS BIGINT) AS gx,
 CAST(floor((longitude - mo) / so / {eps}) AS BIGINT) AS gy FROM quakes, st WHERE latitude IS NOT NULL AND longitude IS NOT NULL),
around AS (SELECT dx, dy FROM (SELECT unnest([-1, 0, 1]) AS dx), (SELECT unnest([-1, 0, 1]) AS dy)),
nb AS MATERIALIZED (SELECT a.event_id AS a, b.event_id AS b FROM (SELECT event_id, zx, zy, gx + dx AS hx, gy + dy AS hy FROM zc, around) a
 JOIN zc b ON a.hx = b.gx AND a.hy = b.gy WHERE (a.zx - b.zx) ** 2 + (a.zy - b.zy) ** 2 <= {eps}::DOUBLE ** 2),
core AS MATERIALIZED (SELECT a AS v FROM nb GROUP BY a HAVING count(*) >= {min_samples}),
ce AS MATERIALIZED (SELECT a, b FROM nb JOIN core x ON x.v = a JOIN core y ON y.v = b),
l0 AS MATERIALIZED (SELECT a AS v, min(b) AS l FROM ce GROUP BY a)"""]
    for k in range(rounds):
        ctes.append(f"""h{k} AS MATERIALIZED (SELECT a AS v, min(l) AS l FROM ce JOIN l{k} ON l{k}.v = b GROUP BY a),
l{k + 1} AS MATERIALIZED (SELECT h.v, least(h.l, j.l) AS l FROM h{k} h JOIN h{k} j ON j.v = h.l)""")
    ctes.append(f"""zn AS MATERIALIZED (SELECT v, CAST(dense_rank() OVER (ORDER BY l) - 1 AS INTEGER) AS zone FROM l{rounds}),
bd AS (SELECT a AS v, min(zone) AS zone FROM nb JOIN zn ON zn.v = b GROUP BY a),
zoned AS (SELECT zc.*, coalesce(zn.zone, bd.zone, -1) AS zone FROM zc LEFT JOIN zn ON zn.v = event_id LEFT JOIN bd ON bd.v = event_id)""")
    return ", ".join(ctes)
