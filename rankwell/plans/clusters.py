"""Registered queries: K-Means seeds and restarts (M1), saved centres and the items assigned to them."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from rankwell.operators import cluster, seeding
from rankwell.plans import modelling as M
from rankwell.plans import oracle_kmeans as OK
from rankwell.plans.splitting import SEED
from rankwell.session import ensure_checkpoint_dir
from rankwell.sources import centres
from rankwell.sources.adapter import with_ctes

STARTS = 3


def q_seeds(spark, sf):
    """M1: the seeds of each start, in the order in which they were chosen."""
    train, _ = M.split_frames(spark, sf)
    chosen, _ = seeding.seeds(train, M.K_MAIN, STARTS, seed=SEED)
    rows = [(s, i, p) for s, ids in chosen.items() for i, p in enumerate(ids)]
    return spark.createDataFrame(rows, "start int, position int, item_id bigint")


def q_restarts(spark, sf):
    """M1: WCSS of each start, and which one is the best."""
    train, _ = M.split_frames(spark, sf)
    _, table = seeding.fit(train, M.K_MAIN, STARTS, seed=SEED, max_iter=M.MAX_ITER)
    return table.select("start", "k", "wcss", "converged", "best")


def q_saved_clusters(spark, sf):
    """Centres saved as a version and read back; the items' held-out ratings are assigned to them without a new fit."""
    _, test = M.split_frames(spark, sf)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/centres-{uuid.uuid4().hex}"
    centres.save(M.kmeans(spark, sf, [M.K_MAIN]), M.K_MAIN, path, "v1")
    found = centres.assign(centres.load(spark, path, "v1"), test)
    return found.select("item_id", "cluster", F.round("distance", 6).alias("distance"))


QUERIES = {
    "M1_seeds": q_seeds,
    "M1_restarts": q_restarts,
    "S11_saved_clusters": q_saved_clusters,
}


def _seed_ctes(k: int, starts: int, rounds: int, seed: int, train: str = "train") -> list[str]:
    """CTEs ending in ``sd_seed`` (start, position, item_id) and ``sd_a0`` (k, item_id, cluster)."""
    def key(start, rnd, item):
        return f"md5(concat_ws('|', '{seed}', CAST({start} AS VARCHAR), '{rnd}', CAST({item} AS VARCHAR)))"

    def nearest(name, picked):
        return f"""{name} AS MATERIALIZED (
  SELECT p.start, x.item_id, min(struct_pack(d := CAST((x.nrm + y.nrm - 2 * coalesce(g.dot, 0)) * 1000000 AS BIGINT), c := p.c)) AS best
  FROM {picked} p CROSS JOIN sd_norm x JOIN sd_norm y ON y.item_id = p.c
  LEFT JOIN (SELECT a.item_id AS c, b.item_id, sum(a.rating * b.rating) AS dot
             FROM {train} a JOIN {train} b ON a.user_id = b.user_id
             WHERE a.item_id IN (SELECT c FROM {picked}) GROUP BY a.item_id, b.item_id) g
    ON g.c = p.c AND g.item_id = x.item_id
  GROUP BY p.start, x.item_id)"""

    values = ", ".join(f"({s})" for s in range(1, starts + 1))
    ctes = [f"""sd_norm AS MATERIALIZED (SELECT item_id, CAST(sum(rating * rating) AS BIGINT) AS nrm FROM {train} GROUP BY item_id)""",
            f"sd_starts AS MATERIALIZED (SELECT * FROM (VALUES {values}) v(start))",
            f"""sd_p0 AS MATERIALIZED (SELECT s.start, arg_min(x.item_id, {key('s.start', 0, 'x.item_id')}) AS c
  FROM sd_starts s CROSS JOIN sd_norm x GROUP BY s.start)""",
            nearest("sd_e0", "sd_p0")]
    for r in range(1, rounds + 1):
        ctes.append(f"""sd_p{r} AS MATERIALIZED (
  SELECT e.start, e.item_id AS c FROM sd_e{r - 1} e
  JOIN (SELECT start, CAST(sum(best.d) AS DOUBLE) AS phi FROM sd_e{r - 1} GROUP BY start) f ON f.start = e.start
  WHERE CAST(CAST('0x' || substr({key('e.start', r, 'e.item_id')}, 1, 8) AS BIGINT) AS DOUBLE) / 4294967296.0 * f.phi
        < {float(seeding.OVERSAMPLE * k)} * CAST(e.best.d AS DOUBLE))""")
        ctes.append(nearest(f"sd_n{r}", f"sd_p{r}"))
        ctes.append(f"""sd_e{r} AS MATERIALIZED (SELECT start, item_id, min(best) AS best
  FROM (SELECT * FROM sd_e{r - 1} UNION ALL SELECT * FROM sd_n{r}) GROUP BY start, item_id)""")
    ctes.append(f"""sd_w AS MATERIALIZED (SELECT start, best.c AS c, count(*) AS w FROM sd_e{rounds} GROUP BY start, best.c)""")
    ctes.append(f"""sd_dist AS MATERIALIZED (
  SELECT a.start, a.c, b.c AS o, x.nrm + y.nrm - 2 * coalesce(g.dot, 0) AS d
  FROM sd_w a JOIN sd_w b ON a.start = b.start JOIN sd_norm x ON x.item_id = a.c JOIN sd_norm y ON y.item_id = b.c
  LEFT JOIN (SELECT s.item_id AS c, u.item_id AS o, sum(s.rating * u.rating) AS dot FROM {train} s JOIN {train} u ON s.user_id = u.user_id
             WHERE s.item_id IN (SELECT c FROM sd_w) AND u.item_id IN (SELECT c FROM sd_w) GROUP BY s.item_id, u.item_id) g
    ON g.c = a.c AND g.o = b.c)""")
    ctes.append("""sd_g1 AS MATERIALIZED (SELECT start, 0 AS position, c AS item_id FROM sd_w
  QUALIFY row_number() OVER (PARTITION BY start ORDER BY w DESC, c) = 1)""")
    for i in range(2, k + 1):
        ctes.append(f"""sd_g{i} AS MATERIALIZED (SELECT * FROM sd_g{i - 1} UNION ALL (
  SELECT z.start, {i - 1} AS position, z.c AS item_id FROM (
    SELECT q.start, q.c, w.w * min(q.d) AS score FROM sd_dist q JOIN sd_g{i - 1} g ON g.start = q.start AND g.item_id = q.o
    JOIN sd_w w ON w.start = q.start AND w.c = q.c GROUP BY q.start, q.c, w.w) z WHERE z.score > 0
  QUALIFY row_number() OVER (PARTITION BY z.start ORDER BY z.score DESC, z.c) = 1))""")
    ctes.append(f"sd_seed AS MATERIALIZED (SELECT start, position, item_id FROM sd_g{k})")
    ctes.append(f"""sd_a0 AS MATERIALIZED (
  SELECT CAST({k} AS BIGINT) AS k, item_id, CAST(item_id % {k} AS INTEGER) AS cluster FROM sd_norm
  UNION ALL
  SELECT CAST(start * {cluster.RUNS} + {k} AS BIGINT) AS k, item_id, CAST(best.j AS INTEGER) AS cluster FROM (
    SELECT s.start, x.item_id, min(struct_pack(d := x.nrm + y.nrm - 2 * coalesce(g.dot, 0), j := s.position)) AS best
    FROM sd_seed s CROSS JOIN sd_norm x JOIN sd_norm y ON y.item_id = s.item_id
    LEFT JOIN (SELECT a.item_id AS c, b.item_id, sum(a.rating * b.rating) AS dot FROM {train} a JOIN {train} b ON a.user_id = b.user_id
               WHERE a.item_id IN (SELECT item_id FROM sd_seed) GROUP BY a.item_id, b.item_id) g
      ON g.c = s.item_id AND g.item_id = x.item_id
    GROUP BY s.start, x.item_id) z)""")
    return ctes


def _restart_ctes() -> list[str]:
    km, assign = OK.kmeans_ctes([M.K_MAIN], M.ORACLE_STEPS, start="sd_a0")
    wc, table = OK.wcss_sql(assign)
    return [*_seed_ctes(M.K_MAIN, STARTS, seeding.ROUNDS, SEED), *km, OK.converged_sql(M.ORACLE_STEPS), *wc]


def _saved_ctes() -> list[str]:
    km, assign = OK.kmeans_ctes([M.K_MAIN], M.ORACLE_STEPS)
    return [*km, f"""sc_s AS MATERIALIZED (SELECT a.cluster, t.user_id, CAST(sum(t.rating) AS BIGINT) AS s
  FROM train t JOIN {assign} a ON a.item_id = t.item_id GROUP BY a.cluster, t.user_id)""",
            f"""sc_c AS MATERIALIZED (SELECT n.cluster, CAST(n.n AS DOUBLE) AS n, CAST(q.q AS DOUBLE) AS q
  FROM (SELECT cluster, count(*) AS n FROM {assign} GROUP BY cluster) n
  JOIN (SELECT cluster, sum(s * s) AS q FROM sc_s GROUP BY cluster) q ON q.cluster = n.cluster)""",
            """sc_x AS MATERIALIZED (SELECT item_id, sum(rating * rating) AS nrm FROM test GROUP BY item_id)""",
            """sc_b AS (SELECT x.item_id, min(struct_pack(d := CAST(floor((CAST(x.nrm AS DOUBLE) - 2.0 * CAST(coalesce(g.dot, 0) AS DOUBLE) / c.n
         + c.q / (c.n * c.n)) * 1000000.0 + 0.5) AS BIGINT), j := c.cluster)) AS best
  FROM sc_x x CROSS JOIN sc_c c LEFT JOIN (SELECT t.item_id, s.cluster, sum(t.rating * s.s) AS dot
    FROM test t JOIN sc_s s ON s.user_id = t.user_id GROUP BY t.item_id, s.cluster) g ON g.item_id = x.item_id AND g.cluster = c.cluster
  GROUP BY x.item_id)"""]


ORACLE = {
    "M1_seeds": with_ctes("SELECT start, position, item_id FROM sd_seed",
                          *M._BASE, *_seed_ctes(M.K_MAIN, STARTS, seeding.ROUNDS, SEED)),
    "M1_restarts": with_ctes(f"""
SELECT CAST(w.k // {cluster.RUNS} AS INTEGER) AS start, {M.K_MAIN} AS k, w.wcss, v.converged,
       row_number() OVER (ORDER BY w.wcss, w.k) = 1 AS best
FROM wc w JOIN km_conv v ON v.k = w.k""", *M._BASE, *_restart_ctes()),
    "S11_saved_clusters": with_ctes("""
SELECT item_id, CAST(best.j AS INTEGER) AS cluster, round(sqrt(greatest(0.0, best.d / 1000000.0)), 6) AS distance FROM sc_b""",
                                    *M._BASE, *_saved_ctes()),
}
