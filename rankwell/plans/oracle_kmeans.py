"""DuckDB oracle SQL for the deterministic K-Means (unrolled Lloyd steps).

Generated from the same k values and step count as the Spark run; all k run
side by side in long form (one row per (k, item) assignment), so each step is
three MATERIALIZED CTEs whatever the number of k.  The arithmetic is the
engine's: exact integer sums, distance = nrm − 2·dot/n + q/n², quantized as
floor(x·1e6 + 0.5), argmin = min over (dist, j) pairs.  Running more steps than the
engine needed is harmless: a stable assignment reproduces itself.  The
emptied-cluster rule is not expressed here, so a run that hits it shows up as
a mismatch rather than passing silently.
"""

from __future__ import annotations


def kmeans_ctes(ks, steps: int, train: str = "train", tag: str = "", start: str | None = None) -> tuple[list[str], str]:
    """CTE list ending in assignment ``km{tag}_a{steps}`` with columns (k, item_id, cluster); ``start`` names a first
    assignment of the same columns (its k are all runs), else it is the modulo rule."""
    ks = [ks] if isinstance(ks, int) else list(ks)
    p = f"km{tag}"
    kv = ", ".join(f"({k})" for k in ks)
    ctes = [f"""{p}_norm AS MATERIALIZED (SELECT item_id, CAST(sum(rating * rating) AS BIGINT) AS nrm
  FROM {train} GROUP BY item_id)""",
            f"{p}_ks AS MATERIALIZED (SELECT * FROM (VALUES {kv}) v(k))",
            f"""{p}_a0 AS MATERIALIZED (SELECT ks.k, x.item_id, CAST(x.item_id % ks.k AS INTEGER) AS cluster
  FROM {p}_norm x CROSS JOIN {p}_ks ks)""" if start is None else f"{p}_a0 AS MATERIALIZED (SELECT * FROM {start})"]
    for s in range(1, steps + 1):
        prev = f"{p}_a{s - 1}"
        ctes.append(f"""{p}_s{s} AS MATERIALIZED (
  SELECT a.k, t.user_id, a.cluster, CAST(sum(t.rating) AS BIGINT) AS s
  FROM {train} t JOIN {prev} a ON t.item_id = a.item_id GROUP BY a.k, t.user_id, a.cluster)""")
        ctes.append(f"""{p}_c{s} AS MATERIALIZED (
  SELECT n.k, n.cluster, CAST(n.n AS DOUBLE) AS n, CAST(coalesce(q.q, 0) AS DOUBLE) AS q
  FROM (SELECT k, cluster, count(*) AS n FROM {prev} GROUP BY k, cluster) n
  LEFT JOIN (SELECT k, cluster, sum(s * s) AS q FROM {p}_s{s} GROUP BY k, cluster) q
    ON n.k = q.k AND n.cluster = q.cluster)""")
        ctes.append(f"""{p}_a{s} AS MATERIALIZED (
  SELECT k, item_id, CAST(best.j AS INTEGER) AS cluster, best.d AS d FROM (
    SELECT c.k, x.item_id, min(struct_pack(
           d := CAST(floor((CAST(x.nrm AS DOUBLE) - 2.0 * CAST(coalesce(d.dot, 0) AS DOUBLE) / c.n + c.q / (c.n * c.n))
                     * 1000000.0 + 0.5) AS BIGINT), j := c.cluster)) AS best
    FROM {p}_norm x CROSS JOIN {p}_c{s} c
    LEFT JOIN (SELECT t.item_id, sc.k, sc.cluster, CAST(sum(t.rating * sc.s) AS BIGINT) AS dot
               FROM {train} t JOIN {p}_s{s} sc ON t.user_id = sc.user_id
               GROUP BY t.item_id, sc.k, sc.cluster) d
      ON d.item_id = x.item_id AND d.k = c.k AND d.cluster = c.cluster
    WHERE c.n > 0 GROUP BY c.k, x.item_id) z)""")
    return ctes, f"{p}_a{steps}"


def assignment_of(assign: str, k: int) -> str:
    """SQL expression for the (item_id, cluster) assignment of one k."""
    return f"(SELECT item_id, cluster FROM {assign} WHERE k = {k})"


def converged_sql(steps: int, tag: str = "") -> str:
    """CTE (k, converged): whether the last two steps agree."""
    p = f"km{tag}"
    return f"""{p}_conv AS (SELECT a.k, count(*) FILTER (WHERE a.cluster <> b.cluster) = 0 AS converged
  FROM {p}_a{steps} a JOIN {p}_a{steps - 1} b ON a.k = b.k AND a.item_id = b.item_id GROUP BY a.k)"""


def wcss_sql(assign: str, train: str = "train", tag: str = "") -> tuple[list[str], str]:
    """WCSS per k of a long-form assignment: Σ_j (N_j − Q_j / n_j); CTE with (k, wcss)."""
    p = f"wc{tag}"
    ctes = [f"""{p}_j AS MATERIALIZED (
  SELECT a.k, a.cluster, count(*) AS n, sum(x.nrm) AS nn
  FROM {assign} a JOIN km{tag}_norm x ON a.item_id = x.item_id GROUP BY a.k, a.cluster)""",
            f"""{p}_q AS MATERIALIZED (
  SELECT k, cluster, sum(s * s) AS q FROM (
    SELECT a.k, t.user_id, a.cluster, sum(t.rating) AS s
    FROM {train} t JOIN {assign} a ON t.item_id = a.item_id GROUP BY a.k, t.user_id, a.cluster)
  GROUP BY k, cluster)""",
            f"""{p} AS (SELECT j.k, round(sum(CAST(j.nn AS DOUBLE) - CAST(q.q AS DOUBLE) / CAST(j.n AS DOUBLE)), 2) AS wcss
  FROM {p}_j j JOIN {p}_q q ON j.k = q.k AND j.cluster = q.cluster GROUP BY j.k)"""]
    return ctes, p
