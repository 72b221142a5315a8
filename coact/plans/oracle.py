"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

The SQL is written from the operator semantics, independently of the Spark
code: it spells the reference's own table definitions (grouped log, global
``dense_rank`` windows, ``IN`` sub-selects) directly.  Tables ``lineitem``,
``orders``, ``events``, ``embeddings`` are views over the same parquet files.
Integer sums are cast to BIGINT and anything involving ``ln`` is rounded.
"""

from __future__ import annotations

from coact.plans.catalog import CF_K, CF_Q, EMPTIED_ITEMS

# --- shared CTE fragments -----------------------------------------------------

LOG_ORDERS = """log AS (
  SELECT concat('c', CAST(o_custkey AS VARCHAR)) AS author,
         CAST(l_quantity AS BIGINT) * CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END AS score,
         concat('s', CAST(l_suppkey AS VARCHAR)) AS subreddit
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

LOG_EVENTS = """log AS (
  SELECT concat('u', CAST(user_id AS VARCHAR)) AS author,
         CAST(floor(value) AS BIGINT) * CASE WHEN event_type = 'error' THEN -1 ELSE 1 END AS score,
         concat('k', json_extract_string(props, '$.k')) AS subreddit
  FROM events)"""

PAIRS = """pairs AS (
  SELECT subreddit AS item, author AS "user",
         CAST(sum(sign(score)) AS BIGINT) AS net_votes, CAST(count(score) AS BIGINT) AS comments,
         CAST(sum(score) AS BIGINT) AS net_score, CAST(sum(abs(score)) AS BIGINT) AS abs_score
  FROM log GROUP BY subreddit, author)"""

OCC = """occ AS (
  SELECT * FROM (
    SELECT item, "user", net_votes, comments,
           dense_rank() OVER (ORDER BY "user" DESC) AS uid
    FROM pairs) WHERE net_votes <> 0)"""


def band_ctes(top_n: int, lo: int, hi: int) -> str:
    return f"""top AS (
  SELECT item, activity, item_id FROM (
    SELECT item, activity, row_number() OVER (ORDER BY activity DESC, item) AS item_id
    FROM (SELECT item, CAST(sum(comments) AS BIGINT) AS activity FROM pairs
          WHERE net_votes <> 0 GROUP BY item)) WHERE item_id <= {top_n}),
usr AS (
  SELECT "user", CAST(count(item) AS BIGINT) AS n_items FROM pairs
  WHERE net_votes <> 0 AND item IN (SELECT item FROM top)
  GROUP BY "user" HAVING count(item) BETWEEN {lo} AND {hi}),
pruned AS (
  SELECT * FROM (
    SELECT p.item, p."user", t.item_id, p.net_score, p.abs_score,
           dense_rank() OVER (ORDER BY p."user" DESC) AS uid
    FROM pairs p JOIN top t ON p.item = t.item
    WHERE p."user" IN (SELECT "user" FROM usr)) WHERE net_score <> 0),
m AS (SELECT CAST(item_id - 1 AS BIGINT) AS i, CAST(uid AS BIGINT) AS j,
             CAST(net_score AS DOUBLE) AS value FROM pruned),
names AS (SELECT CAST(item_id - 1 AS BIGINT) AS i, item FROM top)"""


def with_ctes(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


CF_BASE = with_ctes(LOG_ORDERS, PAIRS, band_ctes(CF_Q.top_n, CF_Q.min_items, CF_Q.max_items))
OCC_BASE = with_ctes(LOG_ORDERS, PAIRS, OCC)

COSINE = """dots AS (
  SELECT a.i AS a, b.i AS b, sum(a.value * b.value) AS dot
  FROM m a JOIN m b ON a.j = b.j AND a.i < b.i GROUP BY a.i, b.i),
both_dirs AS (SELECT a AS i, b AS j, dot FROM dots UNION ALL SELECT b AS i, a AS j, dot FROM dots),
norms AS (SELECT i, sqrt(sum(value * value)) AS norm FROM m GROUP BY i),
sim AS (SELECT s.i, s.j, s.dot / ni.norm / nj.norm AS value
        FROM both_dirs s JOIN norms ni ON ni.i = s.i JOIN norms nj ON nj.i = s.j)"""


def top_k_sql(k: int, sim_cte: str = "sim") -> str:
    return f"""SELECT item, related, rk, sim FROM (
  SELECT a.item, b.item AS related, round(s.value, 9) AS sim,
         CAST(row_number() OVER (PARTITION BY a.item ORDER BY round(s.value, 9) DESC, b.item) AS BIGINT) AS rk
  FROM {sim_cte} s JOIN names a ON a.i = s.i JOIN names b ON b.i = s.j
  WHERE s.i <> s.j) WHERE rk <= {k}"""


SQL: dict[str, str] = {}

SQL["item_user_activity"] = OCC_BASE + """SELECT item, "user", net_votes, comments, CAST(uid AS BIGINT) AS uid,
       CAST(dense_rank() OVER (ORDER BY item DESC) AS BIGINT) AS rid FROM occ"""

SQL["most_active_items"] = OCC_BASE + f""", ia AS (
  SELECT item, rid, CAST(sum(comments) AS BIGINT) AS activity FROM (
    SELECT *, dense_rank() OVER (ORDER BY item DESC) AS rid FROM occ) GROUP BY item, rid)
SELECT item, CAST(rid AS BIGINT) AS rid, activity, CAST(ordered_id AS BIGINT) AS ordered_id FROM (
  SELECT *, dense_rank() OVER (ORDER BY activity DESC) AS ordered_id FROM ia)
WHERE ordered_id <= {CF_Q.top_n}"""

SQL["valid_users"] = CF_BASE + """SELECT "user", n_items FROM usr"""
SQL["top_users"] = CF_BASE + """SELECT "user", n_items FROM usr ORDER BY n_items DESC, "user" """
SQL["pruned_activity"] = CF_BASE + """SELECT item, "user", CAST(item_id AS BIGINT) AS item_id, net_score,
       abs_score, CAST(uid AS BIGINT) AS uid FROM pruned"""
SQL["log_of_top_items"] = CF_BASE + """SELECT l.author, l.score, l.subreddit, CAST(t.item_id AS BIGINT) AS item_id
FROM log l JOIN top t ON l.subreddit = t.item"""
SQL["matrix_triples"] = CF_BASE + """SELECT CAST(item_id AS BIGINT) AS item_id, CAST(uid AS BIGINT) AS uid, net_score FROM pruned"""
SQL["frequency_matrix"] = CF_BASE + "SELECT i, j, value FROM m"
SQL["top_k_related"] = CF_BASE + ", " + COSINE + "\n" + top_k_sql(CF_K)


# --- COO layer ---------------------------------------------------------------------

def cf(body: str, *extra: str) -> str:
    """SQL over the CF band tables plus extra CTEs."""
    if extra:
        return CF_BASE + ", " + ",\n".join(extra) + "\n" + body
    return CF_BASE + body


V0 = "v0 AS (SELECT j AS i, value FROM m WHERE i = 0)"
V1 = "v1 AS (SELECT j AS i, value FROM m WHERE i = 1)"
D0 = "CAST(0 AS DOUBLE)"

SQL["matrix_transpose"] = cf("SELECT j AS i, i AS j, value FROM m")
SQL["matrix_identity"] = cf("""SELECT CAST(x AS BIGINT) AS i, CAST(x AS BIGINT) AS j, CAST(1 AS DOUBLE) AS value
FROM (SELECT unnest(range(0, least(max(i) + 1, max(j) + 1))) AS x FROM m)""")
SQL["matrix_densify"] = cf(f"""SELECT c.i, c.j, coalesce(s.value, {D0}) AS value FROM cells c
LEFT JOIN (SELECT i, j, sum(value) AS value FROM m GROUP BY i, j) s ON s.i = c.i AND s.j = c.j""",
    "dims AS (SELECT max(i) + 1 AS nr, max(j) + 1 AS nc FROM m)",
    "cells AS (SELECT r.i, unnest(range(0, d.nc)) AS j FROM (SELECT unnest(range(0, nr)) AS i FROM dims) r, dims d)")
SQL["vector_densify"] = cf(f"""SELECT x.i, coalesce(s.value, {D0}) AS value
FROM (SELECT unnest(range(0, (SELECT max(i) + 1 FROM v0))) AS i) x
LEFT JOIN (SELECT i, sum(value) AS value FROM v0 GROUP BY i) s ON s.i = x.i""", V0)
SQL["matrix_from_dense"] = """SELECT CAST(vec_id AS BIGINT) AS i, CAST(pos - 1 AS BIGINT) AS j,
       round(CAST(v AS DOUBLE), 9) AS value
FROM (SELECT vec_id, unnest(embedding) AS v, unnest(generate_series(1, len(embedding))) AS pos FROM embeddings)
WHERE v <> 0"""
SQL["matrix_nnz"] = cf("SELECT CAST(count(*) AS BIGINT) AS nnz FROM m")
SQL["take_first_n"] = cf("SELECT i, j, value FROM m ORDER BY i, j LIMIT 10")
SQL["matrix_diagonal"] = cf("SELECT i, sum(value * value) AS value FROM m GROUP BY i")
SQL["matrix_row"] = cf("SELECT CAST(0 AS BIGINT) AS i, j, value FROM m WHERE i = 0")

LOG_ENTROPY = [
    "gf AS (SELECT i, sum(abs(value)) AS gf FROM m GROUP BY i)",
    "p AS (SELECT m.i, m.j, m.value / gf.gf AS value FROM m JOIN gf ON gf.i = m.i)",
    "nu AS (SELECT CAST(max(j) + 1 AS DOUBLE) AS n FROM m)",
    "w AS (SELECT i, CAST(1 AS DOUBLE) + sum(-abs(value) * ln(abs(value)) / ln((SELECT n FROM nu))) AS value "
    "FROM p GROUP BY i)",
    "a AS (SELECT m.i, m.j, ln(1 + abs(m.value)) * w.value AS value FROM m JOIN w ON w.i = m.i)",
]
SQL["matrix_nan_count"] = cf("SELECT CAST(count(*) FILTER (WHERE isnan(value)) AS BIGINT) AS nan_count FROM a",
                             *LOG_ENTROPY)
SQL["matrix_drop_first"] = cf("SELECT j - 1 AS i, i - 1 AS j, value FROM m WHERE j >= 1 AND i >= 1")
SQL["matrix_add"] = cf(f"""SELECT coalesce(a.i, t.i) AS i, coalesce(a.j, t.j) AS j,
       coalesce(a.value, {D0}) + coalesce(t.rv, {D0}) AS value
FROM m a FULL OUTER JOIN t ON a.i = t.i AND a.j = t.j""",
    "t AS (SELECT j AS i, i AS j, value * CAST(-2 AS DOUBLE) AS rv FROM m)")
SQL["matrix_hadamard"] = cf("SELECT i, j, round(value * ln(1 + abs(value)), 6) AS value FROM m")
SQL["matrix_row_divide"] = cf("""SELECT m.i, m.j, round(m.value / n.norm, 9) AS value
FROM m JOIN (SELECT i, sqrt(sum(value * value)) AS norm FROM m GROUP BY i) n ON n.i = m.i""")
SQL["matrix_row_scale"] = cf("""SELECT m.i, m.j, m.value * c.cnt AS value
FROM m JOIN (SELECT i, CAST(count(*) AS DOUBLE) AS cnt FROM m GROUP BY i) c ON c.i = m.i""")
MULT = "SELECT a.i, b.i AS j, sum(a.value * b.value) AS value FROM m a JOIN m b ON a.j = b.j GROUP BY a.i, b.i"
SQL["matrix_multiply"] = cf(MULT)
SQL["matrix_multiply_threshold"] = cf(MULT + " HAVING abs(sum(a.value * b.value)) >= 1000")
SQL["matrix_add_constant"] = cf("SELECT i, j, value + CAST(0.5 AS DOUBLE) AS value FROM m")
SQL["matrix_scalar_multiply"] = cf("SELECT i, j, value * CAST(-2 AS DOUBLE) AS value FROM m")
SQL["matrix_map_values"] = cf("SELECT i, j, round(sqrt(abs(value)), 9) AS value FROM m")
SQL["matrix_map_values_udf"] = SQL["matrix_map_values"]
SQL["vector_map_values"] = cf("SELECT i, round(sqrt(sum(value * value)), 9) AS value FROM m GROUP BY i")
SQL["matrix_row_sum"] = cf("SELECT i, sum(value) AS value FROM m GROUP BY i")
SQL["matrix_rows_packed"] = cf("""SELECT j AS i, CAST(count(*) AS BIGINT) AS size,
       string_agg(CAST(i AS VARCHAR), ',' ORDER BY i) AS indices, sum(value) AS val_sum
FROM m GROUP BY j""")
SQL["matrix_shape"] = cf("""SELECT CAST(max(i) + 1 AS BIGINT) AS n_rows, CAST(max(j) + 1 AS BIGINT) AS n_cols,
       CAST(count(*) AS BIGINT) AS nnz FROM m""")
SQL["vector_norm"] = cf("SELECT round(sqrt(sum(value * value)), 9) AS norm FROM m WHERE i = 0")

COLUMN_STD = ("sd AS (SELECT c.i, sqrt(greatest(c.s2 / nn.n - (c.s1 / nn.n) * (c.s1 / nn.n), "
              f"{D0})) AS sd FROM (SELECT i, sum(value) AS s1, sum(value * value) AS s2 FROM m GROUP BY i) c, "
              "(SELECT CAST(max(j) + 1 AS DOUBLE) AS n FROM m) nn)")
SQL["column_std"] = cf("SELECT i, round(sd, 9) AS value FROM sd", COLUMN_STD)
SQL["vector_unit_distance"] = cf(f"""SELECT round(sqrt(sum(d * d)), 9) AS distance FROM (
  SELECT coalesce(a.value / (SELECT n FROM n0), {D0}) - coalesce(b.value / (SELECT n FROM n1), {D0}) AS d
  FROM v0 a FULL OUTER JOIN v1 b ON a.i = b.i)""",
    V0, V1, "n0 AS (SELECT sqrt(sum(value * value)) AS n FROM v0)",
    "n1 AS (SELECT sqrt(sum(value * value)) AS n FROM v1)")
SQL["rows_by_distance"] = cf(f"""SELECT r.i, round((r.rsq + (SELECT s FROM vsq) - 2 * coalesce(d.dot, {D0}))
       / (sqrt(r.rsq) * sqrt((SELECT s FROM vsq))), 9) AS distance
FROM (SELECT i, sum(value * value) AS rsq FROM m GROUP BY i) r
LEFT JOIN (SELECT m.i, sum(m.value * v0.value) AS dot FROM m JOIN v0 ON m.j = v0.i GROUP BY m.i) d ON d.i = r.i""",
    V0, "vsq AS (SELECT sum(value * value) AS s FROM v0)")
SQL["row_coverage_diff"] = cf("SELECT DISTINCT j FROM m EXCEPT SELECT DISTINCT j FROM m WHERE i = 0")
SQL["distinct_users"] = CF_BASE + 'SELECT DISTINCT "user" FROM pairs WHERE net_votes <> 0'
SQL["distinct_item_ids"] = f"SELECT DISTINCT ordered_id FROM ({SQL['most_active_items']})"

# --- weighting -------------------------------------------------------------------------

SQL["global_frequency"] = cf("SELECT i, sum(abs(value)) AS value FROM m GROUP BY i")
SQL["relative_frequency"] = cf("SELECT i, j, round(value, 9) AS value FROM p", *LOG_ENTROPY[:2])
SQL["entropy_weight"] = cf("SELECT i, round(value, 6) AS value FROM w", *LOG_ENTROPY[:4])
SQL["log_frequency"] = cf("SELECT i, j, round(ln(1 + abs(value)), 6) AS value FROM m")
SQL["signed_log_frequency"] = cf("SELECT i, j, round(sign(value) * ln(1 + abs(value)), 6) AS value FROM m")
SQL["log_entropy_matrix"] = cf("SELECT i, j, round(value, 6) AS value FROM a", *LOG_ENTROPY)

# --- similarity variants -------------------------------------------------------------------


def cosine_ctes(src: str, eps: str | None = None, diagonal: bool = False, prefix: str = "") -> list[str]:
    e = f" + {eps}" if eps else ""
    p = prefix
    ctes = [
        f"{p}dots AS (SELECT a.i AS a, b.i AS b, sum(a.value * b.value) AS dot FROM {src} a JOIN {src} b "
        f"ON a.j = b.j AND a.i < b.i GROUP BY a.i, b.i)",
        f"{p}sq AS (SELECT i, sum(value * value) AS sq FROM {src} GROUP BY i)",
        f"{p}both_dirs AS (SELECT a AS i, b AS j, dot FROM {p}dots UNION ALL SELECT b AS i, a AS j, dot FROM {p}dots"
        + (f" UNION ALL SELECT i, i AS j, sq AS dot FROM {p}sq)" if diagonal else ")"),
        f"{p}sim AS (SELECT s.i, s.j, (s.dot{e}) / sqrt(ni.sq{e}) / sqrt(nj.sq{e}) AS value "
        f"FROM {p}both_dirs s JOIN {p}sq ni ON ni.i = s.i JOIN {p}sq nj ON nj.i = s.j)",
    ]
    return ctes


EPS_SQL = "CAST(1e-9 AS DOUBLE)"
SQL["cosine_similarity_items"] = cf("SELECT i, j, round(value, 9) AS value FROM c_sim",
                                    *cosine_ctes("m", prefix="c_"))
SQL["cosine_similarity_users"] = cf("SELECT i, j, round(value, 9) AS value FROM c_sim",
                                    "mt AS (SELECT j AS i, i AS j, value FROM m)",
                                    *cosine_ctes("mt", prefix="c_"))
SQL["similar_users_topk"] = cf(f"""SELECT i, j, rk, sim FROM (
  SELECT i, j, round(value, 9) AS sim,
         row_number() OVER (PARTITION BY i ORDER BY round(value, 9) DESC, j) AS rk
  FROM c_sim WHERE i <> j) WHERE rk <= {CF_K}""",
                               "mt AS (SELECT j AS i, i AS j, value FROM m)", *cosine_ctes("mt", prefix="c_"))
SQL["cosine_similarity_eps"] = cf("SELECT i, j, round(value, 9) AS value FROM c_sim",
                                  *cosine_ctes("m", eps=EPS_SQL, diagonal=True, prefix="c_"))
SQL["std_normalized_matrix"] = cf(f"""SELECT m.j AS i, m.i AS j, round(m.value / ({EPS_SQL} + sd.sd), 9) AS value
FROM m JOIN sd ON sd.i = m.i""", COLUMN_STD)
SQL["related_to_item"] = cf(f"""SELECT * FROM ({top_k_sql(5)})
WHERE item IN (SELECT item FROM top WHERE item_id <= 2 UNION ALL SELECT 'no-such-item')""", COSINE)
SQL["item_dictionary"] = cf("""SELECT CAST(item_id - 1 AS BIGINT) AS i, item, CAST(item_id AS BIGINT) AS item_id
FROM top""")


# --- split, bias, prediction ---------------------------------------------------------------

R_CTE = "R AS (SELECT j AS i, i AS j, value FROM m)"
SPLIT = ("ranked AS (SELECT i, j, value, row_number() OVER (PARTITION BY i ORDER BY "
         "md5(concat_ws('|', '42', CAST(i AS VARCHAR), CAST(j AS VARCHAR))), j) AS rn FROM R WHERE value <> 0)")
SQL["split_test"] = cf("SELECT i, j, value FROM ranked WHERE rn <= 3", R_CTE, SPLIT)
SQL["split_train"] = cf("SELECT i, j, value FROM ranked WHERE rn > 3", R_CTE, SPLIT)
SQL["rating_bias"] = cf("""SELECT 'user' AS kind, i AS id, round(sum(value) / (SELECT CAST(max(j) + 1 AS DOUBLE) FROM R), 9) AS mean
FROM R GROUP BY i
UNION ALL
SELECT 'item' AS kind, j AS id, round(sum(value) / (SELECT CAST(max(i) + 1 AS DOUBLE) FROM R), 9) AS mean
FROM R GROUP BY j""", R_CTE)


def bias_pred(src: str, sim: str, p: str) -> list[str]:
    """CTEs for the bias-corrected row prediction of ``src`` with similarity ``sim``."""
    return [
        f"{p}nc AS (SELECT CAST(max(j) + 1 AS DOUBLE) AS n FROM {src})",
        f"{p}b AS (SELECT i, sum(value) / (SELECT n FROM {p}nc) AS b FROM {src} GROUP BY i)",
        f"{p}a AS (SELECT i, sum(abs(value)) AS a FROM {sim} GROUP BY i)",
        f"{p}sr AS (SELECT s.i, r.j, sum(s.value * r.value) AS sr FROM {sim} s JOIN {src} r ON s.j = r.i "
        f"GROUP BY s.i, r.j)",
        f"{p}sb AS (SELECT s.i, sum(s.value * b.b) AS sb FROM {sim} s JOIN {p}b b ON s.j = b.i GROUP BY s.i)",
        f"{p}cells AS (SELECT i, unnest(range(0, (SELECT CAST(n AS BIGINT) FROM {p}nc))) AS j FROM {p}b)",
        f"{p}pred AS (SELECT c.i, c.j, b.b + (coalesce(sr.sr, {D0}) - coalesce(sb.sb, {D0})) / a.a AS value "
        f"FROM {p}cells c JOIN {p}b b ON b.i = c.i JOIN {p}a a ON a.i = c.i "
        f"LEFT JOIN {p}sb sb ON sb.i = c.i LEFT JOIN {p}sr sr ON sr.i = c.i AND sr.j = c.j)",
    ]


def topk_pred(src: str, sim: str, k: int, p: str) -> list[str]:
    return [
        # entities without a stored similarity rank before the negative ones
        f"{p}nb AS (SELECT i, j, value FROM (SELECT i, j, value, row_number() OVER (PARTITION BY i ORDER BY "
        f"round(value, 9) DESC, j) AS rk, count(*) OVER (PARTITION BY i) AS stored FROM {sim}) "
        f"WHERE rk + CASE WHEN round(value, 9) < 0 THEN (SELECT max(i) + 1 FROM {src}) - stored ELSE 0 END <= {k})",
        f"{p}num AS (SELECT n.i, r.j, sum(n.value * r.value) AS num FROM {p}nb n JOIN {src} r ON n.j = r.i "
        f"GROUP BY n.i, r.j)",
        f"{p}den AS (SELECT i, sum(abs(value)) AS den FROM {p}nb GROUP BY i)",
        f"{p}cells AS (SELECT i, unnest(range(0, (SELECT max(j) + 1 FROM {src}))) AS j "
        f"FROM (SELECT DISTINCT i FROM {src}))",
        f"{p}pred AS (SELECT c.i, c.j, coalesce(num.num, {D0}) / den.den AS value FROM {p}cells c "
        f"JOIN {p}den den ON den.i = c.i LEFT JOIN {p}num num ON num.i = c.i AND num.j = c.j)",
    ]


SQL["predict_bias_corrected_user"] = cf("SELECT i, j, round(value, 6) AS value FROM u_pred",
                                        R_CTE, *cosine_ctes("R", eps=EPS_SQL, diagonal=True, prefix="us_"),
                                        *bias_pred("R", "us_sim", "u_"))
SQL["predict_bias_corrected_item"] = cf("SELECT j AS i, i AS j, round(value, 6) AS value FROM i_pred",
                                        *cosine_ctes("m", eps=EPS_SQL, diagonal=True, prefix="is_"),
                                        *bias_pred("m", "is_sim", "i_"))
SQL["predict_topk_user"] = cf("SELECT i, j, round(value, 6) AS value FROM u_pred",
                              R_CTE, *cosine_ctes("R", eps=EPS_SQL, diagonal=True, prefix="us_"),
                              *topk_pred("R", "us_sim", 40, "u_"))
SQL["predict_topk_item"] = cf("SELECT j AS i, i AS j, round(value, 6) AS value FROM i_pred",
                              *cosine_ctes("m", eps=EPS_SQL, diagonal=True, prefix="is_"),
                              *topk_pred("m", "is_sim", 40, "i_"))
SQL["prediction_mse"] = cf("""SELECT round(avg((p.value - t.value) * (p.value - t.value)), 6) AS mse
FROM (SELECT i, j, value FROM ranked WHERE rn <= 3) t JOIN (SELECT j AS i, i AS j, value FROM t_pred) p
  ON p.i = t.i AND p.j = t.j""", R_CTE, SPLIT,
    "tr AS (SELECT j AS i, i AS j, value FROM ranked WHERE rn > 3)",
    *cosine_ctes("tr", eps=EPS_SQL, diagonal=True, prefix="ts_"), *bias_pred("tr", "ts_sim", "t_"))


# --- serving --------------------------------------------------------------------------------

PROF = f"prof AS ({top_k_sql(CF_K - 1)})"
HIST = ('hist AS (SELECT "user", item AS visited, row_number() OVER (PARTITION BY "user" ORDER BY item) - 1 AS vpos '
        'FROM (SELECT DISTINCT "user", item FROM pruned))')
BAG = ('bag AS (SELECT h."user", h.visited, h.vpos, p.rk - 1 AS rpos, p.related AS candidate '
       'FROM hist h JOIN prof p ON p.item = h.visited)')
COUNTS = 'counts AS (SELECT "user", candidate, CAST(count(*) AS BIGINT) AS copies FROM bag GROUP BY "user", candidate)'
RANKED = ('ranked_bag AS (SELECT "user", CAST(row_number() OVER (PARTITION BY "user" ORDER BY copies DESC, candidate) '
          'AS BIGINT) AS rk, candidate, copies FROM counts)')

SQL["item_profile"] = cf("""SELECT t.item, t.activity, coalesce(string_agg(p.related, ',' ORDER BY p.rk), '') AS related
FROM top t LEFT JOIN prof p ON p.item = t.item GROUP BY t.item, t.activity""", COSINE, PROF)
SQL["user_history"] = cf("""SELECT "user", string_agg(item, ',' ORDER BY item) AS items
FROM (SELECT DISTINCT "user", item FROM pruned) GROUP BY "user" """)
SQL["serving_roundtrip"] = cf("""SELECT h."user", h.item, t.activity, CAST(count(p.related) AS BIGINT) AS n_related
FROM (SELECT DISTINCT "user", item FROM pruned) h JOIN top t ON t.item = h.item
LEFT JOIN prof p ON p.item = h.item GROUP BY h."user", h.item, t.activity""", COSINE, PROF)
SQL["candidate_bag"] = cf('SELECT "user", candidate, copies FROM counts', COSINE, PROF, HIST, BAG, COUNTS)
SQL["recommend_for_user_sampled"] = cf("""SELECT "user", pick, candidate FROM (
  SELECT "user", candidate, CAST(row_number() OVER (PARTITION BY "user" ORDER BY
      md5(concat_ws('|', '42', "user", visited, CAST(rpos AS VARCHAR))), vpos, rpos) AS BIGINT) AS pick
  FROM bag) WHERE pick <= 20""", COSINE, PROF, HIST, BAG)
SQL["recommend_for_user_ranked"] = cf('SELECT "user", rk, candidate, copies FROM ranked_bag WHERE rk <= 20',
                                      COSINE, PROF, HIST, BAG, COUNTS, RANKED)

ITEM_REQ = ("req AS (SELECT item AS request FROM top WHERE item_id <= 2 "
            "UNION ALL SELECT 'no-such-item' UNION ALL SELECT '')")
SQL["related_answer_text"] = cf("""SELECT r.request,
  CASE WHEN t.item IS NOT NULL THEN 'subs related to r/' || r.request || ':' || chr(10) || coalesce(l.txt, '')
       WHEN r.request = '' THEN '' ELSE r.request || ': no such subreddit' END AS answer
FROM req r LEFT JOIN top t ON t.item = r.request
LEFT JOIN (SELECT item, string_agg(related, chr(10) ORDER BY rk) AS txt FROM prof GROUP BY item) l
  ON l.item = r.request""", COSINE, PROF, ITEM_REQ)
SQL["recommend_answer_text"] = cf("""SELECT r.request,
  CASE WHEN l.txt IS NOT NULL THEN 'recommended subs of u/' || r.request || ':' || chr(10) || l.txt
       WHEN r.request = '' THEN '' ELSE r.request || ': no such user' END AS answer
FROM req r LEFT JOIN (SELECT "user", string_agg(candidate, chr(10) ORDER BY rk) AS txt
                      FROM ranked_bag WHERE rk <= 20 GROUP BY "user") l ON l."user" = r.request""",
    COSINE, PROF, HIST, BAG, COUNTS, RANKED,
    'req AS (SELECT * FROM (SELECT "user" AS request FROM usr ORDER BY n_items DESC, "user" LIMIT 2) '
    "UNION ALL SELECT 'no-such-user' UNION ALL SELECT '')")
SQL["related_as_text"] = cf("""SELECT t.item, coalesce(string_agg(p.related, chr(10) ORDER BY p.rk), '') AS text
FROM top t LEFT JOIN prof p ON p.item = t.item GROUP BY t.item""", COSINE, PROF)
SQL["item_link"] = cf("""SELECT item, '<a href="http://reddit.com/r/' || item || '"> r/' || item || ' </a> <br/>' AS link
FROM top""")
SQL["items_of_user"] = cf("""SELECT "user", item, comments FROM pairs
WHERE net_votes <> 0 AND "user" = (SELECT "user" FROM usr ORDER BY n_items DESC, "user" LIMIT 1)""")
SQL["activity_all_users"] = cf("""SELECT p."user", p.item, p.comments, CAST(c.item_id AS BIGINT) AS item_id, c.copies
FROM pairs p JOIN (SELECT item, item_id, CAST(count(*) AS BIGINT) AS copies FROM pruned GROUP BY item, item_id) c
  ON c.item = p.item WHERE p.net_votes <> 0""")
SQL["activity_all_users_semi"] = cf("""SELECT "user", item, comments FROM pairs
WHERE net_votes <> 0 AND item IN (SELECT item FROM pruned)""")


# --- sources and sinks ------------------------------------------------------------------------

SQL["scan_json_log"] = with_ctes(LOG_EVENTS) + "SELECT author, score, subreddit FROM log"
SQL["scan_json_nested"] = "SELECT o_orderkey AS f1, o_orderstatus AS f2, o_custkey AS field4 FROM orders"
SQL["rows_nested_types"] = cf("""SELECT p."user", p.item, CAST(p.net_score AS DOUBLE) AS score, g.n_items,
       g.n_items * 2 AS n_nested, g.n_signs, g.lo, g.hi
FROM pruned p JOIN (SELECT "user", CAST(count(*) AS BIGINT) AS n_items,
                           CAST(count(DISTINCT sign(net_score)) AS BIGINT) AS n_signs,
                           CAST(min(item_id) AS BIGINT) AS lo, CAST(max(item_id) AS BIGINT) AS hi
                    FROM pruned GROUP BY "user") g ON g."user" = p."user" """)
SQL["scan_delimited_text"] = "SELECT c_name AS name, c_nationkey AS age FROM customer"
SQL["sql_range_filter"] = "SELECT c_name AS name FROM customer WHERE c_nationkey >= 13 AND c_nationkey <= 19"
SQL["string_projection"] = ("SELECT 'Name: ' || c_name AS text FROM customer "
                            "WHERE c_nationkey >= 13 AND c_nationkey <= 19")
SQL["scan_csv_ratings"] = cf("SELECT j AS i, i AS j, value FROM m")
SQL["scan_csv_users"] = cf('SELECT DISTINCT CAST(i AS BIGINT) AS "user" FROM ranked WHERE rn <= 3', R_CTE, SPLIT)
SQL["seen_items_by_user"] = cf("""SELECT CAST(i AS BIGINT) AS "user", string_agg(CAST(j AS VARCHAR), ',' ORDER BY j) AS items
FROM ranked WHERE rn > 3 GROUP BY i""", R_CTE, SPLIT)
SQL["parquet_roundtrip"] = SQL["pruned_activity"]


# --- CF batch, model comparison, CF recommendations, vector neighbours, SVD energy --------------

from coact.plans.cf import CF_BAND  # noqa: E402
from coact.plans.catalog import LSA_K_Q, LSA_Q  # noqa: E402

CF_BATCH_BASE = with_ctes(LOG_ORDERS, PAIRS, band_ctes(CF_BAND.top_n, CF_BAND.min_items, CF_BAND.max_items))
SQL["cf_batch"] = CF_BATCH_BASE + ", " + ",\n".join([COSINE, PROF]) + """
SELECT t.item, t.activity, coalesce(string_agg(p.related, ',' ORDER BY p.rk), '') AS related
FROM top t LEFT JOIN prof p ON p.item = t.item GROUP BY t.item, t.activity"""


def _topk_model(name: str, sim: str) -> str:
    return f"""SELECT '{name}' AS model, * FROM ({top_k_sql(CF_K, sim)})
WHERE item IN (SELECT item FROM top WHERE item_id = 1)"""


STD_SPLIT = [
    R_CTE, COLUMN_STD,
    f"sn AS (SELECT m.j AS i, m.i AS j, m.value / ({EPS_SQL} + sd.sd) AS value FROM m JOIN sd ON sd.i = m.i)",
    "snr AS (SELECT i, j, value, row_number() OVER (PARTITION BY i ORDER BY "
    "md5(concat_ws('|', '42', CAST(i AS VARCHAR), CAST(j AS VARCHAR))), j) AS rn FROM sn WHERE value <> 0)",
    "snt AS (SELECT j AS i, i AS j, value FROM snr WHERE rn > 3)",
]
SQL["compare_models"] = cf("\nUNION ALL\n".join([
    _topk_model("cf", "c_sim"), _topk_model("cf_eps", "e_sim"), _topk_model("cf_std", "s_sim")]),
    *cosine_ctes("m", prefix="c_"), *cosine_ctes("m", eps=EPS_SQL, prefix="e_"),
    *STD_SPLIT, *cosine_ctes("snt", eps=EPS_SQL, diagonal=True, prefix="s_"))

SQL["recommend_unseen"] = cf("""SELECT uid, CAST(rk AS BIGINT) AS rk, item, score FROM (
  SELECT uid, item, score, row_number() OVER (PARTITION BY uid ORDER BY rk0) AS rk FROM r250 t
  WHERE NOT EXISTS (SELECT 1 FROM R WHERE R.i = t.uid AND R.j = t.j)) WHERE rk <= 5""",
    R_CTE, *cosine_ctes("m", prefix="c_"),
    "sc AS (SELECT r.i AS uid, s.j, round(sum(r.value * s.value), 6) AS score FROM R r JOIN c_sim s ON r.j = s.i "
    "GROUP BY r.i, s.j)",
    "r250 AS (SELECT * FROM (SELECT sc.uid, sc.j, n.item, sc.score, row_number() OVER (PARTITION BY sc.uid "
    "ORDER BY sc.score DESC, n.item) AS rk0 FROM sc JOIN names n ON n.i = sc.j) WHERE rk0 <= 250)")

SQL["vector_neighbors"] = """WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
q AS (SELECT e AS q FROM e ORDER BY vec_id LIMIT 1)
SELECT vec_id, round(list_dot_product(e, q) / (sqrt(list_dot_product(e, e)) * sqrt(list_dot_product(q, q))), 6) AS sim
FROM e, q ORDER BY sim DESC, vec_id"""

LSA_BASE = with_ctes(LOG_ORDERS, PAIRS, band_ctes(LSA_Q.top_n, LSA_Q.min_items, LSA_Q.max_items))
SQL["svd_energy"] = LSA_BASE + ", " + ",\n".join(LOG_ENTROPY) + "\nSELECT round(sum(value * value), 4) AS energy FROM a"


# --- flagship over the events adapter ---------------------------------------------------------

from coact.plans.catalog import EVENTS_Q  # noqa: E402

SQL["top_k_related_events"] = (with_ctes(LOG_EVENTS, PAIRS, band_ctes(EVENTS_Q.top_n, EVENTS_Q.min_items,
                                                                      EVENTS_Q.max_items))
                               + ", " + COSINE + "\n" + top_k_sql(CF_K))

# With a rank that is at least the number of items (100 at sf0.01, rank 300) the scaled
# factors have the products and cosines of the weighted rows themselves.
_GRAM = """g AS (SELECT x.i AS i, y.i AS j, sum(x.value * y.value) AS dot
  FROM a x JOIN a y ON x.j = y.j GROUP BY x.i, y.i)"""
_LATENT_TOP = """SELECT i, j, rk, round(sim, {digits}) AS sim FROM (
  SELECT i, j, sim, row_number() OVER (PARTITION BY i ORDER BY sim DESC, j) AS rk
  FROM (SELECT g.i, g.j, round({sim}, 9) AS sim FROM g JOIN g p ON p.i = g.i AND p.j = g.i
        JOIN g q ON q.i = g.j AND q.j = g.j WHERE g.i <> g.j AND p.dot > 0 AND q.dot > 0)) WHERE rk <= {k}"""
# items that share no user have similarity 0 in the latent space and are ranked too
_PAIRS0 = """ids AS (SELECT DISTINCT i FROM a),
g AS (SELECT x.i AS i, y.i AS j, coalesce(h.dot, 0) AS dot FROM ids x CROSS JOIN ids y
  LEFT JOIN g0 h ON h.i = x.i AND h.j = y.i)"""
_G0 = _GRAM.replace("g AS", "g0 AS", 1)
for _key, _sim, _digits in (("latent_similarity_plain", "g.dot", 4),
                            ("latent_similarity_scaled", "g.dot / sqrt(p.dot) / sqrt(q.dot)", 6)):
    SQL[_key] = (LSA_BASE + ", " + ",\n".join([*LOG_ENTROPY, _G0, _PAIRS0]) + "\n"
                 + _LATENT_TOP.format(sim=_sim, digits=_digits, k=LSA_K_Q))

# Power iteration on the Gram matrix of the items, 60 steps from a vector of ones.
SQL["leading_singular_vectors"] = (LSA_BASE.replace("WITH ", "WITH RECURSIVE ", 1) + ", "
                                   + ",\n".join([*LOG_ENTROPY, _GRAM]) + """,
steps AS (
  SELECT 0 AS t, i, CAST(1 AS DOUBLE) AS x FROM (SELECT DISTINCT i FROM g)
  UNION ALL
  SELECT t, i, y / sqrt(sum(y * y) OVER ()) AS x FROM (
    SELECT s.t + 1 AS t, g.i, sum(g.dot * s.x) AS y FROM steps s JOIN g ON g.j = s.i
    WHERE s.t < 60 GROUP BY s.t + 1, g.i)),
u AS (SELECT i, x FROM steps WHERE t = 60),
prod AS (SELECT a.j, sum(a.value * u.x) AS y FROM a JOIN u ON u.i = a.i GROUP BY a.j),
sg AS (SELECT sqrt(sum(y * y)) AS sigma FROM prod)
SELECT 'item' AS side, CAST(i AS BIGINT) AS id, round(x, 6) AS value, round(sigma, 6) AS sigma FROM u, sg
UNION ALL
SELECT 'user', CAST(j AS BIGINT), round(y / sigma, 6), round(sigma, 6) FROM prod, sg""")

SQL["vector_from_dense"] = """SELECT CAST(pos - 1 AS BIGINT) AS i, round(CAST(v AS DOUBLE), 9) AS value
FROM (SELECT unnest(embedding) AS v, unnest(generate_series(1, len(embedding))) AS pos
      FROM (SELECT embedding FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
            ORDER BY vec_id LIMIT 1)) WHERE v <> 0"""

SQL["related_with_epsilon"] = cf(top_k_sql(CF_K, "e_sim"), """n2 AS (SELECT i, sum(value * value) AS sq FROM m GROUP BY i)""",
                                 """own AS (SELECT x.i AS i, y.i AS j, sum(x.value * y.value) AS dot
  FROM m x JOIN m y ON x.j = y.j WHERE x.i < 2 GROUP BY x.i, y.i)""",
                                 """e_sim AS (SELECT a.i, b.i AS j, (coalesce(o.dot, 0) + 1.0) / sqrt(a.sq + 1.0) / sqrt(b.sq + 1.0) AS value
  FROM n2 a CROSS JOIN n2 b LEFT JOIN own o ON o.i = a.i AND o.j = b.i WHERE a.i < 2)""")

# --- keyed serving tables ------------------------------------------------------------------------

SQL["serving_requests"] = cf("""SELECT concat('c', CAST(c_custkey AS VARCHAR)) AS "user", h.items FROM customer LEFT JOIN (
  SELECT "user", string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT "user", item FROM pruned) GROUP BY "user") h
  ON h."user" = concat('c', CAST(c_custkey AS VARCHAR))""")
_PROFILE_TEXT = """text AS (SELECT t.item, t.item_id, t.activity, coalesce(string_agg(p.related, ',' ORDER BY p.rk), '') AS related
FROM top t LEFT JOIN prof p ON p.item = t.item GROUP BY t.item, t.item_id, t.activity)"""
SQL["serving_lookup"] = cf("SELECT item, activity, related FROM text WHERE item_id <= 3", COSINE, PROF, _PROFILE_TEXT)
SQL["serving_insert_empty"] = cf(f"""SELECT item, activity, related FROM text WHERE item_id > {EMPTIED_ITEMS}
UNION ALL SELECT item, activity, '' FROM text WHERE item_id = {EMPTIED_ITEMS}
UNION ALL SELECT item, CAST(sum(comments) AS BIGINT), '' FROM ev_pairs WHERE net_votes <> 0 GROUP BY item""",
                                 COSINE, PROF, _PROFILE_TEXT, LOG_EVENTS.replace("log AS", "ev_log AS", 1),
                                 PAIRS.replace("pairs AS", "ev_pairs AS", 1).replace("FROM log", "FROM ev_log"))

SQL["vector_neighbors_topk"] = f"""WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
n AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS n FROM e)
SELECT request, rk, vec_id, round(sim, 6) AS sim FROM (
  SELECT request, vec_id, sim, row_number() OVER (PARTITION BY request ORDER BY sim DESC, vec_id) AS rk FROM (
    SELECT q.vec_id AS request, n.vec_id, round(list_dot_product(n.e, q.e) / (n.n * q.n), 9) AS sim
    FROM n q JOIN n ON n.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0 AND q.n > 0 AND n.n > 0)) WHERE rk <= {CF_K}"""
