"""DuckDB SQL oracles, one per catalogue query, over the pre-registered
views ``region nation customer supplier part orders lineitem events
documents embeddings pages benchmark labels conversations``.

Iterative algorithms are unrolled: the text is generated with one CTE per
round.  Floating results are rounded the same way in both engines.
"""

from __future__ import annotations

import math

from lodestar.functions.hashing import CMS_PARAMS, CMS_PRIME, uniform01_sql

# Java whitespace split of a line with trailing blanks removed (F1).
_SPLIT = r"string_split_regex(regexp_replace({c}, '\s+$', '', 'g'), '\s+')"

_BASKET_ITEMS = r"""
  items AS (SELECT DISTINCT conv_id, turn, item
            FROM (SELECT conv_id, turn, unnest(string_split_regex(text, '\s+')) AS item
                  FROM conversations)
            WHERE item <> ''),
  th AS (SELECT greatest(2, ceil(0.186 * count(*)))::BIGINT AS s FROM conversations),
  fi AS (SELECT item, count(*) AS n FROM items GROUP BY item
         HAVING count(*) >= (SELECT s FROM th)),
  fo AS (SELECT * FROM items WHERE item IN (SELECT item FROM fi)),
  fp AS (SELECT x.item AS item_a, y.item AS item_b, count(*) AS n
         FROM fo x JOIN fo y ON x.conv_id = y.conv_id AND x.turn = y.turn AND x.item < y.item
         GROUP BY 1, 2 HAVING count(*) >= (SELECT s FROM th)),
  ft AS (SELECT x.item AS item_a, y.item AS item_b, z.item AS item_c, count(*) AS n
         FROM fo x
         JOIN fo y ON x.conv_id = y.conv_id AND x.turn = y.turn AND x.item < y.item
         JOIN fo z ON x.conv_id = z.conv_id AND x.turn = z.turn AND y.item < z.item
         GROUP BY 1, 2, 3 HAVING count(*) >= (SELECT s FROM th))
"""

def _itemsets(levels: int = 10) -> str:
    """All frequent itemsets, level k grown from frequent (k-1)-prefixes."""
    ctes = ["o1 AS (SELECT conv_id, turn, item AS i1 FROM fo)"]
    sel = ["SELECT item AS items, 1 AS size, n FROM fi"]
    for k in range(2, levels + 1):
        prev = ", ".join(f"o.i{j}" for j in range(1, k))
        keys = ", ".join(f"i{j}" for j in range(1, k + 1))
        ctes.append(f"""o{k}x AS (SELECT o.conv_id, o.turn, {prev}, f.item AS i{k}
           FROM o{k - 1} o JOIN fo f ON f.conv_id = o.conv_id AND f.turn = o.turn
                                   AND f.item > o.i{k - 1}),
  L{k} AS (SELECT {keys}, count(*) AS n FROM o{k}x GROUP BY {keys}
           HAVING count(*) >= (SELECT s FROM th)),
  o{k} AS (SELECT o{k}x.* FROM o{k}x JOIN L{k} USING ({keys}))""")
        sel.append(f"SELECT concat_ws(',', {keys}) AS items, {k} AS size, n FROM L{k}")
    return (f"WITH {_BASKET_ITEMS},\n  " + ",\n  ".join(ctes) + "\n" +
            "\nUNION ALL ".join(sel))


ORACLES: dict[str, str] = {
    "word_count": f"""
        SELECT token, count(*) AS n
        FROM (SELECT unnest({_SPLIT.format(c='text')}) AS token FROM documents)
        GROUP BY token""",
    "first_letter_count": f"""
        SELECT letter, count(*) AS n
        FROM (SELECT lower(substr(regexp_replace(token, '[^A-Za-z]', '', 'g'), 1, 1)) AS letter
              FROM (SELECT unnest({_SPLIT.format(c='text')}) AS token FROM documents))
        WHERE letter <> ''
        GROUP BY letter""",
    "distinct_count_per_key": """
        SELECT user_id, count(DISTINCT CAST(CAST(ts AS DATE) AS VARCHAR) || event_type) AS n
        FROM events GROUP BY user_id""",
    "item_support": f"WITH {_BASKET_ITEMS} SELECT item, n FROM fi",
    "pair_support": f"WITH {_BASKET_ITEMS} SELECT item_a, item_b, n FROM fp",
    "order_pair_support": """
        WITH o AS (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem)
        SELECT x.l_partkey AS item_a, y.l_partkey AS item_b, count(*) AS n
        FROM o x JOIN o y ON x.l_orderkey = y.l_orderkey AND x.l_partkey < y.l_partkey
        GROUP BY 1, 2 HAVING count(*) >= 2""",
    "pair_rules": f"""WITH {_BASKET_ITEMS}
        SELECT lhs || '->' || rhs AS rule, lhs, rhs, r.n, r.n / fi.n AS confidence
        FROM (SELECT item_a AS lhs, item_b AS rhs, n FROM fp
              UNION ALL SELECT item_b, item_a, n FROM fp) r
        JOIN fi ON fi.item = r.lhs""",
    "triple_support": f"WITH {_BASKET_ITEMS} SELECT item_a, item_b, item_c, n FROM ft",
    "frequent_itemsets": _itemsets(10),
    "triple_rules": f"""WITH {_BASKET_ITEMS}
        SELECT x || ',' || y || '->' || z AS rule, r.n, r.n / fp.n AS confidence
        FROM (SELECT item_a AS x, item_b AS y, item_c AS z, n FROM ft
              UNION ALL SELECT item_a, item_c, item_b, n FROM ft
              UNION ALL SELECT item_b, item_c, item_a, n FROM ft) r
        JOIN fp ON fp.item_a = r.x AND fp.item_b = r.y""",
}


# -- graphs -----------------------------------------------------------------

RANK_DIGITS = 10


def _graph(event_type: str | None = None) -> str:
    where = f"WHERE event_type = '{event_type}'" if event_type else ""
    return f"""
  ev AS (SELECT user_id, lead(user_id) OVER (ORDER BY ts, event_id) AS nxt
         FROM events {where}),
  g AS (SELECT DISTINCT user_id AS src, nxt AS dst FROM ev
        WHERE nxt IS NOT NULL AND nxt <> user_id)"""


def _friends(cond: str) -> str:
    return f"""WITH {_graph()},
  adj AS (SELECT src, dst FROM g UNION SELECT dst, src FROM g),
  users AS (SELECT DISTINCT src AS user_id FROM adj),
  cand AS (SELECT a.dst AS user_id, b.dst AS candidate, count(*) AS n
           FROM adj a JOIN adj b ON a.src = b.src AND {cond}
           WHERE NOT EXISTS (SELECT 1 FROM adj d WHERE d.src = a.dst AND d.dst = b.dst)
           GROUP BY 1, 2),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, candidate)
             AS rank FROM cand)"""


def _pagerank_edge(rounds: int = 10, d: float = 0.85) -> str:
    ctes = [f"""WITH {_graph(None)},
  od AS (SELECT src, count(*) AS deg FROM g GROUP BY src),
  lw AS (SELECT g.src, g.dst, 1.0::DOUBLE / od.deg AS w FROM g JOIN od USING (src)),
  nn AS (SELECT count(*)::DOUBLE AS n FROM od),
  r0 AS (SELECT src AS page, 1.0::DOUBLE / (SELECT n FROM nn) AS rank FROM od)"""]
    for i in range(1, rounds + 1):
        ctes.append(f"""
  r{i} AS (SELECT lw.dst AS page,
                  sum(r.rank * lw.w) * {d!r}::DOUBLE + {1.0 - d!r}::DOUBLE / (SELECT n FROM nn) AS rank
           FROM lw JOIN r{i - 1} r ON lw.src = r.page GROUP BY lw.dst)""")
    return ",".join(ctes) + f"\nSELECT page, round(rank, {RANK_DIGITS}) AS rank FROM r{rounds}"


def significant_sql(x: str, digits: int = 12) -> str:
    """``functions.vectors.significant`` as SQL."""
    scale = f"pow(10.0, {digits - 1} - floor(log10(abs({x}))))"
    return f"CASE WHEN {x} = 0 THEN {x} ELSE round({x} * {scale}) / {scale} END"


def _pagerank_power_ctes(rounds: int = 40, beta: float = 0.8) -> str:
    ctes = [f"""WITH {_graph(None)},
  nodes AS (SELECT src AS page FROM g UNION SELECT dst FROM g),
  nn AS (SELECT count(*)::DOUBLE AS n FROM nodes),
  od AS (SELECT src, count(*) AS deg FROM g GROUP BY src),
  lw AS (SELECT g.src, g.dst, 1.0::DOUBLE / od.deg AS w FROM g JOIN od USING (src)),
  r0 AS (SELECT page, 1.0::DOUBLE / (SELECT n FROM nn) AS rank FROM nodes)"""]
    for i in range(1, rounds + 1):
        ctes.append(f"""
  r{i} AS (SELECT nodes.page,
                  {1.0 - beta!r}::DOUBLE / (SELECT n FROM nn) + {beta!r}::DOUBLE * coalesce(c.s, 0.0) AS rank
           FROM nodes LEFT JOIN (SELECT lw.dst, sum(r.rank * lw.w) AS s
                                 FROM lw JOIN r{i - 1} r ON lw.src = r.page GROUP BY lw.dst) c
                ON c.dst = nodes.page)""")
    return ",".join(ctes) + f""",
  pr AS (SELECT page, round(rank, {RANK_DIGITS}) AS rank FROM r{rounds})"""


def _hits(rounds: int = 40) -> str:
    ctes = [f"""WITH {_graph(None)},
  nodes AS (SELECT src AS page FROM g UNION SELECT dst FROM g),
  h0 AS (SELECT page, 1.0::DOUBLE AS s FROM nodes)"""]
    for i in range(1, rounds + 1):
        ctes.append(f"""
  ar{i} AS (SELECT nodes.page, coalesce(c.s, 0.0) AS s FROM nodes LEFT JOIN
            (SELECT g.dst, sum(h.s) AS s FROM g JOIN h{i - 1} h ON g.src = h.page GROUP BY g.dst) c
            ON c.dst = nodes.page),
  a{i} AS (SELECT page, s / (SELECT max(s) FROM ar{i}) AS s FROM ar{i}),
  hr{i} AS (SELECT nodes.page, coalesce(c.s, 0.0) AS s FROM nodes LEFT JOIN
            (SELECT g.src, sum(a.s) AS s FROM g JOIN a{i} a ON g.dst = a.page GROUP BY g.src) c
            ON c.src = nodes.page),
  h{i} AS (SELECT page, s / (SELECT max(s) FROM hr{i}) AS s FROM hr{i})""")
    return ",".join(ctes) + f"""
SELECT h.page, round(h.s, {RANK_DIGITS}) AS hub, round(a.s, {RANK_DIGITS}) AS authority
FROM h{rounds} h JOIN a{rounds} a USING (page)"""


ORACLES.update({
    "friends_symmetric": _friends("a.dst <> b.dst") + """
SELECT u.user_id, r.candidate, r.n, r.rank
FROM users u LEFT JOIN ranked r ON r.user_id = u.user_id AND r.rank <= 10""",
    "friends_list_order": _friends("a.dst < b.dst") + """
SELECT u.user_id, coalesce(string_agg(CAST(r.candidate AS VARCHAR), ',' ORDER BY r.rank), '') AS recs
FROM users u LEFT JOIN ranked r ON r.user_id = u.user_id AND r.rank <= 10
GROUP BY u.user_id""",
    "pagerank_edge": _pagerank_edge(10, 0.85),
    "pagerank_power": _pagerank_power_ctes(40, 0.8) + "\nSELECT page, rank FROM pr",
    "hits_scores": _hits(40),
    "pagerank_packed": _pagerank_power_ctes(10, 0.8) + "\nSELECT page, rank FROM pr",
    "hits_packed": _hits(10),
    "rank_extremes": _pagerank_power_ctes(40, 0.8) + f""",
  px AS (SELECT page, {significant_sql('rank')} AS rank FROM r40)
SELECT 'bottom' AS side, row_number() OVER (ORDER BY rank, page) AS pos, page
FROM (SELECT * FROM px ORDER BY rank, page LIMIT 5)
UNION ALL
SELECT 'top' AS side, 6 - row_number() OVER (ORDER BY rank DESC, page DESC) AS pos, page
FROM (SELECT * FROM px ORDER BY rank DESC, page DESC LIMIT 5)""",
})


# -- k-means and SVM --------------------------------------------------------

_PTS = """
  pts AS (SELECT vec_id, unnest(range(0, len(embedding))) AS d,
                 CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings)"""

_DIST = {"l2": "(p.x - c.c) * (p.x - c.c)", "l1": "abs(p.x - c.c)"}


def _assign_cte(i: int, dist: str) -> str:
    return f"""
  d{i} AS (SELECT p.vec_id, c.cluster, sum({_DIST[dist]}) AS dist
           FROM pts p JOIN c{i} c ON p.d = c.d GROUP BY 1, 2),
  a{i} AS (SELECT vec_id, cluster, dist FROM
           (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY dist, cluster) AS rn
            FROM d{i}) WHERE rn = 1)"""


def _kmeans_assign(dist: str) -> str:
    return f"""WITH {_PTS},
  c0 AS (SELECT vec_id AS cluster, d, x AS c FROM pts WHERE vec_id BETWEEN 0 AND 9),
  {_assign_cte(0, dist)}
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, round(dist, 6) AS dist FROM a0"""


def _kmeans_fit(rounds: int, centers: bool = False, dist: str = "l2") -> str:
    ctes = [f"""WITH {_PTS},
  c0 AS (SELECT vec_id AS cluster, d, x AS c FROM pts WHERE vec_id BETWEEN 0 AND 9)"""]
    for i in range(rounds):
        ctes.append(_assign_cte(i, dist).replace(" AS (", " AS MATERIALIZED ("))
        if i < rounds - 1 or centers:
            ctes.append(f"""
  c{i + 1} AS MATERIALIZED (SELECT a.cluster, p.d, sum(p.x) / count(*) AS c
             FROM a{i} a JOIN pts p USING (vec_id) GROUP BY 1, 2
             UNION ALL SELECT * FROM c{i} WHERE cluster NOT IN (SELECT cluster FROM a{i}))""")
    if centers:
        return ",".join(ctes) + (f"\nSELECT CAST(cluster AS INTEGER) AS cluster, CAST(d AS INTEGER)"
                                 f" AS dim, round(c, 6) AS value FROM c{rounds}")
    body = "\nUNION ALL ".join(f"SELECT {i} AS iteration, round(sum(dist), 6) AS loss FROM a{i}"
                               for i in range(rounds))
    return ",".join(ctes) + "\n" + body


_SVM_ROWS = """
  yrows AS (SELECT vec_id, CASE WHEN label < 5 THEN 1 ELSE -1 END AS y FROM embeddings)"""


SVM_DIM = 64


def _svm_fit(out: str, lr: float, stop: float, most: int, batch_size: int | None = None) -> str:
    """The rounds as a recursion: a row has the model after round k, and the
    cost and change of that round. ``out``: history or model."""
    viol = "(m < 1" + (f" AND batch = k % n_batches)" if batch_size else ")")
    place = (f"(row_number() OVER (ORDER BY (vec_id * 48271) % 2147483647, vec_id) - 1) // {batch_size}" if batch_size else "0")
    batches = f"CAST(ceil(count(*) / {batch_size}) AS BIGINT)" if batch_size else "max(1)"
    grad = ", ".join(f"coalesce(sum(CASE WHEN {viol} THEN -y * x[{d}] END), 0.0)" for d in range(1, SVM_DIM + 1))
    zeros = ", ".join(["CAST(0.0 AS DOUBLE)"] * SVM_DIM)
    step = ", ".join(f"w[{d}] - {lr!r} * (w[{d}] + 100.0 * g[{d}])" for d in range(1, SVM_DIM + 1))
    pct = "abs(prev - cost) * 100.0 / prev"
    change = f"0.5 * coalesce(before, 0.0) + 0.5 * {pct}" if batch_size else pct
    name = "smoothed" if batch_size else "pct_change"
    history = f"""
SELECT CAST(k AS INTEGER) AS iteration, round(cost, 3) AS cost, round(change, 6) AS {name} FROM fit WHERE k >= 0"""
    model = """,
  final AS (SELECT w, b FROM fit ORDER BY k DESC LIMIT 1)
SELECT CAST(unnest(range(len(w))) AS INTEGER) AS dim, round(unnest(w), 6) AS value FROM final
UNION ALL SELECT -1, round(b, 6) FROM final"""
    return f"""WITH RECURSIVE rows AS (
    SELECT CAST(embedding AS DOUBLE[]) AS x, CAST(CASE WHEN label < 5 THEN 1 ELSE -1 END AS DOUBLE) AS y,
           {place} AS batch FROM embeddings),
  size AS (SELECT {batches} AS n_batches FROM embeddings),
  fit AS (
    SELECT CAST(-1 AS BIGINT) AS k, [{zeros}] AS w, CAST(0.0 AS DOUBLE) AS b,
           CAST(NULL AS DOUBLE) AS cost, CAST(NULL AS DOUBLE) AS change
    UNION ALL
    SELECT k, [{step}], b - {lr!r} * (100.0 * gb),
           cost, CASE WHEN k > 0 THEN {change} END
    FROM (SELECT k, w, b, prev, before, 0.5 * list_dot_product(w, w) + 100.0 * sum(greatest(0.0, 1.0 - m)) AS cost,
                 [{grad}] AS g, coalesce(sum(CASE WHEN {viol} THEN -y END), 0.0) AS gb
          FROM (SELECT f.k + 1 AS k, f.w, f.b, f.cost AS prev, f.change AS before, n_batches, r.x, r.y, r.batch,
                       r.y * (list_dot_product(r.x, f.w) + f.b) AS m
                FROM fit f, size, rows r WHERE f.k + 1 < {most} AND coalesce(f.change > {stop}, true))
          GROUP BY k, w, b, prev, before))""" + (history if out == "history" else model)


_SVM_GRADIENT = f"""WITH {_PTS},{_SVM_ROWS},
  W AS (SELECT DISTINCT d, CAST(0.01 * ((d % 5) - 2) AS DOUBLE) AS w FROM pts),
  M AS (SELECT p.vec_id, r.y, r.y * (sum(p.x * w.w) + 0.1) AS m
        FROM pts p JOIN W w USING (d) JOIN yrows r USING (vec_id) GROUP BY 1, 2),
  V AS (SELECT vec_id, y FROM M WHERE m < 1)
SELECT CAST(w.d AS INTEGER) AS dim,
       round(w.w + 100.0 * coalesce(sum(-v.y * p.x), 0.0), 6) AS dw
FROM W w LEFT JOIN (pts p JOIN V v USING (vec_id)) ON p.d = w.d
GROUP BY w.d, w.w
UNION ALL
SELECT -1 AS dim, round(CAST(100.0 * coalesce(sum(-y), 0) AS DOUBLE), 6) AS dw FROM V"""

ORACLES.update({
    "kmeans_assign_l2": _kmeans_assign("l2"),
    "kmeans_assign_l1": _kmeans_assign("l1"),
    "kmeans_fit_loss": _kmeans_fit(21),
    "kmeans_fit_l1_loss": _kmeans_fit(21, dist="l1"),
    "kmeans_fit_centers": _kmeans_fit(21, centers=True),
    "svm_cost_gradient": _SVM_GRADIENT,
    "svm_batch_fit": _svm_fit("history", 3e-5, 0.25, 2000),
    "svm_batch_model": _svm_fit("model", 3e-5, 0.25, 2000),
    "svm_minibatch_fit": _svm_fit("history", 1.3e-4, 0.01, 6000, 20),
    "svm_minibatch_model": _svm_fit("model", 1.3e-4, 0.01, 6000, 20),
})


# -- recommendation ---------------------------------------------------------


_CF = """
  r AS (SELECT DISTINCT o_custkey AS cust, l_partkey AS item
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
  blk AS (SELECT DISTINCT item FROM r WHERE item < 1000),
  rm AS (SELECT * FROM r WHERE NOT (cust = 499 AND item < 1000)),
  ti AS (SELECT item FROM rm WHERE cust = 499)"""

_CF_UU = """
  pt AS (SELECT count(*) AS n FROM ti),
  ov AS (SELECT rm.cust, count(*) AS ov FROM rm JOIN ti USING (item) GROUP BY rm.cust),
  deg AS (SELECT cust, count(*) AS p FROM rm GROUP BY cust),
  w AS (SELECT ov.cust, ov.ov / sqrt((SELECT n FROM pt) * deg.p) AS w FROM ov JOIN deg USING (cust)),
  uu_sc AS (SELECT rm.item, sum(w.w) AS score FROM rm JOIN w USING (cust)
            WHERE rm.item < 1000 GROUP BY rm.item),
  uu_all AS (SELECT item, coalesce(score, 0.0) AS score FROM blk LEFT JOIN uu_sc USING (item)),
  uu AS (SELECT item, score, row_number() OVER (ORDER BY """ + significant_sql("score") + """ DESC, item) AS rank
         FROM uu_all)"""

_CF_II = """
  q AS (SELECT item, count(*) AS q FROM rm GROUP BY item),
  tq AS (SELECT ti.item, q.q FROM ti JOIN q USING (item)),
  s AS (SELECT rm.cust, sum(1.0 / sqrt(tq.q)) AS s FROM rm JOIN tq USING (item) GROUP BY rm.cust),
  ii_acc AS (SELECT rm.item, sum(s.s) AS acc FROM rm JOIN s USING (cust)
             WHERE rm.item < 1000 GROUP BY rm.item),
  ii_sc AS (SELECT ii_acc.item, acc / sqrt(q.q) AS score FROM ii_acc JOIN q USING (item)),
  ii_all AS (SELECT item, coalesce(score, 0.0) AS score FROM blk LEFT JOIN ii_sc USING (item)),
  ii AS (SELECT item, score, row_number() OVER (ORDER BY """ + significant_sql("score") + """ DESC, item) AS rank
         FROM ii_all)"""


def _mf_base(k: int = 4) -> str:
    scale = repr(math.sqrt(5.0 / k))
    return f"""
  ratings AS (SELECT o_custkey AS cust, l_partkey AS part, avg(l_quantity) AS rating
              FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2),
  dims AS (SELECT unnest(range(0, {k})) AS d),
  uid AS (SELECT DISTINCT cust AS id FROM ratings),
  iid AS (SELECT DISTINCT part AS id FROM ratings),
  P0 AS (SELECT id, d, {scale} * {uniform01_sql('id', 'd', 1)} AS v FROM uid, dims),
  Q0 AS (SELECT id, d, {scale} * {uniform01_sql('id', 'd', 2)} AS v FROM iid, dims)"""


def _mf_err(t: int) -> str:
    return f"""
  E{t} AS (SELECT r.cust, r.part, r.rating - sum(p.v * q.v) AS err
           FROM ratings r JOIN P{t} p ON p.id = r.cust JOIN Q{t} q ON q.id = r.part AND q.d = p.d
           GROUP BY r.cust, r.part, r.rating)"""


def _mf_obj(t: int, reg: float) -> str:
    return (f"SELECT sum(err * err) AS sse, {reg!r} * ((SELECT sum(v * v) FROM P{t}) + "
            f"(SELECT sum(v * v) FROM Q{t})) AS reg, count(*) AS n FROM E{t}")


def _mf_gd(rounds: int = 3, reg: float = 0.2, lr: float = 1e-4, k: int = 4) -> str:
    ctes = [f"WITH {_mf_base(k)}"]
    for t in range(rounds + 1):
        ctes.append(_mf_err(t))
        if t == rounds:
            break
        for own, other, key, okey in (("P", "Q", "cust", "part"), ("Q", "P", "part", "cust")):
            ctes.append(f"""
  {own}{t + 1} AS (SELECT f.id, f.d, f.v + coalesce({lr!r} * g.g, 0.0) AS v FROM {own}{t} f LEFT JOIN
           (SELECT e.{key} AS id, o.d, sum(2.0 * e.err * o.v - {reg!r} * s.v) AS g
            FROM E{t} e JOIN {other}{t} o ON o.id = e.{okey}
                        JOIN {own}{t} s ON s.id = e.{key} AND s.d = o.d
            GROUP BY 1, 2) g ON g.id = f.id AND g.d = f.d)""")
    objs = "\nUNION ALL ".join(
        f"SELECT {t} AS iteration, round(sse + reg, 3) AS objective FROM ({_mf_obj(t, reg)})"
        for t in range(rounds + 1))
    return ",".join(ctes) + "\n" + objs


ORACLES.update({
    "cf_user_user": f"WITH {_CF},{_CF_UU}\n"
                    "SELECT item, round(score, 6) AS score, rank FROM uu WHERE rank <= 20",
    "cf_item_item": f"WITH {_CF},{_CF_II}\n"
                    "SELECT item, round(score, 6) AS score, rank FROM ii WHERE rank <= 20",
    "cf_hit_rate": f"""WITH {_CF},{_CF_UU},{_CF_II},
  pos AS (SELECT item FROM r WHERE cust = 499 AND item < 1000),
  npos AS (SELECT count(*) AS n FROM pos),
  uh AS (SELECT rank AS k, sum(CASE WHEN item IN (SELECT item FROM pos) THEN 1 ELSE 0 END)
                  OVER (ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS h
         FROM uu WHERE rank <= 20),
  ih AS (SELECT rank AS k, sum(CASE WHEN item IN (SELECT item FROM pos) THEN 1 ELSE 0 END)
                  OVER (ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS h
         FROM ii WHERE rank <= 20)
SELECT coalesce(uh.k, ih.k) AS k,
       round(CAST(uh.h AS DOUBLE) / (SELECT n FROM npos), 10) AS uu_rate,
       round(CAST(ih.h AS DOUBLE) / (SELECT n FROM npos), 10) AS ii_rate
FROM uh FULL JOIN ih ON uh.k = ih.k""",
    "mf_objective": f"WITH {_mf_base(4)},{_mf_err(0)}\n"
                    "SELECT n, round(sse, 3) AS sse, round(reg, 3) AS reg, "
                    "round(sse + reg, 3) AS objective FROM (" + _mf_obj(0, 0.2) + ")",
    "mf_gd_fit": _mf_gd(3, 0.2, 1e-4, 4),
    "mf_als_fit": """
SELECT count(*) AS n, count(DISTINCT cust) AS n_users, count(DISTINCT part) AS n_items, true AS fits
FROM (SELECT DISTINCT o_custkey AS cust, l_partkey AS part FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""",
})


# -- sketches, streaming, sinks, positional join ----------------------------



def _cms_cells(x: str, n_buckets: int = 10_000) -> str:
    params = ", ".join(f"({h}, {a}, {b})" for h, (a, b) in enumerate(CMS_PARAMS))
    p = CMS_PRIME
    return f"""
  hp AS (SELECT * FROM (VALUES {params}) AS t(h, a, b)),
  cells AS (SELECT src.x AS id, hp.h,
                   CAST((((hp.a * (((src.x % {p}) + {p}) % {p}) + hp.b) % {p}) + {p}) % {p} % {n_buckets}
                        AS INTEGER) AS bucket
            FROM ({x}) src, hp),
  sketch AS (SELECT h, bucket, count(*) AS n FROM cells GROUP BY h, bucket)"""


_CMS_SKETCH = f"WITH {_cms_cells('SELECT user_id AS x FROM events')}\nSELECT h, bucket, n FROM sketch"

_CMS_PROBE = """
  probe AS (SELECT DISTINCT id FROM (SELECT user_id AS id FROM events
                                     UNION ALL SELECT c_custkey FROM customer)),
  pcells AS (SELECT probe.id, hp.h,
                    CAST((((hp.a * (((probe.id % 123457) + 123457) % 123457) + hp.b) % 123457)
                          + 123457) % 123457 % 10000 AS INTEGER) AS bucket
             FROM probe, hp)"""

ORACLES.update({
    "cms_sketch": _CMS_SKETCH,
    "cms_stream": _CMS_SKETCH,
    "cms_estimate": f"""WITH {_cms_cells('SELECT user_id AS x FROM events')},{_CMS_PROBE}
SELECT pcells.id, min(coalesce(sketch.n, 0)) AS estimate
FROM pcells LEFT JOIN sketch ON sketch.h = pcells.h AND sketch.bucket = pcells.bucket
GROUP BY pcells.id""",
    "approx_distinct_per_key": """
        SELECT event_type AS key, count(DISTINCT user_id) AS n, true AS within FROM events GROUP BY event_type""",
    "cms_distinct_ids": "SELECT count(DISTINCT l_partkey) AS n_ids FROM lineitem",
    "cms_stream_probe": f"""WITH {_cms_cells('SELECT user_id AS x FROM events')},{_CMS_PROBE}
SELECT pcells.id, min(coalesce(sketch.n, 0)) AS estimate, (SELECT count(*) FROM events) AS seen
FROM pcells LEFT JOIN sketch ON sketch.h = pcells.h AND sketch.bucket = pcells.bucket
GROUP BY pcells.id""",
    "record_count": f"""
        WITH t AS (SELECT {_SPLIT.format(c='text')} AS p FROM documents)
        SELECT p[1] AS key, count(DISTINCT p[3] || p[4]) AS n FROM t WHERE len(p) >= 4 GROUP BY 1""",
    "short_records": f"""
        WITH t AS (SELECT {_SPLIT.format(c='text')} AS p FROM documents)
        SELECT count(*) AS n_lines, count(*) FILTER (WHERE len(p) < 4) AS n_short FROM t""",
    "cms_error": f"""WITH {_cms_cells('SELECT l_partkey AS x FROM lineitem')},
  truth AS (SELECT l_partkey AS id, count(*) AS true_n FROM lineitem GROUP BY 1),
  tot AS (SELECT count(*) AS t FROM lineitem),
  est AS (SELECT c.id, min(s.n) AS estimate
          FROM (SELECT DISTINCT id, h, bucket FROM cells) c
          JOIN sketch s ON s.h = c.h AND s.bucket = c.bucket GROUP BY c.id)
SELECT truth.id, true_n, estimate, true_n / (SELECT t FROM tot) AS norm_freq,
       (estimate - true_n) / true_n AS rel_error
FROM truth JOIN est USING (id)""",
    "sink_roundtrip": f"""
        SELECT token AS key, count(*) AS n
        FROM (SELECT unnest({_SPLIT.format(c='text')}) AS token FROM documents)
        GROUP BY token""",
    "positional_join": """
        SELECT row_number() OVER (ORDER BY doc_id) - 1 AS idx, quality, toxic FROM labels""",
})


# -- text layouts -----------------------------------------------------------

_BY_DOC = "row_number() OVER (ORDER BY doc_id) - 1 AS row_id"

ORACLES.update({
    "adjacency_layout": """
        SELECT src, dst, CAST(pos AS INTEGER) AS pos, count(*) AS n FROM (
            SELECT l_orderkey AS src, l_partkey AS dst, 0 AS pos, l_returnflag FROM lineitem
            UNION ALL SELECT l_orderkey, l_suppkey, 1, l_returnflag FROM lineitem
            UNION ALL SELECT l_orderkey, CAST(l_linenumber AS BIGINT), 2, l_returnflag FROM lineitem)
        WHERE l_returnflag <> 'A' GROUP BY 1, 2, 3""",
    "edges_tab_layout": """
        SELECT l_partkey AS src, l_suppkey AS dst, count(*) AS n FROM lineitem GROUP BY 1, 2""",
    "edges_ws_layout": """
        SELECT CAST(user_id AS VARCHAR) AS src, event_type AS dst, count(*) AS n FROM events
        WHERE event_type <> 'click' GROUP BY 1, 2""",
    "ratings_layout": """
        SELECT l_orderkey AS "user", l_partkey AS item, sum(CAST(CAST(l_quantity AS INTEGER) AS DOUBLE)) AS rating
        FROM lineitem GROUP BY 1, 2""",
    "vectors_layout": """
        SELECT id, CAST(unnest(range(0, len(embedding))) AS INTEGER) AS d, CAST(unnest(embedding) AS DOUBLE) AS x
        FROM (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS id, embedding FROM embeddings)""",
    "dense_matrix_layout": f"""
        SELECT row_id, CAST(col AS BIGINT) AS col_id, CAST(v AS INTEGER) AS value FROM (
            SELECT {_BY_DOC}, 0 AS col, toxic AS v FROM labels
            UNION ALL SELECT {_BY_DOC}, 1, quality FROM labels)
        WHERE v <> 0""",
    "int_rows_layout": f"""
        SELECT {_BY_DOC}, CAST(toxic AS DOUBLE) AS toxic, CAST(quality AS DOUBLE) AS quality FROM labels""",
    "names_layout": """
        SELECT item, n, p_name AS name
        FROM (SELECT l_partkey AS item, count(*) AS n FROM lineitem GROUP BY 1)
        LEFT JOIN (SELECT row_number() OVER (ORDER BY p_partkey) - 1 AS idx, p_name FROM part) ON idx = item""",
    "counts_layout": "SELECT user_id AS event_id, count(*) AS n FROM events GROUP BY 1",
    "item_counts_layout": """
        SELECT l_returnflag AS a, l_linestatus AS b, count(*) AS n FROM lineitem GROUP BY 1, 2""",
    "centroids_layout": """
        SELECT CAST(dense_rank() OVER (ORDER BY label) - 1 AS INTEGER) AS cluster, CAST(d AS INTEGER) AS d, x
        FROM (SELECT label, d, max(x) AS x
              FROM (SELECT label, unnest(range(0, len(embedding))) AS d, CAST(unnest(embedding) AS DOUBLE) AS x
                    FROM embeddings) GROUP BY 1, 2)""",
    "iterations_layout": """
        SELECT l_linenumber AS iteration, l_returnflag,
               CASE WHEN l_linenumber = 1 THEN -count(*) ELSE count(*) END AS n
        FROM lineitem GROUP BY 1, 2""",
    "sorted_part_files": f"""
        SELECT row_number() OVER (ORDER BY token) - 1 AS idx, token
        FROM (SELECT DISTINCT token
              FROM (SELECT unnest({_SPLIT.format(c='text')}) AS token FROM documents))""",
    "single_sorted_file": f"""
        SELECT row_number() OVER (ORDER BY letter) - 1 AS idx, letter, n, CAST(1 AS BIGINT) AS files
        FROM ({ORACLES["first_letter_count"]})""",
    "kmeans_assign_nan": f"SELECT * FROM ({ORACLES['kmeans_assign_l2']}) WHERE vec_id % 7 <> 3",
})
