"""SQL text shared by the DuckDB oracle queries.

These are independent re-statements of each operator in plain SQL over the
driver tables; they are what the Spark results are checked against.
"""

from __future__ import annotations

PAIRS_CTE = """pairs AS (
  SELECT o.o_custkey AS ReviewerID, l.l_partkey AS BeerID,
         avg(l.l_quantity) / 10.0 AS rating,
         min(l.l_discount) AS min_discount,
         min(l.l_shipdate) AS first_ship,
         min(l.l_orderkey) AS first_order,
         count(*) AS n_lines
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  GROUP BY o.o_custkey, l.l_partkey)"""

RATINGS_CTE = PAIRS_CTE + """,
ratings AS (
  SELECT ReviewerID || '-' || BeerID AS RowID, BeerID, ReviewerID, rating,
         CASE WHEN (ReviewerID + BeerID) % 10 = 0 THEN 'test'
              WHEN (ReviewerID + BeerID) % 10 IN (1, 2) THEN 'val'
              ELSE 'train' END AS split
  FROM pairs)"""

NAMED_PART = """named AS (
  SELECT r.RowID, r.BeerID, r.ReviewerID, p.p_name AS BeerName, p.p_type AS BeerType,
         r.rating, r.split
  FROM ratings r JOIN part p ON r.BeerID = p.p_partkey)"""

NAMED_RATINGS_CTE = RATINGS_CTE + ",\n" + NAMED_PART

FEATURES_CTE = RATINGS_CTE + """,
feat AS (
  SELECT ReviewerID || '-' || BeerID AS RowID, ReviewerID, BeerID,
    CAST(regexp_extract(p.p_brand, '(\\d+)$', 1) AS BIGINT) AS BrewerID,
    CASE WHEN min_discount * 100 = 0 THEN NULL ELSE round(min_discount * 100, 2) END AS ABV,
    CASE WHEN ReviewerID % 3 = 0 THEN upper(strftime(first_ship, '%a')) ELSE strftime(first_ship, '%a') END AS DayofWeek,
    CASE WHEN ReviewerID % 3 = 0 THEN upper(strftime(first_ship, '%b')) ELSE strftime(first_ship, '%b') END AS Month,
    CAST(dayofmonth(first_ship) AS INTEGER) AS DayofMonth,
    CAST(year(first_ship) AS INTEGER) AS Year,
    printf('%02d:%02d:%02d',
           CAST(((first_order * 7919 + BeerID) % 86400) // 3600 AS INTEGER),
           CAST((((first_order * 7919 + BeerID) % 86400) % 3600) // 60 AS INTEGER),
           CAST(((first_order * 7919 + BeerID) % 86400) % 60 AS INTEGER)) AS TimeOfDay,
    c.c_mktsegment AS Gender,
    CASE WHEN c.c_custkey % 5 = 0 THEN 'unknown'
         WHEN c.c_custkey % 7 = 0 THEN
           ['January','February','March','April','May','June','July','August',
            'September','October','November','December'][c.c_nationkey % 12 + 1]
           || ' ' || CAST(c.c_custkey % 28 + 1 AS VARCHAR)
         ELSE ['January','February','March','April','May','June','July','August',
               'September','October','November','December'][c.c_nationkey % 12 + 1]
           || ' ' || CAST(c.c_custkey % 28 + 1 AS VARCHAR) || ', '
           || CAST(1950 + c.c_custkey % 60 AS VARCHAR) END AS Birthday,
    CASE WHEN (ReviewerID + BeerID) % 10 = 0 THEN 'test'
         WHEN (ReviewerID + BeerID) % 10 IN (1, 2) THEN 'val'
         ELSE 'train' END AS split
  FROM pairs
  JOIN customer c ON pairs.ReviewerID = c.c_custkey
  JOIN part p ON pairs.BeerID = p.p_partkey)"""


DAY_CASE = ("CASE lower({c}) WHEN 'mon' THEN 1 WHEN 'tue' THEN 2 WHEN 'wed' THEN 3 "
            "WHEN 'thu' THEN 4 WHEN 'fri' THEN 5 WHEN 'sat' THEN 6 WHEN 'sun' THEN 7 END")
MONTH_CASE = ("CASE lower({c}) WHEN 'jan' THEN 1 WHEN 'feb' THEN 2 WHEN 'mar' THEN 3 "
              "WHEN 'apr' THEN 4 WHEN 'may' THEN 5 WHEN 'jun' THEN 6 WHEN 'jul' THEN 7 "
              "WHEN 'aug' THEN 8 WHEN 'sep' THEN 9 WHEN 'oct' THEN 10 WHEN 'nov' THEN 11 "
              "WHEN 'dec' THEN 12 END")


def time_sql(c: str) -> str:
    part = "TRY_CAST(trim(split_part({c}, ':', {k})) AS INTEGER)"
    return (f"CASE WHEN len(string_split({c}, ':')) <> 3 THEN 0 ELSE "
            f"{part.format(c=c, k=1)} * 3600 + {part.format(c=c, k=2)} * 60 + "
            f"{part.format(c=c, k=3)} END")


def age_sql(c: str, year: int = 2020) -> str:
    y = f"TRY_CAST(trim(split_part({c}, ',', 2)) AS INTEGER)"
    return (f"CASE WHEN lower({c}) = 'unknown' THEN 0 WHEN strpos({c}, ',') = 0 THEN 0 "
            f"WHEN {year} - {y} > 0 THEN {year} - {y} WHEN {y} IS NULL THEN NULL ELSE 0 END")


ENGINEERED_CTE = FEATURES_CTE + ",\n" + NAMED_PART + """,
eng0 AS (
  SELECT n.RowID, n.BeerID, n.ReviewerID, n.BeerName, n.BeerType, n.rating, n.split,
         f.BrewerID, f.ABV, f.DayofWeek, f.Month, f.DayofMonth, f.Year, f.TimeOfDay,
         f.Gender, f.Birthday
  FROM named n JOIN feat f ON n.RowID = f.RowID),
eng1 AS (
  SELECT e.*, rc.n AS ReviewerReviewCount, bc.n AS BeerReviewCount FROM eng0 e
  JOIN (SELECT split, ReviewerID, count(*) AS n FROM eng0 GROUP BY split, ReviewerID) rc
    ON e.split = rc.split AND e.ReviewerID = rc.ReviewerID
  JOIN (SELECT split, BeerID, count(*) AS n FROM eng0 GROUP BY split, BeerID) bc
    ON e.split = bc.split AND e.BeerID = bc.BeerID),
eng AS (
  SELECT RowID, BeerID, ReviewerID, BeerName, BeerType, rating, split, BrewerID,
         coalesce(ABV, avg(ABV) OVER (PARTITION BY split)) AS ABV,
         """ + DAY_CASE.format(c="DayofWeek") + """ AS DayofWeek,
         """ + MONTH_CASE.format(c="Month") + """ AS Month,
         DayofMonth, Year,
         """ + time_sql("TimeOfDay") + """ AS TimeOfDay,
         Gender,
         """ + age_sql("Birthday") + """ AS Birthday,
         ReviewerReviewCount, BeerReviewCount
  FROM eng1)"""

SCALED = ["ReviewerReviewCount", "BeerReviewCount", "ABV", "DayofWeek", "DayofMonth",
          "Month", "Year", "TimeOfDay", "Birthday"]


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def cv_baseline_ctes(k: int, n_epochs: int, reg_u: float, reg_i: float, prefix: str = "") -> list[str]:
    """Cross-validated ALS baseline over ``ratings`` (train split): all folds at once.

    The last table is ``{p}cv`` with (fold, mae, n).
    """
    p = prefix
    ctes = [f"{p}fd AS (SELECT BeerID AS u, ReviewerID AS i, rating AS r, "
            f"('0x' || substr(md5(RowID || ':42'), 1, 8))::bigint % {k} AS fold FROM ratings WHERE split = 'train')",
            f"{p}tr AS (SELECT k.f, u, i, r FROM {p}fd, range({k}) k(f) WHERE fold <> k.f)",
            f"{p}mu AS (SELECT f, avg(r) AS mu FROM {p}tr GROUP BY f)"]
    prev = None
    for e in range(1, n_epochs + 1):
        old = f"- coalesce(b.bu, 0) " if prev else ""  # noqa: F541
        join = f"LEFT JOIN {prev} b ON t.u = b.u AND t.f = b.f" if prev else ""
        ctes.append(f"{p}bi{e} AS (SELECT t.f, t.i, sum(t.r - m.mu {old}) / ({reg_i} + count(*)) AS bi "
                    f"FROM {p}tr t {join} JOIN {p}mu m ON m.f = t.f GROUP BY t.f, t.i)")
        ctes.append(f"{p}bu{e} AS (SELECT t.f, t.u, sum(t.r - m.mu - b.bi) / ({reg_u} + count(*)) AS bu "
                    f"FROM {p}tr t JOIN {p}bi{e} b ON t.i = b.i AND t.f = b.f JOIN {p}mu m ON m.f = t.f GROUP BY t.f, t.u)")
        prev = f"{p}bu{e}"
    ctes.append(f"{p}cv AS (SELECT t.fold, avg(abs(t.r - least(greatest(m.mu + coalesce(u.bu, 0) + coalesce(i.bi, 0), 0.0), 5.0))) AS mae, "
                f"count(*) AS n FROM {p}fd t JOIN {p}mu m ON m.f = t.fold LEFT JOIN {prev} u ON u.u = t.u AND u.f = t.fold "
                f"LEFT JOIN {p}bi{n_epochs} i ON i.i = t.i AND i.f = t.fold GROUP BY t.fold)")
    return ctes


def baseline_ctes(n_epochs: int = 10, reg_u: float = 15.0, reg_i: float = 10.0,
                  user: str = "BeerID", item: str = "ReviewerID",
                  prefix: str = "") -> tuple[list[str], str, str]:
    """Unrolled ALS baseline epochs over ``ratings`` (train split).

    Returns (ctes, final bu table, final bi table); tables have columns
    ``u, bu`` and ``i, bi``, plus the ``{p}mu`` one-row table.
    """
    p = prefix
    ctes = [f"{p}tr AS (SELECT {user} AS u, {item} AS i, rating AS r FROM ratings WHERE split = 'train')",
            f"{p}mu AS (SELECT avg(r) AS mu FROM {p}tr)"]
    prev_bu = None
    for e in range(1, n_epochs + 1):
        if prev_bu is None:
            ctes.append(f"{p}bi{e} AS (SELECT t.i, sum(t.r - m.mu) / ({reg_i} + count(*)) AS bi "
                        f"FROM {p}tr t, {p}mu m GROUP BY t.i)")
        else:
            ctes.append(f"{p}bi{e} AS (SELECT t.i, sum(t.r - m.mu - coalesce(b.bu, 0)) / ({reg_i} + count(*)) AS bi "
                        f"FROM {p}tr t LEFT JOIN {prev_bu} b ON t.u = b.u, {p}mu m GROUP BY t.i)")
        ctes.append(f"{p}bu{e} AS (SELECT t.u, sum(t.r - m.mu - b.bi) / ({reg_u} + count(*)) AS bu "
                    f"FROM {p}tr t JOIN {p}bi{e} b ON t.i = b.i, {p}mu m GROUP BY t.u)")
        prev_bu = f"{p}bu{e}"
    return ctes, f"{p}bu{n_epochs}", f"{p}bi{n_epochs}"


def setting_prefix(s: dict) -> str:
    """Table prefix of a baseline setting."""
    return f"g{s['n_epochs']}_{int(s['reg_u'])}_{int(s['reg_i'])}_"


def cv_knn_ctes(k: int, min_supports=(1,), k_max: int = 40) -> list[str]:
    """Cross-validated neighbours (msd) of every train rating: each fold's pairs, similarities and ranks by themselves.

    Tables: nd (ratings with fold), ntr (train rows of fold f), ngs, nus, nki per fold, ntop (neighbours by support and rank).
    """
    supports = ", ".join(f"({m})" for m in min_supports)
    return ["nd AS (SELECT RowID, BeerID AS u, ReviewerID AS i, rating AS r, "
            f"('0x' || substr(md5(RowID || ':42'), 1, 8))::bigint % {k} AS fold FROM ratings WHERE split = 'train')",
            f"ntr AS (SELECT k.f, u, i, r FROM nd, range({k}) k(f) WHERE fold <> k.f)",
            "ngs AS (SELECT f, avg(r) AS mu, stddev_pop(r) AS sd FROM ntr GROUP BY f)",
            "nus AS (SELECT f, u, avg(r) AS mean_u, stddev_pop(r) AS sd_u FROM ntr GROUP BY f, u)",
            "nki AS (SELECT DISTINCT f, i FROM ntr)",
            "nst AS (SELECT a.f, a.u AS x, b.u AS y, count(*) AS n, round(1.0 / (sum((a.r - b.r) * (a.r - b.r)) / count(*) + 1), 12) AS sim "
            "FROM ntr a JOIN ntr b ON a.f = b.f AND a.i = b.i AND a.u < b.u GROUP BY a.f, a.u, b.u)",
            "nb AS (SELECT d.RowID, d.fold AS f, d.u, d.i, t.u AS v, t.r AS rv FROM nd d JOIN ntr t ON t.f = d.fold AND t.i = d.i)",
            "nc AS (SELECT b.*, s.n, s.sim FROM nb b LEFT JOIN nst s ON s.f = b.f AND s.x = least(b.u, b.v) AND s.y = greatest(b.u, b.v))",
            f"ntop AS (SELECT * FROM (SELECT nc.*, support, row_number() OVER (PARTITION BY RowID, support ORDER BY sim DESC, v) AS rk "
            f"FROM nc, (VALUES {supports}) m(support) WHERE nc.n >= support) WHERE rk <= {k_max})"]


def cv_knn_mae(kind: str, k: int = 40, min_k: int = 1, min_support: int = 1) -> str:
    """(fold, mae) of a neighbour model over the tables of ``cv_knn_ctes`` (and of the baseline's for that kind)."""
    dev = {"basic": "t.rv", "means": "t.rv - m.mean_u", "zscore": "(t.rv - m.mean_u) / CASE WHEN m.sd_u = 0 THEN g.sd ELSE m.sd_u END",
           "baseline": "t.rv - (g.mu + coalesce(bv.bu, 0) + coalesce(bj.bi, 0))"}[kind]
    ratio = f"CASE WHEN coalesce(a.n, 0) >= {min_k} AND a.w > 0 THEN a.s / a.w ELSE 0 END"
    est = {"basic": f"CASE WHEN a.n >= {min_k} THEN a.s / a.w END",
           "means": f"CASE WHEN ki.i IS NOT NULL THEN us.mean_u + {ratio} END",
           "zscore": f"CASE WHEN ki.i IS NOT NULL THEN us.mean_u + ({ratio}) * CASE WHEN us.sd_u = 0 THEN g.sd ELSE us.sd_u END END",
           "baseline": f"g.mu + coalesce(bx.bu, 0) + coalesce(bz.bi, 0) + CASE WHEN us.u IS NOT NULL AND ki.i IS NOT NULL THEN {ratio} ELSE 0 END"}[kind]
    bias = kind == "baseline"
    near = "LEFT JOIN bu10 bv ON bv.u = t.v AND bv.f = t.f LEFT JOIN bi10 bj ON bj.i = t.i AND bj.f = t.f" if bias else ""
    own = "LEFT JOIN bu10 bx ON bx.u = d.u AND bx.f = d.fold LEFT JOIN bi10 bz ON bz.i = d.i AND bz.f = d.fold" if bias else ""
    return (f"SELECT d.fold, avg(abs(d.r - least(greatest(coalesce({est}, g.mu), 0.0), 5.0))) AS mae FROM nd d JOIN ngs g ON g.f = d.fold "
            f"LEFT JOIN (SELECT t.RowID, sum(t.sim) AS w, sum(t.sim * ({dev})) AS s, count(*) AS n FROM ntop t "
            f"JOIN ngs g ON g.f = t.f JOIN nus m ON m.f = t.f AND m.u = t.v {near} WHERE support = {min_support} AND rk <= {k} "
            f"GROUP BY t.RowID) a ON a.RowID = d.RowID LEFT JOIN nus us ON us.f = d.fold AND us.u = d.u "
            f"LEFT JOIN nki ki ON ki.f = d.fold AND ki.i = d.i {own} GROUP BY d.fold")


def cv_bake_off_ctes(k: int) -> list[str]:
    """Table maes (algorithm, fold, mae) of the algorithms that start from nothing random; needs ``cv_baseline_ctes``."""
    kinds = " UNION ALL ".join(f"SELECT 'knn_{kind}' AS algorithm, fold, mae FROM ({cv_knn_mae(kind)})"
                               for kind in ("basic", "means", "zscore", "baseline"))
    return [*cv_knn_ctes(k),
            "nh AS (SELECT nd.*, md5('42|' || u || '|' || i) AS h FROM nd)",
            "nn AS (SELECT nh.fold, avg(abs(r - least(greatest(mu + sd * sqrt(-2.0 * ln((('0x' || substr(h, 1, 12))::bigint + 1) / 281474976710656.0::double)) "
            "* cos(2.0 * pi() * (('0x' || substr(h, 13, 12))::bigint / 281474976710656.0::double)), 0.0), 5.0))) AS mae "
            "FROM nh JOIN ngs ON f = fold GROUP BY nh.fold)",
            "sd AS (SELECT a.f, a.i AS x, b.i AS y, avg(a.r - b.r) AS dev FROM ntr a JOIN ntr b ON a.f = b.f AND a.u = b.u AND a.i <> b.i "
            "GROUP BY a.f, a.i, b.i)",
            "sh AS (SELECT d.RowID, d.fold AS f, d.i, t.i AS j FROM nd d JOIN ntr t ON t.f = d.fold AND t.u = d.u)",
            "sa AS (SELECT h.RowID, avg(s.dev) AS dev FROM sh h LEFT JOIN sd s ON s.f = h.f AND s.x = h.i AND s.y = h.j GROUP BY h.RowID)",
            "so AS (SELECT d.fold, avg(abs(d.r - least(greatest(CASE WHEN us.u IS NOT NULL AND ki.i IS NOT NULL "
            "THEN us.mean_u + coalesce(sa.dev, 0) ELSE g.mu END, 0.0), 5.0))) AS mae FROM nd d JOIN ngs g ON g.f = d.fold "
            "LEFT JOIN sa ON sa.RowID = d.RowID LEFT JOIN nus us ON us.f = d.fold AND us.u = d.u "
            "LEFT JOIN nki ki ON ki.f = d.fold AND ki.i = d.i GROUP BY d.fold)",
            f"maes AS ({kinds} UNION ALL SELECT 'normal', fold, mae FROM nn UNION ALL SELECT 'slope_one', fold, mae FROM so "
            "UNION ALL SELECT 'baseline', fold, mae FROM cv)"]


def least_squares_ctes(numeric: list[str], categories: list[str], label: str = "rating") -> list[str]:
    """Normal equations of ``eng``'s train rows by elimination, one pivot a step; ends in (RowID, split, est).

    Sparse (row, column, value) features: a constant, the numeric columns less
    their train mean, one column a category value but the first.
    """
    shift = ", ".join(f"avg({c}) AS m_{c}" for c in numeric)
    parts = ["SELECT RowID, ' one' AS c, 1.0::double AS v FROM eng"]
    parts += [f"SELECT RowID, '{c}' AS c, coalesce({c}, 0)::double - m_{c} AS v FROM eng, lm_shift" for c in numeric]
    parts += [f"SELECT RowID, '{c}=' || {c} AS c, 1.0::double AS v FROM eng WHERE {c} > (SELECT min({c}) FROM eng)" for c in categories]
    return [f"lm_shift AS (SELECT {shift} FROM (SELECT {', '.join(f'coalesce({c}, 0) AS {c}' for c in numeric)} FROM eng WHERE split = 'train'))",
            f"lm_x AS ({' UNION ALL '.join(parts)})",
            f"lm_t AS (SELECT x.* FROM lm_x x JOIN eng e ON e.RowID = x.RowID WHERE e.split = 'train' "
            f"UNION ALL SELECT RowID, '~y', {label} FROM eng WHERE split = 'train')",
            "lm_g AS (SELECT a.c AS a, b.c AS b, sum(a.v * b.v) AS v FROM lm_t a JOIN lm_t b ON a.RowID = b.RowID GROUP BY a.c, b.c)",
            "lm_n AS (SELECT c, row_number() OVER (ORDER BY c) AS i FROM (SELECT DISTINCT c FROM lm_t))",
            "lm_m AS (SELECT x.i, list(coalesce(g.v, 0) ORDER BY y.i) AS cells FROM lm_n x CROSS JOIN lm_n y "
            "LEFT JOIN lm_g g ON g.a = x.c AND g.b = y.c WHERE x.c <> '~y' GROUP BY x.i)",
            "lm_r AS (SELECT 0::bigint AS k, i, cells FROM lm_m UNION ALL SELECT r.k + 1, r.i, "
            "CASE WHEN r.i = p.i THEN list_transform(p.cells, lambda x: x / p.cells[p.i]) "
            "ELSE list_transform(list_zip(r.cells, p.cells), lambda x: x[1] - r.cells[p.i] / p.cells[p.i] * x[2]) END "
            "FROM lm_r r JOIN lm_r p ON p.i = r.k + 1 WHERE r.k < (SELECT max(i) FROM lm_m))",
            "lm_w AS (SELECT n.c, r.cells[len(r.cells)] AS w FROM lm_r r JOIN lm_n n ON n.i = r.i WHERE r.k = (SELECT max(i) FROM lm_m))",
            "lm_p AS (SELECT x.RowID, sum(x.v * w.w) AS est FROM lm_x x JOIN lm_w w ON w.c = x.c GROUP BY x.RowID)"]


def cocluster_ctes(n_epochs: int, n: int = 3) -> list[str]:
    """Co-clustering of ``ratings`` (train) from clusters by id modulo ``n``, epochs unrolled; ends in ccu, cci, cca, ccau, ccai."""
    def averages(e: str, cu: str, ci: str) -> list[str]:
        return [f"rw{e} AS (SELECT b.*, cu.cu, ci.ci FROM cb b JOIN {cu} cu ON cu.u = b.u JOIN {ci} ci ON ci.i = b.i)",
                f"co{e} AS (SELECT cu, ci, avg(r) AS m FROM rw{e} GROUP BY cu, ci)",
                f"au{e} AS (SELECT cu, avg(r) AS m FROM rw{e} GROUP BY cu)", f"ai{e} AS (SELECT ci, avg(r) AS m FROM rw{e} GROUP BY ci)"]

    def nearest(e: str, rows: str, key: str, free: str, fixed: str) -> str:
        cell = {"cu": "a.m", "ci": "b.m"}
        on = f"co.cu = k.k AND co.ci = w.ci" if free == "cu" else "co.cu = w.cu AND co.ci = k.k"  # noqa: F541
        a = "a.cu = k.k" if free == "cu" else "a.cu = w.cu"
        b = "b.ci = w.ci" if free == "cu" else "b.ci = k.k"
        est = "coalesce(co.m, mu) + w.mu_u - coalesce(a.m, mu) + w.mu_i - coalesce(b.m, mu)"
        return (f"SELECT {key}, arg_min(k, (err, k)) AS {free} FROM (SELECT w.{key}, k.k, sum((w.r - ({est})) ** 2) AS err "
                f"FROM {rows} w CROSS JOIN range({n}) k(k) CROSS JOIN cmu LEFT JOIN co{e} co ON {on} LEFT JOIN au{e} a ON {a} "
                f"LEFT JOIN ai{e} b ON {b} GROUP BY w.{key}, k.k) GROUP BY {key}")

    ctes = ["ct AS (SELECT BeerID AS u, ReviewerID AS i, rating AS r FROM ratings WHERE split = 'train')",
            "cmu AS (SELECT avg(r) AS mu FROM ct)",
            "cum AS (SELECT u, avg(r) AS mu_u FROM ct GROUP BY u)", "cim AS (SELECT i, avg(r) AS mu_i FROM ct GROUP BY i)",
            "cb AS (SELECT ct.*, mu_u, mu_i FROM ct JOIN cum ON cum.u = ct.u JOIN cim ON cim.i = ct.i)",
            f"cu0 AS (SELECT u, u % {n} AS cu FROM cum)", f"ci0 AS (SELECT i, i % {n} AS ci FROM cim)"]
    for e in range(n_epochs):
        ctes += averages(str(e), f"cu{e}", f"ci{e}")
        ctes.append(f"cu{e + 1} AS ({nearest(str(e), f'rw{e}', 'u', 'cu', 'ci')})")
        ctes.append(f"rx{e} AS (SELECT b.*, cu.cu, ci.ci FROM cb b JOIN cu{e + 1} cu ON cu.u = b.u JOIN ci{e} ci ON ci.i = b.i)")
        ctes.append(f"ci{e + 1} AS ({nearest(str(e), f'rx{e}', 'i', 'ci', 'cu')})")
    return ctes + averages(str(n_epochs), f"cu{n_epochs}", f"ci{n_epochs}")
