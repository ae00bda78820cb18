"""SQL text of the shared steps, for the oracle side."""

from __future__ import annotations

import math
from itertools import combinations

from panelwatch import schemas as S
from panelwatch.queries.panels import AS_OF, FLOOR, MARKET


def over(part: str, order: str, rows: int | None = None) -> str:
    frame = "" if rows is None else f" ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW"
    return f"OVER (PARTITION BY {part} ORDER BY {order}{frame})"


def lag(x: str, n: int, part="series_key", order="date") -> str:
    return f"lag({x}, {n}) {over(part, order)}"


def log_return(x: str, n: int, part="series_key", order="date") -> str:
    ratio = f"({x}) / nullif({lag(x, n, part, order)}, 0)"
    return f"ln(CASE WHEN {ratio} > 0 THEN {ratio} END)"


def ffill(x: str, part="series_key", order="date") -> str:
    return (
        f"last_value({x} IGNORE NULLS) OVER (PARTITION BY {part} ORDER BY {order} "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    )


def guard(x: str, n: int, value: str, least: int | None = None, part="series_key", order="date") -> str:
    return f"CASE WHEN count({x}) {over(part, order, n)} >= {least or n} THEN {value} END"


def std(x: str, n: int, part="series_key", order="date") -> str:
    return guard(x, n, f"stddev_samp({x}) {over(part, order, n)}", None, part, order)


def zscore(x: str, n: int = 60, floor: str | None = None, part="series_key", order="date") -> str:
    o = over(part, order, n)
    sigma = f"stddev_samp({x}) {o}"
    if floor is None:
        z = f"({x} - avg({x}) {o}) / nullif({sigma}, 0)"
    else:  # equal values: their mean may be off by a rounding step, their z-score is 0
        z = f"CASE WHEN min({x}) {o} = max({x}) {o} THEN 0.0::DOUBLE ELSE ({x} - avg({x}) {o}) / greatest({sigma}, {floor}) END"
    return guard(x, n, z, None, part, order)


def quantile(x: str, n: int, q: float = 0.95, part="series_key", order="date") -> str:
    return guard(x, n, f"quantile_cont({x}, {q}) {over(part, order, n)}", n // 2, part, order)


_PRICE, _MACRO, _GEO = ", ".join(S.PRICE_BLOCK), ", ".join(S.MACRO_BLOCK), ", ".join(S.GEO_BLOCK)
_OWN = {"yield_curve", "hy_spread", "fed_rate"}

# All 19 features on the union of dates, as ``features``.
FEATURES_SQL = (
    MARKET.strip()
    + f""",
p0 AS (
  SELECT s.series_key, s.date,
         CASE WHEN s.bz > 1e-6 THEN s.bz END AS bz,
         {ffill("m.brent", "s.series_key", "s.date")} AS fallback,
         {", ".join(f"CASE WHEN s.{c} < 1e-6 THEN 1e-6 ELSE s.{c} END AS {c}" for c in ("cl", "ng", "xle", "ovx", "vix"))}
  FROM shipments s LEFT JOIN macro m ON s.series_key = m.series_key AND s.date = m.date
),
p1 AS (
  SELECT *, coalesce(bz, CASE WHEN fallback < 1e-6 THEN 1e-6 ELSE fallback END) AS oil FROM p0
),
p2 AS (
  SELECT series_key, date,
         {log_return("oil", 1)} AS brent_ret_1d,
         {log_return("oil", 5)} AS brent_ret_5d,
         {log_return("cl", 1)} AS wti_ret_1d,
         oil - cl AS brent_wti_spread,
         {log_return("ng", 1)} AS ng_ret_1d,
         {log_return("xle", 1)} AS xle_ret_1d,
         xle / nullif(oil, 0) AS xle_brent_ratio,
         {zscore("ovx")} AS ovx_zscore,
         {zscore("vix")} AS vix_zscore
  FROM p1
),
price AS (SELECT *, {std("brent_ret_1d", 20)} AS brent_vol_20d FROM p2),
cpi_own AS (
  SELECT series_key, date, (cpi / nullif({lag("cpi", 12)}, 0) - 1.0::DOUBLE) * 100.0::DOUBLE AS v
  FROM macro WHERE cpi IS NOT NULL
),
dxy_own AS (SELECT series_key, date, {zscore("dxy")} AS v FROM macro WHERE dxy IS NOT NULL),
macro_set AS (
  SELECT m.series_key, m.date, m.yield_curve,
         m.yield_curve - {lag("m.yield_curve", 20, "m.series_key", "m.date")} AS yield_curve_chg_20d,
         {ffill("d.v", "m.series_key", "m.date")} AS dxy_zscore,
         m.hy_spread,
         m.hy_spread - {lag("m.hy_spread", 5, "m.series_key", "m.date")} AS hy_spread_chg_5d,
         m.fed_rate,
         {ffill("c.v", "m.series_key", "m.date")} AS cpi_yoy
  FROM macro m
  LEFT JOIN cpi_own c ON m.series_key = c.series_key AND m.date = c.date
  LEFT JOIN dxy_own d ON m.series_key = d.series_key AND m.date = d.date
),
geo AS (SELECT series_key, date, gpr_ai, gpr_oil FROM shipments WHERE gpr_ai IS NOT NULL),
stale AS (
  SELECT series_key, datediff('day', max(date), DATE '{AS_OF}') AS days,
         pow(0.95::DOUBLE, datediff('day', max(date), DATE '{AS_OF}')) AS w
  FROM geo GROUP BY 1
),
geo_set AS (
  SELECT g.series_key, g.date,
         s.w * g.gpr_ai + (1.0::DOUBLE - s.w) * 100.0::DOUBLE + (1.0::DOUBLE - s.w) * p.ovx_zscore * 30.0::DOUBLE AS geo_signal,
         {zscore("g.gpr_oil", 60, None, "g.series_key", "g.date")} AS gpr_oil_zscore
  FROM geo g JOIN stale s ON g.series_key = s.series_key
  LEFT JOIN price p ON g.series_key = p.series_key AND g.date = p.date
),
spine AS (
  SELECT * FROM price FULL JOIN macro_set USING (series_key, date) FULL JOIN geo_set USING (series_key, date)
),
filled AS (
  SELECT series_key, date, {", ".join(f"{ffill(f)} AS {f}" for f in S.FEATURES)} FROM spine
),
features AS (
  SELECT f.*, true AS is_trading_day, 1.0::DOUBLE AS data_quality_score, '' AS data_quality_flags,
         s.days > 10 AS gpr_is_stale, s.days AS gpr_days_stale
  FROM filled f LEFT JOIN stale s ON f.series_key = s.series_key
  WHERE date >= DATE '{FLOOR}'
)"""
)

# Complete rows, as the scoring steps see them.
TRAIN_SQL = (
    FEATURES_SQL
    + f""",
train AS (SELECT * FROM features WHERE {" AND ".join(f"{f} IS NOT NULL" for f in S.FEATURES)})"""
)

_TOPS = [f"greatest({', '.join(f'abs(z_{f})' for f in names)})" for names in S.BLOCKS.values()]

# z columns, scores_z, and the top driver weights of the z attribution.
SIGNAL_SQL = (
    TRAIN_SQL
    + f""",
zed AS (
  SELECT series_key, date, {", ".join(f"{zscore(f, 60, '1e-6')} AS z_{f}" for f in S.FEATURES)} FROM train
),
signal AS (
  SELECT *, CASE WHEN ({" + ".join(_TOPS)}) IS NOT NULL
              THEN least(({" + ".join(_TOPS)}) / 3.0::DOUBLE, 5.0::DOUBLE) / 5.0::DOUBLE END AS scores_z,
         greatest({", ".join(_TOPS)}) AS peak
  FROM zed
)"""
)

_SUM = " + ".join(f"coalesce(abs(z_{f}), 0)" for f in S.FEATURES)
WEIGHTS_SQL = " UNION ALL ".join(
    f"SELECT series_key, date, '{f}' AS feature, "
    f"coalesce(abs(z_{f}) / nullif({_SUM}, 0) * 0.35::DOUBLE, 0) AS weight FROM signal"
    for f in S.FEATURES
)

# A score table whose forest part is the normalised peak |z|, so that SQL can make it.
SCORES_SQL = (
    SIGNAL_SQL
    + f""",
peaks AS (
  SELECT *, (peak - min(peak) OVER ()) / nullif(stddev_pop(peak) OVER (), 0) AS scores_if
  FROM (SELECT * REPLACE (coalesce(peak, 0.0::DOUBLE) AS peak) FROM signal)
),
blend AS (
  SELECT series_key, date, scores_if, scores_z,
         0.4::DOUBLE * scores_if + 0.35::DOUBLE * coalesce(scores_z, 0) + 0.25::DOUBLE * 0.0::DOUBLE AS risk_score
  FROM peaks
),
thr AS (
  SELECT *, 1.53::DOUBLE AS threshold_static, {", ".join(f"{quantile('risk_score', n)} AS threshold_{k}" for k, n in S.ROLLING_WINDOWS.items())}
  FROM blend
),
flagged AS (
  SELECT *, {", ".join(f"coalesce(risk_score > threshold_{k}, false) AS anomaly_{k}" for k in S.THRESHOLD_NAMES)} FROM thr
),
weights AS ({WEIGHTS_SQL}),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY series_key, date ORDER BY round(weight * 1e10) DESC, feature) AS place FROM weights
),
scores AS (
  SELECT series_key, date, {", ".join(f"CAST({c} AS FLOAT) AS {c}" for c in ["risk_score", "scores_if", "scores_z", *[f"threshold_{k}" for k in S.THRESHOLD_NAMES]])},
         {", ".join(f"anomaly_{k}" for k in S.THRESHOLD_NAMES)}
  FROM flagged
),
drivers AS (
  SELECT r.series_key, r.date, r.feature, r.weight, r.place FROM ranked r
  JOIN scores s ON r.series_key = s.series_key AND r.date = s.date WHERE r.place <= 5
)"""
)


# Forests that SQL draws, grows and reads: the same hashes, hence the same trees.
TREES, SAMPLE = 6, 16  # the small one


def draw(*of: str) -> str:
    return f"(CAST('0x' || substr(md5(concat_ws('|', {', '.join(of)})), 1, 13) AS UBIGINT)::DOUBLE + 0.5::DOUBLE) / {2**52}.0::DOUBLE"


def path_length(n: str) -> str:
    long = f"2.0::DOUBLE * (ln({n} - 1.0::DOUBLE) + 0.5772156649015329::DOUBLE) - 2.0::DOUBLE * ({n} - 1.0::DOUBLE) / {n}"
    return f"CASE WHEN {n} > 2 THEN {long} WHEN {n} = 2 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"


def _level(d: int, by: str = "") -> str:
    """Splits of the nodes of depth ``d``, and the rows of the next depth; ``by`` is empty or a key and a comma."""
    at = [str(S.FOREST_SEED), *[c for c in by.split(", ") if c], "tree", "heap"]
    return f"""
extent{d} AS (SELECT {by}tree, heap, f, min(x[f]) AS lo, max(x[f]) AS hi FROM at{d}, kept GROUP BY ALL),
usable{d} AS (SELECT {by}tree, heap, list({{'f': f, 'lo': lo, 'hi': hi}} ORDER BY f) AS u FROM extent{d} WHERE hi > lo GROUP BY ALL),
picked{d} AS (SELECT {by}tree, heap, u[1 + CAST(floor({draw(*at, "'feature'")} * len(u)) AS BIGINT)] AS p, {draw(*at, "'split'")} AS v FROM usable{d}),
split{d} AS MATERIALIZED (SELECT {by}tree, heap, p.f AS f, CASE WHEN p.lo + v * (p.hi - p.lo) >= p.hi THEN p.lo ELSE p.lo + v * (p.hi - p.lo) END AS split FROM picked{d}),
at{d + 1} AS MATERIALIZED (SELECT {by}tree, 2 * heap + (x[f] > split)::INT AS heap, x FROM at{d} JOIN split{d} USING ({by}tree, heap)),"""


def forest_sql(trees: int, sample: int, kept: str, by: str = "") -> str:
    """The steps from ``signal`` to ``forest_raw``; the table must have more rows than ``enough``.

    ``kept`` selects the positions of the features that the forest sees.  With ``by`` (a column and
    a comma) there is a forest for each of its values.
    """
    enough, depth = sample + 8 * math.sqrt(sample) + 16, math.ceil(math.log2(sample))
    nodes = [
        f"""
  SELECT {by}tree, heap, {d} AS depth, count(*)::DOUBLE AS n, any_value(f) AS f, any_value(split) AS split
  FROM at{d} LEFT JOIN split{d} USING ({by}tree, heap) GROUP BY {by}tree, heap"""
        for d in range(depth)
    ]
    last = f"\n  SELECT {by}tree, heap, {depth} AS depth, count(*)::DOUBLE AS n, NULL, NULL FROM at{depth} GROUP BY {by}tree, heap"
    steps = [
        f"""
step{d + 1} AS (SELECT series_key, date, x, tree, CASE WHEN f IS NULL THEN heap ELSE 2 * heap + (x[f] > split)::INT END AS heap
  FROM step{d} JOIN nodes USING ({by}tree, heap)),"""
        for d in range(depth)
    ]
    return f"""
points AS MATERIALIZED (SELECT series_key, date, [{", ".join(S.FEATURES)}]::DOUBLE[] AS x FROM train),
kept AS MATERIALIZED ({kept}),
bound AS (SELECT {by}-ln(1.0::DOUBLE - {enough}::DOUBLE / count(*)) AS most FROM points {'GROUP BY ' + by[:-2] if by else ''}),
firsts AS (SELECT series_key, date, x, most, -ln({draw(str(S.FOREST_SEED), "series_key", "date")}) AS wait FROM points {'JOIN bound USING (' + by[:-2] + ')' if by else ', bound'}),
starts AS (SELECT *, least(floor(wait / most)::BIGINT, {trees - 1}) AS start FROM firsts WHERE wait < most * {trees}),
waits AS (
  SELECT series_key, date, x, tree, most,
         CASE WHEN tree = start THEN wait - start * most ELSE -ln({draw(str(S.FOREST_SEED), "tree", "series_key", "date")}) END AS wait
  FROM starts, range({trees}) r(tree) WHERE tree >= start
),
at0 AS MATERIALIZED (
  SELECT {by}tree, 1::BIGINT AS heap, x FROM waits WHERE wait < most
  QUALIFY row_number() OVER (PARTITION BY {by}tree ORDER BY wait, series_key, date) <= {sample}
),{"".join(_level(d, by) for d in range(depth))}
nodes AS MATERIALIZED ({" UNION ALL ".join([*nodes, last])}),
leaves AS (SELECT {by}tree, heap, depth, depth + {path_length("n")} AS length FROM nodes WHERE f IS NULL),
step0 AS (SELECT series_key, date, x, tree, 1::BIGINT AS heap FROM points, range({trees}) r(tree)),{"".join(steps)}
forest_raw AS (
  SELECT series_key, date, pow(2.0::DOUBLE, -avg(length) / ({path_length(str(sample))})) AS raw
  FROM step{depth} JOIN leaves USING ({by}tree, heap) GROUP BY series_key, date
)"""


NAMES_SQL = f"""
names AS (SELECT generate_subscripts(l, 1) AS f, unnest(l) AS feature FROM (SELECT [{", ".join(f"'{f}'" for f in S.FEATURES)}] AS l))"""
PAIRS_SQL = " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, abs(corr({a}, {b})) AS corr FROM train" for a, b in combinations(S.FEATURES, 2)
)

SMALL_FOREST_SQL = f"{SIGNAL_SQL},{NAMES_SQL},{forest_sql(TREES, SAMPLE, 'SELECT f FROM names')}"
# A forest of its own for each series set.
KEYED_FOREST_SQL = f"{SIGNAL_SQL},{NAMES_SQL},{forest_sql(TREES, SAMPLE, 'SELECT f FROM names', 'series_key, ')}"
KEYED_PAIRS_SQL = " UNION ALL ".join(
    f"SELECT series_key, '{a}' AS a, '{b}' AS b, abs(corr({a}, {b})) AS corr FROM train GROUP BY series_key" for a, b in combinations(S.FEATURES, 2)
)
# The daily job's forest, on the features that correlation leaves.
FOREST_SQL = (
    f"{SIGNAL_SQL},{NAMES_SQL},\npairs AS ({PAIRS_SQL}),"
    + forest_sql(
        S.FOREST_TREES,
        S.FOREST_SAMPLE,
        f"SELECT f FROM names WHERE feature NOT IN (SELECT b FROM pairs WHERE corr > {S.CORR_LIMIT})",
    )
    + """,
forest_scores AS (SELECT *, (raw - min(raw) OVER ()) / nullif(stddev_pop(raw) OVER (), 0) AS scores_if FROM forest_raw)"""
)

# Shapley values by their definition: a leaf's game knows some features of its path and
# weighs the branches of the others by their rows.
SHAPLEY_SQL = (
    SMALL_FOREST_SQL
    + f""",
steps AS (
  SELECT l.tree, l.heap AS leaf, p.f, p.split, ((l.heap >> k) % 2 = 0) AS goes_left, c.n / p.n AS share
  FROM leaves l, range({math.ceil(math.log2(SAMPLE))}) r(k)
  JOIN nodes c ON c.tree = l.tree AND c.heap = l.heap >> k
  JOIN nodes p ON p.tree = l.tree AND p.heap = l.heap >> (k + 1)
  WHERE k < l.depth
),
players AS MATERIALIZED (
  SELECT tree, leaf, f, product(share) AS share, row_number() OVER (PARTITION BY tree, leaf ORDER BY f) - 1 AS pos,
         count(*) OVER (PARTITION BY tree, leaf) AS d
  FROM steps GROUP BY tree, leaf, f
),
game AS (
  SELECT p.tree, p.leaf, p.d, pattern, known, any_value(length) * product(
           CASE WHEN (known >> pos) % 2 = 0 THEN share WHEN (pattern >> pos) % 2 = 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS v
  FROM players p JOIN leaves l ON l.tree = p.tree AND l.heap = p.leaf, range({SAMPLE}) a(pattern), range({SAMPLE}) b(known)
  WHERE pattern < 1 << p.d AND known < 1 << p.d GROUP BY 1, 2, 3, 4, 5
),
worth AS MATERIALIZED (
  SELECT p.tree, p.leaf, p.f, a.pattern,
         sum((b.v - a.v) * factorial(bit_count(a.known)::INT) * factorial((p.d - 1 - bit_count(a.known))::INT) / factorial(p.d::INT)) AS phi
  FROM players p JOIN game a USING (tree, leaf)
  JOIN game b ON b.tree = a.tree AND b.leaf = a.leaf AND b.pattern = a.pattern AND b.known = a.known + (1 << p.pos)
  WHERE (a.known >> p.pos) % 2 = 0 GROUP BY 1, 2, 3, 4
),
met AS (
  SELECT series_key, date, s.tree, s.leaf, f, bool_and((x[f] <= split) = goes_left) AS hit FROM points, steps s GROUP BY 1, 2, 3, 4, 5
),
seen AS (
  SELECT series_key, date, m.tree, m.leaf, sum(hit::BIGINT << pos)::BIGINT AS pattern
  FROM met m JOIN players p ON m.tree = p.tree AND m.leaf = p.leaf AND m.f = p.f GROUP BY 1, 2, 3, 4
),
phis AS (
  SELECT series_key, date, f, abs(sum(phi) / {TREES}.0::DOUBLE) AS phi
  FROM seen s JOIN worth w ON s.tree = w.tree AND s.leaf = w.leaf AND s.pattern = w.pattern GROUP BY 1, 2, 3
),
budget AS (SELECT series_key, date, sum(phi) AS total FROM phis GROUP BY 1, 2),
zparts AS ({WEIGHTS_SQL}),
summed AS (
  SELECT z.series_key, z.date, z.feature, z.weight + coalesce(phi / nullif(total, 0) * 0.4::DOUBLE, 0.0::DOUBLE) AS weight
  FROM zparts z JOIN names n ON z.feature = n.feature
  LEFT JOIN phis p ON z.series_key = p.series_key AND z.date = p.date AND n.f = p.f
  LEFT JOIN budget b ON z.series_key = b.series_key AND z.date = b.date
),
forest_drivers AS (
  SELECT *, row_number() OVER (PARTITION BY series_key, date ORDER BY round(weight * 1e10) DESC, feature) AS place FROM summed
)"""
)


# Change points: the least cost of cutting a weekly series at multiples of the step, all cuts tried.
_LONG = " UNION ALL ".join(f"SELECT series_key, week_end, '{f}' AS feature, {f} AS v FROM weekly" for f in S.FEATURES)
CHANGES_SQL = f"""
weekly AS MATERIALIZED (
  SELECT series_key, CAST(date_trunc('week', date) AS DATE) + 6 AS week_end, {", ".join(f"arg_max({f}, date) AS {f}" for f in S.FEATURES)}
  FROM train GROUP BY 1, 2
),
long AS MATERIALIZED (
  SELECT *, row_number() OVER s - 1 AS i, count(*) OVER (PARTITION BY series_key, feature) AS n FROM ({_LONG})
  WINDOW s AS (PARTITION BY series_key, feature ORDER BY week_end)
),
apart AS (
  SELECT p.series_key, p.feature, p.i // {S.CP_STEP} AS bi, q.i // {S.CP_STEP} AS bj, (p.v - q.v) * (p.v - q.v) AS d2
  FROM long p JOIN long q ON p.series_key = q.series_key AND p.feature = q.feature AND p.i < q.i
),
widths AS (SELECT series_key, feature, coalesce(1.0::DOUBLE / nullif(median(d2), 0), 1.0::DOUBLE) AS gamma FROM apart GROUP BY 1, 2),
blocks AS (
  SELECT series_key, feature, bi, bj, sum(exp(-least(greatest(d2 * gamma, 0.01::DOUBLE), 100.0::DOUBLE))) AS g
  FROM apart JOIN widths USING (series_key, feature) GROUP BY 1, 2, 3, 4
),
grid AS (
  SELECT series_key, feature, n, a, e, least(e * {S.CP_STEP}, n) - a * {S.CP_STEP} AS rows
  FROM (SELECT DISTINCT series_key, feature, n FROM long), range(1000) x(a), range(1, 1001) y(e)
  WHERE a < e AND (e - 1) * {S.CP_STEP} < n AND n >= {S.CP_MIN_SIZE}
),
cumulated AS (
  SELECT g.*, sum(coalesce(b.g, 0.0::DOUBLE)) OVER (PARTITION BY g.series_key, g.feature, a ORDER BY e) AS part
  FROM grid g LEFT JOIN blocks b ON g.series_key = b.series_key AND g.feature = b.feature AND bi = a AND bj = e - 1
),
summed_up AS (SELECT *, sum(part) OVER (PARTITION BY series_key, feature, e ORDER BY a DESC) AS inside FROM cumulated),
costs AS MATERIALIZED (
  SELECT series_key, feature, e, max(n) AS n,
         list(CASE WHEN rows >= {S.CP_MIN_SIZE} THEN rows - (rows + 2 * inside) / rows + {S.CP_PENALTY}::DOUBLE ELSE 'inf'::DOUBLE END ORDER BY a) AS c
  FROM summed_up GROUP BY 1, 2, 3
),
best AS (
  SELECT DISTINCT series_key, feature, 0::BIGINT AS e, [0.0::DOUBLE] AS least_, []::BIGINT[] AS past FROM costs
  UNION ALL
  SELECT series_key, feature, e, list_append(least_, list_min(t)), list_append(past, list_position(t, list_min(t))::BIGINT - 1)
  FROM (SELECT b.series_key, b.feature, k.e, least_, past, list_transform(list_zip(least_, c), lambda z: z[1] + z[2]) AS t
        FROM best b JOIN costs k ON b.series_key = k.series_key AND b.feature = k.feature AND k.e = b.e + 1)
),
cuts AS (
  SELECT series_key, feature, past, past[e] AS a FROM (SELECT * FROM best WHERE e > 0 QUALIFY row_number() OVER (PARTITION BY series_key, feature ORDER BY e DESC) = 1)
  UNION ALL
  SELECT series_key, feature, past, past[a] FROM cuts WHERE a > 0
),
changes AS (
  SELECT c.series_key, c.feature, l.week_end FROM cuts c
  JOIN long l ON c.series_key = l.series_key AND c.feature = l.feature AND l.i = c.a * {S.CP_STEP} WHERE c.a > 0
)"""

_THRESHOLDS = ", ".join(f"{quantile('risk_score', n)} AS threshold_{k}" for k, n in S.ROLLING_WINDOWS.items())
RISK_SQL = f"""
density AS (SELECT series_key, week_end AS date, count(*)::DOUBLE / {len(S.FEATURES)}.0::DOUBLE AS scores_cp FROM changes GROUP BY 1, 2),
parts AS (
  SELECT f.series_key, f.date, scores_if, scores_z, coalesce(scores_cp, 0.0::DOUBLE) AS scores_cp
  FROM forest_scores f JOIN signal s ON f.series_key = s.series_key AND f.date = s.date
  LEFT JOIN density d ON f.series_key = d.series_key AND f.date = d.date
),
risk AS (SELECT *, 0.4::DOUBLE * scores_if + 0.35::DOUBLE * coalesce(scores_z, 0) + 0.25::DOUBLE * scores_cp AS risk_score FROM parts),
limits AS (SELECT *, {S.STATIC_THRESHOLD}::DOUBLE AS threshold_static, {_THRESHOLDS} FROM risk)"""


QUIET = "1999-06-01"
# The features of a market whose ^OVX falls silent and whose cpi has one value a month.
SPARSE_FEATURES_SQL = FEATURES_SQL.replace(
    MARKET.strip(),
    MARKET.strip().replace("shipments AS (", "shipments_all AS (").replace("macro AS (", "macro_all AS (")
    + f""",
shipments AS (SELECT * REPLACE (CASE WHEN date < DATE '{QUIET}' THEN ovx END AS ovx) FROM shipments_all),
macro AS (
  SELECT * REPLACE (CASE WHEN date = min(date) OVER (PARTITION BY series_key, date_trunc('month', date)) THEN cpi END AS cpi) FROM macro_all
)""",
)
