"""Histograms, box summaries, densities, power transforms, correlations, id gaps."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtside.constants import CORRELATION_THRESHOLD, HISTOGRAM_BINS, MAX_HUE_VALUES, SEASON_TYPE
from courtside.operators import phik, stats
from courtside.operators.quantiles import exact_quantiles
from courtside.plans import eda
from courtside.registry.core import checked, query
from courtside.views import view_ctes

FEATURES = ("fg_pct_home", "reb_home", "ast_home", "pts_home", "pts_away")

_REGULAR = f"SELECT * FROM v_game WHERE season_type = '{SEASON_TYPE}'"


def _regular(t) -> DataFrame:
    return t["v_game"].where(F.col("season_type") == SEASON_TYPE)


def _long_sql(source: str, group: str = "'all'", columns=FEATURES) -> str:
    return " UNION ALL ".join(
        f"""SELECT CAST({group} AS VARCHAR) AS "group", '{c}' AS "column", CAST({c} AS DOUBLE) AS v
FROM ({source}) WHERE {c} IS NOT NULL"""
        for c in columns
    )


def _histogram_sql(group: str, long: str | None = None, before: str = "") -> str:
    bins = HISTOGRAM_BINS
    return checked("v_game", sql=f"""
WITH {before}long AS ({long or _long_sql("SELECT * FROM v_game", group)}),
edges AS (SELECT "column", min(v) AS lo, max(v) AS hi FROM long GROUP BY ALL),
counts AS (
  SELECT "group", "column", least(CAST(floor((v - lo) / (hi - lo) * {bins}) AS INTEGER), {bins - 1}) AS bin,
    count(*) AS n
  FROM long JOIN edges USING ("column") GROUP BY ALL),
grid AS (
  SELECT DISTINCT "group", "column", CAST(b AS INTEGER) AS bin, lo, hi
  FROM long JOIN edges USING ("column"), range({bins}) AS r(b))
SELECT "group", "column", bin, lo + bin * ((hi - lo) / {bins}) AS low, lo + (bin + 1) * ((hi - lo) / {bins}) AS high,
  coalesce(n, 0) AS count
FROM grid LEFT JOIN counts USING ("group", "column", bin)""")


@query("histogram30", _histogram_sql("'all'"))
def histogram30(t):
    return stats.histogram(t["v_game"], FEATURES)


@query("grouped_histogram", _histogram_sql("season_type"))
def grouped_histogram(t):
    return stats.histogram(t["v_game"], FEATURES, by="season_type")


def _box_sql(long: str, before: str = "", digits: int = 4) -> str:
    return checked("v_game", sql=f"""
WITH {before}long AS ({long}),
q AS (SELECT "group", "column", quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median,
  quantile_cont(v, 0.75) AS q3 FROM long GROUP BY ALL)
SELECT "group", "column", round(q1, {digits}) AS q1, round(median, {digits}) AS median, round(q3, {digits}) AS q3, count(*) AS n,
  min(CASE WHEN v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN v END) AS whisker_low,
  max(CASE WHEN v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN v END) AS whisker_high,
  count(*) FILTER (WHERE v NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS n_outliers
FROM long JOIN q USING ("group", "column") GROUP BY "group", "column", q.q1, q.median, q.q3""")


_BOX_SQL = _box_sql(_long_sql(_REGULAR))


def _rounded(df: DataFrame, *columns: str, digits: int = 4) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query("box_summary", _BOX_SQL)
def box_summary(t):
    return _rounded(stats.box_summary(_regular(t), FEATURES), "q1", "median", "q3")


@query("box_summary_narrowed", _BOX_SQL)
def box_summary_narrowed(t):
    """The same with every column taken for too long to sort in one task."""
    return _rounded(stats.box_summary(_regular(t), FEATURES, sort_rows=500), "q1", "median", "q3")


_HUES = ("season_type", "team_name_home", "team_name_away", "season_id")


def _quartiles_sql(hue: str) -> str:
    return f"""SELECT '{hue}' AS hue, "group", "column", count(*) AS n, round(quantile_cont(v, 0.25), 4) AS q1,
  round(quantile_cont(v, 0.5), 4) AS median, round(quantile_cont(v, 0.75), 4) AS q3
FROM ({_long_sql("SELECT * FROM v_game", hue)}) GROUP BY "group", "column" """


@query(
    "grouped_quartiles",
    view_ctes("v_game") + _quartiles_sql("season_type") + " UNION ALL " + _quartiles_sql("team_name_home")
    + " UNION ALL " + _quartiles_sql("season_id"),
)
def grouped_quartiles(t):
    """Quartiles by season, season type and home team; the away team is not a column here."""
    return _rounded(stats.grouped_quartiles(t["v_game"], FEATURES, _HUES, max_values=MAX_HUE_VALUES), "q1", "median", "q3")


@query(
    "column_quantiles",
    """SELECT 'all' AS "group", 'l_extendedprice' AS "column", count(*) AS n,
  round(quantile_cont(l_extendedprice, 0.01), 4) AS p01, round(quantile_cont(l_extendedprice, 0.5), 4) AS p50,
  round(quantile_cont(l_extendedprice, 0.99), 4) AS p99 FROM lineitem""",
)
def column_quantiles(t):
    q = F.col("quantiles")
    return exact_quantiles(t["lineitem"], ["l_extendedprice"], (0.01, 0.5, 0.99)).select(
        "group", "column", "n", *[F.round(q[i], 4).alias(n) for i, n in enumerate(("p01", "p50", "p99"))]
    )


def _density_sql(table: str, column: str) -> str:
    return f"""WITH s AS (
  SELECT count(*) AS n, min(v) AS lo, max(v) AS hi, stddev_samp(v) * pow(count(*), -0.2) AS h
  FROM (SELECT CAST({column} AS DOUBLE) AS v FROM {table}) WHERE v IS NOT NULL),
counted AS (SELECT CAST({column} AS DOUBLE) AS v, count(*) AS w FROM {table} WHERE {column} IS NOT NULL GROUP BY 1),
grid AS (SELECT CAST(p AS INTEGER) AS point, lo + p * ((hi - lo) / 199) AS x, n, h FROM s, range(200) AS r(p))
SELECT point, round(x, 6) AS x,
  round(10000 * sum(w * exp(-0.5 * pow((x - v) / h, 2))) / (any_value(n) * any_value(h) * sqrt(2 * pi())), 6)
    AS density_e4
FROM grid, counted GROUP BY point, x"""


def _density(df: DataFrame) -> DataFrame:
    return df.select("point", F.round("x", 6).alias("x"), F.round(F.col("density") * 10000, 6).alias("density_e4"))


@query("kernel_density", checked("v_game", sql=_density_sql("v_game", "reb_home")))
def kernel_density(t):
    return _density(stats.kernel_density(t["v_game"], "reb_home"))


@query("kernel_density_continuous", _density_sql("customer", "c_acctbal"))
def kernel_density_continuous(t):
    return _density(stats.kernel_density(t["customer"], "c_acctbal"))


_YJ_COLUMNS = ("fg_pct_home", "reb_home", "pts_home")


def _transform_sql(v: str, lam: str) -> str:
    return f"""CASE WHEN {v} >= 0 THEN CASE WHEN {lam} = 0 THEN ln(1 + {v}) ELSE (pow({v} + 1, {lam}) - 1) / {lam} END
  ELSE CASE WHEN {lam} = 2 THEN -ln(1 - {v}) ELSE -(pow(1 - {v}, 2 - {lam}) - 1) / (2 - {lam}) END END"""


_YJ_GRID = f"""long AS ({_long_sql("SELECT * FROM v_game", columns=_YJ_COLUMNS)}
  UNION ALL SELECT 'all', 'c_acctbal', c_acctbal FROM customer),
counted AS (SELECT "column", v, count(*) AS w FROM long GROUP BY ALL),
grid AS (SELECT CAST(i - 20 AS DOUBLE) / 10 AS "lambda" FROM range(61) AS r(i)),
middle AS (SELECT "column", avg(v) AS m FROM long GROUP BY "column"),
moments AS (
  SELECT "column", "lambda", sum(w) AS n, any_value(a) AS a, sum(w * (t - a)) AS s1, sum(w * (t - a) * (t - a)) AS s2,
    sum(w * j) AS jacobian
  FROM (SELECT "column", "lambda", w, {_transform_sql("v", '"lambda"')} AS t, {_transform_sql("m", '"lambda"')} AS a,
          sign(v) * ln(1 + abs(v)) AS j
        FROM counted JOIN middle USING ("column"), grid)
  GROUP BY ALL),
scores AS (
  SELECT "column", "lambda", CAST(n AS BIGINT) AS n, a + s1 / n AS mean, (s2 - s1 * s1 / n) / n AS var,
    -n / 2 * ln((s2 - s1 * s1 / n) / n) + ("lambda" - 1) * jacobian AS loglik
  FROM moments)"""


@query(
    "yj_loglik_grid",
    checked("v_game", sql=f"""WITH {_YJ_GRID} SELECT "column", "lambda", n, round(loglik, 3) AS loglik FROM scores"""),
)
def yj_loglik_grid(t):
    """Log-likelihood of the power transform on the whole exponent grid."""
    parts = []
    for df, columns in ((t["v_game"], _YJ_COLUMNS), (t["customer"], ("c_acctbal",))):
        ranges = stats.ranges_of(df, columns)
        means = {c: row["mean"] for c, row in ranges.items()}
        grid = {c: stats.lambda_grid() for c in columns}
        parts.append(stats.log_likelihood(stats.weighted_values(df, ranges), grid, means))
    return reduce(DataFrame.unionByName, parts).select("column", "lambda", "n", F.round("loglik", 3).alias("loglik"))


_TRANSFORMED = f"""{_YJ_GRID}, best AS (
  SELECT "column", arg_max("lambda", loglik) AS "lambda", arg_max(mean, loglik) AS mean, arg_max(var, loglik) AS var
  FROM scores GROUP BY "column"),
transformed AS (SELECT game_id, season_type, {", ".join(
    f'''round((SELECT ({_transform_sql(f"CAST({c} AS DOUBLE)", chr(34) + "lambda" + chr(34))} - mean) / sqrt(var)
  FROM best WHERE "column" = '{c}'), 4) + 0.0 AS {c}''' for c in _YJ_COLUMNS)}
FROM v_game)"""


def _transformed(t) -> DataFrame:
    games = t["v_game"].select("game_id", "season_type", *_YJ_COLUMNS)
    fitted = stats.fit_yeo_johnson(games, _YJ_COLUMNS, refine=False)
    return _rounded(stats.apply_yeo_johnson(games, fitted), *_YJ_COLUMNS)


@query("yj_transform", checked("v_game", sql=f"WITH {_TRANSFORMED} SELECT * EXCLUDE (season_type) FROM transformed"))
def yj_transform(t):
    """Columns transformed with the best exponent of the grid, and standardised."""
    return _transformed(t).drop("season_type")


# The same names as above are taken by the values before the transform.
_BEFORE = _TRANSFORMED.replace("long AS (", "raw AS (", 1).replace("FROM long", "FROM raw") + ", "
_BEFORE = _BEFORE.replace("grid AS (", "exponents AS (", 1).replace(", grid)", ", exponents)")
_AFTER = _long_sql("SELECT * FROM transformed", columns=_YJ_COLUMNS)


@query("histogram_transformed", _histogram_sql("'all'", _AFTER, _BEFORE))
def histogram_transformed(t):
    return stats.histogram(_transformed(t), _YJ_COLUMNS)


@query("box_summary_transformed", _box_sql(_AFTER, _BEFORE, 6))
def box_summary_transformed(t):
    return _rounded(stats.box_summary(_transformed(t), _YJ_COLUMNS), "q1", "median", "q3", digits=6)


@query("grouped_box_transformed", _box_sql(_long_sql("SELECT * FROM transformed", "season_type", _YJ_COLUMNS), _BEFORE, 6))
def grouped_box_transformed(t):
    """Distributions by season type of the values of the same rows, transformed."""
    return _rounded(stats.box_summary(_transformed(t), _YJ_COLUMNS, by="season_type"), "q1", "median", "q3", digits=6)


def _refined_sql(name: str, grid: str) -> str:
    """Scores of a grid of exponents per column, under a name."""
    return f"""{name}_grid AS ({grid}),
{name} AS (
  SELECT "column", "lambda", a + s1 / n AS mean, (s2 - s1 * s1 / n) / n AS var,
    -n / 2 * ln((s2 - s1 * s1 / n) / n) + ("lambda" - 1) * jacobian AS loglik
  FROM (
    SELECT "column", "lambda", sum(w) AS n, any_value(a) AS a, sum(w * (t - a)) AS s1, sum(w * (t - a) * (t - a)) AS s2,
      sum(w * j) AS jacobian
    FROM (SELECT "column", "lambda", w, {_transform_sql("v", '"lambda"')} AS t, {_transform_sql("m", '"lambda"')} AS a,
            sign(v) * ln(1 + abs(v)) AS j
          FROM counted JOIN middle USING ("column") JOIN {name}_grid USING ("column"))
    GROUP BY ALL))"""


def _around_sql(scores: str, step: float, digits: int) -> str:
    return f"""SELECT "column", round(best - 10 * {step} + i * {step}, {digits}) AS "lambda"
  FROM (SELECT "column", arg_max("lambda", loglik) AS best FROM {scores} GROUP BY "column"), range(21) AS r(i)"""


_VERTEX_SQL = """SELECT "column", best + coalesce(0.5 * (a - d) / (a - 2 * b + d) * 0.001, 0) AS "lambda"
  FROM (SELECT "column", arg_max("lambda", loglik) AS best, arg_max(a, loglik) AS a, max(loglik) AS b, arg_max(d, loglik) AS d
    FROM (SELECT *, lag(loglik) OVER w AS a, lead(loglik) OVER w AS d FROM finer WINDOW w AS (PARTITION BY "column" ORDER BY "lambda"))
    GROUP BY "column")"""


@query(
    "yj_fit",
    checked("v_game", sql=f"""
WITH {_YJ_GRID}, {_refined_sql("fine", _around_sql("scores", 0.01, 3))}, {_refined_sql("finer", _around_sql("fine", 0.001, 4))},
{_refined_sql("vertex", _VERTEX_SQL)}
SELECT "column", round("lambda", 4) AS "lambda", CAST(printf('%.5e', mean) AS DOUBLE) AS mean, CAST(printf('%.5e', sqrt(var)) AS DOUBLE) AS std
FROM vertex WHERE "column" <> 'c_acctbal'"""),
)
def yj_fit(t):
    """The refined exponent per column: two finer grids and a parabola."""
    fitted = stats.fit_yeo_johnson(t["v_game"], _YJ_COLUMNS)
    rows = [(c, f["lambda"], f["mean"], f["std"]) for c, f in sorted(fitted.items())]
    found = t.spark.createDataFrame(rows, "column string, lambda double, mean double, std double")
    digits = {c: F.format_string("%.5e", c).cast("double") for c in ("mean", "std")}
    return found.withColumns({"lambda": F.round("lambda", 4), **digits})


_PHIK_COLUMNS = ("season_type", "team_name_home", "wl_home", "fg_pct_home", "reb_home", "pts_home")
_PHIK_INTERVALS = ("fg_pct_home", "reb_home", "pts_home")
_MATRIX_COLUMNS = (*_PHIK_COLUMNS, "season_id", "game_date_est")
_NEAR_COLUMNS = (*_PHIK_COLUMNS, "season_id", "fg_pct_twice", "year")
_NEAR = "*, fg_pct_home * 2 + 1 AS fg_pct_twice, year(game_date_est) AS year"


def _bin_sql(c: str, intervals=_PHIK_INTERVALS) -> str:
    if c not in intervals:
        return f"CAST({c} AS VARCHAR)"
    low, high = f"min(CAST({c} AS DOUBLE)) OVER ()", f"max(CAST({c} AS DOUBLE)) OVER ()"
    return f"CAST(greatest(CAST(ceil((CAST({c} AS DOUBLE) - {low}) / ({high} - {low}) * 10) AS BIGINT), 1) AS VARCHAR)"


def _chi2_sql(a: str, b: str, digits: int = 4) -> str:
    return f"""SELECT '{a}' AS column_1, '{b}' AS column_2, CAST(sum(o) AS BIGINT) AS n, count(DISTINCT a) AS n_1,
  count(DISTINCT b) AS n_2, round(greatest(sum(o) * (sum(o * o / (r * c)) - 1), 0), {digits}) AS chi2
FROM (SELECT a, b, CAST(o AS DOUBLE) AS o, sum(o) OVER (PARTITION BY a) AS r, sum(o) OVER (PARTITION BY b) AS c
  FROM (SELECT {a} AS a, {b} AS b, count(*) AS o FROM binned WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY ALL))"""


def _binned_sql(columns, source: str = "v_game", intervals=_PHIK_INTERVALS) -> str:
    return f"binned AS (SELECT {', '.join(f'{_bin_sql(c, intervals)} AS {c}' for c in columns)} FROM {source})"


def _tables_sql(columns, digits: int) -> str:
    return " UNION ALL ".join(_chi2_sql(a, b, digits) for i, a in enumerate(columns) for b in columns[i + 1:])


@query("contingency_chi2", checked("v_game", sql=f"WITH {_binned_sql(_PHIK_COLUMNS)}\n{_tables_sql(_PHIK_COLUMNS, 4)}"))
def contingency_chi2(t):
    table = phik.binned(t["v_game"].select(*_PHIK_COLUMNS), _PHIK_INTERVALS)
    return _rounded(phik.contingency_chi2(table), "chi2")


# The SQL finds the correlation another way than the query: cells of the binned
# normal distribution are sums of powers of the correlation times products of
# Hermite integrals of the bins, and the interval is halved 26 times.
_TERMS = 110


def _phik_sql(columns, result: str, source: str = "v_game", intervals=_PHIK_INTERVALS) -> str:
    return checked("v_game", sql=f"""
WITH {_binned_sql(columns, source, intervals)},
tables AS MATERIALIZED ({_tables_sql(columns, 9)}),
noises AS MATERIALIZED (SELECT *, least(n_1, n_2) AS s, greatest(n_1, n_2) AS l, (n_1 - 1) * (n_2 - 1) AS noise,
  n * (least(n_1, n_2) - 1) AS most FROM tables WHERE n_1 > 1 AND n_2 > 1),
sizes AS (SELECT s AS m FROM noises UNION SELECT l FROM noises),
edges AS (SELECT m, i, -5 + 10.0::DOUBLE * i / m AS x FROM sizes, unnest(range(m + 1)) AS r(i)),
hermite AS (
  SELECT m, i, x, 0 AS k, 1.0::DOUBLE AS h, 0.0::DOUBLE AS h_before FROM edges
  UNION ALL SELECT m, i, x, k + 1, (x * h - sqrt(k) * h_before) / sqrt(k + 1), h FROM hermite WHERE k < {_TERMS}),
integrals AS (
  SELECT m, i, k + 1 AS k, -h * exp(-x * x / 2) / sqrt(2 * pi()) / sqrt(k + 1) AS v FROM hermite
  UNION ALL
  SELECT m, i, 0, 0.5 + sign(x) * exp(-x * x / 2) / sqrt(2 * pi()) * list_sum(list_transform(range(90), lambda q:
    CASE WHEN x = 0 THEN 0 ELSE exp((2 * q + 1) * ln(abs(x)) - (q + 1) * ln(2) - lgamma(q + 1.5) + ln(pi()) / 2) END))
  FROM edges),
steps AS (SELECT m, i, k, lead(v) OVER (PARTITION BY m, k ORDER BY i) - v AS v FROM integrals),
bins AS MATERIALIZED (SELECT m, i, list(v ORDER BY k) AS v, max(v) FILTER (WHERE k = 0) AS mass
  FROM steps WHERE v IS NOT NULL GROUP BY m, i),
shapes AS (SELECT DISTINCT s, l FROM noises),
phi AS MATERIALIZED (SELECT m, i, v FROM integrals WHERE k = 0),
shared AS (
  SELECT s, l, a.i AS i, b.i AS j, a.mass AS r, b.mass AS c,
    (CASE WHEN (a.i + 1) * l <= (b.i + 1) * s THEN pa.v ELSE pb.v END)
    - (CASE WHEN a.i * l >= b.i * s THEN qa.v ELSE qb.v END) AS p
  FROM shapes JOIN bins a ON a.m = s JOIN bins b ON b.m = l AND a.i * l < (b.i + 1) * s AND b.i * s < (a.i + 1) * l
  JOIN phi pa ON pa.m = s AND pa.i = a.i + 1 JOIN phi pb ON pb.m = l AND pb.i = b.i + 1
  JOIN phi qa ON qa.m = s AND qa.i = a.i JOIN phi qb ON qb.m = l AND qb.i = b.i),
full_model AS (SELECT s, l, sum(p * p / (r * c)) - 1 AS whole FROM shared GROUP BY s, l),
search AS (
  SELECT column_1, column_2, s, l, (chi2 - noise) / (most - noise) * whole AS wanted,
    0.0::DOUBLE AS low, 1.0::DOUBLE AS high, 0 AS step
  FROM noises JOIN full_model USING (s, l) WHERE chi2 > noise AND chi2 < most AND noise < most
  UNION ALL
  SELECT column_1, column_2, s, l, wanted, CASE WHEN model < wanted THEN (low + high) / 2 ELSE low END,
    CASE WHEN model < wanted THEN high ELSE (low + high) / 2 END, step + 1
  FROM (
    SELECT column_1, column_2, s, l, wanted, low, high, step, sum(p * p / (r * c)) - 1 AS model
    FROM (
      SELECT *, sum(p) OVER (PARTITION BY column_1, column_2, i) AS r, sum(p) OVER (PARTITION BY column_1, column_2, j) AS c
      FROM (
        SELECT h.*, b.i AS j, greatest(list_inner_product(h.w, b.v), 0) AS p
        FROM (SELECT search.*, a.i AS i, list_transform(a.v, lambda y, k: y * pow((low + high) / 2, k - 1)) AS w
              FROM search JOIN bins a ON a.m = s WHERE step < 26) h
        JOIN bins b ON b.m = l))
    WHERE p > 0 GROUP BY ALL)),
solved AS (
  SELECT t.column_1, t.column_2, t.n, t.n_1, t.n_2, t.chi2,
    CASE WHEN t.n_1 < 2 OR t.n_2 < 2 OR t.chi2 <= noise THEN 0.0 WHEN t.chi2 >= most OR noise >= most THEN 1.0
      ELSE (low + high) / 2 END AS phik
  FROM tables t LEFT JOIN noises USING (column_1, column_2)
  LEFT JOIN (SELECT * FROM search WHERE step = 26) USING (column_1, column_2))
{result}""").replace("WITH ", "WITH RECURSIVE ", 1)


@query("phik_matrix", _phik_sql(_MATRIX_COLUMNS, """SELECT column_1, column_2, n, n_1, n_2, round(chi2, 4) AS chi2,
  CAST(round(phik, 3) AS DOUBLE) AS phik FROM solved"""))
def phik_matrix(t):
    """Correlation of every pair, to three places."""
    pairs = phik.phik_pairs(t["v_game"].select(*_MATRIX_COLUMNS), _PHIK_INTERVALS)
    return _rounded(pairs, "chi2").withColumn("phik", F.round("phik", 3))


@query("high_corr_pairs", _phik_sql(_NEAR_COLUMNS, f"""SELECT column_1, column_2, CAST(round(phik, 4) AS DOUBLE) AS correlation
FROM solved WHERE phik >= {CORRELATION_THRESHOLD}""", f"(SELECT {_NEAR} FROM v_game)", (*_PHIK_INTERVALS, "fg_pct_twice")))
def high_corr_pairs(t):
    """Pairs of columns that say nearly the same; the season follows from the game date."""
    games = t["v_game"].selectExpr(*_NEAR.split(", ")).select(*_NEAR_COLUMNS)
    return phik.high_correlations(phik.phik_pairs(games, [*_PHIK_INTERVALS, "fg_pct_twice"]))


@query("phik_before_after", None)
def phik_before_after(t):
    """Correlations of the raw and of the transformed columns side by side."""
    return eda.correlations_before_after(t["v_game"].drop("game_date_est"))


def _density_of_ids_sql(table: str, column: str) -> str:
    return f"""WITH ids AS (SELECT DISTINCT {column} AS id FROM {table} WHERE {column} IS NOT NULL),
gaps AS (SELECT id, id - lag(id) OVER (ORDER BY id) AS gap FROM ids)
SELECT count(*) AS n_ids, min(id) AS min_id, max(id) AS max_id, min(gap) AS min_gap, max(gap) AS max_gap,
  count(*) FILTER (WHERE gap > 1) AS n_gaps, max(id) - min(id) + 1 - count(*) AS n_missing,
  CAST(max(id) - min(id) AS DOUBLE) / (count(*) - 1) AS mean_gap FROM gaps"""


@query("id_density", _density_of_ids_sql("lineitem", "l_orderkey"))
def id_density(t):
    return stats.id_density(t["lineitem"], "l_orderkey")
