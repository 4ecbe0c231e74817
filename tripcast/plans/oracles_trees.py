"""DuckDB SQL that grows boosted trees itself: bins from cell counts, then one
common table expression per split, best leaf first (``tree``), or for whole
ensembles a recursion that goes on by a level a step (``boosted``).

The SQL is written from the rule, not from the Spark code; shared are the
fixed values, the rows, and which features a tree may use.
"""

from __future__ import annotations

from tripcast import schema as S
from tripcast.operators.leafwise import DEFAULT_PARAMS, features_of
from tripcast.plans import common as Q
from tripcast.plans.oracle_base import _INC, _MOD, _MUL, below, mix
from tripcast.plans.oracles_models import BASE, BASELINE
from tripcast.plans.queries_models import SMALL

P = DEFAULT_PARAMS
N = len(S.FEATURE_COLUMNS)
PICK = "tpep_pickup_datetime"

MATRIX = BASE + f""",
 mx AS MATERIALIZED (SELECT row_number() OVER () AS r, *, ln(1 + trip_duration) - ln(1 + baseline) AS label
        FROM (SELECT *, {BASELINE} AS baseline, {mix(0)} AS draw FROM trips_featp CROSS JOIN coef)),
 vals AS MATERIALIZED (SELECT r, unnest(range({N})) AS f,
        unnest([{', '.join(f'CAST({c} AS DOUBLE)' for c in S.FEATURE_COLUMNS)}]) AS x FROM mx)"""
TRAIN = f"pickup_year < {Q.TRAIN_BEFORE_YEAR}"
TEST = f"pickup_year >= {Q.TEST_FROM_YEAR}"


def soft(g: str) -> str:
    g = f"(({g}) / 65536.0)"
    return f"(CASE WHEN {g} > 0 THEN greatest({g} - {P['lambda_l1']}, 0.0) ELSE least({g} + {P['lambda_l1']}, 0.0) END)"


def worth(g: str, n: str) -> str:
    return f"({soft(g)} * {soft(g)} / ({n} + {P['lambda_l2']}))"


def bins(p: str, rows: str) -> str:
    """``{p}bin``: the bin of each value of the rows of ``mx`` that meet
    ``rows``; ``{p}edge``: each bin's largest value."""
    return f""",
 {p}val AS MATERIALIZED (SELECT r, f, x FROM vals WHERE r IN (SELECT r FROM mx WHERE {rows})),
 {p}rng AS (SELECT f, min(x) AS lo, max(x) AS hi FROM {p}val GROUP BY f),
 {p}cel AS (SELECT r, f, x, CASE WHEN hi = lo THEN 0 ELSE least(CAST(floor((x - lo) * 4096.0 / (hi - lo)) AS INTEGER), 4095) END AS c
        FROM {p}val JOIN {p}rng USING (f)),
 {p}cnt AS (SELECT f, c, count(*) AS n, max(x) AS top FROM {p}cel GROUP BY f, c),
 {p}num AS (SELECT f, c, top, CASE WHEN count(*) OVER (PARTITION BY f) <= {P['max_bin']} THEN c
        ELSE {P['max_bin']} * (sum(n) OVER (PARTITION BY f ORDER BY c) - n) // sum(n) OVER (PARTITION BY f) END AS g FROM {p}cnt),
 {p}edge AS (SELECT f, g, max(top) AS top, row_number() OVER (PARTITION BY f ORDER BY g) - 1 AS b FROM {p}num GROUP BY f, g),
 {p}bin AS MATERIALIZED (SELECT r, f, b FROM {p}cel JOIN {p}num USING (f, c) JOIN {p}edge USING (f, g))"""


def start(p: str, rows: str) -> str:
    """``{p}s0``: the score of every row before the first tree."""
    return f""",
 {p}s0 AS (SELECT r, (SELECT sum(CAST(round(label * 65536) AS BIGINT)) / count(*) / 65536.0 FROM mx WHERE {rows}) AS score FROM mx)"""


def tree(p: str, t: int, rows: str, bins_of: str, rate: str, leaves: int, use_leaves: str | None = None) -> str:
    """Tree number ``t``: from ``{p}s{t}`` to ``{p}s{t + 1}``, its nodes as
    ``{p}t{t}n{k}`` after k splits, the splits as ``{p}t{t}b{k}``.
    ``use_leaves``: SQL for a number of leaves below ``leaves``."""
    q = f"{p}t{t}"
    bag = f"(((draw + {t * 7919}) % {_MOD}) * {_MUL} + {_INC}) % {_MOD} < {P['bagging_fraction'] * _MOD}"
    chosen = ", ".join(map(str, features_of(t, N, P["feature_fraction"], 42)))
    out = f""",
 {q}n0 AS MATERIALIZED (SELECT r, 0 AS node, CAST(round_even((label - score) * 65536.0, 0) AS BIGINT) AS g, ({rows}) AND {bag} AS bag
        FROM mx JOIN {p}s{t} USING (r))"""
    for k in range(1, leaves):
        enough = f" AND {k} < {use_leaves}" if use_leaves else ""
        out += f""",
 {q}h{k} AS (SELECT node, f, b, sum(g) AS g, count(*) AS n FROM {q}n{k - 1} JOIN {bins_of}bin USING (r)
        WHERE bag AND f IN ({chosen}) GROUP BY node, f, b),
 {q}c{k} AS (SELECT node, f, b, sum(g) OVER w AS lg, sum(n) OVER w AS ln, sum(g) OVER (PARTITION BY node, f) AS g,
        sum(n) OVER (PARTITION BY node, f) AS n FROM {q}h{k} WINDOW w AS (PARTITION BY node, f ORDER BY b)),
 {q}b{k} AS MATERIALIZED (SELECT node, f, top, gain, n FROM (SELECT *, {worth('lg', 'ln')} + {worth('g - lg', 'n - ln')} - {worth('g', 'n')} AS gain
        FROM {q}c{k} WHERE ln >= {P['min_data_in_leaf']} AND n - ln >= {P['min_data_in_leaf']}) JOIN {bins_of}edge USING (f, b)
        WHERE gain > 0{enough} ORDER BY gain DESC, node, f, b LIMIT 1),
 {q}n{k} AS MATERIALIZED (SELECT a.r, CASE WHEN a.node = s.node THEN (CASE WHEN x <= s.top THEN {2 * k - 1} ELSE {2 * k} END)
        ELSE a.node END AS node, a.g, a.bag
        FROM {q}n{k - 1} a LEFT JOIN {q}b{k} s ON true LEFT JOIN vals v ON v.r = a.r AND v.f = s.f)"""
    return out + f""",
 {q}v AS (SELECT node, {rate} * {soft('sum(g)')} / (count(*) + {P['lambda_l2']}) AS value, count(*) AS n FROM {q}n{leaves - 1}
        WHERE bag GROUP BY node),
 {p}s{t + 1} AS MATERIALIZED (SELECT r, score + coalesce(value, 0.0) AS score FROM {p}s{t} JOIN {q}n{leaves - 1} USING (r)
        LEFT JOIN {q}v USING (node))"""


def ensemble(p: str, rows: str, rounds: int, rate: str, leaves: int, use_leaves: str | None = None) -> str:
    return bins(p, rows) + start(p, rows) + "".join(tree(p, t, rows, p, rate, leaves, use_leaves) for t in range(rounds))


SCORED = f"SELECT {PICK}, trip_duration, baseline * exp(score) AS p FROM mx JOIN {{scores}} USING (r) WHERE {TEST}"
ROUNDS = P["num_boost_round"]
MARK = -1_000_000        # of the rows that hold a prefix' metrics


def bag(t: str) -> str:
    return f"(((draw + ({t}) * 7919) % {_MOD}) * {_MUL} + {_INC}) % {_MOD} < {P['bagging_fraction'] * _MOD}"


def boosted(p: str, rows: str, runs: str) -> str:
    """Whole ensembles, one per row (run, rate, leaves) of ``runs``, on the
    rows of ``mx`` that meet ``rows``: ``{p}last`` (run, r, score) and
    ``{p}prefixes`` (run, t, loss, rmse, mae, r2), the metrics of the test rows
    after t trees.

    ``{p}grown`` holds where each row is: its node (the turns taken from the
    root), and the splits of the tree in growth as rows of their own, r < 0.
    A step gets the rows that the last one moved and splits their nodes; a run
    that splits no more has its tree, scores its rows and begins the next.  Best-first growth makes its
    splits in the order of ``path``: the least gain on the way from the root,
    then the least after that, and so on; so the first ``leaves - 1`` are its
    splits, and none that comes later has to be gone on with."""
    state = "run, r, node, t, score, g, bag, path"
    begun = f"CAST(round_even((label - score) * 65536.0, 0) AS BIGINT) AS g, train AND {{bag}} AS bag, CAST(NULL AS DOUBLE[]) AS path"
    use = ", ".join(f"({t}, {[f + 1 for f in features_of(t, N, P['feature_fraction'], 42)]})" for t in range(ROUNDS))
    least = P["min_data_in_leaf"]
    return bins(p, rows) + f""",
 {p}runs AS MATERIALIZED (SELECT CAST(run AS INTEGER) AS run, CAST(rate AS DOUBLE) AS rate, CAST(leaves AS INTEGER) AS leaves FROM ({runs})),
 {p}use(t, fs) AS MATERIALIZED (VALUES {use}),
 {p}bs AS (SELECT r, list(CAST(b AS UTINYINT) ORDER BY f) AS bs FROM {p}bin GROUP BY r),
 {p}w AS MATERIALIZED (SELECT r, label, draw, trip_duration, baseline, {rows} AS train, {TEST} AS test, bs,
        [{', '.join(f'CAST({c} AS DOUBLE)' for c in S.FEATURE_COLUMNS)}] AS xs FROM mx LEFT JOIN {p}bs USING (r) WHERE ({rows}) OR ({TEST})),
 {p}base AS (SELECT sum(CAST(round(label * 65536) AS BIGINT)) / count(*) / 65536.0 AS score FROM {p}w WHERE train),
 {p}grown({state}) USING KEY (run, r) AS (
  SELECT run, r, '' AS node, 0 AS t, score, {begun.format(bag=bag('0'))} FROM {p}w CROSS JOIN {p}runs CROSS JOIN {p}base
  UNION ALL
  (WITH cur AS MATERIALIZED (SELECT * FROM {p}grown WHERE t < {ROUNDS} AND r > {MARK}),
    long AS (SELECT run, node, g, unnest(fs) AS f, unnest(list_select(bs, fs)) AS b FROM cur JOIN {p}w USING (r) JOIN {p}use USING (t)
        WHERE bag),
    hist AS (SELECT run, node, f, b, sum(g) AS g, count(*) AS n FROM long GROUP BY run, node, f, b),
    cuts AS (SELECT run, node, f, b, sum(g) OVER w AS lg, sum(n) OVER w AS ln, sum(g) OVER (PARTITION BY run, node, f) AS g,
        sum(n) OVER (PARTITION BY run, node, f) AS n FROM hist WINDOW w AS (PARTITION BY run, node, f ORDER BY b)),
    best AS (SELECT run, node, f, b, {worth('lg', 'ln')} + {worth('g - lg', 'n - ln')} - {worth('g', 'n')} AS gain
        FROM cuts WHERE ln >= {least} AND n - ln >= {least} AND gain > 0
        QUALIFY row_number() OVER (PARTITION BY run, node ORDER BY gain DESC, f, b) = 1),
    old AS MATERIALIZED (SELECT run, node, path FROM cur WHERE r < 0),
    fresh AS (SELECT best.run, best.node, best.f, top, CASE WHEN old.path IS NULL THEN [-gain]
        ELSE list_filter(old.path, lambda m: m >= -gain) || [-gain] END AS path
        FROM best JOIN {p}edge e ON e.f = best.f - 1 AND e.b = best.b
        LEFT JOIN old ON old.run = best.run AND best.node <> '' AND old.node = left(best.node, -1)),
    kept AS MATERIALIZED (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY run ORDER BY path, node) AS place
        FROM (SELECT run, node, NULL AS f, NULL AS top, path FROM old UNION ALL SELECT * FROM fresh)) JOIN {p}runs USING (run) WHERE place < leaves),
    growing AS MATERIALIZED (SELECT DISTINCT run FROM kept WHERE f IS NOT NULL),
    done AS MATERIALIZED (SELECT * FROM recurring.{p}grown WHERE r >= 0 AND run IN (SELECT run FROM cur) AND run NOT IN (FROM growing)),
    leaf AS MATERIALIZED (SELECT c.run, c.node, left(c.node, count(kept.node)) AS leaf FROM (SELECT DISTINCT run, node FROM done) c
        LEFT JOIN kept ON kept.run = c.run AND starts_with(c.node, kept.node) GROUP BY c.run, c.node),
    worth AS (SELECT run, leaf, rate * {soft('sum(g)')} / (count(*) + {P['lambda_l2']}) AS value
        FROM done JOIN leaf USING (run, node) JOIN {p}runs USING (run) WHERE bag GROUP BY run, leaf, rate),
    scored AS MATERIALIZED (SELECT run, r, t + 1 AS t, score + coalesce(value, 0.0) AS score
        FROM done JOIN leaf USING (run, node) LEFT JOIN worth USING (run, leaf))
   SELECT run, r, node || CASE WHEN xs[kept.f] <= kept.top THEN '0' ELSE '1' END, t, score, g, bag, NULL
        FROM cur JOIN kept USING (run, node) JOIN {p}w USING (r) WHERE kept.f IS NOT NULL
   UNION ALL SELECT run, -place, node, 0, NULL, NULL, NULL, path FROM kept WHERE run IN (FROM growing)
   UNION ALL SELECT run, r, '', t, score, {begun.format(bag=bag('t'))} FROM scored JOIN {p}w USING (r)
   UNION ALL SELECT run, {MARK} - t, '', t, NULL, NULL, NULL, [avg((label - score)^2), sqrt(avg((trip_duration - p)^2)),
        avg(abs(trip_duration - p)), 1 - sum((trip_duration - p)^2) / (count(*) * var_pop(trip_duration))]
        FROM (SELECT run, t, label, score, trip_duration, baseline * exp(score) AS p FROM scored JOIN {p}w USING (r) WHERE test) GROUP BY run, t)),
 {p}all AS MATERIALIZED (SELECT run, r, t, score, path FROM {p}grown),
 {p}last AS (SELECT run, r, score FROM {p}all WHERE r >= 0),
 {p}prefixes AS (SELECT run, t, path[1] AS loss, path[2] AS rmse, path[3] AS mae, path[4] AS r2 FROM {p}all WHERE r < {MARK})"""


LEAVES = SMALL["num_leaves"]
RATE = str(P["stepSize"])
RECURSIVE = MATRIX.replace("WITH", "WITH RECURSIVE", 1)
WHOLE = RECURSIVE + boosted("a", TRAIN, f"SELECT 0 AS run, {RATE} AS rate, {P['num_leaves']} AS leaves")


def first_nodes() -> str:
    splits = "\nUNION ALL ".join(f"SELECT {k} AS k, node, f, top, gain, n FROM at0b{k}" for k in range(1, LEAVES))
    return f"""
, splits AS ({splits}),
 nodes AS (SELECT 0 AS node UNION ALL SELECT 2 * k - 1 FROM splits UNION ALL SELECT 2 * k FROM splits)
SELECT CAST(nodes.node AS INTEGER) AS node, coalesce(f, -1) AS feature, round(coalesce(top, 0.0), 5) AS threshold,
       CASE WHEN k IS NULL THEN nodes.node ELSE 2 * k - 1 END AS left, CASE WHEN k IS NULL THEN nodes.node ELSE 2 * k END AS right,
       round(coalesce(CASE WHEN k IS NULL THEN value END, 0.0), 5) AS value, round(coalesce(gain, 0.0), 5) AS gain,
       CAST(coalesce(splits.n, at0v.n) AS BIGINT) AS n
FROM nodes LEFT JOIN splits ON splits.node = nodes.node LEFT JOIN at0v ON at0v.node = nodes.node"""


def continued() -> str:
    years = range(1995, Q.TRAIN_BEFORE_YEAR)
    sql = MATRIX + start("y", f"pickup_year = {years[0]}")
    for t, year in enumerate(years):
        rows = f"pickup_year = {year}"
        sql += bins(f"y{year}", rows) + tree("y", t, rows, f"y{year}", RATE, LEAVES)
    return sql + f"""
SELECT {PICK}, round(trip_duration, 4) AS trip_duration, round(p, 4) AS predicted_seconds
FROM ({SCORED.format(scores=f'ys{len(years)}')})"""


def candidates(rows: str) -> str:
    """``runs``: every candidate of the grid cut to its best prefix and scored;
    ``best``: the one of the least error (to 6 digits; the earliest of equal
    ones)."""
    grid = " UNION ALL ".join(f"SELECT {i} AS run, {g['stepSize']} AS rate, {g['num_leaves']} AS leaves" for i, g in enumerate(S.GBT_GRID))
    return boosted("a", rows, grid) + """,
 runs AS MATERIALIZED (SELECT run AS run_no, rate AS stepSize, leaves AS num_leaves, t AS best_iteration, rmse, mae, r2
        FROM aprefixes JOIN aruns USING (run) QUALIFY row_number() OVER (PARTITION BY run ORDER BY round(loss, 12), t) = 1),
 best AS MATERIALIZED (SELECT * FROM runs ORDER BY round(rmse, 6), run_no LIMIT 1)"""


SCORE_COLUMNS = ", ".join(f"round({c}, 4) AS {c}" for c in ("rmse", "mae", "r2"))


def training_run() -> str:
    tune, final = (f"{TRAIN} AND {below(seed, rate)}" for rate, seed in (S.TUNE_SAMPLE, S.FINAL_SAMPLE))
    return RECURSIVE + candidates(tune) + boosted("f", final, "SELECT 0 AS run, stepSize AS rate, num_leaves AS leaves FROM best") + f"""
SELECT 'train' AS run_id, CAST(run_no AS BIGINT) AS run_no, CAST(stepSize AS DOUBLE) AS stepSize, CAST(num_leaves AS DOUBLE) AS num_leaves,
       {SCORE_COLUMNS} FROM runs
UNION ALL SELECT 'train', {len(S.GBT_GRID)}, CAST(stepSize AS DOUBLE), CAST(num_leaves AS DOUBLE), round(m.rmse, 4), round(m.mae, 4), round(m.r2, 4)
FROM (SELECT * FROM fprefixes WHERE t = {ROUNDS}) m CROSS JOIN best"""


ORACLES = {
    "tree_first": MATRIX + ensemble("a", TRAIN, 1, RATE, LEAVES) + first_nodes(),
    "tree_continued": continued(),
    "tree_grid": RECURSIVE + candidates(TRAIN) + f"""
SELECT CAST(run_no AS BIGINT) AS run_no, CAST(stepSize AS DOUBLE) AS stepSize, CAST(num_leaves AS DOUBLE) AS num_leaves,
       CAST(best_iteration AS DOUBLE) AS best_iteration, {SCORE_COLUMNS}, run_no = (SELECT run_no FROM best) AS is_best FROM runs""",
    "tree_predict": WHOLE + f"""
SELECT {PICK}, round(trip_duration, 4) AS trip_duration, round(p, 4) AS predicted_seconds, round(p / 60.0, 4) AS duration_minutes
FROM ({SCORED.format(scores='alast')})""",
    "tree_round_trip": BASE + "SELECT count(*) AS n, 0 AS n_changed FROM te",
    "tree_metrics": WHOLE + f"""
SELECT (SELECT count(*) FROM te) AS n, {SCORE_COLUMNS} FROM aprefixes WHERE t = {ROUNDS}""",
    "tree_training_run": training_run(),
}
