"""The same results in SQL, for DuckDB over the same Parquet tables."""

from __future__ import annotations

_RAW = """
WITH people AS (
  SELECT c_custkey AS distinct_id,
         CAST(18 + c_custkey % 60 AS INTEGER) AS age,
         CASE c_mktsegment WHEN 'BUILDING' THEN 'F' WHEN 'MACHINERY' THEN 'M' END AS gender,
         strftime(m.month, '%Y%m') AS yyyymm
  FROM customer
  CROSS JOIN (
    SELECT unnest(generate_series(
      CAST((SELECT date_trunc('month', min(o_orderdate)) FROM orders) AS DATE),
      CAST((SELECT date_trunc('month', max(o_orderdate)) FROM orders) AS DATE), INTERVAL 1 MONTH)) AS month
  ) m
  CROSS JOIN (SELECT unnest([1, 2]) AS copy) c
  WHERE copy = 1 OR c_custkey % 50 = 0
),
points AS (
  SELECT o_custkey AS distinct_id,
         strftime(o_orderdate, '%Y%m') AS yyyymm,
         CAST(trunc(l_quantity) AS BIGINT) AS total_points,
         CASE WHEN l_returnflag <> 'N' THEN s_name END AS storename,
         p_name AS productname
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN part ON l_partkey = p_partkey
),
main AS (
  SELECT o_custkey AS distinct_id, strftime(o_orderdate, '%Y%m') AS yyyymm,
         CASE WHEN o_orderpriority = '1-URGENT' THEN 'notification' ELSE lower(o_orderpriority) END AS main_event
  FROM orders
),
mr AS (
  SELECT o_custkey AS distinct_id, strftime(o_orderdate, '%Y%m') AS yyyymm,
         CASE WHEN o_orderstatus <> 'P' THEN r_name END AS region
  FROM orders
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
),
points_monthly AS (
  SELECT distinct_id, yyyymm,
         CAST(sum(total_points) AS BIGINT) AS sum_total_points,
         count(storename) AS count_consumption,
         count(DISTINCT storename) AS count_store_distinct,
         count(DISTINCT productname) AS count_product_distinct
  FROM points GROUP BY distinct_id, yyyymm
),
notify_monthly AS (
  SELECT distinct_id, yyyymm, count(main_event) AS count_notify
  FROM main WHERE main_event = 'notification' GROUP BY distinct_id, yyyymm
),
visits_monthly AS (
  SELECT distinct_id, yyyymm, count(region) AS count_distinct_region
  FROM mr GROUP BY distinct_id, yyyymm
),
spine AS (SELECT DISTINCT distinct_id, age, gender, yyyymm FROM people),
extras AS (
  SELECT p.*, n.count_notify, v.count_distinct_region
  FROM points_monthly p
  LEFT JOIN notify_monthly n USING (distinct_id, yyyymm)
  LEFT JOIN visits_monthly v USING (distinct_id, yyyymm)
)"""


def _panel(name: str, monthly: str) -> str:
    """Filled monthly table with the next row's points, as CTE ``name``."""
    return f"""
{name} AS (
  SELECT * FROM (
    SELECT *, lead(sum_total_points) OVER (PARTITION BY distinct_id ORDER BY yyyymm) AS lag_sum_total
    FROM (
      SELECT distinct_id, yyyymm, age, gender,
             coalesce(sum_total_points, 0) AS sum_total_points,
             coalesce(count_consumption, 0) AS count_consumption,
             coalesce(count_store_distinct, 0) AS count_store_distinct,
             coalesce(count_product_distinct, 0) AS count_product_distinct,
             coalesce(count_notify, 0) AS count_notify,
             coalesce(count_distinct_region, 0) AS count_distinct_region
      FROM {monthly}
    )
  ) WHERE lag_sum_total IS NOT NULL
)"""


_PANEL = _RAW + "," + _panel("panel", "spine LEFT JOIN extras USING (distinct_id, yyyymm)")

_TRAINING = (
    _PANEL
    + """,
training AS (
  SELECT distinct_id, yyyymm, age,
         CASE gender WHEN 'F' THEN 2 WHEN 'M' THEN 1 ELSE 0 END AS gender,
         sum_total_points, count_consumption, count_store_distinct, count_product_distinct,
         count_notify, count_distinct_region,
         CASE WHEN lag_sum_total = 0 THEN 0 ELSE 1 END AS label
  FROM panel
)"""
)

_SPLIT = """
CASE WHEN ('0x' || substr(md5({key}), 1, 8))::UBIGINT % 100 < 70 THEN 'train' ELSE 'test' END"""
_ROW_SPLIT = _SPLIT.format(key="concat_ws('|', CAST(distinct_id AS VARCHAR), yyyymm, '42')")
_PERSON_SPLIT = _SPLIT.format(key="concat_ws('|', CAST(distinct_id AS VARCHAR), '42')")

_RULE = (
    _TRAINING
    + """,
rule AS (
  SELECT *, CAST(label AS DOUBLE) AS y, CASE WHEN sum_total_points <> 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction
  FROM training
),
matrix AS (
  SELECT l.label, p.prediction, count(rule.y) AS n
  FROM (SELECT DISTINCT y AS label FROM rule) l
  CROSS JOIN (SELECT DISTINCT y AS prediction FROM rule) p
  LEFT JOIN rule ON rule.y = l.label AND rule.prediction = p.prediction
  GROUP BY l.label, p.prediction
),
cells AS (
  SELECT CAST(sum(n) FILTER (label = 1 AND prediction = 1) AS DOUBLE) AS tp,
         CAST(sum(n) FILTER (label = 0 AND prediction = 1) AS DOUBLE) AS fp,
         CAST(sum(n) FILTER (label = 1 AND prediction = 0) AS DOUBLE) AS fn,
         CAST(sum(n) FILTER (label = 0 AND prediction = 0) AS DOUBLE) AS tn
  FROM matrix
),
scores AS (
  SELECT CAST(sum_total_points AS DOUBLE) AS threshold,
         sum(label) AS pos, sum(1 - label) AS neg
  FROM training GROUP BY sum_total_points
),
curve AS (
  SELECT threshold,
         CAST(sum(pos) OVER up AS DOUBLE) / sum(pos) OVER () AS tpr,
         CAST(sum(neg) OVER up AS DOUBLE) / sum(neg) OVER () AS fpr
  FROM scores WINDOW up AS (ORDER BY threshold DESC)
),
area AS (
  SELECT CAST(sum(rank_sum) AS DOUBLE) AS rank_sum, CAST(sum(pos) AS DOUBLE) AS p, CAST(sum(neg) AS DOUBLE) AS q
  FROM (
    SELECT pos, neg, pos * (coalesce(sum(pos + neg) OVER below, 0) + (pos + neg + 1) / 2.0::DOUBLE) AS rank_sum
    FROM scores
    WINDOW below AS (ORDER BY threshold ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
  )
)"""
)


# The spine of feature_panel_updates, and its panel with the rows that have no next one.
_GAPS = _RAW.replace(
    "yyyymm FROM people)",
    """yyyymm FROM people
  WHERE NOT ((distinct_id + CAST(substr(yyyymm, 1, 4) AS INTEGER) * 12 + CAST(substr(yyyymm, 5, 2) AS INTEGER)) % 7 = 0
    OR distinct_id % 11 = 3 AND yyyymm BETWEEN '199903' AND '200104'
    OR distinct_id % 13 = 5 AND yyyymm < '200101'
    OR distinct_id % 17 = 2 AND yyyymm > '199912'))""",
)
_GAPS_PANEL = (_GAPS + "," + _panel("panel", "spine LEFT JOIN extras USING (distinct_id, yyyymm)")).replace(
    "  ) WHERE lag_sum_total IS NOT NULL\n", "  )\n"
)


def _standardized() -> str:
    stats = ", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in _NUMBERS)
    out = ", ".join(f"round(({c} - m_{c}) / s_{c}, 6) AS {c}" for c in _NUMBERS)
    return (
        _TRAINING
        + f", stats AS (SELECT {stats} FROM training WHERE {_ROW_SPLIT} = 'train')"
        + f" SELECT distinct_id, yyyymm, {out} FROM training CROSS JOIN stats"
    )


def _rule_runs() -> str:
    rules = " UNION ALL ".join(
        f"SELECT 'rule-{t}' AS run_id, 'from {t} points' AS run_name, '{t}' AS threshold, "
        f"(avg(CASE WHEN sum_total_points >= {t} THEN 1.0 ELSE 0.0 END) FILTER (label = 1) + "
        f"avg(CASE WHEN sum_total_points < {t} THEN 1.0 ELSE 0.0 END) FILTER (label = 0)) / 2 AS auc FROM training"
        for t in (1, 20, 50, 100)
    )
    return _TRAINING + f", rules AS ({rules})"


_RUN_COLUMNS = "SELECT run_id, run_name, threshold, round(-auc, 9) AS negative_auc FROM rules"

_REPORT = """,
probs AS (
  SELECT y, least(greatest(sum_total_points / (sum_total_points + 50.0::DOUBLE), 1e-15), 1 - 1e-15) AS p FROM rule
),
loss AS (SELECT -avg(CASE WHEN y = 1 THEN ln(p) ELSE ln(1 - p) END) AS log_loss FROM probs),
rates AS (
  SELECT *, tp + fp + fn + tn AS n, tp + fn AS n1, tn + fp AS n0,
         tp / (tp + fp) AS pr1, tp / (tp + fn) AS re1, tn / (tn + fn) AS pr0, tn / (tn + fp) AS re0
  FROM cells
),
f AS (SELECT *, 2 * pr1 * re1 / (pr1 + re1) AS f1, 2 * pr0 * re0 / (pr0 + re0) AS f0 FROM rates),
report AS (
  SELECT 'n' AS metric, n AS value FROM f
  UNION ALL SELECT 'n_left_out', 0.0::DOUBLE
  UNION ALL SELECT 'accuracy', (tp + tn) / n FROM f
  UNION ALL SELECT 'precision', pr1 FROM f
  UNION ALL SELECT 'recall', re1 FROM f
  UNION ALL SELECT 'f1', f1 FROM f
  UNION ALL SELECT 'weighted_precision', (n1 * pr1 + n0 * pr0) / n FROM f
  UNION ALL SELECT 'weighted_recall', (n1 * re1 + n0 * re0) / n FROM f
  UNION ALL SELECT 'weighted_f1', (n1 * f1 + n0 * f0) / n FROM f
  UNION ALL SELECT 'auc', (re1 + re0) / 2 FROM f
  UNION ALL SELECT 'log_loss', log_loss FROM loss
  UNION ALL SELECT 'auc_score', (rank_sum - p * (p + 1) / 2) / (p * q) FROM area
)
SELECT metric, round(value, 9) AS value FROM report"""

# The parameters that the search draws with its seed, trial by trial.
_TRIALS = [(4, 12), (3, 30), (4, 71), (5, 18)]


def _stump() -> str:
    """The best of the three splits by Gini impurity of the training part, and the shares of its leaves."""
    splits = [("gender", 0.5), ("gender", 1.5), ("bought", 0.5)]
    tried = " UNION ALL ".join(
        f"SELECT '{c}' AS col, {at}::DOUBLE AS threshold, {c} <= {at} AS is_left, count(*) AS n, sum(label) AS p "
        f"FROM rows WHERE split = 'train' GROUP BY ALL"
        for c, at in splits
    )
    return (
        _TRAINING
        + f""",
rows AS (
  SELECT * REPLACE (CASE WHEN (gender = 2) <> (age % 10 = 0) THEN 1 ELSE 0 END AS label),
         CASE WHEN sum_total_points > 0 THEN 1 ELSE 0 END AS bought, {_ROW_SPLIT} AS split
  FROM training
),
sides AS ({tried}),
chosen AS (
  SELECT col, threshold FROM sides GROUP BY col, threshold HAVING count(*) = 2
  ORDER BY sum(2.0::DOUBLE * p * (n - p) / n) LIMIT 1
),
leaves AS (SELECT s.*, CAST(p AS DOUBLE) / n AS share FROM sides s JOIN chosen USING (col, threshold))
SELECT r.distinct_id, r.yyyymm, CAST(r.label AS DOUBLE) AS label,
       CASE WHEN share > 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction, round(share, 9) AS probability_1
FROM rows r JOIN leaves l ON l.is_left = (CASE WHEN l.col = 'gender' THEN r.gender ELSE r.bought END <= l.threshold)
WHERE r.split = 'test'"""
    )


_NUMBERS = [
    "age", "sum_total_points", "count_consumption", "count_store_distinct",
    "count_product_distinct", "count_notify", "count_distinct_region",
]


def _indexed(col: str) -> str:
    """Index of each value of a column: the most frequent of the training part first, ties by text."""
    return f"""(SELECT {col}, CAST(row_number() OVER (ORDER BY count(*) DESC, CAST({col} AS VARCHAR)) - 1 AS DOUBLE) AS {col}_index
  FROM training WHERE {_ROW_SPLIT} = 'train' GROUP BY {col})"""


def _vectors() -> str:
    stats = ", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in _NUMBERS)
    out = ", ".join(f"round(({c} - m_{c}) / s_{c}, 6) AS {c}" for c in _NUMBERS)
    return (
        _TRAINING
        + f", stats AS (SELECT {stats} FROM training WHERE {_ROW_SPLIT} = 'train')"
        + f" SELECT distinct_id, yyyymm, gender_index, {out} FROM training CROSS JOIN stats"
        + f" JOIN {_indexed('gender')} USING (gender) WHERE {_ROW_SPLIT} = 'test'"
    )


def _trials() -> str:
    rows = ", ".join(f"('trial {i}', {depth}, {trees})" for i, (depth, trees) in enumerate(_TRIALS))
    return (
        _TRAINING
        + f""",
labels AS {_indexed("label")}
SELECT run_name, max_depth, num_trees,
       (SELECT CAST(label AS VARCHAR) FROM labels WHERE label_index = 0) AS label_0,
       (SELECT CAST(label AS VARCHAR) FROM labels WHERE label_index = 1) AS label_1,
       (SELECT CAST(count(*) AS DOUBLE) FROM training WHERE {_ROW_SPLIT} = 'test') AS n,
       0.0::DOUBLE AS n_left_out, true AS mirrored, true AS same_again
FROM (VALUES {rows}) AS t(run_name, max_depth, num_trees)"""
    )


# How often a tree draws a row, by four hexadecimal digits of a hash: once from the first limit on, and so on.
_LIMITS = ["5e2d", "bc5b", "eb71", "fb24", "ff10", "ffd9", "fffb"]


def _forest(depth: int, trees: int, part: str = _ROW_SPLIT) -> str:
    """``nodes`` of a forest grown on the part 'train', level by level, and ``walks``: where each distinct row comes
    by at each depth, by a recursive walk through that table."""
    names = ["gender", *_NUMBERS]
    pick = "CASE j " + " ".join(f"WHEN {j} THEN b{j}" for j in range(len(names))) + " END"
    value = "CASE feature " + " ".join(f"WHEN '{c}' THEN {c}" for c in names) + " END"
    below = ", ".join(
        f"len(list_filter(coalesce((SELECT list(v) FROM cuts WHERE j = {j}), []), lambda c: c < {n})) AS b{j}" for j, n in enumerate(names)
    )
    times = " + ".join(f"CAST(d >= '{x}' AS INTEGER)" for x in _LIMITS)
    bins = ", ".join(f"b{j}" for j in range(len(names)))
    fields = ", ".join(f"{{'j': {j}, 'name': '{c}'}}" for j, c in enumerate(names))
    out = f""",
labels AS {_indexed("label")},
parts AS MATERIALIZED (
  SELECT * FROM (SELECT training.*, label_index AS y, {part} AS part FROM training JOIN labels USING (label)) WHERE part IS NOT NULL
),
vals AS (
  SELECT j, v, count(*) AS n FROM (
    SELECT unnest([{", ".join(f"{{'j': {j}, 'v': CAST({c} AS DOUBLE)}}" for j, c in enumerate(names))}], recursive := true)
    FROM parts WHERE part = 'train') GROUP BY j, v
),
ranked AS (
  SELECT j, v, n, sum(n) OVER (PARTITION BY j ORDER BY v) AS upto, sum(n) OVER (PARTITION BY j) AS total,
         count(*) OVER (PARTITION BY j) AS d
  FROM vals
),
cuts AS MATERIALIZED (
  SELECT j, v, row_number() OVER (PARTITION BY j ORDER BY v) - 1 AS bin FROM ranked
  WHERE upto < total AND (d <= 32 OR floor(CAST(32 * upto AS DOUBLE) / total) > floor(CAST(32 * (upto - n) AS DOUBLE) / total))
),
binned AS MATERIALIZED (SELECT distinct_id, yyyymm, y, {below} FROM parts WHERE part = 'train'),
digits AS (
  SELECT b.*, g, i, substr(md5(concat_ws('|', CAST(distinct_id AS VARCHAR), yyyymm, '42', CAST(g AS VARCHAR))), 4 * i + 1, 4) AS d
  FROM binned b, (SELECT unnest(range({-(-trees // 8)})) AS g), (SELECT unnest(range(8)) AS i) WHERE 8 * g + i < {trees}
),
bags AS MATERIALIZED (
  SELECT 8 * g + i AS tree, {bins}, coalesce(sum({times}) FILTER (y = 1), 0) AS pos, coalesce(sum({times}) FILTER (y = 0), 0) AS neg
  FROM digits WHERE d >= '{_LIMITS[0]}' GROUP BY ALL
),
lots AS (SELECT unnest([{fields}], recursive := true)),
active0 AS MATERIALIZED (SELECT tree, 1 AS node, sum(pos) AS pos, sum(neg) AS neg FROM bags GROUP BY tree),
placed0 AS (SELECT *, 1 AS node FROM bags)"""
    for k in range(depth):
        out += f""",
picked{k} AS MATERIALIZED (
  SELECT tree, node, pos, neg, j FROM active{k}, lots WHERE pos > 0 AND neg > 0
  QUALIFY row_number() OVER (PARTITION BY tree, node ORDER BY md5(concat_ws('|', '42', CAST(tree AS VARCHAR), CAST(node AS VARCHAR), name)), j) <= 3
),
hist{k} AS (
  SELECT tree, node, j, {pick} AS bin, sum(p.pos) AS p, sum(p.neg) AS n
  FROM placed{k} p JOIN (SELECT tree, node, j FROM picked{k}) USING (tree, node) GROUP BY ALL
),
sides{k} AS (
  SELECT tree, node, j, bin, a.pos, a.neg, CAST(sum(p) OVER w AS BIGINT) AS lp, CAST(sum(n) OVER w AS BIGINT) AS ln
  FROM hist{k} JOIN active{k} a USING (tree, node) WINDOW w AS (PARTITION BY tree, node, j ORDER BY bin)
),
best{k} AS MATERIALIZED (
  SELECT * FROM (
    SELECT *, CAST(lp AS DOUBLE) * ln / (CAST(lp AS DOUBLE) + ln)
              + CAST(pos - lp AS DOUBLE) * (neg - ln) / (CAST(pos - lp AS DOUBLE) + (neg - ln)) AS impurity
    FROM sides{k} WHERE lp + ln < pos + neg)
  WHERE impurity < CAST(pos AS DOUBLE) * neg / (CAST(pos AS DOUBLE) + neg)
  QUALIFY row_number() OVER (PARTITION BY tree, node ORDER BY impurity, j, bin) = 1
),
active{k + 1} AS MATERIALIZED (
  SELECT tree, 2 * node AS node, lp AS pos, ln AS neg FROM best{k}
  UNION ALL SELECT tree, 2 * node + 1, pos - lp, neg - ln FROM best{k}
),
placed{k + 1} AS MATERIALIZED (
  SELECT p.* REPLACE (2 * p.node + CAST({pick} > bin AS INTEGER) AS node)
  FROM placed{k} p JOIN (SELECT tree, node, j, bin FROM best{k}) USING (tree, node)
)"""
    levels = " UNION ALL ".join(
        [f"SELECT tree, node, a.pos, a.neg, j, bin FROM active{k} a LEFT JOIN (SELECT tree, node, j, bin FROM best{k}) USING (tree, node)" for k in range(depth)]
        + [f"SELECT tree, node, pos, neg, NULL, NULL FROM active{depth}"]
    )
    return (
        out
        + f""",
nodes AS MATERIALIZED (
  SELECT CAST(tree AS INTEGER) AS tree, CAST(node AS INTEGER) AS node, name AS feature, v AS threshold,
         CAST(CASE WHEN j IS NOT NULL THEN 2 * node END AS INTEGER) AS "left",
         CAST(CASE WHEN j IS NOT NULL THEN 2 * node + 1 END AS INTEGER) AS "right", CAST(pos AS BIGINT) AS pos, CAST(neg AS BIGINT) AS neg
  FROM ({levels}) LEFT JOIN lots USING (j) LEFT JOIN cuts USING (j, bin)
),
kinds AS MATERIALIZED (SELECT row_number() OVER () AS kind, * FROM (SELECT DISTINCT {", ".join(names)} FROM parts)),
walks AS (
  SELECT kind, {", ".join(names)}, tree, 1 AS node, 0 AS depth FROM kinds, (SELECT unnest(range({trees})) AS tree)
  UNION ALL
  SELECT w.* REPLACE (CASE WHEN {value} > threshold THEN "right" ELSE "left" END AS node, depth + 1 AS depth)
  FROM walks w JOIN nodes USING (tree, node) WHERE feature IS NOT NULL
),
passed AS MATERIALIZED (
  SELECT kind, tree, depth, CAST(floor(CAST(1073741824 * pos AS DOUBLE) / (pos + neg)) AS BIGINT) AS share
  FROM walks JOIN nodes USING (tree, node)
)"""
    )


def _recursive(sql: str) -> str:
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


def _forest_scores() -> str:
    names = ", ".join(["gender", *_NUMBERS])
    return _recursive(
        _TRAINING
        + _forest(5, 20)
        + f""",
found AS (
  SELECT kind, CAST(sum(share) AS DOUBLE) / 21474836480.0::DOUBLE AS p
  FROM (SELECT kind, tree, arg_max(share, depth) AS share FROM passed GROUP BY kind, tree) GROUP BY kind
)
SELECT distinct_id, yyyymm, y AS label, CASE WHEN p > 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction, round(p, 9) AS probability_1
FROM parts JOIN kinds USING ({names}) JOIN found USING (kind) WHERE part = 'test'"""
    )


def _search(sizes: list[tuple[int, int]] = _TRIALS, part: str = _ROW_SPLIT) -> str:
    """``lines``: (trial, part, metric, value) of forests of some depths and numbers of trees on both parts."""
    names = ", ".join(["gender", *_NUMBERS])
    trials = ", ".join(f"({i}, {d}, {t})" for i, (d, t) in enumerate(sizes))
    lines = {
        "n": "n", "n_left_out": "0.0::DOUBLE", "accuracy": "(tp + tn) / n", "precision": "pr1", "recall": "re1", "f1": "f1",
        "weighted_precision": "(n1 * pr1 + n0 * pr0) / n", "weighted_recall": "(n1 * re1 + n0 * re0) / n",
        "weighted_f1": "(n1 * f1 + n0 * f0) / n", "auc": "(re1 + re0) / 2", "log_loss": "loss / n", "auc_score": "passed / (n1 * n0)",
    }
    rate = "CASE WHEN {1} = 0 THEN 0.0::DOUBLE ELSE {0} / ({1}) END AS {2}"
    rates = ", ".join(
        rate.format(*r)
        for r in (
            ("tp", "tp + fp", "pr1"), ("tp", "tp + fn", "re1"), ("tn", "tn + fn", "pr0"), ("tn", "tn + fp", "re0"),
            ("2 * tp", "2 * tp + fp + fn", "f1"), ("2 * tn", "2 * tn + fp + fn", "f0"),
        )
    )
    return (
        _TRAINING
        + _forest(max(d for d, _ in sizes), max(t for _, t in sizes), part)
        + f""",
trials(trial, max_depth, num_trees) AS (VALUES {trials}),
found AS (
  SELECT trial, kind, CAST(sum(share) AS DOUBLE) / (1073741824.0::DOUBLE * any_value(num_trees)) AS p
  FROM (
    SELECT trial, num_trees, kind, tree, arg_max(share, depth) AS share
    FROM passed JOIN trials ON depth <= max_depth AND tree < num_trees GROUP BY trial, num_trees, kind, tree
  ) GROUP BY trial, kind
),
scores AS (
  SELECT trial, part, p, CAST(count(*) FILTER (y = 1) AS DOUBLE) AS pos, CAST(count(*) FILTER (y = 0) AS DOUBLE) AS neg
  FROM parts JOIN kinds USING ({names}) JOIN found USING (kind) GROUP BY trial, part, p
),
curve AS (
  SELECT *, coalesce(sum(pos) OVER (PARTITION BY trial, part ORDER BY p DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS higher,
         least(greatest(p, 1e-15), 1 - 1e-15) AS q
  FROM scores
),
sums AS (
  SELECT trial, part, coalesce(sum(pos) FILTER (p > 0.5), 0.0) AS tp, coalesce(sum(neg) FILTER (p > 0.5), 0.0) AS fp,
         coalesce(sum(pos) FILTER (p <= 0.5), 0.0) AS fn, coalesce(sum(neg) FILTER (p <= 0.5), 0.0) AS tn,
         -sum(pos * ln(q) + neg * ln(1 - q)) AS loss, sum(neg * (higher + pos / 2)) AS passed
  FROM curve GROUP BY trial, part
),
rates AS (SELECT *, tp + fp + fn + tn AS n, tp + fn AS n1, tn + fp AS n0, {rates} FROM sums),
lines AS (
  SELECT trial, part, unnest([{", ".join(f"{{'metric': '{m}', 'value': {v}}}" for m, v in lines.items())}], recursive := true) FROM rates
)"""
    )


def _leaderboard() -> str:
    return _recursive(
        _search()
        + """
SELECT CAST(max_depth AS INTEGER) AS max_depth, CAST(num_trees AS INTEGER) AS num_trees, round(-auc.value, 9) AS negative_auc,
       round(auc.value, 9) AS auc, round(s.value, 9) AS auc_score
FROM trials JOIN lines auc ON auc.trial = trials.trial AND auc.part = 'test' AND auc.metric = 'auc'
JOIN lines s ON s.trial = trials.trial AND s.part = 'test' AND s.metric = 'auc_score'"""
    )


def _run_reports() -> str:
    return _recursive(
        _search()
        + """
SELECT 'trial ' || CAST(trial AS VARCHAR) AS run_name, unnest(CASE
         WHEN part = 'test' AND metric = 'auc' THEN ['test_auc', 'auc', 'negative_auc']
         WHEN part = 'test' AND metric = 'auc_score' THEN ['test_auc_score', 'auc_score']
         WHEN part = 'test' THEN ['test_' || metric] ELSE ['train_' || metric] END) AS metric,
       unnest(CASE WHEN part = 'test' AND metric = 'auc' THEN [round(value, 9), round(value, 9), round(-value, 9)]
         WHEN part = 'test' AND metric = 'auc_score' THEN [round(value, 9), round(value, 9)] ELSE [round(value, 9)] END) AS value
FROM lines WHERE part = 'test' OR metric IN ('auc', 'auc_score')"""
    )


# The grid of the cross-validated search. Folds are a hash of the person.
_POINTS = [(2, 5), (2, 15), (4, 5), (4, 15)]
_FOLD = "('0x' || substr(md5(concat_ws('|', CAST(distinct_id AS VARCHAR), '42', 'fold')), 1, 8))::UBIGINT % 3"


def _grid() -> str:
    def fold(f: int) -> str:
        part = f"CASE WHEN {_ROW_SPLIT} <> 'train' THEN NULL WHEN {_FOLD} = {f} THEN 'test' ELSE 'train' END"
        return f"""SELECT {f} AS fold, 'curve' AS kind, trial, p, pos, neg, 0.0::DOUBLE AS loss, 0.0::DOUBLE AS area FROM ({_recursive(_search(_POINTS, part))}
  SELECT trial, p, pos, neg FROM scores WHERE part = 'test')
UNION ALL SELECT {f}, 'lines', trial, NULL, NULL, NULL, loss, area FROM ({_recursive(_search(_POINTS, part))}
  SELECT trial, loss / n AS loss, passed / (n1 * n0) AS area FROM rates WHERE part = 'test')"""

    folds = " UNION ALL ".join(fold(f) for f in range(3))
    areas = ", ".join(f"round(max(area) FILTER (fold = {f}), 9) AS fold_{f}_auc_score" for f in range(3))
    return f"""
WITH every AS MATERIALIZED ({folds}),
points(trial, max_depth, num_trees) AS (VALUES {", ".join(f"({i}, {d}, {t})" for i, (d, t) in enumerate(_POINTS))}),
pooled AS (SELECT trial, p, sum(pos) AS pos, sum(neg) AS neg FROM every WHERE kind = 'curve' GROUP BY trial, p),
ranked AS (
  SELECT *, coalesce(sum(pos) OVER (PARTITION BY trial ORDER BY p DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS higher FROM pooled
),
whole AS (SELECT trial, sum(neg * (higher + pos / 2)) / (sum(pos) * sum(neg)) AS area FROM ranked GROUP BY trial),
folds AS (
  SELECT trial, {areas}, round(avg(area), 9) AS mean_auc_score, round(stddev_samp(area), 9) AS spread_auc_score, round(avg(loss), 9) AS mean_log_loss
  FROM every WHERE kind = 'lines' GROUP BY trial
)
SELECT CAST(max_depth AS INTEGER) AS max_depth, CAST(num_trees AS INTEGER) AS num_trees, folds.* EXCLUDE (trial), round(whole.area, 9) AS auc_score
FROM points JOIN folds USING (trial) JOIN whole USING (trial)"""


def _schema() -> str:
    kinds = {"age": "int", "gender": "string", "yyyymm": "string"}
    names = ["distinct_id", "yyyymm", "age", "gender", *_NUMBERS[1:], "lag_sum_total"]
    rows = ", ".join(
        f"('{c}', '{kinds.get(c, 'bigint')}', {c in names[:2]}, {i}, 'person months')" for i, c in enumerate(names)
    )
    return f"SELECT * FROM (VALUES {rows}) AS t(\"column\", type, is_key, position, description)"


_QUARTER = "substr(yyyymm, 1, 4) || 'Q' || CAST((CAST(substr(yyyymm, 5, 2) AS INTEGER) + 2) // 3 AS VARCHAR)"

ORACLE = {
    "people_spine": _RAW + " SELECT distinct_id, age, gender, yyyymm FROM spine",
    "period_key": """
WITH texts AS (
  SELECT o_orderkey, strftime(o_orderdate, '%Y') AS y,
         CASE WHEN o_orderpriority = '5-LOW' THEN '13' ELSE strftime(o_orderdate, '%m') END AS m,
         strftime(o_orderdate, '%d') || CASE WHEN o_orderstatus = 'P' THEN 'x' ELSE '' END AS d
  FROM orders
)
SELECT o_orderkey,
       strftime(try_strptime(y || m || d, '%Y%m%d'), '%Y%m') AS yyyymm,
       strftime(try_strptime(concat_ws('-', y, m, d), '%Y-%m-%d'), '%Y%m') AS yyyymm_dashed,
       strftime(try_strptime(y || m || d, '%Y%m%d'), '%GW%V') AS week,
       y || 'Q' || CAST(quarter(try_strptime(y || m || d, '%Y%m%d')) AS VARCHAR) AS quarter,
       strftime(try_strptime(y || m || d, '%Y%m%d'), '%Y') AS year,
       y || 'Q' || CAST(quarter(try_strptime(y || m || d, '%Y%m%d')) AS VARCHAR) AS quarter_of_month,
       strftime(try_strptime(concat_ws('-', y, m, d), '%Y-%m-%d'), '%Y%m%d') AS yyyymmdd
FROM texts""",
    "points_monthly": _RAW + " SELECT * FROM points_monthly",
    "points_by_grain": _RAW
    + f""",
dated AS (
  SELECT *, {_QUARTER} AS quarter, substr(yyyymm, 1, 4) AS year FROM points
)
SELECT distinct_id, CASE WHEN grouping(quarter) = 0 THEN 'quarter' ELSE 'year' END AS grain, coalesce(quarter, year) AS period,
       CAST(sum(total_points) AS BIGINT) AS sum_total_points, count(storename) AS count_consumption,
       count(DISTINCT storename) AS count_store_distinct, count(DISTINCT productname) AS count_product_distinct,
       true AS stores_close, true AS products_close
FROM dated GROUP BY GROUPING SETS ((distinct_id, quarter), (distinct_id, year), (quarter), (year))""",
    "quarterly_panel": _RAW
    + f""",
quarters AS (
  SELECT distinct_id, {_QUARTER} AS period, CAST(sum(total_points) AS BIGINT) AS sum_total_points,
         count(storename) AS count_consumption, count(DISTINCT storename) AS count_store_distinct,
         count(DISTINCT productname) AS count_product_distinct
  FROM points GROUP BY 1, 2
),
more AS (
  SELECT distinct_id, {_QUARTER} AS period, CAST(sum(count_notify) AS BIGINT) AS count_notify,
         CAST(sum(count_distinct_region) AS BIGINT) AS count_distinct_region
  FROM extras GROUP BY 1, 2
),
filled AS (
  SELECT distinct_id, period, age, gender, coalesce(sum_total_points, 0) AS sum_total_points,
         coalesce(count_consumption, 0) AS count_consumption, coalesce(count_notify, 0) AS count_notify,
         coalesce(count_distinct_region, 0) AS count_distinct_region,
         coalesce(count_store_distinct, 0) AS count_store_distinct, coalesce(count_product_distinct, 0) AS count_product_distinct
  FROM (SELECT DISTINCT distinct_id, {_QUARTER} AS period, age, gender FROM spine)
  LEFT JOIN quarters USING (distinct_id, period) LEFT JOIN more USING (distinct_id, period)
),
nexts AS (SELECT *, lead(sum_total_points) OVER (PARTITION BY distinct_id ORDER BY period) AS lag_sum_total FROM filled)
SELECT * FROM nexts WHERE lag_sum_total IS NOT NULL""",
    "notify_monthly": _RAW + " SELECT * FROM notify_monthly",
    "visits_monthly": _RAW + " SELECT * FROM visits_monthly",
    "app_events_csv": _RAW + " SELECT * FROM notify_monthly",
    "raw_parquet_rollups": _RAW
    + " SELECT p.*, v.count_distinct_region FROM points_monthly p"
    + " LEFT JOIN visits_monthly v USING (distinct_id, yyyymm)",
    "rejected_records": _RAW
    + """,
told AS (
  SELECT unnest(['points', 'visits', 'events']) AS source, o_orderkey AS key FROM orders
),
reasons AS (
  SELECT source, CASE WHEN source = 'events' AND key % 17 = 5 THEN 'broken record' WHEN key % 11 = 1 THEN 'no id'
         WHEN key % 11 = 2 THEN 'bad id' WHEN key % 13 = 3 THEN 'no date' WHEN key % 13 = 4 THEN 'bad date' END AS reason
  FROM told
  UNION ALL
  SELECT 'people', CASE WHEN distinct_id % 11 = 1 THEN 'no id' WHEN distinct_id % 11 = 2 THEN 'bad id'
         WHEN distinct_id % 13 = 3 THEN 'no date' END
  FROM people
)
SELECT source, reason, count(*) AS n, count(*) AS with_file FROM reasons WHERE reason IS NOT NULL GROUP BY source, reason""",
    "points_with_extras": _RAW + " SELECT * FROM extras",
    "feature_panel": _PANEL + " SELECT * FROM panel",
    "feature_panel_flat": _RAW
    + ","
    + _panel(
        "flat",
        """spine LEFT JOIN points_monthly USING (distinct_id, yyyymm)
      LEFT JOIN notify_monthly USING (distinct_id, yyyymm)
      LEFT JOIN visits_monthly USING (distinct_id, yyyymm)""",
    )
    + " SELECT * FROM flat",
    "panel_preview": _PANEL + " SELECT * FROM panel ORDER BY distinct_id, yyyymm LIMIT 5",
    "key_violations": _RAW
    + " SELECT distinct_id, yyyymm, count(*) AS n, 'duplicate key' AS reason"
    + " FROM people GROUP BY distinct_id, yyyymm HAVING count(*) > 1",
    "training_set": _TRAINING + " SELECT * FROM training",
    "split_sizes": _PANEL + f" SELECT {_ROW_SPLIT} AS split, count(*) AS n FROM panel GROUP BY 1",
    "split_by_person": _PANEL
    + f" SELECT {_PERSON_SPLIT} AS split, count(*) AS n, count(DISTINCT distinct_id) AS people FROM panel GROUP BY 1",
    "category_map": _TRAINING
    + """,
pairs AS (
  SELECT 'gender' AS col, CAST(gender AS VARCHAR) AS value FROM training
  UNION ALL SELECT 'label', CAST(label AS VARCHAR) FROM training
)
SELECT col, value, CAST(row_number() OVER (PARTITION BY col ORDER BY count(*) DESC, value) - 1 AS DOUBLE) AS index
FROM pairs GROUP BY col, value""",
    "product_index": """
WITH lines AS (
  SELECT concat_ws(' ', p_name, CAST(l_partkey AS VARCHAR)) AS part,"""
    + _SPLIT.format(key="concat_ws('|', CAST(l_orderkey AS VARCHAR), '42')")
    + """ AS split
  FROM lineitem JOIN part ON l_partkey = p_partkey
),
indexed AS (
  SELECT part, CAST(row_number() OVER (ORDER BY count(*) DESC, part) - 1 AS DOUBLE) AS index
  FROM lines WHERE split = 'train' GROUP BY part
)
SELECT part, index, count(*) AS n FROM lines JOIN indexed USING (part) WHERE split = 'test' GROUP BY ALL""",
    "standardized": _standardized(),
    "valid_feature_rows": _RAW
    + """
SELECT distinct_id, yyyymm, CASE gender WHEN 'F' THEN 2 ELSE 1 END AS gender, age, sum_total_points
FROM spine JOIN points_monthly USING (distinct_id, yyyymm)
WHERE gender IN ('F', 'M')""",
    "confusion_matrix": _RULE + " SELECT label, prediction, n FROM matrix",
    "confusion_cells": _RULE
    + """
SELECT CASE WHEN label = 0 AND prediction = 0 THEN 'True Negative'
            WHEN label = 0 THEN 'False Positive'
            WHEN prediction = 0 THEN 'False Negative'
            ELSE 'True Positive' END AS cell,
       n,
       printf('%.2f%%', 100.0::DOUBLE * n / sum(n) OVER ()) AS share
FROM matrix""",
    "roc_points": _RULE
    + """
SELECT threshold, round(fpr, 9) AS fpr, round(tpr, 9) AS tpr FROM curve
UNION ALL SELECT NULL, 0.0, 0.0""",
    "roc_sketch": "SELECT CAST(unnest(range(1, 51)) AS INTEGER) AS point, true AS fpr_close, true AS tpr_close",
    "auc_hard": _RULE + " SELECT round((tp / (tp + fn) + tn / (tn + fp)) / 2, 9) AS auc FROM cells",
    "auc_score": _RULE + " SELECT round((rank_sum - p * (p + 1) / 2) / (p * q), 9) AS auc FROM area",
    "classification_report": _RULE + _REPORT,
    "classification_report_gaps": (_RULE + _REPORT)
    .replace("  FROM panel\n)", "  FROM panel WHERE gender IN ('F', 'M')\n)")
    .replace("0.0::DOUBLE\n", "CAST(count(*) AS DOUBLE) FROM panel WHERE gender IS NULL OR gender NOT IN ('F', 'M')\n", 1),
    "feature_table_upsert": _PANEL
    + """
SELECT distinct_id, yyyymm, age, gender,
       sum_total_points + bump AS sum_total_points,
       count_consumption + bump AS count_consumption,
       count_store_distinct + bump AS count_store_distinct,
       count_product_distinct + bump AS count_product_distinct,
       count_notify + bump AS count_notify,
       count_distinct_region + bump AS count_distinct_region,
       lag_sum_total
FROM (SELECT *, CAST(CASE WHEN yyyymm >= '199711' THEN 1 ELSE 0 END AS BIGINT) AS bump FROM panel)""",
    "runs_by_parent": _rule_runs() + " " + _RUN_COLUMNS,
    "best_run": _rule_runs() + " " + _RUN_COLUMNS + " ORDER BY auc DESC, run_id LIMIT 1",
    "feature_table_schema": _schema(),
    "runs_reranked": _rule_runs()
    + """,
hits AS ("""
    + " UNION ALL ".join(
        f"SELECT 'rule-{t}' AS run_id, avg(CASE WHEN (sum_total_points >= {t}) = (label = 1) THEN 1.0 ELSE 0.0 END) AS accuracy FROM training"
        for t in (1, 20, 50, 100)
    )
    + """)
SELECT run_id, run_name, threshold, round(-auc, 9) AS negative_auc, round(accuracy, 9) AS accuracy,
       row_number() OVER (ORDER BY accuracy DESC, run_id) = 1 AS best
FROM rules JOIN hits USING (run_id)""",
    "run_tree": _TRAINING
    + """,
trials AS ("""
    + " UNION ALL ".join(
        f"SELECT gender, concat_ws('-', 'rule', CAST(gender AS VARCHAR), '{t}') AS run_id, "
        f"(avg(CASE WHEN sum_total_points >= {t} THEN 1.0 ELSE 0.0 END) FILTER (label = 1) + "
        f"avg(CASE WHEN sum_total_points < {t} THEN 1.0 ELSE 0.0 END) FILTER (label = 0)) / 2 AS auc FROM training GROUP BY gender"
        for t in (1, 20, 50, 100)
    )
    + """),
every AS (
  SELECT run_id, 2 AS depth, 1::BIGINT AS n_trials, run_id AS best_run, auc AS best_value FROM trials
  UNION ALL
  SELECT 'gender-' || CAST(gender AS VARCHAR), 1, count(*), arg_max(run_id, auc), max(auc) FROM trials GROUP BY gender
  UNION ALL
  SELECT 'study', 0, count(*), arg_max(run_id, auc), max(auc) FROM trials
  UNION ALL
  SELECT unnest(['here', 'there', 'lost']), NULL, 1, 'lost', 0.25
)
SELECT run_id, CAST(depth AS INTEGER) AS depth, n_trials, best_run, round(best_value, 9) AS best_value, run_id IN ('here', 'there') AS in_loop
FROM every""",
    "text_ids": _PANEL
    + """
SELECT CASE WHEN distinct_id % 2 = 0 THEN lpad(CAST(distinct_id AS VARCHAR), 6, '0')
            ELSE 'C-' || CAST(distinct_id AS VARCHAR) END AS distinct_id, * EXCLUDE (distinct_id)
FROM panel""",
    "feature_panel_incremental": _PANEL + " SELECT * FROM panel",
    "feature_panel_updates": _GAPS_PANEL + " SELECT * FROM panel",
    "feature_vectors": _vectors(),
    "forest_stump": _stump(),
    "forest_score_keys": _TRAINING
    + f"""
SELECT distinct_id, yyyymm, label_index AS label, true AS sane
FROM training JOIN {_indexed("label")} USING (label) WHERE {_ROW_SPLIT} = 'test'""",
    "search_trials": _trials(),
    "forest_scores": _forest_scores(),
    "forest_nodes": _recursive(_TRAINING + _forest(5, 20) + " SELECT * FROM nodes"),
    "search_leaderboard": _leaderboard(),
    "run_reports": _run_reports(),
    "grid_leaderboard": _grid(),
    "parzen_trials": _TRAINING
    + f""" SELECT 'trial ' || CAST(i AS VARCHAR) AS run_name, CASE WHEN i < 4 THEN 'drawn' ELSE 'proposed' END AS kind,
  (SELECT CAST(count(*) AS DOUBLE) FROM training WHERE {_ROW_SPLIT} = 'test') AS n, true AS inside
FROM (SELECT unnest(range(8)) AS i)""",
    "grid_folds": _TRAINING
    + f""" SELECT CAST({_FOLD} AS INTEGER) AS fold, count(*) AS n, count(DISTINCT distinct_id) AS people,
  CAST(4 * count(*) AS BIGINT) AS scores, 0::BIGINT AS odd, 0::BIGINT AS leaked
FROM training WHERE {_ROW_SPLIT} = 'train' GROUP BY 1""",
}
