"""DuckDB SQL for every query with an SQL formulation (the correctness oracle).

The SQL is written independently of the Spark code, from the rules: the
fixture view, lenient parsing, buckets, top-k labels, splits, frequency
indexing with slot offsets, the multinomial NB formulas and the metric
definitions. Tables ``orders``, ``customer``, ``nation`` are views.
"""

from __future__ import annotations

from catlens.config import FIXTURE_CONFIG, OTHER_LABEL, UNKNOWN, JobConfig

CFG: JobConfig = FIXTURE_CONFIG

# Fixed value: the fixture view (valid in Spark SQL and DuckDB).
TICKETS_RAW_SQL = """SELECT o.o_orderkey AS row_id,
 CASE WHEN o.o_orderkey % 37 = 0 THEN 'abc' WHEN o.o_orderkey % 41 = 0 THEN NULL
      WHEN o.o_orderkey % 43 = 0 THEN concat(' ', CAST(o.o_custkey % 23 AS STRING), '.0 ')
      ELSE CAST((o.o_custkey * (o.o_custkey % 7)) % 23 AS STRING) END AS code_raw,
 CASE WHEN o.o_orderkey % 29 = 0 THEN NULL WHEN o.o_orderkey % 31 = 0 THEN '1360A' WHEN o.o_orderkey % 53 = 0 THEN '930A'
      ELSE concat(CASE WHEN o.o_orderkey % 5 = 0 THEN ' ' ELSE '' END,
           lpad(CAST((o.o_custkey * 7) % 13 AS STRING), 2, '0'), lpad(CAST(o.o_orderkey % 60 AS STRING), 2, '0'),
           CASE WHEN o.o_orderkey % 2 = 0 THEN 'A' WHEN o.o_orderkey % 3 = 0 THEN 'p' ELSE 'P' END) END AS time_raw,
 CASE WHEN o.o_orderkey % 47 = 0 THEN 'n/a' WHEN o.o_orderkey % 59 = 0 THEN '0' WHEN o.o_orderkey % 61 = 0 THEN '2030'
      WHEN o.o_orderkey % 67 = 0 THEN '1999.9' ELSE CAST(1968 + (o.o_custkey * 3 + o.o_orderkey) % 62 AS STRING) END AS year_raw,
 CASE WHEN o.o_orderkey % 71 = 0 THEN '   ' ELSE concat(c.c_mktsegment, CASE WHEN o.o_orderkey % 3 = 0 THEN ' ' ELSE '' END) END AS segment,
 concat('Z', CAST(CASE WHEN o.o_orderkey % 4 = 0 THEN o.o_orderkey % 6 ELSE ((o.o_custkey * (o.o_custkey % 7)) % 23) % 6 END AS STRING)) AS zone,
 concat('C', CAST(CASE WHEN o.o_orderkey % 3 = 0 THEN o.o_custkey % 4 ELSE ((o.o_custkey * (o.o_custkey % 7)) % 23) % 4 END AS STRING)) AS color,
 o.o_orderstatus AS status, o.o_orderpriority AS priority, n.n_name AS nation
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey"""

WS = "' ' || chr(9) || chr(10) || chr(13) || chr(12) || chr(11)"


def strip(x: str) -> str:
    return f"trim({x}, {WS})"


def lenient_int(x: str) -> str:
    return f"TRY_CAST(NULLIF(regexp_extract({strip(x)}, '^([+-]?[0-9]+)([.][0-9]*)?$', 1), '') AS INTEGER)"


def time_bucket(x: str) -> str:
    s = f"upper({strip(x)})"
    hh = f"TRY_CAST(substr({s}, 1, 2) AS INTEGER)"
    mm = f"TRY_CAST(substr({s}, 3, 2) AS INTEGER)"
    h24 = f"({hh} % 12 + CASE WHEN substr({s}, 5, 1) = 'P' THEN 12 ELSE 0 END)"
    return (
        f"CASE WHEN {s} IS NULL OR NOT regexp_matches({s}, '^[0-9]{{4}}[AP]$') THEN '{UNKNOWN}' "
        f"WHEN {hh} > 12 OR {mm} > 59 THEN '{UNKNOWN}' "
        f"WHEN {h24} < 6 THEN 'LATE_NIGHT_0_6' WHEN {h24} < 12 THEN 'MORNING_6_12' "
        f"WHEN {h24} < 18 THEN 'AFTERNOON_12_18' ELSE 'EVENING_18_24' END"
    )


def year_bucket(x: str, current_year: int) -> str:
    s = strip(x)
    y = f"TRY_CAST({s} AS DOUBLE)"
    return (
        f"CASE WHEN {s} IS NULL OR NOT regexp_matches({s}, '^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$') "
        f"OR {y} IS NULL OR trunc({y}) < 1970 OR trunc({y}) > {current_year + 1} THEN '{UNKNOWN}' "
        f"WHEN trunc({y}) < 1990 THEN 'PRE_1990' WHEN trunc({y}) < 2000 THEN '1990s' "
        f"WHEN trunc({y}) < 2010 THEN '2000s' WHEN trunc({y}) < 2020 THEN '2010s' ELSE '2020s' END"
    )


def clean_category(x: str) -> str:
    return f"COALESCE(NULLIF({strip(x)}, ''), '{UNKNOWN}')"


def split_hash(x: str) -> str:
    return f"('0x' || substr(md5({x}), 1, 8))::BIGINT"


def content(cols) -> str:
    """The raw values as one text, NULL as backslash-N."""
    return "concat_ws(chr(31), " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '\\N')" for c in cols) + ")"


# Hash ranks: (h % 100, h div 100), 100 blocks of the values h div 100 can take.
RANK = "((h % 100) * 42949673 + h // 100)"
N_RANKS = 4294967300


def first_test_rank(test_fraction: float) -> str:
    return f"CAST(ceil((1 - CAST({test_fraction} AS DECIMAL(18,9))) * {N_RANKS}) AS BIGINT)"


# Fixture variants.
NULL_KEY_SQL = f"SELECT CASE WHEN row_id % 3 <> 0 THEN row_id END AS row_id, * EXCLUDE (row_id) FROM ({TICKETS_RAW_SQL})"
MANY_SQL = f"SELECT *, 'M' || CAST((row_id * 7919) % (1 + (row_id * 31) % 5003) AS VARCHAR) AS maker FROM ({TICKETS_RAW_SQL})"
COPIES_SQL = f"""SELECT CASE WHEN hot THEN '7' ELSE code_raw END AS code_raw, CASE WHEN hot THEN '0930A' ELSE time_raw END AS time_raw,
 CASE WHEN hot THEN '2001' ELSE year_raw END AS year_raw, CASE WHEN hot THEN 'HOT' ELSE segment END AS segment,
 CASE WHEN hot THEN 'Z0' ELSE zone END AS zone, CASE WHEN hot THEN 'C0' ELSE color END AS color, CASE WHEN hot THEN 'O' ELSE status END AS status,
 CASE WHEN hot THEN '1-URGENT' ELSE priority END AS priority, CASE WHEN hot THEN 'CHINA' ELSE nation END AS nation
 FROM (SELECT *, row_id % 3 = 0 AS hot FROM ({TICKETS_RAW_SQL}))"""


def _unpivot(src: str, cols, key: str = "row_id") -> str:
    return " UNION ALL ".join(f"SELECT {key}, '{c}' AS feature, {c} AS category FROM {src}" for c in cols)


def base_ctes(cfg: JobConfig = CFG, raw: str = TICKETS_RAW_SQL) -> str:
    """tickets_raw, usable (cleaned), freq, top, labelled, train, test."""
    cats = ", ".join(f"{clean_category(c)} AS {c}" for c in cfg.categorical_cols)
    text = content(cfg.needed_cols)
    key = "row_id" if cfg.key_col else "NULL AS row_id"
    h = split_hash(f"coalesce(CAST(row_id AS VARCHAR), chr(30) || {text})" if cfg.key_col else text)
    t = first_test_rank(cfg.test_fraction)
    return f"""tickets_raw AS ({raw}),
cleaned AS (
  SELECT {key}, {lenient_int(cfg.code_col)} AS {cfg.code_out},
         {time_bucket(cfg.time_col)} AS {cfg.hour_bucket_out},
         {year_bucket(cfg.year_col, cfg.current_year)} AS {cfg.year_bucket_out},
         {cats}, {h} AS h
  FROM tickets_raw),
usable AS (SELECT * FROM cleaned WHERE {cfg.code_out} IS NOT NULL),
freq AS (SELECT {cfg.code_out}, count(*) AS count FROM usable GROUP BY {cfg.code_out}),
top AS (SELECT {cfg.code_out}, count FROM freq ORDER BY count DESC, {cfg.code_out} LIMIT {cfg.top_n_classes}),
labelled AS (
  SELECT u.*, CASE WHEN u.{cfg.code_out} IN (SELECT {cfg.code_out} FROM top)
                   THEN CAST(u.{cfg.code_out} AS VARCHAR) ELSE '{OTHER_LABEL}' END AS {cfg.label_col}
  FROM usable u),
train AS (SELECT * FROM labelled WHERE {RANK} < {t}),
test AS (SELECT * FROM labelled WHERE {RANK} >= {t})"""


def stump_ctes(cfg: JobConfig = CFG) -> str:
    """The best single gini split over the one-hot slots of the training rows (ties: lower slot)."""
    lab = cfg.label_col
    return f"""totals AS (SELECT {lab}, label_idx, n_c FROM classes),
active AS (
  SELECT v.slot, v.slot_name, t.{lab}, t.label_idx, t.n_c, coalesce(s.c, 0) AS n1 FROM vocab v CROSS JOIN totals t
  LEFT JOIN (SELECT l.feature, l.category, r.{lab}, count(*) AS c FROM train_long l JOIN train r USING (row_id) GROUP BY ALL) s
    ON s.feature = v.feature AND s.category = v.category AND s.{lab} = t.{lab}),
gains AS (
  SELECT slot, slot_name, 1 - sum(n_c * n_c) / (sum(n_c) * sum(n_c)) AS impurity,
         1 - sum(n_c * n_c) / (sum(n_c) * sum(n_c))
         - sum(n1) / sum(n_c) * (1 - sum(n1 * n1) / (sum(n1) * sum(n1)))
         - (sum(n_c) - sum(n1)) / sum(n_c) * (1 - sum((n_c - n1) * (n_c - n1)) / ((sum(n_c) - sum(n1)) * (sum(n_c) - sum(n1)))) AS gain
  FROM active GROUP BY slot, slot_name HAVING sum(n1) > 0 AND sum(n1) < sum(n_c)),
stump AS (SELECT * FROM gains ORDER BY gain DESC, slot LIMIT 1),
leaf AS (
  SELECT on_side, {lab} AS predicted_label FROM (
    SELECT on_side, {lab}, row_number() OVER (PARTITION BY on_side ORDER BY n DESC, label_idx) AS rn FROM (
      SELECT true AS on_side, {lab}, label_idx, n1 AS n FROM active JOIN stump USING (slot)
      UNION ALL SELECT false, {lab}, label_idx, n_c - n1 FROM active JOIN stump USING (slot))) WHERE rn = 1)"""


def feature_ctes(cfg: JobConfig = CFG) -> str:
    """Vocabulary (frequency-desc index, slot offsets) and label index from train."""
    feats = list(cfg.feature_cols)
    order = ", ".join(f"('{f}', {i})" for i, f in enumerate(feats))
    return f"""feature_order(feature, ord) AS (VALUES {order}),
train_long AS ({_unpivot('train', feats)}),
vocab_counts AS (SELECT feature, category, count(*) AS c FROM train_long GROUP BY feature, category),
ranked AS (
  SELECT feature, category, CAST(row_number() OVER (PARTITION BY feature ORDER BY c DESC, category) - 1 AS INTEGER) AS idx
  FROM vocab_counts),
sizes AS (
  SELECT r.feature, o.ord, count(*) AS nf FROM ranked r JOIN feature_order o USING (feature) GROUP BY r.feature, o.ord),
offsets AS (
  SELECT feature, COALESCE(sum(nf) OVER (ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off
  FROM sizes),
vocab AS (
  SELECT r.feature, r.category, r.idx, CAST(r.idx + o.off AS INTEGER) AS slot,
         r.feature || '_vec_' || r.category AS slot_name
  FROM ranked r JOIN offsets o USING (feature)),
classes AS (
  SELECT {cfg.label_col}, count(*) AS n_c,
         CAST(row_number() OVER (ORDER BY count(*) DESC, {cfg.label_col}) - 1 AS INTEGER) AS label_idx
  FROM train GROUP BY {cfg.label_col})"""


def nb_ctes(cfg: JobConfig = CFG) -> str:
    """Multinomial NB (smoothing lambda) fitted on train, scored on test.

    pi_c = ln(n_c + l) - ln(N + K l); theta_cj = ln(cnt_cj + l) - ln(n_c F + D l)
    (each training row has exactly F active slots). A test row's score is
    pi_c plus the sum of theta over its active slots, in slot order; the
    prediction is the best score, ties to the lower label index.
    """
    feats = list(cfg.feature_cols)
    lam = cfg.smoothing
    return f"""dims AS (SELECT (SELECT count(*) FROM vocab) AS d, {len(feats)} AS nfeat,
                  (SELECT count(*) FROM train) AS n_train, (SELECT count(*) FROM classes) AS k),
priors AS (
  SELECT c.{cfg.label_col}, c.label_idx, c.n_c,
         ln(c.n_c + {lam}) - ln(d.n_train + d.k * {lam}) AS log_prior,
         ln(c.n_c * d.nfeat + d.d * {lam}) AS theta_denom
  FROM classes c, dims d),
slot_counts AS (
  SELECT t.{cfg.label_col}, l.feature, l.category, count(*) AS cnt
  FROM train t JOIN train_long l USING (row_id) GROUP BY t.{cfg.label_col}, l.feature, l.category),
thetas AS (
  SELECT p.{cfg.label_col}, p.label_idx, v.feature, v.category, v.slot, v.slot_name,
         ln(COALESCE(s.cnt, 0) + {lam}) - p.theta_denom AS theta
  FROM priors p CROSS JOIN vocab v
  LEFT JOIN slot_counts s ON s.{cfg.label_col} = p.{cfg.label_col} AND s.feature = v.feature AND s.category = v.category),
test_long AS ({_unpivot('test', feats)}),
row_sums AS (
  SELECT l.row_id, th.{cfg.label_col}, list_sum(list(th.theta ORDER BY th.slot)) AS s
  FROM test_long l JOIN thetas th ON th.feature = l.feature AND th.category = l.category
  GROUP BY l.row_id, th.{cfg.label_col}),
scores AS (
  SELECT t.row_id, p.{cfg.label_col} AS predicted_label, p.label_idx, p.log_prior + COALESCE(r.s, 0) AS score
  FROM test t CROSS JOIN priors p
  LEFT JOIN row_sums r ON r.row_id = t.row_id AND r.{cfg.label_col} = p.{cfg.label_col}),
best AS (
  SELECT row_id, predicted_label FROM (
    SELECT row_id, predicted_label,
           row_number() OVER (PARTITION BY row_id ORDER BY score DESC, label_idx) AS rn FROM scores) WHERE rn = 1),
predictions AS (SELECT t.*, b.predicted_label FROM test t JOIN best b USING (row_id)),
confusion AS (
  SELECT {cfg.label_col}, predicted_label, count(*) AS n FROM predictions GROUP BY {cfg.label_col}, predicted_label),
per_class AS (
  SELECT a.{cfg.label_col}, CAST(a.n_actual AS BIGINT) AS n_actual, CAST(a.tp AS BIGINT) AS tp, COALESCE(q.n_predicted, 0) AS n_predicted,
         CASE WHEN COALESCE(q.n_predicted, 0) = 0 THEN 0.0 ELSE a.tp / q.n_predicted END AS prec,
         a.tp / a.n_actual AS rec
  FROM (SELECT {cfg.label_col}, sum(n) AS n_actual,
               sum(CASE WHEN {cfg.label_col} = predicted_label THEN n ELSE 0 END) AS tp
        FROM confusion GROUP BY {cfg.label_col}) a
  LEFT JOIN (SELECT predicted_label, sum(n) AS n_predicted FROM confusion GROUP BY predicted_label) q
    ON q.predicted_label = a.{cfg.label_col}),
metrics AS (
  SELECT CAST(sum(n_actual) AS BIGINT) AS n_test,
         CAST(sum(tp) AS DOUBLE) / sum(n_actual) AS accuracy,
         sum(CASE WHEN prec + rec = 0 THEN 0.0 ELSE 2 * prec * rec / (prec + rec) END * n_actual) / sum(n_actual) AS f1,
         sum(prec * n_actual) / sum(n_actual) AS weighted_precision,
         sum(rec * n_actual) / sum(n_actual) AS weighted_recall
  FROM per_class)"""


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def build(cfg: JobConfig = CFG) -> dict[str, str]:
    b = base_ctes(cfg)
    f = feature_ctes(cfg)
    nb = nb_ctes(cfg)
    lab = cfg.label_col
    cats = list(cfg.categorical_cols)
    raw_cols = ", ".join(["row_id", "code_raw", "time_raw", "year_raw", *cats])
    text_cols = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in ["row_id", "code_raw", "time_raw", "year_raw", *cats])
    side = f"""SELECT {lab}, 'train' AS split, count(*) AS n FROM train GROUP BY {lab}
  UNION ALL SELECT {lab}, 'test' AS split, count(*) AS n FROM test GROUP BY {lab}"""
    null_base, small_base = base_ctes(cfg, NULL_KEY_SQL), base_ctes(cfg.with_(test_fraction=0.004))
    keyless = cfg.with_(key_col=None)
    shared = f"""groups AS (
  SELECT {lab}, count(*)::HUGEINT AS n, {RANK} AS r FROM labelled
  GROUP BY h, {lab}, {cfg.code_out}, {cfg.hour_bucket_out}, {cfg.year_bucket_out}, {', '.join(cats)}),
shares AS (SELECT {lab}, n, (n * ({N_RANKS} - {first_test_rank(cfg.test_fraction)}) + r) // {N_RANKS} AS t FROM groups)"""
    many = cfg.with_(categorical_cols=(*cfg.categorical_cols, "maker"))
    only = many.with_(features=("maker",))
    many_b, many_f = base_ctes(many, MANY_SQL), feature_ctes(many)
    stump = stump_ctes(cfg)
    tf = cfg.test_fraction
    strat = f"""strat AS (
  SELECT row_id, {lab},
         row_number() OVER (PARTITION BY {lab} ORDER BY h, row_id) AS rn,
         count(*) OVER (PARTITION BY {lab}) AS n_label
  FROM labelled),
strat_side AS (
  SELECT row_id, {lab}, CASE WHEN rn <= floor(n_label * {tf} + 0.5) THEN 'test' ELSE 'train' END AS split FROM strat)"""
    sample_cols = ", ".join(["row_id", *cfg.sample_cols, cfg.hour_bucket_out, lab, "predicted_label"])
    summary = f"""SELECT 'n_rows' AS metric, round(CAST(count(*) AS DOUBLE), 6) AS value FROM labelled
  UNION ALL SELECT 'majority_baseline', round((SELECT max(c) FROM (SELECT count(*) AS c FROM labelled GROUP BY {lab})) / count(*), 6) FROM labelled
  UNION ALL SELECT 'n_test', round(CAST(n_test AS DOUBLE), 6) FROM metrics
  UNION ALL SELECT 'accuracy', round(accuracy, 6) FROM metrics
  UNION ALL SELECT 'f1', round(f1, 6) FROM metrics
  UNION ALL SELECT 'weighted_precision', round(weighted_precision, 6) FROM metrics
  UNION ALL SELECT 'weighted_recall', round(weighted_recall, 6) FROM metrics"""

    return {
        "preview": _with(b) + f"SELECT {raw_cols} FROM tickets_raw ORDER BY row_id LIMIT 5",
        "select_needed": _with(b) + f"SELECT {raw_cols} FROM tickets_raw",
        "csv_roundtrip": _with(b) + f"SELECT {text_cols} FROM tickets_raw",
        "parquet_sink": _with(b) + f"SELECT {lab}, count(*) AS count FROM labelled GROUP BY {lab}",
        "split_fraction_small_counts": _with(small_base) + side,
        "split_hash_nullkey_counts": _with(null_base) + side,
        "split_stratified_nullkey_counts": _with(null_base, strat) + f"SELECT {lab}, split, count(*) AS n FROM strat_side GROUP BY {lab}, split",
        "split_keyless_copies_counts": _with(base_ctes(keyless, COPIES_SQL), shared)
        + f"SELECT {lab}, 'test' AS split, CAST(sum(t) AS BIGINT) AS n FROM shares GROUP BY {lab} HAVING sum(t) > 0 "
        f"UNION ALL SELECT {lab}, 'train', CAST(sum(n - t) AS BIGINT) FROM shares GROUP BY {lab} HAVING sum(n - t) > 0",
        "split_stratified_copies_counts": _with(base_ctes(keyless, COPIES_SQL))
        + f"SELECT {lab}, split, n FROM (SELECT {lab}, unnest(['test', 'train']) AS split, "
        f"unnest([CAST(floor(n_label * {tf} + 0.5) AS BIGINT), n_label - CAST(floor(n_label * {tf} + 0.5) AS BIGINT)]) AS n "
        f"FROM (SELECT {lab}, count(*) AS n_label FROM labelled GROUP BY {lab})) WHERE n > 0",
        "sink_retry": _with(b) + f"SELECT {raw_cols} FROM tickets_raw",
        "split_random_counts": _with(b) + f"SELECT {lab}, count(*) AS n FROM labelled GROUP BY {lab}",
        "category_index_many": _with(many_b, many_f) + "SELECT feature, category, idx, slot, slot_name FROM vocab",
        "one_hot_long_many": _with(many_b, many_f)
        + "SELECT l.row_id, v.feature, v.slot, v.slot_name FROM ("
        + _unpivot("labelled", list(many.feature_cols))
        + ") l JOIN vocab v ON v.feature = l.feature AND v.category = l.category",
        "one_hot_long_joined": _with(many_b, many_f)
        + "SELECT l.row_id, v.feature, v.slot, v.slot_name FROM ("
        + _unpivot("labelled", list(many.feature_cols))
        + ") l JOIN vocab v ON v.feature = l.feature AND v.category = l.category",
        "one_hot_sparse": _with(many_b, feature_ctes(only))
        + "SELECT l.row_id, CAST((SELECT count(*) FROM vocab) AS INTEGER) AS size, coalesce(string_agg(v.slot, ',' ORDER BY v.slot), '') AS slots, "
        "CAST(count(v.slot) AS DOUBLE) AS total FROM ("
        + _unpivot("labelled", list(only.feature_cols))
        + ") l LEFT JOIN vocab v ON v.feature = l.feature AND v.category = l.category GROUP BY l.row_id",
        "nb_predictions_sparse": _with(b, f, nb) + f"SELECT row_id, {lab}, predicted_label FROM predictions",
        "nb_predictions_sparse_many": _with(many_b, many_f, nb_ctes(many)) + f"SELECT row_id, {lab}, predicted_label FROM predictions",
        "nb_predictions_sparse_unseen": _with(many_b, feature_ctes(only), nb_ctes(only)) + f"SELECT row_id, {lab}, predicted_label FROM predictions",
        "nb_predictions_many": _with(many_b, many_f, nb_ctes(many)) + f"SELECT row_id, {lab}, predicted_label FROM predictions",
        "nb_predictions_unseen": _with(many_b, feature_ctes(only), nb_ctes(only)) + f"SELECT row_id, {lab}, predicted_label FROM predictions",
        "nb_predictions_reloaded": _with(b, f, nb) + f"SELECT row_id, {lab}, predicted_label FROM predictions",
        "rf_facts": _with(b, f)
        + "SELECT count(*) AS n_test, true AS recall_is_accuracy, 1.0::DOUBLE AS importance_sum, (SELECT count(*) FROM vocab) AS n_slots FROM test",
        "rf_deep_facts": _with(b, f)
        + f"SELECT count(*) AS n_test, true AS depth_9_to_20, {cfg.num_trees}::BIGINT AS n_trees, true AS children_add_up, true AS leaves_fit, "
        "1.0::DOUBLE AS importance_sum, (SELECT count(*) FROM vocab) AS n_slots FROM test",
        "rf_test_rows": _with(b) + f"SELECT {lab}, count(*) AS n_test_examples FROM test GROUP BY {lab}",
        "rf_stump_split": _with(b, f, stump) + "SELECT slot_name, round(impurity, 6) AS impurity, round(gain, 6) AS gain FROM stump",
        "rf_stump_predictions": _with(b, f, stump)
        + f"SELECT t.row_id, t.{lab}, leaf.predicted_label FROM test t JOIN leaf ON leaf.on_side = (EXISTS ("
        f"SELECT 1 FROM ({_unpivot('test', list(cfg.feature_cols))}) l JOIN vocab v ON v.feature = l.feature AND v.category = l.category "
        "JOIN stump s ON s.slot = v.slot WHERE l.row_id = t.row_id))",
        "rf_stump_importances": _with(b, f, stump)
        + "SELECT v.slot_name AS feature_name, CASE WHEN s.slot IS NULL THEN 0.0 ELSE 1.0 END::DOUBLE AS importance FROM vocab v LEFT JOIN stump s ON s.slot = v.slot",
        "lenient_int": _with(b) + f"SELECT row_id, code_raw, {lenient_int('code_raw')} AS {cfg.code_out} FROM tickets_raw",
        "usable_rows": _with(b) + "SELECT count(*) AS n_rows FROM usable",
        "time_buckets": _with(b) + f"SELECT {cfg.hour_bucket_out}, count(*) AS n FROM usable GROUP BY 1",
        "year_buckets": _with(b)
        + f"SELECT {year_bucket(cfg.year_col, cfg.current_year)} AS {cfg.year_bucket_out}, count(*) AS n FROM tickets_raw GROUP BY 1",
        "clean_categories": _with(b)
        + "SELECT feature, category AS value, count(*) AS n FROM ("
        + _unpivot("usable", cats)
        + ") GROUP BY feature, category",
        "cleaned_rows": _with(b)
        + f"SELECT row_id, {cfg.code_out}, {cfg.hour_bucket_out}, {cfg.year_bucket_out}, {', '.join(cats)} FROM usable",
        "code_frequency": _with(b) + f"SELECT {cfg.code_out}, count FROM freq",
        "top_codes": _with(b) + f"SELECT {cfg.code_out}, count FROM top",
        "labelled": _with(b) + f"SELECT row_id, {cfg.code_out}, {lab} FROM labelled",
        "label_counts": _with(b) + f"SELECT {lab}, count(*) AS count FROM labelled GROUP BY {lab}",
        "majority_baseline": _with(b)
        + f"SELECT CAST(sum(c) AS BIGINT) AS n_rows, max(c) AS top_class_count, round(max(c) / sum(c), 6) AS majority_baseline "
        f"FROM (SELECT count(*) AS c FROM labelled GROUP BY {lab})",
        "split_hash_counts": _with(b) + side,
        "split_stratified_counts": _with(b, strat) + f"SELECT {lab}, split, count(*) AS n FROM strat_side GROUP BY {lab}, split",
        "split_stratified_rows": _with(b, strat) + f"SELECT row_id, {lab} FROM strat_side WHERE split = 'test'",
        "category_index": _with(b, f) + "SELECT feature, category, idx, slot, slot_name FROM vocab",
        "label_index": _with(b, f) + f"SELECT {lab}, label_idx FROM classes",
        "one_hot_long": _with(b, f)
        + "SELECT l.row_id, v.feature, v.slot, v.slot_name FROM ("
        + _unpivot("labelled", list(cfg.feature_cols))
        + ") l JOIN vocab v ON v.feature = l.feature AND v.category = l.category",
        "nb_priors": _with(b, f, nb) + f"SELECT {lab}, round(log_prior, 6) AS log_prior FROM priors",
        "nb_model": _with(b, f, nb) + f"SELECT {lab}, slot_name, round(theta, 6) AS theta FROM thetas",
        "nb_predictions": _with(b, f, nb) + f"SELECT row_id, {lab}, predicted_label FROM predictions",
        "nb_confusion": _with(b, f, nb) + f"SELECT {lab}, predicted_label, n FROM confusion",
        "nb_metrics": _with(b, f, nb)
        + "SELECT n_test, round(accuracy, 6) AS accuracy, round(f1, 6) AS f1, "
        "round(weighted_precision, 6) AS weighted_precision, round(weighted_recall, 6) AS weighted_recall FROM metrics",
        "nb_per_class": _with(b, f, nb)
        + f"SELECT {lab}, round(tp / n_actual, 6) AS class_accuracy, n_actual AS n_test_examples FROM per_class",
        "nb_per_class_rows": _with(b, f, nb)
        + f"SELECT {lab}, round(avg(CASE WHEN {lab} = predicted_label THEN 1 ELSE 0 END), 6) AS class_accuracy, "
        f"count({lab}) AS n_test_examples FROM predictions GROUP BY {lab}",
        "label_counts_checkpointed": _with(b) + f"SELECT {lab}, count(*) AS count FROM labelled GROUP BY {lab}",
        "nb_samples": _with(b, f, nb) + f"SELECT {sample_cols} FROM predictions ORDER BY row_id LIMIT 20",
        "run_summary_nb": _with(b, f, nb) + summary,
    }


ORACLE_SQL: dict[str, str] = build()
