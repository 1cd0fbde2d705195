"""ANSI SQL (DuckDB dialect) twins of the registered queries.

Written independently of the DataFrame code: same fixture, same formulas,
brute force where the Spark side uses a pruned or decomposed plan (kNN,
silhouette, distance correlation).
"""

from __future__ import annotations

import itertools
import math

SQL: dict[str, str] = {}

# settings of the queries, written out here so that the twins do not read them from the code under test
DOC_THRESHOLD, TEST_PCT, KNN_K = 1500, 20, 5
LINE_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
Q_MAX, DISC_MAX = [10, 20, 30, 40, 50], [0.02, 0.05, 0.08]
TEMPS, COOLINGS = [1.0, 5.0, 10.0, 50.0, 100.0, 500.0, 1000.0], [0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4]
CROSS_PARAMS = [1, 2, 4, 8]
THRESHOLDS = [500, 1000, 1500, 2000, 4000, 8000]
RUN_T = 2
MI_COLS = ["l_returnflag", "l_linestatus", "l_linenumber"]
GAMMA, THETA, VALUE_SWEEPS, POLICY_ROUNDS, Q_SWEEPS = 0.25, 0.001, 20, 2, 10
N_CANDIDATES, RCA_K = 16, 8
KNN_GRID = [1, 3, 5, 7, 9]
LC_FRACTIONS = [0.25, 0.5, 1.0]
EVENT_ITERATIONS = {"view": 20, "click": 2, "purchase": 50}
KNN_CURVE = [1, 11, 21, 32, 42, 52, 63, 73, 84, 94, 104, 115, 125, 135, 146, 156, 167, 177, 187, 198, 208, 218, 229, 239, 250]


def H(expr: str) -> str:
    """md5 draw: first 8 hex digits as an unsigned integer."""
    return f"('0x' || substr(md5({expr}), 1, 8))::BIGINT"


def H60(expr: str) -> str:
    """md5 draw: first 15 hex digits."""
    return f"('0x' || substr(md5({expr}), 1, 15))::BIGINT"


def D(v: float) -> str:
    return f"{float(v)!r}::DOUBLE"


EMB = ("emb AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, label, "
       "CASE WHEN label < 5 THEN 1 ELSE 0 END AS y FROM embeddings)")
TP = (f"tp AS (SELECT l.doc_id, d.lang, d.source, d.n_chars, l.quality AS y, "
      f"(d.n_chars > {DOC_THRESHOLD})::INTEGER AS yhat, l.toxic FROM labels l JOIN documents d USING (doc_id))")

# ---------------------------------------------------------------- sources / sinks
SQL["scan_csv"] = ("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, "
                   "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_orderpriority FROM orders")
SQL["scan_csv_positional"] = ("SELECT " + ", ".join(f"round(embedding[{i + 1}]::DOUBLE, 6) AS f{i}" for i in range(64))
                              + ", label FROM embeddings")
SQL["sink_csv"] = "SELECT * FROM customer"
_RUNLOG = ("SELECT event_type AS algo, day(ts)::INTEGER AS budget, round(avg(value), 6) AS accuracy, "
           "{copies}::BIGINT AS copies FROM events GROUP BY ALL")
SQL["sink_runlog_append"] = _RUNLOG.format(copies=2)
SQL["sink_runlog_overwrite"] = _RUNLOG.format(copies=1)

# ---------------------------------------------------------------- profiling
_LI_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
            "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
SQL["profile_shape"] = f"SELECT count(*) AS n_rows, {len(_LI_COLS)} AS n_cols FROM lineitem"
SQL["profile_nulls"] = ("WITH c AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", (count(*) - count({c}))::BIGINT AS n_null FROM lineitem" for c in _LI_COLS)
    + ") SELECT \"column\", n_null, max(n_null > 0) OVER () AS any_null FROM c")


def _describe_cat(c):
    return (f"(WITH k AS (SELECT {c}::VARCHAR AS v, count(*) AS n FROM lineitem WHERE {c} IS NOT NULL GROUP BY 1) "
            f"SELECT '{c}' AS \"column\", sum(n)::BIGINT AS count, count(*)::DOUBLE AS \"unique\", "
            f"(SELECT v FROM k ORDER BY n DESC, v LIMIT 1) AS top, max(n)::DOUBLE AS freq, "
            + ", ".join(f"NULL::DOUBLE AS {s}" for s in ("mean", "std", "min", "q25", "q50", "q75", "max"))
            + " FROM k)")


def _describe_num(c):
    x = f"{c}::DOUBLE"
    return (f"(SELECT '{c}' AS \"column\", count({c})::BIGINT AS count, NULL::DOUBLE AS \"unique\", "
            f"NULL::VARCHAR AS top, NULL::DOUBLE AS freq, round(avg({x}), 6) AS mean, "
            f"round(stddev_samp({x}), 6) AS std, round(min({x}), 6) AS min, "
            f"round(quantile_cont({x}, 0.25), 6) AS q25, round(quantile_cont({x}, 0.5), 6) AS q50, "
            f"round(quantile_cont({x}, 0.75), 6) AS q75, round(max({x}), 6) AS max FROM lineitem)")


SQL["profile_describe"] = " UNION ALL ".join(
    [_describe_cat(c) for c in ("l_returnflag", "l_linestatus")] + [_describe_num(c) for c in LINE_NUM])

# ---------------------------------------------------------------- projections / expressions
SQL["select_cols"] = "SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem"
SQL["drop_cols"] = "SELECT p_partkey, p_brand, p_type, p_size FROM part"
SQL["move_label_first"] = "SELECT quality, doc_id, toxic FROM labels"
SQL["slice_features"] = ("SELECT l_orderkey, l_linenumber, trunc(l_quantity)::DOUBLE AS f0, "
                         "trunc(l_extendedprice)::DOUBLE AS f1, trunc(l_discount)::DOUBLE AS f2 FROM lineitem")
SQL["cast_category"] = "SELECT p_partkey, CAST(p_size AS VARCHAR) AS p_size, p_type FROM part"
SQL["replace_value"] = ("SELECT CASE WHEN p_partkey = 1 THEN 0 ELSE p_partkey END AS p_partkey, p_name, p_brand, p_type, "
                        "CASE WHEN p_size = 1 THEN 0 ELSE p_size END AS p_size, "
                        "CASE WHEN p_retailprice = 1 THEN 0 ELSE p_retailprice END AS p_retailprice FROM part")
SQL["map_label"] = ("SELECT o_orderkey, o_orderstatus, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 "
                    "WHEN 'P' THEN 2 END AS status_code FROM orders")
SQL["one_hot"] = ("SELECT l_orderkey, l_linenumber, "
                  + ", ".join(f"(l_returnflag = '{v}')::INTEGER AS l_returnflag_{v}" for v in "ANR") + ", "
                  + ", ".join(f"(l_linestatus = '{v}')::INTEGER AS l_linestatus_{v}" for v in "FO")
                  + " FROM lineitem")
SQL["min_max_scale"] = ("WITH m AS (SELECT " + ", ".join(f"min({c}) AS mn_{c}, max({c}) AS mx_{c}" for c in LINE_NUM)
                        + " FROM lineitem) SELECT l_orderkey, l_linenumber, "
                        + ", ".join(f"round(({c} - mn_{c}) / nullif(mx_{c} - mn_{c}, 0), 6) AS {c}" for c in LINE_NUM)
                        + " FROM lineitem, m")
SQL["mask_filter"] = ("SELECT l_orderkey, l_linenumber, l_discount FROM lineitem "
                      "WHERE l_discount > 0.05::DOUBLE AND l_returnflag = 'R'")
SQL["abs_threshold_correct"] = ("SELECT event_id, (abs(value / 100 - (event_type = 'purchase')::DOUBLE) < 0.5)::INTEGER "
                                "AS correct FROM events")
_STEP = (1.0 - 0.05) / 19
_V = f"(0.05::DOUBLE + i::DOUBLE * {D(_STEP)}) * n"
SQL["linspace_ladder"] = (f"WITH c AS (SELECT count(*)::DOUBLE AS n FROM events) SELECT i::INTEGER AS i, "
                          f"floor({_V})::BIGINT AS size_floor, round_even({_V}, 0)::BIGINT AS size_round "
                          f"FROM c, range(20) r(i)")
SQL["int_truncate"] = ("SELECT user_id, (sum(floor(value))::BIGINT // count(*))::BIGINT AS mean_int, "
                       "(count(*) // 2)::BIGINT AS half_n FROM events GROUP BY user_id")
SQL["format_fixed"] = "SELECT event_id, printf('%.3f', round_even(value / 7, 3)) AS value_fmt FROM events"
SQL["format_date"] = "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS order_day FROM orders"
SQL["csv_line"] = ("SELECT concat_ws(',', l_orderkey, l_linenumber, l_returnflag, "
                   "printf('%.2f', round_even(l_extendedprice, 2))) AS line FROM lineitem")
SQL["parse_fields"] = ("SELECT l_orderkey, l_linenumber, l_returnflag, "
                       "CAST(printf('%.2f', round_even(l_extendedprice, 2)) AS DOUBLE) AS price FROM lineitem")
SQL["lookup_default"] = ("SELECT event_id, CASE event_type "
                         + " ".join(f"WHEN '{k}' THEN {v}" for k, v in EVENT_ITERATIONS.items())
                         + " ELSE 100 END AS iterations FROM events")

# ---------------------------------------------------------------- sampling / parameter tables
SQL["split_random"] = (f"SELECT event_id, CASE WHEN {H(chr(39) + '0:' + chr(39) + ' || event_id')} % 100 < {TEST_PCT} "
                       f"THEN 'test' ELSE 'train' END AS split FROM events")
SQL["split_ordered"] = ("WITH p AS (SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS pos, "
                        "count(*) OVER () AS n FROM events) SELECT event_id, CASE WHEN pos < floor(n * 0.6) THEN 'train' "
                        "WHEN pos < floor(n * 0.8) THEN 'validation' ELSE 'test' END AS split FROM p")
SQL["bootstrap_sample"] = ("WITH p AS (SELECT event_id, value, row_number() OVER (ORDER BY event_id) - 1 AS pos FROM events), "
                           "n AS (SELECT count(*) AS n FROM events), "
                           "d AS (SELECT row_number() OVER () - 1 AS draw FROM events) "
                           f"SELECT d.draw, p.event_id, p.value FROM d, n, p WHERE p.pos = {H60(chr(39) + '7:' + chr(39) + ' || d.draw')} % n.n")
SQL["kfold_assign"] = (f"SELECT event_id, event_type, ((row_number() OVER (PARTITION BY event_type ORDER BY "
                       f"{H(chr(39) + '0:' + chr(39) + ' || event_id')}, event_id) - 1) % 10)::INTEGER AS fold FROM events")
_PG = [{"q_max": a, "disc_max": b} for a, b in itertools.product(Q_MAX, DISC_MAX)]
SQL["param_grid"] = ("WITH g(grid_idx, q_max, disc_max) AS (VALUES "
                     + ", ".join(f"({i}, {g['q_max']}, {D(g['disc_max'])})" for i, g in enumerate(_PG))
                     + ") SELECT grid_idx, q_max, disc_max, (SELECT count(*) FROM lineitem "
                       "WHERE l_quantity <= g.q_max AND l_discount <= g.disc_max)::BIGINT AS n_rows FROM g")
_PZ = [{"temp": a, "cooling": b} for a, b in zip(TEMPS, COOLINGS, strict=True)]
SQL["param_zip"] = ("WITH g(grid_idx, temp, cooling, tc) AS (VALUES "
                    + ", ".join(f"({i}, {D(g['temp'])}, {D(g['cooling'])}, {D(g['temp'] * g['cooling'])})"
                                for i, g in enumerate(_PZ))
                    + ") SELECT grid_idx, temp, cooling, round((SELECT avg(exp(-value / g.tc)) FROM events), 6) "
                      "AS mean_accept FROM g")
_RESTART = ("rs AS (SELECT day(ts)::INTEGER AS budget, s.seed, "
            f"avg(value * ({H('s.seed::VARCHAR || chr(58) || event_id::VARCHAR')}::DOUBLE / 4294967296.0::DOUBLE)) AS score "
            "FROM events, (SELECT range::INTEGER AS seed FROM range(5)) s GROUP BY ALL)")
SQL["restart_grid"] = f"WITH {_RESTART} SELECT budget, seed, round(score, 6) AS score FROM rs"
SQL["cross_params"] = ("SELECT event_type AS experiment, p.param, count(*) FILTER (WHERE value > p.param * 10)::BIGINT AS n "
                       "FROM events, (VALUES " + ", ".join(f"({p})" for p in CROSS_PARAMS) + ") p(param) GROUP BY ALL")

# ---------------------------------------------------------------- joins
SQL["bind_columns"] = ("SELECT coalesce(d.doc_id, l.doc_id) AS doc_id, d.n_chars, l.quality::DOUBLE AS quality, "
                       "l.toxic::DOUBLE AS toxic "
                       "FROM documents d FULL OUTER JOIN labels l ON d.doc_id = l.doc_id")
SQL["attach_labels"] = "SELECT doc_id, d.lang, l.quality, l.toxic FROM documents d JOIN labels l USING (doc_id)"
SQL["zip_truth_pred"] = f"WITH {TP} SELECT doc_id, y, yhat FROM tp"
SQL["pairwise_distance"] = (
    f"WITH {EMB}, u AS (SELECT label, i, avg(v[i]) AS m FROM emb, range(1, 65) r(i) GROUP BY label, i), "
    "c AS (SELECT label, list(m ORDER BY i) AS cv FROM u GROUP BY label), "
    "cr AS (SELECT cv, (row_number() OVER (ORDER BY label) - 1)::INTEGER AS ref_id FROM c) "
    "SELECT emb.vec_id, cr.ref_id, round(list_distance(emb.v, cr.cv), 6) AS distance FROM emb, cr")
_KNN = (f"{EMB}, es AS (SELECT *, CASE WHEN {H(chr(39) + '0:' + chr(39) + ' || vec_id')} % 100 < {TEST_PCT} "
        "THEN 'test' ELSE 'train' END AS split FROM emb), "
        "qq AS (SELECT vec_id AS qid, v, label FROM es WHERE split = 'test'), "
        "bb AS (SELECT vec_id AS bid, v, label FROM es WHERE split = 'train'), "
        "dd AS (SELECT qid, bid, bb.label AS blabel, sqrt(list_reduce(list_transform(list_zip(qq.v, bb.v), "
        "lambda t: (t[1] - t[2]) * (t[1] - t[2])), lambda a, b: a + b)) AS distance FROM qq, bb), "
        "rk AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY distance, bid) AS rank FROM dd), "
        f"nb AS (SELECT * FROM rk WHERE rank <= {KNN_K})")
SQL["knn_join"] = f"WITH {_KNN} SELECT qid, bid, round(distance, 6) AS distance FROM nb"
SQL["rank_neighbours"] = f"WITH {_KNN} SELECT qid, bid, rank::INTEGER AS rank FROM nb"
SQL["clf_knn"] = (f"WITH {_KNN}, vt AS (SELECT qid, blabel AS label, count(*) AS n FROM nb GROUP BY ALL), "
                  "pr AS (SELECT qid, label AS prediction FROM (SELECT *, row_number() OVER (PARTITION BY qid "
                  "ORDER BY n DESC, label) AS rn FROM vt) WHERE rn = 1) "
                  "SELECT qq.qid, qq.label, pr.prediction FROM qq LEFT JOIN pr USING (qid)")

# ---------------------------------------------------------------- metrics
_CNT = (f"{TP}, c AS (SELECT sum((y = 1 AND yhat = 1)::INTEGER)::BIGINT AS tp, sum((y <> 1 AND yhat = 1)::INTEGER)::BIGINT AS fp, "
        "sum((y <> 1 AND yhat <> 1)::INTEGER)::BIGINT AS tn, sum((y = 1 AND yhat <> 1)::INTEGER)::BIGINT AS fn, "
        "count(*)::BIGINT AS n FROM tp)")
_MET = {
    "accuracy": "coalesce((tp + tn)::DOUBLE / nullif(n, 0), 0)",
    "precision": "coalesce(tp::DOUBLE / nullif(tp + fp, 0), 0)",
    "recall": "coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0)",
    "f1": "coalesce(2 * tp::DOUBLE / nullif(2 * tp + fp + fn, 0), 0)",
    "auc_hard": "(coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0) + coalesce(tn::DOUBLE / nullif(tn + fp, 0), 0)) / 2",
}
for _k, _e in _MET.items():
    SQL[_k] = f"WITH {_CNT} SELECT round({_e}, 6) AS {_k} FROM c"
SQL["metric_report"] = (f"WITH {_CNT} SELECT tp, fp, tn, fn, n, "
                        + ", ".join(f"round({e}, 6) AS {k}" for k, e in _MET.items()) + " FROM c")
SQL["union_results"] = " UNION ALL ".join(
    f"(WITH {TP}, c AS (SELECT sum(({t} = 1 AND yhat = 1)::INTEGER)::BIGINT AS tp, "
    f"sum(({t} <> 1 AND yhat = 1)::INTEGER)::BIGINT AS fp, sum(({t} <> 1 AND yhat <> 1)::INTEGER)::BIGINT AS tn, "
    f"sum(({t} = 1 AND yhat <> 1)::INTEGER)::BIGINT AS fn, count(*)::BIGINT AS n FROM tp) "
    f"SELECT '{name}' AS task, tp, fp, tn, fn, round({_MET['accuracy']}, 6) AS accuracy, round({_MET['f1']}, 6) AS f1 FROM c)"
    for name, t in (("quality", "y"), ("toxic", "toxic")))
SQL["confusion_matrix"] = (f"WITH {TP} SELECT dom.y, dom.yhat, count(tp.doc_id)::BIGINT AS n FROM "
                           "(VALUES (0, 0), (0, 1), (1, 0), (1, 1)) dom(y, yhat) LEFT JOIN tp "
                           "ON tp.y = dom.y AND tp.yhat = dom.yhat GROUP BY ALL")
SQL["confusion_normalized"] = (f"WITH {TP}, cm AS (SELECT dom.y, dom.yhat, count(tp.doc_id)::BIGINT AS n FROM "
                               "(VALUES (0, 0), (0, 1), (1, 0), (1, 1)) dom(y, yhat) LEFT JOIN tp "
                               "ON tp.y = dom.y AND tp.yhat = dom.yhat GROUP BY ALL) "
                               "SELECT y, yhat, n, round(coalesce(n::DOUBLE / nullif(sum(n) OVER (PARTITION BY y), 0), 0), 6) "
                               "AS share FROM cm")
SQL["sum_squared_error"] = ("SELECT round(sum(power(value / 100 - (event_type = 'purchase')::DOUBLE, 2)), 6) AS sse "
                            "FROM events")
SQL["percent_correct"] = ("SELECT round(avg((abs(value / 100 - (event_type = 'purchase')::DOUBLE) < 0.5)::INTEGER::DOUBLE) "
                          "* 100, 6) AS pct_correct FROM events")
SQL["cluster_mode_vote"] = (f"WITH {TP}, vt AS (SELECT source, y, count(*) AS n, min(doc_id) AS first FROM tp GROUP BY ALL), "
                            "w AS (SELECT source, y AS yhat FROM (SELECT *, row_number() OVER (PARTITION BY source "
                            "ORDER BY n DESC, first) AS rn FROM vt) WHERE rn = 1) "
                            "SELECT tp.source, tp.doc_id, tp.y, w.yhat FROM tp LEFT JOIN w USING (source)")
_HOMO = ("cont AS (SELECT {k} AS k, {c} AS c, count(*)::DOUBLE AS n FROM {t} GROUP BY ALL), "
         "nk AS (SELECT k, sum(n) AS nk FROM cont GROUP BY k), nc AS (SELECT c, sum(n) AS nc FROM cont GROUP BY c), "
         "tot AS (SELECT sum(n) AS nn FROM cont), "
         "hck AS (SELECT sum(-n / nn * ln(n / nk)) AS h FROM cont JOIN nk USING (k), tot), "
         "hc AS (SELECT sum(-nc / nn * ln(nc / nn)) AS h FROM nc, tot)")
SQL["homogeneity"] = (f"WITH {TP}, " + _HOMO.format(k="source", c="y", t="tp")
                      + " SELECT round(CASE WHEN hc.h <= 1e-15 THEN 1.0 ELSE 1 - hck.h / hc.h END, 6) AS homogeneity "
                        "FROM hck, hc")
SQL["silhouette_sq"] = (
    f"WITH {EMB}, pr AS (SELECT a.vec_id AS i, a.label AS ki, b.label AS kj, "
    "list_reduce(list_transform(list_zip(a.v, b.v), lambda t: (t[1] - t[2]) * (t[1] - t[2])), lambda x, y: x + y) AS d "
    "FROM emb a, emb b), "
    "pc AS (SELECT i, ki, kj, sum(d) AS s, count(*) AS n FROM pr GROUP BY ALL), "
    "own AS (SELECT i, CASE WHEN n > 1 THEN s / (n - 1) END AS a, n FROM pc WHERE ki = kj), "
    "oth AS (SELECT i, min(s / n) AS b FROM pc WHERE ki <> kj GROUP BY i), "
    "sc AS (SELECT CASE WHEN own.n <= 1 THEN 0.0 ELSE (b - a) / greatest(a, b) END AS s FROM own JOIN oth USING (i)) "
    "SELECT round(avg(s), 6) AS silhouette FROM sc")
_FOLDS = (f"f AS (SELECT event_id, event_type, value, (row_number() OVER (PARTITION BY event_type ORDER BY "
          f"{H(chr(39) + '0:' + chr(39) + ' || event_id')}, event_id) - 1) % 10 AS fold FROM events), "
          "fs AS (SELECT event_type, fold, avg(value) AS score FROM f GROUP BY ALL)")
SQL["fold_mean_std"] = (f"WITH {_FOLDS} SELECT event_type, round(avg(score), 6) AS mean, "
                        "round(stddev_pop(score), 6) AS std FROM fs GROUP BY ALL")
SQL["restart_mean_std"] = (f"WITH {_RESTART} SELECT budget, round(avg(score), 6) AS mean, "
                           "round(stddev_samp(score), 6) AS std FROM rs GROUP BY ALL")
_RUNS = ("ra AS (SELECT algo, budget, avg(best) AS mean_fitness, avg(sec) AS mean_seconds, count(*) AS runs FROM "
         "(SELECT event_type AS algo, day(ts)::INTEGER AS budget, user_id % 5 AS run, max(value) AS best, "
         "sum(value / 10) AS sec FROM events GROUP BY ALL) GROUP BY ALL)")
SQL["run_average"] = (f"WITH {_RUNS} SELECT algo, budget, round(mean_fitness, 6) AS mean_fitness, "
                      "round(mean_seconds, 6) AS mean_seconds, runs FROM ra")
SQL["run_average_wide"] = (f"WITH {_RUNS} SELECT budget, "
                           + ", ".join(f"round(max(CASE WHEN algo = '{a}' THEN mean_fitness END), 6) AS {a}_fitness, "
                                       f"round(max(CASE WHEN algo = '{a}' THEN mean_seconds END), 6) AS {a}_seconds"
                                       for a in ("click", "error", "purchase", "signup", "view")) + " FROM ra GROUP BY budget")
_EPI = ("ep AS (SELECT user_id, sum(value) AS reward, count(*) AS steps, "
        "((epoch_us(max(ts)) - epoch_us(min(ts))) // 1000)::BIGINT AS ms FROM events GROUP BY user_id)")
SQL["episode_summary"] = f"WITH {_EPI} SELECT user_id, round(reward, 6) AS reward, steps, ms FROM ep"
SQL["episode_totals"] = (f"WITH {_EPI} SELECT round(avg(reward), 6) AS mean_reward, "
                         "(sum(steps) // count(*))::BIGINT AS mean_steps_int, min(steps) AS min_steps, "
                         "round(avg(ms), 2) AS mean_ms, count(*) AS episodes FROM ep")
SQL["column_min_max"] = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", min({c})::DOUBLE AS min, max({c})::DOUBLE AS max FROM lineitem" for c in LINE_NUM)
SQL["kurtosis_abs_mean"] = (f"WITH {EMB}, k AS (SELECT i, kurtosis(v[i]) AS k FROM emb, range(1, 65) r(i) GROUP BY i) "
                            "SELECT round(avg(abs(k)), 6) AS kurtosis_abs_mean FROM k")
SQL["distinct_levels"] = "SELECT DISTINCT lang FROM documents"
SQL["entropy_gain"] = (
    "WITH lg AS (SELECT 'l_linestatus' AS feature, l_linestatus AS v, l_returnflag AS yv FROM lineitem UNION ALL "
    "SELECT 'l_linenumber', l_linenumber::VARCHAR, l_returnflag FROM lineitem), "
    "cn AS (SELECT feature, v, yv, count(*)::DOUBLE AS n FROM lg GROUP BY ALL), "
    "nv AS (SELECT feature, v, sum(n) AS nv FROM cn GROUP BY ALL), "
    "ny AS (SELECT feature, yv, sum(n) AS ny FROM cn GROUP BY ALL), "
    "tt AS (SELECT feature, sum(n) AS nn FROM cn GROUP BY ALL), "
    "hy AS (SELECT feature, sum(-ny / nn * ln(ny / nn)) AS h FROM ny JOIN tt USING (feature) GROUP BY ALL), "
    "hcond AS (SELECT feature, sum(-n / nn * ln(n / nv)) AS h FROM cn JOIN nv USING (feature, v) "
    "JOIN tt USING (feature) GROUP BY ALL) "
    "SELECT feature, round(hy.h - hcond.h, 6) AS gain FROM hy JOIN hcond USING (feature)")

# ---------------------------------------------------------------- windows
_DIMS = (f"{EMB}, dm AS (SELECT (i - 1)::INTEGER AS dim, var_samp(v[i]) AS var, abs(corr(v[i], y::DOUBLE)) AS ac "
         "FROM emb, range(1, 65) r(i) GROUP BY i), "
         "dt AS (SELECT dim, var / sum(var) OVER () AS ratio, ac / sum(ac) OVER () AS importance FROM dm)")
SQL["cum_explained_variance"] = (f"WITH {_DIMS} SELECT dim, round(ratio, 6) AS ratio, round(sum(ratio) OVER "
                                 "(ORDER BY ratio DESC, dim ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) "
                                 "AS cum_ratio FROM dt")
SQL["cum_importance"] = (f"WITH {_DIMS}, ci AS (SELECT dim, importance, sum(importance) OVER (ORDER BY importance DESC, "
                         "dim ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum FROM dt) "
                         "SELECT dim, round(importance, 6) AS importance, round(cum, 6) AS cum FROM ci WHERE cum <= 0.95")
SQL["best_params"] = (
    f"WITH {TP}, f AS (SELECT doc_id, n_chars, y, (row_number() OVER (PARTITION BY y ORDER BY "
    f"{H(chr(39) + '0:' + chr(39) + ' || doc_id')}, doc_id) - 1) % 5 AS fold FROM tp), "
    "g(grid_idx, threshold) AS (VALUES " + ", ".join(f"({i}, {t})" for i, t in enumerate(THRESHOLDS)) + "), "
    "pf AS (SELECT grid_idx, threshold, fold, avg((((n_chars > threshold)::INTEGER) = y)::INTEGER::DOUBLE) AS acc "
    "FROM f, g GROUP BY ALL), ms AS (SELECT grid_idx, threshold, avg(acc) AS mean_score FROM pf GROUP BY ALL) "
    "SELECT grid_idx, threshold, round(mean_score, 6) AS mean_score FROM ms ORDER BY mean_score DESC, grid_idx LIMIT 1")
SQL["elbow_kernel"] = (
    f"WITH {EMB}, sd AS (SELECT v AS c, row_number() OVER (ORDER BY {H(chr(39) + 'elbow:' + chr(39) + ' || vec_id')}, vec_id) AS i "
    "FROM emb QUALIFY i <= 48), "
    "ds AS (SELECT vec_id, label, i, round(sqrt(list_reduce(list_transform(list_zip(v, c), lambda t: (t[1] - t[2]) * (t[1] - t[2])), "
    "lambda p, r: p + r)), 9) AS d FROM emb, sd), "
    "ks AS (SELECT unnest(range(2, 49, 2)) AS k), "
    "nr AS (SELECT k, vec_id, label, arg_min(i, (d, i)) AS c FROM ds, ks WHERE i <= k GROUP BY k, vec_id, label), "
    "cont AS (SELECT k, c, label, count(*)::DOUBLE AS n FROM nr GROUP BY ALL), "
    "nk AS (SELECT k, c, sum(n) AS nk FROM cont GROUP BY ALL), nc AS (SELECT k, label, sum(n) AS nc FROM cont GROUP BY ALL), "
    "tt AS (SELECT k, sum(n) AS nn FROM cont GROUP BY ALL), "
    "hck AS (SELECT k, sum(-n / nn * ln(n / nk)) AS h FROM cont JOIN nk USING (k, c) JOIN tt USING (k) GROUP BY k), "
    "hc AS (SELECT k, sum(-nc / nn * ln(nc / nn)) AS h FROM nc JOIN tt USING (k) GROUP BY k), "
    "hh AS (SELECT k, 1 - hck.h / hc.h AS h FROM hck JOIN hc USING (k)) "
    "SELECT k::INTEGER AS k, round(h, 6) AS homogeneity, round(h - lag(h) OVER (ORDER BY k), 6) AS delta FROM hh")

# ---------------------------------------------------------------- sorts / top-k / unions
SQL["sort_desc"] = ("SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem "
                    "ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber")
SQL["top_1_per_group"] = ("WITH c AS (SELECT lang, source, count(*) AS n FROM documents GROUP BY ALL) "
                          "SELECT lang, source, n FROM (SELECT *, row_number() OVER (PARTITION BY lang "
                          "ORDER BY n DESC, source) AS rn FROM c) WHERE rn = 1")
SQL["top_k"] = "SELECT event_id, value FROM events ORDER BY value DESC, event_id LIMIT 10"

# ---------------------------------------------------------------- sequences
_BITS = ("bits AS (SELECT user_id, (value > 50)::INTEGER AS bit, "
         "row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS p, "
         "row_number() OVER (PARTITION BY user_id, (value > 50)::INTEGER ORDER BY ts, event_id) - 1 AS q FROM events)")
SQL["longest_run"] = (f"WITH {_BITS}, isl AS (SELECT user_id, bit, p - q AS isl, count(*) AS len FROM bits GROUP BY ALL) "
                      "SELECT user_id, bit, max(len) AS longest FROM isl GROUP BY ALL")
SQL["edge_runs"] = (f"WITH {_BITS}, g AS (SELECT user_id, count(*) AS n, min(p) FILTER (WHERE bit = 0) AS f0, "
                    "max(p) FILTER (WHERE bit = 1) AS l1 FROM bits GROUP BY user_id), "
                    "h AS (SELECT user_id, n, coalesce(f0, n) AS head, CASE WHEN l1 IS NULL THEN n ELSE n - 1 - l1 END AS tail "
                    "FROM g) SELECT user_id, n, head, tail, greatest(head, tail) + "
                    f"CASE WHEN head > {RUN_T} AND tail > {RUN_T} THEN n ELSE 0 END AS fitness FROM h")
_ROUTE = ("WITH r AS (SELECT label, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y, "
          "row_number() OVER (PARTITION BY label ORDER BY {order}) AS p, count(*) OVER (PARTITION BY label) AS n "
          "FROM embeddings), l AS (SELECT a.label, a.n, sqrt((b.x - a.x) * (b.x - a.x) + (b.y - a.y) * (b.y - a.y)) AS d "
          "FROM r a JOIN r b ON a.label = b.label AND b.p = (a.p % a.n) + 1) "
          "SELECT label, n, round(sum(d), 6) AS length FROM l GROUP BY ALL")
SQL["route_length"] = _ROUTE.format(order="vec_id")
SQL["sort_encoded_route"] = _ROUTE.format(order="embedding[3]::DOUBLE, vec_id")
_MI_PAIRS = [(a, b) for i, a in enumerate(MI_COLS) for b in MI_COLS[i + 1:]]
SQL["pairwise_mutual_information"] = (
    "WITH lg AS (" + " UNION ALL ".join(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, {a}::VARCHAR AS va, {b}::VARCHAR AS vb FROM lineitem"
        for a, b in _MI_PAIRS) + "), "
    "j AS (SELECT col_a, col_b, va, vb, count(*)::DOUBLE AS n FROM lg GROUP BY ALL), "
    "ma AS (SELECT col_a, col_b, va, sum(n) AS na FROM j GROUP BY ALL), "
    "mb AS (SELECT col_a, col_b, vb, sum(n) AS nb FROM j GROUP BY ALL), "
    "tt AS (SELECT col_a, col_b, sum(n) AS nn FROM j GROUP BY ALL) "
    "SELECT col_a, col_b, round(sum(n / nn * ln(n * nn / (na * nb))), 6) AS mi FROM j "
    "JOIN ma USING (col_a, col_b, va) JOIN mb USING (col_a, col_b, vb) JOIN tt USING (col_a, col_b) GROUP BY ALL")

# ---------------------------------------------------------------- planning

SQL["grid_to_cells"] = (
    "WITH l AS (SELECT coalesce(p_name, '') AS t, count(*) OVER () - row_number() OVER (ORDER BY p_partkey) AS y FROM part) "
    "SELECT (i - 1)::INTEGER AS x, y, substr(t, i::INTEGER, 1) AS kind "
    "FROM (SELECT t, y, unnest(range(1, length(t) + 1)) AS i FROM l)")
_TRANS = (
    "lg AS (SELECT event_type, event_type || ':' || floor(least(value, 199.0) / 25)::BIGINT AS s, user_id % 4 AS a, value, "
    "lead(event_type || ':' || floor(least(value, 199.0) / 25)::BIGINT) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s2 "
    "FROM events), "
    "cn AS (SELECT s, a, s2, count(*)::DOUBLE AS n, avg(value) AS r FROM lg WHERE s2 IS NOT NULL AND event_type <> 'purchase' "
    "GROUP BY ALL), "
    "tt AS (SELECT s, a, s2, n / sum(n) OVER (PARTITION BY s, a) AS p, r FROM cn), "
    "st AS (SELECT s FROM tt UNION SELECT s2 FROM tt)")
SQL["transition_table"] = f"WITH {_TRANS} SELECT s, a, s2, round(p, 6) AS p, round(r, 6) AS r FROM tt"


def _vsweep(prev: str) -> str:
    return (f"(SELECT st.s, coalesce(m.v, 0.0) AS v FROM st LEFT JOIN (SELECT s, max(q) AS v FROM "
            f"(SELECT tt.s, tt.a, sum(tt.p * (tt.r + {D(GAMMA)} * coalesce(vp.v, 0.0))) AS q FROM tt "
            f"LEFT JOIN {prev} vp ON vp.s = tt.s2 GROUP BY tt.s, tt.a) GROUP BY s) m ON m.s = st.s)")


def _qvals(v: str) -> str:
    return (f"(SELECT tt.s, tt.a, sum(tt.p * (tt.r + {D(GAMMA)} * coalesce(vp.v, 0.0))) AS q FROM tt "
            f"LEFT JOIN {v} vp ON vp.s = tt.s2 GROUP BY tt.s, tt.a)")


def _greedy(v: str) -> str:
    return (f"(SELECT s, a, q FROM (SELECT *, row_number() OVER (PARTITION BY s ORDER BY round(q, 9) DESC, a) AS rn "
            f"FROM {_qvals(v)}) WHERE rn = 1)")


_VI_N = VALUE_SWEEPS
_VI = (f"{_TRANS}, v0 AS (SELECT s, 0.0::DOUBLE AS v FROM st), "
       + ", ".join(f"v{k} AS {_vsweep(f'v{k - 1}')}" for k in range(1, _VI_N + 1)) + ", "
       + "dl AS (" + " UNION ALL ".join(f"SELECT {k} AS k, max(abs(a.v - b.v)) AS delta FROM v{k} a JOIN v{k - 1} b USING (s)"
                                         for k in range(1, _VI_N + 1)) + "), "
       + f"stp AS (SELECT coalesce(min(k) FILTER (WHERE delta < {D(THETA)}), {_VI_N})::INTEGER AS k FROM dl), "
       + "av AS (" + " UNION ALL ".join(f"SELECT {k} AS k, s, v FROM v{k}" for k in range(1, _VI_N + 1)) + "), "
       + "vf AS (SELECT s, v, stp.k AS sweeps FROM av JOIN stp USING (k))")
SQL["value_iteration"] = f"WITH {_VI} SELECT s, round(v, 6) AS v, sweeps FROM vf"
SQL["greedy_policy"] = f"WITH {_VI}, g AS {_greedy('vf')} SELECT s, a, round(q, 6) AS q FROM g"


def _policy_sql() -> str:
    rounds, sweeps = POLICY_ROUNDS, _VI_N
    parts = [f"{_TRANS}, w0 AS (SELECT s, 0.0::DOUBLE AS v FROM st)"]
    k = 0
    for r in range(1, rounds + 1):
        parts.append(f"pol{r} AS (SELECT s, a FROM {_greedy(f'w{k}')})")
        parts.append(f"tp{r} AS (SELECT tt.* FROM tt JOIN pol{r} USING (s, a))")
        for _ in range(sweeps):
            k += 1
            parts.append(
                f"w{k} AS (SELECT st.s, coalesce(m.v, 0.0) AS v FROM st LEFT JOIN (SELECT tp.s, "
                f"sum(tp.p * (tp.r + {D(GAMMA)} * coalesce(vp.v, 0.0))) AS v FROM tp{r} tp "
                f"LEFT JOIN w{k - 1} vp ON vp.s = tp.s2 GROUP BY tp.s) m ON m.s = st.s)")
    parts.append(f"fin AS (SELECT s, a FROM {_greedy(f'w{k}')})")
    return "WITH " + ", ".join(parts) + f" SELECT w{k}.s, round(w{k}.v, 6) AS v, fin.a FROM w{k} LEFT JOIN fin USING (s)"


SQL["policy_iteration"] = _policy_sql()
SQL["reachable_states"] = (f"WITH RECURSIVE {_TRANS}, ed AS (SELECT DISTINCT s, s2 FROM tt WHERE p > 0), "
                           "rc(s) AS (SELECT min(s) FROM st UNION SELECT ed.s2 FROM rc JOIN ed ON ed.s = rc.s) "
                           "SELECT s FROM rc")


def _fitted_q_sql(first: list[str], n: str, rs: str, table: str) -> str:
    parts = [*first, f"ag AS (SELECT s, a, s2, {n} AS n, {rs} AS rs FROM {table} GROUP BY ALL)",
             "q0 AS (SELECT DISTINCT s, a, 0.3::DOUBLE AS q FROM ag)"]
    for k in range(1, Q_SWEEPS + 1):
        parts.append(
            f"q{k} AS (SELECT q.s, q.a, {D(1 - 0.1)} * q.q + {D(0.1)} * t.t AS q FROM q{k - 1} q JOIN "
            f"(SELECT g.s, g.a, (sum(g.rs) + {D(GAMMA)} * sum(g.n * coalesce(m.m, 0.0))) / sum(g.n) AS t FROM ag g "
            f"LEFT JOIN (SELECT s, max(q) AS m FROM q{k - 1} GROUP BY s) m ON m.s = g.s2 GROUP BY g.s, g.a) t USING (s, a))")
    return "WITH " + ", ".join(parts) + f" SELECT s, a, round(q, 6) AS q FROM q{Q_SWEEPS}"


SQL["batch_q_learning"] = _fitted_q_sql(
    ["lg AS (SELECT event_type AS s, user_id % 4 AS a, value AS r, lead(event_type) OVER (ORDER BY ts, event_id) AS s2 FROM events)"],
    "count(*)::DOUBLE", "sum(r)", "lg")
SQL["udf_planner_factory"] = _fitted_q_sql([_TRANS], "sum(p)", "sum(p * r)", "tt")

# ---------------------------------------------------------------- search
_CANDS = (f"{EMB}, w AS (SELECT c.c, j.j, ({H(chr(39) + 'cand:0:' + chr(39) + ' || c.c || chr(58) || j.j')}::DOUBLE "
          f"/ 4294967296.0::DOUBLE - 0.5::DOUBLE) * 0.2::DOUBLE AS w FROM range({N_CANDIDATES}) c(c), range(64) j(j)), "
          "pr AS (SELECT emb.vec_id, w.c, sum(emb.v[w.j + 1] * w.w) AS p, any_value(emb.y) AS y FROM emb, w GROUP BY ALL)")
SQL["population_score"] = (f"WITH {_CANDS} SELECT c::INTEGER AS candidate, round(sum((p - y) * (p - y)), 6) AS sse, "
                           "round(avg((abs(p - y) < 0.5)::INTEGER::DOUBLE), 6) AS accuracy FROM pr GROUP BY c")
SQL["search_tuning_report"] = (
    f"WITH {_CANDS}, sp AS (SELECT vec_id, CASE WHEN {H(chr(39) + '0:' + chr(39) + ' || vec_id')} % 100 < {TEST_PCT} "
    "THEN 'test' ELSE 'train' END AS split FROM emb) "
    "SELECT c::INTEGER AS candidate, split, round(sum((p - y) * (p - y)), 6) AS sse, "
    "round(avg((abs(p - y) < 0.5)::INTEGER::DOUBLE), 6) AS accuracy FROM pr JOIN sp USING (vec_id) GROUP BY ALL")

# ---------------------------------------------------------------- estimator kernels
_UN = (f"{EMB}, u AS (SELECT vec_id, label, i, v[i] AS x FROM emb, range(1, 65) r(i)), "
       "pa AS (SELECT label AS k, i, avg(x) AS mu, var_pop(x) + 1e-6::DOUBLE AS var FROM u GROUP BY label, i), "
       "wk AS (SELECT label AS k, count(*)::DOUBLE / (SELECT count(*) FROM emb) AS w FROM emb GROUP BY label)")
SQL["kmeans_step"] = (
    f"WITH {_UN}, dd AS (SELECT u.vec_id, pa.k, sum((u.x - pa.mu) * (u.x - pa.mu)) AS d FROM u JOIN pa ON pa.i = u.i "
    "GROUP BY u.vec_id, pa.k), "
    "asg AS (SELECT vec_id, k, d FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, k) AS rn FROM dd) "
    "WHERE rn = 1), "
    "cs AS (SELECT k, count(*) AS n, sum(d) AS cost FROM asg GROUP BY k), "
    "nm AS (SELECT asg.k, u.i, avg(u.x) AS value FROM asg JOIN u USING (vec_id) GROUP BY asg.k, u.i) "
    "SELECT nm.k::INTEGER AS cluster, cs.n, round(cs.cost, 6) AS cost, (nm.i - 1)::INTEGER AS dim, "
    "round(nm.value, 6) AS value FROM nm JOIN cs USING (k)")
_LD = (f"{_UN}, ld AS (SELECT u.vec_id, pa.k, ln(any_value(wk.w)) - 0.5 * sum(ln(pa.var) + ln(2 * pi())) "
       "- 0.5 * sum((u.x - pa.mu) * (u.x - pa.mu) / pa.var) AS ld FROM u JOIN pa ON pa.i = u.i JOIN wk ON wk.k = pa.k "
       "GROUP BY u.vec_id, pa.k), "
       "mx AS (SELECT vec_id, max(ld) AS m FROM ld GROUP BY vec_id), "
       "lse AS (SELECT ld.vec_id, any_value(mx.m) + ln(sum(exp(ld.ld - mx.m))) AS lse FROM ld JOIN mx USING (vec_id) "
       "GROUP BY ld.vec_id)")
SQL["gmm_step"] = (
    f"WITH {_LD}, rr AS (SELECT ld.vec_id, ld.k, exp(ld.ld - lse.lse) AS r FROM ld JOIN lse USING (vec_id)), "
    "nk AS (SELECT k, sum(r) AS nk FROM rr GROUP BY k), "
    "st AS (SELECT rr.k, u.i, sum(rr.r * u.x) AS s, sum(rr.r * u.x * u.x) AS q FROM rr JOIN u USING (vec_id) GROUP BY rr.k, u.i) "
    "SELECT st.k::INTEGER AS component, round(nk.nk / (SELECT count(*) FROM emb), 6) AS weight, (st.i - 1)::INTEGER AS dim, "
    "round(st.s / nk.nk, 6) AS mean, "
    "round(greatest(st.q / nk.nk - (st.s / nk.nk) * (st.s / nk.nk) + 1e-6::DOUBLE, 1e-6::DOUBLE), 6) AS var "
    "FROM st JOIN nk USING (k)")
SQL["aic_bic"] = (
    f"WITH {_LD}, ll AS (SELECT sum(lse) AS ll, count(*) AS n FROM lse), "
    "pp AS (SELECT 2 * (SELECT count(*) FROM wk) * 64 + (SELECT count(*) FROM wk) - 1 AS p) "
    "SELECT round(ll, 6) AS loglik, round(-2 * ll + 2 * p, 6) AS aic, round(-2 * ll + p * ln(n), 6) AS bic FROM ll, pp")
SQL["covariance_matrix"] = (
    f"WITH {EMB}, u AS (SELECT vec_id, i, v[i] AS x FROM emb, range(1, 65) r(i)) "
    "SELECT (a.i - 1)::INTEGER AS i, (b.i - 1)::INTEGER AS j, round(covar_samp(a.x, b.x), 6) AS cov "
    "FROM u a JOIN u b USING (vec_id) GROUP BY a.i, b.i")
_RCA = (f"{EMB}, rm AS (SELECT i, j, CASE WHEN u < 1 / (2 * 8.0) THEN 1.0 WHEN u < 1 / 8.0 THEN -1.0 ELSE 0.0 END AS r "
        f"FROM (SELECT i, j, {H(chr(39) + 'rca:0:' + chr(39) + ' || i || chr(58) || j')}::DOUBLE / 4294967296.0::DOUBLE AS u "
        f"FROM range(64) a(i), range({RCA_K}) b(j))), "
        "pj AS (SELECT emb.vec_id, rm.j, sum(emb.v[rm.i + 1] * rm.r) AS value FROM emb, rm GROUP BY emb.vec_id, rm.j)")
SQL["rca_project"] = f"WITH {_RCA} SELECT vec_id, j::INTEGER AS component, round(value, 6) AS value FROM pj"
SQL["distance_correlation"] = (
    f"WITH {_RCA}, py AS (SELECT vec_id, list(value ORDER BY j) AS y FROM pj GROUP BY vec_id), "
    "xy AS (SELECT emb.vec_id, emb.v, py.y FROM emb JOIN py USING (vec_id)), "
    "pr AS (SELECT list_reduce(list_transform(list_zip(a.v, b.v), lambda t: (t[1] - t[2]) * (t[1] - t[2])), lambda p, q: p + q) AS d1, "
    "list_reduce(list_transform(list_zip(a.y, b.y), lambda t: (t[1] - t[2]) * (t[1] - t[2])), lambda p, q: p + q) AS d2 "
    "FROM xy a, xy b) SELECT round(corr(d1, d2), 6) AS distance_correlation FROM pr")
SQL["add_cluster_features"] = (
    f"WITH {_LD}, km AS (SELECT vec_id, k FROM (SELECT u.vec_id, pa.k, row_number() OVER (PARTITION BY u.vec_id "
    "ORDER BY sum((u.x - pa.mu) * (u.x - pa.mu)), pa.k) AS rn FROM u JOIN pa ON pa.i = u.i GROUP BY u.vec_id, pa.k) "
    "WHERE rn = 1), "
    "em AS (SELECT vec_id, k FROM (SELECT vec_id, k, row_number() OVER (PARTITION BY vec_id ORDER BY ld DESC, k) AS rn "
    "FROM ld) WHERE rn = 1) "
    "SELECT emb.vec_id, emb.label, " + ", ".join(f"(km.k = {i})::INTEGER AS km_{i}" for i in range(10)) + ", "
    + ", ".join(f"(em.k = {i})::INTEGER AS em_{i}" for i in range(10))
    + " FROM emb JOIN km USING (vec_id) JOIN em USING (vec_id)")

SQL["sink_model_table"] = (f"WITH {EMB}, c AS (SELECT label, i, avg(v[i]) AS m FROM emb, range(1, 65) r(i) GROUP BY ALL) "
                           "SELECT (dense_rank() OVER (ORDER BY label) - 1)::INTEGER AS component, (i - 1)::INTEGER AS dim, "
                           "round(m, 6) AS value FROM c")
_U = "{H}::DOUBLE / 4294967296.0::DOUBLE"
SQL["rca_gaussian"] = (
    f"WITH {EMB}, gm AS (SELECT i, j, sqrt(-2.0 * ln(1.0 - "
    + _U.format(H=H(chr(39) + "grp:0:" + chr(39) + " || i || chr(58) || j || ':1'"))
    + ")) * cos(2.0 * pi() * "
    + _U.format(H=H(chr(39) + "grp:0:" + chr(39) + " || i || chr(58) || j || ':2'"))
    + f") / sqrt({RCA_K}.0) AS r FROM range(64) a(i), range({RCA_K}) b(j)), "
    "pj AS (SELECT emb.vec_id, gm.j, sum(emb.v[gm.i + 1] * gm.r) AS value FROM emb, gm GROUP BY emb.vec_id, gm.j) "
    "SELECT vec_id, j::INTEGER AS component, round(value, 6) AS value FROM pj")

SQL["grid_search_cv_knn"] = (
    f"WITH {EMB}, f AS (SELECT vec_id, v, y, (row_number() OVER (PARTITION BY y ORDER BY "
    f"{H(chr(39) + '0:' + chr(39) + ' || vec_id')}, vec_id) - 1) % 5 AS fold FROM emb), "
    "dd AS (SELECT a.vec_id AS qid, a.y AS truth, a.fold, b.vec_id AS bid, b.y AS nl, "
    "sqrt(list_reduce(list_transform(list_zip(a.v, b.v), lambda t: (t[1] - t[2]) * (t[1] - t[2])), lambda p, q: p + q)) AS d "
    "FROM f a JOIN f b ON a.fold <> b.fold), "
    "rk AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY d, bid) AS rank FROM dd), "
    "ks AS (SELECT unnest([" + ", ".join(str(k) for k in KNN_GRID) + "]) AS k), "
    "vt AS (SELECT ks.k, qid, any_value(truth) AS truth, any_value(fold) AS fold, nl, count(*) AS n "
    "FROM rk JOIN ks ON rk.rank <= ks.k GROUP BY ks.k, qid, nl), "
    "pr AS (SELECT k, qid, truth, fold, nl AS pred FROM (SELECT *, row_number() OVER (PARTITION BY k, qid "
    "ORDER BY n DESC, nl) AS rn FROM vt) WHERE rn = 1), "
    "fa AS (SELECT k, fold, avg((pred = truth)::INTEGER::DOUBLE) AS acc FROM pr GROUP BY k, fold), "
    "ma AS (SELECT k, avg(acc) AS mean_accuracy FROM fa GROUP BY k), "
    "bk AS (SELECT k FROM ma ORDER BY mean_accuracy DESC, k LIMIT 1) "
    "SELECT ma.k, round(ma.mean_accuracy, 6) AS mean_accuracy, ma.k = (SELECT k FROM bk) AS best FROM ma")

SQL["complexity_curve_knn"] = (
    f"WITH {EMB}, es AS (SELECT *, CASE WHEN {H(chr(39) + '0:' + chr(39) + ' || vec_id')} % 100 < {TEST_PCT} "
    "THEN 'test' ELSE 'train' END AS split FROM emb), "
    "bb AS (SELECT vec_id AS bid, v, y AS nl FROM es WHERE split = 'train'), "
    "dd AS (SELECT q.split, q.vec_id AS qid, q.y AS truth, bb.bid, bb.nl, "
    "sqrt(list_reduce(list_transform(list_zip(q.v, bb.v), lambda t: (t[1] - t[2]) * (t[1] - t[2])), lambda p, r: p + r)) AS d "
    "FROM es q, bb), "
    "rk AS (SELECT *, row_number() OVER (PARTITION BY split, qid ORDER BY d, bid) AS rank FROM dd), "
    "ks AS (SELECT unnest([" + ", ".join(str(k) for k in KNN_CURVE) + "]) AS k), "
    "vt AS (SELECT ks.k, split, qid, any_value(truth) AS truth, nl, count(*) AS n FROM rk JOIN ks ON rk.rank <= ks.k "
    "GROUP BY ks.k, split, qid, nl), "
    "pr AS (SELECT k, split, qid, truth, nl AS pred FROM (SELECT *, row_number() OVER (PARTITION BY k, split, qid "
    "ORDER BY n DESC, nl) AS rn FROM vt) WHERE rn = 1), "
    "cn AS (SELECT k, split, sum((truth = 1 AND pred = 1)::INTEGER) AS tp, sum((truth <> 1 AND pred = 1)::INTEGER) AS fp, "
    "sum((truth = 1 AND pred <> 1)::INTEGER) AS fn FROM pr GROUP BY k, split) "
    "SELECT k, split, round(coalesce(2 * tp::DOUBLE / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1 FROM cn")

SQL["learning_curve_knn"] = (
    f"WITH {EMB}, src AS (SELECT vec_id, v, y, (row_number() OVER (PARTITION BY y ORDER BY "
    f"{H(chr(39) + '0:' + chr(39) + ' || vec_id')}, vec_id) - 1) % 3 AS fold FROM emb), "
    "nn AS (SELECT count(*) AS n FROM src), "
    "pos AS (SELECT *, row_number() OVER (ORDER BY vec_id) - 1 AS pos FROM src), "
    "sz AS (SELECT greatest(2, floor(n * fr))::BIGINT AS size FROM nn, (VALUES "
    + ", ".join(f"({fr})" for fr in LC_FRACTIONS) + ") t(fr)), "
    "dr AS (SELECT size, unnest(range(size)) AS j FROM sz), "
    f"smp AS (SELECT dr.size, dr.j AS draw, p.vec_id, p.v, p.y, p.fold FROM dr CROSS JOIN nn "
    f"JOIN pos p ON p.pos = {H60(chr(39) + '1:' + chr(39) + ' || dr.j')} % nn.n), "
    "fl AS (SELECT unnest([0, 1, 2]) AS f), "
    "trs AS (SELECT smp.size, fl.f, smp.draw AS bid, smp.v, smp.y AS nl FROM smp, fl WHERE smp.fold <> fl.f), "
    "qs AS (SELECT size, f, 'train' AS side, bid AS qid, v, nl AS truth FROM trs UNION ALL "
    "SELECT sz.size, fl.f, 'cv' AS side, src.vec_id AS qid, src.v, src.y AS truth FROM sz, fl, src WHERE src.fold = fl.f), "
    "dd AS (SELECT qs.size, qs.f, qs.side, qs.qid, qs.truth, trs.bid, trs.nl, "
    "sqrt(list_reduce(list_transform(list_zip(qs.v, trs.v), lambda t: (t[1] - t[2]) * (t[1] - t[2])), lambda p, r: p + r)) AS d "
    "FROM qs JOIN trs ON qs.size = trs.size AND qs.f = trs.f), "
    "rk AS (SELECT *, row_number() OVER (PARTITION BY size, f, side, qid ORDER BY d, bid) AS rank FROM dd), "
    f"vt AS (SELECT size, f, side, qid, any_value(truth) AS truth, nl, count(*) AS n FROM rk WHERE rank <= {KNN_K} "
    "GROUP BY size, f, side, qid, nl), "
    "pr AS (SELECT size, f, side, qid, truth, nl AS pred FROM (SELECT *, row_number() OVER (PARTITION BY size, f, side, qid "
    "ORDER BY n DESC, nl) AS rn FROM vt) WHERE rn = 1), "
    "cn AS (SELECT size, f, side, sum((truth = 1 AND pred = 1)::INTEGER) AS tp, sum((truth <> 1 AND pred = 1)::INTEGER) AS fp, "
    "sum((truth = 1 AND pred <> 1)::INTEGER) AS fn FROM pr GROUP BY size, f, side), "
    "fs AS (SELECT size, side, coalesce(2 * tp::DOUBLE / nullif(2 * tp + fp + fn, 0), 0) AS f1 FROM cn), "
    "ag AS (SELECT size, side, avg(f1) AS m, stddev_pop(f1) AS s FROM fs GROUP BY size, side) "
    "SELECT size::INTEGER AS train_size, "
    "round(max(CASE WHEN side = 'train' THEN m END), 6) AS train_f1_mean, "
    "round(max(CASE WHEN side = 'train' THEN s END), 6) AS train_f1_std, "
    "round(max(CASE WHEN side = 'cv' THEN m END), 6) AS cv_f1_mean, "
    "round(max(CASE WHEN side = 'cv' THEN s END), 6) AS cv_f1_std FROM ag GROUP BY size")

# ---------------------------------------------------------------- kernels of fitted models
_Q = chr(39)
SQL["rbf_features"] = (
    f"WITH {EMB}, w AS (SELECT i, j, sqrt(2.0::DOUBLE) * sqrt(-2.0 * ln(1.0 - {H(f'{_Q}rff:0:{_Q} || i || chr(58) || j || {_Q}:1{_Q}')}::DOUBLE / 4294967296.0)) "
    f"* cos(2 * pi() * ({H(f'{_Q}rff:0:{_Q} || i || chr(58) || j || {_Q}:2{_Q}')}::DOUBLE / 4294967296.0)) AS w FROM range(32) a(i), range(64) b(j)), "
    f"b AS (SELECT i, 2 * pi() * ({H(f'{_Q}rff:0:{_Q} || i || {_Q}:b{_Q}')}::DOUBLE / 4294967296.0) AS b FROM range(32) a(i)), "
    "z AS (SELECT emb.vec_id, w.i, sum(emb.v[w.j + 1] * w.w) AS z FROM emb, w GROUP BY ALL) "
    "SELECT vec_id, z.i::INTEGER AS component, round(sqrt(2.0 / 32) * cos(z + b.b), 6) AS value FROM z JOIN b USING (i)")
SQL["sigmoid_features"] = (
    f"WITH {EMB}, lm AS (SELECT v AS l, row_number() OVER (ORDER BY {H(f'{_Q}lm0:{_Q} || vec_id')}, vec_id) - 1 AS i FROM emb QUALIFY i < 32) "
    "SELECT vec_id, i::INTEGER AS component, round(tanh(0.1::DOUBLE * list_reduce(list_transform(list_zip(v, l), lambda t: t[1] * t[2]), "
    "lambda p, r: p + r)), 6) AS value FROM emb, lm")
SQL["pca_trace"] = (
    f"WITH {EMB}, u AS (SELECT i, v[i] AS x FROM emb, range(1, 65) r(i)), s AS (SELECT i, var_samp(x) AS s FROM u GROUP BY i) "
    "SELECT count(*) AS components, round(1.0::DOUBLE, 6) AS ratio, round(sum(s), 6) AS variance FROM s")
# three columns: the maximum spanning tree leaves out the weakest pair
_MI = SQL["pairwise_mutual_information"].replace("round(sum(n / nn * ln(n * nn / (na * nb))), 6) AS mi", "sum(n / nn * ln(n * nn / (na * nb))) AS mi")
SQL["chow_liu_tree"] = f"SELECT col_a, col_b, round(mi, 6) AS mi FROM ({_MI}) ORDER BY mi DESC, col_a, col_b LIMIT 2"
SQL["udf_objective"] = (
    f"WITH {_CANDS}, ps AS (SELECT c, y, 1 / (1 + exp(-p)) AS p FROM pr) SELECT c::INTEGER AS candidate, round(sum(abs(p - y)), 6) AS error, "
    "round(avg((abs(p - y) < 0.5)::INTEGER::DOUBLE), 6) AS accuracy FROM ps GROUP BY c")


# ---------------------------------------------------------------- tree levels, hashed draws


def _tree_levels(folds: int, depth: int, min_leaf: int, bins: int) -> str:
    """One tree a fold by plain SQL: histograms, gains and the best split of every node, level by level."""
    def entropy(a, b):
        return f"(CASE WHEN {a} > 0 THEN -{a} / ({a} + {b}) * log2({a} / ({a} + {b})) ELSE 0 END + " \
               f"CASE WHEN {b} > 0 THEN -{b} / ({a} + {b}) * log2({b} / ({a} + {b})) ELSE 0 END)"
    h = H("'0:' || vec_id")
    quantiles = ", ".join(f"{i}.0 / {bins}" for i in range(1, bins))
    ctes = [EMB,
            f"folded AS (SELECT *, (row_number() OVER (PARTITION BY y ORDER BY {h}, vec_id) - 1) % {folds} AS own FROM emb)",
            "x AS (SELECT vec_id, generate_subscripts(v, 1) - 1 AS f, unnest(v) AS x FROM folded)",
            f"borders AS (SELECT f, list_distinct(quantile_disc(x, [{quantiles}])) AS q FROM x GROUP BY f)",
            "cell AS MATERIALIZED (SELECT vec_id, f, len(list_filter(q, lambda e: e < x)) AS bin FROM x JOIN borders USING (f))",
            f"r0 AS (SELECT k, vec_id, y, own <> k AS tr, '' AS path FROM folded, (SELECT unnest(range({folds})) AS k))"]
    for d in range(depth):
        ctes += [
            f"h{d} AS (SELECT k, path, f, bin, count(*) FILTER (y = 0)::DOUBLE AS c0, count(*) FILTER (y = 1)::DOUBLE AS c1 "
            f"FROM r{d} JOIN cell USING (vec_id) WHERE tr GROUP BY ALL)",
            f"l{d} AS (SELECT k, path, f, bin, sum(c0) OVER w AS a0, sum(c1) OVER w AS a1, sum(c0) OVER t AS t0, sum(c1) OVER t AS t1 FROM h{d} "
            f"WINDOW w AS (PARTITION BY k, path, f ORDER BY bin), t AS (PARTITION BY k, path, f))",
            f"g{d} AS (SELECT *, round({entropy('t0', 't1')} - ((a0 + a1) * {entropy('a0', 'a1')} + (t0 + t1 - a0 - a1) * "
            f"{entropy('(t0 - a0)', '(t1 - a1)')}) / (t0 + t1), 9) AS gain FROM l{d} "
            f"WHERE a0 + a1 >= {min_leaf} AND t0 + t1 - a0 - a1 >= {min_leaf})",
            f"s{d} AS (SELECT k, path, f, bin AS cut, gain FROM g{d} WHERE gain > 0 "
            f"QUALIFY row_number() OVER (PARTITION BY k, path ORDER BY gain DESC, f, bin) = 1)",
            f"r{d + 1} AS (SELECT r.k, vec_id, y, tr, path || CASE WHEN bin <= cut THEN 'L' ELSE 'R' END AS path "
            f"FROM r{d} r JOIN s{d} s USING (k, path) JOIN cell USING (vec_id, f))"]
    nodes = " UNION ALL ".join(
        f"SELECT r.k, r.path, y, tr, {'s.f, s.cut, s.gain' if d < depth else 'NULL AS f, NULL AS cut, NULL::DOUBLE AS gain'} FROM r{d} r"
        + (f" LEFT JOIN s{d} s USING (k, path)" if d < depth else "") for d in range(depth + 1))
    return ("WITH " + ", ".join(ctes) + f" SELECT k::INTEGER AS fold, path, count(*) FILTER (tr AND y = 0)::BIGINT AS n0, "
            "count(*) FILTER (tr AND y = 1)::BIGINT AS n1, count(*) FILTER (NOT tr AND y = 0)::BIGINT AS held0, "
            "count(*) FILTER (NOT tr AND y = 1)::BIGINT AS held1, any_value(f)::INTEGER AS feature, any_value(cut)::INTEGER AS cut, "
            f"round(any_value(gain), 6) AS gain FROM ({nodes}) GROUP BY k, path")


SQL["tree_levels"] = _tree_levels(folds=5, depth=3, min_leaf=5, bins=32)


def _poisson(mean: float, index: int) -> str:
    """Number of Poisson distribution steps at or below the row's hashed draw."""
    term = total = math.exp(-mean)
    steps, k = [], 0
    while total < 1 - 2.0 ** -33 and term > 0:
        steps.append(total)
        k += 1
        term *= mean / k
        total += term
    u = f"({H(f"'boot0:{index}:' || event_id")} / 4294967296.0)"
    return f"len(list_filter([{', '.join(D(s) for s in steps)}], lambda c: c <= {u}))::INTEGER AS w{index}"


SQL["poisson_draws"] = "SELECT event_id, " + ", ".join(_poisson(m, i) for i, m in enumerate((0.05, 0.5, 1.0))) + " FROM events"

SQL["poly_features"] = (
    f"WITH {EMB}, t AS (SELECT k, i, ({H("'cell:0:' || k || ':' || i")} % 32)::INTEGER AS cell, 1 - 2 * ({H("'sign:0:' || k || ':' || i")} % 2) AS sign "
    "FROM range(3) a(k), range(64) b(i)), "
    "s AS (SELECT vec_id, k, cell, sum(v[i + 1] * sign) AS s FROM emb, t GROUP BY ALL), "
    "two AS (SELECT a.vec_id, (a.cell + b.cell) % 32 AS cell, sum(a.s * b.s) AS s FROM s a JOIN s b USING (vec_id) WHERE a.k = 0 AND b.k = 1 GROUP BY ALL), "
    "three AS (SELECT a.vec_id, (a.cell + b.cell) % 32 AS cell, sum(a.s * b.s) AS s FROM two a JOIN s b USING (vec_id) WHERE b.k = 2 GROUP BY ALL) "
    "SELECT c.vec_id, c.i::INTEGER AS component, round(coalesce(s, 0), 9) + 0.0 AS value FROM (SELECT vec_id, i FROM emb, range(32) r(i)) c "
    "LEFT JOIN three ON three.vec_id = c.vec_id AND three.cell = c.i")


# ---------------------------------------------------------------- search: generations unrolled

_MOMENTS = (f"{EMB}, gm AS MATERIALIZED (SELECT list(r ORDER BY i) AS g FROM (SELECT i, list(x ORDER BY j) AS r FROM (SELECT i, j, sum(v[i] * v[j]) AS x "
            "FROM emb, range(1, 65) a(i), range(1, 65) b(j) GROUP BY i, j) GROUP BY i)), "
            "bm AS (SELECT list(x ORDER BY i) AS b FROM (SELECT i, sum(v[i] * y) AS x FROM emb, range(1, 65) a(i) GROUP BY i)), "
            "mo AS MATERIALIZED (SELECT g, b, (SELECT sum(y * y) FROM emb)::DOUBLE AS yy FROM gm, bm)")


def _u(key: str) -> str:
    """Hashed draw in [0, 1) of a ':'-joined key (SQL text with || for the variable parts)."""
    return f"({H(key)} / 4294967296.0::DOUBLE)"


def _sse(w: str) -> str:
    return f"round(yy - 2 * list_dot_product(b, {w}) + list_sum(list_transform(range(1, 65), lambda i: {w}[i] * list_dot_product(g[i], {w}))), 9)"


def _best_rows(generations: int, temperature: str = "") -> str:
    past = " UNION ALL ".join(f"SELECT {g} AS generation, w, sse FROM best{g}" for g in range(1, generations + 1))
    return (f" SELECT generation::INTEGER AS generation, round(any_value(sse), 6) AS sse{temperature}, "
            f"round(avg((abs(list_dot_product(v, w) - y) < 0.5)::INTEGER::DOUBLE), 6) AS accuracy FROM ({past}), emb GROUP BY generation")


def _climbed(generations: int, neighbours: int, step: float) -> str:
    out = f"WITH {_MOMENTS}, best0 AS MATERIALIZED (SELECT list_transform(range(64), lambda j: 0.0::DOUBLE) AS w, yy AS sse FROM mo)"
    for g in range(1, generations + 1):
        u = _u(f"'climb:0:{g}:' || n || ':' || j")
        out += (f", try{g} AS MATERIALIZED (SELECT n, list_transform(range(64), lambda j: w[j + 1] + ({u} - 0.5) * {D(step)}) AS w FROM best{g - 1}, range({neighbours}) t(n)), "
                f"best{g} AS MATERIALIZED (SELECT w, sse FROM (SELECT n, w, {_sse('w')} AS sse FROM try{g}, mo UNION ALL SELECT -1, w, sse FROM best{g - 1}) "
                "ORDER BY sse, n LIMIT 1)")
    return out + _best_rows(generations)


def _annealed(generations: int, chains: int, temp: float, cooling: float, step: float) -> str:
    out = f"WITH {_MOMENTS}, c0 AS MATERIALIZED (SELECT c, list_transform(range(64), lambda j: 0.0::DOUBLE) AS w, yy AS sse FROM mo, range({chains}) t(c))"
    heat, t = [], temp
    for g in range(1, generations + 1):
        u = _u(f"'anneal:0:{g}:' || c || ':' || j")
        a = _u(f"'accept:0:{g}:' || c")
        out += (f", try{g} AS MATERIALIZED (SELECT c, w, sse, list_transform(range(64), lambda j: w[j + 1] + ({u} - 0.5) * {D(step)}) AS w2 FROM c{g - 1}), "
                f"s{g} AS MATERIALIZED (SELECT *, {_sse('w2')} AS sse2 FROM try{g}, mo), "
                f"t{g} AS MATERIALIZED (SELECT c, w, w2, sse, sse2, sse2 < sse OR {a} < exp(least(0.0, (sse - sse2) / {D(t)})) AS take FROM s{g}), "
                f"c{g} AS MATERIALIZED (SELECT c, CASE WHEN take THEN w2 ELSE w END AS w, CASE WHEN take THEN sse2 ELSE sse END AS sse FROM t{g}), "
                f"best{g} AS MATERIALIZED (SELECT w, sse FROM c{g} ORDER BY sse, c LIMIT 1)")
        t *= cooling
        heat.append(D(t))
    return out + _best_rows(generations, f", [{', '.join(heat)}][generation] AS temperature")


def _evolved(generations: int, population: int, mate: int, mutate: int, step: float) -> str:
    half = max(2, population // 2)
    first = _u("'first:0:' || c || ':' || j")
    out = (f"WITH {_MOMENTS}, p0 AS MATERIALIZED (SELECT c, w, {_sse('w')} AS sse FROM (SELECT c, list_transform(range(64), lambda j: ({first} - 0.5) * {D(step)}) AS w "
           f"FROM range({population}) t(c)), mo), r0 AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY sse, c) - 1 AS k FROM p0)")
    for g in range(1, generations + 1):
        who = {x: f"floor({_u(f"'{x}:0:{g}:' || n")} * {half})" for x in ("mother", "father")}
        kid = (f"SELECT n, list_transform(range(64), lambda j: CASE WHEN {_u(f"'gene:0:{g}:' || n || ':' || j")} < 0.5 THEN a.w[j + 1] ELSE b.w[j + 1] END) AS w "
               f"FROM range({mate}) t(n) JOIN r{g - 1} a ON a.k = {who['mother']} JOIN r{g - 1} b ON b.k = {who['father']}")
        for u in range(mutate):
            child, place = (f"floor({_u(f"'{x}:0:{g}:{u}'")} * {size})" for x, size in (("child", mate), ("place", 64)))
            kid = (f"SELECT n, CASE WHEN n = {child} THEN list_transform(range(64), lambda j: w[j + 1] + CASE WHEN j = {place} "
                   f"THEN ({_u(f"'mutate:0:{g}:{u}'")} - 0.5) * {D(step)} ELSE 0 END) ELSE w END AS w FROM ({kid})")
        out += (f", kid{g} AS MATERIALIZED ({kid}), p{g} AS MATERIALIZED (SELECT k AS c, w, sse FROM r{g - 1} WHERE k < {population - mate} UNION ALL "
                f"SELECT n + {population - mate} AS c, w, {_sse('w')} AS sse FROM kid{g}, mo), "
                f"r{g} AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY sse, c) - 1 AS k FROM p{g}), best{g} AS MATERIALIZED (SELECT w, sse FROM r{g} WHERE k = 0)")
    return out + _best_rows(generations)


SQL["search_hill_climb"] = _climbed(10, 16, 0.1)
SQL["search_anneal"] = _annealed(10, 16, 1e3, 0.4, 0.1)
SQL["search_genetic"] = _evolved(10, 24, 8, 2, 0.1)

SQL["udf_reducer"] = ("SELECT user_id, round(sum(value), 6) AS total, round(max(value), 6) AS best, round(max(value) - min(value), 6) AS spread "
                      "FROM events GROUP BY user_id")
