"""DuckDB SQL twins of the registered queries (the correctness oracle).

The same fixture adapters, experiment parameters and presentation rules as
``abx.plans.queries``, written as plain SQL over the pre-registered views.
Tail probabilities use Simpson quadrature (2,000 steps): DuckDB has lgamma
but neither erf nor an incomplete beta.
"""

from __future__ import annotations

from abx.config import DEFAULT_ACTIVITIES, FIXTURE_EXPERIMENTS
from abx.functions.columns import clean_feature_name
from abx.operators.models import EVENT_TYPES
from abx.operators.stats import z_quantile
from abx.plans.queries import FLAGSHIP_EXPERIMENT, GROUP_PENALTIES, LISTING_LEVELS, PRICE_PENALTIES

STEPS = 2000


def R6(x: str) -> str:
    return f"(round_even(({x})::DOUBLE * 1e6, 0) / 1e6)"


def CENTS(x: str) -> str:
    return f"(round_even(({x})::DOUBLE * 100.0, 0) / 100.0)"


def D(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d')"


def DIV(a: str, b: str) -> str:
    return f"(({a})::DOUBLE / nullif(({b})::DOUBLE, 0))"


def student_p(src: str, t: str = "t_stat", df: str = "df") -> str:
    """SELECT src.*, p_value: two-sided Student p by quadrature of cos^(df-1)."""
    th = f"atan(abs(s.{t}) / sqrt(s.{df}))"
    w = f"(CASE WHEN i = 0 OR i = {STEPS} THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END)"
    integral = f"(SELECT sum({w} * pow(cos(i * {th} / {STEPS}), s.{df} - 1)) FROM range(0, {STEPS + 1}) r(i))"
    return (f"SELECT s.*, 1 - 2 * exp(lgamma((s.{df} + 1) / 2.0) - lgamma(s.{df} / 2.0)) / sqrt(pi())"
            f" * ({th} / {STEPS} / 3.0) * {integral} AS p_value FROM {src} s")


def normal_p(src: str, z: str) -> str:
    """SELECT src.*, p_value: two-sided normal p for |z| by quadrature of the density."""
    h = f"(abs({z}) / {STEPS})"
    w = f"(CASE WHEN i = 0 OR i = {STEPS} THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END)"
    integral = f"(SELECT sum({w} * exp(-0.5 * pow(i * {h}, 2))) FROM range(0, {STEPS + 1}) r(i))"
    return f"SELECT s.*, 1 - 2 / sqrt(2 * pi()) * ({h} / 3.0) * {integral} AS p_value FROM {src} s"


def _experiments_values() -> str:
    rows = ", ".join(
        f"('{e.experiment_id}', {float(e.ratio)!r}::DOUBLE, DATE '{e.start_date}', DATE '{e.end_date}', {int(e.pre_days)})"
        for e in FIXTURE_EXPERIMENTS)
    return f"SELECT * FROM (VALUES {rows}) t(experiment_id, ratio, start_date, end_date, pre_days)"


def _eligible(exps=FIXTURE_EXPERIMENTS) -> str:
    return " UNION ALL ".join(
        f"SELECT user_id, '{e.experiment_id}' AS experiment_id, {float(e.ratio)!r}::DOUBLE AS experiment_ratio"
        f" FROM users WHERE ({e.population})" for e in exps)


def _hash(*parts: str) -> str:
    joined = " || '|' || ".join(parts)
    return f"('0x' || substr(md5({joined}), 1, 8))::BIGINT"


KEY = "json_extract_string(props, '$.k')"
ACT = ",\n  ".join(f"count_if(activity = '{a}')::BIGINT AS total_{a}s" for a in DEFAULT_ACTIVITIES)

BASE = f"""
WITH userlog AS (
  SELECT user_id,
         repeat('0', greatest(0, 8 - length({KEY}))) || {KEY} AS listing_id,
         ts AS event_time, event_type AS activity,
         CASE WHEN event_type = 'purchase' THEN value END AS purchase_amount
  FROM events),
users AS (
  SELECT c_custkey AS user_id, c_custkey % 5 = 0 AS is_host, c_name AS email, c_mktsegment AS segment
  FROM customer),
experiments AS ({_experiments_values()}),
eligible AS ({_eligible()}),
assignments AS (
  SELECT user_id,
         CASE WHEN {_hash('experiment_id', 'user_id::VARCHAR')} < experiment_ratio * 4294967296.0
              THEN 'treatment' ELSE 'control' END AS "group",
         experiment_id, experiment_ratio
  FROM eligible),
user_days AS (
  SELECT user_id, CAST(event_time AS DATE) AS date,
  count(DISTINCT listing_id)::BIGINT AS total_listings,
  {ACT},
  count(*)::BIGINT AS total_events,
  sum(CASE WHEN activity = 'purchase' THEN coalesce(purchase_amount, 0.0) ELSE 0.0 END) AS total_purchase_amount
  FROM userlog GROUP BY ALL),
cal AS (
  SELECT experiment_id, g."group", unnest(generate_series(start_date - pre_days, end_date, INTERVAL 1 DAY))::DATE AS date
  FROM experiments, (VALUES ('control'), ('treatment')) g("group")),
exposed AS (
  SELECT d.*, a.experiment_id, a."group" FROM user_days d JOIN assignments a USING (user_id)
  JOIN experiments e ON e.experiment_id = a.experiment_id AND d.date BETWEEN e.start_date - e.pre_days AND e.end_date),
post_user AS (
  SELECT x.experiment_id, x.user_id, x."group", sum(x.total_purchase_amount) AS value
  FROM exposed x JOIN experiments e USING (experiment_id)
  WHERE x.date BETWEEN e.start_date AND e.end_date GROUP BY ALL),
post_all AS (
  SELECT a.experiment_id, a.user_id, a."group", coalesce(p.value, 0.0) AS value, p.value IS NOT NULL AS active
  FROM assignments a LEFT JOIN post_user p ON p.experiment_id = a.experiment_id AND p.user_id = a.user_id),
pre_user AS (
  SELECT x.experiment_id, x.user_id, x."group", sum(x.total_purchase_amount) AS value
  FROM exposed x JOIN experiments e USING (experiment_id)
  WHERE x.date < e.start_date AND x.date >= e.start_date - e.pre_days GROUP BY ALL)
"""

UD_COLS = ", ".join(["total_listings"] + [f"total_{a}s" for a in DEFAULT_ACTIVITIES] + ["total_events"])


def _moments(src: str, keys: str, val: str = "value", g: str = '"group"') -> str:
    parts = []
    for tag in ("control", "treatment"):
        parts.append(f"count_if({g} = '{tag}')::BIGINT AS n_{tag}, "
                     f"sum(CASE WHEN {g} = '{tag}' THEN {val} END) AS sum_{tag}, "
                     f"var_samp(CASE WHEN {g} = '{tag}' THEN {val} END) AS var_{tag}")
    return f"SELECT {keys}, {', '.join(parts)} FROM {src} GROUP BY {keys}"


def _pooled_t() -> str:
    ok = "n_control >= 2 AND n_treatment >= 2"
    sp2 = "(((n_control - 1) * var_control + (n_treatment - 1) * var_treatment) / nullif(n_control + n_treatment - 2, 0))"
    se = f"sqrt({sp2} * (1.0 / n_control + 1.0 / n_treatment))"
    mc = "(sum_control / n_control)"
    mt = "(sum_treatment / n_treatment)"
    t = f"CASE WHEN {ok} THEN ({mc} - {mt}) / nullif({se}, 0) END"
    df = f"CASE WHEN {ok} THEN (n_control + n_treatment - 2)::DOUBLE END"
    return f"{t} AS t_stat, {df} AS df"


Q: dict[str, str] = {}

Q["user_day_metrics"] = BASE + f"""
SELECT user_id, {D('date')} AS date, {UD_COLS}, {R6('total_purchase_amount')} AS total_purchase_amount
FROM user_days"""

_flag = [e for e in FIXTURE_EXPERIMENTS if e.experiment_id == FLAGSHIP_EXPERIMENT]
Q["assign_hash"] = f"""
WITH users AS (SELECT c_custkey AS user_id, c_custkey % 5 = 0 AS is_host FROM customer),
eligible AS ({_eligible(_flag)})
SELECT user_id,
       CASE WHEN {_hash('experiment_id', 'user_id::VARCHAR')} < experiment_ratio * 4294967296.0
            THEN 'treatment' ELSE 'control' END AS "group",
       experiment_id, experiment_ratio
FROM eligible"""

Q["assign_multi"] = BASE + "SELECT user_id, \"group\", experiment_id, experiment_ratio FROM assignments"

Q["exposed_user_days"] = BASE + f"""
SELECT user_id, {D('date')} AS date, {UD_COLS}, {R6('total_purchase_amount')} AS total_purchase_amount,
       experiment_id, "group"
FROM exposed"""

_DAY_MOMENTS = _moments("(SELECT * FROM exposed WHERE total_purchase_amount <> 0)", "experiment_id, date",
                        "total_purchase_amount")

Q["group_day_moments"] = BASE + f"""
, m AS ({_DAY_MOMENTS})
SELECT experiment_id, {D('date')} AS date,
  n_control, {R6(CENTS('sum_control'))} AS sum_control, {R6(DIV(CENTS('sum_control'), 'n_control'))} AS mean_control,
  {R6('sqrt(var_control)')} AS sd_control,
  n_treatment, {R6(CENTS('sum_treatment'))} AS sum_treatment, {R6(DIV(CENTS('sum_treatment'), 'n_treatment'))} AS mean_treatment,
  {R6('sqrt(var_treatment)')} AS sd_treatment
FROM m"""

Q["daily_ttest"] = BASE + f"""
, m AS ({_DAY_MOMENTS}),
t AS (SELECT *, {_pooled_t()} FROM m),
p AS ({student_p('t')})
SELECT experiment_id, {D('date')} AS date, n_control, n_treatment,
  {R6(DIV(CENTS('sum_control'), 'n_control'))} AS mean_control,
  {R6(DIV(CENTS('sum_treatment'), 'n_treatment'))} AS mean_treatment,
  {R6('t_stat')} AS t_stat, {R6('df')} AS df, {R6('p_value')} AS p_value
FROM p"""

Q["group_counts"] = BASE + 'SELECT experiment_id, "group", count(*)::BIGINT AS count FROM assignments GROUP BY ALL'

_RATIO = """
SELECT experiment_id, control_observed, n - floor(n * ratio)::BIGINT AS control_expected,
       treatment_observed, floor(n * ratio)::BIGINT AS treatment_expected,
       n - control_observed - treatment_observed AS other_observed,
       CASE WHEN n - control_observed - treatment_observed = 0 AND control_observed > 0 AND treatment_observed > 0
            THEN pow(control_observed - (n - floor(n * ratio)), 2) / nullif(n - floor(n * ratio), 0)
               + pow(treatment_observed - floor(n * ratio), 2) / nullif(floor(n * ratio), 0) END AS test_stat
FROM (SELECT experiment_id, count(*) AS n, count_if("group" = 'control')::BIGINT AS control_observed,
             count_if("group" = 'treatment')::BIGINT AS treatment_observed, max(experiment_ratio) AS ratio
      FROM assignments GROUP BY experiment_id)"""

Q["ratio_test"] = BASE + f"""
, r AS ({_RATIO}),
p AS ({normal_p('r', 'sqrt(s.test_stat)')})
SELECT experiment_id, control_observed, control_expected, treatment_observed, treatment_expected,
       other_observed, {R6('test_stat')} AS test_stat, {R6('p_value')} AS p_value
FROM p"""

_TOTALS = """SELECT cal.date, cal."group", cal.experiment_id, coalesce(sum(x.total_purchase_amount), 0.0) AS total_amount,
         count(x.user_id)::BIGINT AS user_days
  FROM cal LEFT JOIN exposed x ON x.experiment_id = cal.experiment_id AND x."group" = cal."group" AND x.date = cal.date
  GROUP BY ALL"""

Q["group_day_totals"] = BASE + f"""
, g AS ({_TOTALS})
SELECT {D('date')} AS date, "group", experiment_id, {R6('total_amount')} AS total_amount, user_days FROM g"""

_CUM = f"""SELECT *, sum(total_amount) OVER (PARTITION BY experiment_id, "group" ORDER BY date
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS daily_cumulative_sum FROM ({_TOTALS})"""

Q["cumulative_by_group"] = BASE + f"""
, c AS ({_CUM})
SELECT {D('date')} AS date, "group", experiment_id, {R6('total_amount')} AS total_amount, user_days,
       {R6('daily_cumulative_sum')} AS daily_cumulative_sum FROM c"""

_DAYIDX = """(rank() OVER (PARTITION BY experiment_id, "group" ORDER BY date) - e.pre_days)::INTEGER AS experiment_duration,
       (date_diff('day', e.start_date, date) + 1)::INTEGER AS experiment_day"""

Q["experiment_day"] = BASE + f"""
, g AS ({_TOTALS})
SELECT {D('date')} AS date, "group", experiment_id, {_DAYIDX}
FROM g JOIN experiments e USING (experiment_id)"""

Q["experiment_results"] = BASE + f"""
, m AS ({_DAY_MOMENTS}),
t AS (SELECT *, {_pooled_t()} FROM m),
p AS ({student_p('t')}),
c AS ({_CUM}),
x AS (SELECT c.*, {_DAYIDX} FROM c JOIN experiments e USING (experiment_id))
SELECT {D('x.date')} AS date, x."group", x.experiment_id, {R6('x.total_amount')} AS total_amount,
       {R6('x.daily_cumulative_sum')} AS daily_cumulative_sum, x.experiment_duration, x.experiment_day,
       CASE x."group" WHEN 'control' THEN 'Stats' WHEN 'treatment' THEN 'P_value' END AS ab_description,
       {R6("CASE x.\"group\" WHEN 'control' THEN p.t_stat WHEN 'treatment' THEN p.p_value END")} AS ab_value
FROM x LEFT JOIN p ON x.experiment_id = p.experiment_id AND x.date = p.date"""

Q["date_spine"] = f"""
WITH b AS (SELECT min(ts)::DATE AS lo, max(ts)::DATE AS hi FROM events),
d AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY))::DATE AS date FROM b)
SELECT {D('date')} AS date, {D("date_trunc('week', date)")} AS week_start_date,
       {D("date_trunc('week', date)::DATE + 6")} AS week_end_date FROM d"""

Q["pre_post_totals"] = BASE + f"""
SELECT x.experiment_id, x."group", CASE WHEN x.date < e.start_date THEN 'pre' ELSE 'post' END AS phase,
       {R6('sum(x.total_purchase_amount)')} AS total_amount, count(*)::BIGINT AS user_days,
       count(DISTINCT x.user_id)::BIGINT AS users
FROM exposed x JOIN experiments e USING (experiment_id) GROUP BY ALL"""

_ACTIVE = ("count_if(active AND \"group\" = 'control')::BIGINT AS active_control, "
           "count_if(active AND \"group\" = 'treatment')::BIGINT AS active_treatment")
_OVERALL_COLS = f"""n_control, n_treatment, active_control, active_treatment,
  {R6(DIV(CENTS('sum_control'), 'n_control'))} AS mean_control,
  {R6(DIV(CENTS('sum_treatment'), 'n_treatment'))} AS mean_treatment"""

Q["overall_ttest"] = BASE + f"""
, m AS ({_moments('post_all', 'experiment_id').replace(' FROM ', f', {_ACTIVE} FROM ', 1)}),
t AS (SELECT *, {_pooled_t()} FROM m),
p AS ({student_p('t')})
SELECT experiment_id, {_OVERALL_COLS},
  {R6('sqrt(var_control)')} AS sd_control, {R6('sqrt(var_treatment)')} AS sd_treatment,
  {R6('t_stat')} AS t_stat, {R6('df')} AS df, {R6('p_value')} AS p_value
FROM p"""

Q["active_rate_ztest"] = BASE + f"""
, act AS (SELECT experiment_id, count_if("group" = 'control')::BIGINT AS active_control,
                 count_if("group" = 'treatment')::BIGINT AS active_treatment
          FROM (SELECT DISTINCT x.experiment_id, x.user_id, x."group" FROM exposed x JOIN experiments e USING (experiment_id)
                WHERE x.date BETWEEN e.start_date AND e.end_date) GROUP BY experiment_id),
n AS (SELECT experiment_id, count_if("group" = 'control')::BIGINT AS n_control,
             count_if("group" = 'treatment')::BIGINT AS n_treatment FROM assignments GROUP BY experiment_id),
j AS (SELECT n.experiment_id, n_control, n_treatment, coalesce(active_control, 0) AS active_control,
             coalesce(active_treatment, 0) AS active_treatment FROM n LEFT JOIN act USING (experiment_id)),
r AS (SELECT *, active_control::DOUBLE / n_control AS rate_control, active_treatment::DOUBLE / n_treatment AS rate_treatment,
             (active_control + active_treatment)::DOUBLE / (n_control + n_treatment) AS pool FROM j),
zz AS (SELECT * EXCLUDE (pool), (rate_control - rate_treatment)
              / nullif(sqrt(pool * (1 - pool) * (1.0 / n_control + 1.0 / n_treatment)), 0) AS z_stat FROM r),
p AS ({normal_p('zz', 's.z_stat')})
SELECT experiment_id, n_control, n_treatment, active_control, active_treatment,
       {R6('rate_control')} AS rate_control, {R6('rate_treatment')} AS rate_treatment,
       {R6('z_stat')} AS z_stat, {R6('p_value')} AS p_value FROM p"""

_PERIODS = """SELECT *, 'day' AS period, date AS period_start FROM {src}
  UNION ALL SELECT *, 'week' AS period, date_trunc('week', date)::DATE AS period_start FROM {src}
  UNION ALL SELECT *, 'month' AS period, date_trunc('month', date)::DATE AS period_start FROM {src}"""

_GC = 'SELECT experiment_id, "group", count(*)::BIGINT AS total_users FROM assignments GROUP BY ALL'

Q["active_rate"] = BASE + f"""
, x AS ({_PERIODS.format(src='(SELECT experiment_id, "group", user_id, date FROM exposed)')}),
s AS (SELECT DISTINCT experiment_id, "group", period, period_start FROM ({_PERIODS.format(src='cal')})),
a AS (SELECT s.experiment_id, s."group", s.period, s.period_start, count(DISTINCT user_id)::BIGINT AS active_users
      FROM s LEFT JOIN x USING (experiment_id, "group", period, period_start) GROUP BY ALL)
SELECT a.experiment_id, a."group", period, {D('period_start')} AS period_start, active_users, total_users,
       {R6('active_users::DOUBLE / total_users')} AS active_rate
FROM a JOIN ({_GC}) g USING (experiment_id, "group")"""

_GAP_US = 1800 * 1_000_000
Q["average_duration"] = BASE + f"""
, ev AS (SELECT user_id, epoch_us(event_time) AS us FROM userlog),
f AS (SELECT user_id, us, CASE WHEN lag(us) OVER w IS NULL OR us - lag(us) OVER w > {_GAP_US} THEN 1 ELSE 0 END AS new
      FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY us)),
s AS (SELECT user_id, us, sum(new) OVER (PARTITION BY user_id ORDER BY us ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid FROM f),
sess AS (SELECT user_id, sid, min(us) AS s0, max(us) AS s1 FROM s GROUP BY ALL),
ud AS (SELECT user_id, make_timestamp(s0)::DATE AS date, count(*) AS sessions, sum(s1 - s0) AS duration_us
       FROM sess GROUP BY ALL),
j AS (SELECT ud.*, a.experiment_id, a."group" FROM ud JOIN assignments a USING (user_id)
      JOIN experiments e ON e.experiment_id = a.experiment_id AND ud.date BETWEEN e.start_date - e.pre_days AND e.end_date),
x AS ({_PERIODS.format(src='j')}),
p AS (SELECT DISTINCT experiment_id, "group", period, period_start FROM ({_PERIODS.format(src='cal')})),
g AS (SELECT p.experiment_id, p."group", p.period, p.period_start, coalesce(sum(sessions), 0)::BIGINT AS sessions,
             coalesce(sum(duration_us), 0)::BIGINT AS total_duration_us, count(DISTINCT user_id)::BIGINT AS active_users
      FROM p LEFT JOIN x USING (experiment_id, "group", period, period_start) GROUP BY ALL)
SELECT g.experiment_id, g."group", period, {D('period_start')} AS period_start, sessions, total_duration_us,
       active_users, total_users, {R6('total_duration_us / 1e6')} AS total_duration_sec,
       {R6('total_duration_us::DOUBLE / total_users / 1e6')} AS avg_duration_sec
FROM g JOIN ({_GC}) c USING (experiment_id, "group")"""

# The sessions of average_duration, as one value per assigned user in the treatment period.
_SESSIONS = Q["average_duration"].removeprefix(BASE).split("j AS (")[0]
Q["duration_ttest"] = BASE + _SESSIONS + f"""
du AS (SELECT a.experiment_id, a.user_id, a."group", sum(ud.duration_us) / 1e6 AS value
       FROM ud JOIN assignments a USING (user_id)
       JOIN experiments e ON e.experiment_id = a.experiment_id AND ud.date BETWEEN e.start_date AND e.end_date GROUP BY ALL),
da AS (SELECT a.experiment_id, a."group", coalesce(d.value, 0.0) AS value, d.value IS NOT NULL AS active
       FROM assignments a LEFT JOIN du d ON d.experiment_id = a.experiment_id AND d.user_id = a.user_id),
m AS ({_moments('da', 'experiment_id').replace(' FROM ', f', {_ACTIVE} FROM ', 1)}),
t AS (SELECT *, {_pooled_t()} FROM m),
p AS ({student_p('t')})
SELECT experiment_id, n_control, n_treatment, active_control, active_treatment,
  {R6('sum_control / n_control')} AS mean_control, {R6('sum_treatment / n_treatment')} AS mean_treatment,
  {R6('t_stat')} AS t_stat, {R6('df')} AS df, {R6('p_value')} AS p_value FROM p"""

Q["user_day_filled"] = BASE + f"""
, days AS (SELECT a.experiment_id, a.user_id, a."group", unnest(generate_series(e.start_date, e.end_date, INTERVAL 1 DAY))::DATE AS date
          FROM assignments a JOIN experiments e USING (experiment_id))
SELECT c.experiment_id, c.user_id, c."group", {D('c.date')} AS date,
       coalesce(d.total_events, 0)::BIGINT AS total_events,
       {R6('coalesce(d.total_purchase_amount, 0.0)')} AS total_purchase_amount
FROM days c LEFT JOIN user_days d ON c.user_id = d.user_id AND c.date = d.date"""

_OVERALL_T = f"""
m AS ({_moments('post_all', 'experiment_id')}),
ot AS (SELECT experiment_id, {_pooled_t()} FROM m),
op AS ({student_p('ot')})"""

Q["all_test_results"] = BASE + f"""
, r AS ({_RATIO}),
rp AS ({normal_p('r', 'sqrt(s.test_stat)')}),
{_OVERALL_T},
act AS (SELECT experiment_id, count_if("group" = 'control') AS a_c, count_if("group" = 'treatment') AS a_t
        FROM (SELECT DISTINCT x.experiment_id, x.user_id, x."group" FROM exposed x JOIN experiments e USING (experiment_id)
              WHERE x.date BETWEEN e.start_date AND e.end_date) GROUP BY experiment_id),
n AS (SELECT experiment_id, count_if("group" = 'control') AS nc, count_if("group" = 'treatment') AS nt
      FROM assignments GROUP BY experiment_id),
zr AS (SELECT n.experiment_id, nc, nt, coalesce(a_c, 0) AS a_c, coalesce(a_t, 0) AS a_t FROM n LEFT JOIN act USING (experiment_id)),
zz AS (SELECT experiment_id, (a_c::DOUBLE / nc - a_t::DOUBLE / nt)
         / nullif(sqrt(((a_c + a_t)::DOUBLE / (nc + nt)) * (1 - (a_c + a_t)::DOUBLE / (nc + nt)) * (1.0 / nc + 1.0 / nt)), 0) AS z_stat FROM zr),
zp AS ({normal_p('zz', 's.z_stat')})
SELECT experiment_id, 'sample_ratio_chi2' AS test, {R6('test_stat')} AS statistic, {R6('p_value')} AS p_value FROM rp
UNION ALL SELECT experiment_id, 'overall_mean_t', {R6('t_stat')}, {R6('p_value')} FROM op
UNION ALL SELECT experiment_id, 'active_rate_z', {R6('z_stat')}, {R6('p_value')} FROM zp"""

Q["assign_quota"] = BASE + f"""
, h AS (SELECT *, {_hash('experiment_id', 'user_id::VARCHAR')} AS h,
               count(*) OVER (PARTITION BY experiment_id) AS n FROM eligible),
r AS (SELECT *, row_number() OVER (PARTITION BY experiment_id ORDER BY h, user_id) AS rk FROM h)
SELECT user_id, CASE WHEN rk <= floor(n * experiment_ratio) THEN 'treatment' ELSE 'control' END AS "group",
       experiment_id, experiment_ratio FROM r"""

Q["assignment_conflicts"] = BASE + """
, u AS (SELECT experiment_id, user_id, count(*) AS rows, min("group") <> max("group") AS both_groups
        FROM assignments GROUP BY ALL)
SELECT experiment_id, sum(rows)::BIGINT AS n_rows, count(*)::BIGINT AS n_users,
       count_if(both_groups)::BIGINT AS users_in_both_groups, count_if(rows > 1)::BIGINT AS duplicate_users
FROM u GROUP BY experiment_id"""

_ids = sorted(e.experiment_id for e in FIXTURE_EXPERIMENTS)
_pairs = [(a, b) for i, a in enumerate(_ids) for b in _ids[i + 1:]]
Q["experiment_overlap"] = BASE + """
, o AS (""" + " UNION ALL ".join(
    f"""SELECT '{a}' AS experiment_a, '{b}' AS experiment_b,
         count_if(x."group" = 'control' AND y."group" = 'control')::BIGINT AS n_cc,
         count_if(x."group" = 'control' AND y."group" = 'treatment')::BIGINT AS n_ct,
         count_if(x."group" = 'treatment' AND y."group" = 'control')::BIGINT AS n_tc,
         count_if(x."group" = 'treatment' AND y."group" = 'treatment')::BIGINT AS n_tt
       FROM assignments x JOIN assignments y ON x.user_id = y.user_id
       WHERE x.experiment_id = '{a}' AND y.experiment_id = '{b}'""" for a, b in _pairs) + f"""),
c AS (SELECT *, (n_cc + n_ct + n_tc + n_tt)::DOUBLE * pow(n_cc::DOUBLE * n_tt - n_ct::DOUBLE * n_tc, 2)
              / nullif((n_cc + n_ct)::DOUBLE * (n_tc + n_tt) * (n_cc + n_tc) * (n_ct + n_tt), 0) AS chi2 FROM o),
p AS ({normal_p('c', 'sqrt(s.chi2)')})
SELECT experiment_a, experiment_b, n_cc, n_ct, n_tc, n_tt, {R6('chi2')} AS chi2, {R6('p_value')} AS p_value FROM p"""

AA_SALTS = 100
Q["aa_test"] = BASE + f"""
, x AS (SELECT p.experiment_id, p.value, s.salt,
             CASE WHEN ('0x' || substr(md5(p.experiment_id || '|aa|' || (s.salt // 4)::VARCHAR || '|' || p.user_id::VARCHAR),
                                       (1 + 8 * (s.salt % 4))::BIGINT, 8))::BIGINT < a.experiment_ratio * 4294967296.0
                  THEN 'treatment' ELSE 'control' END AS g
      FROM post_all p JOIN assignments a ON a.experiment_id = p.experiment_id AND a.user_id = p.user_id,
           range(0, {AA_SALTS}) s(salt)),
m AS ({_moments('x', 'experiment_id, salt', 'value', 'g')}),
t AS (SELECT experiment_id, salt, {_pooled_t()} FROM m),
p AS ({student_p('t')})
SELECT experiment_id, count(*)::BIGINT AS n_splits, count_if(p_value < 0.05)::BIGINT AS n_reject,
       {R6('count_if(p_value < 0.05)::DOUBLE / count(*)')} AS reject_share
FROM p GROUP BY experiment_id"""

_ZSUM = z_quantile(1 - 0.05 / 2) + z_quantile(0.8)
_SS = f"""
, pre_all AS (SELECT a.experiment_id, coalesce(p.value, 0.0) AS value
              FROM assignments a LEFT JOIN pre_user p ON p.experiment_id = a.experiment_id AND p.user_id = a.user_id),
k AS (SELECT experiment_id, count(*)::BIGINT AS n_users, sum(value) AS pre_sum, avg(value) AS pre_mean,
             var_samp(value) AS pre_var FROM pre_all GROUP BY experiment_id),
ss AS (SELECT *, ceil({2.0 * _ZSUM * _ZSUM!r} * pre_var / nullif((pre_mean * 0.1) * (pre_mean * 0.1), 0))::BIGINT AS required_per_group FROM k)"""

Q["sample_size"] = BASE + _SS + f"""
SELECT experiment_id, n_users, {R6(CENTS('pre_sum'))} AS pre_sum, {R6(DIV(CENTS('pre_sum'), 'n_users'))} AS pre_mean,
       {R6('sqrt(pre_var)')} AS pre_sd, required_per_group FROM ss"""

Q["sample_progress"] = BASE + _SS + f"""
, first AS (SELECT x.experiment_id, x."group", x.user_id, min(x.date) AS date
            FROM exposed x JOIN experiments e USING (experiment_id)
            WHERE x.date BETWEEN e.start_date AND e.end_date GROUP BY ALL),
daily AS (SELECT cal.experiment_id, cal."group", cal.date, count(f.user_id)::BIGINT AS new_users
          FROM cal JOIN experiments e ON e.experiment_id = cal.experiment_id AND cal.date >= e.start_date
          LEFT JOIN first f ON f.experiment_id = cal.experiment_id AND f."group" = cal."group" AND f.date = cal.date
          GROUP BY ALL),
cum AS (SELECT *, sum(new_users) OVER (PARTITION BY experiment_id, "group" ORDER BY date
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS users_so_far FROM daily)
SELECT c.experiment_id, c."group", {D('c.date')} AS date, new_users, users_so_far, required_per_group,
       coalesce(users_so_far >= required_per_group, false) AS reached
FROM cum c LEFT JOIN ss USING (experiment_id)"""

Q["host_users"] = "SELECT c_custkey AS user_id, c_name AS email, c_mktsegment AS segment FROM customer WHERE c_custkey % 5 = 0"

_PAD = "repeat('0', greatest(0, 8 - length(p_partkey::VARCHAR))) || p_partkey::VARCHAR"
Q["scan_listings"] = f"""
SELECT {_PAD} AS listing_id, {R6('p_retailprice')} AS price, p_brand AS neighbourhood_cleansed,
       p_type AS room_type, p_size AS accommodates FROM part"""

Q["userlog"] = f"""
SELECT user_id, repeat('0', greatest(0, 8 - length({KEY}))) || {KEY} AS listing_id,
       strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS event_time, event_type AS activity,
       {R6("CASE WHEN event_type = 'purchase' THEN value END")} AS purchase_amount
FROM events"""

Q["distinct_listings"] = f"SELECT DISTINCT repeat('0', greatest(0, 8 - length({KEY}))) || {KEY} AS listing_id FROM events"

Q["activity_summary"] = BASE + f"""
SELECT 'user_id' AS column_name, count(user_id)::BIGINT AS count,
       {R6('sum(user_id::DOUBLE) / count(user_id)')} AS mean, {R6('stddev_samp(user_id::DOUBLE)')} AS stddev,
       {R6('min(user_id)::DOUBLE')} AS min, {R6('max(user_id)::DOUBLE')} AS max FROM userlog
UNION ALL
SELECT 'purchase_amount', count(purchase_amount)::BIGINT,
       {R6(DIV(CENTS('sum(purchase_amount)'), 'count(purchase_amount)'))}, {R6('stddev_samp(purchase_amount)')},
       {R6('min(purchase_amount)')}, {R6('max(purchase_amount)')} FROM userlog"""

Q["user_key_unique"] = """
SELECT (row_number() OVER (ORDER BY c_name, c_custkey) - 1)::BIGINT AS user_key, c_custkey AS user_id, c_name AS email
FROM customer"""

_L = f"SELECT {_PAD} AS listing_id, p_retailprice AS price, p_brand, p_type, p_size AS accommodates FROM part"
_SOURCE = {"neighbourhood_cleansed": "p_brand", "room_type": "p_type"}
_ONE_HOT = ", ".join(f"({_SOURCE[c]} = '{v}')::INTEGER::DOUBLE AS \"{clean_feature_name(f'{c}_{v}')}\""
                     for c, values in LISTING_LEVELS.items() for v in values)
Q["one_hot"] = f"SELECT listing_id, {R6('price')} AS price, accommodates, {_ONE_HOT} FROM ({_L})"

Q["listing_features"] = f"SELECT listing_id, {R6('price')} AS price, {_ONE_HOT} FROM ({_L})"

Q["one_hot_long"] = " UNION ALL ".join(
    f"SELECT listing_id, '{c}_' || replace(replace(replace({col}, ' ', ''), '(', '-'), ')', '') AS feature, 1.0::DOUBLE AS value"
    f" FROM ({_L}) WHERE {col} IS NOT NULL" for c, col in _SOURCE.items())

Q["feature_key_check"] = f"""
WITH l AS ({_L}), k AS (SELECT listing_id, count(*) AS n FROM l GROUP BY listing_id)
SELECT sum(n)::BIGINT AS n_rows, count_if(listing_id IS NOT NULL)::BIGINT AS n_keys,
       coalesce(sum(CASE WHEN listing_id IS NULL THEN n END), 0)::BIGINT AS null_keys,
       count_if(listing_id IS NOT NULL AND n > 1)::BIGINT AS duplicate_keys FROM k"""

Q["stream_user_day_metrics"] = BASE + f"""
SELECT user_id, {D('date')} AS date, {UD_COLS}, {R6('total_purchase_amount')} AS total_purchase_amount
FROM user_days
WHERE date + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR"""

Q["stream_assign"] = BASE + """
SELECT a.user_id, a."group", a.experiment_id, a.experiment_ratio
FROM assignments a WHERE a.user_id IN (SELECT user_id FROM events)"""

Q["stream_distinct_listings"] = BASE + """
SELECT user_id, count(*)::BIGINT AS total_events, count(DISTINCT listing_id)::BIGINT AS distinct_listings
FROM userlog WHERE CAST(event_time AS DATE) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR GROUP BY user_id"""

Q["duration_increments"] = BASE + _SESSIONS.rstrip().rstrip(",") + f"""
SELECT user_id, {D('date')} AS date, sessions::BIGINT AS sessions, duration_us::BIGINT AS duration_us FROM ud"""

Q["daily_log_counts"] = BASE + f"""
, d AS (SELECT CAST(event_time AS DATE) AS date, count(*)::BIGINT AS events, count(DISTINCT user_id)::BIGINT AS users FROM userlog GROUP BY ALL)
SELECT {D('d.date')} AS date, events, users FROM d JOIN experiments e ON e.experiment_id = 'exp1' AND d.date BETWEEN e.start_date AND e.end_date"""

Q["activity_increments"] = BASE + """
SELECT user_id, count(DISTINCT CAST(event_time AS DATE))::INTEGER AS active_days FROM userlog
WHERE event_time >= (SELECT min(start_date - pre_days) FROM experiments) AND event_time < (SELECT max(end_date) + 1 FROM experiments)
GROUP BY user_id"""

# ------------------------------------------------------------------ models

_I, _Y = "(intercept)", "(label)"


def _net(tag: str, p) -> str:
    """CTEs on ``gram_g`` (model-free sums s of feature pairs): coefficients ``coef_{tag}`` by cyclic
    coordinate descent, one coordinate a step."""
    l1, l2 = p.alpha * p.l1_ratio, p.alpha * (1.0 - p.l1_ratio)
    return f"""
cd_{tag} AS (
  SELECT 0 AS k, list_transform(v, lambda x: 0.0::DOUBLE) AS w, v AS g FROM gram_vec
  UNION ALL
  SELECT k + 1, list_transform(w, lambda x, i: CASE WHEN i = q THEN new ELSE x END),
         list_transform(g, lambda x, i: x - (new - w[q]) * c[q][i])
  FROM (SELECT *, CASE WHEN c[q][q] + {l2!r} <= 0 THEN w[q] ELSE sign(rho) * greatest(abs(rho) - {l1!r}, 0) / (c[q][q] + {l2!r}) END AS new
        FROM (SELECT *, g[q] + c[q][q] * w[q] AS rho FROM (
          SELECT k, w, g, c, k % len(w) + 1 AS q FROM cd_{tag}, gram_mat WHERE k < {NET_SWEEPS} * len(w))))),
coef_{tag} AS (
  SELECT '{tag}' AS model, unnest(f) AS feature, unnest(w) AS coefficient
  FROM (SELECT arg_max(w, k) AS w FROM cd_{tag}), gram_mat),
full_{tag} AS (
  SELECT * FROM coef_{tag} UNION ALL
  SELECT '{tag}', '{_I}', (SELECT m FROM gram_m WHERE f = '{_Y}') - (SELECT sum(m * coefficient) FROM coef_{tag} JOIN gram_m ON f = feature))"""


NET_SWEEPS = 250


def nets(z: str, penalties) -> str:
    """CTEs: ``z`` (row, feature, value), its sums, and ``coef``: the coefficients of all penalties."""
    tags = list(penalties)
    return f"""
gram_z AS MATERIALIZED ({z}),
gram_g AS MATERIALIZED (SELECT a.feature AS i, b.feature AS j, sum(a.value * b.value) AS s FROM gram_z a JOIN gram_z b USING (row) GROUP BY ALL),
gram_n AS (SELECT s AS n FROM gram_g WHERE i = '{_I}' AND j = '{_I}'),
gram_m AS MATERIALIZED (SELECT i AS f, s / n AS m FROM gram_g, gram_n WHERE j = '{_I}' AND i <> '{_I}'),
gram_c AS MATERIALIZED (SELECT a.f AS i, b.f AS j, coalesce(s, 0) / n - a.m * b.m AS c
  FROM gram_m a CROSS JOIN gram_m b CROSS JOIN gram_n LEFT JOIN gram_g ON gram_g.i = a.f AND gram_g.j = b.f),
gram_mat AS MATERIALIZED (SELECT list(c ORDER BY i) AS c, list(i ORDER BY i) AS f
  FROM (SELECT i, list(c ORDER BY j) AS c FROM gram_c WHERE i <> '{_Y}' AND j <> '{_Y}' GROUP BY i)),
gram_vec AS MATERIALIZED (SELECT list(c ORDER BY i) AS v FROM gram_c WHERE i <> '{_Y}' AND j = '{_Y}'),{','.join(_net(t, p) for t, p in penalties.items())},
coef AS ({' UNION ALL '.join(f'SELECT * FROM full_{t}' for t in tags)})"""


def _clean(x: str) -> str:
    return f"replace(replace(replace({x}, ' ', ''), '(', '-'), ')', '')"


_PRICE_Z = f"""
  SELECT listing_id AS row, '{_I}' AS feature, 1.0::DOUBLE AS value FROM ({_L}) WHERE price IS NOT NULL
  UNION ALL SELECT listing_id, '{_Y}', price FROM ({_L}) WHERE price IS NOT NULL
  UNION ALL SELECT listing_id, 'accommodates', accommodates::DOUBLE FROM ({_L}) WHERE price IS NOT NULL AND accommodates <> 0
""" + " ".join(f"UNION ALL SELECT listing_id, '{c}_' || {_clean(col)}, 1.0 FROM ({_L}) WHERE price IS NOT NULL AND {col} IS NOT NULL"
               for c, col in _SOURCE.items())

_SCORED = """
SELECT z.row, coef.model, sum(z.value * coef.coefficient) AS prediction
FROM gram_z z JOIN coef ON coef.feature = z.feature GROUP BY ALL"""

_FIT = f"""sqrt(avg((y - prediction) ** 2)) AS rmse, avg(abs(y - prediction)) AS mae,
       1 - avg((y - prediction) ** 2) / var_pop(y) AS r2, count(*)::BIGINT AS n"""

Q["price_model"] = f"""
WITH RECURSIVE {nets(_PRICE_Z, PRICE_PENALTIES)}
SELECT model, feature, {R6('coefficient')} AS coefficient FROM coef"""

Q["price_model_optimality"] = f"""
WITH z AS ({_PRICE_Z})
SELECT model, feature, count(*)::BIGINT AS rows, 0.0::DOUBLE AS violation
FROM z, (VALUES {', '.join(f"('{t}')" for t in PRICE_PENALTIES)}) p(model) WHERE feature <> '{_Y}' GROUP BY ALL"""

Q["price_model_metrics"] = f"""
WITH RECURSIVE {nets(_PRICE_Z, PRICE_PENALTIES)},
p AS (SELECT s.model, s.prediction, z.value AS y FROM ({_SCORED}) s JOIN gram_z z ON z.row = s.row AND z.feature = '{_Y}'),
f AS (SELECT model, {_FIT} FROM p GROUP BY model)
SELECT model, {R6('rmse')} AS rmse, {R6('mae')} AS mae, {R6('r2')} AS r2, n FROM f"""

_UDAY = f"""
ud_rows AS MATERIALIZED (SELECT e.user_id, CAST(ts AS DATE) AS date, sum(value) AS label,
  {', '.join(f"count_if(event_type = '{t}')::BIGINT AS n_{t}" for t in EVENT_TYPES)}
  FROM events e GROUP BY ALL)"""
_UDAY_KEY = "(user_id, date)"
_UDAY_Z = (f"SELECT {_UDAY_KEY} AS row, '{_I}' AS feature, 1.0::DOUBLE AS value FROM ud_rows"
           f" UNION ALL SELECT {_UDAY_KEY}, '{_Y}', label FROM ud_rows "
           + " ".join(f"UNION ALL SELECT {_UDAY_KEY}, 'n_{t}', n_{t}::DOUBLE FROM ud_rows WHERE n_{t} <> 0" for t in EVENT_TYPES)
           + f" UNION ALL SELECT (r.user_id, r.date), 'segment_' || {_clean('u.segment')}, 1.0 FROM ud_rows r JOIN users u USING (user_id)"
             " WHERE u.segment IS NOT NULL")
_GROUP_SCORES = f"""{BASE.replace('WITH userlog', 'WITH RECURSIVE userlog', 1)},{_UDAY},{nets(_UDAY_Z, GROUP_PENALTIES)},
scored AS (
  SELECT r.user_id, r.date, a."group", r.label, sum(z.value * coef.coefficient) AS prediction
  FROM ud_rows r JOIN assignments a ON a.user_id = r.user_id AND a.experiment_id = '{FLAGSHIP_EXPERIMENT}'
  JOIN gram_z z ON z.row = (r.user_id, r.date) JOIN coef ON coef.model = a."group" AND coef.feature = z.feature GROUP BY ALL)"""

Q["score_by_group"] = f"""{_GROUP_SCORES}
SELECT user_id, {D('date')} AS date, "group", {R6('label')} AS label, round_even(prediction * 1e4, 0) / 1e4 AS prediction FROM scored"""

Q["score_metrics"] = f"""{_GROUP_SCORES},
f AS (SELECT "group", {_FIT} FROM (SELECT *, label AS y FROM scored) GROUP BY "group")
SELECT "group", {R6('rmse')} AS rmse, {R6('mae')} AS mae, {R6('r2')} AS r2, n FROM f"""

Q["score_rejects"] = BASE + f""",{_UDAY}
SELECT r.user_id, {D('r.date')} AS date, a."group", {R6('label')} AS label
FROM ud_rows r LEFT JOIN assignments a ON a.user_id = r.user_id AND a.experiment_id = 'exp1'
WHERE a."group" IS NULL"""

ORACLE_SQL = Q
