"""Independent SQL oracles (DuckDB dialect) for the registered queries.

Each oracle recomputes a query's answer straight from the driver's tables
with flat SQL (no JSON, no nesting): the fixture rules of FIXTURES.md §C are
restated as CTEs below and each operator's semantics is restated over them.
Amounts and grams are read as decimals wide enough to keep every digit, so
that scaled values (amount * grams / 100) and their sums are exact; averages
are double(sum)/count; DOUBLE rounding is DuckDB's own ``round(x, n)``.
"""

from __future__ import annotations

# name -> (deps, body)
CTES: dict[str, tuple[list[str], str]] = {}


def cte(name: str, body: str, deps: list[str] | None = None) -> None:
    CTES[name] = (deps or [], body)


def _did(d: str) -> str:
    return f"CAST(year({d}) * 10000 + month({d}) * 100 + day({d}) AS INTEGER)"


def r2(x: str) -> str:
    return f"round({x}, 2)"


def build(body: str, *names: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return body
    parts = [f"{n} AS (\n{CTES[n][1]}\n)" for n in order]
    return "WITH " + ",\n".join(parts) + "\n" + body


# ------------------------------------------------------------------ seeds
cte("s_meals", "SELECT * FROM (VALUES (1, 'breakfast'), (2, 'lunch'), (3, 'dinner')) t(meal_id, meal_name)")
cte("s_nutrients", """SELECT * FROM (VALUES (1, 203, 'Protein', 'g'), (2, 204, 'Fat', 'g'),
  (3, 205, 'Carbohydrate', 'g'), (4, 291, 'Fiber', 'g'), (5, 269, 'Total Sugar', 'g'))
  t(nutrient_id, usda_nutrient_id, nutrient_name, unit)""")
cte("s_bmi", """SELECT * FROM (VALUES (0.0::DOUBLE, 18.5::DOUBLE, 'Underweight'),
  (18.5, 25.0, 'Normal weight'), (25.0, 30.0, 'Overweight'), (30.0, 999.0, 'Obese')) t(min_bmi, max_bmi, category)""")
cte("s_targets", """SELECT * FROM (VALUES (1, 50.0::DOUBLE, 'min', 'low_protein'), (2, 78.0, 'max', 'high_fat'),
  (3, 275.0, 'max', NULL), (4, 28.0, 'min', 'low_fiber'), (5, 50.0, 'max', 'high_sugar'))
  t(nutrient_id, recommended_daily_g, threshold_type, segment_label)""")

# ---------------------------------------------------------------- fixtures
cte("fx_users", f"""SELECT CAST(c.c_custkey AS BIGINT) AS user_id, n.n_name AS country,
  DATE '1950-01-01' + CAST((c.c_custkey * 11) % 18250 AS INTEGER) AS birth_date,
  CAST(150 + c.c_custkey % 50 AS DOUBLE) AS height_cm,
  make_timestamp(CAST(1672531200 + (c.c_custkey * 7919) % 31536000 AS BIGINT) * 1000000) AS registered_at
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey""")

cte("fx_weights", """SELECT md5(concat_ws('-', CAST(user_id AS VARCHAR), CAST(weight_kg AS VARCHAR),
    CAST(recorded_at AS VARCHAR))) AS weight_log_id, user_id, weight_kg, recorded_at
FROM (SELECT CAST(user_id AS BIGINT) AS user_id, CAST(450 + (event_id * 7) % 750 AS DOUBLE) / 10 AS weight_kg,
             ts AS recorded_at FROM events WHERE event_type = 'signup') w""")


def _amt(expr: str) -> str:
    return f"CAST(CAST(CAST({expr} AS DECIMAL(9,0)) * 0.1 AS DECIMAL(9,1)) AS DECIMAL(20,10))"


def _protein(mult: str, again: str = "0") -> str:
    """Five decimals where p_partkey % 101 = 0; a second document of the food may add a gram."""
    return (f"{_amt(mult)} + CASE WHEN p_partkey % 101 = 0 THEN 0.00004 ELSE 0 END"
            f" + CASE WHEN {again} THEN 1 ELSE 0 END")


_FAT = "CASE WHEN p_partkey % 173 = 0 THEN CAST(250000000 AS DECIMAL(20,10)) ELSE " + _amt("(p_partkey * 17) % 1000") + " END"
#: foods of the first load that come in two documents
TWICE = "(p_partkey % 107 = 0 AND p_partkey % 97 <> 0)"
# raw documents: nutrients listed in each
cte("fx_documents", f"""SELECT *, CASE WHEN p_partkey % 97 = 0 THEN 0
  ELSE 5 + (CASE WHEN p_partkey % 5 <> 0 THEN 1 ELSE 0 END) + (CASE WHEN p_partkey % 13 = 0 THEN 1 ELSE 0 END) END AS n_nutrients
FROM part UNION ALL SELECT *, 1 FROM part WHERE {TWICE}""")
# fixture rule: a food whose nutrient list is empty (p_partkey % 97 = 0) is dropped by the pivot
cte("fx_food_src", """SELECT *, CASE WHEN p_partkey % 97 = 0 THEN 0 ELSE 1 END AS n_nutrient_lists FROM part""")
cte("fx_foods", f"""SELECT CAST(p_partkey AS BIGINT) AS fdc_id,
  CASE WHEN p_partkey % 89 = 0 THEN 'Unknown' ELSE p_name || ' #' || CAST(p_partkey AS VARCHAR) END AS description,
  DATE '2019-04-01' + CAST(p_partkey % 1000 AS INTEGER) AS publication_date,
  {_protein('(p_partkey * 13) % 1000', TWICE)} AS protein_g,
  {_FAT} AS fat_g,
  {_amt('(p_partkey * 19) % 1000')} AS carbohydrate_g,
  CASE WHEN p_partkey % 5 = 0 THEN CAST(0 AS DECIMAL(20,10)) ELSE {_amt('(p_partkey * 23) % 300')} END AS fiber_g,
  CASE WHEN p_partkey % 7 = 0 THEN CAST(0 AS DECIMAL(20,10)) ELSE {_amt('(p_partkey * 29) % 1000')} END AS total_sugar_g
FROM fx_food_src WHERE n_nutrient_lists > 0""", ["fx_food_src"])

cte("fx_items_e", f"""SELECT * FROM (SELECT CAST(user_id AS BIGINT) AS user_id,
  CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 ELSE 3 END AS meal_id,
  CAST((event_id * 31) % (SELECT max(p_partkey) FROM part) AS BIGINT) AS fdc_id,
  80 + CAST(json_extract_string(props, '$.k') AS DOUBLE) AS grams,
  CAST(ts AS DATE) AS logged_date, {_did('CAST(ts AS DATE)')} AS logged_date_id
FROM events WHERE event_type IN ('view', 'click', 'purchase')) i WHERE grams IS NOT NULL""")

cte("fx_items_o", f"""SELECT CAST(o.o_custkey AS BIGINT) AS user_id, CAST(l.l_linenumber % 3 + 1 AS INTEGER) AS meal_id,
  CAST(l.l_partkey AS BIGINT) AS fdc_id, 80.0 + 3.0 * l.l_quantity AS grams,
  CAST(o.o_orderdate AS DATE) AS logged_date, {_did('CAST(o.o_orderdate AS DATE)')} AS logged_date_id
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""")

NUTS = ["protein_g", "fat_g", "carbohydrate_g", "fiber_g", "total_sugar_g"]
# raw feed behind each history: (table, timestamp column); its days anchor as_of and ranges
FEED = {"e": ("events", "ts"), "o": ("orders", "o_orderdate")}

for h in ("e", "o"):
    cols = ",\n  ".join(f"CAST(CAST(f.{n} AS DECIMAL(20,10)) * 0.01 AS DECIMAL(22,12)) * CAST(i.grams AS DECIMAL(15,6)) AS {n}" for n in NUTS)
    cte(f"fx_scaled_{h}", f"""SELECT i.user_id, i.meal_id, i.logged_date, i.logged_date_id,
  {cols}
FROM fx_items_{h} i JOIN fx_foods f ON i.fdc_id = f.fdc_id""", [f"fx_items_{h}", "fx_foods"])
    cte(f"fx_asof_{h}", f"SELECT max(CAST({FEED[h][1]} AS DATE)) AS as_of FROM {FEED[h][0]}")
    union = "\n  UNION ALL ".join(
        f"SELECT user_id, logged_date, logged_date_id, {k + 1} AS nutrient_id, {n} AS v FROM fx_scaled_{h}"
        for k, n in enumerate(NUTS))
    cte(f"fx_daily_{h}", f"""SELECT user_id, nutrient_id, logged_date, logged_date_id, sum(v) AS daily_value_g
FROM ({union}) lf
WHERE logged_date >= (SELECT as_of FROM fx_asof_{h}) - INTERVAL 365 DAY
GROUP BY user_id, nutrient_id, logged_date, logged_date_id""", [f"fx_scaled_{h}", f"fx_asof_{h}"])
    union_m = "\n  UNION ALL ".join(
        f"SELECT user_id, meal_id, logged_date, logged_date_id, {k + 1} AS nutrient_id, {n} AS v FROM fx_scaled_{h}"
        for k, n in enumerate(NUTS))
    cte(f"fx_mln_{h}", f"""SELECT user_id, meal_id, nutrient_id, logged_date, logged_date_id, sum(v) AS value_g
FROM ({union_m}) lf GROUP BY user_id, meal_id, nutrient_id, logged_date, logged_date_id""", [f"fx_scaled_{h}"])

cte("fx_latest_w", """SELECT user_id, weight_kg FROM (
  SELECT user_id, weight_kg, row_number() OVER (PARTITION BY user_id ORDER BY recorded_at DESC, weight_log_id DESC) AS rn
  FROM fx_weights) x WHERE rn = 1""", ["fx_weights"])

cte("fx_users_bmi", f"""SELECT b.user_id, b.country, b.birth_date, b.weight_kg, b.height_cm, b.bmi,
  b.registered_date_id, c.category AS bmi_category
FROM (SELECT u.user_id, u.country, u.birth_date, w.weight_kg, u.height_cm,
        round(w.weight_kg / power(u.height_cm / 100.0, 2), 1) AS bmi,
        {_did('CAST(u.registered_at AS DATE)')} AS registered_date_id
      FROM fx_users u JOIN fx_latest_w w ON u.user_id = w.user_id) b
JOIN s_bmi c ON b.bmi >= c.min_bmi AND b.bmi < c.max_bmi""", ["fx_users", "fx_latest_w", "s_bmi"])

cte("fx_bmi_hist", f"""SELECT w.weight_log_id, w.user_id, w.weight_kg, u.height_cm,
  round(w.weight_kg / power(u.height_cm / 100.0, 2), 1) AS bmi,
  {_did('CAST(w.recorded_at AS DATE)')} AS recorded_date_id
FROM fx_weights w JOIN fx_users u ON w.user_id = u.user_id""", ["fx_weights", "fx_users"])

THRESH = "CASE WHEN x.nutrient_id = 1 THEN round(u.weight_kg * 0.8, 1) ELSE t.recommended_daily_g END"


def flag(v: str, th: str = "threshold_g") -> str:
    return f"CASE WHEN threshold_type = 'min' THEN {v} < {th} WHEN threshold_type = 'max' THEN {v} > {th} END"


for h in ("e", "o"):
    cte(f"fx_seg_{h}", f"""SELECT *, {flag('daily_value_g')} AS is_flagged FROM (
  SELECT x.user_id, x.nutrient_id, x.logged_date, x.logged_date_id,
    CAST(round(x.daily_value_g, 2) AS DOUBLE) AS daily_value_g, {THRESH} AS threshold_g,
    t.threshold_type, t.segment_label
  FROM fx_daily_{h} x JOIN fx_users_bmi u ON x.user_id = u.user_id
  JOIN s_targets t ON x.nutrient_id = t.nutrient_id WHERE t.segment_label IS NOT NULL) s""",
        [f"fx_daily_{h}", "fx_users_bmi", "s_targets"])
    cte(f"fx_recent_{h}", f"""SELECT *, max(logged_date) OVER (PARTITION BY user_id) AS reference_date
FROM fx_daily_{h} WHERE logged_date >= (SELECT as_of FROM fx_asof_{h}) - INTERVAL 30 DAY""", [f"fx_daily_{h}", f"fx_asof_{h}"])
    cte(f"fx_frames_{h}", f"""SELECT r.user_id, r.nutrient_id, r.reference_date, k.days,
  CAST(sum(r.daily_value_g) AS DOUBLE) AS total, count(*) AS logged
FROM fx_recent_{h} r JOIN (VALUES (1), (7), (30)) k(days) ON r.reference_date - r.logged_date < k.days
GROUP BY r.user_id, r.nutrient_id, r.reference_date, k.days""", [f"fx_recent_{h}"])
    cte(f"fx_win_{h}", f"""SELECT *, {flag('last_day_g')} AS is_flagged_last_day,
  {flag('last_7d_avg_g')} AS is_flagged_last_7d, {flag('last_30d_avg_g')} AS is_flagged_last_30d FROM (
  SELECT x.user_id, x.nutrient_id, x.reference_date, x.total AS last_day_g,
    round(w.total / w.logged, 2) AS last_7d_avg_g, round(m.total / m.logged, 2) AS last_30d_avg_g,
    {THRESH} AS threshold_g, t.threshold_type, t.segment_label
  FROM fx_frames_{h} x
  JOIN fx_frames_{h} w ON w.user_id = x.user_id AND w.nutrient_id = x.nutrient_id AND w.days = 7
  JOIN fx_frames_{h} m ON m.user_id = x.user_id AND m.nutrient_id = x.nutrient_id AND m.days = 30
  JOIN fx_users_bmi u ON x.user_id = u.user_id
  JOIN s_targets t ON x.nutrient_id = t.nutrient_id WHERE x.days = 1 AND t.segment_label IS NOT NULL) s""",
        [f"fx_frames_{h}", "fx_users_bmi", "s_targets"])

DBL = ", ".join(f"CAST({n} AS DOUBLE) AS {n}" for n in NUTS)

ORACLE: dict[str, str] = {}

ORACLE["b1_stg_foods"] = build(
    "SELECT CAST(p_partkey AS BIGINT) AS fdc_id, CASE WHEN p_partkey % 89 = 0 THEN 'Unknown' "
    "ELSE p_name || ' #' || CAST(p_partkey AS VARCHAR) END AS description, "
    "DATE '2019-04-01' + CAST(p_partkey % 1000 AS INTEGER) AS publication_date, "
    "TIMESTAMP '2024-02-01 00:00:00' AS loaded_at FROM fx_documents", "fx_documents")
ORACLE["b2_stg_users"] = build("SELECT * FROM fx_users", "fx_users")
ORACLE["b3_stg_weights"] = build("SELECT * FROM fx_weights", "fx_weights")
ORACLE["c1_food_pivot"] = build(
    f"SELECT fdc_id, description, {_did('publication_date')} AS publication_date_id, 20240201 AS loaded_date_id, "
    f"{DBL} FROM fx_foods", "fx_foods")
ORACLE["m5_dim_foods"] = ORACLE["c1_food_pivot"]
ORACLE["c2_meal_unpivot"] = build("SELECT * FROM fx_items_e", "fx_items_e")
ORACLE["c3_scaled"] = build(
    f"SELECT user_id, meal_id, logged_date, logged_date_id, {DBL} FROM fx_scaled_o", "fx_scaled_o")
# the shortest decimal of each serving, exact products and sums
cte("fx_items_odd", """SELECT CAST(o.o_custkey AS BIGINT) AS user_id, CAST(l.l_partkey AS BIGINT) AS fdc_id,
  CAST(CAST(CASE WHEN l.l_orderkey % 7 = 0 THEN l.l_quantity + 0.12345678::DOUBLE
    WHEN l.l_orderkey % 11 = 0 THEN 2e9::DOUBLE + l.l_quantity + 0.5::DOUBLE WHEN l.l_orderkey % 13 = 0 THEN 1e-9::DOUBLE
    ELSE 80.0::DOUBLE + 3.0::DOUBLE * l.l_quantity END AS VARCHAR) AS DECIMAL(22,11)) AS grams
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""")
ORACLE["g1_exact_sums"] = build("SELECT i.user_id, " + ", ".join(
    f"CAST(CAST(sum(CAST(f.{n} * 0.01 AS DECIMAL(14,7)) * i.grams) AS DECIMAL(38,12)) AS VARCHAR) AS {n}" for n in NUTS) +
    " FROM fx_items_odd i JOIN fx_foods f ON i.fdc_id = f.fdc_id GROUP BY i.user_id", "fx_items_odd", "fx_foods")
ORACLE["c4_daily_intake"] = build(
    "SELECT user_id, nutrient_id, logged_date, logged_date_id, CAST(daily_value_g AS DOUBLE) AS daily_value_g "
    "FROM fx_daily_o", "fx_daily_o")
ORACLE["c5_user_bmi"] = build("SELECT * FROM fx_users_bmi", "fx_users_bmi")
ORACLE["j3_weight_bands"] = build("""SELECT b.band_id, count(*) AS weigh_ins, min(w.weight_kg) AS min_kg, max(w.weight_kg) AS max_kg
FROM fx_weights w JOIN (SELECT p_partkey AS band_id,
    CASE WHEN p_partkey % 700 = 1 THEN 122.0::DOUBLE ELSE 45.0::DOUBLE + ((p_partkey * 7919) % 80000) / 1000.0::DOUBLE END AS low_kg,
    CASE WHEN p_partkey % 700 <> 1 THEN 45.0::DOUBLE + ((p_partkey * 7919) % 80000) / 1000.0::DOUBLE
      + CASE WHEN p_partkey % 500 = 0 THEN 5.0::DOUBLE ELSE (p_partkey % 50) / 1000.0::DOUBLE END END AS high_kg FROM part) b
  ON w.weight_kg >= b.low_kg AND (b.high_kg IS NULL OR w.weight_kg < b.high_kg)
GROUP BY b.band_id""", "fx_weights")
ORACLE["c6_bmi_history"] = build("SELECT * FROM fx_bmi_hist", "fx_bmi_hist")
ORACLE["c7_segments"] = build("SELECT * FROM fx_seg_e", "fx_seg_e")
ORACLE["c8_windowed"] = build("SELECT * FROM fx_win_e", "fx_win_e")
ORACLE["m2_dim_users"] = build(
    "SELECT user_id, country, birth_date, weight_kg, height_cm, bmi, bmi_category, "
    "round(weight_kg * 0.8, 1) AS recommended_protein_g, registered_date_id FROM fx_users_bmi", "fx_users_bmi")
ORACLE["m7_meal_nutrients"] = build(
    "SELECT user_id, meal_id, nutrient_id, logged_date, logged_date_id, CAST(value_g AS DOUBLE) AS value_g "
    "FROM fx_mln_o", "fx_mln_o")

# ------------------------------------------------------------- dimensions
cte("dim_date", f"""SELECT {_did('full_date')} AS date_id, full_date, CAST(year(full_date) AS INTEGER) AS year,
  CAST(quarter(full_date) AS INTEGER) AS quarter, CAST(month(full_date) AS INTEGER) AS month,
  monthname(full_date) AS month_name, CAST(week(full_date) AS INTEGER) AS week_of_year,
  CAST(day(full_date) AS INTEGER) AS day_of_month, CAST(dayofweek(full_date) AS INTEGER) AS day_of_week,
  dayname(full_date) AS day_name, dayofweek(full_date) IN (0, 6) AS is_weekend
FROM (SELECT CAST(d AS DATE) AS full_date FROM range(DATE '2019-01-01', DATE '2027-12-31', INTERVAL 1 DAY) t(d)) s""")

# ---------------------------------------------------------------- raw logs
cte("fx_logs_e", """SELECT CAST(user_id AS BIGINT) AS user_id, min(ts) AS logged_at,
  CAST(count(*) FILTER (WHERE event_type = 'view') AS INTEGER) AS nb,
  CAST(count(*) FILTER (WHERE event_type = 'click') AS INTEGER) AS nl,
  CAST(count(*) FILTER (WHERE event_type = 'purchase' OR (event_type NOT IN ('view', 'click') AND event_id % 5 = 0)) AS INTEGER) AS nd
FROM events GROUP BY CAST(user_id AS BIGINT), CAST(ts AS DATE), event_id // 100000""")
_LOGS = "SELECT user_id, logged_at, nb AS n_breakfast, nl AS n_lunch, nd AS n_dinner FROM fx_logs_e"
ORACLE["b4_stg_meal_logs"] = build(_LOGS, "fx_logs_e")

ORACLE["m1_dim_date"] = build(f"""SELECT {_did('full_date')} AS date_id, full_date, CAST(year(full_date) AS INTEGER) AS year,
  CAST(quarter(full_date) AS INTEGER) AS quarter, CAST(month(full_date) AS INTEGER) AS month,
  monthname(full_date) AS month_name, CAST(week(full_date) AS INTEGER) AS week_of_year,
  CAST(day(full_date) AS INTEGER) AS day_of_month, CAST(dayofweek(full_date) AS INTEGER) AS day_of_week,
  dayname(full_date) AS day_name, dayofweek(full_date) IN (0, 6) AS is_weekend
FROM (SELECT CAST(d AS DATE) AS full_date FROM range((SELECT min(CAST(o_orderdate AS DATE)) FROM orders),
      (SELECT max(CAST(o_orderdate AS DATE)) FROM orders) + INTERVAL 1 DAY, INTERVAL 1 DAY) t(d)) s""")

for h in ("e", "o"):
    cte(f"fx_dn_{h}", f"""SELECT f.user_id, f.nutrient_id, n.nutrient_name, f.logged_date, sum(f.value_g) AS dv
FROM fx_mln_{h} f JOIN s_nutrients n ON f.nutrient_id = n.nutrient_id
GROUP BY f.user_id, f.nutrient_id, n.nutrient_name, f.logged_date""", [f"fx_mln_{h}", "s_nutrients"])
    cte(f"fx_range_{h}", f"""SELECT CAST(min(CAST({FEED[h][1]} AS DATE)) + INTERVAL 7 DAY AS DATE) AS s,
  max(CAST({FEED[h][1]} AS DATE)) AS e FROM {FEED[h][0]}""")
    cte(f"fx_dnr_{h}", f"""SELECT f.user_id, f.nutrient_id, n.nutrient_name, f.logged_date, sum(f.value_g) AS dv
FROM fx_mln_{h} f JOIN s_nutrients n ON f.nutrient_id = n.nutrient_id
WHERE f.logged_date BETWEEN (SELECT s FROM fx_range_{h}) AND (SELECT e FROM fx_range_{h})
GROUP BY f.user_id, f.nutrient_id, n.nutrient_name, f.logged_date""", [f"fx_mln_{h}", "s_nutrients", f"fx_range_{h}"])
    cte(f"fx_foodlog_{h}", f"""SELECT i.user_id, i.meal_id, i.fdc_id, i.grams, i.logged_date, m.meal_name,
  f.description AS food_name
FROM fx_items_{h} i JOIN fx_foods f ON i.fdc_id = f.fdc_id JOIN s_meals m ON i.meal_id = m.meal_id""",
        [f"fx_items_{h}", "fx_foods", "s_meals"])

AVG2 = "round(CAST(sum({0}) AS DOUBLE) / count({0}), 2)"

ORACLE["r1_daily"] = build("""SELECT f.user_id, n.nutrient_name, f.logged_date, CAST(sum(f.value_g) AS DOUBLE) AS daily_value_g
FROM fx_mln_o f JOIN s_nutrients n ON f.nutrient_id = n.nutrient_id GROUP BY f.user_id, n.nutrient_name, f.logged_date""",
                           "fx_mln_o", "s_nutrients")
ORACLE["r2_weekly"] = build(f"""SELECT user_id, nutrient_name, CAST(date_trunc('week', logged_date) AS DATE) AS week_start,
  {AVG2.format('dv')} AS weekly_avg_g
FROM fx_dn_o GROUP BY user_id, nutrient_id, nutrient_name, date_trunc('week', logged_date)""", "fx_dn_o")
ORACLE["r3_mom"] = build(f"""SELECT user_id, nutrient_name, month_start, monthly_avg_g,
  lag(monthly_avg_g) OVER (PARTITION BY user_id, nutrient_id ORDER BY month_start) AS prev_month_avg_g,
  round(monthly_avg_g - lag(monthly_avg_g) OVER (PARTITION BY user_id, nutrient_id ORDER BY month_start), 2) AS mom_delta_g
FROM (SELECT user_id, nutrient_id, nutrient_name, CAST(date_trunc('month', logged_date) AS DATE) AS month_start,
        {AVG2.format('dv')} AS monthly_avg_g
      FROM fx_dn_o GROUP BY user_id, nutrient_id, nutrient_name, date_trunc('month', logged_date)) m""", "fx_dn_o")
ORACLE["r4_rolling"] = build("""SELECT user_id, nutrient_name, logged_date, week_of_year, month_name,
  CAST(dv AS DOUBLE) AS daily_value_g,
  round(CAST(sum(dv) OVER w AS DOUBLE) / count(dv) OVER w, 2) AS rolling_7d_avg_g
FROM (SELECT f.user_id, f.nutrient_id, n.nutrient_name, f.logged_date, dd.week_of_year, dd.month_name, sum(f.value_g) AS dv
      FROM fx_mln_e f JOIN s_nutrients n ON f.nutrient_id = n.nutrient_id JOIN dim_date dd ON f.logged_date_id = dd.date_id
      GROUP BY f.user_id, f.nutrient_id, n.nutrient_name, f.logged_date, dd.week_of_year, dd.month_name) x
WINDOW w AS (PARTITION BY user_id, nutrient_id ORDER BY logged_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
                             "fx_mln_e", "s_nutrients", "dim_date")
ORACLE["r5_latest"] = build("""SELECT s.user_id, n.nutrient_name, s.logged_date, s.daily_value_g, s.threshold_g,
  s.threshold_type, s.segment_label, s.is_flagged
FROM fx_seg_e s JOIN s_nutrients n ON s.nutrient_id = n.nutrient_id
WHERE s.logged_date = (SELECT max(logged_date) FROM fx_seg_e)""", "fx_seg_e", "s_nutrients")
ORACLE["r6_windowed_report"] = build("""SELECT w.user_id, n.nutrient_name, w.segment_label, w.threshold_g, w.threshold_type,
  w.last_day_g, w.last_7d_avg_g, w.last_30d_avg_g, w.is_flagged_last_day, w.is_flagged_last_7d, w.is_flagged_last_30d
FROM fx_win_e w JOIN s_nutrients n ON w.nutrient_id = n.nutrient_id""", "fx_win_e", "s_nutrients")
ORACLE["r7_segment_pivot"] = build("SELECT user_id, " + ", ".join(
    f"max(CASE WHEN segment_label = '{lb}' AND is_flagged THEN true ELSE false END) AS {lb}"
    for lb in ["low_protein", "high_fat", "low_fiber", "high_sugar"]) + """
FROM fx_seg_e WHERE logged_date = (SELECT max(logged_date) FROM fx_seg_e) GROUP BY user_id""", "fx_seg_e")
ORACLE["r8_food_log"] = build("""SELECT user_id, logged_date, meal_name, food_name, grams FROM fx_foodlog_e
WHERE logged_date = (SELECT as_of FROM fx_asof_e)""", "fx_foodlog_e", "fx_asof_e")
ORACLE["r9_weekly_food"] = build("""SELECT user_id, CAST(date_trunc('week', logged_date) AS DATE) AS week_start, meal_name,
  food_name, count(*) AS times_logged,
  round(CAST(sum(CAST(grams AS DECIMAL(15,6))) AS DOUBLE) / count(grams), 1) AS avg_grams
FROM fx_foodlog_o GROUP BY user_id, date_trunc('week', logged_date), meal_name, food_name""", "fx_foodlog_o")
ORACLE["r10_bmi"] = build("""SELECT b.user_id, d.full_date AS recorded_date, b.weight_kg, b.height_cm, b.bmi
FROM fx_bmi_hist b JOIN dim_date d ON b.recorded_date_id = d.date_id""", "fx_bmi_hist", "dim_date")

ORACLE["t1_order"] = build("""SELECT *, row_number() OVER (ORDER BY logged_date DESC, meal_id, food_name NULLS LAST,
    grams DESC, user_id, fdc_id) AS position
FROM (SELECT i.user_id, i.logged_date, i.meal_id, i.fdc_id, nullif(f.description, 'Unknown') AS food_name, i.grams
  FROM fx_items_e i LEFT JOIN fx_foods f ON i.fdc_id = f.fdc_id) x""", "fx_items_e", "fx_foods")
ORACLE["d1_max_date"] = build("SELECT max(logged_date) AS max_date FROM fx_items_o", "fx_items_o")
ORACLE["d2_users"] = build("SELECT user_id FROM fx_users_bmi", "fx_users_bmi")
ORACLE["d3_overview"] = build("""SELECT u.user_id, u.country, u.birth_date, u.weight_kg, u.height_cm, u.bmi, u.bmi_category,
  round(u.weight_kg * 0.8, 1) AS recommended_protein_g, d.full_date AS registered_date
FROM fx_users_bmi u JOIN dim_date d ON u.registered_date_id = d.date_id""", "fx_users_bmi", "dim_date")
ORACLE["d4_rolling_user"] = build("""SELECT user_id, nutrient_name, logged_date, CAST(dv AS DOUBLE) AS daily_value_g,
  round(CAST(sum(dv) OVER w AS DOUBLE) / count(dv) OVER w, 2) AS rolling_7d_avg_g
FROM fx_dnr_e WINDOW w AS (PARTITION BY user_id, nutrient_id ORDER BY logged_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
                                  "fx_dnr_e")
D5 = f"""SELECT user_id, nutrient_name, CAST(date_trunc('week', logged_date) AS DATE) AS week_start,
  {AVG2.format('dv')} AS weekly_avg_g
FROM fx_dnr_o GROUP BY user_id, nutrient_id, nutrient_name, date_trunc('week', logged_date)"""
ORACLE["d5_weekly_user"] = build(D5, "fx_dnr_o")
D6 = f"""SELECT user_id, nutrient_name, month_start, monthly_avg_g,
  round(monthly_avg_g - lag(monthly_avg_g) OVER (PARTITION BY user_id, nutrient_id ORDER BY month_start), 2) AS mom_delta_g
FROM (SELECT user_id, nutrient_id, nutrient_name, CAST(date_trunc('month', logged_date) AS DATE) AS month_start,
        {AVG2.format('dv')} AS monthly_avg_g
      FROM fx_dnr_o GROUP BY user_id, nutrient_id, nutrient_name, date_trunc('month', logged_date)) m"""
ORACLE["d6_monthly_user"] = build(D6, "fx_dnr_o")
ORACLE["d7_food_range"] = build("""SELECT user_id, logged_date, meal_name, food_name AS description, grams FROM fx_foodlog_e
WHERE logged_date BETWEEN (SELECT s FROM fx_range_e) AND (SELECT e FROM fx_range_e)""", "fx_foodlog_e", "fx_range_e")
ORACLE["d8_bmi_range"] = build("""SELECT b.user_id, d.full_date AS recorded_date, b.weight_kg, b.bmi
FROM fx_bmi_hist b JOIN dim_date d ON b.recorded_date_id = d.date_id
WHERE d.full_date BETWEEN (SELECT s FROM fx_range_e) AND (SELECT e FROM fx_range_e)""", "fx_bmi_hist", "dim_date", "fx_range_e")
ORACLE["d9_windowed_user"] = build("""SELECT w.user_id, n.nutrient_name, w.last_day_g, w.last_7d_avg_g, w.last_30d_avg_g,
  w.threshold_g, w.segment_label, w.is_flagged_last_day, w.is_flagged_last_7d, w.is_flagged_last_30d
FROM fx_win_e w JOIN s_nutrients n ON w.nutrient_id = n.nutrient_id""", "fx_win_e", "s_nutrients")
ORACLE["d10_flagged_counts"] = build("""SELECT n.nutrient_name, s.logged_date, count(*) AS total_users,
  CAST(sum(CASE WHEN s.is_flagged THEN 1 ELSE 0 END) AS BIGINT) AS flagged_users
FROM fx_seg_e s JOIN s_nutrients n ON s.nutrient_id = n.nutrient_id
WHERE s.logged_date BETWEEN (SELECT s FROM fx_range_e) AND (SELECT e FROM fx_range_e)
GROUP BY s.nutrient_id, n.nutrient_name, s.logged_date""", "fx_seg_e", "s_nutrients", "fx_range_e")
ORACLE["d11_first_last"] = build("""SELECT user_id,
  max(CASE WHEN rd = 1 THEN weight_kg END) AS current_weight_kg,
  round(max(CASE WHEN rd = 1 THEN weight_kg END) - max(CASE WHEN ra = 1 THEN weight_kg END), 1) AS weight_delta_kg,
  max(CASE WHEN rd = 1 THEN bmi END) AS current_bmi,
  round(max(CASE WHEN rd = 1 THEN bmi END) - max(CASE WHEN ra = 1 THEN bmi END), 1) AS bmi_delta
FROM (SELECT b.user_id, b.weight_kg, b.bmi,
        row_number() OVER (PARTITION BY b.user_id ORDER BY d.full_date DESC, b.weight_log_id DESC) AS rd,
        row_number() OVER (PARTITION BY b.user_id ORDER BY d.full_date, b.weight_log_id) AS ra
      FROM fx_bmi_hist b JOIN dim_date d ON b.recorded_date_id = d.date_id
      WHERE d.full_date BETWEEN (SELECT s FROM fx_range_e) AND (SELECT e FROM fx_range_e)) x
GROUP BY user_id""", "fx_bmi_hist", "dim_date", "fx_range_e")
ORACLE["d12_week_labels"] = build(f"SELECT *, strftime(week_start, '%Y-W%W') AS week_label FROM ({D5}) q", "fx_dnr_o")
ORACLE["d12_month_labels"] = build(f"SELECT *, strftime(month_start, '%b %Y') AS month_label FROM ({D6}) q", "fx_dnr_o")
ORACLE["d13_day_meals"] = build("""SELECT i.user_id, i.logged_date,
  CASE i.meal_id WHEN 1 THEN 'breakfast' WHEN 2 THEN 'lunch' WHEN 3 THEN 'dinner' END AS meal_name,
  (SELECT f.description FROM fx_foods f WHERE f.fdc_id = i.fdc_id) AS description, i.grams
FROM fx_items_e i WHERE i.fdc_id IN (SELECT fdc_id FROM fx_foods)
  AND i.logged_date >= (SELECT s FROM fx_range_e) AND i.logged_date <= (SELECT e FROM fx_range_e)""",
                                "fx_items_e", "fx_foods", "fx_range_e")

# ----------------------------------------------------------------- quality
ORACLE["q1_not_null"] = build("""SELECT 'user_id' AS column_name, count(*) FILTER (WHERE user_id IS NULL) AS failures FROM fx_logs_e
UNION ALL SELECT 'breakfast', count(*) FILTER (WHERE nb = 0) FROM fx_logs_e
UNION ALL SELECT 'lunch', CAST(0 AS BIGINT) UNION ALL SELECT 'dinner', CAST(0 AS BIGINT)
UNION ALL SELECT 'logged_at', count(*) FILTER (WHERE logged_at IS NULL) FROM fx_logs_e""", "fx_logs_e")
ORACLE["q2_unique"] = f"""SELECT * FROM (SELECT CAST(p_partkey AS BIGINT) AS fdc_id, CAST(1 + CASE WHEN {TWICE} THEN 1 ELSE 0 END
  + CASE WHEN p_size > 40 THEN 1 ELSE 0 END AS BIGINT) AS n_records FROM part) q WHERE n_records > 1"""
ORACLE["q2_new_duplicates"] = build("""SELECT l.l_orderkey * 8 + l.l_linenumber AS line_id, strftime(o.o_orderdate, '%Y-%m') AS month,
  count(*) AS stored
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
WHERE strftime(o.o_orderdate, '%Y-%m') IN ('1996-03', '1998-11') AND (l.l_orderkey * 8 + l.l_linenumber) % 3 = 0
GROUP BY 1, 2""")
ORACLE["q3_accepted_values"] = build("""SELECT country AS value_field, count(*) AS n_records FROM fx_users
WHERE country NOT IN ('Spain') GROUP BY country""", "fx_users")
ORACLE["q4_relationships"] = build("""SELECT i.fdc_id AS from_field FROM fx_items_o i
WHERE NOT EXISTS (SELECT 1 FROM fx_foods f WHERE f.fdc_id = i.fdc_id)""", "fx_items_o", "fx_foods")
ORACLE["q5_range"] = build(" UNION ALL ".join(
    f"SELECT '{n}' AS column_name, count(*) FILTER (WHERE NOT ({n} >= 0 AND {n} <= 100)) AS failures, "
    f"'dim_foods' AS table_name FROM fx_foods" for n in NUTS) +
    " UNION ALL SELECT 'grams', count(*) FILTER (WHERE NOT (grams >= 0 AND grams <= 1000)), 'fct_meal_logs' FROM fx_items_o",
    "fx_foods", "fx_items_o")
ORACLE["q6_one_meal"] = build("""SELECT user_id, logged_at FROM fx_logs_e
WHERE nb = 0 AND nl = 0 AND nd = 0""", "fx_logs_e")
_AS_OF = "TIMESTAMP '2024-02-01 06:00:00'"
ORACLE["q7_freshness"] = build(f"""SELECT source_name, max_loaded_at, age_hours,
  CASE WHEN max_loaded_at IS NULL THEN 'error' WHEN age_hours > err THEN 'error' WHEN age_hours > warn THEN 'warn'
       ELSE 'pass' END AS status
FROM (SELECT 'app_events.raw_meal_logs' AS source_name, max(logged_at) AS max_loaded_at,
        12.0 AS warn, 25.0 AS err FROM fx_logs_e
      UNION ALL SELECT 'usda.raw_foods', TIMESTAMP '2024-02-01 00:00:00', 720.0, 1440.0) s,
LATERAL (SELECT CAST((epoch_us({_AS_OF}) - epoch_us(s.max_loaded_at)) // 1000000 AS DOUBLE) / 3600.0 AS age_hours) a""",
                              "fx_logs_e")
ORACLE["q8_grain"] = build("""SELECT user_id, meal_id, fdc_id, logged_date, count(*) AS n_records FROM fx_items_o
GROUP BY user_id, meal_id, fdc_id, logged_date HAVING count(*) > 1""", "fx_items_o")

# ------------------------------------------------------------------ writes
cte("fx_feed0_e", "SELECT min(CAST(ts AS DATE)) AS d0 FROM events")
cte("fx_b1_e", """SELECT * FROM fx_items_e WHERE logged_date <= (SELECT d0 FROM fx_feed0_e) + INTERVAL 14 DAY""",
    ["fx_items_e", "fx_feed0_e"])
ORACLE["i1_late_days"] = ORACLE["c2_meal_unpivot"]
ORACLE["i1_high_water"] = build("""SELECT * FROM fx_b1_e UNION ALL
SELECT * FROM fx_items_e WHERE logged_date >= (SELECT d0 FROM fx_feed0_e) + INTERVAL 10 DAY
  AND logged_date > (SELECT max(logged_date) FROM fx_b1_e)""", "fx_b1_e", "fx_items_e", "fx_feed0_e")
cte("fx_b2_e", """SELECT user_id, meal_id, fdc_id, grams + 1.0 AS grams, logged_date, logged_date_id FROM fx_items_e
WHERE logged_date >= (SELECT d0 FROM fx_feed0_e) + INTERVAL 10 DAY""", ["fx_items_e", "fx_feed0_e"])
ORACLE["i2_replace"] = build("""SELECT * FROM fx_b1_e b WHERE NOT EXISTS (SELECT 1 FROM fx_b2_e x WHERE x.user_id = b.user_id
  AND x.meal_id = b.meal_id AND x.fdc_id = b.fdc_id AND x.logged_date = b.logged_date)
UNION ALL SELECT * FROM fx_b2_e""", "fx_b1_e", "fx_b2_e")

cte("fx_foods2", f"""SELECT CAST(p_partkey AS BIGINT) AS fdc_id,
  CASE WHEN p_partkey % 89 = 0 THEN 'Unknown' ELSE p_name || ' #' || CAST(p_partkey AS VARCHAR) END AS description,
  {_did("DATE '2019-04-01' + CAST(p_partkey % 1000 AS INTEGER)")} AS publication_date_id,
  20240301 AS loaded_date_id,
  {_protein('(p_partkey * 13 + 7) % 1000', 'false')} AS protein_g,
  {_FAT} AS fat_g,
  {_amt('(p_partkey * 19) % 1000')} AS carbohydrate_g,
  CASE WHEN p_partkey % 5 = 0 THEN CAST(0 AS DECIMAL(20,10)) ELSE {_amt('(p_partkey * 23) % 300')} END AS fiber_g,
  CASE WHEN p_partkey % 7 = 0 THEN CAST(0 AS DECIMAL(20,10)) ELSE {_amt('(p_partkey * 29) % 1000')} END AS total_sugar_g
FROM part WHERE p_size > 40""")
cte("fx_foods1", f"""SELECT fdc_id, description, {_did('publication_date')} AS publication_date_id, 20240201 AS loaded_date_id,
  {', '.join(NUTS)} FROM fx_foods""", ["fx_foods"])
_T1, _T2 = "TIMESTAMP '2024-02-01 00:00:00'", "TIMESTAMP '2024-03-01 00:00:00'"
_SCD = ", ".join(["fdc_id", "description", "publication_date_id", "loaded_date_id"] + [f"CAST({n} AS DOUBLE) AS {n}" for n in NUTS])


def _scd_row(src: str, frm: str, to: str, where: str) -> str:
    return (f"SELECT {_SCD}, md5(CAST(fdc_id AS VARCHAR) || '|' || CAST({frm} AS VARCHAR)) AS dbt_scd_id, "
            f"{frm} AS dbt_updated_at, {frm} AS dbt_valid_from, {to} AS dbt_valid_to FROM {src} {where}")


cte("fx_snap", " UNION ALL ".join([
    _scd_row("fx_foods1", _T1, "CAST(NULL AS TIMESTAMP)",
             "WHERE fdc_id NOT IN (SELECT fdc_id FROM fx_foods2)"),
    _scd_row("fx_foods1", _T1, _T2, "WHERE fdc_id IN (SELECT fdc_id FROM fx_foods2)"),
    _scd_row("fx_foods2", _T2, "CAST(NULL AS TIMESTAMP)", ""),
]), ["fx_foods1", "fx_foods2"])
ORACLE["i4_scd2"] = build("SELECT * FROM fx_snap", "fx_snap")
ORACLE["i5_point_in_time"] = build(f"""SELECT * FROM fx_snap WHERE dbt_valid_from <= {_T2}
  AND (dbt_valid_to IS NULL OR {_T2} < dbt_valid_to)""", "fx_snap")

ORACLE["a1_land_foods"] = build("""SELECT CAST(p_partkey AS BIGINT) AS fdc_id, TIMESTAMP '2024-02-01 00:00:00' AS loaded_at,
  CASE WHEN p_partkey % 89 = 0 THEN NULL ELSE p_name || ' #' || CAST(p_partkey AS VARCHAR) END AS description,
  CAST(n_nutrients AS INTEGER) AS n_nutrients FROM fx_documents""", "fx_documents")

ORACLE["a1_quarantine"] = build("""SELECT file, reason, count(*) AS n FROM (
  SELECT 'page-' || CAST(p_partkey // 200 AS VARCHAR) AS file, CASE WHEN p_partkey % 151 = 0 THEN 'fdcId is missing or not a whole number'
    WHEN p_partkey % 163 = 0 THEN 'publicationDate is not a date' WHEN p_partkey % 167 = 0 THEN 'foodNutrients is not a list'
    WHEN p_partkey % 173 = 0 THEN 'the document is not a JSON object' END AS reason
  FROM fx_documents WHERE (p_partkey // 200) % 5 <> 3
  UNION ALL SELECT DISTINCT 'page-' || CAST(p_partkey // 200 AS VARCHAR), 'the page is not a JSON array'
  FROM fx_documents WHERE (p_partkey // 200) % 5 = 3) d GROUP BY file, reason""", "fx_documents")
ORACLE["x1_stream_daily"] = build("""SELECT user_id, nutrient_id, logged_date, logged_date_id, CAST(sum(v) AS DOUBLE) AS daily_value_g
FROM (""" + "\n  UNION ALL ".join(
    f"SELECT user_id, logged_date, logged_date_id, {k + 1} AS nutrient_id, {n} AS v FROM fx_scaled_e"
    for k, n in enumerate(NUTS)) + """) lf
GROUP BY user_id, nutrient_id, logged_date, logged_date_id""", "fx_scaled_e")

ORACLE["x1_stateful_daily"] = ORACLE["x1_stream_daily"]
ORACLE["a6_food_ids"] = "SELECT DISTINCT CAST(p_partkey AS BIGINT) AS fdc_id FROM part"
ORACLE["a9_incremental_segments"] = ORACLE["c7_segments"]
ORACLE["c8_accumulated"] = ORACLE["c8_windowed"]
ORACLE["i3_full_refresh"] = build("SELECT * FROM fx_items_e WHERE logged_date >= (SELECT d0 FROM fx_feed0_e) + INTERVAL 14 DAY",
                                  "fx_items_e", "fx_feed0_e")
ORACLE["a2_daily_load"] = build(f"SELECT * FROM ({_LOGS}) q WHERE logged_at >= (SELECT d0 FROM fx_feed0_e) + INTERVAL 14 DAY",
                                "fx_logs_e", "fx_feed0_e")
ORACLE["a3_historic_load"] = build(_LOGS, "fx_logs_e")
ORACLE["a7_views"] = build("""SELECT s.segment_label, s.logged_date, u.country, count(*) AS users
FROM fx_seg_e s JOIN fx_users_bmi u ON s.user_id = u.user_id WHERE s.is_flagged
GROUP BY s.segment_label, s.logged_date, u.country""", "fx_seg_e", "fx_users_bmi")
ORACLE["w4_windows"] = build("""SELECT h.user_id, h.weight_log_id, h.recorded_date_id, h.bmi,
  CAST((SELECT sum(CAST(p.bmi * 10 AS BIGINT)) FROM fx_bmi_hist p WHERE p.user_id = h.user_id
        AND (p.recorded_date_id, p.weight_log_id) <= (h.recorded_date_id, h.weight_log_id)) AS BIGINT) AS running_bmi,
  lead(h.bmi) OVER w AS next_bmi, lag(h.bmi) OVER w AS previous_bmi, first_value(h.bmi) OVER w AS first_bmi
FROM fx_bmi_hist h WINDOW w AS (PARTITION BY h.user_id ORDER BY h.recorded_date_id, h.weight_log_id)""", "fx_bmi_hist")
ORACLE["w4_dedup"] = build("""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
  PARTITION BY user_id ORDER BY recorded_date_id DESC, weight_log_id DESC) AS rn FROM fx_bmi_hist) q WHERE rn = 1""", "fx_bmi_hist")

# -------------------------------------------------------------- mart tests
def _tests_sql(tests, src: dict[str, str], ctes: list[str]) -> str:
    from ..operators.quality import test_name
    parts = []
    for model, test, c, arg in tests:
        t = src[model]
        if test == "not_null":
            q = f"SELECT count(*) FROM {t} x WHERE x.{c} IS NULL"
        elif test == "unique":
            q = f"SELECT count(*) FROM (SELECT {c} FROM {t} x WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1) g"
        elif test == "accepted_values":
            vals = ", ".join(repr(v) for v in arg)
            q = f"SELECT count(*) FROM (SELECT {c} FROM {t} x WHERE {c} IS NOT NULL AND {c} NOT IN ({vals}) GROUP BY {c}) g"
        elif test == "relationships":
            q = (f"SELECT count(*) FROM {t} x WHERE x.{c} IS NOT NULL AND NOT EXISTS "
                 f"(SELECT 1 FROM {src[arg[0]]} p WHERE p.{arg[1]} = x.{c})")
        else:
            q = f"SELECT count(*) FROM {t} x WHERE NOT (x.{c} >= {arg[0]} AND x.{c} <= {arg[1]})"
        parts.append(f"SELECT '{test_name(model, test, c)}' AS test_name, ({q}) AS failures")
    return build("\nUNION ALL ".join(parts), *ctes)


def _mart_tests_sql() -> str:
    from ..operators.quality import MART_TESTS, test_name
    src = {"dim_users": "(SELECT *, round(weight_kg * 0.8, 1) AS recommended_protein_g FROM fx_users_bmi)",
           "dim_meals": "s_meals", "dim_date": "dim_date", "dim_nutrients": "s_nutrients",
           "fct_user_segments_windowed": "fx_win_e", "fct_user_segments": "fx_seg_e",
           "fct_bmi_evolution": "fx_bmi_hist", "dim_foods": "fx_foods1", "fct_meal_logs": "fx_items_e",
           "fct_meal_log_nutrients": "fx_mln_e"}
    parts = []
    for model, test, c, arg in MART_TESTS:
        t = src[model]
        if test == "not_null":
            q = f"SELECT count(*) FROM {t} x WHERE x.{c} IS NULL"
        elif test == "unique":
            q = f"SELECT count(*) FROM (SELECT {c} FROM {t} x WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1) g"
        elif test == "accepted_values":
            vals = ", ".join(f"'{v}'" for v in arg)
            q = f"SELECT count(*) FROM (SELECT {c} FROM {t} x WHERE {c} IS NOT NULL AND {c} NOT IN ({vals}) GROUP BY {c}) g"
        elif test == "relationships":
            q = (f"SELECT count(*) FROM {t} x WHERE x.{c} IS NOT NULL AND NOT EXISTS "
                 f"(SELECT 1 FROM {src[arg[0]]} p WHERE p.{arg[1]} = x.{c})")
        else:
            q = f"SELECT count(*) FROM {t} x WHERE NOT (x.{c} >= {arg[0]} AND x.{c} <= {arg[1]})"
        parts.append(f"SELECT '{test_name(model, test, c)}' AS test_name, ({q}) AS failures")
    return build("\nUNION ALL ".join(parts), "fx_users_bmi", "s_meals", "dim_date", "s_nutrients", "fx_win_e",
                 "fx_seg_e", "fx_bmi_hist", "fx_foods1", "fx_items_e", "fx_mln_e")


ORACLE["q9_mart_tests"] = _mart_tests_sql()

ORACLE["d12_labels"] = build("""SELECT DISTINCT logged_date, CAST(date_trunc('week', logged_date) AS DATE) AS week_start,
  strftime(logged_date, '%Y-W%W') AS week_label, CAST(date_trunc('month', logged_date) AS DATE) AS month_start,
  strftime(logged_date, '%b %Y') AS month_label
FROM fx_items_o WHERE logged_date BETWEEN (SELECT s FROM fx_range_o) AND (SELECT e FROM fx_range_o)""",
                              "fx_items_o", "fx_range_o")


cte("fx_stg_foods", """SELECT CAST(p_partkey AS BIGINT) AS fdc_id,
  CASE WHEN p_partkey % 89 = 0 THEN 'Unknown' ELSE p_name || ' #' || CAST(p_partkey AS VARCHAR) END AS description,
  DATE '2019-04-01' + CAST(p_partkey % 1000 AS INTEGER) AS publication_date, 'json' AS raw_json,
  TIMESTAMP '2024-02-01 00:00:00' AS loaded_at FROM fx_documents""", ["fx_documents"])
cte("fx_raw_users", """SELECT u.*, c.c_name AS user_name FROM fx_users u JOIN customer c ON u.user_id = c.c_custkey""",
    ["fx_users"])
cte("fx_stg_logs", "SELECT user_id, logged_at FROM fx_logs_e", ["fx_logs_e"])


def _model_tests_sql() -> str:
    from ..operators.quality import MODEL_TESTS
    src = {"raw_foods": "fx_stg_foods", "raw_meal_logs": "fx_stg_logs", "raw_users": "fx_raw_users",
           "raw_weights": "fx_weights",
           "stg_users": "fx_users", "stg_weights": "fx_weights", "stg_meal_logs": "fx_stg_logs",
           "stg_foods": "fx_stg_foods", "users_bmi": "fx_users_bmi", "segments": "fx_seg_e", "windowed": "fx_win_e",
           "food_nutrients": "fx_foods", "daily_intake": "fx_daily_e", "scaled": "fx_scaled_e",
           "bmi_history": "fx_bmi_hist", "items": "fx_items_e"}
    return _tests_sql(MODEL_TESTS, src, ["fx_raw_users", "fx_users", "fx_weights", "fx_stg_logs", "fx_stg_foods", "fx_users_bmi",
                                         "fx_seg_e", "fx_win_e", "fx_foods", "fx_daily_e", "fx_scaled_e",
                                         "fx_bmi_hist", "fx_items_e"])


ORACLE["q10_model_tests"] = _model_tests_sql()


def _snapshot_tests_sql() -> str:
    from ..operators.quality import SNAPSHOT_TESTS
    return _tests_sql(SNAPSHOT_TESTS, {"dim_foods_snapshot": "fx_snap"}, ["fx_snap"])


ORACLE["q11_snapshot_tests"] = _snapshot_tests_sql()
