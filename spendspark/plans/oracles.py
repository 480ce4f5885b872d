"""The same results as plain SQL, written against the driver tables on their own terms.

The SQL takes other roads than the Spark plans where it can: shared week calendars with joins
instead of gap expansion, a global row number instead of a boundary search, expected values by
construction instead of parsing.
"""

from __future__ import annotations

# The texts of the results, written out here so that a change of the code is noticed.
_BELOW_AVERAGE = ("Bạn đang chi tiêu ít hơn ", "% so với mức trung bình. Rất tiết kiệm!")
_ABOVE_AVERAGE = ("Bạn đang chi tiêu nhiều hơn ", "% so với mức trung bình. Cân nhắc điều chỉnh.")
_AVERAGE = ("Chi tiêu của bạn nằm trong mức trung bình (", "%).")
_WARNING = ("⚠️ Cảnh báo: Chi tiêu vượt ", "% so với xu hướng số đông!")
_ANOMALY_FAR_ABOVE = ("Giao dịch ", "₫ cao gấp ", "x so với mức bình thường của danh mục này!")
_ANOMALY_ABOVE = ("Giao dịch ", "₫ cao hơn đáng kể so với thói quen chi tiêu của bạn.")
_ANOMALY_OTHER = ("Giao dịch ", "₫ có dấu hiệu bất thường về thời điểm hoặc mức chi.")
_ANOMALY_NONE = "Giao dịch bình thường."
_NEEDS_FOUR_WEEKS = "Cần chính xác 4 tuần dữ liệu"
_NEEDS_AVERAGES = "Cần ít nhất 1 giá trị trung bình"

LINEITEM = """tx AS (
  SELECT l_orderkey * 10 + l_linenumber AS transaction_id, l_suppkey AS user_id,
         l_linenumber AS category_id, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount,
         CAST(l_shipdate AS DATE) AS date
  FROM lineitem)"""

ORDERS = """tx AS (
  SELECT o_orderkey AS transaction_id, o_custkey AS user_id,
         CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS category_id,
         CAST(o_totalprice AS DECIMAL(18,2)) AS amount, CAST(o_orderdate AS DATE) AS date
  FROM orders)"""

EVENTS = """tx AS (
  SELECT event_id AS transaction_id, user_id,
         CASE event_type WHEN 'click' THEN 1 WHEN 'error' THEN 2 WHEN 'purchase' THEN 3
                         WHEN 'signup' THEN 4 WHEN 'view' THEN 5 END AS category_id,
         CAST(value AS DECIMAL(18,2)) AS amount, CAST(ts AS DATE) AS date
  FROM events)"""

WEEKLY = """weekly AS (
  SELECT user_id, CAST(date_trunc('week', date) AS DATE) + 6 AS week_end,
         CAST(sum(amount) AS DOUBLE) AS spend
  FROM tx GROUP BY 1, 2)"""

FILLED = (
    WEEKLY
    + """,
calendar AS (
  SELECT user_id, CAST(unnest(generate_series(first_week, last_week, INTERVAL 7 DAY)) AS DATE) AS week_end
  FROM (SELECT user_id, min(week_end) AS first_week, max(week_end) AS last_week FROM weekly GROUP BY 1)),
filled AS (
  SELECT user_id, week_end, coalesce(spend, 0.0::DOUBLE) AS spend
  FROM calendar LEFT JOIN weekly USING (user_id, week_end)),
scales AS (
  SELECT user_id,
         greatest(coalesce(round_even(quantile_cont(spend, 0.95) FILTER (WHERE spend > 0), 4), 1.0), 1.0) AS scale
  FROM filled GROUP BY 1),
scaled AS (
  SELECT user_id, week_end, spend, scale, least(greatest(spend / scale, 0.0), 3.0) AS scaled
  FROM filled JOIN scales USING (user_id))"""
)

SEQUENCES = (
    FILLED
    + """,
seqs AS (
  SELECT * FROM (
    SELECT user_id, week_end AS target_week,
           lag(scaled, 4) OVER w AS x1, lag(scaled, 3) OVER w AS x2,
           lag(scaled, 2) OVER w AS x3, lag(scaled, 1) OVER w AS x4,
           scaled AS y, scale, row_number() OVER w AS n
    FROM scaled WINDOW w AS (PARTITION BY user_id ORDER BY week_end))
  WHERE n > 4),
active AS (SELECT * FROM seqs WHERE x1 + x2 + x3 + x4 > 0.001 OR y > 0.001)"""
)

LATEST = (
    FILLED
    + """,
latest AS (
  SELECT user_id, week_end AS last_week, w1, w2, w3, w4 FROM (
    SELECT user_id, week_end,
           lag(spend, 3) OVER w AS w1, lag(spend, 2) OVER w AS w2, lag(spend, 1) OVER w AS w3, spend AS w4,
           row_number() OVER (PARTITION BY user_id ORDER BY week_end DESC) AS from_end
    FROM filled WINDOW w AS (PARTITION BY user_id ORDER BY week_end))
  WHERE from_end = 1 AND w1 IS NOT NULL)"""
)

MONTHLY = """monthly AS (
  SELECT user_id, category_id, CAST(date_trunc('month', date) AS DATE) AS year_month,
         sum(amount) AS spending,
         CAST(count(amount) AS INTEGER) AS transaction_count,
         CAST(sum(amount) AS DOUBLE) / count(amount) AS avg_transaction,
         CAST(max(amount) AS DOUBLE) AS max_transaction,
         CAST(sum(isodow(date) - 1) AS DOUBLE) / count(*) AS avg_day_of_week,
         CAST(sum(day(date)) AS DOUBLE) / count(*) AS avg_day_of_month
  FROM tx GROUP BY 1, 2, 3)"""

FEATURES = (
    MONTHLY
    + """,
totals AS (
  SELECT user_id, CAST(date_trunc('month', date) AS DATE) AS year_month,
         CAST(sum(amount) AS DOUBLE) AS total_all_categories
  FROM tx GROUP BY 1, 2),
shares AS (
  SELECT m.* EXCLUDE (spending), CAST(spending AS DOUBLE) AS monthly_spending, total_all_categories,
         CAST(spending AS DOUBLE)
           / CASE WHEN total_all_categories = 0 THEN 1 ELSE total_all_categories END AS category_ratio
  FROM monthly m LEFT JOIN totals USING (user_id, year_month)),
lagged AS (
  SELECT *, lag(monthly_spending) OVER w AS prev_month_spending,
         CAST(lag(transaction_count) OVER w AS DOUBLE) AS prev_month_count,
         lag(category_ratio) OVER w AS prev_month_ratio,
         avg(monthly_spending) OVER (PARTITION BY user_id, category_id ORDER BY year_month
                                     ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS avg_monthly_spending_3m,
         lead(monthly_spending) OVER w AS next_month_spending
  FROM shares WINDOW w AS (PARTITION BY user_id, category_id ORDER BY year_month)),
features AS (
  SELECT user_id, year_month, category_id, CAST(month(year_month) AS INTEGER) AS month,
         CAST(year(year_month) AS INTEGER) AS year, monthly_spending, transaction_count, avg_transaction,
         max_transaction, avg_day_of_week, avg_day_of_month, total_all_categories, category_ratio,
         prev_month_spending, prev_month_count, prev_month_ratio, avg_monthly_spending_3m,
         CASE WHEN prev_month_spending IS NOT NULL THEN
           least(greatest(prev_month_spending
             / CASE WHEN avg_monthly_spending_3m = 0 THEN 1 ELSE avg_monthly_spending_3m END, 0.0), 5.0)
         END AS spending_trend,
         next_month_spending
  FROM lagged),
training AS (
  SELECT * FROM features
  WHERE prev_month_spending IS NOT NULL AND next_month_spending IS NOT NULL
    AND avg_monthly_spending_3m IS NOT NULL)"""
)

ANOMALY = """averages AS (
  SELECT category_id, CAST(sum(amount) AS DOUBLE) / count(amount) AS category_avg,
         count(amount) AS transactions FROM tx GROUP BY 1),
anomaly AS (
  SELECT transaction_id, CAST(amount AS DOUBLE) AS amount, category_id,
         CAST(isodow(date) - 1 AS INTEGER) AS day_of_week, CAST(day(date) AS INTEGER) AS day_of_month,
         CAST(amount AS DOUBLE) / CASE WHEN category_avg = 0 THEN 1 ELSE category_avg END
           AS amount_vs_category_avg
  FROM tx JOIN averages USING (category_id))"""


def forest(n_trees: int = 100, size: int = 256, seed: int = 42) -> str:
    """The same forest as the engine's on the table ``anomaly``: samples by hash, one table for each level, and scores.

    Needs user and day beside the features; ``flags`` is the result.
    """
    prime, limit = 2147483647, (size - 1).bit_length()
    typical = "CASE WHEN {0} <= 1 THEN 0.0::DOUBLE WHEN {0} = 2 THEN 1.0::DOUBLE ELSE 2 * (ln({0} - 1) + 0.5772156649::DOUBLE) - 2.0::DOUBLE * ({0} - 1) / {0} END"
    hashed = f"md5('{seed}|' || concat_ws('|', transaction_id, user_id, category_id, CAST(amount AS DECIMAL(28,6)), date))"
    numbers = [1, 2, 3, 4, 5]
    lows, highs = ("[" + ", ".join(f"{f}(v[{i}])" for i in numbers) + "]" for f in ("min", "max"))
    ctes = [
        f"""maps AS (
  SELECT * FROM (WITH RECURSIVE m(tree, a, b) AS (
    SELECT 0, 48271::BIGINT, 16807::BIGINT UNION ALL SELECT tree + 1, a * 48271 % {prime}, b * 16807 % {prime} FROM m WHERE tree < {n_trees - 1})
    SELECT * FROM m)),
points AS MATERIALIZED (
  SELECT f.*, CAST([amount, category_id, day_of_week, day_of_month, amount_vs_category_avg] AS DOUBLE[]) AS v, {hashed} AS digits
  FROM (SELECT a.*, t.user_id, t.date FROM anomaly a JOIN tx t USING (transaction_id)) f),
rows0 AS MATERIALIZED (
  SELECT tree, 0::BIGINT AS slot, v FROM (
    SELECT tree, v, row_number() OVER (PARTITION BY tree ORDER BY (CAST('0x' || substr(digits, 14, 7) AS BIGINT) * a + b) % {prime},
      digits, transaction_id, user_id, category_id, amount, date) AS place FROM points, maps)
  WHERE place <= {size}),
depths AS (SELECT greatest(ceil(log2(greatest(count(*), 2))), 1) AS most, count(*) AS held FROM rows0 WHERE tree = 0)"""
    ]
    for depth in range(limit + 1):
        leaf = f"len(varying) = 0 OR {depth} >= (SELECT most FROM depths)"
        pick = f"varying[1 + CAST(floor({unit(str(seed), 'tree', 'slot', chr(39) + 'feature' + chr(39))} * len(varying)) AS BIGINT)]"
        cut = f"lo[feature] + {unit(str(seed), 'tree', 'slot', chr(39) + 'cut' + chr(39))} * (hi[feature] - lo[feature])"
        ctes.append(f"""nodes{depth} AS MATERIALIZED (
  SELECT tree, slot, feature, CASE WHEN feature IS NULL THEN NULL WHEN {cut} < hi[feature] THEN {cut} ELSE lo[feature] END AS threshold,
    CASE WHEN feature IS NULL THEN CAST(round(({depth} + {typical.format("n")}) * 1e9::DOUBLE) AS BIGINT) END AS path
  FROM (SELECT *, CASE WHEN {leaf} THEN NULL ELSE {pick} END AS feature FROM (
    SELECT *, list_filter({numbers}, lambda i: lo[i] < hi[i]) AS varying FROM (
      SELECT tree, slot, count(*) AS n, {lows} AS lo, {highs} AS hi FROM rows{depth} GROUP BY tree, slot)))),
rows{depth + 1} AS MATERIALIZED (
  SELECT r.tree, 2 * r.slot + CASE WHEN r.v[n.feature] <= n.threshold THEN 1 ELSE 2 END AS slot, r.v
  FROM rows{depth} r JOIN nodes{depth} n ON n.tree = r.tree AND n.slot = r.slot WHERE n.feature IS NOT NULL)""")
        before = "SELECT transaction_id, v, tree, 0::BIGINT AS slot FROM points, maps" if depth == 0 else (
            f"SELECT transaction_id, v, tree, 2 * slot + CASE WHEN v[feature] <= threshold THEN 1 ELSE 2 END AS slot "
            f"FROM walk{depth - 1} WHERE feature IS NOT NULL"
        )
        ctes.append(f"""walk{depth} AS MATERIALIZED (
  SELECT w.transaction_id, CASE WHEN n.feature IS NOT NULL THEN w.v END AS v, w.tree, w.slot, n.feature, n.threshold, n.path
  FROM ({before}) w JOIN nodes{depth} n ON n.tree = w.tree AND n.slot = w.slot)""")
    ends = " UNION ALL ".join(f"SELECT transaction_id, path FROM walk{d} WHERE feature IS NULL" for d in range(limit + 1))
    ctes.append(f"""scores AS MATERIALIZED (
  SELECT transaction_id, -pow(2.0::DOUBLE, -(sum(path)::BIGINT / ({float(n_trees)}::DOUBLE / 1e-9::DOUBLE))
    / (SELECT {typical.format("held")} FROM depths)) AS score FROM ({ends}) GROUP BY transaction_id),
judged AS (
  SELECT transaction_id, amount, amount_vs_category_avg, score - (SELECT quantile_cont(score, 0.05) FROM scores) AS decision
  FROM scores JOIN anomaly USING (transaction_id)),
flags AS (
  SELECT *, decision < 0 AS is_anomaly, CASE WHEN decision < 0 AND round_even(decision, 4) = 0 THEN CAST('-0.0' AS DOUBLE)
    ELSE round_even(decision, 4) END AS anomaly_score FROM judged)""")
    return ",\n".join(ctes)


def change(value: str, base: str, fallback: str) -> str:
    return (
        f"CASE WHEN {base} > 0 THEN ({value} - {base}) / {base} * 100 "
        f"WHEN {fallback} > 0 THEN ({value} - {fallback}) / {fallback} * 100 ELSE 0.0::DOUBLE END"
    )


TREND = "CASE WHEN change > 10 THEN 'increasing' WHEN change < -10 THEN 'decreasing' ELSE 'stable' END"

STATUS = (
    "CASE WHEN deviation < -20 THEN 'below_average' WHEN deviation <= 20 THEN 'average' "
    "WHEN deviation <= 50 THEN 'above_average' ELSE 'warning' END"
)


def whole(value: str) -> str:
    """Half-even whole number as text, with the sign of a small negative value."""
    return (
        f"CASE WHEN {value} < 0 AND round_even({value}, 0) = 0 THEN '-0' "
        f"ELSE CAST(CAST(round_even({value}, 0) AS BIGINT) AS VARCHAR) END"
    )


def around(texts: tuple[str, str], middle: str) -> str:
    return f"'{texts[0]}' || {middle} || '{texts[1]}'"


DEVIATION_MESSAGE = (
    f"CASE WHEN deviation < -20 THEN {around(_BELOW_AVERAGE, whole('abs(deviation)'))} "
    f"WHEN deviation <= 20 THEN "
    + around(_AVERAGE, f"CASE WHEN deviation >= 0 THEN '+' ELSE '' END || {whole('deviation')}")
    + f" WHEN deviation <= 50 THEN {around(_ABOVE_AVERAGE, whole('deviation'))} "
    f"ELSE {around(_WARNING, whole('deviation'))} END"
)

_MONEY = "format('{:,}', CAST(round_even(amount, 0) AS BIGINT))"
_RATIO = "printf('%.1f', round_even(amount_vs_category_avg, 1))"
ANOMALY_MESSAGE = (
    "CASE WHEN NOT is_anomaly THEN '" + _ANOMALY_NONE + "' WHEN amount_vs_category_avg > 3 THEN "
    f"'{_ANOMALY_FAR_ABOVE[0]}' || {_MONEY} || '{_ANOMALY_FAR_ABOVE[1]}' || {_RATIO} "
    f"|| '{_ANOMALY_FAR_ABOVE[2]}' "
    f"WHEN amount_vs_category_avg > 2 THEN {around(_ANOMALY_ABOVE, _MONEY)} "
    f"ELSE {around(_ANOMALY_OTHER, _MONEY)} END"
)


def with_ctes(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


def unit(*parts: str) -> str:
    """A number in [0, 1) from the hash of the joined parts."""
    joined = " || '|' || ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    return f"(CAST(CAST('0x' || substr(md5({joined}), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496.0::DOUBLE)"


def uniform_int(low: int, high: int, *parts: str) -> str:
    return f"CAST({low} + floor({unit(*parts)} * {high - low + 1}) AS BIGINT)"


def least_squares(inputs: list[str], target: str) -> str:
    """``solved``: weights b0, b1, ... of least squares on the table ``train``, by elimination of the normal equations."""
    names, p = ["1", *inputs, target], len(inputs) + 1
    whole = [f"CAST(round_even({v} * 1e6::DOUBLE, 0) AS DECIMAL(15,0)) AS v{i}" if i else "CAST(1 AS DECIMAL(15,0)) AS v0" for i, v in enumerate(names)]
    sums = [f"CAST(sum(CAST(v{i} AS HUGEINT) * CAST(v{j} AS HUGEINT)) AS DOUBLE) AS m{i}_{j}" for i in range(p) for j in range(p + 1)]
    ctes = [f"whole AS (SELECT {', '.join(whole)} FROM train)", f"step0 AS (SELECT {', '.join(sums)} FROM whole)"]
    for k in range(p):
        cells = [
            f"m{i}_{j} / m{k}_{k} AS m{i}_{j}" if i == k else f"m{i}_{j} - m{i}_{k} / m{k}_{k} * m{k}_{j} AS m{i}_{j}"
            for i in range(p)
            for j in range(p + 1)
        ]
        ctes.append(f"step{k + 1} AS (SELECT {', '.join(cells)} FROM step{k})")
    found = ", ".join(f"m{i}_{p}{' / 1e6::DOUBLE' if i == 0 else ''} AS b{i}" for i in range(p))
    return ",\n".join([*ctes, f"solved AS (SELECT {found} FROM step{p})"])


_WEEKLY_SIDES = """ordered AS (
  SELECT *, row_number() OVER (ORDER BY user_id, target_week) <= floor(0.8::DOUBLE * count(*) OVER ()) AS is_train FROM active),
train AS (SELECT * FROM ordered WHERE is_train)"""

_DRAW = ("42", "user_id", "day", "k")

_PER_USER = """
SELECT user_id, count(*) AS n, CAST(sum(amount) AS DOUBLE) AS total,
       CAST(min(amount) AS DOUBLE) AS smallest, CAST(max(amount) AS DOUBLE) AS largest,
       CAST(sum(category_id * day(date)) AS BIGINT) AS category_days,
       min(date) AS first_day, max(date) AS last_day"""


def synthetic(days: int, amount: str, more: str = "") -> str:
    return f"""
WITH days AS (
  SELECT c_custkey AS user_id, CAST(unnest(range(0, {days})) AS INTEGER) AS day FROM customer),
counted AS (SELECT *, {uniform_int(1, 3, "42", "user_id", "day", "'count'")} AS n FROM days),
drawn AS (SELECT user_id, day, unnest(range(1, n + 1)) AS k, DATE '2024-01-01' + day AS date FROM counted),
tx AS (
  SELECT user_id, date, {uniform_int(1, 5, *_DRAW, "'category'")} AS category_id,
         CAST({amount} AS DECIMAL(18,2)) AS amount,
         {unit(*_DRAW, "'outlier'")} < 0.05::DOUBLE AS is_injected
  FROM drawn)
{_PER_USER}{more}
FROM tx GROUP BY user_id"""


_SPREAD = f"(0.3::DOUBLE + {unit(*_DRAW, chr(39) + 'spread' + chr(39))} * 1.7::DOUBLE)"
_SEASONAL_AMOUNT = (
    f"floor({uniform_int(50_000, 300_000, '42', 'user_id', chr(39) + 'base' + chr(39))} "
    f"* (1.0::DOUBLE + day(date) / 30.0::DOUBLE * 0.3::DOUBLE) * {_SPREAD})"
)
_OUTLIER_AMOUNT = (
    f"floor({uniform_int(50_000, 200_000, '42', 'user_id', chr(39) + 'base' + chr(39))} * {_SPREAD}) "
    f"* CASE WHEN {unit(*_DRAW, chr(39) + 'outlier' + chr(39))} < 0.05::DOUBLE "
    f"THEN {uniform_int(3, 5, *_DRAW, chr(39) + 'times' + chr(39))} ELSE 1 END"
)

_ORDER_RECORDS = """
SELECT transaction_id, CASE WHEN transaction_id % 50 <> 0 THEN user_id END AS user_id, category_id,
       CAST(amount AS DOUBLE) AS amount, date, 'ăn "sáng", ' || category_id AS note
FROM tx WHERE transaction_id % 75 <> 0"""

# Orders of which some have no user and others no category.
ORDERS_WITH_GAPS = """tx AS (
  SELECT o_orderkey AS transaction_id, CASE WHEN o_orderkey % 11 <> 0 THEN o_custkey END AS user_id,
         CASE WHEN o_orderkey % 7 <> 0 THEN CAST(substr(o_orderpriority, 1, 1) AS INTEGER) END AS category_id,
         CAST(o_totalprice AS DECIMAL(18,2)) AS amount, CAST(o_orderdate AS DATE) AS date
  FROM orders)"""

_MISSING = "a model input is missing"

_SEQUENCE_COLUMNS = "SELECT user_id, target_week, x1, x2, x3, x4, y, scale FROM "
_MONTH_KEYS = "SELECT user_id, category_id, year_month, "

_SQL: dict[str, str] = {
    "amount_coercion": """
WITH items AS (
  SELECT *, CAST(l_extendedprice AS DECIMAL(18,2)) AS p, (l_orderkey + l_linenumber) % 16 AS v FROM lineitem),
texts AS (
  SELECT *, CAST(p AS VARCHAR) AS t, CAST(floor(p) AS BIGINT) AS w FROM items)
SELECT l_orderkey, l_linenumber,
  CASE v WHEN 0 THEN t WHEN 1 THEN ' ' || t || ' ' WHEN 2 THEN '+' || t WHEN 3 THEN w || '.'
    WHEN 4 THEN w || 'e1' WHEN 5 THEN w || ',000' WHEN 6 THEN w || '_000' WHEN 7 THEN '0x' || w
    WHEN 8 THEN t || 'd' WHEN 9 THEN t || 'f' WHEN 10 THEN 'NaN' WHEN 11 THEN '' WHEN 13 THEN 'abc' || w
    WHEN 14 THEN 'inf' WHEN 15 THEN '-' || t END AS amount_text,
  CAST(CASE WHEN v IN (0, 1, 2) THEN p WHEN v = 3 THEN w WHEN v = 4 THEN w * 10 WHEN v = 15 THEN -p ELSE 0 END
    AS DOUBLE) AS amount
FROM texts""",
    "date_parsing": """
SELECT o_orderkey,
  CASE o_orderkey % 8 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y-%-m-%-d')
    WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') WHEN 3 THEN ' ' || strftime(o_orderdate, '%Y-%m-%d') || ' '
    WHEN 4 THEN strftime(o_orderdate, '%Y-%m-%dT23:59:59') WHEN 5 THEN '' WHEN 6 THEN 'NaT' END AS date_text,
  CASE WHEN o_orderkey % 8 < 5 THEN CAST(o_orderdate AS DATE) END AS date
FROM orders""",
    "csv_without_header": with_ctes(ORDERS, select=_ORDER_RECORDS),
    "csv_with_header": with_ctes(ORDERS, select=_ORDER_RECORDS),
    "json_records": with_ctes(ORDERS, select=_ORDER_RECORDS),
    "json_records_alias": with_ctes(ORDERS, select=_ORDER_RECORDS),
    "ingest_rejects": """
SELECT CASE WHEN o_orderkey % 30 = 0 THEN 'not a record' WHEN o_orderkey % 41 = 0 THEN 'amount out of range'
         WHEN o_orderkey % 75 = 0 THEN 'no date' WHEN o_orderkey % 100 = 0 THEN 'neither user nor category'
         ELSE 'usable' END AS outcome, count(*) AS n
FROM orders GROUP BY 1""",
    "date_format": with_ctes(
        ORDERS,
        select="""
SELECT transaction_id, CASE WHEN transaction_id % 50 <> 0 THEN user_id END AS user_id, category_id,
       CAST(CAST(amount AS DECIMAL(24,6)) + CAST(0.000125 AS DECIMAL(24,6)) AS DOUBLE) AS amount, date
FROM tx WHERE transaction_id % 75 <> 0""",
    ),
    "weekly_spend_missing_keys": with_ctes(
        ORDERS_WITH_GAPS, WEEKLY, select="SELECT * FROM weekly WHERE user_id IS NOT NULL"
    ),
    "monthly_features_missing_keys": with_ctes(
        ORDERS_WITH_GAPS,
        FEATURES,
        select="SELECT * FROM features WHERE user_id IS NOT NULL AND category_id IS NOT NULL",
    ),
    "category_average_missing_keys": with_ctes(
        ORDERS_WITH_GAPS, ANOMALY, select="SELECT * FROM averages WHERE category_id IS NOT NULL"
    ),
    "requests_with_gaps": with_ctes(
        EVENTS,
        LATEST,
        select=f"""
SELECT 'weekly' AS kind, '{_MISSING}' AS error, count(*) AS n FROM latest WHERE user_id % 2 = 1
UNION ALL SELECT 'trend', '{_MISSING}', count(*) FROM latest WHERE user_id % 2 = 1 OR user_id % 6 = 2
UNION ALL SELECT 'transaction', '{_MISSING}', count(*) FROM tx WHERE user_id % 2 = 1 OR transaction_id % 5 = 0""",
    ),
    "iforest_flags": with_ctes(
        ORDERS,
        ANOMALY,
        forest(),
        select=f"SELECT transaction_id, is_anomaly, anomaly_score, {ANOMALY_MESSAGE} AS message FROM flags",
    ),
    "iforest_stream": f"""
SELECT o_orderkey AS transaction_id, CASE WHEN o_orderkey % 5 <> 0 AND o_orderkey % 7 <> 0 THEN true END AS as_batch,
  CASE WHEN o_orderkey % 5 = 0 THEN '{_MISSING}' WHEN o_orderkey % 7 = 0 THEN 'no stored average for this category' END AS error
FROM orders""",
    "gbt_category_quality": with_ctes(
        LINEITEM,
        FEATURES,
        select=f"""
SELECT fact, CAST(value AS DOUBLE) AS value FROM (
  SELECT 'n_train' AS fact, count(*) FILTER (side) AS value FROM sides
  UNION ALL SELECT 'n_test', count(*) FILTER (NOT side) FROM sides
  UNION ALL SELECT 'n_evaluations', 4 UNION ALL SELECT 'importances', 1
  UNION ALL SELECT 'better_rmse', 1 UNION ALL SELECT 'better_mae', 1)""",
    ).replace("\nSELECT fact", ",\nsides AS (SELECT " + unit("42", "user_id", "category_id", "year_month") + " < 0.8::DOUBLE AS side FROM training)\nSELECT fact", 1),
    "category_forecast": with_ctes(
        LINEITEM,
        FEATURES,
        select=f"""
SELECT user_id, category_id, year_month, CASE WHEN known THEN monthly_spending END AS current_spending,
  CASE WHEN known THEN true END AS in_range, CASE WHEN known THEN true END AS label_agrees,
  CASE WHEN NOT known THEN '{_MISSING}' END AS error
FROM (SELECT *, prev_month_spending IS NOT NULL AND avg_monthly_spending_3m IS NOT NULL AND spending_trend IS NOT NULL AS known
      FROM features WHERE next_month_spending IS NULL)""",
    ),
    "gbt_weekly_quality": with_ctes(
        LINEITEM,
        SEQUENCES,
        select="""
SELECT fact, CAST(value AS DOUBLE) AS value FROM (
  SELECT 'n_train' AS fact, floor(0.8::DOUBLE * count(*)) AS value FROM active
  UNION ALL SELECT 'n_test', count(*) - floor(0.8::DOUBLE * count(*)) FROM active
  UNION ALL SELECT 'n_evaluations', 0 UNION ALL SELECT 'importances', 0
  UNION ALL SELECT 'better_rmse', 1 UNION ALL SELECT 'better_mae', 1)""",
    ),
    "weekly_forecast": with_ctes(
        LINEITEM,
        LATEST,
        select="""
SELECT user_id, w1, w2, w3, w4, true AS in_range, true AS label_agrees, CAST(NULL AS VARCHAR) AS error FROM latest""",
    ),
    "weekly_linear_forecast": with_ctes(
        LINEITEM,
        SEQUENCES,
        LATEST.removeprefix(FILLED + ",\n"),
        _WEEKLY_SIDES,
        least_squares(["x1", "x2", "x3", "x4"], "y"),
        select=f"""
SELECT user_id, CASE WHEN predicted < 0 AND round_even(predicted, 0) = 0 THEN CAST('-0.0' AS DOUBLE) ELSE round_even(predicted, 0) END
    AS predicted_spending, w1, w2, w3, w4, {TREND} AS trend, round_even(change, 1) AS change_percent, CAST(NULL AS VARCHAR) AS error
FROM (SELECT *, {change("predicted", "w4", "(w1 + w2 + w3 + w4) / 4")} AS change FROM (
  SELECT *, greatest(peak * (b0 + b1 * least(w1 / peak, 3.0) + b2 * least(w2 / peak, 3.0) + b3 * least(w3 / peak, 3.0)
    + b4 * least(w4 / peak, 3.0)), 0.0::DOUBLE) AS predicted
  FROM (SELECT *, CASE WHEN greatest(w1, w2, w3, w4) > 0 THEN greatest(w1, w2, w3, w4) ELSE 1.0 END AS peak FROM latest), solved))""",
    ),
    "weekly_linear_quality": with_ctes(
        LINEITEM,
        SEQUENCES,
        _WEEKLY_SIDES,
        least_squares(["x1", "x2", "x3", "x4"], "y"),
        select="""
SELECT round_even(sqrt(avg(e * e)), 6) AS rmse, round_even(avg(abs(e)), 6) AS mae, round_even(any_value(b0), 6) AS constant,
  round_even(any_value(b1), 6) AS weight1, round_even(any_value(b2), 6) AS weight2, round_even(any_value(b3), 6) AS weight3,
  round_even(any_value(b4), 6) AS weight4
FROM (SELECT *, y - (b0 + b1 * x1 + b2 * x2 + b3 * x3 + b4 * x4) AS e FROM ordered, solved WHERE NOT is_train)""",
    ),
    "run_log": with_ctes(
        ORDERS,
        FEATURES,
        select="""
SELECT kind, key, value FROM (VALUES
  ('param', 'maxIter', '200'), ('param', 'stepSize', '0.05'), ('param', 'maxDepth', '5'), ('param', 'maxBins', '255'),
  ('param', 'featureSubsetStrategy', '0.9'), ('param', 'subsamplingRate', '0.8'), ('param', 'seed', '42')) AS p(kind, key, value)
UNION ALL SELECT 'metric', unnest(['rmse', 'mae', 'squared_error_after_50', 'squared_error_after_100',
  'squared_error_after_150', 'squared_error_after_200', 'fi_category_id', 'fi_month', 'fi_year', 'fi_monthly_spending',
  'fi_transaction_count', 'fi_avg_transaction', 'fi_max_transaction', 'fi_avg_day_of_week', 'fi_avg_day_of_month',
  'fi_total_all_categories', 'fi_category_ratio', 'fi_prev_month_spending', 'fi_prev_month_count', 'fi_prev_month_ratio',
  'fi_avg_monthly_spending_3m', 'fi_spending_trend', 'splits_category_id', 'splits_month', 'splits_year', 'splits_monthly_spending',
  'splits_transaction_count', 'splits_avg_transaction', 'splits_max_transaction', 'splits_avg_day_of_week',
  'splits_avg_day_of_month', 'splits_total_all_categories', 'splits_category_ratio', 'splits_prev_month_spending',
  'splits_prev_month_count', 'splits_prev_month_ratio', 'splits_avg_monthly_spending_3m', 'splits_spending_trend']), 'finite'
UNION ALL SELECT 'metric', 'n_transactions', CAST(count(*) AS VARCHAR) || '.0' FROM tx
UNION ALL SELECT 'metric', 'n_rows', CAST(count(*) AS VARCHAR) || '.0' FROM training
UNION ALL SELECT 'metric', 'n_train', CAST(count(*) FILTER (side) AS VARCHAR) || '.0' FROM sides
UNION ALL SELECT 'metric', 'n_test', CAST(count(*) FILTER (NOT side) AS VARCHAR) || '.0' FROM sides""",
    ).replace("\nSELECT kind", ",\nsides AS (SELECT " + unit("42", "user_id", "category_id", "year_month") + " < 0.8::DOUBLE AS side FROM training)\nSELECT kind", 1),
    "snapshot_after_empty_batch": with_ctes(
        ORDERS, select="SELECT transaction_id, user_id, category_id, CAST(amount AS DOUBLE) AS amount, date FROM tx"
    ),
    "distinct_users": "SELECT l_suppkey AS user_id FROM lineitem GROUP BY 1",
    "calendar_parts": with_ctes(
        LINEITEM,
        select="""
SELECT transaction_id, user_id, date, CAST(isodow(date) - 1 AS INTEGER) AS day_of_week,
       CAST(day(date) AS INTEGER) AS day_of_month, CAST(date_trunc('month', date) AS DATE) AS year_month,
       CAST(month(date) AS INTEGER) AS month, CAST(year(date) AS INTEGER) AS year,
       CAST(date_trunc('week', date) AS DATE) + 6 AS week_end
FROM tx""",
    ),
    "weekly_spend": with_ctes(ORDERS, WEEKLY, select="SELECT * FROM weekly"),
    "weekly_spend_gap_filled": with_ctes(ORDERS, FILLED, select="SELECT * FROM filled"),
    "weekly_spend_gap_filled_events": with_ctes(EVENTS, FILLED, select="SELECT * FROM filled"),
    "user_p95_scale": with_ctes(ORDERS, FILLED, select="SELECT * FROM scales"),
    "weekly_normalised": with_ctes(ORDERS, FILLED, select="SELECT * FROM scaled"),
    "weekly_sequences": with_ctes(EVENTS, SEQUENCES, select=_SEQUENCE_COLUMNS + "seqs"),
    "weekly_sequences_lineitem": with_ctes(LINEITEM, SEQUENCES, select=_SEQUENCE_COLUMNS + "seqs"),
    "weekly_sequences_active": with_ctes(ORDERS, SEQUENCES, select=_SEQUENCE_COLUMNS + "active"),
    "weekly_sequences_active_lineitem": with_ctes(LINEITEM, SEQUENCES, select=_SEQUENCE_COLUMNS + "active"),
    "stored_sequences": with_ctes(
        EVENTS, SEQUENCES, select="SELECT user_id, target_week, x1, x2, x3, x4, y, scale, 4 AS window_size FROM active"
    ),
    "sequence_split": with_ctes(
        LINEITEM,
        SEQUENCES,
        select="""
SELECT user_id, target_week, y,
       row_number() OVER (ORDER BY user_id, target_week) <= floor(0.8::DOUBLE * count(*) OVER ()) AS is_train
FROM active""",
    ),
    "weekly_scoring_frame": with_ctes(
        EVENTS,
        LATEST,
        select="""
SELECT user_id, last_week, w1, w2, w3, w4, least(w1 / peak, 3.0) AS x1, least(w2 / peak, 3.0) AS x2,
       least(w3 / peak, 3.0) AS x3, least(w4 / peak, 3.0) AS x4, peak, w4 AS latest,
       w1 + w2 + w3 + w4 AS total, (w1 + w2 + w3 + w4) / 4 AS mean
FROM (SELECT *, CASE WHEN greatest(w1, w2, w3, w4) > 0 THEN greatest(w1, w2, w3, w4) ELSE 1.0 END AS peak FROM latest)""",
    ),
    "trend_label_weekly": with_ctes(
        LINEITEM,
        LATEST,
        select=f"""
SELECT user_id, round_even(predicted, 0) AS predicted_spending, w1, w2, w3, w4, {TREND} AS trend,
       round_even(change, 1) AS change_percent
FROM (SELECT *, {change("predicted", "w4", "mean")} AS change
      FROM (SELECT *, (w1 + w2 + w3 + w4) / 4 AS mean, greatest((w1 + w2 + w3 + w4) / 4, 0.0) AS predicted
            FROM latest))""",
    ),
    "scoring_input_rejects": with_ctes(
        EVENTS,
        FILLED,
        select=f"""
SELECT user_id, CAST(count(*) AS INTEGER) AS n_weeks, '{_NEEDS_FOUR_WEEKS}' AS error
FROM filled GROUP BY 1 HAVING count(*) <> 4""",
    ),
    "monthly_category_spend": with_ctes(
        LINEITEM,
        MONTHLY,
        select="SELECT * EXCLUDE (spending), CAST(spending AS DOUBLE) AS monthly_spending FROM monthly",
    ),
    "monthly_user_total": with_ctes(LINEITEM, FEATURES, select="SELECT * FROM totals"),
    "category_ratio": with_ctes(
        LINEITEM,
        FEATURES,
        select=_MONTH_KEYS + "monthly_spending, total_all_categories, category_ratio FROM shares",
    ),
    "monthly_lags": with_ctes(
        LINEITEM,
        FEATURES,
        select=_MONTH_KEYS + "prev_month_spending, prev_month_count, prev_month_ratio FROM features",
    ),
    "rolling_3m_prior": with_ctes(LINEITEM, FEATURES, select=_MONTH_KEYS + "avg_monthly_spending_3m FROM features"),
    "spending_trend": with_ctes(LINEITEM, FEATURES, select=_MONTH_KEYS + "spending_trend FROM features"),
    "monthly_target": with_ctes(LINEITEM, FEATURES, select=_MONTH_KEYS + "next_month_spending FROM features"),
    "monthly_training_features": with_ctes(LINEITEM, FEATURES, select="SELECT * FROM training"),
    "monthly_training_features_orders": with_ctes(ORDERS, FEATURES, select="SELECT * FROM training"),
    "monthly_scoring_frame": with_ctes(
        LINEITEM,
        FEATURES,
        select="SELECT * EXCLUDE (next_month_spending) FROM features WHERE next_month_spending IS NULL",
    ),
    "trend_label_category": with_ctes(
        LINEITEM,
        FEATURES,
        select=f"""
SELECT user_id, year_month, category_id, round_even(predicted, 0) AS predicted_spending,
       monthly_spending AS current_spending, {TREND} AS trend, round_even(change, 1) AS change_percent
FROM (SELECT *, {change("predicted", "monthly_spending", "avg_monthly_spending_3m")} AS change
      FROM (SELECT *, greatest(avg_monthly_spending_3m, 0.0) AS predicted FROM training))""",
    ),
    "naive_forecast_error": with_ctes(
        LINEITEM,
        FEATURES,
        select="""
SELECT round_even(sqrt(avg(pow(next_month_spending - avg_monthly_spending_3m, 2))), 4) AS rmse,
       round_even(avg(abs(next_month_spending - avg_monthly_spending_3m)), 4) AS mae
FROM training""",
    ),
    "sample_counts": with_ctes(
        LINEITEM,
        FEATURES,
        SEQUENCES,
        select="""
SELECT 'transactions' AS stage, count(*) AS n FROM tx
UNION ALL SELECT 'monthly_rows', count(*) FROM training
UNION ALL SELECT 'sequences', count(*) FROM active""",
    ),
    "hashed_split_sides": with_ctes(
        LINEITEM,
        FEATURES,
        select=_MONTH_KEYS
        + unit("42", "user_id", "category_id", "year_month")
        + " < 0.8::DOUBLE AS is_train FROM training",
    ),
    "population_trend": with_ctes(
        LINEITEM,
        MONTHLY,
        select=f"""
SELECT user_id, category_id, round_even(mean, 0) AS population_average, latest AS user_spending,
       round_even(deviation, 1) AS deviation_percent, {STATUS} AS status, {DEVIATION_MESSAGE} AS message
FROM (
  SELECT *, CASE WHEN mean > 0 THEN (latest - mean) / mean * 100 ELSE 0.0::DOUBLE END AS deviation
  FROM (SELECT user_id, category_id, CAST(spending AS DOUBLE) AS latest FROM monthly
        QUALIFY row_number() OVER (PARTITION BY user_id, category_id ORDER BY year_month DESC) = 1)
  JOIN (SELECT category_id, CAST(sum(spending) AS DOUBLE) / count(*) AS mean FROM monthly GROUP BY 1)
    USING (category_id))""",
    ),
    "population_trend_arrays": with_ctes(
        ORDERS,
        MONTHLY,
        select=f"""
SELECT user_id, category_id, CASE WHEN n > 1 THEN round_even(mean, 0) END AS population_average,
       CASE WHEN n > 1 THEN latest END AS user_spending,
       CASE WHEN n > 1 THEN round_even(deviation, 1) END AS deviation_percent,
       CASE WHEN n > 1 THEN {STATUS} END AS status, CASE WHEN n > 1 THEN {DEVIATION_MESSAGE} END AS message,
       CASE WHEN n = 1 THEN '{_NEEDS_AVERAGES}' END AS error
FROM (
  SELECT *, CASE WHEN mean > 0 THEN (latest - mean) / mean * 100 ELSE 0.0::DOUBLE END AS deviation
  FROM (
    SELECT user_id, category_id, count(*) AS n, CAST(max_by(spending, year_month) AS DOUBLE) AS latest,
           CAST(sum(spending) - max_by(spending, year_month) AS DOUBLE) / nullif(count(*) - 1, 0) AS mean
    FROM monthly GROUP BY 1, 2))""",
    ),
    "category_average": with_ctes(ORDERS, ANOMALY, select="SELECT * FROM averages"),
    "anomaly_features": with_ctes(ORDERS, ANOMALY, select="SELECT * FROM anomaly"),
    "anomaly_message": with_ctes(
        ORDERS,
        ANOMALY,
        select=f"""
SELECT transaction_id, is_anomaly, {ANOMALY_MESSAGE} AS message
FROM (SELECT *, amount_vs_category_avg > 2 AS is_anomaly FROM anomaly)""",
    ),
    "anomaly_share": with_ctes(
        ORDERS,
        ANOMALY,
        select="""
SELECT count(*) FILTER (WHERE amount_vs_category_avg > 2) AS n_anomalies,
       count(*) FILTER (WHERE amount_vs_category_avg <= 2) AS n_normal,
       avg(CASE WHEN amount_vs_category_avg > 2 THEN 1 ELSE 0 END) * 100 AS anomaly_ratio_percent
FROM anomaly""",
    ),
    "ratio_threshold": with_ctes(
        ORDERS,
        ANOMALY,
        select="""
SELECT round_even(threshold, 9) AS threshold, count(*) FILTER (WHERE amount_vs_category_avg < threshold) AS n_below
FROM anomaly, (SELECT quantile_cont(amount_vs_category_avg, 0.05) AS threshold FROM anomaly)
GROUP BY 1""",
    ),
    "iforest_share": with_ctes(
        ORDERS,
        ANOMALY,
        forest(),
        select="""
SELECT count(*) FILTER (is_anomaly) AS n_anomalies, count(*) FILTER (NOT is_anomaly) AS n_normal,
       avg(CAST(is_anomaly AS INTEGER)) * 100 AS anomaly_ratio_percent FROM flags""",
    ),
    "synthetic_tiny": f"""
WITH drawn AS (SELECT c_custkey AS user_id, CAST(unnest(range(0, 10)) AS INTEGER) AS day, 1 AS k FROM customer),
tx AS (
  SELECT user_id, DATE '2023-10-01' + CAST((user_id - 101 + 36500) % 3650 * 10 AS INTEGER) + day AS date,
         {uniform_int(1, 5, *_DRAW, "'category'")} AS category_id,
         {uniform_int(20_000, 200_000, *_DRAW, "'amount'")} AS amount
  FROM drawn)
{_PER_USER}
FROM tx GROUP BY user_id""",
    "synthetic_seasonal": synthetic(365, _SEASONAL_AMOUNT),
    "synthetic_outliers": synthetic(
        180, _OUTLIER_AMOUNT, ",\n       count(*) FILTER (WHERE is_injected) AS n_injected"
    ),
}

# Day columns of each result; they are compared as ISO text.
_DAYS: dict[str, list[str]] = {
    **dict.fromkeys(
        ["date_parsing", "csv_without_header", "csv_with_header", "json_records", "snapshot_after_empty_batch"]
        + ["json_records_alias", "date_format"],
        ["date"],
    ),
    "calendar_parts": ["date", "year_month", "week_end"],
    **dict.fromkeys(
        ["weekly_spend", "weekly_spend_gap_filled", "weekly_spend_gap_filled_events", "weekly_normalised"]
        + ["weekly_spend_missing_keys"],
        ["week_end"],
    ),
    **dict.fromkeys(
        ["weekly_sequences", "weekly_sequences_lineitem", "weekly_sequences_active"]
        + ["weekly_sequences_active_lineitem", "stored_sequences", "sequence_split"],
        ["target_week"],
    ),
    "weekly_scoring_frame": ["last_week"],
    **dict.fromkeys(
        ["monthly_category_spend", "monthly_user_total", "category_ratio", "monthly_lags", "rolling_3m_prior"]
        + ["spending_trend", "monthly_target", "monthly_training_features", "monthly_training_features_orders"]
        + ["monthly_scoring_frame", "trend_label_category", "hashed_split_sides"]
        + ["monthly_features_missing_keys", "category_forecast"],
        ["year_month"],
    ),
    **dict.fromkeys(
        ["synthetic_tiny", "synthetic_seasonal", "synthetic_outliers"], ["first_day", "last_day"]
    ),
}


def days_as_text(sql: str, days: list[str]) -> str:
    casts = ", ".join(f"CAST({day} AS VARCHAR) AS {day}" for day in days)
    return f"SELECT * REPLACE ({casts}) FROM ({sql})" if days else sql


ORACLES: dict[str, str] = {name: days_as_text(sql, _DAYS.get(name, [])) for name, sql in _SQL.items()}
