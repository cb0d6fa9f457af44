"""The registered queries as plain SQL for another engine.

Written from the definitions, with EXISTS and distinct counts per window, not from the way the Spark
code computes them. Percentages use the same exact rounding: half away from zero on whole numbers.
"""

from __future__ import annotations

IST = "INTERVAL 330 MINUTE"
FLOOR = "DATE '2024-01-05'"
ORDERS_FLOOR = "DATE '1996-01-01'"
REF = "DATE '2024-01-28'"
SEGMENTS = ("AUTOMOBILE", "BUILDING", "HOUSEHOLD", "MACHINERY")
IN_SCOPE = "('AUTOMOBILE', 'BUILDING', 'HOUSEHOLD', 'MACHINERY')"
# What the stand-ins give rows beside their own values.
CATEGORY = "CASE WHEN c_custkey % 17 = 0 THEN NULL WHEN c_custkey % 17 = 1 THEN '' ELSE c_mktsegment END"
PEOPLE = f"(SELECT c_custkey, {CATEGORY} AS c_mktsegment FROM customer)"
AMOUNT = "CAST(CASE WHEN event_id % 11 = 0 THEN 0 ELSE ceil(value) END AS INTEGER)"
SCREEN = "CASE event_id % 7 WHEN 0 THEN 'Free Home' WHEN 1 THEN 'tab FREE' WHEN 2 THEN NULL ELSE 'Home' END"
TITLE = "CASE event_id % 5 WHEN 0 THEN 'Daily QUIZ' WHEN 1 THEN NULL WHEN 2 THEN 'A quiz' ELSE 'Mock' END"
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


def ratio(n: str, d: str, digits: int) -> str:
    """n / d rounded half away from zero, exactly."""
    scale = 10**digits
    size = f"((2 * {scale}::HUGEINT * abs({n}) + ({d})) // (2 * nullif(({d}), 0)))"
    return f"(CASE WHEN ({n}) < 0 THEN -{size} ELSE {size} END / {scale}::DOUBLE)"


def pct(n: str, d: str, digits: int = 2) -> str:
    return ratio(f"(100 * ({n}))", d, digits)


def attributes(d: str) -> str:
    """Weekday name, %W week label and month label."""
    return (
        f"{d} AS date, strftime({d}, '%A') AS day_of_week, strftime({d}, '%Y-W%W') AS week, "
        f"strftime({d}, '%Y-%m') AS month"
    )


def local(column: str = "ts") -> str:
    return f"CAST({column} + {IST} AS DATE)"


PURCHASES = f"""
paid AS (
  SELECT CAST(e.event_id AS VARCHAR) AS transaction_id, e.user_id, {local('e.ts')} AS ps_date, {AMOUNT} AS amount,
         c.c_mktsegment AS category
  FROM events e JOIN {PEOPLE} c ON c.c_custkey = e.user_id
  WHERE e.event_type = 'purchase' AND CAST(e.ts AS DATE) >= {FLOOR} AND {local('e.ts')} >= {FLOOR}
    AND {AMOUNT} > 0 AND c.c_mktsegment IN {IN_SCOPE}
),
pairs AS (SELECT user_id, ps_date, category, count(*) AS transactions FROM paid GROUP BY ALL)"""

ACTIVITY = f"""
lv AS (
  SELECT user_id, {local()} AS d FROM events
  WHERE event_type = 'view' AND lower({SCREEN}) NOT LIKE '%free%' AND CAST(ts AS DATE) >= {FLOOR}
  UNION ALL
  SELECT user_id, {local()} FROM events WHERE event_type = 'click' AND CAST(ts AS DATE) >= {FLOOR}
),
tests AS (
  SELECT user_id, {local()} AS d FROM events
  WHERE event_type = 'error' AND event_id % 3 <> 0 AND lower({TITLE}) NOT LIKE '%quiz%' AND CAST(ts AS DATE) >= {FLOOR}
),
anything AS (SELECT * FROM lv UNION ALL SELECT * FROM tests)"""


def seen(source: str, first: int, last: int) -> str:
    """Activity of the pair p between two days after the purchase."""
    return (
        f"EXISTS (SELECT 1 FROM {source} a WHERE a.user_id = p.user_id "
        f"AND a.d >= p.ps_date + {first} AND a.d <= p.ps_date + {last})"
    )


FACTS = f"""
facts AS (
  SELECT p.*, {seen('lv', 0, 1)} AS lv, {seen('tests', 0, 1)} AS test,
         {seen('anything', 6, 8)} AS d7, {seen('anything', 29, 31)} AS d30
  FROM pairs p
)"""

EVENT_FACTS = f"WITH {PURCHASES}, {ACTIVITY}, {FACTS}"

ORDER_PAIRS = f"""
pairs AS (SELECT DISTINCT o_custkey AS user_id, CAST(o_orderdate AS DATE) AS ps_date FROM orders
          WHERE o_totalprice > 0 AND o_orderdate >= {ORDERS_FLOOR}),
ships AS (
  SELECT o_custkey AS user_id, CAST(l_shipdate AS DATE) AS d
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate >= {ORDERS_FLOOR}
)"""


def order_facts(horizon: int) -> str:
    return f"""WITH {ORDER_PAIRS},
facts AS (
  SELECT p.*, {seen('ships', 0, horizon)} AS lv, {seen('ships', 0, 1)} AS test,
         {seen('ships', 6, 8)} AS d7, {seen('ships', 29, 31)} AS d30
  FROM pairs p
)"""


def windows(ref: str) -> str:
    """All report windows around a reference date."""
    month = f"CAST(date_trunc('month', {ref}) AS DATE)"
    monday = f"(CAST(date_trunc('week', {ref}) AS DATE) - 364)"
    year = f"CAST(date_trunc('year', {ref}) AS DATE)"

    def back(d: str, months: int) -> str:
        return f"CAST({d} - INTERVAL {months} MONTH AS DATE)"

    bounds = {
        "W": (f"{ref} - 6", ref),
        "W1": (f"{ref} - 13", f"{ref} - 7"),
        "today": (ref, ref),
        "lw_same_day": (f"{ref} - 7", f"{ref} - 7"),
        "MTD": (month, ref),
        "LM_MTD": (back(month, 1), back(ref, 1)),
        "full_LM": (back(month, 1), f"{month} - 1"),
        "LY_WTD": (monday, f"{ref} - 364"),
        "LY_MTD": (back(month, 12), back(ref, 12)),
        "LY_LW": (f"{monday} - 7", f"{monday} - 1"),
        "LY_LM": (back(month, 13), f"{back(month, 12)} - 1"),
        "LY_full": (back(year, 12), f"{year} - 1"),
    }
    rows = ", ".join(f"('{name}', {first}, {last})" for name, (first, last) in bounds.items())
    return f"windows(w, first_day, last_day) AS (VALUES {rows})"


def per_window(outcome: str, ref: str) -> str:
    """Distinct buyers and distinct activated buyers of every window."""
    return f"""{windows(ref)},
per_window AS (
  SELECT w, count(DISTINCT f.user_id) AS d, count(DISTINCT CASE WHEN f.{outcome} THEN f.user_id END) AS n
  FROM windows LEFT JOIN facts f ON f.ps_date BETWEEN first_day AND last_day
  GROUP BY w
)"""


def activation_windows(facts: str, outcome: str, label: str, ref: str) -> str:
    def n(w: str) -> str:
        return f"max(n) FILTER (WHERE w = '{w}')"

    def d(w: str) -> str:
        return f"max(d) FILTER (WHERE w = '{w}')"

    def delta(a: str, b: str) -> str:
        gap = f"({n(a)}::HUGEINT * {d(b)} - {n(b)}::HUGEINT * {d(a)})"
        return pct(gap, f"({d(a)}::HUGEINT * {d(b)})")

    columns = [f"'{label}' AS kpi"]
    for w in ("W", "W1"):
        columns += [f"{ratio(n(w), '7', 1)} AS users_{w}_daily_avg", f"{pct(n(w), d(w))} AS pct_{w}"]
    plain = ("today", "lw_same_day", "MTD", "LM_MTD", "full_LM", "LY_WTD", "LY_MTD", "LY_LW", "LY_LM", "LY_full")
    for w in plain:
        columns += [f"{n(w)} AS users_{w}", f"{pct(n(w), d(w))} AS pct_{w}"]
    columns += [f"{delta('W', 'W1')} AS wow_delta_pct_pts", f"{delta('MTD', 'LM_MTD')} AS mom_mtd_delta_pct_pts"]
    return (
        f"{facts}, {per_window(outcome, ref)}\nSELECT {', '.join(columns)} FROM per_window "
        f"HAVING (SELECT count(*) FROM facts WHERE {outcome}) > 0"
    )


def activated(outcomes: tuple[str, ...] = ("lv", "test")) -> str:
    return ", ".join(
        f"count(*) FILTER (WHERE {o}) AS {o}_activated_24hr, "
        f"{pct(f'count(*) FILTER (WHERE {o})', 'count(*)')} AS {o}_activation_pct"
        for o in outcomes
    )


DAILY = f"{EVENT_FACTS},\ndaily AS (SELECT ps_date, count(*) AS total_purchases, sum(transactions)::BIGINT AS total_transactions, {activated()} FROM facts GROUP BY ps_date)"

COHORT = "CAST(date_trunc('month', ps_date) AS DATE)"


def retained(outcome: str, unit: str) -> str:
    if unit == "pairs":
        return f"count(*) FILTER (WHERE {outcome})"
    return f"count(DISTINCT CASE WHEN {outcome} THEN user_id END)"


def retention_cohorts(facts: str, unit: str) -> str:
    buyers = "count(DISTINCT user_id)"
    return f"""{facts}
SELECT 'Retention' AS kpi, {retained('d7', unit)} AS d7_retained_users, {buyers} AS total_purchase_users,
       {pct(retained('d7', unit), buyers)} AS d7_retention_pct, {retained('d30', unit)} AS d30_retained_users,
       {pct(retained('d30', unit), buyers)} AS d30_retention_pct, {COHORT} AS purchase_cohort_month
FROM facts GROUP BY {COHORT}"""


def retention_waterfall(facts: str, unit: str = "users") -> str:
    buyers = "count(DISTINCT user_id)"
    return f"""{facts}
SELECT strftime({COHORT}, '%Y-%m') AS cohort_month, {buyers} AS total_purchased_users,
       {retained('d7', unit)} AS d7_retained_users, {pct(retained('d7', unit), buyers)} AS d7_retention_pct,
       {retained('d30', unit)} AS d30_retained_users, {pct(retained('d30', unit), buyers)} AS d30_retention_pct,
       {buyers} - {retained('d7', unit)} AS d7_not_retained, {buyers} - {retained('d30', unit)} AS d30_not_retained
FROM facts GROUP BY {COHORT}"""


SIGNUP_USERS = f"""
signup_users AS (
  SELECT s.event_id AS user_id, s.user_id AS person, s.ts AS signup_ts, CAST(s.ts AS DATE) AS signup_date,
         c.c_mktsegment AS category,
         (SELECT min(CAST(k.ts AS DATE)) FROM events k
          WHERE k.event_type = 'click' AND k.user_id = s.user_id AND k.ts >= s.ts) AS category_selected_date
  FROM events s LEFT JOIN {PEOPLE} c ON c.c_custkey = s.user_id
  WHERE s.event_type = 'signup'
)"""


def funnel(offset: str = IST, categories: tuple[str, ...] = SEGMENTS[:3]) -> str:
    """Daily funnel counts."""
    inside = ", ".join(f"'{c}'" for c in categories)
    per_category = "".join(
        f", count(DISTINCT CASE WHEN category = '{c}' THEN user_id END) AS {c.lower()}" for c in SEGMENTS
    )
    return f"""WITH {SIGNUP_USERS},
shifted AS (
  SELECT user_id, category, CAST(signup_ts + {offset} AS DATE) AS d,
         CAST(CAST(category_selected_date AS TIMESTAMP) + {offset} AS DATE) AS chosen
  FROM signup_users WHERE signup_date BETWEEN {FLOOR} AND {REF}
),
funnel AS (
  SELECT d, count(DISTINCT user_id) AS total,
         count(DISTINCT CASE WHEN chosen = d THEN user_id END) AS d0,
         count(DISTINCT CASE WHEN chosen <= d + 1 THEN user_id END) AS d1,
         count(DISTINCT CASE WHEN chosen <= d + 3 THEN user_id END) AS d3,
         count(DISTINCT CASE WHEN chosen <= d + 7 THEN user_id END) AS d7{per_category},
         count(DISTINCT CASE WHEN category NOT IN ({inside}) AND category <> '' THEN user_id END) AS others
  FROM shifted GROUP BY d
)"""


STAGES = ", ".join(
    f"d{n} AS cat_selected_d{n}, {pct(f'd{n}', 'total')} AS pct_cat_selected_d{n}" for n in (0, 1, 3, 7)
)


def signup_funnel(offset: str) -> str:
    return f"""{funnel(offset)}
SELECT 'Signup to Category Selected' AS kpi, d AS signup_date, total AS total_signups, {STAGES},
       automobile, building, household, others
FROM funnel"""


CONTENT = f"""WITH consumed AS (
  SELECT {local('e.ts')} AS d, e.user_id, e.event_type AS kind, c.c_mktsegment AS category,
         CAST(floor(e.value) AS INTEGER) AS seconds
  FROM events e JOIN {PEOPLE} c ON c.c_custkey = e.user_id
  WHERE CAST(e.ts AS DATE) >= {FLOOR} AND {local('e.ts')} >= {FLOOR} AND c.c_mktsegment IN {IN_SCOPE}
)"""

DAU = "count(DISTINCT user_id)"
SECONDS = "sum(seconds)::BIGINT"
VOLUME = f"""{DAU} AS dau, count(*) AS total_consumption_events, {ratio('count(*)', DAU, 2)} AS avg_items_per_user,
       {ratio(SECONDS, '3600', 1)} AS total_watch_hours,
       {ratio(f'({SECONDS} // nullif({DAU}, 0))', '60', 1)} AS avg_watch_min_per_user"""
BY_TYPE = ", ".join(
    f"count(DISTINCT CASE WHEN kind = '{t}' THEN user_id END) AS {t}_users, "
    f"count(CASE WHEN kind = '{t}' THEN 1 END) AS {t}_events"
    for t in EVENT_TYPES
)


def by_category(categories: tuple[str, ...], prefix: str) -> str:
    return ", ".join(
        f"count(DISTINCT CASE WHEN category = '{c}' THEN user_id END) AS {prefix}{c.lower()}_users" for c in categories
    )


JOURNEY = f"""{EVENT_FACTS}, {SIGNUP_USERS},
first_signup AS (SELECT user_id, min(ts) AS ts FROM events WHERE event_type = 'signup' GROUP BY user_id),
s1 AS (
  SELECT user_id, ts FROM first_signup JOIN {PEOPLE} ON c_custkey = user_id
  WHERE c_mktsegment IN {IN_SCOPE} AND CAST(ts AS DATE) >= {FLOOR}
),
s2 AS (
  SELECT user_id FROM s1 f
  WHERE EXISTS (SELECT 1 FROM events k WHERE k.event_type = 'click' AND k.user_id = f.user_id AND k.ts >= f.ts)
),
s3 AS (SELECT user_id FROM s2 WHERE user_id IN (SELECT user_id FROM facts)),
s4 AS (SELECT user_id FROM s3 WHERE user_id IN (SELECT user_id FROM facts WHERE lv)),
counted(step, stage, users) AS (
  SELECT 1, 'Signup', (SELECT count(*) FROM s1)
  UNION ALL SELECT 2, 'Category selected', (SELECT count(*) FROM s2)
  UNION ALL SELECT 3, 'Purchase', (SELECT count(*) FROM s3)
  UNION ALL SELECT 4, 'Activated 24hr', (SELECT count(*) FROM s4)
)
SELECT step, stage, users, lag(users) OVER (ORDER BY step) - users AS drop_off FROM counted"""


def activation_parts() -> list[str]:
    parts = []
    names = {
        "W": ("W (7-day avg)", "Purchasers W", 7),
        "W1": ("W-1 (7-day avg)", "Purchasers W-1", 7),
        "today": ("Today", "Purchasers Today", 1),
        "MTD": ("MTD", "Purchasers MTD", 1),
        "full_LM": ("Full LM", "Purchasers Full LM", 1),
    }
    for outcome, kpi in (("lv", "Live+Video Activation (24hr)"), ("test", "Test Activation (24hr)")):
        for w, (name, label, days) in names.items():
            bounds = f"(SELECT first_day FROM windows WHERE w = '{w}') AND (SELECT last_day FROM windows WHERE w = '{w}')"
            n = f"count(DISTINCT CASE WHEN {outcome} THEN user_id END)"
            parts.append(
                f"SELECT '{kpi}' AS kpi, '{name}' AS window_name, CAST({ratio(n, str(days), 0)} AS BIGINT) AS users, "
                f"{pct(n, 'count(DISTINCT user_id)', 1)} AS pct, '{label}' AS denom_label "
                f"FROM facts WHERE ps_date BETWEEN {bounds}"
            )
    return parts


def retention_parts(last_days: dict[str, int], ref: str | None = None) -> list[str]:
    """Cohorts by month; with ``ref`` only those whose last buyer's last day is not after it."""
    return [
        f"SELECT '{outcome.upper()} Retention', strftime({COHORT}, '%b %Y') || ' cohort', "
        f"count(*) FILTER (WHERE {outcome}), "
        f"{pct(f'count(*) FILTER (WHERE {outcome})', 'count(DISTINCT user_id)', 1)}, "
        f"strftime({COHORT}, '%b') || ' Purchasers' FROM facts GROUP BY {COHORT}"
        + (f" HAVING last_day({COHORT}) + {last} <= {ref}" if ref else "")
        for outcome, last in last_days.items()
    ]


def cohort_summary(ref: str) -> str:
    """The parts of the summary on buyers, for the long profile."""
    parts = activation_parts() + retention_parts({"d7": 8, "d30": 31}, ref)
    return (
        f"{order_facts(7)}, {windows(ref)}, parts AS ({' UNION ALL '.join(parts)}) "
        'SELECT kpi, window_name AS "window", users, pct, denom_label FROM parts'
    )


def summary() -> str:
    parts = activation_parts() + retention_parts({"d7": 8, "d30": 31})
    days = {"Yesterday": (REF, 1), "W": (f"{REF} - 6", 7), "MTD": ("DATE '2024-01-01'", 28)}
    for w, (first, length) in days.items():
        name = "W avg" if w == "W" else w
        d1 = "count(DISTINCT CASE WHEN chosen <= d + 1 THEN user_id END)"
        parts.append(
            f"SELECT 'Signup to Category (D1)', '{name}', "
            f"CAST({ratio(d1, str(7 if w == 'W' else 1), 0)} AS BIGINT), "
            f"{pct(d1, 'count(DISTINCT user_id)', 1)}, 'Signups {w}' FROM shifted WHERE d BETWEEN {first} AND {REF}"
        )
    for w, (first, length) in days.items():
        avg = "" if w == "Yesterday" else " avg"
        parts.append(
            f"SELECT 'Content Consumed / DAU', '{w}{avg}', "
            f"CAST({ratio('count(DISTINCT (d, user_id))', str(length), 0)} AS BIGINT), NULL, 'DAU {w}{avg}' "
            f"FROM consumed WHERE d BETWEEN {first} AND {REF}"
        )
    ctes = (
        f"{EVENT_FACTS}, {windows(REF)}, {funnel()[len('WITH '):]}, {CONTENT[len('WITH '):]}, "
        f"parts AS ({' UNION ALL '.join(parts)})"
    )
    return f'{ctes} SELECT kpi, window_name AS "window", users, pct, denom_label FROM parts'


# Queries that promise an order, and the columns that it is by.
ORDERED = {
    "retention_cohorts_long_ordered": ["purchase_cohort_month"],
    "signup_funnel_ordered": ["signup_date"],
    "content_daily_ordered": ["activity_date"],
}


def oracle_sql() -> dict[str, str]:
    sql = reports_sql()
    again = {
        "purchase_outcomes_pruned": sql["purchase_outcomes"],
        "purchase_outcomes_stored": f"SELECT * EXCLUDE (category) FROM ({sql['purchase_outcomes']})",
        "purchase_outcomes_long": f"""WITH {ORDER_PAIRS}
SELECT user_id, ps_date AS purchase_date, {seen('ships', 0, 90)} AS lv, {seen('ships', 29, 31)} AS d30,
       {seen('ships', 88, 90)} AS d89
FROM pairs p""",
    }
    again |= {f"activation_from_{fmt}": sql["activation_daily"] for fmt in ("parquet", "orc", "csv", "json")}
    again |= {name: f"{sql[name.removesuffix('_ordered')]} ORDER BY {', '.join(by)}" for name, by in ORDERED.items()}
    return sql | again


def reports_sql() -> dict[str, str]:
    long_facts = order_facts(7)
    live_video = activation_windows(EVENT_FACTS, "lv", "Live + Video Activation (24hr)", REF)
    tests = activation_windows(EVENT_FACTS, "test", "Test Activation (24hr)", REF)
    return {
        "activation_daily": f"{DAILY} SELECT {attributes('ps_date')}, * EXCLUDE (ps_date) FROM daily",
        "activation_windows_lv": live_video,
        "activation_windows_test": tests,
        "activation_windows": f"SELECT * FROM ({live_video}) UNION ALL SELECT * FROM ({tests})",
        "activation_windows_long": activation_windows(
            long_facts, "lv", "Live + Video Activation (24hr)", "DATE '2000-06-15'"
        ),
        "activation_windows_quarter": activation_windows(
            order_facts(90), "lv", "Live + Video Activation (24hr)", "DATE '2000-06-15'"
        ),
        "activation_windows_clamped": activation_windows(
            long_facts, "lv", "Live + Video Activation (24hr)", "DATE '2000-03-31'"
        ),
        "activation_windows_nobody": tests.replace("event_id % 3 <> 0", "event_id % 3 > 2"),
        "activation_by_category": f"{EVENT_FACTS} SELECT category, count(*) AS total_purchases, {activated()} "
        "FROM facts GROUP BY category",
        "purchase_outcomes": f"{EVENT_FACTS} SELECT user_id, ps_date AS purchase_date, category, transactions, "
        "lv, test, d7, d30 FROM facts",
        "activity_days": f"""WITH {ACTIVITY[:ACTIVITY.index('anything AS')].rstrip().rstrip(',')},
live AS (SELECT user_id, {local()} AS d FROM events
         WHERE event_type = 'view' AND lower({SCREEN}) NOT LIKE '%free%' AND CAST(ts AS DATE) >= {FLOOR}),
video AS (SELECT user_id, {local()} AS d FROM events WHERE event_type = 'click' AND CAST(ts AS DATE) >= {FLOOR})
SELECT DISTINCT user_id, d AS activity_date, (user_id, d) IN (SELECT (user_id, d) FROM live) AS live,
       (user_id, d) IN (SELECT (user_id, d) FROM video) AS video,
       (user_id, d) IN (SELECT (user_id, d) FROM tests) AS test
FROM (SELECT * FROM lv UNION ALL SELECT * FROM tests)""",
        "retention_cohorts": retention_cohorts(EVENT_FACTS, "pairs"),
        "retention_cohorts_users": retention_cohorts(EVENT_FACTS, "users"),
        "retention_cohorts_long": retention_cohorts(long_facts, "pairs"),
        "retention_waterfall": retention_waterfall(EVENT_FACTS),
        "retention_waterfall_long": retention_waterfall(long_facts),
        "signup_funnel": signup_funnel(IST),
        "signup_funnel_local": signup_funnel("INTERVAL 0 MINUTE"),
        "signup_funnel_wide": f"{funnel()} SELECT {attributes('d')}, total AS total_signups, {STAGES}, "
        + ", ".join(f"{c.lower()} AS cat_{c.lower()}" for c in SEGMENTS)
        + " FROM funnel",
        "signup_funnel_long": f"{funnel()} "
        + " UNION ALL ".join(
            f"SELECT d AS date, 'D{n}' AS stage, d{n} AS users, {pct(f'd{n}', 'total')} AS pct FROM funnel"
            for n in (0, 1, 3, 7)
        ),
        "signup_weekday": f"""{funnel()}
SELECT strftime(d, '%A') AS day_of_week, isodow(d) >= 6 AS is_weekend, sum(total)::BIGINT AS total_signups,
       sum(d0)::BIGINT AS cat_selected_d0, {pct('sum(d0)::BIGINT', 'sum(total)::BIGINT')} AS pct_cat_selected_d0
FROM funnel GROUP BY 1, 2""",
        "content_daily": f"{CONTENT} SELECT 'Content Consumed Per Day' AS kpi, d AS activity_date, {VOLUME}, {BY_TYPE}, "
        f"{by_category(SEGMENTS[:3], '')} FROM consumed GROUP BY d",
        "content_daily_wide": f"{CONTENT} SELECT {attributes('d')}, {VOLUME}, {BY_TYPE}, "
        f"{by_category(SEGMENTS, 'cat_')} FROM consumed GROUP BY d",
        "content_by_type": f"""{CONTENT}
SELECT t.d AS date, t.kind AS content_type, count(DISTINCT c.user_id) AS users, count(c.d) AS events
FROM (SELECT DISTINCT a.d, b.kind FROM consumed a CROSS JOIN (SELECT unnest({list(EVENT_TYPES)}) AS kind) b) t
LEFT JOIN consumed c ON c.d = t.d AND c.kind = t.kind GROUP BY ALL""",
        "content_dau": f"{CONTENT} SELECT d AS activity_date, {DAU} AS dau FROM consumed GROUP BY d",
        "content_dau_west": f"""SELECT CAST(ts - INTERVAL 300 MINUTE AS DATE) AS activity_date, {DAU} AS dau
FROM events JOIN {PEOPLE} ON c_custkey = user_id
WHERE CAST(ts - INTERVAL 300 MINUTE AS DATE) >= {FLOOR} AND c_mktsegment IN {IN_SCOPE} GROUP BY 1""",
        "date_dim_orders": f"""SELECT {attributes('d')}, year(d)::INTEGER AS year, isodow(d) >= 6 AS is_weekend
FROM (SELECT CAST(unnest(generate_series(min(o_orderdate)::DATE, max(o_orderdate)::DATE, INTERVAL 1 DAY)) AS DATE) AS d
      FROM orders)""",
        "date_dim": f"""SELECT {attributes('d')}, year(d)::INTEGER AS year, isodow(d) >= 6 AS is_weekend
FROM (SELECT CAST(unnest(generate_series(min({local()}), max({local()}), INTERVAL 1 DAY)) AS DATE) AS d FROM events)""",
        "activation_on_calendar": f"""{DAILY}
SELECT {attributes('x.d')}, year(x.d)::INTEGER AS year, isodow(x.d) >= 6 AS is_weekend, daily.* EXCLUDE (ps_date)
FROM (SELECT CAST(unnest(generate_series(min({local()}), max({local()}), INTERVAL 1 DAY)) AS DATE) AS d FROM events) x
LEFT JOIN daily ON daily.ps_date = x.d""",
        "kpi_summary": summary(),
        "kpi_summary_cohorts": cohort_summary("DATE '2000-06-15'"),
        "revenue_daily": f"""WITH {PURCHASES},
members AS (SELECT count(DISTINCT c_custkey) AS everyone FROM {PEOPLE} WHERE c_mktsegment IN {IN_SCOPE}),
daily AS (
  SELECT ps_date, count(DISTINCT user_id) AS buyers, count(*) AS orders,
         (sum(CAST(amount AS DECIMAL(18, 2))) * 100)::BIGINT AS hundredths
  FROM paid GROUP BY ps_date
)
SELECT ps_date AS date, buyers, orders, hundredths / 100::DOUBLE AS revenue,
       {ratio('hundredths', '(100 * orders)', 2)} AS avg_order_value, {pct('buyers', 'everyone')} AS conversion_pct
FROM daily CROSS JOIN members""",
        "journey_funnel": JOURNEY,
        "purchases_with_users": f"""SELECT CAST(event_id AS VARCHAR) AS transaction_id, user_id, CAST(ts AS DATE) AS day,
       {AMOUNT} AS amount, c_mktsegment AS category
FROM events LEFT JOIN {PEOPLE} ON c_custkey = user_id WHERE event_type = 'purchase'""",
        "purchases_with_daily": f"""{DAILY}
SELECT CAST(e.event_id AS VARCHAR) AS transaction_id, e.user_id, {AMOUNT} AS amount, {local('e.ts')} AS purchase_date,
       daily.total_purchases, daily.lv_activation_pct, daily.test_activation_pct
FROM events e LEFT JOIN daily ON daily.ps_date = {local('e.ts')} WHERE e.event_type = 'purchase'""",
        "users_with_funnel": f"""{funnel()}
SELECT u.user_id, u.signup_date, u.category, f.total AS total_signups, f.d1 AS cat_selected_d1,
       {pct('f.d1', 'f.total')} AS pct_cat_selected_d1
FROM signup_users u LEFT JOIN funnel f ON f.d = u.signup_date""",
    }
