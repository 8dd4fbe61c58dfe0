"""Independent DuckDB SQL for every registered query (the correctness oracle).

The test-data mapping of ``testdata.py`` and the silver/gold rules are
restated here as SQL over the raw tables (views ``orders``, ``customer``,
``nation``, ``region``, ``lineitem``, ``events``).  Helper functions emit
SQL expression text; CTEs are composed per query.
"""

from __future__ import annotations

# Expected values, restated here so that a wrong constant in the code under
# test shows as a difference.
CURRENCIES = ["EUR", "USD", "GBP", "JPY", "TRY", "AED", "CNY"]
TARGET_CURRENCIES = ["USD", "GBP", "JPY", "TRY", "AED", "CNY"]
NUMBER_WORDS = {"One": "1", "Two": "2", "Three": "3", "Four": "4", "Five": "5", "Ten": "10"}
GARBAGE_TOKENS = ["?", "???", "-", "--", "___", "null", "NULL", "Null", "NaN", " "]
JUNK_EDGE_PATTERN = r"^[!@#\$%^&*()_+\-=]+|[!@#\$%^&*()_+\-=]+$"
CANCELLED_LABELS = ["Canceled", "Cancelled"]
COUNTRY_EXCLUDE_TYPES = ["Budget Hotel", "--", "___", "???", "Unknown", "City Hotel...", "!!Business Hotel", "Giza"]
COUNTRY_EXCLUDE_COUNTRIES = ["Unknown"]
TYPE_EXCLUDE = ["--", "___", "???", "!!Business Hotel", "Budget Hotel...", "!!City Hotel", "City Hotel...",
                "!!Boutique", "!!Budget Hotel", "Luxury Hotel...", "Business Hotel...", "Resort...", "!!Resort",
                "!!Luxury Hotel", "Boutique...", "Unknown", "Giza"]
CITY_EXCLUDE = ["Unknown", "Tel Aviv"]
REQUIRED_RATES = ["USD", "GBP", "TRY"]
SUMMED = ["booking_year", "booking_month", "star_rating", "nights", "adults", "children", "total_amount",
          "room_price", "exchange_rate_to_eur", "total_amount_eur", "avg_nightly_rate", "avg_nightly_rate_eur"]

# Quality rules: (kind, column, argument).
SILVER_RULES = [
    ("not_null", "booking_id", None), ("not_null", "customer_id", None), ("not_null", "hotel_id", None),
    ("not_null", "booking_date", None), ("unique", "booking_id", None), ("at_least_zero", "total_amount", None),
    ("at_least_zero", "room_price", None), ("of_type", "booking_id", "StringType"),
    ("of_type", "total_amount", "DoubleType"), ("of_type", "customer_id", "StringType"),
    ("in_set", "currency", CURRENCIES)]
GOLD_RULES = {
    "fact_bookings": ("x_fact", [
        ("not_null", "booking_id", None), ("unique", "booking_id", None), ("not_null", "hotel_id", None),
        ("not_null", "booking_date", None), ("not_null", "total_amount", None),
        ("not_null", "total_amount_eur", None), ("in_set", "currency", CURRENCIES)]),
    "dim_city": ("x_dim_city", [("not_null", "city_key", None), ("unique", "city_key", None),
                                ("not_null", "city", None), ("unique", "city", None)]),
    "dim_hotel": ("x_dim_hotel", [("not_null", "hotel_id", None), ("unique", "hotel_id", None),
                                  ("in_set", "hotel_tier", ["Premium", "Standard", "Budget"])]),
    "dim_date": ("x_dim_date", [("not_null", "date_key", None), ("unique", "date_key", None),
                                ("not_null", "year", None)]),
    "kpi_revenue": ("x_kpi", [("not_null", "city", None), ("not_null", "total_bookings", None),
                              ("not_null", "total_revenue_eur", None)])}

# ---- expression helpers ------------------------------------------------------------------


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def qlist(values) -> str:
    return ", ".join(q(v) for v in values)


def initcap(e: str) -> str:
    """Spark initcap: lower-case, then upper-case the first letter of each
    space-separated word."""
    return (f"array_to_string(list_transform(string_split(lower({e}), ' '), "
            f"lambda w: upper(left(w, 1)) || substr(w, 2)), ' ')")


def sround(e: str, d: int) -> str:
    """Spark's round of a double rounds its decimal form HALF_UP."""
    return f"CAST(round(CAST(CAST(CAST({e} AS DOUBLE) AS VARCHAR) AS DECIMAL(38,20)), {d}) AS DOUBLE)"


def dsum(e: str, scale: int, rounded: int | None = None) -> str:
    """Exact sum of the decimal forms of doubles, as a double."""
    total = f"sum(CAST(CAST(CAST({e} AS DOUBLE) AS VARCHAR) AS DECIMAL(38,{scale})))"
    return f"CAST({total if rounded is None else f'round({total}, {rounded})'} AS DOUBLE)"


def _decimal_quotient(num_units: str, vscale: int, den: str, scale: int) -> str:
    """num / den as Spark's decimal division does it: exact quotient rounded
    HALF_UP to 6 decimals, then HALF_UP to ``scale`` decimals.  ``num_units``
    is the numerator in units of 10^-vscale (non-negative integers)."""
    r6 = f"((2 * ({num_units}) * {10 ** (6 - vscale)} + ({den})) // (2 * ({den})))"
    step = 10 ** (6 - scale)
    return f"(CAST((2 * {r6} + {step}) // {2 * step} AS DOUBLE) / {10 ** scale})"


def avg_money(e: str) -> str:
    """Average of cent amounts as Spark's decimal average computes it."""
    return _decimal_quotient(f"sum(CAST(round({e} * 100) AS HUGEINT))", 2, f"count({e})", 2)


def to_double(e: str) -> str:
    return f"TRY_CAST({e} AS DOUBLE)"


def to_int(e: str) -> str:
    return f"TRY_CAST(trunc(TRY_CAST({e} AS DOUBLE)) AS INTEGER)"


def words(e: str) -> str:
    cases = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in NUMBER_WORDS.items())
    return f"COALESCE(CASE {e} {cases} END, {e})"


def garbage(v: str) -> str:
    return f"CASE WHEN {v} IN ({qlist(GARBAGE_TOKENS)}) OR {v} = '' THEN 'Unknown' ELSE {v} END"


def clean_string(e: str, upper: bool = False) -> str:
    v = f"regexp_replace(trim({e}), {q(JUNK_EDGE_PATTERN)}, '', 'g')"
    g = garbage(v)
    return f"upper({g})" if upper else initcap(g)


def clean_phone(e: str) -> str:
    v = f"regexp_replace(trim({e}), '[^0-9+]', '', 'g')"
    p = f"CASE WHEN length({v}) < 5 OR contains({v}, '0000000') THEN 'Unknown' ELSE {v} END"
    return initcap(garbage(p))


def blank_unknown(e: str) -> str:
    return f"CASE WHEN {e} IS NULL OR trim({e}) = '' THEN 'Unknown' ELSE trim({e}) END"


def coord(e: str, limit: int) -> str:
    return f"CASE WHEN {e} < -{limit} OR {e} > {limit} OR {e} = 0 THEN NULL ELSE {e} END"


def city_clean(e: str) -> str:
    return initcap(f"trim(regexp_replace({e}, '[.\\s]+$', '', 'g'))")


def sentinel(ts: str) -> str:
    return f"COALESCE({ts}, TIMESTAMP '1900-01-01 00:00:00')"


def digits(e: str) -> str:
    return f"regexp_replace({e}, '[^0-9]', '', 'g')"


def pick(values, idx: str) -> str:
    return f"[{qlist(values)}][{idx} + 1]"


def tier(e: str) -> str:
    return (f"CASE WHEN {e} >= 4 THEN 'Premium' WHEN {e} >= 3 "
            f"THEN 'Standard' ELSE 'Budget' END")


# ---- CTE library (name -> (dependencies, body)) -------------------------------------------

SEG = ("CASE c_mktsegment WHEN 'BUILDING' THEN 'Business Hotel' WHEN 'AUTOMOBILE' THEN 'City Hotel' "
       "WHEN 'FURNITURE' THEN 'Boutique' WHEN 'HOUSEHOLD' THEN 'Resort' ELSE 'Luxury Hotel' END")
CB = "replace(lower(n_name), '_', ' ')"
EK = "TRY_CAST(json_extract_string(props, '$.k') AS INTEGER)"

CTES: dict[str, tuple[tuple, str]] = {}


def cte(name, deps, body):
    CTES[name] = (tuple(deps), body)


cte("x_li", (), "SELECT l_orderkey, count(*) AS n_lines FROM lineitem GROUP BY l_orderkey")
cte("x_loc", (), "SELECT n_nationkey, n_name, n_regionkey, r_name FROM nation LEFT JOIN region "
                 "ON n_regionkey = r_regionkey")
cte("x_batch", ("x_li", "x_loc"), f"""
SELECT CAST(o_orderkey AS VARCHAR) AS booking_id,
  'HTL-' || CAST(o_custkey AS VARCHAR) AS hotel_id,
  CAST(1000 + (o_orderkey * 7919) % 9000 AS VARCHAR) AS customer_id,
  c_name AS hotel_name,
  CASE WHEN o_orderkey % 19 = 0 THEN '--' WHEN o_orderkey % 23 = 0 THEN '!!' || {SEG}
       WHEN o_orderkey % 29 = 0 THEN {SEG} || '...' ELSE {SEG} END AS hotel_type,
  CASE WHEN o_orderkey % 31 = 0 THEN NULL WHEN o_orderkey % 5 = 0 THEN {CB} || '. .'
       WHEN o_orderkey % 5 = 1 THEN upper({CB}) || '   ' WHEN o_orderkey % 5 = 2 THEN {CB} || '....'
       WHEN o_orderkey % 5 = 3 THEN '  ' || {CB} ELSE {CB} END AS city,
  CASE WHEN o_orderkey % 37 = 0 THEN NULL ELSE r_name END AS country,
  CASE WHEN o_orderkey % 41 = 0 THEN 'Four' WHEN o_orderkey % 43 = 0 THEN 'four'
       ELSE CAST(CAST(floor((c_acctbal + 1000) / 2200) AS INTEGER) AS VARCHAR) END AS star_rating,
  CASE WHEN o_orderkey % 47 = 0 THEN 95.0 ELSE CAST(n_nationkey * 3.5 - 42 AS DOUBLE) END AS latitude,
  CAST(n_regionkey * 30 - 60 + n_nationkey AS DOUBLE) AS longitude,
  CASE WHEN o_orderkey % 53 = 0 THEN '???' WHEN o_orderpriority = '1-URGENT' THEN 'Suite'
       WHEN o_orderpriority = '2-HIGH' THEN 'Deluxe' WHEN o_orderpriority = '3-MEDIUM' THEN 'Double'
       ELSE 'Single' END AS room_type,
  CAST(n_lines AS VARCHAR) AS nights,
  CASE WHEN o_orderkey % 17 = 0 THEN 'Two' WHEN o_orderkey % 59 = 0 THEN '-3'
       ELSE CAST(1 + o_orderkey % 4 AS VARCHAR) END AS adults,
  CAST(o_orderkey % 3 AS VARCHAR) AS children,
  CASE o_orderstatus WHEN 'F' THEN 'Confirmed' WHEN 'O' THEN 'Pending' ELSE 'Canceled' END AS booking_status,
  {pick(['Web', 'MobileApp', 'Agency'], 'o_orderkey % 3')} AS source_system,
  o_orderpriority AS booking_channel,
  CASE WHEN o_orderkey % 11 = 0 THEN lower({pick(CURRENCIES, 'o_orderkey % 7')}) || ' '
       ELSE {pick(CURRENCIES, 'o_orderkey % 7')} END AS currency,
  CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_totalprice END AS total_price,
  CASE WHEN o_orderkey % 3 = 0 AND n_lines > 0 THEN o_totalprice / n_lines END AS room_price,
  CASE WHEN o_orderkey % 61 = 0 THEN NULL ELSE CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) END AS booking_ts,
  CASE WHEN o_orderkey % 67 = 0 THEN NULL
       ELSE CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 30 AS INTEGER) AS TIMESTAMP) END AS checkin_ts,
  CASE WHEN o_orderkey % 71 = 0 THEN '12-3' WHEN o_orderkey % 73 = 0 THEN '00000000'
       ELSE '+1 (555) ' || lpad(CAST(o_custkey % 10000 AS VARCHAR), 4, '0') END AS phone,
  TIMESTAMP '2024-01-15 00:00:00' AS ingestion_ts,
  'hotel_raw_batch.csv' AS source_file
FROM orders LEFT JOIN customer ON o_custkey = c_custkey
LEFT JOIN x_loc ON c_nationkey = n_nationkey
LEFT JOIN x_li ON o_orderkey = l_orderkey""")

cte("x_ev", (), f"SELECT *, {EK} AS k FROM events")
cte("x_stream", ("x_ev",), f"""
SELECT CAST(event_id AS VARCHAR) AS booking_id,
  CAST(user_id + 1000 AS VARCHAR) AS customer_id,
  CAST(user_id AS VARCHAR) AS hotel_id,
  CAST(ts AS TIMESTAMP) AS booking_ts,
  CASE event_type WHEN 'click' THEN 'Single' WHEN 'view' THEN 'Double' WHEN 'signup' THEN 'Suite'
       WHEN 'purchase' THEN 'Deluxe' ELSE '--' END AS room_type,
  CAST(1 + k % 14 AS VARCHAR) AS nights,
  CAST(1 + event_id % 4 AS VARCHAR) AS adults,
  value * 10 AS total_amount,
  {pick(CURRENCIES, 'event_id % 7')} AS currency,
  CASE event_type WHEN 'purchase' THEN 'Confirmed' WHEN 'error' THEN 'Cancelled' ELSE 'Pending' END
    AS booking_status,
  {pick(['MobileApp', 'Web', 'Agency'], 'k % 3')} AS source_system,
  CAST(ts AS TIMESTAMP) AS ingestion_ts,
  CAST(ts AS TIMESTAMP) AS event_ts
FROM x_ev""")

cte("x_wread", ("x_ev", "x_loc"), f"""
SELECT {CB} AS city, r_name AS country_api, CAST(n_nationkey * 3.5 - 42 AS DOUBLE) AS latitude,
  CAST(n_regionkey * 30 - 60 + n_nationkey AS DOUBLE) AS longitude,
  value / 10 - 10 AS temperature_c, event_id % 100 AS humidity, CAST(k AS BIGINT) AS weather_code,
  CAST(ts AS TIMESTAMP) AS recorded_at, event_id, n_nationkey
FROM x_ev JOIN x_loc ON user_id % 25 = n_nationkey""")
cte("x_rquote", ("x_ev",), f"""
SELECT 'EUR' AS base_currency, {pick(TARGET_CURRENCIES, 'event_id % 6')} AS target_currency,
  1 + value / 100 AS rate, CAST(ts AS TIMESTAMP) AS ts, event_id
FROM x_ev""")
cte("x_wlk", ("x_wread",), f"""
SELECT w_city, temperature_c, weather_code FROM (
  SELECT {initcap('trim(city)')} AS w_city, temperature_c, weather_code,
    row_number() OVER (PARTITION BY {initcap('trim(city)')} ORDER BY recorded_at DESC NULLS LAST,
      temperature_c ASC NULLS LAST, weather_code ASC NULLS LAST) AS rn
  FROM x_wread) WHERE rn = 1""")
cte("x_rlk", ("x_rquote",), """
SELECT r_currency, rate FROM (
  SELECT upper(trim(target_currency)) AS r_currency, rate,
    row_number() OVER (PARTITION BY upper(trim(target_currency)) ORDER BY ts DESC NULLS LAST,
      rate ASC NULLS LAST) AS rn
  FROM x_rquote) WHERE rn = 1""")

META_STR = ["hotel_name", "city", "country", "star_rating", "hotel_type"]
META_NUM = ["latitude", "longitude"]

cte("x_union", ("x_batch", "x_stream"), "SELECT * FROM x_batch UNION ALL BY NAME SELECT * FROM x_stream")
cte("x_hdim", ("x_batch",), f"""
SELECT dim_id, {', '.join(f'{c} AS dim_{c}' for c in META_STR + META_NUM)} FROM (
  SELECT {digits('hotel_id')} AS dim_id, *,
    row_number() OVER (PARTITION BY {digits('hotel_id')} ORDER BY booking_id) AS rn
  FROM x_batch) WHERE rn = 1 AND dim_id IS NOT NULL AND dim_id <> ''""")
_fill = ", ".join(
    [f"CASE WHEN u.{c} IS NULL OR trim(u.{c}) = '' OR u.{c} = 'Unknown' THEN d.dim_{c} ELSE u.{c} END AS {c}"
     for c in META_STR] +
    [f"CASE WHEN u.{c} IS NULL THEN d.dim_{c} ELSE u.{c} END AS {c}" for c in META_NUM])
cte("x_filled", ("x_union", "x_hdim"), f"""
SELECT u.* EXCLUDE ({', '.join(META_STR + META_NUM)}), {_fill}
FROM x_union u LEFT JOIN x_hdim d ON {digits('u.hotel_id')} = d.dim_id""")
cte("x_dedup", ("x_filled",), """
SELECT * EXCLUDE (rn, total_price, total_amount), COALESCE(total_amount, total_price) AS total_amount FROM (
  SELECT *, row_number() OVER (PARTITION BY booking_id ORDER BY ingestion_ts DESC NULLS LAST,
    source_file ASC NULLS LAST) AS rn FROM x_filled) WHERE rn = 1""")
cte("x_enriched", ("x_dedup", "x_wlk", "x_rlk"), f"""
SELECT t.* EXCLUDE (total_amount, room_price, nights),
  abs(t.total_amount) AS total_amount, abs(t.room_price) AS room_price, {to_int('t.nights')} AS nights,
  {city_clean('t.city')} AS city_clean, w.temperature_c, w.weather_code,
  CASE WHEN upper(trim(t.currency)) = 'EUR' THEN 1.0 ELSE r.rate END AS exchange_rate_to_eur
FROM x_dedup t
LEFT JOIN x_wlk w ON {city_clean('t.city')} = w.w_city
LEFT JOIN x_rlk r ON upper(trim(t.currency)) = r.r_currency
WHERE t.booking_ts IS NOT NULL""")
cte("x_imputed", ("x_enriched",), f"""
SELECT * EXCLUDE (room_price, total_amount, room_price1),
  room_price1 AS room_price,
  CASE WHEN total_amount IS NULL AND room_price1 IS NOT NULL THEN {sround('room_price1 * nights', 2)}
       ELSE total_amount END AS total_amount
FROM (SELECT *, CASE WHEN room_price IS NULL AND total_amount IS NOT NULL AND nights > 0
         THEN {sround('total_amount / nights', 2)} ELSE room_price END AS room_price1 FROM x_enriched)""")


def _dt(name: str, ts: str) -> str:
    s = sentinel(ts)
    return f"CAST({s} AS DATE) AS {name}, strftime({s}, '%H:%M:%S') AS {name}_time"


cte("x_silver_full", ("x_imputed",), f"""
SELECT booking_id, hotel_id, customer_id,
  {blank_unknown('hotel_name')} AS hotel_name, {blank_unknown('hotel_type')} AS hotel_type,
  {clean_string('city')} AS city, {clean_string('country')} AS country,
  COALESCE(abs({to_int(words('star_rating'))}), 0) AS star_rating,
  {coord('latitude', 90)} AS latitude, {coord('longitude', 180)} AS longitude,
  {clean_string('room_type')} AS room_type,
  COALESCE(abs(CAST(nights AS DOUBLE)), 0.0) AS nights,
  COALESCE(abs({to_int(words('adults'))}), 0) AS adults,
  COALESCE(abs({to_double(words('children'))}), 0.0) AS children,
  {clean_string('booking_status')} AS booking_status, {clean_string('source_system')} AS source_system,
  {clean_string('booking_channel')} AS booking_channel, {clean_string('currency', upper=True)} AS currency,
  COALESCE(abs(room_price), 0.0) AS room_price,
  {_dt('booking_date', 'booking_ts')}, {_dt('checkin_date', 'checkin_ts')},
  {clean_phone('phone')} AS phone,
  {_dt('ingestion_time', 'ingestion_ts')},
  {clean_string('source_file')} AS source_file,
  {_dt('event_time', 'event_ts')},
  COALESCE(abs(total_amount), 0.0) AS total_amount,
  {clean_string('city_clean')} AS city_clean,
  temperature_c, weather_code, abs(exchange_rate_to_eur) AS exchange_rate_to_eur
FROM x_imputed""")
cte("x_silver", ("x_silver_full",), "SELECT * EXCLUDE (checkin_date_time) FROM x_silver_full")

RATE_CUR = TARGET_CURRENCIES
cte("x_cities", ("x_silver",), f"""
SELECT DISTINCT * FROM (
  SELECT {initcap("trim(regexp_replace(city_clean, '\\.+$', '', 'g'))")} AS city,
         {initcap('trim(country)')} AS country FROM x_silver)
WHERE city IS NOT NULL AND city <> 'Unknown' AND city <> ''""")
_rates = ", ".join(f"(SELECT max(rate) FROM x_rlk WHERE r_currency = {q(c)}) AS rate_{c.lower()}" for c in RATE_CUR)
cte("x_city_dim", ("x_cities", "x_wlk", "x_rlk"), f"""
SELECT c.city, c.country, w.temperature_c, w.weather_code, 1.0 AS rate_eur, {_rates}
FROM x_cities c LEFT JOIN x_wlk w ON c.city = w.w_city""")

FACT_COLS = f"""booking_id, hotel_id, customer_id, booking_date,
  CAST(year(booking_date) AS INTEGER) AS booking_year, CAST(month(booking_date) AS INTEGER) AS booking_month,
  city_clean AS city, country, hotel_name, hotel_type, star_rating, room_type, nights, adults, children,
  booking_status, source_system, booking_channel, currency, total_amount, room_price,
  COALESCE(exchange_rate_to_eur, 1.0) AS exchange_rate_to_eur,
  {sround('total_amount * COALESCE(exchange_rate_to_eur, 1.0)', 2)} AS total_amount_eur,
  CASE WHEN nights > 0 THEN {sround('total_amount / nights', 2)} ELSE total_amount END AS avg_nightly_rate,
  CASE WHEN nights > 0 THEN {sround('total_amount * COALESCE(exchange_rate_to_eur, 1.0) / nights', 2)}
       ELSE {sround('total_amount * COALESCE(exchange_rate_to_eur, 1.0)', 2)} END AS avg_nightly_rate_eur,
  temperature_c, weather_code"""
cte("x_fact", ("x_silver",), f"""
SELECT {FACT_COLS} FROM x_silver
WHERE booking_date > DATE '1950-01-01' AND hotel_id IS NOT NULL AND booking_id IS NOT NULL""")

RATE_COLS_ALL = [f"rate_{c.lower()}" for c in CURRENCIES]
cte("x_dim_city", ("x_city_dim",), f"""
SELECT CAST(row_number() OVER (ORDER BY city) AS INTEGER) AS city_key, city, country, temperature_c, weather_code,
  {', '.join(f'COALESCE({r}, 0.0) AS {r}' for r in RATE_COLS_ALL)}
FROM (SELECT *, row_number() OVER (PARTITION BY city ORDER BY country ASC NULLS LAST,
        temperature_c ASC NULLS LAST, weather_code ASC NULLS LAST) AS rn
      FROM x_city_dim WHERE city IS NOT NULL AND city <> 'Unknown' AND city <> '') WHERE rn = 1""")
cte("x_dim_hotel", ("x_silver",), f"""
SELECT hotel_id, hotel_name, city_clean AS city, country, hotel_type, star_rating, latitude, longitude,
  {tier('star_rating')} AS hotel_tier
FROM (SELECT *, row_number() OVER (PARTITION BY hotel_id ORDER BY booking_date DESC NULLS LAST,
        booking_id ASC NULLS LAST) AS rn FROM x_silver WHERE hotel_id IS NOT NULL) WHERE rn = 1""")


def kpi_measures(cancelled, guard: bool) -> str:
    den = "NULLIF(count(*), 0)" if guard else "count(*)"
    return f"""count(*) AS total_bookings,
  {dsum('total_amount_eur', 2)} AS total_revenue_eur,
  {avg_money('total_amount_eur')} AS avg_booking_value_eur,
  {avg_money('avg_nightly_rate_eur')} AS avg_nightly_rate_eur,
  {sround('avg(nights)', 1)} AS avg_nights,
  CAST(sum(adults + COALESCE(children, 0)) AS DOUBLE) AS total_guests,
  {sround(f"sum(CASE WHEN booking_status IN ({qlist(cancelled)}) THEN 1 ELSE 0 END) * 100.0 / {den}", 1)}
    AS cancellation_rate"""


cte("x_kpi", ("x_fact", "x_dim_city"), f"""
SELECT k.*, c.temperature_c AS city_temperature_c, c.weather_code AS city_weather_code FROM (
  SELECT city, country, booking_year, booking_month, hotel_type, {kpi_measures(CANCELLED_LABELS, False)}
  FROM x_fact GROUP BY city, country, booking_year, booking_month, hotel_type) k
LEFT JOIN x_dim_city c ON k.city = c.city""")


def date_attrs(d: str) -> str:
    return f"""{d} AS date_key, CAST(year({d}) AS INTEGER) AS year, CAST(month({d}) AS INTEGER) AS month,
  CAST(day({d}) AS INTEGER) AS day, CAST(quarter({d}) AS INTEGER) AS quarter,
  monthname({d}) AS month_name, strftime({d}, '%b') AS month_short,
  dayname({d}) AS day_name, strftime({d}, '%a') AS day_short,
  CAST(weekofyear({d}) AS INTEGER) AS week_of_year, CAST(dayofweek({d}) + 1 AS INTEGER) AS day_of_week,
  CAST(dayofyear({d}) AS INTEGER) AS day_of_year, dayofweek({d}) IN (0, 6) AS is_weekend,
  CAST(year({d}) AS VARCHAR) || '-Q' || CAST(quarter({d}) AS VARCHAR) AS year_quarter,
  strftime({d}, '%Y-%m') AS year_month"""


def year_spine(src: str, col: str, name: str) -> str:
    return (f"SELECT CAST(unnest(generate_series(make_date(CAST(min(year({col})) AS INTEGER), 1, 1), "
            f"make_date(CAST(max(year({col})) AS INTEGER), 12, 31), INTERVAL 1 DAY)) AS DATE) AS {name} "
            f"FROM {src} HAVING min(year({col})) IS NOT NULL")


cte("x_spine", ("x_fact",), year_spine("x_fact", "booking_date", "d"))
cte("x_dim_date", ("x_spine",), f"SELECT {date_attrs('d')} FROM x_spine")


def with_ctes(final: str, *names: str) -> str:
    """Prefix ``final`` with the named CTEs and their dependencies (ordered)."""
    order: list[str] = []

    def visit(n):
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return final
    body = ",\n".join(f"{n} AS ({CTES[n][1]})" for n in order)
    return f"WITH {body}\n{final}"


cte("x_kpi_channel", ("x_fact", "x_dim_city"), f"""
SELECT f.city, f.country, f.booking_year, f.booking_month, f.hotel_type,
  c.temperature_c AS city_temperature_c, c.weather_code AS city_weather_code,
  {kpi_measures(('Canceled',), True)}, count(DISTINCT f.booking_channel) AS channel_count
FROM x_fact f LEFT JOIN x_dim_city c ON f.city = c.city
GROUP BY f.city, f.country, f.booking_year, f.booking_month, f.hotel_type, c.temperature_c, c.weather_code""")

# The SQL model of the city dimension: every (city, country), the whole reading.
cte("x_wfull", ("x_wread",), f"""
SELECT * FROM (
  SELECT {initcap('trim(city)')} AS w_city, temperature_c, weather_code, humidity, latitude, longitude,
    row_number() OVER (PARTITION BY {initcap('trim(city)')} ORDER BY recorded_at DESC NULLS LAST,
      temperature_c ASC NULLS LAST, weather_code ASC NULLS LAST, humidity ASC NULLS LAST, latitude ASC NULLS LAST,
      longitude ASC NULLS LAST) AS rn
  FROM x_wread) WHERE rn = 1""")
cte("x_model_city", ("x_cities", "x_wfull", "x_rlk"), f"""
SELECT CAST(row_number() OVER (ORDER BY city ASC, country ASC NULLS FIRST) AS INTEGER) AS city_key, city, country,
  latitude, longitude, temperature_c, humidity, weather_code, {', '.join(
      f'COALESCE((SELECT max(rate) FROM x_rlk WHERE r_currency = {q(c)}), 0.0) AS rate_{c.lower()}' for c in RATE_CUR)}
FROM x_cities LEFT JOIN x_wfull ON city = w_city""")
cte("x_model_kpi", ("x_fact", "x_model_city"), f"""
SELECT f.city, f.country, f.booking_year, f.booking_month, f.hotel_type,
  c.temperature_c AS city_temperature_c, c.weather_code AS city_weather_code,
  {kpi_measures(('Canceled',), True)}, count(DISTINCT f.booking_channel) AS channel_count
FROM x_fact f LEFT JOIN x_model_city c ON f.city = c.city
GROUP BY f.city, f.country, f.booking_year, f.booking_month, f.hotel_type, c.temperature_c, c.weather_code""")

cte("x_cal_spine", ("x_fact",), year_spine("x_fact", "booking_date", "Date"))
cte("x_cal", ("x_cal_spine",), """
SELECT Date, CAST(year(Date) AS INTEGER) AS Year, CAST(month(Date) AS INTEGER) AS MonthNo,
  monthname(Date) AS Month, CAST(floor((month(Date) + 2) / 3) AS INTEGER) AS QuarterNo,
  'Qtr ' || CAST(CAST(floor((month(Date) + 2) / 3) AS INTEGER) AS VARCHAR) AS Quarter,
  CAST(day(Date) AS INTEGER) AS Day
FROM x_cal_spine""")


def not_in(col: str, values) -> str:
    """BI exclude filter: rows whose value is NULL are kept."""
    return f"NOT COALESCE({col} IN ({qlist(values)}), FALSE)"


def wavg(value: str, weight: str, scale: int, vscale: int) -> str:
    """sum(value * weight) / sum(weight) with the products summed in decimal."""
    num = f"sum(CAST(round({value} * {weight} * {10 ** vscale}) AS HUGEINT))"
    return _decimal_quotient(num, vscale, f"sum({weight})", scale)


def dq_sql(src: str, model: str, rules) -> str:
    """One SELECT per rule over ``src``; UNION ALL of (model, check, column,
    tested, failing, success)."""
    failing = {"not_null": "{c} IS NULL", "at_least_zero": "{c} < 0", "in_set": "{c} NOT IN ({v})"}
    label = {"at_least_zero": "between[0,None]"}
    parts = []
    for kind, c, arg in rules:
        name = f"of_type[{arg}]" if kind == "of_type" else label.get(kind, kind)
        if kind == "unique":
            body = (f"CAST(COALESCE(sum(n), 0) AS BIGINT) AS tested, "
                    f"CAST(COALESCE(sum(n) FILTER (WHERE k IS NOT NULL AND n > 1), 0) AS BIGINT) AS failing "
                    f"FROM (SELECT {c} AS k, count(*) AS n FROM {src} GROUP BY {c})")
        elif kind == "of_type":  # the oracle's tables have these types by construction
            body = "1 AS tested, 0 AS failing"
        else:
            bad = failing[kind].format(c=c, v=qlist(arg or []))
            body = f"count(*) AS tested, count(*) FILTER (WHERE {bad}) AS failing FROM {src}"
        parts.append(f'SELECT {q(name)} AS "check", {q(c)} AS "column", {body}')
    return (f"SELECT {q(model)} AS model, \"check\", \"column\", CAST(tested AS BIGINT) AS tested, "
            f"CAST(failing AS BIGINT) AS failing, failing = 0 AS success FROM ({chr(10).join(' UNION ALL ' * (i > 0) + p for i, p in enumerate(parts))})")


def time_activity_sql(src: str, cols) -> str:
    parts = [f"SELECT {q(c)} AS \"column\", count(*) FILTER (WHERE {c} <> '00:00:00') AS non_midnight_rows FROM {src}"
             for c in cols]
    return ("SELECT \"column\", non_midnight_rows, non_midnight_rows = 0 AS dropped FROM ("
            + " UNION ALL ".join(parts) + ")")
