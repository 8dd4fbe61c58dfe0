"""Data-quality checks.  Each table is scanned in ONE aggregate pass (plus
one grouped pass per uniqueness check); results come back as rows
(model, check, column, tested, failing, success) instead of prints."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import constants as K


@dataclass(frozen=True)
class Check:
    kind: str            # not_null | unique | between | of_type | in_set
    column: str
    min_value: float | None = None
    max_value: float | None = None
    values: tuple = ()
    type_name: str = ""


def not_null(c):
    return Check("not_null", c)


def unique(c):
    return Check("unique", c)


def between(c, lo=None, hi=None):
    return Check("between", c, lo, hi)


def of_type(c, t):
    return Check("of_type", c, type_name=t)


def in_set(c, values):
    return Check("in_set", c, values=tuple(values))


# FIXED VALUES: the silver expectation suite (11 expectations).
SILVER_SUITE = [
    not_null("booking_id"), not_null("customer_id"), not_null("hotel_id"), not_null("booking_date"),
    unique("booking_id"),
    between("total_amount", 0), between("room_price", 0),
    of_type("booking_id", "StringType"), of_type("total_amount", "DoubleType"),
    of_type("customer_id", "StringType"),
    in_set("currency", K.CURRENCIES),
]

RESULT_SCHEMA = "check string, column string, tested bigint, failing bigint"


def _failing_expr(ch: Check):
    c = F.col(ch.column)
    if ch.kind == "not_null":
        return F.count_if(c.isNull())
    if ch.kind == "between":
        bad = F.lit(False)
        if ch.min_value is not None:
            bad = bad | (c < ch.min_value)
        if ch.max_value is not None:
            bad = bad | (c > ch.max_value)
        return F.count_if(c.isNotNull() & bad)
    if ch.kind == "in_set":
        return F.count_if(c.isNotNull() & ~c.isin(list(ch.values)))
    raise ValueError(ch.kind)


def _label(ch: Check) -> str:
    if ch.kind == "between":
        return f"between[{ch.min_value},{ch.max_value}]"
    if ch.kind == "of_type":
        return f"of_type[{ch.type_name}]"
    return ch.kind


def dq_suite(df: DataFrame, checks=tuple(SILVER_SUITE), model: str = "silver_bookings") -> DataFrame:
    """Run ``checks`` on ``df`` in one pass: rows are grouped by the first
    unique column (map-side combined, so a hot key costs one row per task),
    each group with its counts of failing rows; one aggregate over the groups
    answers all row checks and the uniqueness.  Further unique columns take a
    grouped pass each; type checks read the schema."""
    spark = df.sparkSession
    row_checks = [c for c in checks if c.kind in ("not_null", "between", "in_set")]
    keys = [c for c in checks if c.kind == "unique"]

    def result(ch, tested, failing):
        return F.struct(F.lit(_label(ch)).alias("check"), F.lit(ch.column).alias("column"),
                        F.coalesce(tested, F.lit(0)).cast("bigint").alias("tested"),
                        F.coalesce(failing, F.lit(0)).cast("bigint").alias("failing"))

    def repeated(column):
        return F.sum(F.when(F.col(column).isNotNull() & (F.col("_n") > 1), F.col("_n")))

    parts = []
    if keys:
        first = keys[0]
        groups = df.groupBy(first.column).agg(
            F.count("*").alias("_n"), *[_failing_expr(c).alias(f"_f{i}") for i, c in enumerate(row_checks)])
        rows = [result(c, F.sum("_n"), F.sum(f"_f{i}")) for i, c in enumerate(row_checks)]
        rows.append(result(first, F.sum("_n"), repeated(first.column)))
        parts.append(groups.agg(F.array(*rows).alias("a")).select(F.inline("a")))
        for c in keys[1:]:
            groups = df.groupBy(c.column).agg(F.count("*").alias("_n"))
            parts.append(groups.agg(F.array(result(c, F.sum("_n"), repeated(c.column))).alias("a"))
                         .select(F.inline("a")))
    elif row_checks:
        rows = [result(c, F.count("*"), _failing_expr(c)) for c in row_checks]
        parts.append(df.agg(F.array(*rows).alias("a")).select(F.inline("a")))
    types = {f.name: type(f.dataType).__name__ for f in df.schema.fields}
    type_rows = [(_label(c), c.column, 1, 0 if types.get(c.column) == c.type_name else 1)
                 for c in checks if c.kind == "of_type"]
    if type_rows:
        parts.append(spark.createDataFrame(type_rows, RESULT_SCHEMA))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(F.lit(model).alias("model"), "check", "column", F.col("tested").cast("bigint"),
                      F.col("failing").cast("bigint"), (F.col("failing") == 0).alias("success"))


def dq_report(results: DataFrame) -> DataFrame:
    """Suite summary: total, passed, failed and the failed check names."""
    return results.agg(F.count("*").alias("total"), F.count_if("success").alias("passed"),
                       F.count_if(~F.col("success")).alias("failed"),
                       F.array_sort(F.collect_list(F.when(~F.col("success"),
                                                          F.concat_ws(":", "check", "column")))).alias("failed_checks"))


def dq_native_summary(df: DataFrame) -> DataFrame:
    """Seven named problem counts plus two filled-in counts, in one pass
    (duplicates = total - distinct)."""
    counts = df.agg(
        F.count_if(F.col("booking_id").isNull()).alias("booking_id NULL"),
        F.count_if(F.col("customer_id").isNull()).alias("customer_id NULL"),
        F.count_if(F.col("hotel_id").isNull()).alias("hotel_id NULL"),
        F.count_if(F.col("booking_date").isNull()).alias("booking_date NULL"),
        F.count_if(F.col("total_amount") < 0).alias("total_amount < 0"),
        F.count_if(F.col("city_clean").isNull()).alias("city_clean NULL"),
        (F.count("*") - F.count_distinct("booking_id")
         - F.coalesce(F.max(F.col("booking_id").isNull()).cast("int"), F.lit(0))).alias("duplicate booking"),
        # rows the cleaning filled in rather than found: sentinel dates, zero amounts
        F.count_if(F.col("booking_date") == F.to_date(F.lit(K.DATE_SENTINEL))).alias("booking_date sentinel"),
        F.count_if(F.col("total_amount") == 0).alias("total_amount zero-filled"),
    )
    names = counts.columns
    stack = "stack({}, {}) as (test, problems)".format(
        len(names), ", ".join(f"'{n}', cast(`{n}` as bigint)" for n in names))
    return counts.selectExpr(stack).withColumn("ok", F.col("problems") == 0)


def dq_table_checks(silver: DataFrame, weather: DataFrame, rates: DataFrame,
                    min_rows: int = K.MIN_SILVER_ROWS, required_cols=None) -> DataFrame:
    """Table-level tests: row-count floor and non-empty, required columns,
    temperature range (NULL ignored), strictly positive rates."""
    spark = silver.sparkSession
    req = required_cols or ["booking_id", "hotel_id", "booking_date", "total_amount", "currency", "city_clean"]
    lo, hi = K.TEMPERATURE_RANGE
    missing = [c for c in req if c not in silver.columns]
    n = F.count("*")
    nameless = F.count_if(F.col("city").isNull())
    off = F.count_if(F.col("temperature_c").isNotNull() & ((F.col("temperature_c") < lo) | (F.col("temperature_c") > hi)))
    poor = F.count_if(~(F.col("rate") > 0))

    def checks(df, model, *rows):
        """One aggregate over the table, one result row per (check, observed, success)."""
        structs = [F.struct(F.lit(model).alias("model"), F.lit(c).alias("check"), o.cast("bigint").alias("observed"),
                            ok.alias("success")) for c, o, ok in rows]
        return df.agg(F.array(*structs).alias("a")).select(F.inline("a"))

    return (checks(silver, "silver_bookings", ("min_rows", n, n >= min_rows), ("not_empty", n, n > 0))
            .union(spark.createDataFrame([("silver_bookings", "required_columns", len(missing), not missing)],
                                         "model string, check string, observed bigint, success boolean"))
            .union(checks(weather, "bronze_weather", ("not_empty", n, n > 0),
                          ("city_not_null", nameless, nameless == 0), ("temperature_in_range", off, off == 0)))
            .union(checks(rates, "bronze_exchange_rates", ("not_empty", n, n > 0),
                          ("rate_positive", poor, poor == 0))))


def dq_required_values(df: DataFrame, column: str, required=tuple(K.REQUIRED_RATE_CURRENCIES)) -> DataFrame:
    """Which required values occur in ``column`` (a semi-join of the
    expected list against the distinct values)."""
    spark = df.sparkSession
    exp = spark.createDataFrame([(v,) for v in required], T.StructType([T.StructField("value", T.StringType())]))
    present = df.select(F.col(column).alias("value")).distinct().withColumn("present", F.lit(True))
    return (exp.join(present, "value", "left")
            .select("value", F.coalesce(F.col("present"), F.lit(False)).alias("present")))


# FIXED VALUES: the gold model tests (20).
MODEL_TESTS = {
    "fact_bookings": [not_null("booking_id"), unique("booking_id"), not_null("hotel_id"),
                      not_null("booking_date"), not_null("total_amount"), not_null("total_amount_eur"),
                      in_set("currency", K.CURRENCIES)],
    "dim_city": [not_null("city_key"), unique("city_key"), not_null("city"), unique("city")],
    "dim_hotel": [not_null("hotel_id"), unique("hotel_id"), in_set("hotel_tier", ["Premium", "Standard", "Budget"])],
    "dim_date": [not_null("date_key"), unique("date_key"), not_null("year")],
    "kpi_revenue": [not_null("city"), not_null("total_bookings"), not_null("total_revenue_eur")],
}


def dq_model_tests(tables: dict) -> DataFrame:
    """Run the declarative gold model tests over ``{model: DataFrame}``."""
    out = None
    for model, checks in MODEL_TESTS.items():
        if model not in tables:
            continue
        r = dq_suite(tables[model], checks, model)
        out = r if out is None else out.unionByName(r)
    return out
