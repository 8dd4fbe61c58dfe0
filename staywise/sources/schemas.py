"""Declared schemas of the landing tables and API payloads."""

from __future__ import annotations

from pyspark.sql import types as T

# FIXED VALUES: the 73 nullable string columns of the stream landing table
# (hotel 13, customer 16, booking 29, review and system 14, event time).
STREAM_TABLE_COLUMNS = [
    # hotel
    "hotel_id", "hotel_name", "country", "city", "hotel_type", "star_rating", "total_rooms",
    "hotel_facilities", "hotel_description", "nearby_attractions", "latitude", "longitude", "website",
    # customer
    "customer_id", "first_name", "last_name", "full_name", "email", "phone", "birth_date", "gender",
    "country_customer", "city_customer", "address", "postal_code", "language_preference",
    "loyalty_level_customer", "registration_date", "marketing_consent",
    # booking
    "booking_id", "booking_date", "checkin_date", "checkout_date", "nights", "adults", "children",
    "infants", "room_type", "rooms_booked", "booking_channel", "special_requests", "is_cancelled",
    "cancellation_date", "cancellation_reason", "total_price", "room_price", "tax_amount", "service_fee",
    "paid_amount", "payment_status", "payment_method", "booking_source", "promotion_code",
    "discount_amount", "created_timestamp", "updated_timestamp", "created_by", "booking_status",
    # review and system
    "review_id", "review_rating", "review_title", "review_text", "review_date", "helpful_votes",
    "is_verified_review", "reviewer_location", "stay_date", "trip_type", "room_type_reviewed",
    "source_system", "created_at", "updated_at",
    # event time
    "event_time",
]

STREAM_TABLE_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in STREAM_TABLE_COLUMNS])

# The 9 fields the event stream declares.
EVENT_SCHEMA = T.StructType([
    T.StructField("booking_id", T.StringType()),
    T.StructField("customer_id", T.LongType()),
    T.StructField("hotel_id", T.StringType()),
    T.StructField("booking_date", T.StringType()),
    T.StructField("room_type", T.StringType()),
    T.StructField("total_amount", T.DoubleType()),
    T.StructField("currency", T.StringType()),
    T.StructField("source_system", T.StringType()),
    T.StructField("ingestion_time", T.StringType()),
])

# Real-time table: hotel_id long, dates as timestamps.
REALTIME_SCHEMA = T.StructType([
    T.StructField("booking_id", T.StringType()),
    T.StructField("customer_id", T.LongType()),
    T.StructField("hotel_id", T.LongType()),
    T.StructField("booking_date", T.TimestampType()),
    T.StructField("room_type", T.StringType()),
    T.StructField("total_amount", T.DoubleType()),
    T.StructField("currency", T.StringType()),
    T.StructField("source_system", T.StringType()),
    T.StructField("ingestion_time", T.TimestampType()),
])

GEOCODE_SCHEMA = T.StructType([T.StructField("results", T.ArrayType(T.StructType([
    T.StructField("latitude", T.DoubleType()), T.StructField("longitude", T.DoubleType()),
    T.StructField("country", T.StringType())])))])

FORECAST_SCHEMA = T.StructType([T.StructField("current", T.StructType([
    T.StructField("temperature_2m", T.DoubleType()),
    T.StructField("relative_humidity_2m", T.LongType()),
    T.StructField("weather_code", T.LongType()),
    T.StructField("time", T.StringType())]))])

RATES_SCHEMA = T.StructType([
    T.StructField("base_code", T.StringType()),
    T.StructField("time_last_update_utc", T.StringType()),
    T.StructField("rates", T.MapType(T.StringType(), T.DoubleType())),
])

WEATHER_TABLE_SCHEMA = ("city string, country_api string, latitude double, longitude double, "
                        "temperature_c double, humidity bigint, weather_code bigint, recorded_at timestamp, "
                        "source string, ingestion_time timestamp")
RATES_TABLE_SCHEMA = ("base_currency string, target_currency string, rate double, timestamp timestamp, "
                      "source string, ingestion_time timestamp")
