"""Lookup tables, constants and patterns that results depend on.

They are data, not logic: each must have exactly this value for the results to be right.
"""

from __future__ import annotations

# Delay and weather ranges (inclusive) that cleaning clamps to.
DELAY_MINUTES = (-30.0, 600.0)
LOAD_FACTOR = (0.0, 1.0)
TEMPERATURE_F = (-10.0, 120.0)
HOURLY_RAIN_IN = (0.0, 10.0)
VISIBILITY_MI = (0.0, 10.0)
HOUR_OF_DAY = (0, 23)

# Holidays of 2022-2024 (observed dates).
HOLIDAYS = (
    "2022-01-17", "2022-02-21", "2022-05-30", "2022-06-20", "2022-07-04", "2022-09-05",
    "2022-10-10", "2022-11-11", "2022-11-24", "2022-12-26",
    "2023-01-02", "2023-01-16", "2023-02-20", "2023-05-29", "2023-06-19", "2023-07-04",
    "2023-09-04", "2023-10-09", "2023-11-10", "2023-11-23", "2023-12-25",
    "2024-01-01", "2024-01-15", "2024-02-19", "2024-05-27", "2024-06-19", "2024-07-04",
    "2024-09-02", "2024-10-14", "2024-11-11", "2024-11-28", "2024-12-25",
)
# Days around a holiday that count as its travel window.
HOLIDAY_WINDOW_DAYS = (-1, 2)

# Known routes: distance in miles, share of punctual arrivals, load factor, departures a day,
# passengers a year.
ROUTES = (
    ("FLL-ATL", 581, 0.74, 0.87, 6, 420000),
    ("FLL-LAS", 2316, 0.78, 0.91, 3, 210000),
    ("FLL-LAX", 2342, 0.76, 0.88, 2, 148000),
    ("FLL-ORD", 1182, 0.70, 0.85, 4, 290000),
    ("FLL-DFW", 1235, 0.73, 0.83, 4, 280000),
    ("FLL-MCO", 170, 0.77, 0.89, 5, 350000),
    ("FLL-JFK", 1069, 0.68, 0.86, 3, 210000),
    ("FLL-BOS", 1240, 0.71, 0.84, 2, 145000),
    ("FLL-DTW", 1154, 0.72, 0.82, 3, 195000),
    ("FLL-MIA", 21, 0.80, 0.78, 2, 88000),
)
DEFAULT_ROUTE_OTP = 0.75
CONGESTED_DESTINATIONS = ("ATL", "DFW", "JFK", "LAX", "ORD")
LONG_HAUL_MILES = 1500
SHORT_HAUL_MILES = 400

# Schedule strategies: key, load-factor capture, punctuality multiplier, label.
STRATEGIES = (
    ("all_day", 1.00, 1.00, "All-Day (Spread)"),
    ("peak_only", 1.22, 1.15, "Peak Hours Only"),
    ("off_peak", 0.72, 0.85, "Off-Peak Only"),
)

# What-if economics.
REVENUE_PER_SEAT_MILE = 0.1025
COST_PER_SEAT_MILE = 0.0920
SEATS_PER_DEPARTURE = 178
DAYS_PER_YEAR = 365
DEMAND_ELASTICITY = 0.30
CONGESTION_OTP_LOSS = 0.003
SCHEDULE_OTP_WEIGHT = 0.025
DILUTION_PER_FLIGHT = 0.005
DEMAND_SIGMA = 0.05
YIELD_SIGMA = 0.04
COST_SIGMA = 0.03
OTP_SIGMA = 0.012
LF_RANGE = (0.20, 0.98)
NEW_FLIGHT_LF_RANGE = (0.20, 0.97)
OTP_RANGE = (0.40, 0.99)
DEFAULT_RUNS = 10000
# The 90th percentile of a standard normal variable.
Z_TENTH = 1.2815515655446004
# Abramowitz and Stegun, 7.1.26: the complement of the error function by a polynomial.
ERROR_FUNCTION = (0.3275911, 0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)

# Wording of the what-if reports.
RECOMMENDATION_TEXT = "%s: %s%d daily %s flight (%s) → LF %+.1fpp, OTP %+.1fpp, Revenue $%+.1fM/yr"
STRATEGY_TEXT = "  [%-10s] LF=%.1f%% (%+.1fpp) | OTP=%.1f%% (%+.1fpp) | Rev=%+.1fM"
NARRATIVE_HEAD = """=== Scenario Analysis: %s %+d Daily Flight(s) ===

BASELINE STATE:
  Load Factor:  %.1f%%
  OTP:          %.1f%%

SCENARIO COMPARISON:"""
NARRATIVE_END = """
BEST OPTION:
  %s"""

# Forecast intervals: multiples of sigma for the 80 % and 95 % bands.
Z80 = 1.28
Z95 = 1.96
SEASON_MONTHS = 12

# Question intents in order of precedence: pattern on the lower-case text, report.
INTENT_PATTERNS = (
    (r"(worst|best) otp|on.?time.*(route|performance)", "worst_otp_routes"),
    (r"delay cause|delay breakdown|what cause", "delay_causes_by_route"),
    (r"load factor|capacity utilization|lf", "latest_load_factors"),
    (r"summer|winter|seasonal|season", "seasonal_load_factor"),
    (r"weather|thunder|storm|delay.*weather|weather.*delay", "weather_by_route"),
    (r"monthly|trend|over time|month", "monthly_trend"),
    (r"december|holiday|peak season", "december_by_route"),
    (r"fll.atl|atlanta|fll to atl", "one_route_over_time"),
)
DEFAULT_INTENT = "best_otp_routes"
# Route of the report on one route.
DEFAULT_ROUTE = "FLL-ATL"

# Model features in training order.
FEATURES = (
    "hour_of_day", "day_of_week", "month", "quarter", "is_weekend", "is_monday", "is_friday",
    "is_holiday", "is_holiday_window", "is_early_morning", "is_peak_morning", "is_afternoon",
    "is_evening", "is_summer", "is_hurricane_season", "is_winter", "hour_sin", "hour_cos",
    "month_sin", "month_cos", "dow_sin", "dow_cos",
    "route_distance", "route_otp_baseline", "is_high_congestion_dest", "is_long_haul",
    "is_short_haul", "distance_normalised",
    "weather_severity", "thunderstorm_flag", "precipitation_flag", "low_visibility_flag",
    "wind_gust_flag", "wind_speed", "high_wind_flag",
    "rolling_avg_dep_delay", "prev_tail_dep_delay",
    "legs_today_before", "cumulative_tail_delay_today", "prev_tail_arr_delay",
    "hours_since_last_flight", "quick_turn_flag", "tail_delay_streak",
)

# Classifier settings (those that Spark's boosted trees have).
TREES = 400
TREE_DEPTH = 6
LEARNING_RATE = 0.05
ROW_SAMPLE = 0.8
FEATURE_SAMPLE = 0.8
MIN_LEAF_ROWS = 5
POSITIVE_WEIGHT = 1.5
DECISION_THRESHOLD = 0.5
RISK_LOW = 0.30
RISK_HIGH = 0.55

# Release gates.
MIN_AUC = 0.75
MIN_F1 = 0.40
