"""Fixed values of the data contract: cities, variables, code table, thresholds."""

# Cities served, in configuration order.
CITIES = [
    {"name": "mumbai", "display_name": "Mumbai", "latitude": 19.0760,
     "longitude": 72.8777, "timezone": "Asia/Kolkata", "country": "India"},
    {"name": "delhi", "display_name": "Delhi", "latitude": 28.6139,
     "longitude": 77.2090, "timezone": "Asia/Kolkata", "country": "India"},
    {"name": "bangalore", "display_name": "Bangalore", "latitude": 12.9716,
     "longitude": 77.5946, "timezone": "Asia/Kolkata", "country": "India"},
    {"name": "london", "display_name": "London", "latitude": 51.5074,
     "longitude": -0.1278, "timezone": "Europe/London", "country": "UK"},
    {"name": "new_york", "display_name": "New York", "latitude": 40.7128,
     "longitude": -74.0060, "timezone": "America/New_York", "country": "USA"},
    {"name": "tokyo", "display_name": "Tokyo", "latitude": 35.6762,
     "longitude": 139.6503, "timezone": "Asia/Tokyo", "country": "Japan"},
]

# Hourly variables requested per city, with their storage types.
HOURLY_VARIABLES = {
    "temperature_2m": "double",
    "relative_humidity_2m": "int",
    "apparent_temperature": "double",
    "precipitation": "double",
    "rain": "double",
    "wind_speed_10m": "double",
    "wind_direction_10m": "int",
    "weather_code": "int",
    "uv_index": "double",
}
BACKFILL_DAYS = 7
HOURS_PER_DAY = 24

# Weather codes and the label they stand for.
WEATHER_CONDITIONS = [
    ("Clear sky", [0]),
    ("Mainly clear", [1]),
    ("Partly cloudy", [2]),
    ("Overcast", [3]),
    ("Fog", [45, 48]),
    ("Drizzle", [51, 53, 55]),
    ("Rain", [61, 63, 65]),
    ("Snow", [71, 73, 75]),
    ("Snow grains", [77]),
    ("Rain showers", [80, 81, 82]),
    ("Snow showers", [85, 86]),
    ("Thunderstorm", [95]),
    ("Thunderstorm with hail", [96, 99]),
]
UNKNOWN_CONDITION = "Unknown"

# Inclusive bounds of a plausible reading.
PLAUSIBLE = {
    "temperature_2m": (-60, 60),
    "relative_humidity_2m": (0, 100),
    "wind_speed_10m": (0, 300),
}

# An extreme day exceeds one of these (strictly).
HEAT_ABOVE = 42
COLD_BELOW = 0
RAIN_ABOVE = 50
WIND_ABOVE = 60
UV_ABOVE = 8
STORM_CODES = [95, 96, 99]

# Severity levels, highest first: (level, temperature, rain, wind, weight).
SEVERITIES = [
    ("CRITICAL", 48, 100, 120, 3),
    ("WARNING", 45, 75, 90, 2),
]
LOWEST_SEVERITY = ("WATCH", 1)

# The comfort score's ideal climate and penalties.
IDEAL_TEMPERATURE = 22
IDEAL_HUMIDITY = 50
TEMPERATURE_PENALTY = 2
HUMIDITY_PENALTY = 0.3

# Report periods and the completeness threshold of the Gold gate.
TREND_DAYS = 30
TIMELINE_DAYS = 30
RISK_DAYS = 90
ROLLING_ROWS = 7
GOLD_COMPLETENESS = 0.9
