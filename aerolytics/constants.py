"""Fixed values that must equal the reference behaviour for right results.

FIXED VALUES (category names and codes, PM2.5 breakpoints, station names, feature lists,
cluster texts, thresholds). Stated plainly, in natural order, in one place.
"""

# --- fixed values -----------------------------------------------------------------
# AQI categories in code order 0..5.
AQI_CATEGORIES = [
    "Good",
    "Moderate",
    "Unhealthy for Sensitive Groups",
    "Unhealthy",
    "Very Unhealthy",
    "Hazardous",
]
# Upper-inclusive PM2.5 breakpoints for codes 0..4; above the last is code 5.
PM25_BREAKPOINTS = [12.0, 35.4, 55.4, 150.4, 250.4]
# Unknown category text maps to this code (Moderate).
UNKNOWN_CATEGORY_CODE = 1
# Categories counted as safe for the hour-of-day safety score, and the advice threshold.
SAFE_CATEGORIES = ["Good", "Moderate"]
SAFE_THRESHOLD = 0.7
ADVICE_SAFE = "✅ Safe"
ADVICE_MODERATE = "⚠️ Moderate"

STATIONS = [
    "Aotizhongxin", "Changping", "Dingling", "Dongsi", "Guanyuan", "Gucheng",
    "Huairou", "Nongzhanguan", "Shunyi", "Tiantan", "Wanliu", "Wanshouxigong",
]
STATION_FILE_PATTERN = "PRSA_Data_{station}_20130301-20170228.csv"
DEFAULT_STATION = "Aotizhongxin"

# Raw source column names; inside the engine they are lower case and PM2.5 is pm25.
RAW_POLLUTANTS = ["PM2.5", "PM10", "SO2", "NO2", "CO", "O3"]
RAW_WEATHER = ["TEMP", "PRES", "DEWP", "RAIN", "WSPM"]
POLLUTANTS = ["pm25", "pm10", "so2", "no2", "co", "o3"]
WEATHER = ["temp", "pres", "dewp", "rain", "wspm"]
NUMERIC = POLLUTANTS + WEATHER

PM25_LAGS = [1, 3, 6, 12, 24]
PM10_LAGS = [1, 6, 24]
ROLLING_WINDOWS = [3, 6, 12, 24]

CLASSIFIER_FEATURES = [
    "pm10", "so2", "no2", "co", "o3", "temp", "pres", "dewp", "rain", "wspm",
    "wd_encoded", "hour_sin", "hour_cos", "month_sin", "month_cos",
    "pm25_lag1", "pm25_lag6", "pm25_lag24", "pm25_roll_mean3", "pm25_roll_mean24",
]
REGRESSOR_FEATURES = [
    "pm10", "so2", "no2", "co", "o3", "temp", "pres", "dewp", "rain", "wspm",
    "wd_encoded", "hour_sin", "hour_cos", "month_sin", "month_cos",
    "pm25_lag1", "pm25_lag3", "pm25_lag6", "pm25_lag12", "pm25_lag24",
    "pm25_roll_mean3", "pm25_roll_mean6", "pm25_roll_mean24", "pm25_roll_std3",
]
PROJECTION_FEATURES = ["pm25", "pm10", "so2", "no2", "co", "o3", "temp", "pres", "dewp", "wspm"]

CLUSTER_DESCRIPTIONS = [
    "Low-pollution zone (clean air profile)",
    "Moderate-pollution urban zone",
    "High-pollution industrial zone",
    "Heavy-traffic hotspot",
    "Seasonal pollution zone",
]
UNKNOWN_CLUSTER_TEXT = "Unknown cluster profile"
UNKNOWN_TEXT = "Unknown"

FORECAST_HORIZON = 24
MAX_FORECAST_HORIZON = 72
TOP_N_DEFAULT = 5
TOP_N_MAX = 24
SENSOR_SENTINEL = -200.0
UCI_TIME_FORMAT = "dd/MM/yyyy HH.mm.ss"
PCA_VARIANCE_TARGET = 0.95
DBSCAN_EPS = 0.8
DBSCAN_MIN_POINTS = 2
KMEANS_K_RANGE = [3, 4, 5]
KMEANS_RESTARTS = 10
SEED = 42
GATE_MAX_RMSE = 60.0
GATE_MIN_ACCURACY = 0.60
# --- end fixed values -------------------------------------------------------------
