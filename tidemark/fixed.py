"""Fixed values.

Word lists, constants and name lists that must hold exactly these values for
results to agree with the established data and reports. Nothing here is logic.
"""

from __future__ import annotations

# --- Fixed values: text cleaning ---------------------------------------------
DEVANAGARI_DIGITS = "०१२३४५६७८९"
CURRENCY_SIGN = "रू"
COMMODITY_NAMES = {
    "गोलभेडा ठूलो": "Tomato_Big",
    "गोलभेडा सानो": "Tomato_Small",
    "गोलभेडा": "Tomato",
}
COMMODITIES_KEPT = ("Tomato", "Tomato_Big", "Tomato_Small")
QUOTE_COLUMNS = {"Date": "Date", "कृषि उपज": "commodity", "औसत": "Average_Price"}
SUPPLY_COLUMNS = {"Date": "Date", "कृषि उपज": "commodity", "आगमन": "Supply_Volume"}

# --- Fixed values: calendar --------------------------------------------------
MARKET_ZONE = "Asia/Kathmandu"
FIRST_DAY = "2022-01-01"
MONTH_PAIRS = {
    "jul/aug": 7, "aug/sep": 8, "sep/oct": 9, "oct/nov": 10, "nov/dec": 11, "dec/jan": 12,
    "jan/feb": 1, "feb/mar": 2, "mar/apr": 3, "apr/may": 4, "may/jun": 5, "jun/jul": 6,
}
FESTIVAL_RANGES = ((3, 1, 3, 20), (4, 10, 4, 20), (9, 25, 10, 15), (11, 1, 11, 15))
FESTIVAL_DAY_OF_YEAR = 280
SEASON_MONTHS = {
    "is_monsoon": (6, 7, 8, 9),
    "is_monsoon_peak": (7, 8),
    "is_dashain_tihar": (10, 11),
    "is_terai_harvest": (12, 1, 2),
    "is_offseason": (3, 4),
    "is_pre_festival": (9,),
    "is_winter": (12, 1, 2),
    "is_post_monsoon": (10, 11),
}
# The parameter search counts November as harvest too.
SEARCH_HARVEST_MONTHS = (11, 12, 1, 2)
SEASON_REPORT = {
    "Dashain/Tihar (Oct-Nov)": (10, 11),
    "Monsoon (Jun-Sep)": (6, 7, 8, 9),
    "Terai Harvest (Dec-Feb)": (12, 1, 2),
}
# The premium of this season is taken against the days outside it.
SEASON_AGAINST_REST = ("Monsoon (Jun-Sep)",)

# --- Fixed values: places, weights, event words ------------------------------
DISTRICTS = ("Kathmandu", "Sarlahi", "Dhading", "Kavre")
DISTRICT_WEIGHTS = {"Kathmandu": 0.15, "Sarlahi": 0.40, "Dhading": 0.25, "Kavre": 0.20}
PLACE_NAMES = {
    "Kathmandu": "Kathmandu", "Sarlahi": "Sarlahi", "Dhading": "Dhading",
    "Kavre": "Kavre", "Kavrepalanchok": "Kavre",
}
EVENT_WORDS = {
    "Landslide": ("landslide", "landslides", "slope failure", "hill collapse"),
    "Flood": ("flood", "floods", "flooding", "inundation", "river overflow"),
    "Road_Block": (
        "road blocked", "road obstruction", "highway blocked", "highway obstructed",
        "traffic disrupted", "road disruption", "road closed", "highway closed",
        "one-way traffic", "transport disrupted",
    ),
    "Heavy_Rain_Disruption": (
        "heavy rain", "continuous rainfall", "rain-induced", "monsoon damage", "rain disruption",
    ),
}
SEVERITY_WORDS = {
    2: ("road blocked", "one-way traffic", "flooding", "landslide", "flood", "heavy rain"),
    3: ("major", "severe", "widespread", "highway blocked", "transport disrupted"),
    4: ("killed", "fatal"),
    5: ("nationwide", "extreme"),
}
SEVERITY_WORDS_LOCAL = {
    2: (
        "road blocked", "road obstruction", "one-way traffic", "flooding", "landslide", "flood",
        "heavy rain", "continuous rainfall", "damaged road",
    ),
    3: (
        "major", "severe", "widespread", "highway blocked", "highway obstructed",
        "power supply disrupted", "transport disrupted", "multiple places", "several places",
        "district affected",
    ),
    4: ("death toll", "killed", "fatal"),
    5: ("nationwide", "extreme"),
}
COUNTRY_WORD = "Nepal"

# --- Fixed values: column names ----------------------------------------------
RATE_METADATA = ("currency_name", "currency_iso3", "unit", "usd_buy", "published_on", "modified_on")
DATE_HEADERS = ("date", "published_date", "published_date_(a.d.)", "day", "period")
SELL_HEADERS = ("usd_sell", "usd_sell_rate", "u.s._dollar_sell", "us_dollar_sell")
SELL_HEADERS_LOCAL = SELL_HEADERS + ("dollar_sell", "usd")
SHEET_MARKERS = ("fiscal year", "mid-month")
SHEET_DATE_WORDS = ("fiscal year", "mid-month", "english date", "date", "month", "period")
SHEET_VALUE_WORDS = ("overall inflation", "inflation", "% change")
PAGE_DATE_WORDS = ("date", "effective")
PAGE_VALUE_WORDS = ("diesel", "hsd")

# --- Fixed values: model features --------------------------------------------
MODEL_LAGS = (1, 2, 3, 5, 7, 14, 21, 28)
FEATURE_GROUPS = {
    "Macro": ("Supply_Volume", "USD_TO_NPR", "Diesel", "Inflation"),
    "Weather": (
        "Temp_mean", "Temp_std", "Rainfall_mean", "Rainfall_max", "Pressure_mean",
        "Wind_mean", "Wind_max", "Precip_mean", "Precip_max",
    ),
    "KG Risk": (
        "Market_Risk", "disruption_flag", "active_disruption_count", "max_severity",
        "weighted_route_blockage",
    ),
    "Lag": ("lag1", "lag2", "lag3", "lag5", "lag7", "lag14", "lag21", "lag28"),
    "Rolling": ("roll_mean7", "roll_mean14", "roll_mean21", "roll_std7", "roll_std14", "roll_std21"),
    "Momentum": (
        "momentum7", "momentum14", "momentum21", "accel", "zscore14", "price_range7", "volatility7",
    ),
    "Temporal": (
        "month_sin", "month_cos", "month_progress", "is_monsoon", "is_dashain_tihar",
        "is_terai_harvest", "day_of_week", "is_weekend", "weeks_to_dashain",
    ),
    "Interaction": ("mom7_x_monsoon", "mom7_x_festival"),
}
# The shorter study knows fewer columns per group; lag28 is computed there but not used.
FEATURE_GROUPS_SHORT = {
    "Macro": ("Supply_Volume", "USD_TO_NPR", "Diesel", "Inflation"),
    "Weather": ("Temp_mean", "Temp_std", "Rainfall_mean", "Rainfall_max"),
    "KG Risk": ("Market_Risk",),
    "Lag": ("lag1", "lag2", "lag3", "lag5", "lag7", "lag14", "lag21"),
    "Rolling": ("roll_mean7", "roll_mean14", "roll_mean21", "roll_std7", "roll_std14"),
    "Momentum": (
        "momentum7", "momentum14", "momentum21", "accel", "zscore14", "price_range7", "volatility7",
    ),
    "Temporal": (
        "month_sin", "month_cos", "month_progress", "is_monsoon", "is_dashain_tihar",
        "day_of_week", "is_weekend", "weeks_to_dashain",
    ),
    "Interaction": ("mom7_x_monsoon", "mom7_x_festival"),
}
EXPERIMENTS = {
    "BASE": ("Macro", "Weather", "KG Risk"),
    "BASE + LAG": ("Macro", "Weather", "KG Risk", "Lag"),
    "BASE + LAG + ROLL": ("Macro", "Weather", "KG Risk", "Lag", "Rolling"),
    "BASE + LAG + ROLL + MOM": ("Macro", "Weather", "KG Risk", "Lag", "Rolling", "Momentum"),
    "BASE + LAG + ROLL + MOM + TEMP": (
        "Macro", "Weather", "KG Risk", "Lag", "Rolling", "Momentum", "Temporal",
    ),
    "FULL MODEL": (
        "Macro", "Weather", "KG Risk", "Lag", "Rolling", "Momentum", "Temporal", "Interaction",
    ),
}
SEARCH_FEATURES = (
    "lag1", "lag2", "lag3", "lag5", "lag7", "lag14", "lag21", "lag28",
    "roll_mean7", "roll_mean14", "roll_mean21", "roll_mean30", "roll_std7", "roll_std14",
    "mom7", "mom14", "mom21", "accel", "zscore14", "price_range7",
    "month_sin", "month_cos", "is_monsoon", "is_monsoon_peak", "is_dashain_tihar",
    "is_terai_harvest", "is_offseason", "is_pre_festival", "is_winter", "is_post_monsoon",
    "mom7_x_monsoon", "mom7_x_festival", "mom7_x_harvest", "weeks_to_dashain",
    "Supply_Volume", "USD_TO_NPR", "Diesel", "Inflation",
    "Sarlahi_Rainfall_MM", "Dhading_Rainfall_MM", "Kathmandu_Rainfall_MM", "Market_Risk",
)
SEASONAL_WORDS = (
    "monsoon", "dashain", "festival", "harvest", "offseason", "winter", "holi", "month_sin",
    "month_cos", "weeks_to_dashain", "post_monsoon", "pre_festival", "mom7_x",
)

# --- Fixed values: models and evaluation -------------------------------------
HORIZONS = (1, 2, 3, 4, 5, 6, 7)
PRIMARY_HORIZON = 7
TRAIN_SHARE = 0.80
SPIKE_SIGMA = 1.5
MEAN_PRICE = 52.86
SEED = 42
RIDGE_ALPHA = 100.0
FOREST = {"numTrees": 400, "maxDepth": 6, "minInstancesPerNode": 30, "featureSubsetStrategy": "0.4"}
BOOSTING = {"maxIter": 500, "stepSize": 0.01, "maxDepth": 2, "minInstancesPerNode": 20, "subsamplingRate": 0.7}
BOOSTING_SPARSE = {
    "maxIter": 500, "stepSize": 0.01, "maxDepth": 2, "minInstancesPerNode": 20,
    "subsamplingRate": 0.6, "featureSubsetStrategy": "0.6",
}
BOOSTING_SPARSE_PENALTIES = {"l1": 5.0, "l2": 10.0}
BOOSTING_SERVICE_PENALTIES = {"l1": 0.0, "l2": 1.0}
BOOSTING_SERVICE = {"maxIter": 500, "stepSize": 0.05, "maxDepth": 6, "subsamplingRate": 0.8}
SEARCH_GRID = {
    "numTrees": (200, 300, 400, 500),
    "maxDepth": (3, 4, 5, 6),
    "minInstancesPerNode": (20, 30, 40, 50),
    "featureSubsetStrategy": ("0.3", "0.4", "0.5", "sqrt"),
}
GAP_GOOD, GAP_ACCEPTABLE = 0.10, 0.15
SIGNIFICANCE = 0.05
MIN_DM_DATES, MIN_SUBSET_ROWS, FEW_SHOCKS = 20, 10, 30
