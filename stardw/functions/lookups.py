"""Fixed lookup values.

FIXED VALUES — these must equal the source pipeline's business rules for the
results to match.  They are stated plainly, in their natural order.
"""

# FIXED VALUES: Brazilian state code -> macro region.
STATE_REGION = {
    "AM": "North", "PA": "North", "AC": "North", "RO": "North", "RR": "North", "AP": "North", "TO": "North",
    "MA": "Northeast", "PI": "Northeast", "CE": "Northeast", "RN": "Northeast", "PB": "Northeast",
    "PE": "Northeast", "AL": "Northeast", "SE": "Northeast", "BA": "Northeast",
    "MT": "Center-West", "MS": "Center-West", "GO": "Center-West", "DF": "Center-West",
    "SP": "Southeast", "RJ": "Southeast", "MG": "Southeast", "ES": "Southeast",
    "PR": "South", "SC": "South", "RS": "South",
}
REGION_DEFAULT = "Other"

# FIXED VALUES: category group -> keywords, checked as substrings of the
# lower-cased English category name; the first group (in this order) with a
# matching keyword wins, "Other" otherwise.
CATEGORY_GROUP_KEYWORDS = [
    ("Electronics", ["electronics", "computer", "telephony", "tablet", "console", "game",
                     "audio", "watch", "signal", "portable"]),
    ("Home & Garden", ["furniture", "bed", "bath", "housewares", "home_appliance", "kitchen",
                       "garden", "air_condition", "home_confort", "small_appliance"]),
    ("Fashion", ["fashion", "bag", "clothing", "underwear", "shoe", "luggage", "apparel"]),
    ("Health & Beauty", ["health", "beauty", "perfumery", "diaper", "hygiene"]),
    ("Sports & Leisure", ["sport", "leisure", "toy", "baby", "christmas"]),
    ("Books & Media", ["book", "music", "dvd", "cd", "musical"]),
    ("Food & Drinks", ["food", "drink", "beverage"]),
    ("Auto", ["auto", "vehicle"]),
    ("Construction", ["construction", "tool", "security", "industry", "agro"]),
    ("Art & Craft", ["art", "craft", "stationery", "party"]),
]
GROUP_DEFAULT = "Other"

# FIXED VALUES: age bins, right-closed (lo, hi] -> label.
AGE_BINS = [
    (0, 24, "18-24"), (24, 34, "25-34"), (34, 44, "35-44"),
    (44, 54, "45-54"), (54, 64, "55-64"), (64, 100, "65+"),
]
AGE_OUT_OF_RANGE = "nan"

# FIXED VALUES: simulated attribute ranges (inclusive).
AGE_MIN, AGE_MAX = 18, 70
MALE_PERCENT = 48
SIGNUP_DAYS_MIN, SIGNUP_DAYS_MAX = 60, 730
SELLER_JOIN_DAYS_MIN, SELLER_JOIN_DAYS_MAX = 30, 1095

# FIXED VALUES: tokens a CSV reader must treat as missing (the pandas
# read_csv default set).
CSV_NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# FIXED VALUES: English calendar names (independent of the JVM locale).
MONTH_NAMES = ["January", "February", "March", "April", "May", "June", "July",
               "August", "September", "October", "November", "December"]
WEEKDAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]

# FIXED VALUES: first and last time (whole microseconds) of a 64-bit count of
# nanoseconds around 1970.
TIMESTAMP_RANGE = ("1677-09-21 00:12:43.145225", "2262-04-11 23:47:16.854775")
