"""Word lists, lookup tables, limits and patterns of the retail domain.

They have to be exactly these for results to be right, so they are kept
together here and referenced everywhere else.
"""

# --- feeds -----------------------------------------------------------------

BASE_CURRENCY = "USD"

# Quote currencies kept from a rates document.
TARGET_CURRENCIES = [
    "EUR", "GBP", "INR", "AED", "SGD", "JPY", "AUD", "CAD", "CHF", "CNY",
    "HKD", "KRW", "MYR", "THB", "SAR", "QAR", "BRL", "MXN", "ZAR", "NZD",
]

# (city, country, latitude, longitude); a weather answer lists cities in this order.
CITIES = [
    ("Mumbai", "IN", 19.0760, 72.8777),
    ("Delhi", "IN", 28.7041, 77.1025),
    ("New York", "US", 40.7128, -74.0060),
    ("London", "GB", 51.5074, -0.1278),
    ("Dubai", "AE", 25.2048, 55.2708),
    ("Singapore", "SG", 1.3521, 103.8198),
    ("Sydney", "AU", -33.8688, 151.2093),
    ("Tokyo", "JP", 35.6762, 139.6503),
    ("Paris", "FR", 48.8566, 2.3522),
    ("Frankfurt", "DE", 50.1109, 8.6821),
]

# WMO weather interpretation codes.
WEATHER_CODES = [
    (0, "Clear sky"), (1, "Mainly clear"), (2, "Partly cloudy"), (3, "Overcast"),
    (45, "Fog"), (48, "Depositing rime fog"),
    (51, "Light drizzle"), (53, "Moderate drizzle"), (55, "Dense drizzle"),
    (61, "Slight rain"), (63, "Moderate rain"), (65, "Heavy rain"),
    (71, "Slight snow"), (73, "Moderate snow"), (75, "Heavy snow"),
    (80, "Slight showers"), (81, "Moderate showers"), (82, "Violent showers"),
    (95, "Thunderstorm"), (96, "Thunderstorm with hail"), (99, "Heavy thunderstorm"),
]
UNKNOWN_WEATHER = "Unknown"
MISSING_WEATHER_CODE = -1

# --- domains ---------------------------------------------------------------

ORDER_STATUSES = [
    "pending", "processing", "shipped", "out_for_delivery",
    "delivered", "cancelled", "returned", "refunded",
]
STATUSES_WITHOUT_REVENUE = ["cancelled", "refunded"]
ORDER_CHANNELS = ["mobile_app", "web", "in_store", "third_party"]
PAYMENT_METHODS = ["credit_card", "debit_card", "upi", "net_banking", "wallet", "cod"]
ORDER_CURRENCIES = ["USD", "EUR", "GBP", "INR", "AED", "SGD"]
CUSTOMER_TIERS = ["bronze", "silver", "gold", "platinum"]
GENDERS = ["male", "female", "non_binary", "prefer_not_to_say"]
SUSPENDED = "suspended"

# Commission share by seller category.
COMMISSION_RATES = {
    "Electronics": 0.08, "Clothing": 0.12, "Groceries": 0.05, "Home": 0.10,
    "Beauty": 0.13, "Sports": 0.10, "Books": 0.07, "Toys": 0.11,
}

# Stock range (least, most units) by product category, and the share of the
# range under which stock counts as low.
STOCK_RANGES = {
    "Electronics": (10, 300), "Clothing": (20, 500), "Groceries": (50, 2000),
    "Home": (5, 200), "Beauty": (30, 800), "Sports": (10, 400),
    "Books": (5, 1000), "Toys": (10, 600),
}
LOW_STOCK_SHARE = 0.10

# (code, name, region, symbol)
CURRENCIES = [
    ("USD", "US Dollar", "United States", "$"),
    ("EUR", "Euro", "European Union", "€"),
    ("GBP", "British Pound", "United Kingdom", "£"),
    ("INR", "Indian Rupee", "India", "₹"),
    ("AED", "UAE Dirham", "UAE", "AED"),
    ("SGD", "Singapore Dollar", "Singapore", "SGD"),
    ("JPY", "Japanese Yen", "Japan", "¥"),
    ("AUD", "Australian Dollar", "Australia", "AUD"),
    ("CAD", "Canadian Dollar", "Canada", "CAD"),
    ("CHF", "Swiss Franc", "Switzerland", "CHF"),
    ("CNY", "Chinese Yuan", "China", "CNY"),
    ("HKD", "Hong Kong Dollar", "Hong Kong", "HKD"),
    ("KRW", "South Korean Won", "South Korea", "KRW"),
    ("MYR", "Malaysian Ringgit", "Malaysia", "MYR"),
    ("THB", "Thai Baht", "Thailand", "THB"),
    ("SAR", "Saudi Riyal", "Saudi Arabia", "SAR"),
    ("QAR", "Qatari Riyal", "Qatar", "QAR"),
    ("BRL", "Brazilian Real", "Brazil", "BRL"),
    ("MXN", "Mexican Peso", "Mexico", "MXN"),
    ("ZAR", "South African Rand", "South Africa", "ZAR"),
    ("NZD", "New Zealand Dollar", "New Zealand", "NZD"),
]
DEFAULT_CURRENCY = "USD"
DEFAULT_RATE = 1.0
UNKNOWN_KEY = -1

# --- bands: (edges, labels, label beyond the last edge) ---------------------

ORDER_VALUE_BAND = ([100, 500, 2000], ["low", "medium", "high"], "premium")
PRICE_BAND = ([20, 100, 500], ["budget", "mid-range", "premium"], "luxury")
ACCOUNT_AGE_SEGMENT = ([90, 365, 730], ["new", "growing", "established"], "loyal")
SPEND_SEGMENT = ([100, 500, 2000], ["low", "medium", "high"], "vip")
# These two are read from the top edge down.
SELLER_TIER = ([4.5, 4.0, 3.5], ["platinum", "gold", "silver"], "bronze")
FULFILLMENT_BAND = ([95, 85, 70], ["excellent", "good", "average"], "poor")

# --- quality limits ---------------------------------------------------------

MIN_SELLERS = 90
MIN_PAIRS = 20
REQUIRED_CURRENCIES = ["EUR", "GBP", "INR", "JPY", "AUD", "AED", "SGD"]
RATING_RANGE = (1.0, 5.0)
FULFILLMENT_RANGE = (0, 100)
TEMPERATURE_RANGE = (-90.0, 60.0)
HUMIDITY_RANGE = (0, 100)

# --- patterns ---------------------------------------------------------------

HONORIFIC_PREFIX = r"(?i)^(dr\.|mr\.|mrs\.|ms\.|prof\.|rev\.|sir\.?)\s+"
NAME_SUFFIX = r"(?i)\s+(jr\.?|sr\.?|md|phd|ii|iii|iv|esq\.?)$"
EMAIL = r"^[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}$"
COUNTRY_PREFIX = r"^(?:\+|00)(\d{1,3})[\s\-]"
PHONE_PREFIXES = r"^(?:\+\d{1,3}[\s\-])?(?:00\d{1,3}[\s\-])?"
EXTENSION_OR_PUNCTUATION = r"(?i)x\d+$|\D"
X_EXTENSION = r"(?i)x\d+$"
WORD_EXTENSION = r"(?i)ext\.?\s*\d+$"
