"""FIXED VALUES.

Lists, codes and patterns whose exact content decides results.  They are
stated here once, in their natural order, and used by the rules in
``scalars.py`` / ``periods.py``.
"""

# Filing index: filename prefix a valid line must carry.
INDEX_FILENAME_PREFIX = "edgar/data/"
INDEX_FIELDS = ["cik", "company_name", "form_type", "filing_date", "filename"]
INDEX_HEADER = "CIK|Company Name|Form Type|Date Filed|Filename"

# Country codes searched in geography text and series ids, with the name each
# maps to (source order).
COUNTRY_CODES = [
    ("US", "United States"),
    ("USA", "United States"),
    ("AUS", "Australia"),
    ("CAN", "Canada"),
    ("CHN", "China"),
    ("DEU", "Germany"),
    ("FRA", "France"),
    ("GBR", "United Kingdom"),
    ("ITA", "Italy"),
    ("JPN", "Japan"),
    ("MEX", "Mexico"),
    ("BRA", "Brazil"),
    ("IND", "India"),
    ("KOR", "South Korea"),
    ("RUS", "Russia"),
    ("ZAF", "South Africa"),
]
DEFAULT_COUNTRY = "United States"

# Two-letter state suffixes that also mean the default country.
US_STATES = [
    "AL", "AK", "AZ", "AR", "CA", "CO", "CT", "DE", "FL", "GA",
    "HI", "ID", "IL", "IN", "IA", "KS", "KY", "LA", "ME", "MD",
    "MA", "MI", "MN", "MS", "MO", "MT", "NE", "NV", "NH", "NJ",
    "NM", "NY", "NC", "ND", "OH", "OK", "OR", "PA", "RI", "SC",
    "SD", "TN", "TX", "UT", "VT", "VA", "WA", "WV", "WI", "WY",
]

# Labour-statistics survey from a series-id prefix, checked in this order.
SURVEY_PREFIXES = [
    (("CUUR", "CUUS"), "CU"),
    (("SUUR",), "SU"),
    (("WPU", "PCU"), "WP"),
    (("CES", "CEU"), "CE"),
    (("LNS",), "LN"),
    (("IWP",), "IW"),
    (("EWP",), "EW"),
]
SURVEY_UNKNOWN = "Unknown"

# Row labels of analyst tables -> field, first match wins.  Each rule is a
# list of alternatives; an alternative is a tuple of words that must all be
# contained in the lower-cased label.
EPS_REVISION_RULES = [
    ("up_last_7_days", [("up", "7"), ("up", "seven")]),
    ("up_last_30_days", [("up", "30"), ("up", "thirty")]),
    ("down_last_7_days", [("down", "7"), ("down", "seven")]),
    ("down_last_30_days", [("down", "30"), ("down", "thirty")]),
]
REVENUE_ESTIMATE_RULES = [
    ("num_analysts", [("number", "analyst")]),
    ("avg_estimate", [("avg",), ("average",), ("mean",)]),
    ("low_estimate", [("low",), ("min",)]),
    ("high_estimate", [("high",), ("max",)]),
    ("year_ago_sales", [("year", "ago")]),
    ("sales_growth", [("growth",)]),
]

# As-of date patterns on page text, in order (case-insensitive search).
ASOF_PATTERNS = [
    r"As of\s+(\d{1,2}[/-]\d{1,2}[/-]\d{2,4})",
    r"as of\s+(\d{1,2}[/-]\d{1,2}[/-]\d{2,4})",
    r"Date:\s*(\d{1,2}[/-]\d{1,2}[/-]\d{2,4})",
    r"(\d{1,2}[/-]\d{1,2}[/-]\d{2,4})",
]

# Header aliases for fund table rows: field -> aliases (field order matters
# only for output column order; each field takes the first header that
# contains any alias).
HEADER_ALIASES = [
    ("ticker", ["ticker", "symbol", "ticker symbol"]),
    ("name", ["name", "fund name", "etf name", "product name"]),
    ("asset_class", ["asset class", "asset", "category"]),
    ("expense_ratio", ["expense ratio", "exp ratio", "er", "fee"]),
    ("total_net_assets", ["total net assets", "aum", "assets", "net assets", "tna"]),
    ("ytd_return", ["ytd", "ytd return", "year to date"]),
    ("one_year_return", ["1 year", "1yr", "one year", "1-year"]),
    ("three_year_return", ["3 year", "3yr", "three year", "3-year"]),
    ("five_year_return", ["5 year", "5yr", "five year", "5-year"]),
    ("ten_year_return", ["10 year", "10yr", "ten year", "10-year"]),
    ("inception_date", ["inception", "inception date", "start date"]),
    ("primary_benchmark", ["benchmark", "index", "primary benchmark"]),
]

# Fund links worth following.
FUND_LINK_MARKERS = ["/us/products/", "/funds/"]

# Key/value table header words that are not data.
KV_HEADER_WORDS = ["", "key", "field"]

# Regime names by number of states.
REGIME_NAMES = {
    2: ["Expansion", "Contraction"],
    3: ["Expansion", "Peak", "Contraction"],
    4: ["Expansion", "Peak", "Contraction", "Trough"],
}
REGIME_FALLBACK_PREFIX = "Regime_"

# Source fields of the valuation table (source name -> column).
VALUATION_FIELDS = [
    ("marketCap", "market_cap"),
    ("enterpriseValue", "enterprise_value"),
    ("trailingPE", "trailing_pe"),
    ("forwardPE", "forward_pe"),
    ("pegRatio", "pegratio_5y"),
    ("priceToSalesTrailing12Months", "price_sales"),
    ("priceToBook", "price_book"),
    ("enterpriseToRevenue", "ev_revenue"),
    ("enterpriseToEbitda", "ev_ebitda"),
]

# Fund-list keys tried in order when a payload is an object.
FUND_LIST_KEYS = ["funds", "products", "etfs", "data", "items"]

# Indicator panels.
KEY_MACRO_SERIES = ["GDP", "UNRATE", "CPIAUCSL", "FEDFUNDS", "INDPRO", "PAYEMS", "UMCSENT"]
GDP_COMPONENT_SERIES = ["GDP", "GDPC1", "PCECC96", "GPDIC1", "GCEC1", "NETEXP"]
