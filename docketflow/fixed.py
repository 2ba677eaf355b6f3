"""Texts, names, patterns and formats that results depend on literally."""

# Forms, months, quarters.
ANNUAL_FORMS = ("10-K", "10-K/A")
MONTH_NAMES = (
    "Jan", "Feb", "Mar", "Apr", "May", "Jun",
    "Jul", "Aug", "Sept", "Oct", "Nov", "Dec",
)
QUARTERS = ("QTR1", "QTR2", "QTR3", "QTR4")

# Listings: file names, column bounds of the fixed layout, header length, lines without
# data, the date of a rule line.
PERIOD_NAME = r"(?i)(\d{4})_(QTR[1-4])_company\.idx$"
FIXED_BOUNDS = ((0, 62), (62, 74), (74, 86), (86, 98), (98, None))
HEADER_LINES = 9
RULE_START = "-----"
HEADING_START = "company name"
SENTINEL_DATE = "------------"

# Addresses.
SITE = "https://www.sec.gov"
VIEWER = "https://www.sec.gov/ix?doc="
LISTING_BASE = "https://www.sec.gov/Archives/edgar/full-index/"
DOCUMENT_SUFFIX = r"(?i)\.(txt|htm|html)\z"

# Pages: elements whose text does not count, the first of raw text, class of the table that lists documents.
RAW_ELEMENTS = ("script", "style")
DROPPED_ELEMENTS = ("header", "footer", "nav", "noscript")
TABLE_CLASS = "tableFile"

# Outcomes.
SUCCESS = "✅ Success"
SUCCESS_DIRECT = "✅ Success (direct)"
SUCCESS_INDEX = "✅ Success (index)"
NO_FILENAME = "❌ Missing or invalid Filename"
FETCH_FAILED = "❌ Filing fetch failed: "
INDEX_FAILED = "❌ Index fetch failed: "
INVALID_PATH = "⚠️ Invalid path: "
NO_TABLE = "⚠️ No document table found"
NO_LINK = "⚠️ No primary .htm/.html link found"
EXCEPTION = "⚠️ Exception: "

# Text: what stripping removes, what ends a line. Spark's own trim knows only the space.
WHITESPACE_CHARS = (
    "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
LINE_BREAK = r"[\n\x0b\f\r\x1c\x1d\x1e\x85\u2028\u2029]"

# Dates: the whole years a 64-bit nanosecond clock can hold, 1678 to 2261; the accepted
# layouts with what each becomes; month names.
CLOCK_YEARS = r"(?:167[89]|16[89]\d|1[7-9]\d\d|2[01]\d\d|22[0-5]\d|226[01])"
MONTH_WORD = (
    "(?:Jan(?:uary)?|Feb(?:ruary)?|Mar(?:ch)?|Apr(?:il)?|May|June?|July?|Aug(?:ust)?|Sep(?:tember)?"
    "|Oct(?:ober)?|Nov(?:ember)?|Dec(?:ember)?)"
)
DATE_LAYOUTS = (
    (r"^(\d{1,2})/(\d{1,2})/(\d{4})$", "$3-$1-$2"),
    (r"^(\d{1,2})/(\d{1,2})/(69|[7-9]\d)$", "19$3-$1-$2"),
    (r"^(\d{1,2})/(\d{1,2})/([0-5]\d|6[0-8])$", "20$3-$1-$2"),
    (r"^(\d{4})/(\d{1,2})/(\d{1,2})$", "$1-$2-$3"),
    (r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3"),
    (r"^(\d{4})-(\d{1,2})$", "$1-$2-1"),
    (
        r"^(\d{4}-\d{2}-\d{2})[T ](?:[01]\d|2[0-3]):[0-5]\d(?::[0-5]\d(?:\.\d+)?)?"
        r"(?: ?Z|[+-]\d{2}:?\d{2})?$",
        "$1",
    ),
    (rf"(?i)^({MONTH_WORD}) (\d{{1,2}}),? (\d{{4}})$", "$3-$1-$2"),
    (rf"(?i)^(\d{{1,2}})[ -]({MONTH_WORD})[ -](\d{{4}})$", "$3-$2-$1"),
)
NAMED_MONTH = rf"(?i)^{CLOCK_YEARS}-{MONTH_WORD}-\d{{1,2}}$"

# Years: what counts as a number.
PLAIN_NUMBER = r"^[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?$"
