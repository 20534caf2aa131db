"""Patterns, word lists and message texts.

These decide which messages match, so they must stay exactly as they are for results
to agree with tables that already exist. Java regex syntax; all but the lookaround in
``POSTAL_CODE_IN_TEXT`` is also valid RE2.
"""

# --- request classification, matched on lower(trim(message)) ---
BIKER_PILLION = r"^(?:bikers?\s+looking\s+(?:for\s+)?pillions?|pillions?\s+looking\s+(?:for\s+)?bikers?)\b"
DRIVER_LOOKING = r"\bdrivers?\s+looking\s+(?:for\s+)?(?:hitchers?|passengers?)\b"
LOOKING_FOR_PASSENGER = r"\blooking\s+for\s+passengers?\b"
VEHICLE = r"(?:接送服务|\bwhole\s+car\b|\b[5-9]\s*seater\b)"
PICKUP_WORD = r"\b(?:pick\s*up|pickup)\b"
DROP_WORD = r"\b(?:drop\s*off|dropoff|drop)\b"
HITCHER_LOOKING = r"\bhitchers?\s+looking\s+(?:for\s+)?drivers?\b"
LOOKING_FOR_DRIVER = r"\blooking\s+for\s+drivers?\b"

# --- labelled lines, matched on the message as posted ---
PICKUP_LINE = r"(?im)^\s*(?:pick\s*up(?:\s+(?:point|location))?|pickup(?:\s+(?:point|location))?|from)\s*:\s*([^\r\n]+)"
DROPOFF_LINE = r"(?im)^\s*(?:drop\s*off(?:\s+(?:point|location))?|dropoff(?:\s+(?:point|location))?|destination|to)\s*:\s*([^\r\n]+)"
TIME_LINE = r"(?im)^\s*(?:time|when|pickup\s+time)\s*:\s*([^\r\n]+)"

# --- passenger counts ---
PAX_AFTER_LABEL = r"(?i)\bpax\s*:?\s*(\d{1,2})\b"
PAX_BEFORE_LABEL = r"(?i)\b(\d{1,2})\s*(?:pax|passengers?)\b"
PAX_RANGE_LOW = r"(?i)\bpax\s*:?\s*(\d{1,2})\s*[-–]\s*\d{1,2}\b"
PAX_RANGE_HIGH = r"(?i)\bpax\s*:?\s*\d{1,2}\s*[-–]\s*(\d{1,2})\b"
WHOLE_CAR = r"\bwhole\s+car\b"
PAX_UNKNOWN = r"\bpax\s*:?\s*(?:-|nil|n/?a|tbc)(?:\s|$)"
PAX_UNLABELLED_RANGE = r"\b\d{1,2}\s*[-–]\s*\d{1,2}\s*(?:pax|passengers?)\b"

# --- places ---
FLAG_LETTERS = "[🇸🇬🇲🇾]"
TRAILING_DOTS = r"\.+$"
JB_TO_SG = r"^jb(?:\s|[/→👉🇲🇾🇸🇬-])*sg\s*$"
SG_TO_JB = r"^sg(?:\s|[/→👉🇲🇾🇸🇬-])*jb\s*$"
WHITESPACE_RUN = r"\s+"
SIX_DIGITS = r"^[0-9]{6}$"
ALL_DIGITS = r"^[0-9]+$"
POSTAL_CODE_IN_TEXT = r"(?<![0-9])([0-9]{6})(?![0-9])"
HAS_POSTAL_CODE = r"(^|[^0-9])[0-9]{6}([^0-9]|$)"
HAS_TWO_POSTAL_CODES = r"(^|[^0-9])[0-9]{6}([^0-9].*)?[0-9]{6}([^0-9]|$)"
SEARCH_SUFFIX = (
    r"\s+(?:side\s+entrance|main\s+entrance|drop\s*off\s+point|"
    r"pick\s*up\s+point|pickup\s+point|taxi\s+stand|hotel|entrance|lobby)$"
)
MALAYSIA_TEXT = "(JB|JOHOR|MALAYSIA|MY)"

NON_SPECIFIC_PLACES = [
    "any", "any where", "anywhere", "east", "jb", "johor", "johor bahru", "n/a", "na",
    "nil", "north", "not sure", "sg", "singapore", "south", "tbc", "west",
]
NON_SPECIFIC_REASON = "Non-specific or non-Singapore location"
NO_EXACT_POSTAL_REASON = "OneMap returned no exact result for postal code "
OVERRIDE_NOTE = "Town-level override to OneMap MRT station search: "

# Towns whose override is their own station: the query is "<Town> MRT Station".
STATION_TOWNS = [
    "admiralty", "aljunied", "ang mo kio", "bedok", "bishan", "boon lay", "bukit batok",
    "bukit panjang", "buona vista", "canberra", "changi airport", "chinatown",
    "choa chu kang", "city hall", "clementi", "commonwealth", "dhoby ghaut", "dover",
    "eunos", "expo", "farrer park", "holland village", "hougang", "jurong east",
    "kallang", "kovan", "lakeside", "lavender", "little india", "marsiling", "newton",
    "novena", "orchard", "outram park", "pasir ris", "paya lebar", "pioneer",
    "potong pasir", "punggol", "queenstown", "redhill", "sembawang", "sengkang",
    "serangoon", "simei", "tampines", "tanjong pagar", "toa payoh", "woodlands",
    "yew tee", "yio chu kang", "yishun",
]
