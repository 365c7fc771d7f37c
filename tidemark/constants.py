"""Fixed values of the data contract.

Everything in this module is a fixed value: results depend on these exact numbers, names and
patterns, so they are stated plainly here and nowhere else. No logic lives in this module.
"""

from __future__ import annotations

# --- limits -------------------------------------------------------------------------------
TEXT_CHAR_CAP = 8000
TITLE_CHAR_CAP = 200
TEXT_CHAR_FLOOR = 50
JUNK_RATIO_CAP = 0.5
RELEVANCE_FLOOR = 0.3
MIN_FIT_CHARS = 200
MIN_RAW_CHARS = 800
LINKS_PER_SITE = 100
BLOCK_SCAN_CHARS = 4000
PREVIEW_CHARS = 200
ERROR_CHAR_CAP = 500

# --- vectors, chunks, search --------------------------------------------------------------
EMBEDDING_DIM = 384
MAX_TOKENS = 512
CHUNK_TOKENS = 512
CHUNK_OVERLAP = 64
SEARCH_THRESHOLD = 0.5
SEARCH_MIN_ARTICLES = 10
SEARCH_TOP_K = 20
TITLE_SIMILARITY = 0.95
TITLE_MIN_CHARS = 8

# --- drift --------------------------------------------------------------------------------
DRIFT_WINDOW = 3
DRIFT_DROP = 0.5

# --- names --------------------------------------------------------------------------------
ID_SEPARATOR = "\x1f"
LANDING_PREFIX = "market_data_"
LAYERS = ("bronze", "silver", "gold", "_quality", "_pipeline")
RUN_STATUSES = ("success", "partial", "fail")

# --- crawl sites --------------------------------------------------------------------------
SITES = (
    {
        "url": "https://www.cnbc.com/markets/",
        "url_patterns": ("*/2025/*", "*/2026/*", "*/video/2025/*", "*/video/2026/*"),
        "include_external": False,
    },
    {
        "url": "https://www.investing.com/news/stock-market-news",
        "url_patterns": ("*/news/*-news/*", "*/analysis/*"),
        "include_external": False,
    },
    {
        "url": "https://finviz.com/news.ashx",
        "url_patterns": ("*",),
        "include_external": True,
    },
)

# --- patterns (Java dialect; WS is what Python calls whitespace) ----------------------------
WS = r"\s\x1c-\x1f"
LINE_BREAK = r"\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029"

URL_OR_LINK = rf"\[[^\]]*\]\([^)]+\)|https?://[^{WS}]+|www\.[^{WS}]+"

# A phrase comes with fragments: pieces of every match of it, in lower case, without the letters
# that have case variants outside ASCII (i, k, s).
_GAP = rf"(?U:[{WS}])+"
ERROR_PHRASES = (
    (rf"oops[,!]?(?U:[{WS}])*something{_GAP}went{_GAP}wrong", ("oop", "wrong")),
    (rf"temporarily{_GAP}down{_GAP}for{_GAP}maintenance", ("temporar", "down")),
    (rf"access{_GAP}denied", ("acce", "den")),
    (rf"page{_GAP}not{_GAP}found", ("page", "not", "found")),
    (rf"404(?<!(?U:\w)404){_GAP}not{_GAP}found(?!(?U:\w))", ("404", "not", "found")),
    (rf"sign{_GAP}in{_GAP}to{_GAP}(?:read|continue)", ("gn", "to")),
    (rf"subscribe{_GAP}to{_GAP}(?:read|continue)", ("ub", "cr", "be", "to")),
)

DATE_FORMS = (
    r"\b(\d{4}-\d{2}-\d{2})\b",
    rf"\b((?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]*[{WS}]+\d{{1,2}},?[{WS}]+\d{{4}})\b",
    r"\b(\d{1,2}/\d{1,2}/\d{4})\b",
)

BLOCK_PHRASES = (
    (r"are you a (?:human|robot)", ("are you a ",)),
    (r"verifying you are human", ("ng you are human",)),
    (r"access denied", ("acce", "den")),
    (r"oops, something went wrong", ("oop", "ng went wrong")),
    (r"please enable (?:js|javascript)", ("plea", "e enable ")),
    (r"unsupported browser", ("upported brow",)),
    (r"captcha", ("captcha",)),
    (r"cloudflare", ("cloudflare",)),
)

NAV_PHRASES = (
    (r"skip to (?:navigation|main content|right column)", ("p to ",)),
    (r"sign in", ("gn ",)),
    (r"subscribe", ("ub", "cr", "be")),
    (r"shopping\.", ("hopp", "ng.")),
    (r"newsletters", ("new", "letter")),
    (r"horoscope", ("horo", "cope")),
    (r"games", ("game",)),
)
