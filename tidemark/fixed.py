"""Sizes, word lists, patterns and formats that results depend on.

Everything here is data. Functions take these as default arguments, so a
caller can override any of them.
"""

# --- Fixed values: text preparation ---------------------------------------
TARGET_CHARS = 2000
OVERLAP_CHARS = 200
MIN_CHARS = 50
TITLE_CHARS = 120
UNTITLED_SESSION = "(untitled session)"
TOOL_ARGS_CHARS = 200
TOOL_RESULT_CHARS = 500
PREVIEW_TITLE_CHARS = 60
PREVIEW_TEXT_CHARS = 120

# --- Fixed values: sources --------------------------------------------------
SESSION_KIND = "claude_session"
NOTE_KIND = "manual_note"
EMPTY_CONTENT = "empty_content"
NOT_FOUND = "not_found"
NOTE_STATUS = "saved; embedding queued (rag-worker will backfill within ~2s)"

# --- Fixed values: secret shapes (published key formats) --------------------
SECRET_PATTERNS = (
    ("anthropic", r"\bsk-ant-[A-Za-z0-9_-]{20,}"),
    ("openai", r"\bsk-(?:proj-)?[A-Za-z0-9_-]{20,}"),
    ("voyage", r"\bpa-[A-Za-z0-9_-]{20,}"),
    ("github", r"\bgh[pousr]_[A-Za-z0-9]{36,}"),
    ("github_pat", r"\bgithub_pat_[A-Za-z0-9_]{22,}"),
    ("aws", r"\b(?:AKIA|ASIA)[0-9A-Z]{16}\b"),
    ("jwt", r"\beyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    ("hex", r"[0-9a-fA-F]{32,}"),
)
SECRET_MARKS = (
    "sk-", "pa-", "ghp_", "gho_", "ghu_", "ghs_", "ghr_", "github_pat_", "AKIA", "ASIA", "eyJ",
)
REDACTED = "[REDACTED]"

# --- Fixed values: retrieval ------------------------------------------------
RRF_K = 60
SEARCH_LIMIT_MAX = 50
SOURCES_LIMIT_MAX = 200
OVERFETCH = 2
SCORE_PLACES = 4
IVF_LISTS = 100
RANK_WEIGHT = 0.1
RANK_NORM = 1.64493406685
BM25_K1 = 1.2
BM25_B = 0.75

# --- Fixed values: embedding ------------------------------------------------
EMBED_BATCH = 64
BACKFILL_BATCH = 32
FIFO_BATCH = 15

# --- Fixed values: events ---------------------------------------------------
BOT_PATTERN = (
    "(?i)bot|crawl|spider|slurp|preview|monitor|curl|wget|python-|httpx|headless|"
    "facebookexternal|whatsapp|telegram|lighthouse|pingdom|uptime|google-"
)
BATCH_EVENTS = 50
JSON_CHARS = 8000
APP_CHARS = 64
NAME_CHARS = 128
UA_CHARS = 256
IDENTIFY = "$identify"
PURCHASE = "purchase"
ALERT_FORMAT = "\U0001F4B0 **결제** `%s` — %s / %s원 (user %s)"
FUNNEL_STEPS = ("signup", "activate", "app_open", "purchase")

# --- Fixed values: listings -------------------------------------------------
GEOHASHES = (
    "wydm9", "wydmc", "wydmd", "wydme", "wydmf", "wydmg", "wydq1", "wydq4", "wydq5",
)
AREA_NAMES = {
    "11290": "성북",
    "11230": "동대문",
    "11140": "중구",
    "11200": "성동",
    "11305": "강북",
}
OTHER_AREA = "기타"
SALES_TYPE = "월세"
ROOM_TYPES = ("투룸", "쓰리룸")
OFFICETEL = "오피스텔"
DEPOSIT_MAX = 3000
TOTAL_RENT_MIN = 80
TOTAL_RENT_MAX = 120
WOMEN_ONLY = ("여성전용", "여성 전용", "여자전용", "여성만", "여자만")
OPEN = "open"
DAYS = 14
LOCAL_ZONE = "Asia/Seoul"

# --- Fixed values: daily brief ----------------------------------------------
TITLE_EXCLUDES = (
    "채용", "구인", "모집", "후원", "광고", "이벤트", "할인", "프로모션", "출시 기념",
)
TOP_N = 5
TOP_SEARCHES = 8
TOP_PRODUCTS = 6
TOP_READS = 6
ITEMS_PER_FEED = 4
NEWS_PER_SEARCH = 2
MAX_PAGES = 4
BODY_MIN_CHARS = 40
BODY_CHARS = 2400
README_CHARS = 2000
SHORT_DESCRIPTION = 30
TAGLINE_CHARS = 200
REPO_HOST = "https://github.com/"
README_BRANCHES = ("main", "master")
README_NAMES = ("README.md", "readme.md", "README.rst")
SERIES_MIN_POINTS = 6
SERIES_SIDE_POINTS = 3
MOMENTUM_PCT = 12
MOVERS_UP = 3
MOVERS_DOWN = 2
PROMPT_READS = 8
PROMPT_SEARCHES = 8
PROMPT_NAMES = 5
PROMPT_PRODUCTS = 6
PROMPT_EMPTY = "(없음)"
MESSAGE_CHARS = 3900
RECENT_DATES = 30
HEADINGS = {
    "ideas": "💡 <b>오늘의 마케팅 인사이트</b>",
    "reads": "📣 <b>마케팅 읽을거리</b>",
    "segments": "📊 <b>세그먼트별 관심사 추이</b>",
    "searches": "🔥 <b>오늘 한국 실시간 검색</b>",
    "products": "🚀 <b>Product Hunt</b>",
    "topics": "📰 <b>GeekNews · 어제</b>",
    "repos": "🐙 <b>GitHub Trending · Python</b>",
}

# --- Fixed values: feed and markup patterns ---------------------------------
FEED_FIELD = r"(?s)<{0}>(.*?)</{0}>"
FEED_TRAFFIC = r"<ht:approx_traffic>(.*?)</ht:approx_traffic>"
FEED_CONTENT = r"(?s)<content[^>]*>(.*?)</content>"
FEED_LINK = r"""<link[^>]*rel="alternate"[^>]*href="([^"]+)\""""
FEED_PARAGRAPH = r"(?s)<p>(.*?)</p>"
CDATA = r"(?s)<!\[CDATA\[(.*?)\]\]>"
TAG = r"<[^>]+>"

# --- Fixed values: snapshots ------------------------------------------------
RETENTION_DAYS = 7

# Largest file that is read as one value, and the size of the parts of larger ones.
DOCUMENT_BYTES = 1 << 30
DOCUMENT_PART_BYTES = 16 << 20
