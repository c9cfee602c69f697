"""Default word lists, host lists and limits."""

# --- fixed values: they decide results and must stay exactly as given ---------------------

CAPTURE_SNAPSHOTS = [
    "2023-23", "2023-14", "2023-06", "2022-49", "2022-40", "2022-33", "2022-27", "2022-21",
    "2022-05", "2021-49", "2021-43", "2021-39", "2021-31", "2021-25", "2021-21", "2021-17",
    "2021-10", "2021-04",
]
CAPTURE_STATUS, CAPTURE_MIME = "200", "text/html"
CAPTURE_LANGUAGE, CAPTURE_ENCODING = "eng", "UTF-8"

TRUSTED_HOSTS = [
    "www.nbcnews.com", "www.cnn.com", "abcnews.go.com", "apnews.com", "www.dallasnews.com",
    "www.usatoday.com", "www.washingtonpost.com", "news.google.com", "www.foxnews.com",
    "www.cbsnews.com", "www.fox4news.com", "www.nytimes.com", "www.axios.com",
    "www.reuters.com", "www.vox.com", "www.wsj.com", "www.politico.com", "time.com",
    "www.bloomberg.com", "www.forbes.com", "www.reuters.com", "finance.yahoo.com",
    "finance.google.com", "www.linkedin.com", "www.zoominfo.com", "www.sec.gov/edgar.shtml",
    "www.hoovers.com", "www.dnb.com", "www.crunchbase.com", "angel.co", "www.owler.com",
    "pitchbook.com", "en.wikipedia.org",
]
TRUSTED_MIN_HITS = 2
ARTICLE_HOST, ARTICLE_PREFIX = "en.wikipedia.org", "/wiki/"

TERMS_PATTERNS = [
    "terms of use", "terms & conditions", "terms and conditions", "terms of service",
    "user agreement",
]
ABOUT_WORDS = ["about us", "about the team", "meet the team", "our team", "who we are", "about"]
REGION_WORD = "united states"

POPUP_TAGS = ["div", "section", "article", "aside", "main", "footer", "form", "dialog"]
POPUP_WORDS = [
    "terms", "terms of service", "privacy policy", "content warning", "mature content",
    "subscribe", "subscription", "premium", "sign up", "register", "agree", "accept",
    "continue", "confirm", "verify your age", "age verification", "access content",
    "unlock content", "get full access", "limited access", "cookies",
]
POPUP_SELECTORS = [
    ".popup", ".modal", ".overlay", "#popup-container", "#modal-window",
    "#overlay-background", "[role='dialog']", "[aria-modal='true']",
]
ELEMENT_ROLES = ["alertdialog", "alert", "button"]
INTERACTION_WORDS = [
    "login", "sign in", "log in", "username", "password", "email", "enter your email",
    "age verification", "verify your age", "are you 18 or older?", "date of birth", "captcha",
    "i'm not a robot", "create account", "register", "subscription required", "paywall",
    "unlock premium content", "enter your details", "submit", "continue", "accept terms",
    "agree to terms",
]
INTERACTION_SELECTORS = [
    "input[type='password']", "input[type='email']", "input[type='text']",
    "button[type='submit']", "a[href*='login']", "a[href*='signup']", "div[role='dialog']",
    "iframe",
]

STYLE_EXTENDER = {"L2 answer": "answer"}
STYLE_LENGTH = 100

CHUNK_CHARS = 2048
HOME_PREFIX = "Home Page of the company | "
DOMAIN_CAP, DEPTH_LIMIT, IDLE_SECONDS = 10, 4, 6
SCORE_NAMES = [
    "faithfulness", "context_precision", "groundedness", "factual_correctness",
    "instruction_critic",
]
LUMA = (0.299, 0.587, 0.114)

PROMPT_TEMPLATE = (
    "\n    Please summarize the following text in a clear, well-organized, and "
    "easy-to-understand manner:\n    Content: {content}\n    Summary: {summary}\n    "
)
# ------------------------------------------------------------------------------------------

# --- fixed values: texts of the comparison report ---
TOO_FEW = "Insufficient data (need >=%s samples per group, got %s vs %s)"
NO_DATA = "No valid data found for any system for this metric."
NO_OTHERS = (
    "%s has the highest median (%.3f), but no other systems had valid data for comparison on this metric.")
HIGHER = "%s median (%.3f) is significantly higher than all other comparable systems (p < %s)."
NOT_HIGHER = (
    "%s has the highest median (%.3f), but was not significantly higher than all comparable systems "
    "(alpha=%s). Check details.")
