"""Fixed values.

Everything in this module must equal the values the original feed tools use
for results to match: word lists, default texts, prefixes, patterns, limits.
They are stated here once, plainly and in their natural order; all other
modules import them from here.
"""

# --- fixed values: keyword statistics -------------------------------------
# Stop words of the keyword extractor, in their original order.
STOP_WORDS = [
    "the", "is", "at", "which", "and", "or", "in", "to", "for", "of",
    "with", "by", "on", "this", "that", "our", "method", "based",
    "towards", "via", "multi", "text", "using", "aware", "data", "from",
    "paper", "propose", "proposed", "approach", "model", "system",
    "framework", "results", "show", "demonstrates", "experimental",
    "experiments", "evaluation", "performance", "state", "art", "sota",
    "dataset", "datasets", "task", "tasks", "learning", "neural",
    "network", "networks", "deep", "machine", "artificial", "intelligence",
    "ai", "ml", "dl",
]
MAX_PHRASE_WORDS = 3          # candidate phrases have at most 3 words
MIN_WORD_CHARS = 3            # every word of a candidate is longer than 2 chars
PHRASE_WEIGHT = 1.5           # multi-word candidates weigh 1.5
TERMS_PER_TITLE = 10          # top terms kept per title
CLOUD_TOP = 30                # keywords in the cloud
TREND_TOP = 10                # keywords in the trend chart
CLOUD_MIN_SIZE = 12           # cloud weight = clamp(count * 3, 12, 50)
CLOUD_MAX_SIZE = 50
CLOUD_FACTOR = 3

# --- fixed values: search and ranking --------------------------------------
KEYWORD_REASON_PREFIX = "关键词: "   # "keywords: "
AUTHOR_REASON_PREFIX = "作者: "      # "authors: "
TEXT_REASON_PREFIX = "文本: "        # "text: "
REASON_TERM_SEPARATOR = ", "
REASON_KIND_SEPARATOR = " | "
VIEW_AUTHOR_SEPARATOR = ", "         # authors joined for display / matching
DIGEST_AUTHOR_SEPARATOR = ","        # authors joined in the Markdown digest
AUTHORS_SHOWN_IN_FULL = 4            # more than 4: first 2, "...", last 2
AUTHORS_HEAD = 2
AUTHORS_TAIL = 2
AUTHOR_ELLIPSIS = "..."
HIGHLIGHT_CLASS = "highlight-match"
AUTHOR_HIGHLIGHT_CLASS = "author-highlight"
ALL_CATEGORIES = "all"
ABS_URL_PREFIX = "https://arxiv.org/abs/"
PDF_URL_PREFIX = "https://arxiv.org/pdf/"

# --- fixed values: files and languages -------------------------------------
ENRICHED_FILE_PATTERN = r"(\d{4}-\d{2}-\d{2})_AI_enhanced_(English|Chinese)\.jsonl"
ENRICHED_FILE_MIDDLE = "_AI_enhanced_"
FEED_FILE_SUFFIX = ".jsonl"
LANGUAGES = ["English", "Chinese"]
LIST_PAGE_LANGUAGE = "Chinese"        # list page: preferred and fallback
STATS_PAGE_LANGUAGE = "English"       # statistics page: preferred and fallback

# --- fixed values: look-back de-duplication --------------------------------
LOOKBACK_DAYS = 7
STATUS_HAS_NEW = "has_new_content"
STATUS_NO_NEW = "no_new_content"
STATUS_NO_DATA = "no_data"
STATUS_ERROR = "error"

# --- fixed values: enrichment ----------------------------------------------
AI_FIELDS = ["tldr", "motivation", "method", "result", "conclusion"]
AI_DEFAULTS = {
    "tldr": "Summary generation failed",
    "motivation": "Motivation analysis unavailable",
    "method": "Method extraction failed",
    "result": "Result analysis unavailable",
    "conclusion": "Conclusion extraction failed",
}
AI_PROCESSING_FAILED = "Processing failed"
FENCE_PATTERN = r"(?is)```(?:json)?\s*(.*?)```"
RETRIES = 3
RETRY_BASE_SECONDS = 2.0
RETRY_MAX_SECONDS = 60.0

# --- fixed values: topic filter --------------------------------------------
TOPIC_DEFAULT_REASON = "Classifier failed closed; paper excluded for strict topic filtering."
TOPIC_MIN_CONFIDENCE = 0.65
UNCERTAIN_KEEP_PREFIX = "uncertain_keep: "
TOPIC_MAX_TOPICS = 8
TOPIC_MAX_TOPIC_CHARS = 80
TOPIC_MAX_REASON_CHARS = 500

# --- fixed values: code links -----------------------------------------------
GITHUB_REPO_PATTERN = r"https?://github\.com/([a-zA-Z0-9-_]+)/([a-zA-Z0-9-_\.]+)"
GITHUB_PAGES_PATTERN = r"https?://[a-zA-Z0-9-_]+\.github\.io(?:/[a-zA-Z0-9-_\.]+)*"
GITHUB_URL_PREFIX = "https://github.com/"

# --- fixed values: Markdown digest ------------------------------------------
DIGEST_TOC_HEADER = "<div id=toc></div>\n\n# Table of Contents\n\n"
DIGEST_TOC_LINE = "- [{cate}](#{cate}) [Total: {count}]\n"
DIGEST_SECTION_HEADER = "\n\n<div id='{cate}'></div>\n\n# {cate} [[Back]](#toc)\n\n"
DIGEST_ENTRY_SEPARATOR = "\n\n"
DIGEST_ENTRY_TEMPLATE = (
    "### [{idx}] [{title}]({url})\n"
    "*{authors}*\n"
    "\n"
    "Main category: {cate}\n"
    "\n"
    "TL;DR: {tldr}\n"
    "\n"
    "\n"
    "<details>\n"
    "  <summary>Details</summary>\n"
    "Motivation: {motivation}\n"
    "\n"
    "Method: {method}\n"
    "\n"
    "Result: {result}\n"
    "\n"
    "Conclusion: {conclusion}\n"
    "\n"
    "Abstract: {summary}\n"
    "\n"
    "</details>\n"
)
DEFAULT_PREFERRED_CATEGORIES = ["cs.CV", "cs.CL"]
ARCHIVE_LINE = "[{date}]({url})"
ARCHIVE_SEPARATOR = "\n\n"
