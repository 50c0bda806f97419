"""Values that results depend on and that must not drift."""

# ---- Fixed values (patterns) ----------------------------------------------
# Unicode whitespace as one character class; Java and RE2 both read it.
SPACE = (
    r"[\t\n\x0b\f\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
SPACE_CHARS = (
    "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
NOT_SPACE = SPACE.replace("[", "[^", 1)
# Token characters of lower-cased text: Latin a-z, Cyrillic a-ya, digits.
TOKEN = r"[a-z0-9\x{430}-\x{44f}]+"
AUTO_CARD = r"<!--" + SPACE + r"*This model card has been generated automatically"
# Card cleaning, applied in this order.
CARD_CLEANING = (
    (r"(?s)```.*?```", " "),
    (r"#+" + SPACE + "*", " "),
    (r"\[([^\]]+)\]\([^)]+\)", r"$1"),
    (r"http" + NOT_SPACE + "+", " "),
    (r"[-*\x{2022}`]", " "),
    (r"[ \t]+", " "),
    (r"\n{3,}", "\n\n"),
    (r"<[^>]+>", ""),
)

# ---- Fixed values (words) -------------------------------------------------
EMPTY_WORDS = ("", "nan", "none", "null", "[]")
QUERY_PREFIX = "Represent this sentence for searching relevant passages: "
PREFIXED_ENCODERS = (
    "BAAI/bge-small-en-v1.5",
    "BAAI/bge-base-en-v1.5",
    "BAAI/bge-large-en-v1.5",
)
DEFAULT_ENCODERS = (
    "sentence-transformers/all-MiniLM-L6-v2",
    "BAAI/bge-small-en-v1.5",
)
TEXT_STRATEGIES = ("title_body", "title_task_body", "title_task_tags_body", "body_only")
METRICS = ("inner_product", "l2")
CARD_COLUMNS = (
    "model_id",
    "likes",
    "downloads",
    "tags",
    "pipeline_tag",
    "library_name",
    "createdAt",
    "languages",
    "modelCard",
)
SLIM_COLUMNS = CARD_COLUMNS[:-1]
BODY_COLUMNS = ("body", "modelCard", "text")

# ---- Fixed values (numbers) -----------------------------------------------
BM25_K1, BM25_B, BM25_EPSILON = 1.5, 0.75, 0.25
RRF_K = 60
NORM_FLOOR = 1e-12
MIN_CARD_CHARS = 20
CARD_TEXT_CHARS, CARD_TAGS, CARD_LANGUAGES = 2500, 40, 20
RERANK_TEXT_CHARS, RERANK_TAGS = 500, 5
SNIPPET_CHARS, SHOWN_SNIPPET_CHARS, PREVIEW_CHARS = 500, 220, 120
METRIC_CUTOFFS = (1, 5, 10, 20)
CANDIDATES, RERANKED = 100, 20
ABLATION_SIZES = (50, 100, 200)
ABLATION_TEXTS = (
    ("title_body", "title_body", 500),
    ("body_only", "body_only", 500),
    ("title_short_body", "title_body", 200),
    ("title_body_pipeline_tag", "title_task_body", 500),
    ("title_body_pipeline_tag_tags", "title_task_tags_body", 500),
)
POPULAR_CARDS, RANDOM_CARDS, SEED = 150_000, 450_000, 42
SILVER_LOW, SILVER_HIGH, SILVER_FALLBACK, SILVER_TARGET, SILVER_QUERIES = 10, 250, 5, 50, 5
