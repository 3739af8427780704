"""Fixed values. Results depend on these exact words, patterns and numbers."""

# English stop words used by the tokenizers (default argument).
STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him
his himself she her hers herself it its itself they them their theirs themselves
what which who whom this that these those am is are was were be been being have
has had having do does did doing a an the and but if or because as until while
of at by for with about against between into through during before after above
below to from up down in out on off over under again further then once here
there when where why how all any both each few more most other some such no nor
not only own same so than too very s t can will just don should now d ll m o re
ve y ain aren couldn didn doesn hadn hasn haven isn ma mightn mustn needn shan
shouldn wasn weren won wouldn
""".split()

# The word that replaces masked phrases, and its token.
MASK_TEXT = '{"profanity"}'
MASK_TOKEN = "profanity"

# Words added to the stop list of the relevance model.
MODEL_STOP_WORDS = ["com", "http", "retweet", "tweet", "twitter", "news", "people", "world", "video", "said"]

# Address words that carry no topic.
URL_STOP_WORDS = ["https", "http", "www", "com", "htm", "html", "asp", "jsp", "aspx", "php", "org", "net", "pl", "cgi"]

# Top-level labels that say nothing about a place.
GENERIC_DOMAINS = ["com", "net", "edu", "org"]

# Link addresses that are never followed.
BLOCKED_SUFFIXES = [
    "comment", "feed", "comments", ".rss", "video", "link", "gif", "jpeg", "mp4", "wav", "jpg", "mp3",
    "png", "share.php", "sharer.php", "login.php", "print", "button", "share", "email", "submit", "post", ".pdf",
]
BLOCKED_PARTS = ["report-a-typo", "m.tempo.co/"]

# Meta attributes that announce a publication date.
DATE_META_NAMES = [
    "pubdate", "publishdate", "timestamp", "dc.date.issued", "article:published_time", "date",
    "sailthru.date", "article.published", "published-date", "article.created", "article_date_original",
    "cxenseparse:recs:publishtime", "date_published",
]
DATE_META_PROPERTIES = ["article:published_time", "bt:pubdate"]
DATE_META_ITEMPROPS = ["datepublished", "datecreated"]
DATE_META_HTTP_EQUIV = ["date"]

# Date inside an address.
URL_DATE_PATTERN = (
    r"([\./\-_]{0,1}(19|20)\d{2})[\./\-_]{0,1}(([0-3]{0,1}[0-9][\./\-_])|(\w{3,5}[\./\-_]))([0-3]{0,1}[0-9][\./\-]{0,1})?"
)

# Absolute addresses taken out of href values.
SUB_URL_PATTERN = r"https?://[a-zA-Z0-9./-]+"

# Status codes of the page record.
STATUS_OK = "0200"
STATUS_NOT_HTML = "1001"
STATUS_EMPTY = "2000"
STATUS_FAILED = "2001"
STATUS_WARC = "3200"

# Constant tags of the page record and of the tweet form.
DOC_TYPE = "webpage"
DATABASE, SOURCE = "EFC", "EFC"
TWEET_DATABASE, TWEET_SOURCE = "Collect_yTK", "yTK"

# Relevance thresholds and weights.
PAGE_THRESHOLD = 0.5
URL_THRESHOLD = 0.1
EXPAND_THRESHOLD = 0.1
TOPIC_WEIGHT, LOCATION_WEIGHT, DATE_WEIGHT = 0.4, 0.2, 0.4
LINK_WEIGHT, SOURCE_WEIGHT = 0.6, 0.4
SOURCE_PRIOR = 1.0
DATE_TOLERANCE_DAYS = 30
VOCABULARY_SIZE = 10
MIN_DOCUMENT_FREQUENCY = 2
MIN_LOCATION_COUNT = 20
PAGE_LIMIT = 1000
