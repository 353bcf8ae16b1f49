"""Results depend on these exact limits, patterns and formats."""

# Product curation
MIN_TEXT_CHARS = 600
MIN_PRICE = 0.5
MAX_PRICE = 999.49
MAX_PART_CHARS = 3000
MAX_TEXT_CHARS = 4000
REMOVED_DETAILS = [
    "Part Number",
    "Best Sellers Rank",
    "Batteries Included?",
    "Batteries Required?",
    "Item model number",
]
CODE_IN_LINE = r"\b(?=[A-Z0-9]{7,}\b)(?=.*[A-Z])(?=.*\d)[A-Z0-9]+\b"
CODE_TOKEN_CHARS = 7

# Unit -> (operation on the amount, factor), giving pounds
POUNDS = {
    "pounds": ("*", 1.0),
    "ounces": ("/", 16.0),
    "grams": ("/", 453.592),
    "milligrams": ("/", 453592.0),
    "kilograms": ("/", 0.453592),
}
HUNDREDTHS = 100.0

# prompts
PRICE_PREFIX = "Price is $"
PRICE_QUESTION = "What does this cost to the nearest dollar?"
ESTIMATE_REQUEST = "Estimate the price of this product. Respond with the price, no explanation"
SUMMARY_REQUEST = (
    "Create a concise description of a product. Respond only in this format. "
    "Do not include part numbers.\n"
    "Title: Rewritten short precise title\n"
    "Category: eg Electronics\n"
    "Brand: Brand name\n"
    "Description: 1 sentence description\n"
    "Details: 1 sentence on features"
)
BATCH_MODEL = "openai/gpt-oss-20b"
BATCH_ENDPOINT = "/v1/chat/completions"
BATCH_ROWS = 1000
TOKEN_CUTOFF = 110
FREIGHT_ANSWER = "\n\nFreight rate:"

# Price text
PLAIN_NUMBER = r"[-+]?\d*\.\d+|\d+"
REPLY_PRICE_PATTERNS = [
    r"\$?\s*(\d{1,3}(?:,\d{3})*(?:\.\d{2})?)",
    r"\$?\s*(\d+\.?\d*)",
    r"(\d+\.\d{2})",
    r"(\d+)",
]
FREIGHT_REPLY_PATTERNS = [
    r"\$?\s*(\d{1,3}(?:,\d{3})+(?:\.\d{1,2})?)",
    r"\$?\s*(\d+\.\d{1,2})",
    r"\$?\s*(\d+)",
]

# Freight CSV columns
BOOKING_COLUMNS = [
    "POL",
    "POD",
    "COMMODITY_CODE",
    "COMMODITY_DESCRIPTION",
    "TOTAL_TEU",
    "BOOKING_TYPE",
    "BOOKING_YEAR",
    "BOOKING_MONTH",
    "BOOKING_CHANNEL",
    "TOTAL_PRICE",
    "CHG_CURRENCY",
]
MONTH_NAMES = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]

# Error bands (absolute green, absolute orange) and shared ratios
PRODUCT_BAND = (40.0, 80.0)
FREIGHT_BAND = (1000.0, 3000.0)
BAND_RATIOS = (0.2, 0.4)

# retrieval
SEARCHED = 60
RETRIEVED = 20
NDCG_DEPTH = 10
MAX_TERMS = 8
LEXICAL_TOP = 20
METRIC_BANDS = {
    "mrr": (0.9, 0.75),
    "ndcg": (0.9, 0.75),
    "coverage": (90.0, 75.0),
    "accuracy": (4.5, 4.0),
    "completeness": (4.5, 4.0),
    "relevance": (4.5, 4.0),
}

# chunks
CHUNK_CHARS = 500
CHUNK_OVERLAP = 200
CHUNK_TARGET_CHARS = 100
CHUNK_OVERLAP_WORDS = 50

# deals
FEED_ENTRIES = 10
PRICED_PER_SCAN = 5
ALERT_DISCOUNT = 50.0
NOTICE_CHARS = 200
ENSEMBLE_WEIGHTS = (0.8, 0.2)
NEIGHBOURS = 5

# Answer criteria when none are given
DEFAULT_CRITERIA = ["Accuracy", "Completeness", "Clarity"]

# Patterns on web pages
PAGE_CHARS = 2000
BUNDLE_CHARS = 5000
NO_TITLE = "No title found"
SNIPPET_CLASS = "snippet summary"
TAG = r"<[^<]+?>"

# English stop words (the Spark ML list; "'" never occurs inside a token here)
STOP_WORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she "
    "her hers herself it its itself they them their theirs themselves what which who whom this that "
    "these those am is are was were be been being have has had having do does did doing a an the and "
    "but if or because as until while of at by for with about against between into through during "
    "before after above below to from up down in out on off over under again further then once here "
    "there when where why how all any both each few more most other some such no nor not only own same "
    "so than too very s t can will just don should now cannot could ought would"
).split()

# models
VOCABULARY = 2000
HASHED_FEATURES = 5000
FOREST_TREES = 100
BOOST_RATE = 0.1
BOOST_ROUNDS = 1000

# Text formats
FREIGHT_TEXT = (
    "Estimate the freight rate for this shipment:\n\n"
    "Route: %s to %s\n"
    "Commodity: %s (HS %s)\n"
    "Volume: %.1f TEU\n"
    "Type: %s\n"
    "Date: %d-%02d\n"
    "Channel: %s"
)
DESCRIPTION_WITH_CATEGORY = "%s. %s Category: %s."
DESCRIPTION = "%s. %s"
NO_DESCRIPTION = "Unknown product"
DEAL_TEXT = "Title: %s\nDetails: %s\nFeatures: %s\nURL: %s"
ALERT_TEXT = (
    "🔥 Great Deal! $%.2f off - %s...\n\n"
    "💰 Price: $%.2f\n"
    "📊 Value: $%.2f\n"
    "💵 Save: $%.2f"
)
MONEY = "$%.2f"
LOOKUP_FOUND = "The price of a ticket to %s is $%s."
LOOKUP_MISSING = "No price data available for %s."
LOOKUP_EMPTY = "Please provide a destination city."
BUNDLE_START = "## Landing Page:\n\n"
BUNDLE_LINKS = "\n## Relevant Links:\n"
BUNDLE_LINK = "\n\n### Link: %s\n"
CONTEXT_PART = "Extract from %s:\n%s"
DOCUMENT_PART = "### %s\n%s"
SIMILAR_PRODUCT = "%d. %s\n   Price: $%.2f\n"
TITLE_MARK = "Title: "
TITLE_CHARS = 40
ROUTE_PATTERN = r"Route: (\w+) to (\w+)"
UNKNOWN_ROUTE = "Route %d"
SOURCES_START = "Top sources:\n"
NO_ANSWER = "Evaluation failed."
NO_VERDICT = "Evaluation parse failed."
ROUTE = " → "
SHORT_ROUTE = "→"
DOTS = "..."
FEATURES_MARK = "Features"
