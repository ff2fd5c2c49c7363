"""Neutral rule vocabularies used by the registered queries. Callers bring their own."""

# Words that occur in the supplied prose, so that every branch of a rule is exercised.
POSITIVE = ("the", "that", "tion", "pipeline", "outbound", "heon")
NEGATIVE = ("aux", "nicht", "retail store")
HIDDEN = ("our client", "thanwh", "ouau")
TARGETS = ("companies", "ention", "ander", "and")
LOW_VALUE = ("benefits", "erst")
MARKETS = (("north", r"the\b"), ("south", r"\ble\b"), ("gap", r"that.{0,80}with"))
TITLE_ENTITIES = ("&lt;", "&#39;", "&amp;")
SMALL_BUYERS = ("founder", "owner", "ceo", "managing director")
SALES_LEADERS = ("head of sales", "sales director", "vp sales", "chief revenue officer")
SALES_WORDS = ("sales", "business")

SEGMENT_RULES = (
    ("warehousing", ("warehouse", "storage", "fulfillment"), "storage or fulfillment"),
    ("forwarding", ("freight", "broker"), "forwarding or broker"),
    ("ground", ("truck", "cargo", "courier"), "ground transport"),
    ("maritime", ("ocean", "shipping", "port"), "maritime"),
)
INDUSTRY_RULES = (
    ("Software", ("software", "data", "cloud")),
    ("Logistics", ("freight", "cargo", "shipping", "warehouse")),
    ("Retail", ("retail", "commerce")),
)
SPECIALISTS = (
    ("ground", "ground_transport", 0.8, ("truck", "cargo", "freight")),
    ("storage", "warehousing", 0.8, ("warehouse", "storage")),
    ("sea", "maritime", 0.9, ("ocean", "shipping", "port")),
)
PAGE_CATEGORIES = (
    ("offer", r"[ .](?:the|le|der)[ ,.]"), ("audience", r"[ .](?:and|et|und)[ ,.]"),
    ("industry", r"tion"), ("proof", r"\d{3}"), ("b2b", r"that|que|ander"), ("identity", r"©|example"),
)
SPAM_RULES = (
    ("word", "high", ("the", "cash", "urgent", "free")),
    ("phrase", "medium", ("of the", "act now", "circle back")),
    ("category", "high", ("casino", "miracle cure")),
)
