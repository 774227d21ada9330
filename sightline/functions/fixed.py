"""Lists, patterns and thresholds that results depend on."""

# Source types, in display order.
SOURCE_TYPES = ("brand_official", "competitor_official", "media_review", "ugc", "corporate_site", "encyclopedia_reference", "institutional", "other")

# Hosts of a known type; a subdomain has the type of its domain.
KNOWN_HOSTS = {
    "reddit.com": "ugc",
    "youtube.com": "ugc",
    "facebook.com": "ugc",
    "instagram.com": "ugc",
    "tiktok.com": "ugc",
    "x.com": "ugc",
    "twitter.com": "ugc",
    "quora.com": "ugc",
    "wikipedia.org": "encyclopedia_reference",
    "wikidata.org": "encyclopedia_reference",
    "britannica.com": "encyclopedia_reference",
    "reuters.com": "media_review",
    "apnews.com": "media_review",
    "forbes.com": "media_review",
    "techcrunch.com": "media_review",
    "searchenginejournal.com": "media_review",
    "g2.com": "media_review",
    "capterra.com": "media_review",
    "trustpilot.com": "media_review",
    "bbb.org": "media_review",
    "github.com": "corporate_site",
    "linkedin.com": "corporate_site",
}

# Public suffixes of two labels.
DOUBLE_SUFFIXES = (
    "co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.jp", "ne.jp", "or.jp", "com.cn", "net.cn", "org.cn", "gov.cn", "com.sg", "com.hk",
    "com.tw", "co.nz", "com.br", "com.mx", "co.in", "co.kr"
)

# Query parameters that track visitors, besides those that begin with utm_.
TRACKING_KEYS = ("gclid", "fbclid", "msclkid", "mc_cid", "mc_eid")

# Signatures of unusable answers, in order of precedence (Java spelling).
INVALID_SIGNATURES = (
    ("LOGIN_REQUIRED", r"(?is)\b(log in|login|sign in|sign up)\b.{0,80}\b(chatgpt|account|continue)\b"),
    ("ERROR_PAGE", r"(?i)\b(something went wrong|internal server error|bad gateway|service unavailable|try again later)\b"),
    ("REFUSAL", r"(?i)^(i['’]?m sorry[, ]+but |i (?:can(?:not|'t)|won't) (?:help|assist|provide)|unable to comply)"),
    ("PLACEHOLDER", r"(?i)^(n/?a|no answer|placeholder|loading\.{0,3})$"),
)

INTENT_PRIORITY = {"decision": 0, "comparison": 1, "recommendation": 2}

TYPE_LABELS = {"generic": "generic", "category": "generic", "branded": "branded", "brand": "branded", "brand_related": "branded"}
INTENT_LABELS = {
    "recommendation": "recommendation",
    "推荐": "recommendation",
    "awareness": "recommendation",
    "informational": "recommendation",
    "了解": "recommendation",
    "comparison": "comparison",
    "commercial": "comparison",
    "比较": "comparison",
    "decision": "decision",
    "transactional": "decision",
    "决策": "decision",
}

#: Labels of old banks that are read as recommendation.
LEGACY_INTENTS = ("awareness", "informational", "了解")
COMMERCIAL_INTENTS = ("recommendation", "comparison", "decision")

# Runs: what is supported, spelt in lower case, and defaults.
MARKETS = ("us", "usa", "united states", "united_states")
LANGUAGES = ("en", "en-us", "english", "english-us")
PLATFORMS = ("chatgpt",)
SAMPLE_POLICY = "first_valid_per_question"
QUOTA_TOTAL, QUOTA_GENERIC, QUOTA_BRANDED, THRESHOLD = 50, 40, 10, 0.78

# Question-bank rows: required fields, quality flags, stages.
REQUIRED_FIELDS = (
    "question_id", "question_type", "funnel_intent", "decision_stage", "cluster", "audience_role", "scenario", "constraint", "evidence_need", "user_question",
    "zh_translation", "standalone_rewrite", "retrieval_rewrite", "evidence_query", "title_seed", "monitoring_prompt", "quality_checks"
)
CURRENT_FIELDS = ("topic_id", "intent_key")
CURRENT_VERSION, LEGACY_VERSIONS = "overseas-geo-question-bank/v3", ("overseas-geo-question-bank/v2",)
QUALITY_FLAGS = ("natural", "standalone", "answerable", "single_intent", "category_aligned", "neutral_premise", "monitoring_field_valid")
CURRENT_FLAGS = ("topic_aligned", "category_visible", "commercial_intent")
DECISION_STAGES = ("shortlist", "evaluation", "purchase", "implementation", "review")
RETIRED_FIELDS = ("geo_intent", "intent_angle")

# Least counts of different labels that banks of so many questions need, unless they name their own.
MIN_DISTINCT, DISTINCT_FROM = {"audience_roles": 3, "scenarios": 3, "constraints": 2}, 18

# Wording gates (Java spelling).
CONVERSATIONAL = r"(?i)^(how|what|which|who|where|when|why|is|are|am|do|does|did|can|could|should|would|will|has|have|recommend|compare|explain|show me|tell me|help me|please recommend|please compare|give me|give us|list|suggest|find|i need|i am looking for|i['’]m looking for|any recommendations)\b"
BARE_ACTION = r"(?i)^(buy|purchase|order|gift|subscribe(?:\s+to)?|sign\s+up(?:\s+for)?|request|book|get)\b|^give\b(?=.*\b(?:subscription|gift|access|licen[cs]e|account)\b)"
PROMOTIONAL = r"(?i)\b(?:best|top)\b|\bmost\s+(?:popular|recommended|reliable|trusted|affordable|effective|accurate|visible|comprehensive|advanced|integrations?|features?|citations?|mentions?|coverage|value)\b|\breviews\b|\b(?:customer|user|buyer|verified|product|platform|tool|brand)\s+review\b"
LOW_CONFIDENCE = r"(?i)\b(?:most|review)\b"
AMBIGUOUS = r"(?i)\bbrand\s+(tracking|monitoring)\b"
CLARIFIER = r"(?i)\b(AI\s+search|AI-generated\s+answers?|generative\s+search|LLMs?|large\s+language\s+models?)\b"
CJK = "[\\u3400-\\u4dbf\\u4e00-\\u9fff]"
NON_COMMERCIAL = r"(?i)^(?:what\s+is\s+(?!(?:the\s+)?(?:best|top|recommended|right|better|good)\b)|how\s+do(?:es)?\b.{0,120}\bwork|what\s+is\s+the\s+difference\s+between|what\s+should\s+(?:i|we|buyers|a\s+buyer)\s+(?:look\s+for|consider|evaluate|assess)|where\s+to\s+buy|how\s+to\s+buy|where\s+can\s+i\s+buy)\b"

# Limits of batch warnings: ratio above (or from) which a batch of at least MIN_BATCH rows is flagged.
MIN_BATCH = 10
MAX_PROMOTIONAL, MAX_CLUSTER, HIGH_CLUSTER, MIN_METADATA, MAX_OPENERS, HIGH_OPENERS, MAX_ONE_OPENER = 0.20, 0.50, 0.80, 0.80, 0.75, 0.90, 0.50
COMMON_OPENERS = ("how", "what", "which")

# How facts that are true or false are shown.
YES, NO = "是", "否"

# Report texts: words that readers must not see, and words that tell them what to do.
BANNED = r"P[012]|p[012]|赋能|深度赋能|全面提升|优化升级|建议您|我们应该|严重落后|毫无建树|被动挨打"
ACTION_WORDS = r"建议|应该|应当|需要|需|优先补齐|创建|新建|检查并完善|建设页面|强化内容"
# Digits of any script count.
NUMBER = r"(?<![A-Za-z0-9_])-?\p{Nd}+(?:\.\p{Nd}+)?%?"
FACT_TOKEN = r"\{\{fact:([^}]+)\}\}"
BODY_URL = r"(?i)https?://[^\s)\]>\"']+"

# (module, path, field, longest text, may be empty, fewest, most) of report texts; no bound of counts where None.
TEXT_LIMITS = (
    ("M01", "title", "text", 60, False, 1, 1),
    ("M01", "points", "text", 90, False, 3, 5),
    ("M01", "conclusion", "text", 90, False, 1, 1),
    ("M02", "items", "text", 90, False, 3, 3),
    ("M03", "items", "text", 90, False, 3, 3),
    ("M04", "positive_evidence", "keyword", 16, False, 0, 5),
    ("M04", "positive_evidence", "explain", 60, False, 0, 5),
    ("M04", "risk_evidence", "keyword", 16, False, 0, 5),
    ("M04", "risk_evidence", "explain", 60, False, 0, 5),
    ("M04", "analysis_items", "text", 80, False, 3, 3),
    ("M05", "p0", "text", 90, True, 1, 1),
    ("M05", "p1", "text", 90, True, 1, 1),
    ("M05", "p2", "text", 90, True, 1, 1),
    ("M06", "summary", "text", 70, False, 1, 1),
    ("M06", "actions", "source_module", 20, False, 0, None),
    ("M06", "actions", "title", 24, False, 0, None),
    ("M06", "actions", "evidence", 70, False, 0, None),
    ("M06", "actions", "action", 90, False, 0, None),
    ("M06", "actions", "expected_impact", 50, False, 0, None),
    ("M10", "title", "text", 40, False, 1, 1),
    ("M10", "summary", "text", 100, False, 1, 1),
    ("M10", "points", "text", 70, False, 3, 5),
    ("M10", "conclusion", "text", 100, False, 1, 1),
)

# (order, module, path, field, name in the upload table, path there, has an index) of uploaded texts.
UPLOAD_ORDER = (
    (0, "M01", "title", "text", "summary_overview", "", "title", False),
    (1, "M05", "p0", "text", "summary_category_actions", "", "p0", False),
    (2, "M05", "p1", "text", "summary_category_actions", "", "p1", False),
    (3, "M05", "p2", "text", "summary_category_actions", "", "p2", False),
    (4, "M01", "points", "text", "summary_overview", "points", "text", True),
    (5, "M02", "items", "text", "summary_competitor_performance", "items", "text", True),
    (6, "M04", "positive_evidence", "keyword", "summary_brand_expression", "positive_evidence", "keyword", True),
    (6, "M04", "positive_evidence", "explain", "summary_brand_expression", "positive_evidence", "explain", True),
    (7, "M04", "risk_evidence", "keyword", "summary_brand_expression", "risk_evidence", "keyword", True),
    (7, "M04", "risk_evidence", "explain", "summary_brand_expression", "risk_evidence", "explain", True),
    (8, "M04", "analysis_items", "text", "summary_brand_expression", "analysis_items", "text", True),
    (9, "M03", "items", "text", "summary_citation_sources", "items", "text", True),
    (10, "M06", "actions", "source_module", "summary_priority_opportunities", "actions", "source_module", True),
    (10, "M06", "actions", "title", "summary_priority_opportunities", "actions", "title", True),
    (10, "M06", "actions", "evidence", "summary_priority_opportunities", "actions", "evidence", True),
    (10, "M06", "actions", "action", "summary_priority_opportunities", "actions", "action", True),
    (10, "M06", "actions", "expected_impact", "summary_priority_opportunities", "actions", "expected_impact", True),
)
