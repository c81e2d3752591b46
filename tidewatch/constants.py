"""Fixed values that results depend on.

These are the values the original pipeline uses; they are stated here as data,
in their natural order, so that outputs (labels, keyword hits, category order,
thresholds) come out the same.  Everything else in the package is derived.
"""

# ---- fixed values: relevance pattern (case-insensitive, unanchored search) ----
# The alternation is the original keyword list; ``ai\b`` / ``ml\b`` word ends are
# written as "not followed by a word character" so Java and RE2 agree.
RELEVANCE_TERMS = [
    "machine.?learning", "deep.?learning", "neural", "transformer", "llm", "gpt", "diffusion",
    "langchain", "rag", "agent", "vision", "nlp", "reinforcement", "generative", "embedding",
    "fine.?tun", "train", "inference", "model", "ai\\b", "ml\\b",
]

# ---- fixed values: analysis dimensions, in order, with their labels ----
DIMENSIONS = ["technology", "infrastructure", "application", "capital", "risk"]
DIMENSION_LABELS = {
    "technology": "技术层",
    "infrastructure": "基础设施",
    "application": "应用层",
    "capital": "资本信号",
    "risk": "风险信号",
}
# Text keys of each dimension, in the order they are flattened.
DIMENSION_TEXT_KEYS = {
    "technology": ["model_capability", "new_paradigm"],
    "infrastructure": ["inference_cost", "compute_trend"],
    "application": ["new_industries", "displacement"],
    "capital": ["funding_trend", "valuation", "strategic_moves"],
    "risk": ["regulation", "ethics_safety", "supply_chain"],
}
COMBINED_SCOPE = "_combined"

# ---- fixed values: digest category order and labels ----
CATEGORY_ORDER = ["papers", "company", "opensource", "industry", "other"]
CATEGORY_LABELS = {
    "papers": "论文",
    "company": "公司动态",
    "opensource": "开源生态",
    "industry": "资本与行业",
    "other": "其他",
}

# ---- fixed values: source catalog (name, category, method), in fetch order ----
SOURCE_CATALOG = [
    ("arXiv cs.AI", "papers", "RSS"),
    ("arXiv cs.LG", "papers", "RSS"),
    ("arXiv cs.CL", "papers", "RSS"),
    ("OpenAI Blog", "company", "RSS"),
    ("Google DeepMind Blog", "company", "RSS"),
    ("Google AI Blog", "company", "RSS"),
    ("TechCrunch AI", "industry", "RSS"),
    ("VentureBeat AI", "industry", "RSS"),
    ("Crunchbase News", "industry", "RSS"),
    ("Anthropic Blog", "company", "scrape"),
    ("Meta AI Blog", "company", "scrape"),
    ("GitHub Trending", "opensource", "scrape"),
    ("HuggingFace Trending", "opensource", "API"),
]

# ---- fixed values: text-shift labels (M1) ----
SHIFT_LEAP = "跃迁"
SHIFT_CONTINUATION = "延续"
SHIFT_GRADUAL = "渐进"

# ---- fixed values: signal description formats (two-decimal numbers) ----
SPIKE_DESCRIPTION = "{label}近3天内容相似度({recent})显著高于更早期均值({older})，表明该方向话题突然增强。"
CONTINUOUS_DESCRIPTION = "{label}的话题向量在最近{days}天内呈现持续增强趋势（{up}/{steps}天递增），表明该方向正在持续升温。"
EMERGING_DESCRIPTION = "{label}出现全新话题（与历史最大相似度仅{max}），这可能是一个新兴方向的早期信号。"
NOT_ENOUGH_HISTORY = "趋势分析需要至少{need}天历史数据，当前仅{have}天。"

# ---- fixed values: default thresholds ----
LOOKBACK_DAYS = 30
MIN_HISTORY_DAYS = 3
SPIKE_RECENT_N = 3
SPIKE_DELTA = 0.15
SPIKE_MIN_RECENT = 0.3
SPIKE_SCALE = 0.3
CONTINUOUS_MIN_HISTORY = 4
CONTINUOUS_WINDOW = 7
CONTINUOUS_MIN_RATIO = 0.6
EMERGING_MAX_SIM = 0.25
EMERGING_MEAN_SIM = 0.15
KEYWORD_RECENT_N = 5
KEYWORD_RISE_DELTA = 0.2
KEYWORD_FADE_MIN_DF = 3
KEYWORD_TOP = 10
MAX_FEATURES = 5000
SERIES_MAX_FEATURES = 3000
NGRAM_MIN = 2
NGRAM_MAX = 4
SHIFT_LEAP_NOVELTY = 0.4
SHIFT_CONTINUATION_MEAN = 0.5
ITEMS_PER_SOURCE = 10
FEED_ENTRIES = 15
LINK_CAP = 15
LINK_MIN_TITLE = 10
TITLE_CHARS = 200
SUMMARY_CHARS = 1000
ABSTRACT_CHARS = 2000
DESCRIPTION_CHARS = 500
DIGEST_SUMMARY_CHARS = 400
TOP_K = 10

# ---- fixed values: messages of the metrics report ----
NO_TEXT_TODAY = "今日无 arXiv 摘要数据"
TOO_LITTLE_HISTORY = "历史数据不足（需至少 {need} 天）"
NO_REPOS_TODAY = "今日无 GitHub 数据"
NO_MODELS_TODAY = "今日无 HuggingFace 数据"

# ---- fixed values: wording of the digest (group heading: before and after the number) ----
DIGEST_DATE = "今日日期: "
DIGEST_COUNT = "信息条目数: "
DIGEST_INTRO = "以下是今日新增的AI信息列表（按来源分类）："
DIGEST_GROUP = ("（", " 条）")
DIGEST_URL = "   URL: "
DIGEST_SUMMARY = "   摘要: "

# ---- fixed values: headings of the report bundle ----
BUNDLE_ANALYSIS = "## 今日结构分析\n\n"
BUNDLE_TREND = "\n\n## 趋势对比报告\n\n"
BUNDLE_NO_TREND = "\n\n## 趋势对比\n"
BUNDLE_METRICS = "\n\n## 数据洞察报告 (metrics_report)\n\n"
BUNDLE_CHARTS = "\n\n## 趋势图路径 (chart_paths)\n\n"
