"""Word lists and lookup tables whose values must stay exactly as they are for results to match.

Everything below this line is FIXED VALUES, listed in natural order. Do not edit one without the others.
"""

from __future__ import annotations

# ---------------------------------------------------------------- FIXED VALUES ----------------------------------
# Spark ML's default English stop words (StopWordsRemover.loadDefaultStopWords("english")), in file order.
SPARK_ENGLISH_STOP_WORDS: tuple[str, ...] = (
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "your", "yours", "yourself",
    "yourselves", "he", "him", "his", "himself", "she", "her", "hers", "herself", "it", "its", "itself",
    "they", "them", "their", "theirs", "themselves", "what", "which", "who", "whom", "this", "that", "these",
    "those", "am", "is", "are", "was", "were", "be", "been", "being", "have", "has", "had", "having", "do",
    "does", "did", "doing", "a", "an", "the", "and", "but", "if", "or", "because", "as", "until", "while",
    "of", "at", "by", "for", "with", "about", "against", "between", "into", "through", "during", "before",
    "after", "above", "below", "to", "from", "up", "down", "in", "out", "on", "off", "over", "under", "again",
    "further", "then", "once", "here", "there", "when", "where", "why", "how", "all", "any", "both", "each",
    "few", "more", "most", "other", "some", "such", "no", "nor", "not", "only", "own", "same", "so", "than",
    "too", "very", "s", "t", "can", "will", "just", "don", "should", "now", "i'll", "you'll", "he'll",
    "she'll", "we'll", "they'll", "i'd", "you'd", "he'd", "she'd", "we'd", "they'd", "i'm", "you're", "he's",
    "she's", "it's", "we're", "they're", "i've", "we've", "you've", "they've", "isn't", "aren't", "wasn't",
    "weren't", "haven't", "hasn't", "hadn't", "don't", "doesn't", "didn't", "won't", "wouldn't", "shan't",
    "shouldn't", "mustn't", "can't", "couldn't", "cannot", "could", "here's", "how's", "let's", "ought",
    "that's", "there's", "what's", "when's", "where's", "who's", "why's", "would",
)

# Domain words the job adds to the stop list.
CUSTOM_STOP_WORDS: tuple[str, ...] = (
    "based", "using", "method", "approach", "study", "analysis", "new", "proposed",
    "model", "paper", "data", "system", "research", "results", "effective", "potential",
)

# Discipline abbreviations understood by search and insights (lower-case key -> discipline).
DISCIPLINE_ALIASES: tuple[tuple[str, str], ...] = (
    ("nlp", "Natural Language Processing"), ("cs", "Computer Science"), ("cv", "Computer Vision"),
    ("ai", "Artificial Intelligence"), ("ml", "Machine Learning"), ("se", "Software Engineering"),
    ("iot", "Internet of Things"), ("med", "Medicine"), ("econ", "Economics"), ("law", "Law"),
)

# Domain dictionaries for topic classification; a keyword belongs to the first domain in
# DOMAIN_PRECEDENCE that has any of its words as a substring.
CS_ENG_KEYWORDS: tuple[str, ...] = (
    "计算", "算法", "网络", "系统", "数据", "模型", "代码", "软件", "ai", "nlp", "cv", "learning", "processing",
    "cloud", "iot", "computing", "spark", "web", "识别", "检测", "深度", "架构",
)
SOC_SCI_KEYWORDS: tuple[str, ...] = (
    "法", "规", "伦理", "社会", "经济", "政策", "管理", "law", "economics", "history", "philosophy", "education",
    "policy", "culture", "art", "历史", "教育", "哲学", "文学", "金融", "商业",
)
MED_BIO_KEYWORDS: tuple[str, ...] = (
    "医", "药", "病", "基因", "健康", "临床", "medicine", "health", "clinical", "disease", "healthcare", "生物",
    "护理", "分子",
)
DOMAIN_PRECEDENCE: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("soc_sci", SOC_SCI_KEYWORDS), ("med_bio", MED_BIO_KEYWORDS), ("cs_eng", CS_ENG_KEYWORDS),
)
GENERIC_DOMAIN = "generic"

# Related terms used to pad topic candidates, per domain, in list order.
DOMAIN_FALLBACK_TERMS: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("soc_sci", ("伦理风险", "合规审查", "制度建构", "政策溢出效应", "全球化治理", "数字化转型")),
    ("med_bio", ("靶向治疗", "公共卫生干预", "预后评估", "流行病学特征", "病理学机制", "早筛模型")),
    ("cs_eng", ("知识图谱", "强化学习", "分布式架构", "隐私计算", "边缘计算", "自适应算法")),
    ("generic", ("交叉融合", "可持续发展", "数智化转型", "动因机制", "效能评价")),
)
TOPIC_SLOTS = 3  # candidates per keyword, one per template

# Crawled subjects and their concept ids, in crawl order.
SUBJECT_CONCEPTS: tuple[tuple[str, str], ...] = (
    ("Artificial Intelligence", "C154945302"),
    ("Machine Learning", "C119857082"),
    ("Computer Vision", "C120314980"),
    ("Natural Language Processing", "C204321447"),
    ("Data Mining", "C124101348"),
)

# Defaults applied when a record lacks a value.
DEFAULT_INGEST_SOURCE = "Crossref_API"   # ingest: key `source` absent (an explicit null stays null)
DEFAULT_WORK_TITLE = "Untitled"          # crawler: empty display name
DEFAULT_WORK_YEAR = 2026                 # crawler: empty publication year
CRAWL_SOURCE = "OpenAlex_Cursor"         # crawler: source label of flattened works
MAX_TITLE_CHARS = 500
AUTHORS_KEPT = 3
# ------------------------------------------------------------- END FIXED VALUES ---------------------------------


def stop_words() -> tuple[str, ...]:
    """The job's stop list, duplicates removed, first occurrence order."""
    return tuple(dict.fromkeys(SPARK_ENGLISH_STOP_WORDS + CUSTOM_STOP_WORDS))


def stop_words_longer_than(n: int) -> tuple[str, ...]:
    """Stop words that can still matter after a `length(word) > n` filter.

    Titles are reduced to ASCII letters before tokenising, so a word with an apostrophe never
    matches; removing short words first and then the long stop words gives the same result
    as the full list with a much shorter membership test.
    """
    return tuple(w for w in stop_words() if len(w) > n and w.isalpha())


def fallback_terms(domain: str) -> tuple[str, ...]:
    return dict(DOMAIN_FALLBACK_TERMS)[domain]
