"""Keyword lexicons for impact scoring and topic classification.

Both are plain parameters of the scoring operators; the defaults below are the
reference's lists.  A lexicon becomes a tiny literal table, so the keyword
tests are unrolled into one codegen'd projection (no join, no shuffle).
"""

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's defaults)
# ---------------------------------------------------------------------------

# keyword -> weight, added once per keyword contained in the article text
IMPACT_KEYWORDS = {
    "clinical trial": 5, "fda": 5, "approval": 5,
    "breakthrough": 4, "discovery": 4, "first": 4, "novel": 4,
    "treatment": 3, "cure": 3, "drug": 3, "therapy": 3,
    "funding": 2, "investment": 2, "partnership": 2, "collaboration": 2,
    "study": 2, "research": 2, "development": 2,
}

# topic -> keywords, in priority order (earlier topic wins a tie).
# "microbiome" is listed twice in its topic and therefore counts twice.
TOPIC_KEYWORDS = {
    "therapeutics": ["treatment", "therapy", "drug", "cure", "clinical trial", "fda", "approval"],
    "diagnostics": ["diagnostic", "detection", "screening", "test", "biomarker"],
    "research": ["research", "study", "discovery", "breakthrough", "novel"],
    "industry": ["funding", "investment", "partnership", "collaboration", "company"],
    "technology": ["technology", "platform", "tool", "device", "ai", "machine learning"],
    "genetics": ["gene", "genetic", "dna", "rna", "genome", "crispr"],
    "microbiome": ["microbiome", "bacteria", "microbial", "gut", "microbiome"],
    "cancer": ["cancer", "oncology", "tumor", "carcinoma", "leukemia"],
    "rare_disease": ["rare disease", "orphan", "genetic disorder"],
    "infectious_disease": ["infection", "virus", "bacterial", "pathogen", "vaccine"],
}

DEFAULT_TOPIC = "general"

# ---------------------------------------------------------------------------
# A second lexicon pair that actually hits the multilingual test corpus (the
# default biotech words barely occur there).  Used by tests and registered
# queries so scoring and quotas are exercised on real ties.
CORPUS_IMPACT_KEYWORDS = {
    "eaux": 5, "los": 4, "ción": 4, "ver": 3, "ering": 3, "und": 2, "ich": 2, "ment": 2,
}
CORPUS_TOPIC_KEYWORDS = {
    "french": ["que", "eaux", "ment"],
    "german": ["und", "der", "ich"],
    "spanish": ["los", "ción", "que"],
    "english": ["the", "ing", "and"],
}
