"""Fixed values and the settings that change results."""

from __future__ import annotations

from dataclasses import dataclass

# Column names of the raw act tables.
ACT_COLUMNS = ("Act_type", "Act_name", "CELEX", "act_raw_text", "EUROVOC")
ID_COLUMN = "CELEX"
TEXT_COLUMN = "act_raw_text"
TAG_COLUMN = "EUROVOC"
FORCED_TEXT_COLUMNS = ("date_publication", "temporal_status", "oeil_link")

# Whole cells that a CSV scan treats as missing (case-sensitive).
MISSING_SPELLINGS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Spark's English stop words without an apostrophe, then three more words that the
# published query token lists drop.
STOP_WORDS = (
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "your", "yours",
    "yourself", "yourselves", "he", "him", "his", "himself", "she", "her", "hers", "herself",
    "it", "its", "itself", "they", "them", "their", "theirs", "themselves", "what", "which",
    "who", "whom", "this", "that", "these", "those", "am", "is", "are", "was", "were", "be",
    "been", "being", "have", "has", "had", "having", "do", "does", "did", "doing", "a", "an",
    "the", "and", "but", "if", "or", "because", "as", "until", "while", "of", "at", "by", "for",
    "with", "about", "against", "between", "into", "through", "during", "before", "after",
    "above", "below", "to", "from", "up", "down", "in", "out", "on", "off", "over", "under",
    "again", "further", "then", "once", "here", "there", "when", "where", "why", "how", "all",
    "any", "both", "each", "few", "more", "most", "other", "some", "such", "no", "nor", "not",
    "only", "own", "same", "so", "than", "too", "very", "s", "t", "can", "will", "just", "don",
    "should", "now", "cannot", "could", "ought", "would",
    "third", "regarding", "within",
)

# The character cap some users put on a text before tokenizing. Off unless asked for.
TEXT_CAP = 100_000


@dataclass(frozen=True)
class Settings:
    """Parameters with the published defaults."""

    min_token_length: int = 2
    text_cap: int | None = None
    stop_words: tuple[str, ...] = STOP_WORDS
    ngram_max: int = 2
    max_features: int = 50_000
    svc_c: float = 1.0
    top_labels: int = 100
    k1: float = 1.5
    b: float = 0.75
    score_digits: int = 9
    split_seed: int = 42
    test_percent: int = 20
    # A side of a join is broadcast only when it has at most this many rows.
    broadcast_rows: int = 500_000


DEFAULTS = Settings()
