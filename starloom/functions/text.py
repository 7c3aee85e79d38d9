"""Text cleaning and keyword flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from starloom.functions.numeric import as_col

# English stop words of the pipeline's text cleaning (public NLTK word list).
STOP_WORDS = """
i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself yourselves he him his himself
she she's her hers herself it it's its itself they them their theirs themselves what which who whom this that that'll
these those am is are was were be been being have has had having do does did doing a an the and but if or because as
until while of at by for with about against between into through during before after above below to from up down in out
on off over under again further then once here there when where why how all any both each few more most other some such
no nor not only own same so than too very s t can will just don don't should should've now d ll m o re ve y ain aren
aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't haven haven't isn isn't ma mightn mightn't
mustn mustn't needn needn't shan shan't shouldn shouldn't wasn wasn't weren weren't won won't wouldn wouldn't
""".split()

# Substrings that mark a senior title.
SENIOR_KEYWORDS = ["senior", "lead", "principal", "staff", "director", "vp", "head", "chief"]

_EDGE_SPACE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def strip(c: Column | str) -> Column:
    """Trim every kind of whitespace (Spark's trim only drops spaces)."""
    return F.regexp_replace(as_col(c), _EDGE_SPACE, "")


def clean_tokens(c: Column | str, stop_words: Sequence[str] = STOP_WORDS, min_length: int = 3) -> Column:
    """Letter-only lower-case tokens of a text without tags, stop words and short tokens."""
    text = F.coalesce(as_col(c).cast("string"), F.lit(""))
    text = F.regexp_replace(text, r"<[^>]+>", " ")
    text = F.lower(F.regexp_replace(text, r"[^a-zA-Z]+", " "))
    # Words shorter than the minimum are dropped anyway, so they need no place in the lookup set.
    words = [w for w in stop_words if len(w) >= min_length]
    return F.filter(F.split(text, " "), lambda t: (F.length(t) >= min_length) & ~t.isin(words))


def clean_text(c: Column | str, stop_words: Sequence[str] = STOP_WORDS, min_length: int = 3) -> Column:
    return F.array_join(clean_tokens(c, stop_words, min_length), " ")


def token_count(cleaned: Column | str) -> Column:
    """Number of tokens of a cleaned text; an empty text has none."""
    cleaned = as_col(cleaned)
    return F.when(cleaned == "", 0).otherwise(F.size(F.split(cleaned, " ")))


def normal_title(c: Column | str) -> Column:
    return strip(F.lower(as_col(c)))


def keyword_flag(c: Column | str, keywords: Sequence[str] = SENIOR_KEYWORDS, whole_words: bool = False) -> Column:
    """1 if any keyword occurs as a substring (or whole word), ignoring case; NULL gives 0."""
    pattern = "|".join(keywords)
    if whole_words:
        pattern = rf"\b(?:{pattern})\b"
    return F.coalesce(F.lower(as_col(c)).rlike(pattern).cast("int"), F.lit(0))
