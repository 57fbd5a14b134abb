"""Title normalisation, for finding the same song under another track group."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Both sides of a title match have to use the same rules.
BRACKETED = r"\([^)]*\)|\[[^\]]*\]"
DASH_SUFFIX = r" - .*$"
NOT_LETTER_DIGIT_SPACE = r"[^\p{L}\p{N} ]"
SPACES = r" +"


def clean_title(title: Column | str) -> Column:
    """Lower-cased title without brackets, dash suffix and punctuation; null when nothing is left."""
    text = F.lower(title)
    text = F.regexp_replace(text, BRACKETED, " ")
    text = F.regexp_replace(text, DASH_SUFFIX, "")
    text = F.regexp_replace(text, NOT_LETTER_DIGIT_SPACE, "")
    text = F.regexp_replace(text, SPACES, " ")
    return F.nullif(F.trim(text), F.lit(""))
