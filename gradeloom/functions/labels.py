"""Label columns: spelling variants of one label compare equal."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def label_key(c: Column) -> Column:
    """Case, blanks, hyphens and underscores removed; null stays null and a label of nothing else becomes null."""
    return F.nullif(F.lower(F.regexp_replace(c, r"(?U)[\s\-_]+", "")), F.lit(""))


#: Names and codes of the languages that occur, to their two-letter code.
LANGUAGES = {
    "en": "en", "eng": "en", "english": "en",
    "de": "de", "deu": "de", "ger": "de", "german": "de",
    "fr": "fr", "fra": "fr", "fre": "fr", "french": "fr",
    "es": "es", "spa": "es", "spanish": "es",
    "ru": "ru", "rus": "ru", "russian": "ru",
    "zh": "zh", "zho": "zh", "chi": "zh", "chinese": "zh",
}


def language_code(c: Column) -> Column:
    """Two-letter code of a language given as code, region code or English name; 'unknown' for null and the rest."""
    key = F.regexp_extract(F.lower(F.trim(c)), r"^([a-z]+)", 1)
    known = F.create_map(*[F.lit(x) for kv in LANGUAGES.items() for x in kv])
    return F.coalesce(F.try_element_at(known, key), F.lit("unknown"))


def hash_unit(*cols: Column) -> Column:
    """52 bits of SHA-256 of the columns as a long in [0, 2^52): the same in every engine, run and partitioning."""
    return F.conv(F.substring(F.sha2(F.concat_ws("\u0001", *cols), 256), 1, 13), 16, 10).cast("long")
