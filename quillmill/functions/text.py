"""Text normalisation expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters that are removed (zero width, BOM).
REMOVED = "​‌‍﻿"
#: Characters that are replaced, and what by (no-break space, dashes, quotes).
REPLACED = {
    " ": " ", "‐": "-", "‑": "-", "–": "-", "—": "-",
    "‘": "'", "’": "'", "“": '"', "”": '"',
}
#: Words that count for nothing when descriptions are compared.
NOISE_WORDS = ("the", "a", "an", "and", "or", "of", "for", "in", "on", "at", "to", "with", "-", "–")
#: Labels of total rows.
SUMMARY_LABELS = ("total", "totals", "grand total", "sub total", "subtotal", "sub-total")
#: Texts that stand for nothing.
NULL_TEXTS = ("", "nan", "none", "null")
#: Synonyms of verdicts.
VERDICTS = {
    "CORRECT": "CORRECT", "RIGHT": "CORRECT", "ACCURATE": "CORRECT",
    "INCORRECT": "INCORRECT", "WRONG": "INCORRECT", "INACCURATE": "INCORRECT", "ERROR": "INCORRECT",
    "MISSING": "MISSING", "NOT FOUND": "MISSING", "ABSENT": "MISSING",
    "UNVERIFIABLE": "UNVERIFIABLE", "UNCLEAR": "UNVERIFIABLE", "CANNOT VERIFY": "UNVERIFIABLE",
}
#: What signals a price adjustment clause.
ESCALATION_KEYWORDS = (
    "cpi", "consumer price index", "escalat", "price adjust", "rate adjust", "cost adjust", "inflation",
    "rise and fall", "variation of price",
)


def blank_to_null(value: Column) -> Column:
    return F.when(~F.lower(F.trim(value)).isin(*NULL_TEXTS), value)


def sanitise(value: Column) -> Column:
    """Zero-width characters go, dashes, quotes and no-break spaces become plain, white space collapses."""
    plain = F.translate(value, "".join(REPLACED) + REMOVED, "".join(REPLACED.values()))
    return F.trim(F.regexp_replace(plain, r"(?U)\s+", " "))


def normalise_key(value: Column) -> Column:
    """Lowered words without punctuation, sorted."""
    words = F.filter(F.split(F.regexp_replace(F.lower(value), r"(?U)[^\w\s]", " "), r"(?U)\s+"), lambda w: w != "")
    return F.array_join(F.array_sort(words), " ")


def search_normalise(value: Column) -> Column:
    """Lowered, non-word characters as one space, trimmed."""
    return F.trim(F.regexp_replace(F.lower(value), r"(?U)[^\w]+", " "))


def token_set(value: Column) -> Column:
    """Distinct lowered words without noise words."""
    words = F.filter(F.split(F.lower(F.trim(value)), r"\s+"), lambda w: (w != "") & ~w.isin(*NOISE_WORDS))
    return F.array_distinct(words)


def verdict(value: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in VERDICTS.items() for x in pair])
    return F.coalesce(known[F.upper(F.trim(value))], F.lit("UNVERIFIABLE"))


def safe_name(value: Column, longest: int = 80) -> Column:
    """A file name: non-word characters as `_`, squeezed, trimmed of `_` and `.`; `unnamed` if nothing is left."""
    name = F.regexp_replace(F.regexp_replace(value, r"[^\w.-]", "_"), "_+", "_")
    name = F.regexp_replace(F.substring(F.regexp_replace(name, r"^[_.]+|[_.]+$", ""), 1, longest), r"[_.]+$", "")
    return F.coalesce(F.when(name != "", name), F.lit("unnamed"))


def safe_path(folder: Column, parts: list[Column], ending: str = ".json", longest: int = 255) -> Column:
    """folder/part_part<ending>: the parts as file names, cut so that the whole path has at most `longest` characters (30 at least for the name)."""
    room = F.greatest(F.lit(longest - 1 - len(ending)) - F.length(folder), F.lit(30))
    joined = F.concat_ws("_", *[safe_name(p) for p in parts])
    name = F.when(F.length(joined) > room, F.regexp_replace(F.substring(joined, F.lit(1), room), r"[_.]+$", "")).otherwise(joined)
    return F.concat(folder, F.lit("/"), name, F.lit(ending))


def table_slug(value: Column, longest: int = 60) -> Column:
    return F.substring(F.regexp_replace(value, r"[^\w-]", "_"), 1, longest)


def contains_any(value: Column, keywords: tuple[str, ...]) -> Column:
    """True if the lowered text contains a keyword."""
    low = F.lower(F.coalesce(value, F.lit("")))
    out = F.lit(False)
    for k in keywords:
        out = out | low.contains(k)
    return out


def keyword_match(value: Column, keyword: Column) -> Column:
    """Keywords of up to three characters need a delimiter on both sides, longer ones are substrings."""
    low, key = F.lower(F.coalesce(value, F.lit(""))), F.lower(keyword)
    framed = F.concat(F.lit(" "), F.translate(low, ",;/-()\t\n", "        "), F.lit(" "))
    return F.when(F.length(key) <= 3, framed.contains(F.concat(F.lit(" "), key, F.lit(" ")))).otherwise(low.contains(key))


def filter_keywords(applies_to: Column) -> Column:
    """The keywords an adjustment clause applies to: phrases, parenthesised terms, acronyms and phrases of acronyms."""
    noise = (
        "prices", "price", "including", "via", "the", "for", "of", "with", "from", "to", "in", "on", "all", "any", "such",
        "as", "related", "applicable", "based",
    )
    low = F.lower(applies_to)

    def phrases(parts: Column) -> Column:
        return F.transform(
            parts, lambda p: F.array_join(F.filter(F.split(F.trim(p), r"\s+"), lambda w: ~w.isin(*noise) & (w != "")), " ")
        )

    main = F.split(F.regexp_replace(low, r"\([^)]*\)", " "), r"[,;/&]+|\band\b|\bor\b")
    inside = F.regexp_extract_all(low, F.lit(r"\(([^)]+)\)"), F.lit(1))
    acronyms = F.transform(F.regexp_extract_all(applies_to, F.lit(r"\b([A-Z]{2,4})\b"), F.lit(1)), F.lower)
    named = F.transform(
        F.regexp_extract_all(applies_to, F.lit(r"\b([A-Z]{2,4}(?:\s+[A-Z][a-zA-Z]*)*)\b"), F.lit(1)), lambda p: F.lower(F.trim(p))
    )
    short = F.filter(F.concat(acronyms, named), lambda w: ~w.isin(*noise, "cpi"))
    return F.array_distinct(F.filter(F.concat(phrases(main), phrases(inside), short), lambda w: w != ""))
