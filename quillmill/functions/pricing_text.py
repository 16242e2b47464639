"""What contract text and table headers say about prices."""

from __future__ import annotations

from itertools import groupby

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words of pricing tables.
PRICING_KEYWORDS = (
    "price", "pricing", "rate", "rates", "fee", "fees", "cost", "costs", "charge", "charges", "schedule of rates",
    "bill of quantities", "tariff", "lump sum", "unit rate", "remuneration", "payment", "$/hr", "$/day", "$/tonne",
    "per hour", "per day", "per unit", "rate card", "price list", "price schedule", "rate schedule", "amount", "value",
    "quotation",
)
#: Patterns of labels and the field they stand for, in the order they are tried.
LABEL_PATTERNS = (
    (r"\beffective\s+date\b", "VALID_FROM"), (r"\bdate\s+of\s+effect\b", "VALID_FROM"), (r"\bdate\s+effective\b", "VALID_FROM"),
    (r"\bcommencement\s+date\b", "VALID_FROM"), (r"\bstart\s+date\b", "VALID_FROM"), (r"\bvalid\s+from\b", "VALID_FROM"),
    (r"\bcommencing\b", "VALID_FROM"), (r"\bdate\s+of\s+commencement\b", "VALID_FROM"), (r"\bagreement\s+date\b", "VALID_FROM"),
    (r"\bcontract\s+date\b", "VALID_FROM"), (r"\bexecution\s+date\b", "VALID_FROM"), (r"\bdate\s+of\s+agreement\b", "VALID_FROM"),
    (r"\bdate\s+of\s+contract\b", "VALID_FROM"), (r"\bdeed\s+date\b", "VALID_FROM"), (r"\bdated\b", "VALID_FROM"),
    (r"\bvariation\s+date\b", "VALID_FROM"),
    (r"\bexpiry\s+date\b", "VALID_TO"), (r"\bexpiration\s+date\b", "VALID_TO"), (r"\bend\s+date\b", "VALID_TO"),
    (r"\bvalid\s+(?:to|until)\b", "VALID_TO"), (r"\btermination\s+date\b", "VALID_TO"), (r"\bexpires?\b", "VALID_TO"),
    (r"\bdate\s+of\s+expiry\b", "VALID_TO"),
    (r"\bcontract\s+(?:no\.?|number|ref|reference|id)\b", "CONTRACT_ID"),
    (r"\bagreement\s+(?:no\.?|number|ref|reference|id)\b", "CONTRACT_ID"), (r"\breference\s+(?:no\.?|number)\b", "CONTRACT_ID"),
    (r"\bdocument\s+(?:no\.?|number)\b", "CONTRACT_ID"), (r"\border\s+(?:no\.?|number)\b", "CONTRACT_ID"),
    (r"\bproject\s+(?:no\.?|number|ref)\b", "CONTRACT_ID"),
    (r"\bcurrency\b", "CURRENCY"), (r"\bpayment\s+currency\b", "CURRENCY"), (r"\bcontract\s+currency\b", "CURRENCY"),
    (r"\bcompany(?:\s+name)?\b", "COMPANY_CODE"), (r"\bprincipal\b", "COMPANY_CODE"), (r"\bclient\b", "COMPANY_CODE"),
    (r"\borgani[sz]ation\b", "COMPANY_CODE"), (r"\bbuyer\b", "COMPANY_CODE"), (r"\bpurchaser\b", "COMPANY_CODE"),
    (r"\bvendor\b", "COMPANY_CODE"), (r"\bcontractor\b", "COMPANY_CODE"), (r"\bsupplier\b", "COMPANY_CODE"),
    (r"\bparty\b", "COMPANY_CODE"),
)
#: Units named in text, in the order they are tried.
UNIT_PATTERNS = (
    (r"\$/\s*hr|per\s+hour|hourly", "Hour"), (r"\$/\s*day|per\s+day|daily", "Day"), (r"\$/\s*week|per\s+week|weekly", "Week"),
    (r"\$/\s*month|per\s+month|monthly", "Month"), (r"\$/\s*year|per\s+annum|annual", "Year"),
    (r"per\s+tonne|per\s+ton|\$/t\b", "Tonne"), (r"per\s+kg|per\s+kilogram", "Kilogram"),
    (r"per\s+unit|each|per\s+item", "Each"), (r"per\s+metre|per\s+meter|\$/m\b", "Metre"),
    (r"per\s+sq\s*m|per\s+m2|per\s+square\s+met", "Square Metre"), (r"lump\s+sum|fixed\s+(fee|price)", "Lump Sum"),
    (r"per\s+trip", "Trip"), (r"per\s+shift", "Shift"), (r"per\s+lot", "Lot"),
)
#: Currencies named in text: codes, then phrases.
CURRENCY_CODES = ("AUD", "USD", "EUR", "GBP", "NZD", "CAD", "SGD", "HKD", "JPY", "CNY", "INR")
CURRENCY_PHRASES = (
    (r"[Aa]ustralian\s+[Dd]ollars?", "AUD"), (r"US\s+[Dd]ollars?", "USD"), (r"[Ss]terling|[Pp]ounds?\s+[Ss]terling", "GBP"),
)
#: Phrases before a date, and the field it is for.
DATE_PHRASES = {
    "valid_from": (
        r"[Ee]ffective\s+(?:[Dd]ate|[Ff]rom)", r"[Cc]ommencement\s+[Dd]ate", r"[Vv]alid\s+[Ff]rom", r"[Ss]tart\s+[Dd]ate",
    ),
    "valid_to": (
        r"[Ee]xpir(?:y|es|ation)\s+[Dd]ate", r"[Vv]alid\s+[Tt]o", r"[Ee]nd\s+[Dd]ate", r"[Tt]ermination\s+[Dd]ate",
    ),
}
#: Header patterns of price columns and of the other fields, each used once, in this order.
PRICE_HEADER = r"(?i)rate|price|cost|amount|value|net|fee|charge|\$|total"
HEADER_CURRENCY = r"(?i)\b(AUD|USD|EUR|GBP|NZD|CAD|SGD)\b"
FIELD_HEADERS = (
    ("ITEM_DESCRIPTION", r"(?i)desc|item|service|material|product|name|scope|activity|role|position|title|type|category"),
    ("ORDER_UOM", r"(?i)uom|unit|basis|measure|\bper\b|frequency"),
    ("PRICE_UNIT_UOM", r"(?i)price.?unit|price.?uom|price.?basis"),
    ("TARGET_QUANTITY", r"(?i)qty|quantity|volume|target"),
    ("MATERIAL_ID", r"(?i)\bcode\b|\bid\b|number|ref|sku|part|material.?id"),
    ("MIN_RATE", r"(?i)\bmin\b|minimum|lower|floor"),
    ("MAX_RATE", r"(?i)\bmax\b|maximum|upper|ceil"),
    ("CURRENCY", r"(?i)curr|ccy|currency"),
)


def _first(text: Column, patterns: tuple[tuple[str, str], ...], otherwise: Column) -> Column:
    out = None
    # patterns of one value that follow each other are one alternation
    for value, group in groupby(patterns, key=lambda p: p[1]):
        pattern = "|".join(f"(?:{p})" for p, _ in group)
        out = F.when(text.rlike(pattern), value) if out is None else out.when(text.rlike(pattern), value)
    return out.otherwise(otherwise)


def label_field(label: Column) -> Column:
    """The field a table label stands for, or null."""
    text = F.trim(F.regexp_replace(F.trim(F.lower(label)), ":+$", ""))
    return _first(F.trim(F.regexp_replace(text, r"\([^)]*\)", "")), LABEL_PATTERNS, F.lit(None).cast("string"))


def detect_currency(text: Column) -> Column:
    code = F.regexp_extract(text, rf"\b({'|'.join(CURRENCY_CODES)})\b", 1)
    return F.when(code != "", code).otherwise(_first(text, CURRENCY_PHRASES, F.lit("")))


def detect_unit(text: Column) -> Column:
    return _first(text, UNIT_PATTERNS, F.lit(""))


def detect_date(text: Column, field: str) -> Column:
    """The text of the first date behind a phrase for valid_from or valid_to; null if there is none."""
    found = [F.regexp_extract(text, p + r"[:\s]+(\d{1,2}[\s/\-]\w+[\s/\-]\d{2,4})", 1) for p in DATE_PHRASES[field]]
    iso = {"valid_from": "[Ee]ffective", "valid_to": "[Ee]xpir"}[field]
    found.append(F.regexp_extract(text, iso + r"[:\s]+(\d{4}-\d{2}-\d{2})", 1))
    return F.coalesce(*[F.when(x != "", x) for x in found])


def is_currency_header(header: Column) -> Column:
    """A currency code, with nothing beside it that names another field."""
    rest = F.trim(F.regexp_replace(header, HEADER_CURRENCY, ""))
    return header.rlike(HEADER_CURRENCY) & ((rest == "") | ~rest.rlike("(?i)desc|item|name|uom|unit|qty"))


def is_price_header(header: Column) -> Column:
    return header.rlike(PRICE_HEADER) | is_currency_header(header)


def price_qualifier(header: Column) -> Column:
    """What a price header says besides currency and price words."""
    text = F.trim(F.regexp_replace(F.trim(header), HEADER_CURRENCY, ""))
    text = F.trim(F.regexp_replace(text, r"(?i)\b(rate|price|cost|amount|value|net|fee|charge|total)\b", ""))
    text = F.trim(F.regexp_replace(text, r"\([^)]*\)", ""))
    return F.regexp_replace(F.trim(F.regexp_replace(text, "[$€£/]", "")), r"^[ \-_]+|[ \-_]+$", "")


def header_currency(header: Column) -> Column:
    return F.upper(F.regexp_extract(header, HEADER_CURRENCY, 1))


def header_field(header: Column) -> Column:
    """The first field pattern a header that is no price column matches, or null."""
    return F.when(~is_price_header(header), _first(header, tuple((p, f) for f, p in FIELD_HEADERS), F.lit(None).cast("string")))


def contract_id(value: Column) -> Column:
    """The id in a value that may carry label text: letters, digits, dashes and slashes with a digit among them.

    Blank gives an empty string, text without such a token is returned trimmed.
    """
    text = F.trim(value)
    prefix = (
        r"(?i)^(?:contract|agreement|document|order|project|purchase\s+order|po|ref(?:erence)?|deed|doc)\s*"
        r"(?:no\.?|number|ref(?:erence)?|id)?\s*[:\s.\-]*\s*(?=.)"
    )
    bare = F.regexp_replace(text, prefix, "")
    token = F.regexp_extract(bare, r"(?i)\b([A-Z0-9]*(?:[-/][A-Z0-9]+)*\d[A-Z0-9]*(?:[-/][A-Z0-9]+)*)", 1)
    return F.when(F.coalesce(text, F.lit("")) == "", "").when(token != "", token).otherwise(F.trim(bare))
