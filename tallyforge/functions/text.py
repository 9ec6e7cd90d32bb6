"""Normalisers of provider text, card number detection and deterministic buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings of instruments.
ALIASES = {
    "upi": "UPI", "vpa": "UPI", "card": "CREDIT_CARD", "credit": "CREDIT_CARD", "credit_card": "CREDIT_CARD",
    "credit card": "CREDIT_CARD", "debit": "DEBIT_CARD", "debit_card": "DEBIT_CARD", "debit card": "DEBIT_CARD",
    "netbanking": "NETBANKING", "net banking": "NETBANKING", "nb": "NETBANKING", "wallet": "WALLET",
    "international": "INTERNATIONAL", "intl": "INTERNATIONAL", "emi": "CREDIT_CARD", "paylater": "WALLET", "cardless_emi": "CREDIT_CARD",
}
#: Text that stands for nothing in provider files.
MISSING = ["", "nan", "None", "<NA>"]
MISSING_CURRENCY = ["", "NAN", "NONE", "<NA>", "NA"]
# Card numbers by issuer prefix, 13 to 19 digits with single spaces or dashes.
PAN = r"(?<!\d)(?:4\d{3}|5[1-5]\d{2}|2[2-7]\d{2}|3[47]\d{2}|6[0-5]\d{2}|8[1-9]\d{2})[ \-]?\d(?:[ \-]?\d){8,14}(?!\d)"


def instrument(raw: Column) -> Column:
    """The instrument of a provider's spelling: an exact alias, else the longest alias inside it, else UNKNOWN."""
    key = F.translate(F.lower(F.trim(raw)), "- ", "__")
    exact = F.create_map(*(F.lit(x) for pair in ALIASES.items() for x in pair))
    out = F.when(raw.isNull() | (key == ""), F.lit("UNKNOWN")).when(F.map_contains_key(exact, key), F.element_at(exact, key))
    for alias in sorted(ALIASES, key=len, reverse=True):  # insertion order breaks ties of length
        out = out.when(F.contains(key, F.lit(alias)), F.lit(ALIASES[alias]))
    return out.otherwise(F.lit("UNKNOWN"))


def present(text: Column, missing: list[str] = MISSING) -> Column:
    """Trimmed text, null for the spellings of nothing."""
    t = F.trim(text)
    return F.when(~t.isin(missing), t)


def merchant(text: Column) -> Column:
    return F.coalesce(present(text), F.lit("UNKNOWN"))


def currency(text: Column) -> Column:
    """Upper-case currency code; nothing declared stays null."""
    return present(F.upper(F.trim(text)), MISSING_CURRENCY)


def blank_to_null(text: Column) -> Column:
    """The file markers of a missing value, and blank text, as null."""
    return F.when(~F.trim(text).isin("") & ~text.isin("NA", "null", "NULL"), text)


def pans(text: Column) -> Column:
    """The card numbers (digits only) in a text that pass the check digit."""
    found = F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(PAN), F.lit(0)), lambda m: F.regexp_replace(m, r"[ \-]", ""))
    return F.filter(found, lambda d: F.length(d).between(13, 19) & F.call_function("luhn_check", d))


def has_pan(*texts: Column) -> Column:
    hit = F.lit(False)
    for t in texts:
        hit = hit | (F.size(pans(t)) > 0)
    return hit


def bucket(seed: str, key: Column) -> Column:
    """A stable number from 0 to 99 for each key: the first two bytes of a SHA-256, modulo 100."""
    digest = F.sha2(F.concat(F.lit(f"{seed}|"), key.cast("string")), 256)
    return (F.conv(F.substring(digest, 1, 4), 16, 10).cast("long") % 100).cast("int")


def payload_hash(*cols: Column) -> Column:
    """SHA-256 of the columns as text, nulls empty, joined by the unit separator."""
    return F.sha2(F.concat_ws("\x1f", *(F.coalesce(c.cast("string"), F.lit("")) for c in cols)), 256)
