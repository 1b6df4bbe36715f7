"""Text functions, all built from JVM-side expressions."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, functions as F

__all__ = [
    "digits_only",
    "empty_to_null",
    "hmac_sha256",
    "initcap_words",
    "is_missing_string",
    "matches",
    "norm_str",
    "normalize_na",
    "parse_json_list",
    "pseudonymize",
    "pseudonymize_address",
    "single_spaced",
    "snake_case",
    "strip_phone_tags",
    "strip_pii_tags",
    "strip_ws",
    "trim_both",
]

# The characters Python's str.strip() treats as whitespace.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Words read as missing after trimming, and by a CSV reader before it.
NA_AFTER_TRIM = ("nan", "NaN", "None", "")
NA_AT_READ = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Words a formatted text column shows for "missing", compared in lower case.
MISSING_WORDS = ("", "<na>", "nan", "none")

# Privacy tags.
PII_TAG = "⟦[pP]:[^⟧]+⟧"
PHONE_TAG = "⟦PH:[^⟧]+⟧"


def snake_case(name: str) -> str:
    """``UserId``, ``user id`` and ``user-id`` all become ``user_id``."""
    text = name.strip().replace("-", "_").replace(" ", "_")
    padded = f" {text} "
    pieces = [
        "_" + here if here.isupper() and left != " " and (left.islower() or right.islower()) else here
        for left, here, right in zip(padded, text, padded[2:])
    ]
    return "_".join(part for part in "".join(pieces).lower().split("_") if part)


def strip_ws(c: Column) -> Column:
    """Strip every kind of whitespace at both ends (``trim`` alone strips only spaces).

    Trimming a set of characters is slow, so text that starts and ends with printable ASCII passes by. Its last byte
    tells, as every byte of a longer character is above ASCII; the last character would take a walk through the text.
    """
    last = F.substring(c.cast("string").cast("binary"), -1, 1)
    solid = c.between("!", "~") & last.between(F.lit(b"!"), F.lit(b"~"))
    return F.when(solid, c).otherwise(F.trim(c, F.lit(WHITESPACE)))


def trim_both(c: Column) -> Column:
    """Strip the space character at both ends."""
    return F.trim(c.cast("string"))


def empty_to_null(c: Column) -> Column:
    """Blank text becomes null; other text is returned trimmed."""
    return F.nullif(trim_both(c), F.lit(""))


def normalize_na(c: Column, tokens: tuple[str, ...] = NA_AFTER_TRIM) -> Column:
    """Words that stand for a missing value become null."""
    return F.when(~c.isin(*tokens), c)


def strip_pii_tags(c: Column) -> Column:
    """Remove ``⟦P:…⟧`` and ``⟦p:…⟧`` marks."""
    return F.regexp_replace(c, PII_TAG, "")


def strip_phone_tags(c: Column) -> Column:
    """Remove ``⟦PH:…⟧`` marks."""
    return F.regexp_replace(c, PHONE_TAG, "")


def digits_only(c: Column) -> Column:
    """Keep the digits 0 to 9."""
    return F.regexp_replace(c, "[^0-9]", "")


def matches(c: Column, pattern: str) -> Column:
    """True where the pattern is found in the text."""
    return c.rlike(pattern)


def norm_str(c: Column) -> Column:
    """Form used to compare words: whitespace stripped, lower case, null kept."""
    return F.lower(strip_ws(c.cast("string")))


def is_missing_string(c: Column) -> Column:
    """Null, blank, or one of the words for a missing value."""
    return F.coalesce(norm_str(c).isin(*MISSING_WORDS), F.lit(True))


def single_spaced(c: Column) -> Column:
    """Words of a text with one space between them and none around."""
    other = WHITESPACE.replace(" ", "")
    spaced = F.trim(F.translate(c, other, " " * len(other)))
    # Few texts have a run of spaces, so only those meet the regular expression.
    return F.when(F.contains(spaced, F.lit("  ")), F.regexp_replace(spaced, " {2,}", " ")).otherwise(spaced)


def initcap_words(c: Column) -> Column:
    """Capitalize every whitespace-separated word and join the words with one space."""
    return F.initcap(single_spaced(c))


def parse_json_list(c: Column, element_type: str = "string") -> Column:
    """JSON array text becomes an array; text that is no JSON array becomes null."""
    return F.from_json(c, f"array<{element_type}>")


def pseudonymize(c: Column, salt: str) -> Column:
    """Stable stand-in for an address; equal inputs (whatever their case) stay joinable."""
    return F.sha2(F.concat(F.lit(salt), F.lower(c)), 256)


def hmac_sha256(c: Column, key: bytes) -> Column:
    """Keyed digest of a text, lowercase hex: nobody without the key can tell which guess a digest belongs to.

    Two digests over the padded key, all in the JVM. The padded keys are literals of the plan, so keep plans of
    such queries where the key may be.
    """
    block = (hashlib.sha256(key).digest() if len(key) > 64 else key).ljust(64, b"\0")
    inner, outer = (F.lit(bytes(b ^ pad for b in block)) for pad in (0x36, 0x5C))
    return F.sha2(F.concat(outer, F.unhex(F.sha2(F.concat(inner, c.cast("binary")), 256))), 256)


def pseudonymize_address(c: Column, key: bytes, hide_domain: bool = False) -> Column:
    """Stand-in for an address: a keyed digest of the whole address, and its domain, so that joins on domains still work.

    Case and spaces around do not matter. One person at two domains has two stand-ins. ``hide_domain`` replaces the
    domain by a keyed digest of its own, equal for equal domains. Text without an ``@`` has no domain.
    """
    plain = F.lower(strip_ws(c))
    domain = F.substring_index(plain, "@", -1)
    shown = hmac_sha256(domain, key) if hide_domain else domain
    return F.when(F.contains(plain, F.lit("@")), F.concat_ws("@", hmac_sha256(plain, key), shown)).otherwise(hmac_sha256(plain, key))
