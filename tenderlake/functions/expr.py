"""Column expressions with the exact semantics of the record normaliser: trimming, falsy values, keys, confidences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The 29 code points that count as white space at the ends of a field.
WHITESPACE = "".join(map(chr, (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))

#: The fields that a record must have, in the order in which a rejection names them.
REQUIRED = ("source_id", "source_url", "solicitation", "title", "agency", "jurisdiction", "observed_at")
TEXT_FIELDS = ("solicitation", "title", "agency", "jurisdiction")


def strip(c: Column) -> Column:
    """Without white space at both ends; trim() knows U+0020 only."""
    return F.btrim(c, F.lit(WHITESPACE))


def canonical_id(agency: Column, solicitation: Column) -> Column:
    """16 hexadecimal digits of the SHA-256 of both parts, trimmed and lower-cased, with `::` between; null if either is."""
    return F.substring(F.sha2(F.concat(F.lower(strip(agency)), F.lit("::"), F.lower(strip(solicitation))), 256), 1, 16)


def local_uuid(*parts: Column) -> Column:
    """A UUID-shaped id that depends on the parts only; each is length-prefixed, so no two lists of parts run together."""
    told = [F.concat(F.coalesce(F.length(p.cast("string")).cast("string"), F.lit("-")), F.lit(":"), F.coalesce(p.cast("string"), F.lit(""))) for p in parts]
    return F.regexp_replace(F.substring(F.sha2(F.concat(*told), 256), 1, 32), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")


def field(v: Column, name: str) -> Column:
    """A variant's field as a variant; null where it is absent or v is no object."""
    return F.try_variant_get(v, f"$['{name}']", "variant")


def falsy(v: Column, kind: Column, said: Column) -> Column:
    """Whether a variant, with its schema and its JSON, is absent, null, false, zero, or empty; a blank string is not."""
    number = ~kind.isin("STRING", "BOOLEAN") & (said.try_cast("double") == 0)
    return v.isNull() | F.coalesce(F.is_variant_null(v), F.lit(False)) | F.coalesce(said.isin('""', "false", "[]", "{}"), F.lit(False)) | F.coalesce(number, F.lit(False))


def confidence(v: Column, kind: Column, text: Column) -> Column:
    """1.0 if a variant, with its schema and its text, is absent, the number of a number, a true/false or a numeric string; null where there is none."""
    numeric = F.when(strip(text).rlike(r"^[+-]?(\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)([eE][+-]?\d+(_\d+)*)?$"), F.replace(strip(text), F.lit("_"), F.lit("")).try_cast("double"))
    words = F.lower(strip(text))
    special = F.when(words.rlike(r"^[+-]?(inf|infinity)$"), F.when(words.startswith("-"), F.lit(float("-inf"))).otherwise(F.lit(float("inf")))).when(words.rlike(r"^[+-]?nan$"), F.lit(float("nan")))
    return F.when(v.isNull(), F.lit(1.0)).when(kind == "STRING", F.coalesce(numeric, special)).when(kind == "BOOLEAN", F.when(F.try_variant_get(v, "$", "boolean"), 1.0).otherwise(0.0)).otherwise(F.try_variant_get(v, "$", "double"))
