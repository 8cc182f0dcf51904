"""Normalization, parsing and hashing as expressions over columns; all run inside the JVM."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Python's str.strip and \s see it.
SPACE = "\\x09-\\x0d\\x1c-\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
# Parts of a name after its last comma that show it is no publisher.
NOT_PUBLISHERS = ("theory", "practice", "review", "studies", "perspectives", "issues", "journal", "quarterly", "annual")


def _c(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def strip(value: Column | str) -> Column:
    """Without white space at either end; null stays null."""
    return F.regexp_replace(_c(value), f"^[{SPACE}]+|[{SPACE}]+$", "")


def or_null(value: Column | str) -> Column:
    """Null for an empty string."""
    return F.nullif(_c(value), F.lit(""))


def is_missing(value: Column | str) -> Column:
    """Null, blank, or the text of a missing number."""
    return _c(value).isNull() | (strip(_c(value).cast("string")) == "")


def clean_whitespace(value: Column | str) -> Column:
    """Stripped, runs of white space as one space; '' for missing."""
    return F.coalesce(F.trim(F.regexp_replace(_c(value), f"[{SPACE}]+", " ")), F.lit(""))


normalize_title = clean_whitespace


def strip_punctuation(value: Column | str) -> Column:
    """Without the characters of Unicode's punctuation categories; symbols such as + and $ stay."""
    return F.regexp_replace(_c(value), "\\p{P}", "")


def matching_title(value: Column | str) -> Column:
    """The key titles are compared by: lower case, & as a word, no punctuation, single spaces, one leading article off."""
    text = F.regexp_replace(F.lower(clean_whitespace(value)), "&", " and ")
    return F.regexp_replace(clean_whitespace(strip_punctuation(text)), "^(the|a|an) ", "")


def normalize_issn(value: Column | str) -> Column:
    """Eight characters, digits but for an X at the end, without the hyphen; null for anything else. No checksum."""
    return or_null(F.regexp_extract(F.upper(F.replace(strip(value), F.lit("-"), F.lit(""))), "^[0-9]{7}[0-9X]$", 0))


def split_multi_issn(value: Column | str) -> Column:
    """The valid identifiers of a comma-separated list, in order, repeats kept; an empty array for missing."""
    return F.coalesce(F.filter(F.transform(F.split(_c(value), ","), normalize_issn), lambda x: x.isNotNull()), F.array().cast("array<string>"))


def issn_checksum(value: Column | str) -> Column:
    """Whether the weighted digits, 8 to 2 and the check character (X is 10), add up to a multiple of 11; false for no ISSN."""
    bare = normalize_issn(value)
    digits = sum((F.substring(bare, k, 1).cast("int") * (9 - k) for k in range(1, 8)), F.lit(0))
    check = F.when(F.substring(bare, 8, 1) == "X", 10).otherwise(F.substring(bare, 8, 1).try_cast("int"))
    return F.coalesce((digits + check) % 11 == 0, F.lit(False))


def split_publisher(value: Column | str) -> Column:
    """struct(name, publisher, confidence) of a name with a publisher after its last comma.

    Without a comma: none. A side that's empty, or a part that shows it is no publisher: low, and the name stays whole.
    """
    whole = clean_whitespace(value)
    left, right = F.trim(F.regexp_extract(whole, "^(.*),([^,]*)$", 1)), F.trim(F.regexp_extract(whole, "^(.*),([^,]*)$", 2))
    low = (left == "") | (right == "") | F.lower(right).rlike("|".join(NOT_PUBLISHERS))
    none = ~whole.contains(",")
    return F.struct(
        F.when(none | low, whole).otherwise(left).alias("name"),
        F.when(~none & ~low, right).alias("publisher"),
        F.when(none, "none").when(low, "low").otherwise("high").alias("confidence"),
    )


#: Digits are bounded so that what fits is finite as a double.
_NUMBER = "^[+-]?(?:[0-9]{1,200}\\.?[0-9]{0,200}|\\.[0-9]{1,200})(?:[eE][+-]?[0-9]{1,2})?$"


def _number(text: Column) -> Column:
    return F.regexp_extract(text, _NUMBER, 0).try_cast("double")


def parse_decimal_comma(value: Column | str) -> Column:
    """A double; one comma and no point is a decimal comma. Null for what is missing, not finite or no number."""
    return _number(F.regexp_replace(strip(_c(value).cast("string")), "^([^,.]*),([^,.]*)$", "$1.$2"))


def parse_int(value: Column | str) -> Column:
    """A long from a whole number, also one written like 2003.0 or 1e3; null for the rest. Booleans are 0 and 1."""
    text = strip(_c(value).cast("string"))
    number = _number(text)
    plain = F.regexp_extract(text, "^([+-]?[0-9]{1,18})(?:\\.0*)?$", 1).try_cast("long")
    return F.coalesce(plain, F.when(number == F.floor(number), number.try_cast("long")), F.when(text.isin("true", "false"), (text == "true").cast("long")))


def parse_year(value: Column | str) -> Column:
    year = parse_int(value)
    return F.when(year.between(1000, 9999), year.cast("int"))


def quartile(value: Column | str) -> Column:
    text = F.upper(strip(value))
    return F.when(text.isin("Q1", "Q2", "Q3", "Q4"), text)


def abdc_rating(value: Column | str) -> Column:
    text = F.upper(strip(value))
    return F.when(text.isin("A*", "A", "B", "C"), text)


def yes(value: Column | str) -> Column:
    """True only for yes, whatever its case; false for missing."""
    return F.coalesce(F.lower(strip(value)) == "yes", F.lit(False))


def in_range(value: Column | str, least, most) -> Column:
    """Within both bounds; false for null."""
    return F.coalesce(_c(value).between(least, most), F.lit(False))


def parse_categories(value: Column | str) -> Column:
    """array of struct(category_name, quartile) from `Name (Q1); Name`; an entry without a quartile keeps its text."""
    shape = "^(.*)\\s\\((Q[1-4])\\)$"
    parts = F.filter(F.transform(F.split(_c(value), ";"), clean_whitespace), lambda x: x != "")
    entry = lambda x: F.struct(F.when(x.rlike(shape), F.regexp_extract(x, shape, 1)).otherwise(x).alias("category_name"), or_null(F.regexp_extract(x, shape, 2)).alias("quartile"))
    return F.coalesce(F.transform(parts, entry), F.array().cast("array<struct<category_name:string,quartile:string>>"))


def parse_areas(value: Column | str) -> Column:
    return F.coalesce(F.filter(F.transform(F.split(_c(value), ";"), clean_whitespace), lambda x: x != ""), F.array().cast("array<string>"))


def first_non_empty(columns: Iterable[str], available: Iterable[str]) -> Column:
    """The first of the columns, among those there are, that isn't blank."""
    there = set(available)
    found = [or_null(clean_whitespace(F.col(f"`{c}`").cast("string"))) for c in columns if c in there]
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def row_json(columns: Iterable[str]) -> Column:
    """The columns as JSON, sorted by name, nulls kept, so that equal rows have equal text whatever their column order."""
    return F.to_json(F.struct(*[F.col(f"`{c}`").alias(c) for c in sorted(columns)]), {"ignoreNullFields": "false"})


def row_hash(columns: Iterable[str]) -> Column:
    """SHA-256 of the row before any normalization; blank text and NaN don't change to null, null and NaN are alike."""
    return F.sha2(row_json(columns).cast("binary"), 256)


def lookup(value: Column | str, table: Mapping) -> Column:
    """The entry of a small fixed table; null for a key that it lacks."""
    return F.element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), _c(value)) if table else F.lit(None)




def normalize_identifier(kind: Column | str, value: Column | str) -> Column:
    return F.when(_c(kind).isin("ISSN", "EISSN"), normalize_issn(value)).otherwise(or_null(strip(value)))


def distinct_issns(*values: Column | str) -> Column:
    """Valid identifiers of several columns, in order, each once."""
    return F.array_distinct(F.array_compact(F.array(*[normalize_issn(v) for v in values])))


def journal_ids_of(listed: Column | str, message: Column | str) -> Column:
    """Sorted distinct ids from a list such as `3;8`, or, if that's missing, from `journal 3` or `journal_id=8` in a message."""
    numbers = F.when(~is_missing(listed), F.regexp_extract_all(_c(listed), F.lit("([0-9]+)"), F.lit(1))).otherwise(F.regexp_extract_all(F.coalesce(_c(message), F.lit("")), F.lit("(?i)journal(?:_id)?s?[ =:#]*([0-9]+)"), F.lit(1)))
    return F.array_sort(F.array_distinct(F.transform(F.coalesce(numbers, F.array().cast("array<string>")), lambda x: x.cast("long"))))


def utc_text(ts: Column | str) -> Column:
    return F.date_format(_c(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def rounded(value: Column | str, scale: int) -> Column:
    """Half up, as a decimal column stores it: decimal(scale + 1, scale)."""
    return F.round(_c(value).cast("decimal(18,10)"), scale).cast(f"decimal({scale + 1},{scale})")
