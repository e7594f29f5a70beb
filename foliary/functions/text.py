"""Text expressions for Markdown, all evaluated inside Spark's own expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def trimmed(s: Column) -> Column:
    """Without white space of any kind at both ends; Spark's own trim takes blanks only."""
    return F.regexp_replace(s, r"(?U)^\s+|\s+$", "")


def filled(s: Column) -> Column:
    """Null where a string is empty."""
    return F.when(s != "", s)


def extension_of(name: Column) -> Column:
    """The lower-case extension of a path or URL with its dot; empty if there is none.

    What follows a ? or # is cut; a name that begins with its only dot has none.
    """
    path = F.regexp_extract(name, r"^[^?#]*", 0)
    return F.lower(F.regexp_extract(F.regexp_extract(path, r"[^/\\]*$", 0), r"^.+(\.[^.]*)$", 1))


def without_extension(name: Column) -> Column:
    return F.regexp_replace(name, r"\.[^.]+$", "")


def table(rows: Column) -> Column:
    """A Markdown table of an array of arrays of finished cells; the first row is the header."""
    width = F.array_max(F.transform(rows, lambda r: F.size(r)))
    line = lambda r: F.concat(F.lit("| "), F.array_join(F.concat(r, F.array_repeat(F.lit(""), width - F.size(r))), " | "), F.lit(" |"))
    rule = F.concat(F.lit("| "), F.array_join(F.array_repeat(F.lit("---"), width), " | "), F.lit(" |"))
    body = F.transform(F.slice(rows, 2, F.greatest(F.size(rows) - 1, F.lit(0))), line)
    return F.array_join(F.concat(F.array(line(F.element_at(rows, 1)), rule), body), "\n")


def image(alt: Column, target: Column) -> Column:
    return F.concat(F.lit("!["), alt, F.lit("]("), target, F.lit(")"))


def link_target(target: Column) -> Column:
    """In angle brackets if it holds white space or signs that end a link."""
    return F.when(target.rlike(r"[\s()#<>]"), F.concat(F.lit("<"), F.replace(target, F.lit(">"), F.lit("%3E")), F.lit(">"))).otherwise(target)


def joined(parts: Column, separator: str) -> Column:
    """Parts that are not null or empty, in their order."""
    return F.array_join(F.filter(parts, lambda p: p.isNotNull() & (p != "")), separator)


def positive(text: Column) -> Column:
    """A whole number above zero written without leading zeros, else null."""
    return F.when(text.rlike(r"^[1-9]\d*$"), text.try_cast("bigint"))


def natural(text: Column) -> Column:
    return F.when(text.rlike(r"^(0|[1-9]\d*)$"), text.try_cast("bigint"))


def encoded(text: Column) -> Column:
    """Percent-encoding with %20 for blanks."""
    return F.replace(F.url_encode(text), F.lit("+"), F.lit("%20"))


def decoded(text: Column) -> Column:
    """What percent-encoding stands for; a plus sign stays."""
    return F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))


def boolean(text: Column) -> Column:
    """A flag without a value is set; else true or false in any case, and null for any other word."""
    word = F.lower(text)
    return F.when(text.isNull() | (word == "true"), True).when(word == "false", False)


def crc32(content: Column) -> Column:
    """Eight lower-case hex digits of the IEEE checksum."""
    return F.lpad(F.lower(F.hex(F.crc32(content))), 8, "0")


def new_uuid4() -> Column:
    return F.uuid()


def is_uuid4(text: Column) -> Column:
    return text.rlike(r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$")


def retriable(status: Column, message: Column) -> Column:
    """Whether a failed call is worth another try: a gateway's failure or a transport error, never another status."""
    named = F.regexp_extract(message, r"(?i)(?:API Error \(|Failed to download [^:]+: )(\d{3})\b", 1)
    status = F.coalesce(status.cast("int"), named.try_cast("int"))
    signs = ["network", "timeout", "fetch failed", "econnaborted", "etimedout", "enotfound", "econnrefused", "err_network"]
    by_text = F.lower(F.coalesce(message, F.lit(""))).rlike("|".join(signs))
    return F.when(status.isNotNull(), status.isin(502, 604)).otherwise(by_text)


def parameter(pair: Column) -> Column:
    """key and value (variant: JSON if it reads as JSON, else the text) of ``key=value``, cut at the first =."""
    value = F.regexp_extract(pair, r"(?s)^[^=]*=(.*)$", 1)
    return F.struct(F.regexp_extract(pair, r"^([^=]*)=", 1).alias("key"), F.coalesce(F.try_parse_json(value), value.cast("variant")).alias("value"))
