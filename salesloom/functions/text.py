"""Text expressions: trimming, defaults, ids inside text, tag levels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The space separators (Unicode category Zs).
SPACES = (
    "\u0020\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"
)
# The other characters that count as white space in API and inbox text.
CONTROL_SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\u2028\u2029"


def trim_u(text: Column) -> Column:
    """Strip Unicode spaces on both sides. Tabs and line breaks stay."""
    return F.btrim(text, F.lit(SPACES))


def strip_all(text: Column) -> Column:
    """Strip every kind of white space on both sides."""
    return F.btrim(text, F.lit(SPACES + CONTROL_SPACES))


def empty_to(text: Column, default: str) -> Column:
    """NULL or '' becomes the default; blanks stay."""
    return F.coalesce(F.nullif(text, F.lit("")), F.lit(default))


def blank_to(text: Column, default: Column | str) -> Column:
    """NULL or blank text becomes the default; other text comes back stripped."""
    fallback = F.lit(default) if isinstance(default, str) else default
    return F.coalesce(F.nullif(strip_all(text), F.lit("")), fallback)


def clean_code(text: Column) -> Column:
    """Trimmed upper-case code, UNKNOWN when blank or NULL."""
    return F.upper(F.coalesce(F.nullif(trim_u(text), F.lit("")), F.lit("UNKNOWN")))


def or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def to_bigint(value: Column) -> Column:
    """Whole number from a number or from text; a fraction is rounded half to even, junk raises."""
    exact = value.try_cast(T.LongType())
    rounded = F.bround(value.cast(T.DecimalType(38, 6)), 0).cast(T.LongType())
    return F.when(value.isNull(), F.lit(None).cast(T.LongType())).otherwise(F.coalesce(exact, rounded))


def bigint_of(rows: DataFrame, column: str) -> Column:
    """A column as whole number; a column that already is one stays plain, so filters reach the scan."""
    if isinstance(rows.schema[column].dataType, T.IntegralType):
        return F.col(column).cast(T.LongType())
    return to_bigint(F.col(column))


def gid_number(gid: Column) -> Column:
    """The digits after the last slash of a global id, or NULL."""
    digits = F.regexp_extract(gid, r"/(\d+)\s*$", 1)
    return F.nullif(digits, F.lit("")).try_cast(T.LongType())


def level_from_tags(tags: Column, is_array: bool = False) -> Column:
    """Customer level from tags: a known tier word, else the first tag as a slug, else standard."""
    if is_array:
        kept = F.filter(F.transform(tags, strip_all), lambda tag: tag != "")
        text = F.nullif(F.array_join(kept, ","), F.lit(""))
    else:
        text = F.nullif(strip_all(tags), F.lit(""))
    lowered = F.lower(text)
    parts = F.filter(F.transform(F.split(text, ","), strip_all), lambda part: part != "")
    slug = F.replace(F.lower(F.try_element_at(parts, F.lit(1))), F.lit(" "), F.lit("_"))
    # The tier words, strongest first.
    level = F.when(lowered.contains("vip"), "vip")
    for tier in ("gold", "silver", "bronze"):
        level = level.when(lowered.contains(tier), tier)
    return F.coalesce(level.otherwise(slug), F.lit("standard"))


def shop_label(domain: Column, default: str = "shopify_store") -> Column:
    """Shop name out of its domain."""
    lowered = F.lower(strip_all(domain))
    # Fixed value: the domain suffix that is not part of the shop name.
    suffix = ".myshopify.com"
    return F.when(lowered.endswith(suffix), F.replace(lowered, F.lit(suffix), F.lit(""))).otherwise(
        F.coalesce(F.nullif(lowered, F.lit("")), F.lit(default))
    )


def store_domain(domain: Column) -> Column:
    """Shop domain without protocol and outer slashes, or NULL when it is not a shop domain."""
    bare = F.btrim(F.replace(F.replace(F.lower(domain), F.lit("https://"), F.lit("")), F.lit("http://"), F.lit("")), F.lit("/"))
    # Fixed value: the pattern of a shop domain.
    return F.when(bare.rlike(r"^[a-z0-9][a-z0-9-]*\.myshopify\.com\z"), bare)
