"""Column functions for text. All stay in the JVM.

Regular expressions name letters and digits by their Unicode classes, since \\w is ASCII in Java. White space is Unicode white space.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..plans import settings as S

WORD = r"[\p{L}\p{N}_]+"
LONG_WORD = r"[\p{L}\p{N}_]{4,}"
#: Two or more capitalised words in a row, in Latin letters with the marks of Vietnamese (fixed pattern).
UPPER = "A-ZÀÁẢÃẠĂẮẰẲẴẶÂẤẦẨẪẬÐĐÈÉẺẼẸÊẾỀỂỄỆÌÍỈĨỊÒÓỎÕỌÔỐỒỔỖỘƠỚỜỞỠỢÙÚỦŨỤƯỨỪỬỮỰỲÝỶỸỴ"
LOWER = "a-zàáảãạăắằẳẵặâấầẩẫậðđèéẻẽẹêếềểễệìíỉĩịòóỏõọôốồổỗộơớờởỡợùúủũụưứừửữựỳýỷỹỵ"
PROPER_NOUN = rf"[{UPPER}][{LOWER}]*(?:\s+[{UPPER}][{LOWER}]*)+"
#: "<number>. <8 digits> " begins a row of a table (fixed pattern).
TABLE_ROW = r"(?<!^)(?<!\n)(\d+\.\s+\d{8}\s+)"
MEDIA = r"(?is)(<table.*?</table>|<img[^>]*>)"


def strip(text: Column) -> Column:
    """Without Unicode white space at either end."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def blank_is_null(text: Column) -> Column:
    return F.when(text != "", text)


def first_given(*names: Column) -> Column:
    """The first that is neither null nor empty, else "unknown"."""
    return F.coalesce(*[blank_is_null(c) for c in names], F.lit("unknown"))


def file_name(source: Column, given: Column | None = None) -> Column:
    """The part after the last "/", where there is one and no name is given."""
    own = F.when(F.contains(source, F.lit("/")), F.substring_index(source, "/", -1))
    return own if given is None else F.coalesce(given, own)


def token_estimate(text: Column) -> Column:
    """0 for null or empty text, else its characters by CHARS_PER_TOKEN, rounded down, and one."""
    n = F.length(text)
    return F.when(text.isNull() | (n == 0), F.lit(0)).otherwise(F.floor(n / F.lit(S.CHARS_PER_TOKEN)).cast("int") + 1)


def payload_estimate(prompt: Column, *extras: Column) -> Column:
    """Tokens of a request: the prompt, further strings and the frame."""
    total = token_estimate(prompt)
    for x in extras:
        total = total + token_estimate(x)
    return total + S.REQUEST_TOKENS


def lines(text: Column) -> Column:
    """Stripped lines that are not blank, in order."""
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), strip), lambda x: x != "")


def words(text: Column) -> Column:
    """Runs of anything but white space; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"(?U)\s+"), lambda x: x != "")


def tokens(text: Column, pattern: str = WORD) -> Column:
    """Different lower-case words."""
    return F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(f"({pattern})"), F.lit(1)))


def phrases(text: Column) -> Column:
    """Proper-noun phrases of more than three characters; repeats are kept."""
    found = F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"({PROPER_NOUN})"), F.lit(1)), strip)
    return F.filter(found, lambda p: F.length(p) > 3)


def count_in(part: Column, whole: Column) -> Column:
    """How often part (not empty) occurs in whole, without overlap."""
    return ((F.length(whole) - F.length(F.replace(whole, part, F.lit("")))) / F.length(part)).cast("int")


def table_rows_apart(text: Column) -> Column:
    """A line feed before each row of a table that does not begin a line."""
    return F.regexp_replace(text, TABLE_ROW, "\n$1")


def media_segments(text: Column) -> Column:
    """array<struct<segment, is_media>>: tables and images apart from what stands between them, in order, nothing empty."""
    media = F.regexp_extract_all(text, F.lit(MEDIA), F.lit(1))
    between = F.split(text, MEDIA, -1)
    one = lambda value, flag: F.array(F.struct(value.alias("segment"), F.lit(flag).alias("is_media")))
    mixed = F.flatten(F.zip_with(between, media, lambda b, m: F.concat(one(b, False), one(m, True))))
    return F.filter(mixed, lambda s: s["segment"].isNotNull() & (s["segment"] != ""))


def snippet(text: Column, n: int | Column = S.SNIPPET_WORDS) -> Column:
    """The first n words and " ...", or the text as it is if it has no more."""
    found, n = words(text), F.lit(n) if isinstance(n, int) else n
    return F.when(F.size(found) <= n, text).otherwise(F.concat(F.array_join(F.slice(found, F.lit(1), n), " "), F.lit(" ...")))


def fill(template: Column | str, **values: Column) -> Column:
    """Literal replacement of {name} by a value, one name after the other; a value may bring in a later name, as in a chain of replacements."""
    out = F.lit(template) if isinstance(template, str) else template
    for name, value in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), F.coalesce(value, F.lit("")))
    return out


def without_fences(text: Column) -> Column:
    """Without ```json and ``` marks, stripped."""
    return strip(F.replace(F.replace(text, F.lit("```json"), F.lit("")), F.lit("```"), F.lit("")))


def outer_braces(text: Column, guarded: bool = True) -> Column:
    """From the first { to the last }, of text without fences. Without both: the stripped text if guarded, else empty."""
    plain = F.replace(F.replace(text, F.lit("```json"), F.lit("")), F.lit("```"), F.lit(""))
    found = F.regexp_extract(plain, r"(?s)(\{.*\})", 1)
    return F.when(found != "", found).otherwise(strip(plain) if guarded else F.lit(""))


def stable_id(*parts: Column) -> Column:
    """A reproducible id in place of a random one."""
    return F.sha2(F.concat_ws("\u0001", *[F.coalesce(p.cast("string"), F.lit("\u0002")) for p in parts]), 256)
