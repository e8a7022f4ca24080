"""Column functions over text, with one notion of white space in all of them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space as Unicode-aware string functions see it, on every code point.
SPACE = r"\t-\r\x1c-\x20\x{85}\p{Z}"
WORD = rf"[^{SPACE}]+"

# Lower-case fragments of a push's error text after which another attempt is useless.
PERMANENT = [
    "gh001:", "gh006:", "gh013:", "large files detected", "exceeds github's file size limit", "pre-receive hook declined", "protected branch hook declined", "remote rejected",
    "permission denied", "authentication failed", "access denied", "write access to repository not granted", "requested url returned error: 401", "requested url returned error: 403",
    "repository not found", "could not read from remote repository", "does not appear to be a git repository", "src refspec", "updates were rejected", "non-fast-forward",
]
# Manifest names that are public besides those ending in .sha.
PUBLIC_NAMES = ["checksum", "checksum.json", "translations", "translations.json", "books", "books.json", "chapters", "chapters.json"]
# XML's spellings of booleans.
TRUE_WORDS, FALSE_WORDS = ["true", "1", "yes"], ["false", "0", "no"]


def strip(c: Column) -> Column:
    """c without white space at its ends."""
    return F.regexp_replace(c, rf"^[{SPACE}]+|[{SPACE}]+$", "")


def strip_leading_eol(c: Column) -> Column:
    """c without the carriage returns and line feeds it begins with."""
    return F.regexp_replace(c, r"^[\r\n]+", "")


def is_blank(c: Column, ignored: str = "[]") -> Column:
    """Whether nothing but white space is left without the ignored string; null for null."""
    return F.length(strip(F.replace(c, F.lit(ignored), F.lit("")) if ignored else c)) == 0


def collapse(c: Column) -> Column:
    """c with runs of white space as one space, stripped."""
    return strip(F.regexp_replace(c, rf"[{SPACE}]+", " "))


def chapter_name(book: Column, chapter: Column) -> Column:
    return F.concat(book, F.lit(" "), chapter.cast("string"))


def verse_name(book: Column, chapter: Column, verse: Column) -> Column:
    return F.concat(book, F.lit(" "), chapter.cast("string"), F.lit(":"), verse.cast("string"))


def normalized_name(c: Column) -> Column:
    """Letters and digits alone, in lower case."""
    return F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]", "")


def human_bytes(c: Column) -> Column:
    """A size with the largest unit of 1024 that it reaches, with two decimals."""
    n = c.cast("double")
    return (
        F.when(n < 1024, F.concat(F.format_string("%.2f", n), F.lit(" B")))
        .when(n < 1024.0**2, F.concat(F.format_string("%.2f", F.bround(n / 1024, 2)), F.lit(" KiB")))
        .when(n < 1024.0**3, F.concat(F.format_string("%.2f", F.bround(n / 1024**2, 2)), F.lit(" MiB")))
        .otherwise(F.concat(F.format_string("%.2f", F.bround(n / 1024**3, 2)), F.lit(" GiB")))
    )


def is_safe_path(c: Column) -> Column:
    """Whether a relative path stays below its root: not empty, absolute, with backslashes or NUL, and without
    empty, '.' or '..' parts."""
    return F.coalesce((F.length(c) > 0) & ~c.rlike(r"\\|\x00") & ~c.rlike(r"(^|/)(\.{0,2})(/|$)"), F.lit(False))


def is_within(path: Column, root: Column) -> Column:
    """Whether path is root or below it."""
    clean = lambda x: F.regexp_replace(x, "/+$", "")
    return (clean(path) == clean(root)) | path.startswith(F.concat(clean(root), F.lit("/")))


def is_public_name(c: Column) -> Column:
    """Whether a manifest file may leave the data tree."""
    return c.endswith(".sha") | c.isin(PUBLIC_NAMES)


def is_permanent_failure(c: Column, markers: list[str] = PERMANENT) -> Column:
    low = F.lower(c)
    return F.exists(F.array(*[F.lit(m) for m in markers]), lambda m: F.contains(low, m))


def version_of(c: Column) -> Column:
    """The first three-part version in a text, null without one."""
    return F.nullif(F.regexp_extract(c, r"(\d+\.\d+\.\d+)", 1), F.lit(""))


def xml_boolean(c: Column) -> Column:
    """True, false, or null for what is neither."""
    low = F.lower(strip(c))
    return F.when(low.isin(TRUE_WORDS), True).when(low.isin(FALSE_WORDS), False)


def long_date(c: Column, zone: str) -> Column:
    """A time in UTC as the date in a zone: Monday 05-January, 2026."""
    return F.date_format(F.from_utc_timestamp(c, zone), "EEEE dd-MMMM, yyyy")


def joined_url(*parts: Column) -> Column:
    return F.concat_ws("/", *parts)


def scheme_groups(c: Column, default: str = "default") -> Column:
    """map from scheme to its values in order, of a text like 'a:x a:y z'. What has no scheme, or an empty one,
    falls to default; empty values count as values; schemes come in the order they are first seen."""
    parts = F.filter(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(f"({WORD})"), F.lit(1)), lambda x: F.length(x) > 0)
    at = lambda x: F.instr(x, ":")
    pairs = F.transform(
        parts,
        lambda x: F.struct(
            F.when(at(x) > 1, F.substring_index(x, ":", 1)).otherwise(F.lit(default)).alias("scheme"),
            F.when(at(x) > 0, F.regexp_replace(x, "^[^:]*:", "")).otherwise(x).alias("value"),
        ),
    )
    schemes = F.array_distinct(F.transform(pairs, lambda p: p["scheme"]))
    return F.map_from_entries(F.transform(schemes, lambda s: F.struct(s, F.transform(F.filter(pairs, lambda p: p["scheme"] == s), lambda p: p["value"]))))
