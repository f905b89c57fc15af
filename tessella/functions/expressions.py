"""Scalar functions that stay in the JVM: everything about text that built-in expressions can say."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed patterns.
PRINTF = r"%(?:%|(?:\d+\$)?[-#+ 0,(<]*\d*(?:\.\d+)?(?:[tT][HIklMSLNpzZsQBbhAaCYyjmdeRTrDFc]|[bBhHsScCdoxXeEfgGaAn]))"
TEMPLATE = r"\$\{[A-Za-z_][A-Za-z0-9_.-]*\}|\$[A-Za-z_][A-Za-z0-9_]*\$"
TAG = r"</?[A-Za-z][^<>]*>"
MNEMONIC = r"(?s)&&.?|(?<![\p{L}\p{N}])&[\p{L}\p{N}]|__.?|(?<![\p{L}\p{N}])_[\p{L}\p{N}]"
NEWLINE = r"\r\n|\r|\n"
LENGTH_RATIO = 2.5


def all_matches(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def sha256_text(text: Column) -> Column:
    return F.sha2(F.encode(text, "utf-8"), 256)


def joined_id(*parts: Column) -> Column:
    """sha256 of the parts with NUL between them."""
    out = parts[0]
    for p in parts[1:]:
        out = F.concat(out, F.lit("\0"), p)
    return sha256_text(out)


def path_stem(path: Column) -> Column:
    name = F.regexp_extract(path, r"([^/]*)/*$", 1)
    return F.when(name.rlike(r"^.+\.[^.]+$"), F.regexp_extract(name, r"^(.+)\.[^.]+$", 1)).otherwise(name)


def printf_tokens(text: Column) -> Column:
    """Conversions as they stand, prose percents included."""
    return all_matches(text, PRINTF)


def template_tokens(text: Column) -> Column:
    return all_matches(text, TEMPLATE)


def mnemonic_tokens(text: Column) -> Column:
    """`mnemonic:` or `escaped:` and the sign, for each access-key marker and each doubled one."""
    return F.transform(all_matches(text, MNEMONIC), lambda m: F.concat(F.when(m.startswith("&&") | m.startswith("__"), F.lit("escaped:")).otherwise(F.lit("mnemonic:")), F.substring(m, 1, 1)))


def tag_tokens(text: Column) -> Column:
    return all_matches(text, TAG)


def strip_tags(text: Column) -> Column:
    return F.regexp_replace(text, TAG, "")


def is_blank(text: Column) -> Column:
    return ~text.rlike(r"(?U)\S")


def empty_target(source: Column, target: Column) -> Column:
    return is_blank(target) & ~is_blank(source)


def length_ratio(source: Column, target: Column) -> Column:
    return (F.length(source) > 0) & (F.length(target) > LENGTH_RATIO * F.length(source))


def glossary_pattern(glossary: Mapping[str, str | Sequence[str]]) -> str | None:
    """A Java pattern of all variants that differ from their preferred term, as whole words in any case."""
    variants = [v for preferred, raw in glossary.items() for v in ([raw] if isinstance(raw, str) else raw) if v.casefold() != preferred.casefold()]
    return "(?iuU)(?<!\\w)(?:" + "|".join("\\Q" + v.replace("\\E", "\\E\\\\E\\Q") + "\\E" for v in variants) + ")(?!\\w)" if variants else None


def glossary_mismatch(target: Column, glossary: Mapping[str, str | Sequence[str]] | None) -> Column:
    pattern = glossary_pattern(glossary or {})
    return target.rlike(pattern) if pattern else F.lit(False)


def same_multiset(a: Column, b: Column) -> Column:
    return F.array_sort(a) == F.array_sort(b)


def natural_lines(text: Column) -> Column:
    return F.split(text, NEWLINE)


def is_continued(line: Column) -> Column:
    return F.length(F.regexp_extract(line, r"(\\*)$", 1)) % 2 == 1


_KEY = r"^((?:[^\\=:\x20\t\f]|\\[\s\S])*)"


def split_property(line: Column) -> Column:
    """struct<key, value>, both still escaped, of one logical line without its leading blanks."""
    return F.struct(F.regexp_extract(line, _KEY, 1).alias("key"), F.regexp_extract(line, _KEY + r"[\x20\t\f]*[=:]?[\x20\t\f]*([\s\S]*)$", 2).alias("value"))


def escape_value(value: Column) -> Column:
    """A value as it stands in a properties file: a leading blank, backslash, = and :, and control signs escaped."""
    out = F.regexp_replace(value, r"([\\=:])", r"\\$1")
    for raw, shown in (("\t", r"\\t"), ("\n", r"\\n"), ("\r", r"\\r"), ("\f", r"\\f")):
        out = F.regexp_replace(out, raw, r"\\" + shown[1:])
    return F.regexp_replace(out, r"^(\x20)", r"\\$1")


def escape_html(text: Column, quote: bool = False) -> Column:
    for raw, shown in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), *((('"', "&quot;"), ("'", "&#x27;")) if quote else ())):
        text = F.replace(text, F.lit(raw), F.lit(shown))
    return text


def escape_markdown(text: Column) -> Column:
    out = escape_html(text, quote=True)
    for raw, shown in (("|", "&#124;"), ("`", "&#96;"), ("\n", " ")):
        out = F.replace(out, F.lit(raw), F.lit(shown))
    return out


def newline_styles(text: Column) -> Column:
    return F.array_distinct(all_matches(text, NEWLINE))


def normalise_newlines(source: Column, target: Column) -> Column:
    """target in source's newline style and with its final newline or none; an error where source mixes styles or has no
    newline but target has several lines."""
    styles = newline_styles(source)
    style = F.get(styles, F.lit(0))
    body = F.regexp_replace(F.regexp_replace(target, NEWLINE, "\n"), r"\n+\z", "")
    ended = F.concat(F.replace(body, F.lit("\n"), style), F.when(source.rlike(r"[\r\n]\z"), style).otherwise(F.lit("")))
    return (
        F.when(F.size(styles) > 1, F.raise_error(F.lit("source mixes newline styles")).cast("string"))
        .when((F.size(styles) == 0) & body.contains("\n"), F.raise_error(F.lit("source has one line, target several")).cast("string"))
        .when(F.size(styles) == 0, body)
        .otherwise(ended)
    )


def decode_utf8(content: Column) -> Column:
    """Text of a UTF-8 file without its byte-order mark; null where it isn't UTF-8."""
    text = F.when(F.is_valid_utf8(content.cast("string")), content.cast("string"))
    return F.regexp_replace(text, "^﻿", "")


def output_path(path: Column, suffix: str = "_de") -> Column:
    return F.when(path.endswith(".properties"), F.concat(F.regexp_extract(path, r"(?s)^(.*)\.properties$", 1), F.lit(f"{suffix}.properties"))).otherwise(path)


def id_prefix(c: Column, n: int = 12) -> Column:
    return F.substring(c, 1, n)


def is_sha256(c: Column) -> Column:
    return c.rlike("^[0-9a-f]{64}$")


def literal_set(values: Iterable[str]) -> Column:
    return F.array(*(F.lit(v) for v in values)) if (values := list(values)) else F.array().cast("array<string>")
