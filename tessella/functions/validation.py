"""Findings of translated pairs: what built-in expressions can tell, and one Arrow UDF for the rest."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessella.functions import expressions as E
from tessella.functions.markup import Markup, parse_markup, without_tags
from tessella.functions.messages import Message, parse_message, placeholders
from tessella.schemas import BLOCKING, FINDING_CODES


def messages_in(text: str, markup: Markup) -> Message:
    """Message formats of the visible text and of each attribute value."""
    parsed = [parse_message(without_tags(text) if markup.relevant else text), *map(parse_message, markup.attributes)]
    return Message([t for p in parsed for t in p.tokens], all(p.valid for p in parsed), any(p.recognized for p in parsed))


def deep_codes(source: str, target: str) -> list[str]:
    """Codes that need parsing: message formats, markup, placeholders."""
    ms, mt = parse_markup(source), parse_markup(target)
    fs, ft = messages_in(source, ms), messages_in(target, mt)
    codes = []
    if (fs.recognized or ft.recognized) and fs.valid and not ft.valid:
        codes.append("message_format_invalid")
    if ms.relevant or mt.relevant:
        if (ms.valid and not mt.valid) or ms.structure != mt.structure:
            codes.append("markup_structure_changed")
        elif ms.links != mt.links:
            codes.append("link_changed")
    if placeholders(source, fs) != placeholders(target, ft):
        codes.append("placeholder_mismatch")
    return codes


@F.pandas_udf(T.ArrayType(T.StringType()))
def _deep(source: pd.Series, target: pd.Series) -> pd.Series:
    return pd.Series([deep_codes(a or "", b or "") for a, b in zip(source, target, strict=True)])


def needs_parsing(source: Column, target: Column) -> Column:
    """Braces, percents and tags only; all other pairs are settled by built-in expressions."""
    return source.rlike("[{%<]") | target.rlike("[{%<]")


def finding_codes(source: Column, target: Column, glossary: dict | None = None) -> Column:
    """array<string> of a pair's codes in listing order. The UDF runs on rows that hold a brace, a percent or a tag."""
    needed = needs_parsing(source, target)
    shallow = ~(E.same_multiset(E.template_tokens(source), E.template_tokens(target)) & E.same_multiset(E.mnemonic_tokens(source), E.mnemonic_tokens(target)))
    # rows that need no parsing hand nulls to the UDF, which costs next to nothing
    deep = _deep(F.when(needed, source), F.when(needed, target))
    told = F.when(needed, deep).when(shallow, F.array(F.lit("placeholder_mismatch"))).otherwise(F.array().cast("array<string>"))
    flags = {"empty_target": E.empty_target(source, target), "length_ratio": E.length_ratio(source, target), "glossary_mismatch": E.glossary_mismatch(target, glossary)}
    each = [F.when(flags[c] if c in flags else F.array_contains(told, c), F.lit(c)) for c in FINDING_CODES]
    return F.filter(F.array(*each), lambda c: c.isNotNull())


def findings(source: Column, target: Column, glossary: dict | None = None) -> Column:
    return with_severity(finding_codes(source, target, glossary))


def with_severity(codes: Column) -> Column:
    return F.transform(codes, lambda c: F.struct(c.alias("code"), F.when(c.isin(*BLOCKING), "blocking").otherwise("warning").alias("severity")))


def is_blocking(found: Column) -> Column:
    return F.exists(found, lambda f: f["severity"] == "blocking")


def status(source: Column, target: Column, found: Column) -> Column:
    """A unit's status from its texts and findings: open without a target, translated while something blocks."""
    return F.when((F.length(target) == 0) & (F.length(source) > 0), "open").when(is_blocking(found), "translated").otherwise("technically_reviewed")


def validate_translation(source: str, target: str, glossary: dict | None = None) -> list[tuple[str, str]]:
    """One pair's (code, severity), without Spark."""
    import re

    codes = set(deep_codes(source, target))
    if not target.strip() and source.strip():
        codes.add("empty_target")
    if source and len(target) > E.LENGTH_RATIO * len(source):
        codes.add("length_ratio")
    variants = [v for p, raw in (glossary or {}).items() for v in ([raw] if isinstance(raw, str) else raw) if v.casefold() != p.casefold()]
    if any(re.search(rf"(?<!\w){re.escape(v)}(?!\w)", target, re.IGNORECASE) for v in variants):
        codes.add("glossary_mismatch")
    return [(c, "blocking" if c in BLOCKING else "warning") for c in FINDING_CODES if c in codes]
