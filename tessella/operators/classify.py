"""Classification of archive members: every member is a resource or an exclusion with one reason."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.functions import expressions as E
from tessella.schemas import ConfigError

# Fixed values.
LOCALIZED = r"(?:^|/)[^/]+_(?:[a-z]{2,3})(?:_(?:[A-Z]{2}|[A-Za-z]{4})(?:_[A-Z]{2})?)?\.properties$"
PATTERN_TYPES = (
    ("*.properties", "properties"),
    ("inspectionDescriptions/**/*.html", "inspection_description"),
    ("intentionDescriptions/**/*.html", "intention_description"),
    ("fileTemplates/**/*.html", "file_template"),
    ("postfixTemplates/**/*.xml", "postfix_template"),
    ("postfixTemplates/**/*.html", "postfix_template"),
    ("tips/**/*.html", "tip"),
)
TYPE_PLACES = {"inspection_description": "inspectionDescriptions/", "intention_description": "intentionDescriptions/", "file_template": "fileTemplates/", "postfix_template": "postfixTemplates/", "tip": "tips/"}
ANCILLARY = {"prefixes": ("META-INF/plugin",), "substrings": ("__index__",), "suffixes": (".class", ".svg", ".png")}
CONTAINER_REASONS, RESOURCE_REASONS = ("third_party_container", "already_localized"), ("non_translatable_resource",)


@dataclass(frozen=True)
class ScanRules:
    """container_rules: (glob, reason); resource_rules: (container glob, resource glob, reason); selections: (path, container)."""

    container_rules: tuple = ()
    resource_rules: tuple = ()
    selections: tuple = ()
    patterns: tuple = tuple(p for p, _ in PATTERN_TYPES)
    localization_directories: tuple = ("i18n", "l10n")
    reference_containers: tuple = ()
    require_reference: bool = False
    limits: dict = field(default_factory=lambda: {"max_containers": 20_000, "max_members": 2_000_000, "max_outer_members": 100_000, "max_nested_jar_bytes": 512 << 20, "max_resource_bytes": 16 << 20, "max_total_nested_jar_bytes": 8 << 30, "max_total_resource_bytes": 4 << 30})

    def __post_init__(self):
        for _, reason in self.container_rules:
            if reason not in CONTAINER_REASONS:
                raise ConfigError(f"no reason for containers: {reason}")
        for *_, reason in self.resource_rules:
            if reason not in RESOURCE_REASONS:
                raise ConfigError(f"no reason for resources: {reason}")
        if unknown := set(self.patterns) - {p for p, _ in PATTERN_TYPES}:
            raise ConfigError(f"unknown patterns: {sorted(unknown)}")
        for name, value in self.limits.items():
            if type(value) is not int or value < 1:
                raise ConfigError(f"{name} must be a positive integer")
        if len({p for p, _ in self.selections}) < len(self.selections):
            raise ConfigError("two selections for a resource")

    @classmethod
    def from_json(cls, text: str) -> ScanRules:
        from tessella.sources.jsonl import loads

        j = loads(text)
        return cls(
            tuple((r["glob"], r["reason"]) for r in j["container_exclusions"]),
            tuple((r["container"], r["resource"], r["reason"]) for r in j["resource_exclusions"]),
            tuple((r["resource"], r["container"]) for r in j["resource_selections"]),
            tuple(j["resource_patterns"]),
            tuple(j["localization_directories"]),
            tuple(j["translation_reference_containers"]),
            j["require_translation_reference"],
            {k: v for k, v in j["limits"].items() if k != "spool_memory_bytes"},
        )


def glob_regex(glob: str) -> str:
    """A case-sensitive glob as a Java (and RE2) pattern; `*` and `?` cross `/`."""
    out, i = [], 0
    while i < len(glob):
        c, i = glob[i], i + 1
        end = glob.find("]", i + 1 + (glob[i : i + 1] == "!")) if c == "[" else -1
        if c == "*":
            out.append(".*")
        elif c == "?":
            out.append(".")
        elif end > 0:
            body = glob[i:end].replace("\\", r"\\").replace("[", r"\[").replace("&&", r"&\&")
            out.append(f"[^{body[1:]}]" if body[0] == "!" else f"[{body}]" if body[0] != "^" else f"[\\{body}]")
            i = end + 1
        else:
            out.append(re.sub(r"([^A-Za-z0-9_/ ])", r"\\\1", c) if ord(c) < 128 else c)
    return f"(?s)^{''.join(out)}$"


def matches_glob(path: Column, glob: str) -> Column:
    return path.rlike(glob_regex(glob))


def matches_resource_glob(path: Column, glob: str) -> Column:
    """As `matches_glob`, but `/**/` may also stand for one slash."""
    shorter = glob.replace("/**/", "/")
    return matches_glob(path, glob) | matches_glob(path, shorter) if shorter != glob else matches_glob(path, glob)


def is_safe(path: Column) -> Column:
    return ~path.startswith("/") & ~F.array_contains(F.split(path, "/"), "..") & ~path.contains("\\")


def is_localized(path: Column, directories=("i18n", "l10n")) -> Column:
    return path.rlike(LOCALIZED) | F.arrays_overlap(F.split(F.lower(path), "/"), E.literal_set(directories))


def resource_type(path: Column, patterns=tuple(p for p, _ in PATTERN_TYPES)) -> Column:
    """The type of the first pattern that matches; null if none does."""
    return first_rule([(matches_resource_glob(path, p), t) for p, t in PATTERN_TYPES if p in patterns])


def first_rule(rules: list[tuple[Column, str]]) -> Column:
    out = None
    for when, what in rules:
        out = F.when(when, F.lit(what)) if out is None else out.when(when, F.lit(what))
    return F.lit(None).cast("string") if out is None else out


def is_supported(kind: Column, path: Column) -> Column:
    out = F.when(kind == "properties", path.endswith(".properties"))
    for k, prefix in TYPE_PLACES.items():
        out = out.when(kind == k, path.startswith(prefix) & (path.endswith(".html") | (path.endswith(".xml") if k == "postfix_template" else F.lit(False))))
    return out.otherwise(False)


def is_reference_path(path: Column, rules: ScanRules) -> Column:
    """Whether a reference archive's member counts: a resource of its own language that isn't ancillary."""
    a = ANCILLARY
    odd = [path.startswith(p) for p in a["prefixes"]] + [path.contains(s) for s in a["substrings"]] + [path.endswith(s) for s in a["suffixes"]]
    out = resource_type(path, rules.patterns).isNotNull() & is_safe(path)
    for o in odd:
        out = out & ~o
    return out


def outer_reason(name: Column, is_dir: Column, size: Column, rules: ScanRules) -> Column:
    """Why an outer member isn't opened, budgets aside; null if it is."""
    cascade = [(is_dir, "directory"), (~is_safe(name), "unsafe_path"), (~F.lower(name).endswith(".jar"), "not_jar")]
    cascade += [(matches_glob(name, g), r) for g, r in rules.container_rules]
    return first_rule(cascade), (size > rules.limits["max_nested_jar_bytes"])


def inner_reason(container: Column, path: Column, is_dir: Column, size: Column, in_reference: Column, rules: ScanRules) -> Column:
    """Why an inner member is no resource, budgets and read errors aside; null if it is."""
    kind = resource_type(path, rules.patterns)
    cascade = [
        (is_dir, "directory"),
        (~is_safe(path), "unsafe_path"),
        (F.lower(path).rlike(r"\.(?:jar|zip)$"), "nested_archive"),
        (is_localized(path, rules.localization_directories), "localized"),
        *((matches_glob(container, c) & matches_glob(path, p), r) for c, p, r in rules.resource_rules),
        (kind.isNull(), "unsupported_resource"),
        ((kind == "properties") & ~in_reference, "not_in_translation_reference"),
        (size > rules.limits["max_resource_bytes"], "resource_too_large"),
    ]
    return first_rule(cascade)


def first_rule_join(rows: DataFrame, rules: DataFrame, path: str) -> DataFrame:
    """rows with `reason` of the first rule (pos, glob_regex, reason) whose pattern matches. Rules are a configuration: they
    become one CASE, so that rows are neither joined nor shuffled and each pattern is compiled once."""
    ordered = sorted(rules.select("pos", "glob_regex", "reason").collect())
    return rows.withColumn("reason", first_rule([(F.col(path).rlike(r.glob_regex), r.reason) for r in ordered]))
