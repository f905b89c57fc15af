"""Java properties files: parsed without loss, and rendered with some values replaced."""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessella.schemas import PropertiesError

_LINE = re.compile(r"([^\r\n]*)(\r\n|\r|\n|\Z)")
_KEY = re.compile(r"(?:[^\\=: \t\f]|\\.|\\\Z)*", re.DOTALL)
_SEPARATOR = re.compile(r"[ \t\f]*(?:[=:][ \t\f]*)?")
_ESCAPE = re.compile(r"\\(?:u([0-9a-fA-F]{4})|(.))?", re.DOTALL)
_SHORT = {"t": "\t", "n": "\n", "r": "\r", "f": "\f"}
_SHOWN = {"\t": "\\t", "\n": "\\n", "\r": "\\r", "\f": "\\f", "\\": "\\\\", "=": "\\=", ":": "\\:"}


ENTRY = T.StructType([T.StructField(n, k) for n, k in (("pos", T.IntegerType()), ("key", T.StringType()), ("value", T.StringType()), ("start", T.IntegerType()), ("end", T.IntegerType()), ("newline", T.StringType()))])


class Entry(NamedTuple):
    """One occurrence: text[start:end] is its value as it stands, `newline` the end of its last line."""

    key: str
    value: str
    start: int
    end: int
    newline: str


def unescape(text: str) -> str:
    def one(m: re.Match) -> str:
        if m[1]:
            return chr(int(m[1], 16))
        if m[2] == "u":
            raise PropertiesError(f"malformed unicode escape at {m.start()}")
        return m[0] if m[2] is None else _SHORT.get(m[2], m[2])

    out = _ESCAPE.sub(one, text)
    try:  # pairs of surrogate escapes are one character
        return out.encode("utf-16", "surrogatepass").decode("utf-16")
    except UnicodeDecodeError:
        raise PropertiesError("lone surrogate escape") from None


def escape(value: str) -> str:
    out = "".join(_SHOWN.get(c, c) for c in value)
    return f"\\{out}" if value[:1] == " " else out


def decode(content: bytes) -> str:
    try:
        return content.decode("utf-8")
    except UnicodeDecodeError as e:
        raise PropertiesError(f"not UTF-8: {e}") from None


def parse(content: bytes) -> list[Entry]:
    """All occurrences in order. Equal repetitions of a key are fine, differing ones an error."""
    text, out, values, at = decode(content), [], {}, 0
    while at < len(text):
        m = _LINE.match(text, at)
        body, start = m[1].lstrip(" \t\f"), at
        at = m.end()
        if not body or body[0] in "#!":
            continue
        # places[i]: where the logical line's i-th character stands
        logical, places = body, list(range(start + len(m[1]) - len(body), m.end(1)))
        while (len(logical) - len(logical.rstrip("\\"))) % 2:
            if at >= len(text):
                raise PropertiesError("the last line is continued")
            m = _LINE.match(text, at)
            more = m[1].lstrip(" \t\f")
            logical, places = logical[:-1] + more, places[:-1] + list(range(m.end(1) - len(more), m.end(1)))
            at = m.end()
        k = _KEY.match(logical).end()
        v = _SEPARATOR.match(logical, k).end()
        key, value = unescape(logical[:k]), unescape(logical[v:])
        if values.setdefault(key, value) != value:
            raise PropertiesError(f"key with different values: {key}")
        out.append(Entry(key, value, places[v] if v < len(places) else m.end(1), m.end(1), m[2]))
    return out


def render(content: bytes, translations: dict[str, str]) -> bytes:
    """The file with the given values in place of its own; what doesn't change stays as it stands."""
    entries = parse(content)
    if unknown := sorted(set(translations) - {e.key for e in entries}):
        raise PropertiesError(f"unknown keys: {', '.join(unknown)}")
    text, at, out = decode(content), 0, []
    for e in entries:
        new = translations.get(e.key, e.value)
        if new != e.value:
            out += [text[at : e.start], escape(new)]
            at = e.end
    return "".join([*out, text[at:]]).encode("utf-8") if out else content


@F.udtf(returnType=ENTRY, useArrow=True)
class ParseProperties:
    """LATERAL parse_properties(content): a row for each occurrence."""

    def eval(self, content: bytes):
        for i, e in enumerate(parse(bytes(content or b""))):
            yield i, *e


def register(spark) -> None:
    spark.udtf.register("parse_properties", ParseProperties)
