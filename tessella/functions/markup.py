"""Structure and links of markup fragments: a stream of events first, and all else derived from it."""

from __future__ import annotations

import re
from html.parser import HTMLParser
from typing import NamedTuple

from tessella.functions.expressions import TAG

_TAG = re.compile(TAG)
#: What makes a text markup at all.
_RELEVANT = re.compile(rf"{TAG}|<!--|<\?|(?i:<!DOCTYPE)")
#: Tags without content, and attributes that hold links.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
LINKING = frozenset(("href", "src"))


class Markup(NamedTuple):
    relevant: bool
    valid: bool
    structure: list[str]
    links: list[tuple[str, str, str]]
    attributes: list[str]


class Event(NamedTuple):
    """kind is one of open, empty (has no content), close, comment, pi, declaration."""

    kind: str
    name: str = ""
    attributes: tuple[tuple[str, str], ...] = ()

    def __str__(self) -> str:
        return " ".join([self.kind, self.name, *sorted(k for k, _ in self.attributes)]).strip()


def stream(text: str) -> list[Event]:
    """The parser's events as they come; what can't be parsed counts as a declaration."""
    out: list[Event] = []
    tag = lambda kind, name, attributes: out.append(Event(kind, name.lower(), tuple((k.lower(), v or "") for k, v in attributes)))
    parser = HTMLParser(convert_charrefs=True)
    parser.handle_starttag = lambda name, attributes: tag("empty" if name.lower() in VOID else "open", name, attributes)
    parser.handle_startendtag = lambda name, attributes: tag("empty", name, attributes)
    parser.handle_endtag = lambda name: tag("close", name, ())
    parser.handle_comment = lambda _: out.append(Event("comment"))
    parser.handle_pi = lambda _: out.append(Event("pi"))
    parser.handle_decl = lambda _: out.append(Event("declaration"))
    try:
        parser.feed(text)
        parser.close()
    except (ValueError, AssertionError):
        out.append(Event("declaration"))
    return out


def partners(events: list[Event]) -> tuple[dict[int, int], set[int]]:
    """close -> the open event that it ends, by place; and the places of events that have no partner."""
    waiting: list[int] = []
    ends: dict[int, int] = {}
    alone: set[int] = set()
    for i, e in enumerate(events):
        if e.kind == "open":
            waiting.append(i)
        elif e.kind == "close":
            if waiting and events[waiting[-1]].name == e.name:
                ends[i] = waiting.pop()
            else:
                alone.add(i)
    return ends, alone.union(waiting)


def places(events: list[Event], ends: dict[int, int]) -> dict[int, str]:
    """Where each element stands: its name and number among its siblings, after its parent's place."""
    out: dict[int, str] = {}
    inside, born = [""], {"": 0}
    for i, e in enumerate(events):
        if i in ends:
            inside.pop()
        elif e.kind in ("open", "empty"):
            parent = inside[-1]
            out[i] = f"{parent}/{e.name}[{born[parent]}]"
            born[parent] += 1
            if e.kind == "open":
                inside.append(out[i])
                born[out[i]] = 0
    return out


def parse_markup(text: str) -> Markup:
    if not _RELEVANT.search(text):
        return Markup(False, True, [], [], [])
    events = stream(text)
    ends, alone = partners(events)
    at = places(events, ends)
    valid = not alone and all(e.kind != "declaration" for e in events)
    told = [str(e) for i, e in enumerate(events) if e.kind != "declaration" and (e.kind != "close" or i in ends)]
    links = sorted((at[i], k, v) for i, e in enumerate(events) for k, v in e.attributes if k in LINKING)
    return Markup(True, valid, told, links, [v for e in events for _, v in e.attributes])


def without_tags(text: str) -> str:
    return _TAG.sub("", text)
