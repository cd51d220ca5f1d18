"""Keywords: from strings or nested lists to a tree of terms, prefixes and phrases."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

_QUOTED = re.compile(r'"([^"]*)"')
_WORD = re.compile(r"[^\W_]+")


@dataclass(frozen=True)
class Term:
    token: str


@dataclass(frozen=True)
class Prefix:
    token: str


@dataclass(frozen=True)
class Phrase:
    tokens: tuple[str, ...]


@dataclass(frozen=True)
class And:
    members: tuple


@dataclass(frozen=True)
class Or:
    members: tuple


Node = Term | Prefix | Phrase | And | Or


def tokens(text: str) -> list[str]:
    """The ``simple`` tokens of a string: lower case, letters and digits."""
    return _WORD.findall(text.lower())


def is_valid(keys: Any) -> bool:
    """A non-blank scalar, or a mapping or list with at least one valid member; ``#`` settings don't count."""
    if keys is None or isinstance(keys, bool):
        return False
    if isinstance(keys, dict):
        return any(is_valid(v) for k, v in keys.items() if not str(k).startswith("#"))
    if isinstance(keys, (list, tuple)):
        return any(map(is_valid, keys))
    return bool(str(keys).strip())


def flatten(keys: Any) -> str:
    """All members of nested keys in depth-first order, joined by spaces, without settings."""
    if isinstance(keys, dict):
        return " ".join(x for k, v in keys.items() if not str(k).startswith("#") and (x := flatten(v)))
    if isinstance(keys, (list, tuple)):
        return " ".join(x for v in keys if (x := flatten(v)))
    return "" if keys is None else str(keys).strip()


def _all(members: list[Node], kind: type) -> Node | None:
    members = [m for m in members if m is not None]
    return members[0] if len(members) == 1 else kind(tuple(members)) if members else None


def parse_text(text: str, prefixes: bool = False) -> Node | None:
    """Quoted runs are phrases, which are alternatives to each other; bare words must all match (as prefixes, if asked)."""
    phrases = [Phrase(tuple(t)) if len(t) > 1 else Term(t[0]) for q in _QUOTED.findall(text) if (t := tokens(q))]
    words = [Prefix(t) if prefixes else Term(t) for t in tokens(_QUOTED.sub(" ", text))]
    return _all([_all(phrases, Or), _all(words, And)], And)


def parse(keys: Any, prefixes: bool = False) -> Node | None:
    """The tree of keys: nested groups keep their ``#conjunction``; None if nothing is asked for."""
    if not is_valid(keys):
        return None
    if isinstance(keys, dict):
        kind = Or if str(keys.get("#conjunction", "AND")).upper() == "OR" else And
        return _all([parse(v, prefixes) for k, v in keys.items() if not str(k).startswith("#")], kind)
    if isinstance(keys, (list, tuple)):
        return _all([parse(v, prefixes) for v in keys], And)
    return parse_text(str(keys), prefixes)


def mapped(node: Node, change: Callable[[str], str]) -> Node:
    """The tree with each token changed."""
    if isinstance(node, (And, Or)):
        return type(node)(tuple(mapped(m, change) for m in node.members))
    return Phrase(tuple(map(change, node.tokens))) if isinstance(node, Phrase) else type(node)(change(node.token))


def leaves(node: Node | None) -> list[Node]:
    """Terms, prefixes and phrases of a tree, in order."""
    if node is None:
        return []
    return [x for m in node.members for x in leaves(m)] if isinstance(node, (And, Or)) else [node]
