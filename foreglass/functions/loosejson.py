"""JSON texts in the notations that models and services write."""

from __future__ import annotations

import ast
import json
import re

_FENCE = re.compile(r"\A\s*```[\w-]*\s*\n?(.*?)\n?\s*```\s*\Z", re.S)
_TRAILING = re.compile(r"(\"(?:[^\"\\]|\\.)*\")|,(?=\s*[}\]])", re.S)
_LITERALS = re.compile(r"('(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|\b(true|false|null)\b", re.S)
_NAMES = {"true": "True", "false": "False", "null": "None"}


def read(text: str | None) -> object | None:
    """The value of a whole JSON text; None for null, for texts cut off before their end, and for what is no JSON.

    Beside plain JSON it reads a byte-order mark, fenced blocks, JSON within a
    JSON string, commas before a closing bracket and single-quoted notation
    with ``None`` and ``True``. Numbers and names keep their values; nothing is
    repaired by guessing.
    """
    while isinstance(text, str):  # a text within a text is always shorter
        text = _once(text)
        if not isinstance(text, str) or text.lstrip()[:1] not in ('{', '[', '"', '`', '﻿'):
            return text
    return text


def plain(text: str) -> str | None:
    """The value of a whole JSON text as plain JSON; None where ``read`` gives None and for values JSON does not have."""
    try:
        return None if (value := read(text)) is None else json.dumps(value)
    except (TypeError, ValueError, RecursionError):
        return None


def _once(text: str) -> object | None:
    text = text.lstrip("﻿ \t\r\n")
    try:
        return json.loads(text)
    except (ValueError, RecursionError):
        pass
    if text.startswith("`") and (fenced := _FENCE.match(text)):
        return _once(fenced.group(1))
    if text.rstrip()[-1:] not in ("}", "]", '"', "'"):
        return None
    try:
        return json.loads(_TRAILING.sub(lambda m: m.group(1) or "", text))
    except (ValueError, RecursionError):
        pass
    if "'" not in text:
        return None
    try:
        return ast.literal_eval(_LITERALS.sub(lambda m: m.group(1) or _NAMES[m.group(2)], text))
    except (ValueError, SyntaxError, RecursionError, MemoryError):
        return None
