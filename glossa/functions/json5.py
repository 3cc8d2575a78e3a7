"""JSON5 as strict JSON, for objects that pages carry in scripts.

One pass over a text's tokens with an explicit stack gives strict JSON, which Spark's own functions
read (``parse_json`` to a VARIANT, ``from_json`` to a map): comments and trailing commas go, names
and strings in either kind of quote become JSON strings, hexadecimal, signed and short numbers
become JSON numbers, and of equal names in an object the last counts.

Defined cases: null stays null; ``Infinity`` and ``NaN``, which JSON has no numbers for, are strings
of that name; lone surrogates become U+FFFD; more than ``DEPTH`` levels, and everything that JSON5
does not allow, is an error: ``strict`` raises it, ``lenient`` gives null.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

#: Nested levels; Spark's JSON reader takes 1,000.
DEPTH = 500
#: Texts of an Arrow batch that are Python strings at a time.
SLICE = 128
_GAP = re.compile(r"(?:[\s\ufeff]|//[^\n\r\u2028\u2029]*|/\*.*?\*/)*", re.DOTALL)
_NAME = r"(?:[^\W\d]|[$]|\\u[0-9a-fA-F]{4})(?:[\w$\u200c\u200d]|\\u[0-9a-fA-F]{4})*"
_TOKEN = re.compile(
    r"(?P<mark>[{}\[\]:,])"
    r"|(?P<string>\"(?:[^\"\\\n\r]|\\(?:\r\n|.))*\"|'(?:[^'\\\n\r]|\\(?:\r\n|.))*')"
    r"|(?P<number>[+-]?(?:0[xX][0-9a-fA-F]+|(?:(?:0|[1-9][0-9]*)(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][+-]?[0-9]+)?|Infinity|NaN)(?![\w$.]))"
    rf"|(?P<name>{_NAME})",
    re.DOTALL,
)
_ESCAPE = re.compile(r"\\(u[0-9a-fA-F]{4}|x[0-9a-fA-F]{2}|\r\n|.)", re.DOTALL)
_ESCAPED = {"b": "\b", "f": "\f", "n": "\n", "r": "\r", "t": "\t", "v": "\v", "0": "\0", "\n": "", "\r": "", "\r\n": "", "\u2028": "", "\u2029": ""}
_WORDS = {"true", "false", "null"}


def _unescaped(text: str) -> str:
    def one(m: re.Match) -> str:
        found = m[1]
        if len(found) > 1 and found[0] in "ux":
            return chr(int(found[1:], 16))
        if found in "ux" or found.isdigit() and found != "0":
            raise ValueError(f"bad escape \\{found}")
        return _ESCAPED.get(found, found)

    plain = _ESCAPE.sub(one, text)
    return plain.encode("utf-16", "surrogatepass").decode("utf-16", "replace")


def _number(text: str) -> str:
    sign, digits = ("-" if text[0] == "-" else ""), text.lstrip("+-")
    if digits in ("Infinity", "NaN"):
        return json.dumps(sign * (digits == "Infinity") + digits)
    if digits[:2] in ("0x", "0X"):
        return f"{sign}{int(digits, 16)}"
    whole, e, power = digits.replace("E", "e").partition("e")
    before, dot, after = whole.partition(".")
    return f"{sign}{before or '0'}{'.' + (after or '0') if dot else ''}{e}{power}"


def to_json(text: str) -> str:
    """The text of one JSON5 value as strict JSON; raises ValueError where it is none."""
    at = _GAP.match(text).end()
    stack: list[tuple[list | dict, str | None]] = []  # what is open, and the name that waits for its value
    inside: list | dict | None = None
    name: str | None = None
    expects = "value"  # value, first (a value or the end), name (a name or the end), colon, comma, end
    result = ""

    def took(value: str) -> str:
        nonlocal result
        if inside is None:
            result = value
            return "end"
        if isinstance(inside, dict):
            inside.pop(name, None)
            inside[name] = value
        else:
            inside.append(value)
        return "comma"

    while at < len(text):
        m = _TOKEN.match(text, at)
        if m is None:
            raise ValueError(f"unexpected character at {at}")
        kind, token = m.lastgroup, m[0]
        if expects == "name" and kind in ("string", "name"):
            name, expects = _unescaped(token[1:-1] if kind == "string" else token), "colon"
        elif expects == "colon" and token == ":":
            expects = "value"
        elif expects == "comma" and token == ",":
            expects = "name" if isinstance(inside, dict) else "first"
        elif token in ("}", "]") and kind == "mark" and inside is not None and isinstance(inside, dict) == (token == "}") and expects in ("name", "first", "comma"):
            value = "{" + ",".join(f"{json.dumps(k)}:{v}" for k, v in inside.items()) + "}" if token == "}" else "[" + ",".join(inside) + "]"
            inside, name = stack.pop()
            expects = took(value)
        elif expects in ("value", "first") and token in ("{", "[") and kind == "mark":
            if len(stack) >= DEPTH:
                raise ValueError(f"more than {DEPTH} levels")
            stack.append((inside, name))
            inside, name, expects = ({}, None, "name") if token == "{" else ([], None, "first")
        elif expects in ("value", "first") and kind == "string":
            expects = took(json.dumps(_unescaped(token[1:-1])))
        elif expects in ("value", "first") and kind == "number":
            expects = took(_number(token))
        elif expects in ("value", "first") and token in _WORDS:
            expects = took(token)
        else:
            raise ValueError(f"unexpected {token[:20]!r} at {at}")
        at = _GAP.match(text, m.end()).end()
    if expects != "end":
        raise ValueError("the text ends early")
    return result


def _each(strict_errors: bool) -> Callable[[pa.Array], pa.Array]:
    def one(text: str | None) -> str | None:
        if text is None:
            return None
        try:
            return to_json(text)
        except ValueError:
            if strict_errors:
                raise
            return None

    @arrow_udf("string")
    def run(texts: pa.Array) -> pa.Array:
        parts = [pa.array([one(t) for t in texts.slice(at, SLICE).to_pylist()], pa.string()) for at in range(0, len(texts), SLICE)]
        return pa.concat_arrays(parts or [pa.array([], pa.string())])

    return run


def strict(text: Column) -> Column:
    """A JSON5 text as JSON; one that isn't JSON5 is an error."""
    return _each(True)(text)


def lenient(text: Column) -> Column:
    """A JSON5 text as JSON, null where it isn't JSON5."""
    return _each(False)(text)


def variant(text: Column) -> Column:
    """A JSON5 text as a VARIANT; one that isn't JSON5 is an error."""
    return F.parse_json(strict(text))
