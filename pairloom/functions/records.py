"""Reading the nested sample records that arrive as JSON text.

A record is readable when its text is a JSON object, or a JSON string whose content is again a readable record.
Everything else (null, empty, cut, not an object) is unreadable and yields ``None``. Neither the layers of strings nor
the depth of nesting are bounded: what is too deep for the interpreter's stack is read, walked and written with a stack
of its own.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The promotion lattice of the kinds that a leaf can have: each can be cast to any later one; ties are settled for the wider.
KINDS = ("boolean", "number", "string", "array")

_BLANKS = re.compile(r"[ \t\n\r]*")


def read_record(text: str | None) -> dict | None:
    """The object that ``text`` holds, within however many layers of JSON strings (each is shorter than the last)."""
    while isinstance(text, str) and text:
        try:
            got = json.loads(text)
        except ValueError:
            return None
        except RecursionError:
            try:
                got = parse_deep(text)
            except ValueError:
                return None
        if isinstance(got, dict):
            return got
        text = got
    return None


def parse_deep(text: str) -> Any:
    """``json.loads`` for any depth of nesting."""
    blanks, scalar = (lambda k: _BLANKS.match(text, k).end()), json.JSONDecoder().scan_once
    open_: list = []  # containers from the outside in
    keys: list = []  # the key under which each open object takes its next value
    out: Any = None

    def put(value: Any) -> None:
        nonlocal out
        if not open_:
            out = value
        elif type(open_[-1]) is dict:
            open_[-1][keys[-1]] = value
        else:
            open_[-1].append(value)

    def key(k: int) -> int:
        """Reads ``"name":`` at ``k`` and gives the place of its value."""
        if text[k : k + 1] != '"':
            raise ValueError("a key is missing")
        keys[-1], k = scalar(text, k)
        k = blanks(k)
        if text[k : k + 1] != ":":
            raise ValueError("a colon is missing")
        return blanks(k + 1)

    at = blanks(0)
    while True:
        sign = text[at : at + 1]
        if sign in ("{", "["):
            node: Any = {} if sign == "{" else []
            put(node)
            open_.append(node)
            keys.append(None)
            at = blanks(at + 1)
            if text[at : at + 1] not in ("}", "]"):
                at = key(at) if sign == "{" else at
                continue
        else:
            try:
                value, at = scalar(text, at)
            except StopIteration:
                raise ValueError("a value is missing") from None
            put(value)
        while True:  # a value, or an empty container that is still open, has ended
            at = blanks(at)
            if not open_:
                if at != len(text):
                    raise ValueError("something follows the value")
                return out
            sign, inside = text[at : at + 1], open_[-1]
            if sign == ("}" if type(inside) is dict else "]"):
                open_.pop()
                keys.pop()
                at += 1
            elif sign == "," and inside:
                at = blanks(at + 1)
                at = key(at) if type(inside) is dict else at
                break
            else:
                raise ValueError("a comma or an end is missing")


def write(value: Any) -> str:
    """``json.dumps`` in its plain form for any depth of nesting."""
    try:
        return json.dumps(value, ensure_ascii=False)
    except RecursionError:
        pass
    out: list[str] = []
    todo: list = [(value, False)]  # (a value, or text that goes out as it is)
    while todo:
        x, ready = todo.pop()
        if ready:
            out.append(x)
        elif type(x) is dict or type(x) is list:
            named = type(x) is dict
            out.append("{" if named else "[")
            todo.append(("}" if named else "]", True))
            for k, (name, v) in zip(range(len(x) - 1, -1, -1), reversed(list(x.items() if named else enumerate(x)))):
                todo.append((v, False))
                todo.append(((", " if k else "") + (json.dumps(name, ensure_ascii=False) + ": " if named else ""), True))
        else:
            out.append(json.dumps(x, ensure_ascii=False))
    return "".join(out)


def kind_of(value: Any) -> str:
    if isinstance(value, bool):
        return "boolean"
    if isinstance(value, (int, float)):
        return "number"
    return "array" if isinstance(value, list) else "string"


def leaves(value: Any, strays: bool = False) -> Iterator[tuple[str, Any]]:
    """(path, value) of every scalar and every array of other values, in order; null, ``[]`` and ``{}`` count as absent.

    An array that holds an object is an array of objects: ``[]`` follows its path and its other elements are skipped,
    or with ``strays`` given under the array's own path.
    """
    todo = [("", value, False)]
    while todo:
        path, x, stray = todo.pop()
        if stray:
            yield path, x
        elif type(x) is dict:
            base = path + "." if path else ""
            todo.extend([(base + k, v, False) for k, v in reversed(x.items()) if v is not None])
        elif type(x) is not list:
            if x is not None:
                yield path, x
        elif any(type(y) is dict for y in x):
            for y in reversed(x):
                if type(y) is dict:
                    todo.append((path + "[]", y, False))
                elif strays and y is not None and y != []:
                    todo.append((path, y, True))
        elif x:
            yield path, x


def leaf_kinds(record: dict, names: dict[tuple[str, str], str]) -> dict[str, str | set[str]]:
    """path -> kind of all leaves, as ``leaves`` gives them; a set where one record holds several kinds at a path.

    ``names`` keeps joined paths between calls; the caller empties it when it grows.
    """
    out: dict[str, str | set[str]] = {}
    todo = [(record, "")]
    while todo:
        node, base = todo.pop()
        for k, v in node.items():
            if v is None:
                continue
            path = names.get((base, k))
            if path is None:
                path = names[base, k] = f"{base}.{k}" if base else k
            t = type(v)
            if t is str:
                kind = "string"
            elif t is bool:
                kind = "boolean"
            elif t is int or t is float:
                kind = "number"
            elif t is dict:
                todo.append((v, path))
                continue
            elif not v:
                continue
            elif objects := [x for x in v if type(x) is dict]:
                inner = path + "[]"
                todo.extend([(x, inner) for x in objects])
                continue
            else:
                kind = "array"
            had = out.setdefault(path, kind)
            if had is not kind:
                out[path] = (had if isinstance(had, set) else {had}) | {kind}
    return out


#: Layers of JSON strings that a text can have: each quote inside doubles its backslashes with every layer, so k layers take 2^(k-1) signs.
_LAYERS = 32


def record_text(text: str | Column) -> Column:
    """The text inside however many layers of JSON strings, natively; null if a layer is unreadable."""
    t = F.col(text) if isinstance(text, str) else text
    quoted = lambda x: x.rlike(r'^\s*"')
    inner = lambda x: F.when(quoted(x), F.try_variant_get(F.try_parse_json(x), "$", "string")).otherwise(x)
    return F.when(quoted(t), F.aggregate(F.sequence(F.lit(1), F.lit(_LAYERS)), t, lambda x, _: inner(x))).otherwise(t)


def object_variant(text: str | Column, wrapped: bool = True) -> Column:
    """The readable record in a text column as a variant, natively; null if it is no object or unreadable.

    Valid JSON that begins with a brace is an object, which is cheaper to see than from the variant's schema. JSON
    strings are opened layer by layer, as many as a text can have, unless ``wrapped`` is false. A variant holds at most 1,000 levels of nesting and
    16 MB (Spark's own limits); ``read_record`` has none.
    """
    t = F.col(text) if isinstance(text, str) else text
    parsed = lambda x: F.when(x.rlike(r"^\s*\{"), F.try_parse_json(x))
    if not wrapped:
        return parsed(t)
    return F.when(t.rlike(r'^\s*"'), F.get(F.transform(F.array(record_text(t)), parsed), F.lit(0))).otherwise(parsed(t))


def readable(df: DataFrame, text: str, *keep: str | Column) -> DataFrame:
    """``keep`` and the record ``v`` (a variant) of the rows whose record is readable.

    The rows are made from the record, not filtered by it: a filter would be pushed down and parse every text again.
    """
    return df.select(*keep, F.explode(F.array_compact(F.array(object_variant(text)))).alias("v"))
