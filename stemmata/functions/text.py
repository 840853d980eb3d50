"""Text rules. Columns use built-in functions; where Unicode tables of the JVM and of Python differ, the
rule is a plain Python function here and a pandas UDF in ``unicode``.
"""

from __future__ import annotations

import html
import json
import re
import string
from collections.abc import Iterable
from urllib.parse import urlencode

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The word separators of Ethiopic script.
ETHIOPIC = "፡።፣፤፥፦፧፨"
#: Fixed value: a space of no width, dropped from plain text.
ZERO_WIDTH = "​"
#: ASCII white space as a character class of both regular-expression engines.
ASCII_WHITE = r"[\x20\x09-\x0D]"


# --- columns --------------------------------------------------------------------------------


def template(form: str, names: dict[str, str] | None = None) -> Column:
    """A form such as ``{prefix}{word}{trailer}`` as a projection: columns with nulls as nothing, and what stands between them.

    ``names``: columns by the names that the form uses, where they differ. Braces are doubled to stand for themselves.
    """
    parts = []
    for literal, name, _, _ in string.Formatter().parse(form):
        parts += [F.lit(literal)] if literal else []
        parts += [F.coalesce(F.col((names or {}).get(name, name)).cast("string"), F.lit(""))] if name else []
    return F.concat(*parts) if parts else F.lit("")


def plain_text(c: Column) -> Column:
    """White space runs as one space, none at the ends; no zero-width spaces."""
    flat = F.regexp_replace(F.replace(c, F.lit(ZERO_WIDTH), F.lit("")), r"(?U)\s+", " ")
    return F.regexp_replace(flat, r"^(?U)\s+|(?U)\s+$", "")


def ascii_words(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))


def sigla(c: Column) -> Column:
    """The sigla of a list between white space."""
    return F.filter(F.split(c, r"(?U)\s+"), lambda x: x != "")


def boundary(linebreak: Column) -> Column:
    """What follows a unit: an empty line, a line end, or nothing."""
    mark = F.lower(F.trim(F.coalesce(linebreak, F.lit(""))))
    return F.when(mark == "doublefollowing", "\n\n").when(mark != "", "\n").otherwise("")


def reference(path: Column, delimiters: Column) -> Column:
    """A path joined with the delimiter of each level; levels without one take ``/``."""
    parts = F.transform(path, lambda x, i: F.when(i == 0, x).otherwise(F.concat(F.coalesce(F.get(delimiters, i - 1), F.lit("/")), x)))
    return F.array_join(parts, "")


def integer_or(c: Column, fallback: Column | int) -> Column:
    return F.coalesce(c.try_cast("int"), fallback if isinstance(fallback, Column) else F.lit(fallback))


def html_escaped(c: Column) -> Column:
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        c = F.replace(c, F.lit(raw), F.lit(safe))
    return c


def url_encoded(c: Column) -> Column:
    """Form encoding as RFC 3986 keeps ``~`` and form encoding escapes ``*``."""
    return F.replace(F.replace(F.url_encode(c), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def without_xml_suffix(c: Column) -> Column:
    return F.regexp_replace(c, r"\.xml$", "")


def without_language(c: Column, language: Column) -> Column:
    """A generated unit's id without its ``xx_``."""
    mark = F.concat(language, F.lit("_"))
    return F.when(F.startswith(c, mark), F.substring(c, F.length(mark) + 1, F.length(c))).otherwise(c)


def effective_language(token: Column, version: Column) -> Column:
    return F.coalesce(F.nullif(token, F.lit("")), version)


def git_blob_sha1(content: Column) -> Column:
    """The object name that git gives to these bytes."""
    head = F.encode(F.concat(F.lit("blob "), F.octet_length(content).cast("string")), "utf-8")
    return F.sha1(F.concat(head, F.lit(bytes([0])), content))


# --- plain Python ---------------------------------------------------------------------------


def plain(text: str) -> str:
    return " ".join(text.replace(ZERO_WIDTH, "").split())


def separates(c: str) -> bool:
    return c.isspace() or c == ZERO_WIDTH or c in ETHIOPIC


def slug(text: str) -> str:
    """Letters and digits of any script; all between them is one ``_``; ``version`` if none is left."""
    words, word = [], []
    for c in text:
        if c.isalnum():
            word.append(c)
        elif word:
            words.append("".join(word))
            word = []
    if word:
        words.append("".join(word))
    return "_".join(words) or "version"


def unique(values: Iterable[object]) -> tuple[str, ...]:
    """As texts, each once, in first order."""
    return tuple(dict.fromkeys(map(str, values)))


def comparison_address(work: object, chapter: object, verse: object, versions: Iterable[object] | None = None, witnesses: dict[str, Iterable[object]] | None = None) -> str:
    """The address of a comparison. No selection means defaults; an empty one is kept as an empty value."""
    place = {k: str(v).strip() for k, v in (("work", work), ("chapter", chapter), ("verse", verse))}
    if not all(place.values()):
        raise ValueError("a comparison needs work, chapter and verse")
    query = list(place.items())
    chosen = None if versions is None else unique(versions)
    if chosen is not None:
        query += [("version", v) for v in chosen or ("",)]
    for version in chosen or ():
        if witnesses is not None and version in witnesses:
            query += [(f"witness.{version}", w) for w in unique(witnesses[version]) or ("",)]
    return "/compare?" + urlencode(query)


def escaped(value: object) -> str:
    return html.escape(str(value), quote=True)


# --- strict JSON ----------------------------------------------------------------------------


class StrictJSONError(ValueError):
    """JSON that another reader could understand differently."""


def strict_json(data: bytes | str) -> object:
    """Decode JSON; repeated keys, NaN, infinities, overflow and underflow of a number that isn't 0 are errors."""
    def members(pairs: list[tuple[str, object]]) -> dict:
        found = dict(pairs)
        if len(found) != len(pairs):
            raise StrictJSONError("a key is repeated: " + ", ".join(sorted({k for k, _ in pairs if [x for x, _ in pairs].count(k) > 1})))
        return found

    def number(digits: str) -> float:
        x = float(digits)
        if x in (float("inf"), float("-inf")):
            raise StrictJSONError(f"number too large: {digits}")
        if x == 0 and re.search("[1-9]", re.split("[eE]", digits)[0]):
            raise StrictJSONError(f"number too small: {digits}")
        return x

    def constant(name: str) -> None:
        raise StrictJSONError(f"{name} is no JSON")

    text = data.decode("utf-8") if isinstance(data, bytes) else data
    return json.loads(text, object_pairs_hook=members, parse_float=number, parse_constant=constant)


def json_text(value: object) -> str:
    return json.dumps(value, ensure_ascii=False)


# --- identifiers ----------------------------------------------------------------------------


def git_sha(value: object, what: str) -> str:
    if not isinstance(value, str) or not re.fullmatch(r"[0-9a-f]{40}", value):
        raise ValueError(f"{what} is not a full lowercase git object name: {value!r}")
    return value


def path_component(value: object, what: str) -> str:
    if not isinstance(value, str) or value in ("", ".", "..") or not re.fullmatch(r"[A-Za-z0-9._-]+", value):
        raise ValueError(f"{what} is no plain path component: {value!r}")
    return value


def positive(value: object, what: str) -> int:
    if type(value) is not int or value < 1:
        raise ValueError(f"{what} is no positive integer: {value!r}")
    return value


def not_blank(value: object, what: str) -> str:
    if not isinstance(value, str) or not value.strip():
        raise ValueError(f"{what} is blank: {value!r}")
    return value
