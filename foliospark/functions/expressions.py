"""Column expressions shared by operators; all of them run inside the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# RFC 4122's URL namespace, and the letters that set a UUID's variant.
URL_NAMESPACE = "6ba7b8119dad11d180b400c04fd430c8"
VARIANT = "89ab89ab89ab89ab"
ZERO_WIDTH = "​﻿‌‍"
# Whitespace as Python's str.strip sees it, for Java patterns.
SPACE = r"[\s\x{1c}-\x{1f}\x{85}\p{Z}]"


def fresh(columns: list[str], name: str) -> str:
    """A column name like ``name`` that is not taken, letter case aside."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def words(text: Column) -> Column:
    """The runs of letters, digits and underscores in lower case, as an array."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, even where ``body`` uses it inside another lambda."""
    return F.transform(F.array(value), body)[0]


def shingles(text: Column, k: int) -> Column:
    """Runs of k words joined by blanks; all words if there are fewer; none without words; null for null."""

    def runs(w: Column) -> Column:
        last = F.greatest(F.size(w) - (k - 1), F.lit(1))
        some = F.transform(F.sequence(F.lit(1), last), lambda i: F.array_join(F.slice(w, i, k), " "))
        return F.when(F.size(w) == 0, F.array().cast("array<string>")).when(w.isNotNull(), some)

    return let(words(text), runs)


def strip(text: Column) -> Column:
    """Without Unicode whitespace at both ends."""
    return F.regexp_replace(F.regexp_replace(text, rf"\A{SPACE}+", ""), rf"{SPACE}+\z", "")


def uuid5(name: Column, namespace: str = URL_NAMESPACE) -> Column:
    """The version 5 UUID of a name."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace)), F.encode(name, "UTF-8")))
    variant = F.translate(F.substring(h, 17, 1), "0123456789abcdef", VARIANT)
    return F.concat(F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-5"), F.substring(h, 14, 3), F.lit("-"), variant, F.substring(h, 18, 3), F.lit("-"), F.substring(h, 21, 12))


def overlay(base: Column, above: Column) -> Column:
    """A map with the entries of both; where both have a key, ``above`` wins. Null counts as empty."""
    empty = F.create_map().cast("map<string,string>")
    a, b = F.coalesce(base, empty), F.coalesce(above, empty)
    return F.map_concat(F.map_filter(a, lambda k, _: ~F.map_contains_key(b, k)), b)


def first_match(text: Column, pattern: str, group: int = 1) -> Column:
    """A pattern's group where it first matches, else null."""
    found = F.regexp_extract(text, pattern, group)
    return F.when(text.rlike(pattern), found)


def size_mb(length: Column) -> Column:
    """Bytes as megabytes to one decimal, rounded half even."""
    return F.bround(length / 1e6, 1)


def stored_scalar(value: Column, kind: str) -> Column:
    """A metadata value as stores that only hold scalars want it: text as it is, anything nested as JSON."""
    return value if kind == "string" else F.to_json(value) if kind.startswith(("struct", "array", "map")) else value.cast("string")
