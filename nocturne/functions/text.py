"""Tokens, stems, passages and small text utilities as Column expressions."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

TOKEN = r"[a-z0-9][a-z0-9_.\-]{1,}"
#: Words that are left out before stemming.
STOP_WORDS = (
    "a an and are as at be but by for from has have if in into is it its of on or that the this to was were will with what which how why when where who your you we our i me my they them their he she his her do does did not no yes can could should would"
).split()


def tokens(text: Column) -> Column:
    """Lower-cased tokens without stop words, not yet stemmed."""
    found = F.regexp_extract_all(F.lower(text), F.lit(f"({TOKEN})"), 1)
    return F.filter(found, lambda t: ~t.isin(STOP_WORDS))


def stem_once(token: Column) -> Column:
    """One pass: the longest suffix that leaves three characters, else a final e or y of five or more."""
    stripped = F.regexp_replace(token, "^(.{3,}?)(ing|ers|ies|ed|es|er|s)$", "$1")
    return F.when(stripped != token, stripped).otherwise(F.regexp_replace(token, "^(.{4,})[ey]$", "$1"))


def stem(token: Column) -> Column:
    """Passes repeated to the fixpoint. Most tokens end in no suffix at all and are told by one look.

    A pass removes a character at least and leaves three, which bounds the passes by the token's length.
    """
    start = F.struct(token.alias("t"), F.lit(False).alias("done"))

    def step(state: Column, _: Column) -> Column:
        after = stem_once(state["t"])
        return F.when(state["done"], state).otherwise(F.struct(after.alias("t"), (after == state["t"]).alias("done")))

    passes = F.aggregate(F.sequence(F.lit(1), F.greatest(F.length(token) - 2, F.lit(1))), start, step, lambda state: state["t"])
    return F.when(token.rlike("(?:ing|ed|er|[sey])$") & (F.length(token) > 3), passes).otherwise(token)


class Stems(dict):
    """The stem of a token, None of a stop word: looked up in a task, reckoned when it is met for the first time. As ``stem`` and ``STOP_WORDS``."""

    ENDING, LAST = re.compile("(.{3,}?)(?:ing|ers|ies|ed|es|er|s)"), re.compile("(.{4,})[ey]")
    HELD = 1 << 20  # tokens

    def __missing__(self, token: str) -> str | None:
        if len(self) >= self.HELD:
            self.clear()
        now, after = token, None if token in STOP_WORDS else token
        while after is not None:
            now = after
            if not (m := self.ENDING.fullmatch(now) or self.LAST.fullmatch(now)):
                break
            after = m[1]
        self[token] = out = None if after is None else now
        return out


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is reckoned once, however often it is used: as a lambda's variable."""
    return F.element_at(F.transform(F.array(value), use), 1)


def passages(text: Column, words: int = 220, overlap: int = 40, shortest: int = 80) -> Column:
    """Overlapping windows of words joined by spaces, those of more than ``shortest`` characters."""
    step = max(words - overlap, 50)

    def windows(split: Column) -> Column:
        cut = F.transform(F.sequence(F.lit(1), F.greatest(F.size(split), F.lit(1)), F.lit(step)), lambda i: F.array_join(F.slice(split, i, words), " "))
        return F.filter(F.when(F.size(split) > 0, cut).otherwise(F.array().cast("array<string>")), lambda p: F.length(p) > shortest)

    return once(F.filter(F.split(text, r"[\s\x1c-\x1f\x85]+"), lambda w: w != ""), windows)


def html_escape(text: Column) -> Column:
    out = text
    for char, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        out = F.replace(out, F.lit(char), F.lit(name))
    return out


def safe_name(name: Column, fallback: str = "upload") -> Column:
    """A file name of letters, digits, dot, underscore and dash that doesn't begin with a dot."""
    base = F.regexp_replace(F.regexp_replace(name, r"\\", "/"), "^.*/", "")
    cleaned = F.regexp_replace(F.regexp_replace(base, "[^A-Za-z0-9._-]+", "_"), "^[.]+", "")
    return F.when(F.coalesce(cleaned, F.lit("")) == "", fallback).otherwise(cleaned)


def log_message(line: Column) -> Column:
    """A log line without its time, level and logger."""
    return F.regexp_replace(line, r"^\d{4}-\d{2}-\d{2}[ T][\d:,.]+\s+\[?[A-Z]+\]?\s+(?:[\w.]+:?\s+)?", "")
