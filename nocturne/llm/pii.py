"""Personal data by anchor expansion.

An Aho-Corasick automaton over the whole text finds anchors: at-signs, schemes, plus signs, digits
and identifier cues. From each anchor a deterministic local parser expands to the boundaries of an
e-mail address, a network address, a card, a phone number or an account and validates it. The four
base kinds give exactly the leftmost non-overlapping matches of their patterns; failing matches are
dropped and not tried again. The method adds two kinds: ``account`` (a cue such as account number or
passport, in any case, followed by an identifier with three digits, in one word or in groups; after
the cue IBAN only one whose check digits are right) and ``login`` (user information before the
at-sign of scheme://user@host).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

#: Fixed by the contract: the kinds in their order and the patterns that local parsers follow.
KINDS = ("email", "ip", "card", "phone")
ADDED = ("account", "login")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+\.([0-9]+)\.([0-9]+)\.([0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

CUES = ("iban", "account number", "account no", "account id", "acct", "passport", "ssn", "social security number", "customer id", "user id", "kontonummer", "numéro de compte", "número de cuenta")
AFTER = r"[\s:#.=№-]{1,4}"
#: Between a cue and its identifier: separators and up to three of these words.
LEAD = re.compile(rf"(?:{AFTER}(?i:is|was|are|the|my|your|no|nr|num|number|nummer|id|code|reads|ist|lautet|est|es|le|la)(?![A-Za-z0-9])){{0,3}}{AFTER}")
ACCOUNT = re.compile(r"(?=(?:[A-Za-z-]{0,33}[0-9]){3})[A-Za-z0-9][A-Za-z0-9-]{4,32}[A-Za-z0-9](?![A-Za-z0-9])")
GROUPED_IBAN = re.compile(r"[A-Za-z]{2}[0-9]{2}(?:[\x20-][A-Za-z0-9]{4}){2,7}(?:[\x20-][A-Za-z0-9]{1,3})?(?![A-Za-z0-9])")
#: Groups apart by single spaces or hyphens, each with a digit but for letters at the ends.
GROUPED = re.compile(r"(?:[A-Z]{1,4}[\x20-])?[A-Z]{0,4}[0-9][A-Z0-9]{0,5}(?:[\x20-][A-Z]{0,4}[0-9][A-Z0-9]{0,7}){1,8}(?:[\x20-][A-Z](?=[.,;:)]|\Z))?(?![A-Za-z0-9])")
LOGIN = re.compile(r"[^\s/@:?#\"'<>]+(?::[^\s/@?#\"'<>]*)?(?=@[A-Za-z0-9-])")


def _automaton():
    import ahocorasick

    a = ahocorasick.Automaton()
    for char in "0123456789":
        a.add_word(char, ("digit", 1))
    for word, kind in (("@", "at"), ("+", "plus"), ("://", "scheme")):
        a.add_word(word, (kind, len(word)))
    for cue in CUES:
        a.add_word(cue, ("iban" if cue == "iban" else "cue", len(cue)))
    a.make_automaton()
    return a


_anchors = None


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if i % 2:
            n = n * 2 - 9 * (n > 4)
        total += n
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def iban(text: str) -> bool:
    """Whether the letters and digits are those of an IBAN: the check digits, modulo 97."""
    chars = [c for c in text.upper() if c.isalnum()]
    return 15 <= len(chars) <= 34 and int("".join(str(int(c, 36)) for c in chars[4:] + chars[:4])) % 97 == 1


def _account(text: str, at: int, only_iban: bool) -> tuple[int, int] | None:
    """The identifier after a cue that ends at ``at``: a right IBAN, else (after other cues) the longer of one word and of groups."""
    if not (lead := LEAD.match(text, at)):
        return None
    start = lead.end()
    if m := GROUPED_IBAN.match(text, start):
        for end in [m.end(), *(i for i in range(m.end() - 1, start, -1) if text[i] in " -")]:  # the next word may look like a group
            if iban(text[start:end]):
                return start, end
    m = ACCOUNT.match(text, start)
    if only_iban:
        return (start, m.end()) if m and iban(m.group()) else None
    ends = [m.end()] if m else []
    if (m := GROUPED.match(text, start)) and sum(c.isalnum() for c in m.group()) >= 6 and len(_digits(m.group())) >= 3:
        ends.append(m.end())
    return (start, max(ends)) if ends else None


def _lowered(text: str) -> str:
    """Lower case with every character at its place."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def spans(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, kind) in code points, by start and then kind; base kinds before added ones."""
    global _anchors
    if not text:
        return []
    if _anchors is None:
        _anchors = _automaton()
    found: list[tuple[int, int, str]] = []
    past = dict.fromkeys((*KINDS, *ADDED), 0)  # where the next match of a kind may begin
    for last, (kind, length) in _anchors.iter(_lowered(text)):
        at = last - length + 1
        if kind == "digit":
            if at >= past["ip"]:
                if m := IP.match(text, at):
                    past["ip"] = m.end()
                    if all(_small(x) for x in m.group().split(".")):
                        found.append((at, m.end(), "ip"))
                else:  # nor can it begin later in this run of digits
                    end = at + 1
                    while end < len(text) and "0" <= text[end] <= "9":
                        end += 1
                    past["ip"] = end
            if at >= past["card"] and (m := CARD.match(text, at)):
                past["card"] = m.end()
                if 14 <= len(d := _digits(m.group())) <= 19 and luhn(d):
                    found.append((at, m.end(), "card"))
        elif kind == "at":
            start = at
            while start > past["email"] and text[start - 1] in LOCAL:
                start -= 1
            if start < at and (m := DOMAIN.match(text, at + 1)):
                past["email"] = m.end()
                found.append((start, m.end(), "email"))
        elif kind == "plus":
            if at >= past["phone"] and (m := PHONE.match(text, at)):
                past["phone"] = m.end()
                if 10 <= len(_digits(m.group())) <= 15:
                    found.append((at, m.end(), "phone"))
        elif kind == "scheme":
            if at >= past["login"] and (m := LOGIN.match(text, last + 1)):
                past["login"] = m.end()
                found.append((last + 1, m.end(), "login"))
        elif at >= past["account"] and (at == 0 or not text[at - 1].isalnum()) and (where := _account(text, last + 1, kind == "iban")):
            past["account"] = where[1]
            found.append((*where, "account"))
    order = {k: i for i, k in enumerate((*KINDS, *ADDED))}
    found.sort(key=lambda s: (s[0], order[s[2]], s[1]))
    return found


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def joined(found: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in found)


def redact(text: str | None, found: list[tuple[int, int, str]]) -> str | None:
    """The text with each maximal run of overlapping spans replaced by the first span's kind in brackets."""
    if not text or not found:
        return text
    out, at, i = [], 0, 0
    while i < len(found):
        start, end, kind = found[i]
        while i + 1 < len(found) and found[i + 1][0] < end:
            i += 1
            end = max(end, found[i][1])
        out.append(f"{text[at:start]}[{kind.upper()}]")
        at, i = end, i + 1
    return "".join([*out, text[at:]])


def find(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), redacted: bool = False) -> DataFrame:
    """``keep`` columns, counts of the base kinds, base_sha256, spans (and redacted text) of each row.

    A narrow map over Arrow batches; work is linear in the text. Null and empty texts have no spans
    (the hash is that of the empty string; the redacted text stays null or empty). Repeated rows stay.
    """
    fields = [docs.schema[c].simpleString().replace(":", " ", 1) for c in keep]
    names = [*keep, *(f"n_{k}" for k in KINDS), "base_sha256", "spans", *["redacted"] * redacted]
    out = ", ".join([*fields, *(f"n_{k} long" for k in KINDS), "base_sha256 string", "spans string", *["redacted string"] * redacted])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, listed, cleaned = [], [], [], []
            for value in batch.column(len(keep)):
                text = value.as_py()
                found = spans(text)
                base = [s for s in found if s[2] in KINDS]
                counts.append([sum(s[2] == k for s in base) for k in KINDS])
                digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
                listed.append(joined(found))
                if redacted:
                    cleaned.append(redact(text, found))
            columns = [*batch.columns[: len(keep)], *(pa.array([c[i] for c in counts], pa.int64()) for i in range(len(KINDS))), pa.array(digests, pa.string()), pa.array(listed, pa.string())]
            yield pa.RecordBatch.from_arrays([*columns, *[pa.array(cleaned, pa.string())] * redacted], names)

    return docs.select(*keep, "text").mapInArrow(run, out)
