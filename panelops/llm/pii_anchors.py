"""Personal data by anchor expansion.

One Aho-Corasick automaton finds the anchors of every kind in a single pass
over the text: at-signs, plus signs, digits, URL schemes and identifier cues.
A deterministic local parser then expands each anchor to the boundaries of
its span and validates it. Nothing else of the text is looked at.

Kinds and parsers (start and end in code points, end exclusive):

* ``email``  at-sign: local part to the left, domain labels to the right;
* ``ip``     digit: a dotted chain of numbers, taken four at a time from the
  left; every part at most 255;
* ``card``   digit: the longest run of digits with single spaces or hyphens
  between them; 16 to 19 digits that pass Luhn;
* ``phone``  plus sign: the longest run of phone characters that ends in a
  digit; 8 to 15 digits;
* ``login``  scheme: ``scheme://user:password@host`` (the address boundary);
* ``iban``   two capitals and two digits: 15 to 34 characters, mod 97 = 1;
* ``account`` identifier cue (account, password, token, ...): an assignment
  sign and a value of at least six characters with a digit in it.

The first four are the leftmost non-overlapping matches of their kind, and a
failing match uses up its text. The others are added and never replace them.

Defined cases: a null or empty text has no spans; an empty table gives no
rows; spans of different kinds may
overlap; every row is judged by itself, so repeated rows give equal results;
very long texts are one pass with memory for the spans only. ``find_spans``
adds one column; other columns stay, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE_KINDS = ["email", "ip", "card", "phone"]
ADDED_KINDS = ["login", "iban", "account"]
KINDS = BASE_KINDS + ADDED_KINDS

SPANS = "array<struct<kind:string,start:int,end:int>>"

# Identifier cues, matched in any case.
CUES = ["account", "acct", "api_key", "apikey", "iban", "passport", "password", "passwd",
        "pwd", "secret", "ssn", "tax_id", "token"]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])*")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+")
_SCHEME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-")
_FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_USERINFO = re.compile(r"://[^\s/?#@:\"<>]+:[^\s/?#@\"<>]+@[^\s/?#\"<>]+")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_VALUE = re.compile(r"[\"']?[ ]{0,2}(?::=|[:=])[ ]{0,2}[\"']?([A-Za-z0-9+/_.~-]{6,})")


def luhn(digits: str) -> bool:
    total = 0
    for k, ch in enumerate(reversed(digits)):
        d = ord(ch) - 48
        if k % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def _iban_valid(raw: str) -> bool:
    s = raw.replace(" ", "")
    if not 15 <= len(s) <= 34:
        return False
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def automaton():
    """Anchors, each with its kind of parser."""
    import ahocorasick

    a = ahocorasick.Automaton()
    a.add_word("@", ("at", 1))
    a.add_word("+", ("plus", 1))
    a.add_word("://", ("scheme", 3))
    for d in "0123456789":
        a.add_word(d, ("digit", 1))
    for cue in CUES:
        a.add_word(cue, ("cue", len(cue)))
    a.make_automaton()
    return a


def folded(text: str) -> str:
    """``text`` with A-Z in lower case, every character in its place. Lower-casing
    all letters does the same for the anchors, and is faster, unless a character
    becomes two or another one than A-Z an ASCII letter."""
    low = text.lower()
    if len(low) == len(text) and "\u212a" not in text:
        return low
    return text.translate(_FOLD)


class Expander:
    """Parses the anchors of one text at a time, from left to right."""

    def __init__(self):
        self.anchors = automaton()

    def spans(self, text: str) -> list[tuple[str, int, int]]:
        if not text:
            return []
        out: list[tuple[str, int, int]] = []
        # How far each kind has used up the text.
        email = card = phone = dotted = iban = account = 0
        # A-Z folded, and nothing else, so that positions stay.
        for last, (what, size) in self.anchors.iter(folded(text)):
            at = last - size + 1
            if what == "digit":
                if at >= dotted:
                    dotted = self._ips(text, at, out)
                if at >= card:
                    m = _DIGITS.match(text, at)
                    card = m.end()
                    digits = m[0].replace(" ", "").replace("-", "")
                    if 16 <= len(digits) <= 19 and luhn(digits):
                        out.append(("card", at, card))
                if at >= iban and at >= 2 and (m := _IBAN.match(text, at - 2)):
                    if (at < 3 or not text[at - 3].isalnum()) and _iban_valid(m[0]):
                        iban = m.end()
                        out.append(("iban", at - 2, iban))
            elif what == "at":
                start = at
                while start > email and text[start - 1] in _LOCAL:
                    start -= 1
                if start < at and (m := _DOMAIN.match(text, at + 1)):
                    email = m.end()
                    out.append(("email", start, email))
            elif what == "plus":
                if at >= phone and (m := _PHONE.match(text, at)):
                    end = m.end()
                    while not "0" <= text[end - 1] <= "9":
                        end -= 1
                    if end - at >= 4:  # plus, digit, one character, digit
                        phone = end
                        n = sum("0" <= c <= "9" for c in text[at:end]) if end - at < 64 else 99
                        if 8 <= n <= 15 or (n == 99 and self._few(text, at, end)):
                            out.append(("phone", at, end))
            elif what == "scheme":
                if m := _USERINFO.match(text, at):
                    start = at
                    while start and text[start - 1] in _SCHEME:
                        start -= 1
                    while start < at and text[start] in "0123456789+.-":
                        start += 1
                    if start < at:
                        out.append(("login", start, m.end()))
            elif at >= account:
                m = _VALUE.match(text, last + 1)
                if m and any("0" <= c <= "9" for c in m[1]):
                    account = m.end()
                    out.append(("account", m.start(1), account))
        out.sort(key=lambda x: (KINDS.index(x[0]), x[1]))
        return out

    @staticmethod
    def _few(text: str, start: int, end: int) -> bool:
        """8 to 15 digits in a long run of phone characters."""
        n = 0
        for k in range(start, end):
            n += "0" <= text[k] <= "9"
            if n > 15:
                return False
        return n >= 8

    @staticmethod
    def _ips(text: str, at: int, out: list[tuple[str, int, int]]) -> int:
        m = _DOTTED.match(text, at)
        parts = m[0].split(".")
        pos = at
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            size = sum(map(len, four)) + 3
            if all(map(_byte, four)):
                out.append(("ip", pos, pos + size))
            pos += size + 1
        return m.end()


_EXPANDER: list[Expander] = []


def _expander() -> Expander:
    """One automaton per Python worker."""
    if not _EXPANDER:
        _EXPANDER.append(Expander())
    return _EXPANDER[0]


def spans_of(text: Column) -> Column:
    """Array of (kind, start, end), by kind, then start."""

    @F.pandas_udf(SPANS)
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        expander = _expander()
        keys = ("kind", "start", "end")
        for texts in batches:
            yield pd.Series(
                [[dict(zip(keys, s, strict=True)) for s in expander.spans(t or "")] for t in texts],
                dtype=object,
            )

    return find(text)


def find_spans(docs: DataFrame, text: str = "text", out: str = "spans") -> DataFrame:
    return docs.withColumn(out, spans_of(F.col(text)))


def span_digest(spans: Column, kinds: list[str]) -> Column:
    """``kind:start:end`` of the given kinds, joined by commas."""
    chosen = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(
        F.transform(
            chosen,
            lambda s: F.concat_ws(
                ":", s["kind"], s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """Replace every span by its kind in square brackets.

    Overlapping spans are one replaced region, named after the span that
    starts first (the longer one of two that start together). Rows without
    spans keep their text byte for byte; a null text stays null.
    """

    @F.pandas_udf("string")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        expander = _expander()
        for texts in batches:
            yield pd.Series([replace_spans(t, expander.spans(t or "")) for t in texts])

    return docs.withColumn(text, clean(F.col(text)))


def replace_spans(text: str | None, spans: list[tuple[str, int, int]]) -> str | None:
    if not spans:
        return text
    out, at, reach = [], 0, 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= reach:
            out += [text[at:start], f"[{kind.upper()}]"]
        reach = max(reach, end)
        at = reach
    return "".join([*out, text[at:]])
