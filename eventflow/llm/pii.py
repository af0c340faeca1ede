"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds the anchors: at-signs, plus signs,
digits, ``://`` and the cues of account numbers. At each anchor a small
deterministic parser expands to the left and right and validates what it
finds. Kinds, in the order they are listed:

* ``email``, ``ip``, ``card``, ``phone``: the leftmost non-overlapping matches
  of EMAIL, IP, CARD and PHONE below; a match that fails validation (IP parts
  over 255, card length or Luhn sum, number of phone digits) is dropped and
  the search goes on behind it.
* ``account``: a valid IBAN (mod 97), or 6 to 17 digits behind an account cue.
* ``login``: user information of a URL (``scheme://user:secret@host``).

Spans count code points, end exclusive. A null text has no spans, like an
empty one; repeated rows give repeated results; texts are read whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventflow.llm.common import steps, texts, with_fields

# fixed values: the base patterns the parsers are equal to
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

KINDS = ("email", "ip", "card", "phone", "account", "login")
BASE_KINDS = KINDS[:4]
CUES = ("iban", "account", "acct", "konto", "compte", "cuenta")
SCHEMES = ("://",)

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGITS = frozenset("0123456789")
_PHONE_RUN = re.compile(r"[\x20().0-9-]*")
_CARD_RUN = re.compile(CARD)
_IP_RUN = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_IBAN = re.compile(r"[A-Za-z]{2}[0-9]{2}(?:\x20?[A-Za-z0-9]){11,30}")
_CUE_NUMBER = re.compile(r"[\x20A-Za-z.:#]{0,12}?[\x20:#]([0-9](?:[\x20-]?[0-9]){5,16})(?![0-9])")
_LOGIN = re.compile(r"[A-Za-z0-9._%+~-]+(?::[^\s/@]+)?@")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = ord(d) - 48
        if k & 1:
            x = x * 2 - 9 if x > 4 else x * 2
        total += x
    return total % 10 == 0


def iban(text: str) -> bool:
    compact = text.replace(" ", "").upper()
    if not 15 <= len(compact) <= 34:
        return False
    return int("".join(str(int(c, 36)) for c in compact[4:] + compact[:4])) % 97 == 1


def parse_email(text: str, at: int, floor: int) -> tuple[int, int] | None:
    """Expand the at-sign at ``at``; nothing left of ``floor`` may be used."""
    a = at
    while a > floor and text[a - 1] in _LOCAL:
        a -= 1
    if a == at or not (m := _DOMAIN.match(text, at + 1)):
        return None
    return a, m.end()


def parse_ips(text: str, start: int) -> tuple[list[tuple[int, int]], int]:
    """Quadruples of the dotted digit chain that starts here, and its end."""
    chain = _IP_RUN.match(text, start)
    parts, out, a = chain.group().split("."), [], start
    for k in range(0, len(parts) - 3, 4):
        four = parts[k:k + 4]
        b = a + sum(map(len, four)) + 3
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in four):
            out.append((a, b))
        a = b + 1
    return out, chain.end()


def parse_card(text: str, start: int) -> tuple[bool, int]:
    """Is the digit chain that starts here a card number; and its end."""
    m = _CARD_RUN.match(text, start)
    if not m:
        return False, start + 1
    digits = m.group().replace(" ", "").replace("-", "")
    return 13 <= len(digits) <= 19 and luhn(digits), m.end()


def parse_phone(text: str, plus: int) -> tuple[bool, int] | None:
    """None: the pattern does not match here; else whether it is valid, and its end."""
    if text[plus + 1:plus + 2] not in _DIGITS:
        return None
    b = _PHONE_RUN.match(text, plus + 2).end()
    while b > plus + 3 and text[b - 1] not in _DIGITS:
        b -= 1
    if b <= plus + 3:
        return None
    return 9 <= sum(c in _DIGITS for c in text[plus:b]) <= 15, b


def parse_account(text: str, cue: int) -> tuple[int, int] | None:
    """The number behind a cue that ends at ``cue``."""
    m = _CUE_NUMBER.match(text, cue)
    return m.span(1) if m else None


def parse_iban(text: str, first_digit: int) -> tuple[int, int] | None:
    """An IBAN whose two letters stand before this digit; the longest prefix whose checksum holds."""
    a = first_digit - 2
    if a < 0 or a and text[a - 1].isalnum() or not (m := _IBAN.match(text, a)):
        return None
    b = m.end()
    while b - a >= 15:
        if not text[b:b + 1].isalnum() and text[b - 1] != " " and iban(text[a:b]):
            return a, b
        b -= 1
    return None


def _automaton():
    import ahocorasick
    a = ahocorasick.Automaton()
    for d in "0123456789":
        a.add_word(d, "d")
    a.add_word("@", "@")
    a.add_word("+", "+")
    for s in SCHEMES:
        a.add_word(s, ":")
    for c in CUES:
        a.add_word(c, "c")
    a.make_automaton()
    return a


_LOWER = {c: c + 32 for c in range(65, 91)}
_MADE: list = []


def find_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """Spans of one text by kind."""
    if not _MADE:
        _MADE.append(_automaton())
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    email, ip, card, phone, account, login = (found[k] for k in KINDS)
    after_email = after_ip = after_card = after_phone = after_account = 0
    lowered = text.lower() if text.isascii() else text.translate(_LOWER)
    for end, kind in _MADE[0].iter(lowered):
        if kind == "d":
            if end >= after_ip:
                more, after_ip = parse_ips(text, end)
                ip += more
            if end >= after_card:
                valid, b = parse_card(text, end)
                if valid:
                    card.append((end, b))
                after_card = b
                if end >= after_account and (span := parse_iban(text, end)):
                    account.append(span)
                    after_account = span[1]
        elif kind == "@":
            if span := parse_email(text, end, after_email):
                email.append(span)
                after_email = span[1]
        elif kind == "+":
            if end >= after_phone and (got := parse_phone(text, end)):
                after_phone = got[1]
                if got[0]:
                    phone.append((end, got[1]))
        elif kind == "c":
            if end >= after_account and (span := parse_account(text, end + 1)):
                account.append(span)
                after_account = span[1]
        elif m := _LOGIN.match(text, end + 1):
            login.append((end + 1, m.end() - 1))
    return found


def written(found: dict[str, list[tuple[int, int]]], kinds: tuple[str, ...]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in kinds for a, b in found[k])


def find_pii(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None,
             keep_text: bool = False) -> DataFrame:
    """Per row: the id (with the text if asked) and ``carry`` columns, the spans of the base kinds
    (``base_spans``) and of all kinds (``spans``), both ``kind:start:end`` by kind and start, comma-joined."""
    src = texts(df, id_col, text_col, carry)
    at = src.columns.index(text_col)
    out = with_fields(src, "base_spans string, spans string", () if keep_text else (text_col,))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in steps(batches, at):
            found = [find_spans(t) for t in b.column(at).to_pylist()]
            kept = [b.column(i) for i in range(b.num_columns) if keep_text or i != at]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array([written(f, BASE_KINDS) for f in found], pa.string()),
                 pa.array([written(f, KINDS) for f in found], pa.string())], names=out.names)

    return src.mapInArrow(run, out)


def count_kind(spans, kind: str):
    """How many spans of one kind a ``spans`` column lists."""
    return F.size(F.filter(F.split(spans, ","), lambda s: s.startswith(f"{kind}:"))).cast("long")


def redact(text: str, found: dict[str, list[tuple[int, int]]]) -> str:
    """The text with every span (overlapping ones joined) replaced by its kind in brackets."""
    marks = sorted((a, -b, k) for k in KINDS for a, b in found[k])
    out, done, end = [], 0, 0
    for a, b, k in marks:
        if a >= end:
            out += [text[done:a], f"[{k.upper()}]"]
        end = done = max(end, -b)
    return "".join(out) + text[done:]


def redact_pii(df: DataFrame, text_col: str = "text") -> DataFrame:
    """The same columns, personal data in ``text_col`` replaced by ``[KIND]``; null texts stay null."""
    src = df
    at = src.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            new = pa.array([None if t is None else redact(t, find_spans(t)) for t in b.column(at).to_pylist()], pa.string())
            cols = [new if i == at else b.column(i) for i in range(b.num_columns)]
            yield pa.RecordBatch.from_arrays(cols, names=b.schema.names)

    return src.mapInArrow(run, src.schema)
