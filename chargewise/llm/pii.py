"""Personal data by anchor expansion.

One Aho-Corasick automaton finds every anchor of a text in a single pass: at-signs, URL schemes,
identifier cues (in any case), plus signs and digits. At each anchor a small deterministic parser expands to the
left and right, finds the boundary and validates what it holds. Parsers never rescan what an earlier
expansion of their kind has covered, so the work is linear in the text.

Base kinds (leftmost, non-overlapping within a kind): email, ip, card, phone. Kinds that the method
adds: url (a scheme and a valid host), iban (mod-97), account (a cue such as "account no." and 6 to
17 digits, or a social security number), address (house number, capitalised words, street word),
secret (a cue such as "password=" and its value).
"""

from __future__ import annotations

import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from chargewise.llm.common import slices_of, texts_of

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "url", "iban", "account", "address", "secret")

# What the automaton looks for, by the parser that expands it.
SCHEMES = ("http://", "https://", "ftp://", "www.")
IBAN_CUES = ("iban",)
ACCOUNT_CUES = ("account", "acct", "konto", "compte", "cuenta", "ssn", "social security")
SECRET_CUES = ("password=", "passwd=", "api_key=", "apikey=", "secret=", "token=")
STREET_WORDS = ("street", "avenue", "road", "lane", "drive", "boulevard", "st", "ave", "rd", "ln", "dr", "blvd")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_DIGITS = re.compile(r"[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_URL = re.compile(r"[^\s\"'<>()\[\]{}]+")
_HOST = re.compile(r"(?:(?i:https?|ftp)://)?(?:[^/@\s]*@)?[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+(?::[0-9]+)?(?=[/?#]|$)")
_IBAN = re.compile(r"[\s:#.]{0,4}([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30})(?![A-Za-z0-9])")
_ACCOUNT = re.compile(r"(?i:s)?(?: ?(?i:no|number|nr|num)\b\.?)?[\s:#]{1,4}([0-9]{6,17}|[0-9]{3}-[0-9]{2}-[0-9]{4})(?![0-9A-Za-z-])")
_SECRET = re.compile(r"[^\s\"'<>,;]{6,}")
_HOUSE = re.compile(r"([0-9]{1,5} (?:[A-Z][a-z]{1,24} ){1,4})$")


@lru_cache(maxsize=1)
def _automaton():
    import ahocorasick
    found = ahocorasick.Automaton()
    for c in "0123456789":
        found.add_word(c, ("digit", 1))
    found.add_word("@", ("at", 1))
    found.add_word("+", ("plus", 1))
    for parser, words in (("url", SCHEMES), ("iban", IBAN_CUES), ("account", ACCOUNT_CUES),
                          ("secret", SECRET_CUES), ("address", STREET_WORDS)):
        for word in words:
            found.add_word(f" {word}" if parser == "address" else word, (parser, len(word)))
    found.make_automaton()
    return found


def _lowered(text: str) -> str:
    return text.lower() if text.isascii() else text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def _valid_iban(code: str) -> bool:
    code = code.replace(" ", "")
    return 15 <= len(code) <= 34 and int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def _email(text: str, at: int, floor: int) -> tuple[int, int] | None:
    domain = _DOMAIN.match(text, at + 1)
    if domain is None:
        return None
    start = at
    while start > floor and text[start - 1] in _LOCAL:
        start -= 1
    return (start, domain.end()) if start < at else None


def spans_of(text: str) -> list[tuple[int, int, int]]:
    """(start, index into KINDS, end) of every span, in code points, by start, then kind."""
    done = [0] * len(KINDS)      # per kind, the end of what has been consumed
    ip_floor = 0
    found: list[tuple[int, int, int]] = []

    def keep(kind: int, start: int, end: int) -> None:
        done[kind] = end
        found.append((start, kind, end))

    # Anchors in any case: the automaton reads a copy with A-Z lowered, place by place; the parsers read the text.
    for last, (parser, length) in _automaton().iter(_lowered(text)):
        at = last - length + 1
        if parser == "digit":
            # A base pattern that fails at the start of a digit run fails within the run as well.
            first = at == 0 or not ("0" <= text[at - 1] <= "9")
            if at >= done[1] and at >= ip_floor and (first or at == done[1]):
                if (m := _IP.match(text, at)) is not None:
                    done[1] = m.end()
                    if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m.group().split(".")):
                        found.append((at, 1, m.end()))
                else:
                    ip_floor = _DIGITS.match(text, at).end()
            if at >= done[2] and (first or at == done[2]) and (m := _CARD.match(text, at)) is not None:
                done[2] = m.end()
                if 12 <= m.end() - at <= 37:
                    digits = m.group().replace(" ", "").replace("-", "")
                    if 12 <= len(digits) <= 19 and _luhn(digits):
                        found.append((at, 2, m.end()))
        elif parser == "at":
            if at >= done[0] and (span := _email(text, at, done[0])) is not None:
                keep(0, *span)
        elif parser == "plus":
            if at >= done[3] and (m := _PHONE.match(text, at)) is not None:
                done[3] = m.end()
                if 9 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
                    found.append((at, 3, m.end()))
        elif parser == "url":
            if at >= done[4] and (at == 0 or not text[at - 1].isalnum()) and (m := _URL.match(text, at)) is not None:
                end = at + len(m.group().rstrip(".,;:!?"))
                if _HOST.match(text[at:end]) is not None:
                    keep(4, at, end)
        elif parser == "iban":
            if last >= done[5] and (m := _IBAN.match(text, last + 1)) is not None and _valid_iban(m[1]):
                keep(5, *m.span(1))
        elif parser == "account":
            if last >= done[6] and (m := _ACCOUNT.match(text, last + 1)) is not None:
                keep(6, *m.span(1))
        elif parser == "address":
            before = text[max(done[7], at - 120, 0):at]
            if "A" <= text[at] <= "Z" and not text[last + 1:last + 2].isalnum() and (m := _HOUSE.search(before)) is not None:
                keep(7, at - len(m[1]), last + 1)
        elif parser == "secret":
            if at >= done[8] and (m := _SECRET.match(text, last + 1)) is not None:
                keep(8, *m.span())
    found.sort()
    return found


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())])
_OUT = pa.schema([("doc_id", pa.int64()), ("spans", pa.list_(_SPAN))])


def find_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, spans array of (kind, start, end, base)) for every row of `docs` (doc_id, text).

    Whole texts; a null or empty text has an empty array. Offsets are code points, end exclusive.
    Repeated rows and null doc_ids keep their own result rows; other columns are ignored.
    """
    def run(batches):
        for b in batches:
            spans = [[{"kind": KINDS[k], "start": s, "end": e, "base": k < len(BASE_KINDS)}
                      for s, k, e in spans_of(t)] for own in slices_of(b.column(1)) for t in own]
            yield pa.RecordBatch.from_arrays(
                [b.column(0).cast(pa.int64()), pa.array(spans, _OUT.field(1).type)], schema=_OUT)
    return texts_of(docs, "doc_id").mapInArrow(
        run, "doc_id long, spans array<struct<kind:string,start:int,end:int,base:boolean>>")


def redact(text: str, mark: str = "<{}>") -> str:
    """The text with every span replaced by its kind; overlapping spans become one replacement."""
    out, at = [], 0
    for start, kind, end in spans_of(text):
        if end <= at:
            continue
        if start >= at:
            out += [text[at:start], mark.format(KINDS[kind].upper())]
        at = end
    return "".join([*out, text[at:]])
