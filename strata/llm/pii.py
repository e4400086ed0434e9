"""Personal data: expressions propose spans, checksums and ranges confirm them, context adjusts the score.

Base kinds (always kept once confirmed): ``email``; ``ip`` (four parts, each at most
255); ``card`` (12 to 19 digits that pass Luhn); ``phone`` (9 to 15 digits).  A
proposal that fails its check is dropped and not tried again at another length.
Further kinds: ``iban`` (length and mod-97) and ``ssn`` (number ranges); they are kept
when their score, moved by words near the span, reaches ``MIN_SCORE``.

Every text is read whole, in time linear in its length: no expression can start inside
a run that it has already read, but for ``iban``, which reads at most 34 characters (and
the single spaces between them) from each start.  Spans are in code points, end
exclusive, and leftmost non-overlapping within a kind.

Defined cases: a null text counts as empty and has no spans; rows are independent, so
null ids, repeated rows and ties need no rule; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import few_rows, tidied, worker_tables

KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
BASE = KINDS[:4]
MIN_SCORE = 0.5
CONTEXT_CHARS = 40

_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
#: the run is read ahead, so that the next start may lie inside it
_IBAN = re.compile(r"(?<![A-Za-z0-9])(?=([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}+))")
_IN_WORD = re.compile(r"[A-Za-z0-9]")
_SSN = re.compile(r"(?<![0-9-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")

#: score of a confirmed span before its context, and the words that raise or lower it
PRIOR = {"email": 0.9, "ip": 0.7, "card": 0.8, "phone": 0.7, "iban": 0.8, "ssn": 0.45}
RAISE = {
    "email": ("mail", "contact", "write", "reply"),
    "ip": ("ip", "host", "server", "address", "login"),
    "card": ("card", "visa", "credit", "payment", "amex"),
    "phone": ("phone", "call", "tel", "mobile", "fax"),
    "iban": ("iban", "account", "bank", "transfer"),
    "ssn": ("ssn", "social", "security", "taxpayer"),
}
LOWER = {
    "email": ("example", "noreply"),
    "ip": ("version", "release", "build"),
    "card": ("order", "serial", "tracking"),
    "phone": ("order", "serial", "isbn"),
    "iban": ("example", "sample"),
    "ssn": ("part", "serial", "isbn", "order"),
}
STEP = 0.1
_WORD = re.compile(r"[^\W\d_]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def mod97(iban: str) -> bool:
    rest = 0
    for c in iban[4:] + iban[:4]:
        d = int(c, 36)
        rest = (rest * (100 if d > 9 else 10) + d) % 97
    return rest == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """A local part reaches left from its @ to the last character that may not be in one, or the match before."""
    done = 0
    for m in _DOMAIN.finditer(text):
        head = text[done:m.start()]
        start = done + len(head.rstrip(_LOCAL))
        if start < m.start():
            yield start, m.end()
            done = m.end()
        else:
            done = m.start() + 1


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and int(part) <= 255


def _digits(span: str) -> str:
    return "".join(filter(str.isdigit, span))


def _iban_end(text: str, start: int, stop: int) -> int | None:
    """The longest end at a word border, up to ``stop``, for which the checksum holds."""
    ends = [i for i in range(stop - 1, start + 14, -1) if text[i] == " "]
    if not _IN_WORD.match(text, stop):
        ends.insert(0, stop)
    for end in ends:
        code = text[start:end].replace(" ", "")
        if 15 <= len(code) <= 34 and mod97(code):
            return end
    return None


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    for m in _IBAN.finditer(text):
        if m.start() >= done and (end := _iban_end(text, *m.span(1))):
            yield m.start(), end
            done = end


def confirmed(text: str) -> list[tuple[str, int, int]]:
    """All confirmed spans (kind, start, end), by start and then kind."""
    out = []
    if "@" in text:
        out += [("email", s, e) for s, e in _emails(text)]
    out += [("ip", *m.span()) for m in _IP.finditer(text) if all(map(_octet, m.groups()))]
    for m in _CARD.finditer(text):
        d = m.end() - m.start()
        if d >= 12:
            digits = _digits(m.group())
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15]
    out += [("iban", s, e) for s, e in _ibans(text)]
    out += [("ssn", *m.span()) for m in _SSN.finditer(text)
            if m[1] not in ("000", "666") and m[1] < "900" and m[2] != "00" and m[3] != "0000"]
    out.sort(key=lambda s: (s[1], KINDS.index(s[0])))
    return out


def scored(text: str) -> list[tuple[str, int, int, float]]:
    """Confirmed spans with their score; a further kind below ``MIN_SCORE`` is left out."""
    out = []
    for kind, start, end in confirmed(text):
        near = {w.lower() for w in _WORD.findall(text[max(0, start - CONTEXT_CHARS):start])}
        near |= {w.lower() for w in _WORD.findall(text[end:end + CONTEXT_CHARS])}
        up = sum(w in near for w in RAISE[kind])
        down = sum(w in near for w in LOWER[kind])
        value = min(1.0, max(0.0, round(PRIOR[kind] + STEP * (up - down), 3)))
        if kind in BASE or value >= MIN_SCORE:
            out.append((kind, start, end, value))
    return out


SPANS = "array<struct<kind:string,start:int,end:int,score:double>>"


def _find(batches):
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
    worker_tables("pii")
    for b in few_rows(batches):
        text = b.column("_text")
        found = [[dict(zip(("kind", "start", "end", "score"), s)) for s in scored(x.as_py())] for x in text]
        keep = [c for c in b.schema.names if c != "_text"]
        yield pa.record_batch([b.column(c) for c in keep] + [pa.array(found, kind)], names=[*keep, "spans"])


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, spans`` (kind, start, end, score), by start and then kind."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    return rows.mapInArrow(tidied(_find), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, spans {SPANS}")


def redact(text: str) -> str:
    """``text`` with every span replaced by its kind in angle brackets (the earlier of overlapping spans wins)."""
    out, at = [], 0
    for kind, start, end, _ in scored(text):
        if start >= at:
            out += [text[at:start], f"<{kind}>"]
            at = end
    return "".join(out) + text[at:]


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
