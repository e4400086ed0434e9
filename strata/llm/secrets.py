"""Secrets: fixed forms, and literals that source or configuration text assigns to sensitive names.

Base kinds (always kept): ``assign`` (a sensitive word, ``:`` or ``=``, six characters or
more), ``access`` (an access key id of 20 characters or more) and ``hex`` (24 or more
lower-case hexadecimal digits).  They are leftmost non-overlapping matches; one that is
too short is dropped and not tried again.

``literal`` is found by reading assignments.  Lines that hold an assignment sign, a flag or
a tag are cut into tokens (strings, names, signs), and every assignment gives a target
name and a value: string literals, bare words of configuration, and names of
other values.  Forms read: ``x = "v"``, ``x: T = "v"``, ``x := "v"``, ``"x": "v"``,
``m["x"] = "v"``, ``x => "v"``, ``f(x="v")``, ``x: v``, ``X=v``, ``?x=v&``, ``--x v``,
``<x>v</x>``, ``x = "a" + y + "b"``, ``x = wrap("v")``, ``${y}`` and ``{y}`` inside strings.

Values are constants that travel: an assignment from a name takes over what that name
holds just then (or, if it was never set before, what it holds at the end, as in
configuration).  Every value is a node whose parents are the values it was made of, and a
literal gets the highest score of the names that it reaches.  The nodes are made in text
order, so one sweep back does this in linear time.

Score: words of the target name (snake, kebab and camel case) count for or against, then
length, kinds of characters and entropy of the literal; placeholders, prose and one-kind
bare words count against.  A literal below ``MIN_SCORE`` is left out.

Defined cases: a null text counts as empty and has no spans; rows are independent, so null
ids, repeated rows and ties need no rule; an empty table gives an empty result; other
columns are ignored.  Texts are read whole; spans are in code points, end exclusive.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import few_rows, tidied, worker_tables

KINDS = ("assign", "access", "hex", "literal")
BASE = KINDS[:3]
MIN_SCORE = 0.7
#: the shortest value of ``assign`` and of ``literal``
MIN_CHARS = 6

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")

#: tokens that a bracket's or a call's other end is looked for
NEAR = 64

#: words of a name, and what they add to its score
STRONG = {"password", "passwd", "pwd", "passphrase", "passcode", "secret", "secrets", "token", "credential", "credentials",
          "apikey", "bearer", "authorization"}
STRONG_PAIRS = {("api", "key"), ("access", "key"), ("private", "key"), ("secret", "key"), ("auth", "key"), ("account", "key"),
                ("encryption", "key"), ("signing", "key"), ("shared", "key"), ("master", "key"), ("auth", "token")}
WEAK = {"key", "auth", "pass", "pin", "salt", "signature", "session", "cookie", "dsn", "cert"}
AGAINST = {"file", "path", "url", "uri", "name", "id", "field", "label", "hint", "prompt", "length", "len", "size", "count", "max",
           "min", "expiry", "expires", "ttl", "type", "policy", "regex", "pattern", "format", "version", "column", "header", "param",
           "error", "message", "reset", "public"}
_PLACEHOLDER = re.compile(r"(?i)^(?:change.?me|example.*|sample.*|dummy.*|your.*|my.?(?:password|secret|token).*|"
                          r"password|passwd|secret|token|none|null|undefined|true|false|required|optional|string|"
                          r"x{3,}.*|\*+|\.+|<.*>|todo.*|redacted|hidden)$")
_NAME_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")

#: a string opens at a quote after white space or a sign, so that an apostrophe in prose does not
_TOKEN = re.compile(r"""
    (?P<str>(?<![^\s=:,+(\[{>?&|frbuFRBU])(?:"(?:[^"\\\n]|\\.)*+"|'(?:[^'\\\n]|\\.)*+'|`(?:[^`\\\n]|\\.)*+`))
  | (?P<tag></?[A-Za-z_][\w.-]*>)
  | (?P<flag>(?<!\S)--?[A-Za-z][\w-]*)
  | (?P<op>==|!=|<=|>=|=>|->|:=|\?=|\+=|::|[=:+,;()\[\]{}&|?])
  | (?P<word>[^\s=:,;+()\[\]{}"'`&|?<>]+)
  | (?P<other>\S)
""", re.X)
_SETS = {"=", ":", ":=", "?=", "+=", "=>"}
_STOPS = _SETS | {",", ";", ")", "[", "]", "}", "&", "|", "?", "==", "!="}
#: what ends the search for the name before a type
_PARTS = {",", ";", "(", ")", "{", "}", "?", "=", "&&"}
_IDENT = re.compile(r"[A-Za-z_$][\w$.-]*\Z")
_REF = re.compile(r"\$\{(\w+)\}|\$(\w+)|\{\{\s*(\w+)\s*\}\}|\{(\w+)\}|%\((\w+)\)s")
_LOOKUP = re.compile(r"(?i)env|get|input|prompt|read|find|fetch|load")
_SCHEME = {"bearer", "basic"}
_QUOTES = "\"'`"


def name_score(name: str) -> float:
    """How much a target name says that its value is secret."""
    words = [w.lower() for w in _NAME_WORD.findall(name)]
    if not words:
        return 0.0
    kinds = set(words)
    value = 0.0
    if kinds & STRONG or any(p in STRONG_PAIRS for p in zip(words, words[1:])):
        value = 0.6
    elif kinds & WEAK:
        value = 0.4
    return value - 0.6 * bool(kinds & AGAINST)


def entropy(text: str) -> float:
    """Bits a character."""
    n = len(text)
    return -sum(c / n * math.log2(c / n) for c in Counter(text).values()) if n else 0.0


def literal_score(value: str, quoted: bool) -> float:
    """What a literal's own form adds."""
    if len(value) < MIN_CHARS:
        return -1.0
    head = value[:4096]
    kinds = sum(any(f(c) for c in head) for f in (str.islower, str.isupper, str.isdigit, lambda c: not c.isalnum()))
    out = 0.2 * (len(value) >= 8) + 0.1 * (len(value) >= 16) + 0.2 * (kinds >= 2) + 0.1 * (entropy(head) >= 3)
    if _PLACEHOLDER.match(head) or len(set(head)) < 3:
        out -= 0.6
    if re.search(r"\s", head):
        out -= 0.4
    if not quoted and kinds < 2:
        out -= 0.4
    return out


class _Values:
    """The values of one text: literals, what they are made of, and the names they reach."""

    def __init__(self):
        self.nodes: list[list] = []  # score of the target, literals (start, end, quoted), parent nodes
        self.held: dict[str, int] = {}
        self.late: list[tuple[int, str]] = []

    def key(self, name: str) -> str:
        return re.sub(r"^(?:self|this)[.]", "", name).lstrip("$")

    def assign(self, name: str, literals, refs, add: bool) -> None:
        at, parents, key = len(self.nodes), [], self.key(name)
        for r in map(self.key, refs):
            if r in self.held:
                parents.append(self.held[r])
            elif r != key:
                self.late.append((at, r))
        if add and key in self.held:
            parents.append(self.held[key])
        self.nodes.append([name_score(name), literals, parents])
        self.held[key] = at

    def scored(self) -> Iterator[tuple[int, int, bool, float]]:
        """Every literal with the highest score of a name that it reaches."""
        def sweep():
            for score, _, parents in reversed(self.nodes):
                for p in parents:
                    self.nodes[p][0] = max(self.nodes[p][0], score)
        sweep()
        for at, r in self.late:
            if r in self.held:
                to = self.nodes[self.held[r]]
                to[0] = max(to[0], self.nodes[at][0])
        if self.late:
            sweep()
        for score, literals, _ in self.nodes:
            for start, end, quoted in literals:
                yield start, end, quoted, score


def _target(tokens, at: int) -> str | None:
    """The name that the assignment sign at ``at`` sets."""
    i = at - 1
    if i < 0:
        return None
    kind, text = tokens[i][:2]
    if kind == "op" and text == "]":  # m["x"] = or x[] =
        if i >= 2 and tokens[i - 1][0] == "str":
            return tokens[i - 1][1].strip(_QUOTES)
        i = next((k for k in range(i, max(-1, i - NEAR), -1) if tokens[k][1] == "["), 0) - 1
        return tokens[i][1] if i >= 0 and tokens[i][0] == "word" else None
    if kind == "str":
        return text.strip(_QUOTES)
    if kind == "flag":
        return text.lstrip("-")
    if kind != "word":
        return None
    if tokens[at][1] == "=":  # x: T = v
        for j in range(i - 1, max(0, i - 4), -1):
            if tokens[j][1] == ":" and tokens[j - 1][0] == "word":
                return tokens[j - 1][1]
            if tokens[j][1] in _PARTS:
                break
    return text.lstrip("*&") if _IDENT.match(text.lstrip("*&")) else None


def _value(tokens, at: int, base: int, line: str):
    """Literals and names from the token ``at`` on: one sum of terms."""
    literals, refs, more = [], [], True
    while at < len(tokens):
        kind, text, start, end = tokens[at]
        if kind == "op":
            if text == "+":
                more, at = True, at + 1
                continue
            break
        if kind == "str":  # neighbours in a row are one string, in some languages
            refs += [next(filter(None, r)) for r in _REF.findall(text)]
            literals.append((base + start + 1, base + end - 1, True))
            more, at = False, at + 1
            continue
        if not more or kind not in ("word", "flag"):
            break
        if at + 1 < len(tokens) and tokens[at + 1][0] == "str" and tokens[at + 1][2] == end and len(text) <= 2:
            at += 1  # a prefix as in f"" or rb''
            continue
        if at + 1 < len(tokens) and tokens[at + 1][1] == "(":  # a call: its last literal, unless it looks a value up by one
            inside, at, depth = [], at + 2, 1
            stop = min(len(tokens), at + NEAR)
            while at < stop and depth:
                depth += (tokens[at][1] == "(") - (tokens[at][1] == ")")
                if tokens[at][0] == "str":
                    inside.append(tokens[at])
                at += 1
            if len(inside) > 1 or inside and not _LOOKUP.search(text):
                literals.append((base + inside[-1][2] + 1, base + inside[-1][3] - 1, True))
            more = False
            continue
        if text.lower() in _SCHEME:
            at += 1
            continue
        ref = _REF.match(line, start)
        if ref:
            refs.append(next(filter(None, ref.groups())))
            while at < len(tokens) and tokens[at][2] < ref.end():
                at += 1
            more = False
            continue
        stop = at + 1  # a bare word goes on to the next white space or end sign
        while stop < len(tokens) and tokens[stop][2] == tokens[stop - 1][3] and tokens[stop][1] not in _STOPS and tokens[stop][0] != "tag":
            stop += 1
        if stop < len(tokens) and tokens[stop][1] in ("=", "==") and tokens[stop][2] == tokens[stop - 1][3] \
                and (stop + 1 == len(tokens) or tokens[stop + 1][2] > tokens[stop][3]):
            stop += 1  # the padding of a coded value
        if stop < len(tokens) and tokens[stop][1] == "[":
            break  # a look-up
        last = tokens[stop - 1][3]
        word = line[start:last].rstrip(".,!?")
        if _IDENT.match(word):
            refs.append(word)
        literals.append((base + start, base + start + len(word), False))
        more, at = False, stop
    return literals, refs


def _line(line: str, base: int, values: _Values) -> None:
    tokens = [(m.lastgroup, m.group(), m.start(), m.end()) for m in _TOKEN.finditer(line)]
    for at, (kind, text, start, end) in enumerate(tokens):
        nxt = tokens[at + 1] if at + 1 < len(tokens) else None
        if kind == "op" and text in _SETS:
            name = _target(tokens, at)
            if name and nxt:
                if text == ":" and nxt[0] != "str" and any(t[1] == "=" for t in tokens[at + 2:at + 5]) \
                        and not any(t[1] in _PARTS - {"="} for t in tokens[at + 1:at + 4]):
                    continue  # x: T = v is read at its "="
                values.assign(name, *_value(tokens, at + 1, base, line), text == "+=")
        elif kind == "flag" and nxt and nxt[0] in ("word", "str") and nxt[2] > end:
            values.assign(text.lstrip("-"), *_value(tokens, at + 1, base, line), False)
        elif kind == "tag" and text[1] != "/":
            stop = line.find("</", end)
            inner = line[end:stop].strip() if stop > end else ""
            if inner and "<" not in inner:
                first = base + end + line[end:stop].index(inner)
                values.assign(text[1:-1], [(first, first + len(inner), True)], [], False)


def literals(text: str) -> list[tuple[int, int, float]]:
    """Literals assigned to sensitive names: start, end, score."""
    values, base = _Values(), 0
    for line in text.split("\n"):
        if "=" in line or ":" in line or "--" in line or "</" in line:
            _line(line, base, values)
        base += len(line) + 1
    best: dict[tuple[int, int], float] = {}
    for start, end, quoted, score in values.scored():
        if score > 0 and end - start >= MIN_CHARS:
            value = round(min(1.0, score + literal_score(text[start:end], quoted)), 3)
            if value >= MIN_SCORE:
                best[start, end] = max(value, best.get((start, end), 0.0))
    out, done = [], 0
    for (start, end), value in sorted(best.items()):
        if start >= done:
            out.append((start, end, value))
            done = end
    return out


def find(text: str) -> list[tuple[str, int, int, float]]:
    """All spans (kind, start, end, score), by start and then kind."""
    out = []
    low = text.lower()
    if any(w in low for w in _ASSIGN_WORDS):
        out += [("assign", *m.span(), 1.0) for m in _ASSIGN.finditer(text) if m.end() - m.start(2) >= MIN_CHARS]
    if "AKIA" in text:
        out += [("access", *m.span(), 1.0) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [("hex", *m.span(), 1.0) for m in _HEX.finditer(text)]
    out += [("literal", *s) for s in literals(text)]
    out.sort(key=lambda s: (s[1], KINDS.index(s[0])))
    return out


SPANS = "array<struct<kind:string,start:int,end:int,score:double>>"


def _find(batches):
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
    worker_tables("secrets")
    for b in few_rows(batches):
        found = [[dict(zip(("kind", "start", "end", "score"), s)) for s in find(x.as_py())] for x in b.column("_text")]
        keep = [c for c in b.schema.names if c != "_text"]
        yield pa.record_batch([b.column(c) for c in keep] + [pa.array(found, kind)], names=[*keep, "spans"])


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, spans`` (kind, start, end, score), by start and then kind."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    return rows.mapInArrow(tidied(_find), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, spans {SPANS}")


def redact(text: str) -> str:
    """``text`` with every span replaced by its kind in angle brackets (the earlier of overlapping spans wins)."""
    out, at = [], 0
    for kind, start, end, _ in find(text):
        if start >= at:
            out += [text[at:start], f"<{kind}>"]
            at = end
    return "".join(out) + text[at:]
