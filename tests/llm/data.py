"""Small tables with every awkward case, and brute-force versions of the operators."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # columns that clash with names the operators use themselves
    *[T.StructField(c, T.StringType()) for c in ("rid", "_text", "kept", "score", "node", "l0", "items", "_row", "text_sha256")],
])
EXTRA = ("x",) * 9


def prose(rng, n: int, letters: int = 26) -> str:
    return " ".join("".join(chr(97 + c) for c in rng.integers(0, letters, rng.integers(1, 8))) for _ in range(n))


def awkward_texts(seed: int = 1) -> list[str | None]:
    rng = np.random.default_rng(seed)
    base, other = prose(rng, 120), prose(rng, 60)
    words = base.split()
    near = [" ".join(words[:k] + ["changed"] + words[k + 1:]) for k in (0, 5, 40, 119)]
    far = " ".join(words[:70]) + " " + prose(rng, 50)
    return [
        None, "", " \t\n", "one", "one two three four", "One  TWO three\tfour", base, base, base.upper(), *near, far, other,
        other + " " + base, prose(rng, 30000), "a" * 5000, "ab " * 3000, "é漢🙂 " * 400, "\x00\x0b\x0c x", "l1\nl2 7 x\nl3",
        "mail a.b@c.de and 10.0.0.1, card 4111 1111 1111 1111, call +49 30 1234567", "you idiot, you utter moron", base,
    ]


def awkward_rows() -> list[tuple]:
    rows = []
    for i, t in enumerate(awkward_texts()):
        rows.append((i, t, ["en", "de", None][i % 3], ["src0", "src1", None, ""][i % 4], None if t is None else len(t), *EXTRA))
    rows += [rows[6], rows[6], (None, "a text without an id", "en", "src0", 20, *EXTRA), (None, None, None, None, None, *EXTRA),
             (7, "the id of another text", "en", "src0", 22, *EXTRA)]
    return rows


def shingles(text: str | None) -> frozenset:
    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if len(w) >= 5:
        return frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4))
    return frozenset([tuple(w)]) if w else frozenset()


def similar_components(sets: list[frozenset]) -> list[int]:
    """For every set the position of the least set it is linked to; empty sets stand alone."""
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    of = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            of[x].append(i)
    both = Counter()
    for members in of.values():
        for k, i in enumerate(members):
            for j in members[k + 1:]:
                both[i, j] += 1
    for (i, j), n in both.items():
        if 100 * n >= 80 * (len(sets[i]) + len(sets[j]) - n):
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(sets))]


def covered(texts: list[bytes], length: int) -> list[np.ndarray]:
    """Which bytes lie in a string of ``length`` bytes that starts more than once."""
    n = Counter(t[p:p + length] for t in texts for p in range(len(t) - length + 1))
    out = []
    for t in texts:
        m = np.zeros(len(t), dtype=bool)
        for p in range(len(t) - length + 1):
            if n[t[p:p + length]] > 1:
                m[p:p + length] = True
        out.append(m)
    return out


def base_pii(text: str, kinds) -> list[tuple[str, int, int]]:
    """The four base kinds by plain expressions."""
    def luhn(d):
        return sum(v if i % 2 == 0 else sum(divmod(2 * v, 10)) for i, v in enumerate(map(int, reversed(d)))) % 10 == 0

    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m.group())
        if 12 <= len(d) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
            if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return sorted(out, key=lambda s: (s[1], kinds.index(s[0])))
