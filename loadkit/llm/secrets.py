"""Secrets in texts, and credentials in several parts that lie near each other."""

from __future__ import annotations

import bisect
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_batch, texts

#: Base kinds in the order of ties, then the kinds that linking adds.
KINDS = ("assign", "access", "hex", "weak_id", "weak_secret", "endpoint")
#: A scope: the lines up to so many code points around a part, not beyond a blank line.
REACH = 400
_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = bytes(49 if chr(b) in "0123456789abcdef" else 32 for b in range(256))
_ID = re.compile(r"""(?:user(?:name)?|login|account|client_?id|access_?key(?:_?id)?)["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.@-]{3,64})""", re.A | re.I)
_LONG = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}(?![A-Za-z0-9+/_=-])")
_ENDPOINT = re.compile(r"""(?:https?|ftp|jdbc:\w+|postgres(?:ql)?|mysql|mongodb|redis|amqp|s3|ssh)://[^\s"'<>]+""", re.A | re.I)
#: The part of a name that lies before an identifier's word, and what makes such a name a secret's.
_NAME = re.compile(r"[A-Za-z0-9_.-]*\Z")
_OF_SECRET = re.compile(r"secret|private", re.I)
_BLANK = re.compile(r"\n[ \t\r]*\n")


def base(text: str) -> list[tuple[str, int, int]]:
    """Spans of the three base kinds: assign, access and hex."""
    found, raw = [], text.encode()
    low = raw.lower()
    if any(w in low for w in _WORDS):
        found += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    if b"AKIA" in raw:
        found += [("access", *m.span()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18]
    runs = raw.translate(_HEX)
    at = runs.find(b"1" * 16)
    if at >= 0:
        code = (lambda i: i) if len(raw) == len(text) else (lambda i: len(raw[:i].decode()))
        while at >= 0:
            end = runs.find(b" ", at)
            end = len(runs) if end < 0 else end
            found.append(("hex", code(at), code(end)))
            at = runs.find(b"1" * 16, end)
    return found


def entropy(text: str) -> float:
    """Bits a character."""
    n = len(text)
    return -sum(c / n * math.log2(c / n) for c in Counter(text).values())


def scopes(text: str) -> list[int]:
    """Where blank lines part the text: ends of blocks."""
    return [m.end() for m in _BLANK.finditer(text)] + [len(text)]


class Stretches:
    """Places that some spans cover, as sorted stretches apart from each other: one sweep to make, one bisection to ask."""

    def __init__(self, spans):
        self.starts, self.ends = [], []
        for a, b in sorted(spans):
            if self.ends and a <= self.ends[-1]:
                self.ends[-1] = max(b, self.ends[-1])
            else:
                self.starts.append(a)
                self.ends.append(b)

    def meet(self, a: int, b: int) -> bool:
        k = bisect.bisect_right(self.ends, a)
        return k < len(self.starts) and self.starts[k] < b


def linked(text: str, spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Weak parts of a credential whose complements lie in their scope.

    Parts are identifiers (access keys, or `user = ...`), secrets (assigned values and hex runs,
    or long words of high entropy) and endpoints (locations with a scheme). A weak identifier is
    reported if a secret and an endpoint, or an assigned secret alone, meet it; a weak secret if
    an identifier meets it; an endpoint if an identifier and a secret do. Two parts meet if their
    intervals, widened by REACH within their block, overlap. Intervals of a kind are joined to
    stretches once, so time grows with the number of parts and not with their pairs. An
    identifier has 3 to 64 characters, and the 64 before it tell whether its name is a secret's.
    """
    strong = Stretches(s[1:] for s in spans)
    ids = [m.span() for m in _ID.finditer(text) if not _OF_SECRET.search(_NAME.search(text[max(0, m.start() - 64) : m.start()])[0])]
    ends = [m.span() for m in _ENDPOINT.finditer(text)]
    known_ids, known_secrets = [s[1:] for s in spans if s[0] == "access"], [s[1:] for s in spans if s[0] != "access"]
    if not (ids or known_ids):
        return []
    weak_ids = [s for s in ids if not strong.meet(*s)]
    other = Stretches([*ends, *ids])
    weak_secrets = [m.span() for m in _LONG.finditer(text) if not strong.meet(*m.span()) and not other.meet(*m.span()) and entropy(m[0]) >= 3.5 and re.search(r"\d", m[0])]
    blocks = scopes(text)

    def widened(span):
        """Blocks are apart and a widened interval stays in its own, so those of two blocks never overlap."""
        k = bisect.bisect_right(blocks, span[0])
        return max(span[0] - REACH, blocks[k - 1] if k else 0), min(span[1] + REACH, blocks[min(k, len(blocks) - 1)])

    near = {name: Stretches(map(widened, parts)) for name, parts in (
        ("id", [*weak_ids, *known_ids]), ("secret", [*weak_secrets, *known_secrets]), ("end", ends), ("assigned", [s[1:] for s in spans if s[0] == "assign"]))}
    meets = lambda span, name: near[name].meet(*widened(span))
    out = [("weak_secret", *s) for s in weak_secrets if meets(s, "id")]
    out += [("weak_id", *s) for s in weak_ids if meets(s, "assigned") or meets(s, "secret") and meets(s, "end")]
    out += [("endpoint", *s) for s in ends if meets(s, "id") and meets(s, "secret") and not strong.meet(*s)]
    return out


def scan(text: str) -> tuple[list, list]:
    """(base spans, all spans), each sorted by start, then kind."""
    order = lambda s: (s[1], KINDS.index(s[0]), s[2])
    found = base(text)
    return sorted(found, key=order), sorted(found + linked(text, found), key=order)


def joined(spans: list) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find_secrets(docs: DataFrame, keys: list, text: str = "text") -> DataFrame:
    """`keys`, counts of the base kinds, base (its spans as text) and spans (all of them).

    A row's text is all that its spans depend on, so nothing is shuffled: the interval join of
    parts runs within the row, over sorted lists, in time that grows with the text. Null and empty
    texts have no span; equal rows are returned each, null keys as they are; other columns are not
    read, and an empty table gives an empty result.
    """
    kept = docs.select(*keys, F.col(text).alias("_text"))
    names = kept.columns[:-1]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1])

    def fn(batch):
        found = [scan(t) for t in texts(batch.column("_text"))]
        counts = {f"n_{kind}": pa.array([sum(s[0] == kind for s in b) for b, _ in found], pa.int64()) for kind in KINDS[:3]}
        return {n: batch.column(n) for n in names} | counts | {"base": pa.array([joined(b) for b, _ in found]), "spans": pa.array([joined(s) for _, s in found])}

    return by_batch(kept, kept.columns, f"{schema}, n_assign bigint, n_access bigint, n_hex bigint, base string, spans string", fn)
