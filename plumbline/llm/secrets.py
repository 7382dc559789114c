"""Secret scan: fixed forms, and weak candidates linked to their complementary parts."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import DataFrame, functions as F

from plumbline.llm.common import per_text

# The three base forms, in the order in which equal starts are listed.
KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")

# Parts that mean nothing alone.
WEAK_KINDS = ("weak_id", "weak_secret", "weak_endpoint")
_WEAK_ID = re.compile(r"""(?:user(?:name)?|login|account|client_?id)["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.@-]{3,})""", re.I | re.A)
_WEAK_SECRET = re.compile(r"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/_-]{16,}={0,2}(?![A-Za-z0-9+/=_-])", re.A)
_WEAK_ENDPOINT = re.compile(r"""[a-z][a-z0-9+]{1,15}://[^\s"'<>]+|\b\d{1,3}(?:\.\d{1,3}){3}(?::\d{2,5})?\b""", re.I | re.A)
_CUES = re.compile(r"passw|secret|token|api_?key", re.I | re.A)

Span = tuple[int, int, str]


def base_spans(text: str) -> list[Span]:
    """(start, end, kind) of the base forms, leftmost and non-overlapping per kind."""
    out: list[Span] = []
    if _CUES.search(text):
        out += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def _keyish(word: str, inside: bool) -> bool:
    """Letters and digits, since complementary parts decide; ``inside`` one of those it must look drawn, not written."""
    if inside:
        classes = sum(any(f(c) for c in word) for f in (str.isdigit, str.isupper, str.islower))
        return classes == 3 and len(set(word)) * 2 >= min(len(word), 40)
    return any(c.isdigit() for c in word) and any(c.isalpha() for c in word)


class _Parts:
    """Intervals by start, with the furthest end so far: joins by distance without making pairs."""

    def __init__(self, spans: list[Span]):
        spans = sorted(spans)
        self.starts = [a for a, _, _ in spans]
        self.tops = list(accumulate((b for _, b, _ in spans), max))

    def near(self, span: Span, scope: int) -> bool:
        """Whether at most ``scope`` code points lie between the span and one of the intervals, on either side."""
        k = bisect_right(self.starts, span[1] + scope)
        return k > 0 and self.tops[k - 1] >= span[0] - scope


def weak_parts(text: str, base: list[Span]) -> tuple[list[Span], list[Span], list[Span]]:
    """Weak identifiers, secrets and endpoints that overlap no base span."""
    taken = _Parts(base)

    def free(m: re.Match, group: int, kind: str) -> list[Span]:
        span = (m.start(group), m.end(group), kind)
        return [] if taken.near(span, -1) else [span]

    low = text.casefold()
    ids = [s for m in _WEAK_ID.finditer(text) for s in free(m, 1, "weak_id")] if any(c in low for c in ("user", "login", "account", "client")) else []
    ends = [s for m in _WEAK_ENDPOINT.finditer(text) for s in free(m, 0, "weak_endpoint")]
    if not any(k == "access" for _, _, k in base) and not (ids and ends):
        return ids, [], ends  # nothing could make a weak secret reportable
    others = _Parts(ids + ends)
    return ids, [s for m in _WEAK_SECRET.finditer(text) for s in free(m, 0, "weak_secret") if _keyish(m[0], others.near(s, -1))], ends


def linked_spans(text: str, base: list[Span], scope: int) -> list[Span]:
    """Weak parts with complementary parts within ``scope`` code points, from the end of one to the start of the other.

    An identifier (access or weak), a secret (base or weak) and an endpoint are linked when one of the three is within
    the scope of the other two; a weak secret is also linked to an access identifier in its scope. All weak parts of a
    link are reported. Links are found by interval look-ups, part by part, so many parts in one scope make no pairs.
    """
    ids, keys, ends = weak_parts(text, base)
    access = [s for s in base if s[2] == "access"]
    kinds = [ids + access, keys + [s for s in base if s[2] != "access"], ends]
    at = [_Parts(spans) for spans in kinds]
    centres = [_Parts([s for s in kinds[k] if all(at[j].near(s, scope) for j in range(3) if j != k)]) for k in range(3)]

    def linked(s: Span, k: int) -> bool:
        others = [j for j in range(3) if j != k]
        return all(at[j].near(s, scope) for j in others) or any(centres[j].near(s, scope) for j in others)

    whose = _Parts(access)
    out = [s for s in keys if whose.near(s, scope) or linked(s, 1)]
    out += [s for s in ids if linked(s, 0)]
    return out + [s for s in ends if linked(s, 2)]


class _Scan:
    def __init__(self, scope: int):
        self.scope = scope

    def __call__(self, raw: bytes) -> tuple:
        text = raw.decode("utf-8", "replace")
        base = base_spans(text)
        every = sorted([*base, *linked_spans(text, base, self.scope)], key=lambda s: (s[0], (*KINDS, *WEAK_KINDS).index(s[2]), s[1]))
        return [k for _, _, k in every], [a for a, _, _ in every], [b for _, b, _ in every]


def find_secrets(docs: DataFrame, scope: int = 400, out: list[str] | None = None) -> DataFrame:
    """Documents (columns ``out``, all by default) with the parallel arrays ``kinds``, ``starts``, ``ends`` of their spans.

    Spans are in code points, end exclusive, sorted by start and kind. ``assign``, ``access`` and ``hex`` are reported
    wherever they stand; ``weak_id``, ``weak_secret`` and ``weak_endpoint`` only when complementary parts co-occur
    within ``scope`` code points of the same document. NULL and empty texts have no spans; repeated rows are scanned
    each on its own; no row meets another, so there is no shuffle. Input columns named like an output are replaced.
    """
    mine = docs.drop("kinds", "starts", "ends")
    keep = [c for c in out or docs.columns if c in mine.columns]
    return per_text(mine, _Scan(scope), "kinds array<string>, starts array<int>, ends array<int>", keep)


def secret_digest(docs: DataFrame, scope: int = 400) -> DataFrame:
    """Per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    found = find_secrets(docs.select("doc_id", "text"), scope, out=["doc_id"])
    spans = F.transform(F.arrays_zip("kinds", "starts", "ends"), lambda s: F.struct(s.kinds.alias("k"), F.concat_ws(":", s.kinds, s.starts.cast("string"), s.ends.cast("string")).alias("t")))
    found = found.select("doc_id", spans.alias("s"))
    count = lambda kind: F.size(F.filter("s", lambda x: x.k == kind)).cast("long")
    base = F.filter("s", lambda x: x.k.isin(*KINDS))
    return found.select("doc_id", *(count(k).alias(f"n_{k}") for k in KINDS), F.sha2(F.concat_ws(",", F.transform(base, lambda x: x.t)), 256).alias("base_sha256"),
                        F.concat_ws(",", F.transform("s", lambda x: x.t)).alias("spans"))


def digest_of(spans: list[Span]) -> str:
    """sha256 of kind:start:end, comma-joined."""
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, b, k in spans).encode()).hexdigest()
