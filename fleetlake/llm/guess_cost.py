"""Secrets in texts: fixed patterns, and values in a credential context judged by their guess cost.

The guess cost of a value is the smallest sum, over all ways to cut it into segments, of the
segments' costs (log10 of the guesses an informed attacker needs): dictionary words with case and
look-alike spellings, dates and years, repeated units, keyboard walks and alphabetic or numeric
sequences, and brute force per character.  It is found by dynamic programming over the end of the
last segment.  Every segment kind has a bounded length, so a value costs time linear in its length,
and the search for "at least the threshold" ends as soon as no later prefix can be cheaper.

Patterns and contexts are found in the whole text; positions are code points, ends exclusive.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.llm import common
from fleetlake.llm.words import COMMON

#: log10 guesses from which a value in a credential context counts as a secret.
THRESHOLD = 7.5

# --- fixed values -------------------------------------------------------------------------------
KINDS = ("assign", "access", "hex", "guess")
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)([\"']?\x20*[:=]\x20*[\"']?)([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
#: Up to the first character of the value.
CONTEXT = re.compile(
    r"(?:password|passwd|secret|token|api[\x20_-]?key|(?<![A-Za-z0-9])(?:pass(?:phrase|code)?|pwd|credentials?|bearer|authorization|(?:access|private|secret|client)[\x20_-](?:key|secret|token)))"
    r"[\"']?(?:(?:[\x20\t]++(?:is|was))?[\x20\t]*+[:=][\x20\t]*+|[\x20\t]++(?:(?:is|was)[\x20\t]++)?)(?:bearer[\x20\t]++)?[\"']?(?=[!-~]{6})",
    re.IGNORECASE | re.ASCII,
)
VALUE = re.compile(r"[!-~]+")
CONTEXT_WORDS = ("pass", "pwd", "secret", "token", "credential", "bearer", "authorization", "key")
KEY_ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
SHIFTED = dict(zip('~!@#$%^&*()_+{}|:"<>?', "`1234567890-=[]\\;',./", strict=True))
LOOK_ALIKE = {"4": "a", "@": "a", "3": "e", "1": "i", "!": "i", "0": "o", "5": "s", "$": "s", "7": "t"}
WORDS = (
    "password pass admin login welcome monkey dragon master letmein qwerty shadow sunshine princess football baseball "
    "superman batman trustno hello freedom whatever secret token key user root test guest default changeme example "
    "sample dummy none null true false value string your here this that the and for with from have not are you all "
    "was but can one our out day get has him his how man new now old see two way who boy did its let put say she too "
    "use dad mom love money summer winter spring autumn monday friday january june july august april march may "
    "house water world time year people first last long great little own other right big high small large next early "
    "young important few public bad same able jesus michael jordan harley ranger buster soccer hockey killer george "
    "andrew charlie daniel thomas robert hunter tigger purple orange yellow silver golden cookie pepper ginger server "
    "system data base account service client access private number name word code home work"
).split()

SEGMENT = 0.3  # per segment: where the attacker has to place the cut
MAX_RUN, MAX_UNIT = 64, 8
YEAR = re.compile(r"(?:19|20)\d\d")
DATE = re.compile(
    r"(?:19|20)\d\d([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])"
    r"|(?:0[1-9]|[12]\d|3[01])([-/._]?)(?:0[1-9]|1[0-2])\2(?:(?:19|20)\d\d|\d\d)"
    r"|(?:0[1-9]|1[0-2])([-/._]?)(?:0[1-9]|[12]\d|3[01])\3(?:(?:19|20)\d\d|\d\d)"
)
DATE_COST, YEAR_COST = math.log10(366 * 120), math.log10(120)


def _places() -> dict[str, tuple[int, float]]:
    shift = (0.0, 0.5, 0.75, 1.25)
    return {c: (r, i + shift[r]) for r, row in enumerate(KEY_ROWS) for i, c in enumerate(row)}


PLACES = _places()
RANKS = {w: i + 1 for i, w in reversed(list(enumerate([*WORDS, *COMMON])))}
LONGEST_WORD = max(map(len, RANKS))


def brute_force(c: str) -> float:
    """log10 of the characters of this one's class."""
    if c.isascii():
        return 1.0 if c.isdigit() else math.log10(26) if c.isalpha() else math.log10(33)
    return 2.0


def word_cost(s: str) -> float | None:
    """Cost of a dictionary word, also capitalised or with look-alike characters."""
    low = s.lower()
    rank = RANKS.get(low)
    extra = 0.0 if s == low else math.log10(2) if s[1:] == low[1:] or s.isupper() else math.log10(2) * sum(c != d for c, d in zip(s, low, strict=True))
    if rank is None:
        plain = "".join(LOOK_ALIKE.get(c, c) for c in low)
        rank = RANKS.get(plain)
        extra += math.log10(2) * sum(c != d for c, d in zip(low, plain, strict=True))
    return None if rank is None else math.log10(rank + 1) + extra


def date_cost(s: str) -> float | None:
    if 6 <= len(s) <= 10 and DATE.fullmatch(s):
        return DATE_COST
    return YEAR_COST if len(s) == 4 and YEAR.fullmatch(s) else None


def repeat_cost(s: str) -> float | None:
    """The shortest unit (at most MAX_UNIT characters) that, repeated, gives ``s``."""
    for u in range(1, min(MAX_UNIT, len(s) // 2) + 1):
        if len(s) % u == 0 and s == s[:u] * (len(s) // u):
            return sum(map(brute_force, s[:u])) + math.log10(len(s) // u)
    return None


def step(a: str, b: str) -> tuple | None:
    """The direction from one key to the next, or None when they are not neighbours; sequences of
    letters and digits count as walks too."""
    if (a.isalpha() and b.isalpha() or a.isdigit() and b.isdigit()) and abs(ord(b) - ord(a)) == 1:
        return ("order", ord(b) - ord(a))
    p, q = PLACES.get(SHIFTED.get(a, a).lower()), PLACES.get(SHIFTED.get(b, b).lower())
    if p is None or q is None or p == q:
        return None
    rows, along = q[0] - p[0], q[1] - p[1]
    return (rows, along > 0) if abs(rows) <= 1 and abs(along) <= 1 else None


def walk_cost(s: str) -> float | None:
    """Start key, length and turns of a walk of three or more keys."""
    if len(s) < 3:
        return None
    steps = [step(a, b) for a, b in zip(s[:-1], s[1:], strict=True)]
    if None in steps:
        return None
    turns = sum(a != b for a, b in zip(steps[:-1], steps[1:], strict=True))
    return math.log10(94) + math.log10(len(s)) + turns * math.log10(8)


def segment_cost(s: str) -> float | None:
    """The cheapest reading of ``s`` as one segment that is not brute force."""
    found = [c for f in (word_cost, date_cost, repeat_cost, walk_cost) if (c := f(s)) is not None]
    return min(found) if found else None


def guess_cost(value: str, enough: float = math.inf) -> float:
    """Smallest cost over all segmentations (a brute-force span costs its characters, any other
    segment its own cost and SEGMENT).  When that is at least ``enough`` the result is some number
    from ``enough`` on: the search stops once every prefix that a later segment could start from
    costs that much."""
    n = len(value)
    plain = [0.0]
    for c in value:
        plain.append(plain[-1] + brute_force(c))
    best = [0.0] * (n + 1)
    same = [0] * (MAX_UNIT + 1)  # length of the run of characters that equal the one u places before
    walk, turns, last = 0, [0], None  # steps in the walk that ends here; turns so far
    for end in range(1, n + 1):
        i = end - 1
        low = best[i] + plain[end] - plain[i]
        for length in range(2, min(LONGEST_WORD, end) + 1):
            s = value[end - length : end]
            for cost in (word_cost(s), date_cost(s)):
                if cost is not None:
                    low = min(low, best[end - length] + cost + SEGMENT)
        for u in range(1, MAX_UNIT + 1):
            same[u] = same[u] + 1 if i >= u and value[i] == value[i - u] else 0
            if same[u] >= u:
                unit = plain[end] - plain[end - u]
                for k in range(2, min(same[u] // u + 1, MAX_RUN // u) + 1):
                    low = min(low, best[end - k * u] + unit + math.log10(k) + SEGMENT)
        way = step(value[i - 1], value[i]) if i else None
        turns.append(turns[-1] + (way is not None and last is not None and way != last))
        walk, last = (walk + 1 if way is not None else 0), way
        for length in range(3, min(walk + 1, MAX_RUN) + 1):
            turned = turns[end] - turns[end - length + 2]
            low = min(low, best[end - length] + math.log10(94) + math.log10(length) + turned * math.log10(8) + SEGMENT)
        best[end] = low
        if low >= enough and min(best[max(0, end - MAX_RUN) : end + 1]) >= enough:
            return low
    return best[n]


def findings(text: str | None, threshold: float = THRESHOLD) -> list[tuple[str, int, int, int, int]]:
    """(kind, start, end, value start, value end) of every secret, by start, then kind."""
    if not text:
        return []
    out = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        for m in ASSIGN.finditer(text):
            if m.end(3) - m.start(3) >= 8:
                out.append(("assign", m.start(), m.end(), m.start(3), m.end(3)))
    out += [("access", m.start(), m.end(), m.start(), m.end()) for m in ACCESS.finditer(text)]
    out += [("hex", m.start(), m.end(), m.start(), m.end()) for m in HEX.finditer(text)]
    if any(w in low for w in CONTEXT_WORDS):
        m = CONTEXT.search(text)
        while m:
            start = at = m.end()
            value = VALUE.match(text, start)[0].rstrip(".,;:!?)]}>\"'")
            if len(value) >= 6 and guess_cost(value, threshold) >= threshold:
                at = start + len(value)
                out.append(("guess", start, at, start, at))
            # a value that is no secret may be the keyword of the next context
            m = CONTEXT.search(text, at)
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0])))


def redact(text: str | None, threshold: float = THRESHOLD) -> str | None:
    """The text with the value of every finding replaced by ``[secret]``; overlapping values are
    one replacement."""
    spans = sorted((a, b) for _, _, _, a, b in findings(text, threshold))
    if not spans:
        return text
    out, at, i = [], 0, 0
    while i < len(spans):
        a, b = spans[i]
        while i + 1 < len(spans) and spans[i + 1][0] < b:
            i += 1
            b = max(b, spans[i][1])
        out += [text[at:a], "[secret]"]
        at = b
        i += 1
    return "".join(out) + text[at:]


FINDING = "array<struct<kind:string,start:int,end:int,value_start:int,value_end:int>>"
FINDING_ARROW = pa.list_(pa.struct([("kind", pa.string()), *((n, pa.int32()) for n in ("start", "end", "value_start", "value_end"))]))


def _scan(threshold: float, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(batch.schema.get_field_index("key"))
            (texts,) = common.batches_of(batch, "text")
            found = [findings(t, threshold) for t in texts]
            names = ("kind", "start", "end", "value_start", "value_end")
            columns = [keys, pa.array([[dict(zip(names, f, strict=True)) for f in x] for x in found], FINDING_ARROW)]
            if with_text:
                columns.append(pa.array([redact(t, threshold) if x else t for t, x in zip(texts, found, strict=True)], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=["key", "findings", "text"][: len(columns)])

    return run


def scan(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, findings) for every row of ``docs`` (doc_id, text): a narrow pass, one row out per
    row in, whatever the doc_id (null or repeated).  Null and empty texts have no findings."""
    common.configure(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("key"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_scan(threshold, False), f"key long, findings {FINDING}").withColumnRenamed("key", "doc_id")


def redacted(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with the secrets of ``text`` replaced and a column ``findings`` (replaced if there is
    one); all other columns as they are, row by row."""
    common.configure(docs.sparkSession)
    others = [c for c in docs.columns if c not in ("text", "findings")]
    rows = docs.select(F.struct(*others).alias("key"), F.col("text").cast("string").alias("text"))
    out = rows.mapInArrow(_scan(threshold, True), f"key {rows.schema['key'].dataType.simpleString()}, findings {FINDING}, text string")
    return out.select("key.*", "findings", "text")


def span_digest(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Counts and span lists of ``scan`` per document."""
    count = lambda kind: F.size(F.filter("findings", lambda x: x["kind"] == kind)).cast("long")
    line = lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))
    return scan(docs, threshold).select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(F.array_join(F.transform(F.filter("findings", lambda x: x["kind"] != "guess"), line), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("findings", line), ",").alias("spans"),
    )
