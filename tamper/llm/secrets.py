"""Operator 8: secret scans with password guess costs.

Three base kinds are plain patterns (assignments, access keys, hex strings). The method
proper looks at values in a credential context ("password is ...", "pwd=...", "auth: ...",
"Bearer ..." with a value that is no plain word)
and computes the least number of guesses (log2) over all segmentations of the value into
dictionary words (also capitalised or with digits for letters), dates, repeats, keyboard
walks and brute-force spans, by dynamic programming from left to right. Values that cost
at least ``STRONG`` bits are secrets and add spans of kind ``guess``; placeholders and
weak words do not. Base spans stay as they are.

A map over rows: whole texts, no shuffle, no length limit (the program is linear in a
value's length times the longest word: walks and repeats are measured once from their
ends, and only segments that begin and stop near the ends of a run, or where another
segment ends, are tried). Defined cases: null text is empty and has no
spans; repeated rows and null ids are scanned each; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from math import log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tamper.llm import _text as X
from tamper.llm._spark import arrow_batches, table

KINDS = ("assign", "access", "hex", "guess")
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
                    r"([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
CONTEXT = re.compile(r"(?:pass(?:word|wd|phrase)?|pwd|secret|token|api[_-]?key|access[_-]?key|"
                     r"private[_-]?key|auth(?:orization)?|credential|bearer)s?[\"']?\x20*"
                     r"(?:[:=]+>?|\x20is\x20)\x20*[\"']?([^\s\"'<>,;(){}]+)", re.I | re.A)
SCHEME = re.compile(r"\b(?:bearer|basic|token|digest|negotiate)\x20+[\"']?([^\s\"'<>,;(){}]+)", re.I | re.A)
SCHEMES = ("bearer", "basic", "token", "digest", "negotiate")
TOKEN = re.compile(r"[0-9+/=_]|[a-z].*[A-Z]", re.A)
HINTS = ("pass", "pwd", "secret", "token", "api", "key", "auth", "credential", "bearer", "basic",
         "digest", "negotiate")
LEAST, STRONG = 6, 33.0

# Common words of passwords and placeholders, most common first.
WORDS = """password pass admin user login welcome letmein secret qwerty test master dragon
monkey shadow hello sunshine princess football baseball superman batman access guest root
love god money summer winter spring autumn hunter ranger killer soccer hockey george
michael jordan daniel thomas robert jessica ashley charlie andrew joshua pepper ginger
cookie banana orange purple silver golden cheese coffee computer internet server system
database default changeme example sample dummy placeholder none null true false undefined
your my here insert value token key api the new old temp demo prod dev stage public
private service account client app web mail home work office company school apple google
january february march april may june july august september october november december
monday tuesday wednesday thursday friday saturday sunday api_key access_key""".split()
RANK = {w: i + 1 for i, w in reversed(list(enumerate(WORDS)))}
LONGEST_WORD = max(map(len, WORDS))
LEET = str.maketrans("4301$5@7!8", "aeolssatib")
KEY_ROWS = ("`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
DATES = re.compile(r"(?:19|20)\d\d|\d{1,2}([-/.])\d{1,2}\1(?:19|20)?\d\d|(?:19|20)\d\d([-/.])\d{1,2}\2\d{1,2}"
                   r"|(?:19|20)\d\d(?:0[1-9]|1[0-2])(?:[0-2]\d|3[01])|(?:[0-2]\d|3[01])(?:0[1-9]|1[0-2])(?:19|20)\d\d")
YEARS, DAYS = 120, 366


def _neighbours() -> dict[str, set[str]]:
    """Keys next to each key on a slanted keyboard."""
    place = {c: (r, i) for r, row in enumerate(KEY_ROWS) for i, c in enumerate(row)}
    return {a: {b for b, (s, j) in place.items() if (s == r and abs(j - i) == 1)
                or (s == r - 1 and j - i in (0, 1)) or (s == r + 1 and i - j in (0, 1))}
            for a, (r, i) in place.items()}


NEAR = _neighbours()


def _char_bits(c: str, mixed: bool = False) -> float:
    if c.isascii():
        return log2(10 if c.isdigit() else 52 if c.isalpha() and mixed else 26 if c.isalpha() else 33)
    return log2(100)


# A walk or a repeat is left, or begun, within so many characters of the ends of its
# longest run, or not at all: further inside, going on costs less than any other segment.
RIM = 24


def _runs(value: str, low: str) -> tuple[list[int], list[int], list[list[int]]]:
    """Computed once, from the right or left: the end of the keyboard walk through each
    position, the turns of walks up to it, and for each unit 1 to 4 how far the text from
    a position repeats itself one unit on."""
    n = len(value)
    walk = [i + 1 for i in range(n)]
    for i in range(n - 2, -1, -1):
        if low[i + 1] in NEAR.get(low[i], ()):
            walk[i] = walk[i + 1]
    turns = [0] * (n + 1)
    for i in range(2, n):
        step, before = ord(low[i]) - ord(low[i - 1]), ord(low[i - 1]) - ord(low[i - 2])
        turns[i + 1] = turns[i] + (step != before)
    again = []
    for unit in (1, 2, 3, 4):
        same = [0] * (n + unit)
        for i in range(n - unit - 1, -1, -1):
            if value[i] == value[i + unit]:
                same[i] = same[i + 1] + 1
        again.append(same)
    return walk, turns, again


def _ends(start: int, last: int, step: int = 1):
    """Ends at which a segment may stop: near its start and near the end of its run."""
    near = min(last, start + RIM * step)
    yield from range(start, near + 1, step)
    far = max(near + step, last - RIM * step)
    far += (start - far) % step
    yield from range(far, last + 1, step)


def guess_bits(value: str) -> float:
    """log2 of the guesses that the cheapest segmentation of ``value`` needs. Linear in the
    length of the value."""
    n, low = len(value), value.lower()
    if len(low) != n:  # a letter whose lower case is longer
        low = value
    plain = low.translate(LEET)
    mixed = value[1:] != value[1:].lower() and value != value.upper()  # more than a first capital
    best = [0.0] + [float("inf")] * n
    walk, turns, again = _runs(value, low)
    entry = bytearray(n + 1)  # ends of words and dates, and of walks and repeats near their run's end
    began, since = 0, [0] * 4  # starts of the present walk, and of each unit's present run
    for i in range(n):
        here = best[i]

        def reach(end: int, bits: float, last: int = 0, here=here):
            if here + bits < best[end]:
                best[end] = here + bits
                if last - end <= RIM:
                    entry[end] = 1

        one = here + _char_bits(value[i], mixed)
        if one < best[i + 1]:
            best[i + 1] = one
        for size in range(3, min(LONGEST_WORD, n - i) + 1):
            for text, extra in ((low, 0), (plain, 1)):
                if rank := RANK.get(text[i:i + size]):
                    caps = value[i:i + size]
                    reach(i + size, log2(rank) + 1 + extra + (caps != caps.lower()))
        if value[i].isdigit() and (m := DATES.match(value, i)):
            reach(m.end(), log2(YEARS) if m.end() - i == 4 else log2(YEARS * DAYS) + 2)
        if i and walk[i] != walk[i - 1]:
            began = i
        if entry[i] or i - began <= RIM or walk[i] - i <= RIM:
            for end in _ends(i + 3, walk[i]):
                reach(end, log2(47 * (end - i)) + 1.5 * (turns[end] - turns[min(i + 2, end)]) / 2, walk[i])
        for k, same in enumerate(again):
            unit = k + 1
            if i and not same[i - 1]:
                since[k] = i
            if same[i] >= unit and (entry[i] or i - since[k] <= RIM or same[i] <= RIM):
                bits = sum(_char_bits(c, mixed) for c in value[i:i + unit])
                last = i + unit + same[i] // unit * unit
                for end in _ends(i + 2 * unit, last, unit):
                    if end - i >= 3:
                        reach(end, bits + log2((end - i) / unit), last)
    return best[n]


def scan(text: str, may_hex: bool = True) -> list[tuple[int, int, str]]:
    """(start, kind number, end) of all spans, sorted."""
    found = []
    low = text.lower()
    if any(h in low for h in HINTS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
        # after a scheme stand blanks alone, as in prose: a value there has to look like a token
        values = {m.span(1) for m in CONTEXT.finditer(text) if m[1].lower() not in SCHEMES}
        values |= {m.span(1) for m in SCHEME.finditer(text) if TOKEN.search(m[1])}
        found += [(a, 3, b) for a, b in values if b - a >= LEAST and guess_bits(text[a:b]) >= STRONG]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    if may_hex:
        found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


HEX_BYTES = ~X.separators((0x30, 0x39), (0x61, 0x66))


def rows_with_hex(column: pa.Array, least: int = 24) -> np.ndarray:
    """Which rows have a run of ``least`` hex digits."""
    data, offsets = X.text_bytes(column)
    starts, ends, _ = X.words(data, offsets, HEX_BYTES)
    rows = np.searchsorted(offsets, starts[ends - starts >= least], "right") - 1
    out = np.zeros(len(column), bool)
    out[rows] = True
    return out


def _scan_batches(batches):
    join = lambda spans: ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)
    for batch in batches:
        for part in X.chunks(batch):
            column = part.column("text")
            found = [scan(t or "", h) for t, h in zip(column.to_pylist(), rows_with_hex(column), strict=True)]
            counts = [[sum(k == n for _, k, _ in f) for f in found] for n in range(3)]
            base = [hashlib.sha256(join(s for s in f if s[1] < 3).encode()).hexdigest() for f in found]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts),
                 pa.array(base, pa.string()), pa.array([join(f) for f in found], pa.string())],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of every row of ``docs``."""
    arrow_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        _scan_batches, f"doc_id {kind}, n_assign long, n_access long, n_hex long, "
                       "base_sha256 string, spans string")


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(table(spark, sf_dir, "documents", "doc_id", "text"))
