"""Secret scans: fixed patterns, and Shannon entropy in sliding windows.

Candidate strings are long runs of key characters. For each character class a
window slides over the runs of that class inside a candidate; counts of its
characters and the sum of n·log2(n) change by one character in and one out, so
the entropy of every window costs a constant. Windows over the class's limit
join into spans, an allow-list suppresses known harmless shapes, placeholder
words excuse their own word or window, and of a span that meets a pattern's the
parts outside the pattern's stay.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from lakemill.llm.common import column, field, texts, whole

# The kinds of the contract, in its order.
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LONG_HEX = re.compile(r"[0-9a-f]{16,}")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
KINDS = ("assign", "access", "hex", "entropy")

CANDIDATE = re.compile(r"[A-Za-z0-9+/=_-]{20,}")
DIGIT = re.compile(r"[0-9]")


@dataclass(frozen=True)
class CharClass:
    """Runs of ``chars``; a window of ``size`` counts from ``bits`` of entropy on, if it holds each of ``needs``.

    With ``shape``, a window must also hold that pattern, and stands for its whole run.
    """

    name: str
    chars: str
    size: int
    bits: float
    needs: str
    shape: str = ""


#: In one case letters tell little from words: three numbers in a window, or two and four letters without a vowel.
SPREAD = r"(?i)(?:[0-9]+[a-z]+){2}[0-9]|(?=.*[0-9][a-z]+[0-9]).*[b-df-hj-np-tv-xz]{4}"

#: Random strings of a window's length come to about 3.3 bits (hex), 3.8 (one case) and 4.1 (base64); words stay below.
CLASSES = (
    CharClass("hex", r"[0-9A-Fa-f]", 24, 3.0, "da"),
    CharClass("base64", r"[A-Za-z0-9+/=]", 20, 3.75, "dul"),
    CharClass("urlsafe", r"[A-Za-z0-9_-]", 20, 3.75, "dul"),
    CharClass("lower", r"[a-z0-9]", 20, 3.4, "dl", SPREAD),
    CharClass("upper", r"[A-Z0-9]", 20, 3.4, "du", SPREAD),
)

#: Words in one case, capitalised or joined as in camelCase, each of two letters or more; keys of mixed case are none.
NAME = "(?:[A-Z]?[a-z]{2,}+|[A-Z]{2,}+)++"
#: A span that one of these matches as a whole is harmless: UUIDs, dates and times, counted file names, the alphabet.
ALLOWED = (
    r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}",
    r"[0-9T:Z+_-]+",
    rf"({NAME}[-_/])*{NAME}[-_/]?[0-9]{{1,4}}",
)
#: A word of letters and digits that holds one of these is harmless up to a length of two windows; a longer one only
#: where a window holds it whole.
PLACEHOLDER = re.compile(r"abcdefghij|0123456789|example|sample|placeholder", re.IGNORECASE)
WORD, LONGEST_PLACEHOLDER = re.compile(r"[A-Za-z0-9]+"), 40


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the three fixed patterns, leftmost and not overlapping within a kind."""
    found = []
    lowered = text.lower()
    if any(k in lowered for k in KEYWORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    if LONG_HEX.search(text):
        found += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= 16]
    return sorted(found)


def kind_of(char: str) -> str:
    return "d" if char.isdigit() else "u" if char.isupper() else "l" if char.islower() else "o"


def windows(run: str, size: int) -> Iterator[tuple[int, float, dict[str, int]]]:
    """(start, entropy in bits, characters by kind) of every window, by incremental counts."""
    term = [0.0] + [n * math.log2(n) for n in range(1, size + 1)]
    count: dict[str, int] = {}
    kinds = {"d": 0, "u": 0, "l": 0, "o": 0}
    total = 0.0
    for i, char in enumerate(run):
        n = count.get(char, 0)
        total += term[n + 1] - term[n]
        count[char] = n + 1
        kinds[kind_of(char)] += 1
        if i >= size:
            gone = run[i - size]
            n = count[gone]
            total += term[n - 1] - term[n]
            count[gone] = n - 1
            kinds[kind_of(gone)] -= 1
        if i >= size - 1:
            yield i - size + 1, math.log2(size) - total / size, kinds


def enough(kinds: dict[str, int], needs: str) -> bool:
    """``a`` stands for a letter of either case."""
    return all(kinds["u"] + kinds["l"] if need == "a" else kinds[need] for need in needs)


def placeholders(candidate: str, at: int) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """(words that no window may touch, placeholders that no window may hold) of a candidate that begins at ``at``."""
    harmless, excused = [], []
    if PLACEHOLDER.search(candidate):
        for word in WORD.finditer(candidate):
            held = [(at + word.start() + m.start(), at + word.start() + m.end()) for m in PLACEHOLDER.finditer(word[0])]
            if held and len(word[0]) <= LONGEST_PLACEHOLDER:
                harmless.append((at + word.start(), at + word.end()))
            else:
                excused += held
    return harmless, excused


def entropy_spans(text: str, classes: tuple[CharClass, ...] = CLASSES, allowed: tuple[str, ...] = ALLOWED) -> list[tuple[int, int]]:
    """Joined spans of windows over the limit of their class, without allowed and placeholders' ones."""
    found = []
    for candidate in CANDIDATE.finditer(text):
        if not DIGIT.search(candidate[0]):
            continue
        harmless, excused = placeholders(candidate[0], candidate.start())
        # Either list ascends and does not overlap itself, so a window asks one entry of each.
        word_starts, word_ends = [x for x, _ in harmless], [y for _, y in harmless]
        held_starts, held_ends = [x for x, _ in excused], [y for _, y in excused]
        for c in classes:
            for run in re.finditer(c.chars + "{%d,}" % c.size, candidate[0]):
                first = candidate.start() + run.start()
                for start, bits, kinds in windows(run[0], c.size):
                    if bits >= c.bits and enough(kinds, c.needs):
                        a, b = first + start, first + start + c.size
                        k, j = bisect_right(word_ends, a), bisect_left(held_starts, a)
                        if k < len(harmless) and word_starts[k] < b or j < len(excused) and held_ends[j] <= b:
                            continue
                        if not c.shape:
                            found.append((a, b))
                        elif re.search(c.shape, run[0][start : start + c.size]):
                            found.append((first, first + len(run[0])))
                            break
    joined: list[list[int]] = []
    for start, end in sorted(found):
        if joined and start <= joined[-1][1]:
            joined[-1][1] = max(joined[-1][1], end)
        else:
            joined.append([start, end])
    return [(a, b) for a, b in joined if not any(re.fullmatch(p, text[a:b]) for p in allowed)]


def scan(text: str, classes=CLASSES, allowed=ALLOWED) -> tuple[list, list]:
    """(base spans, all spans) as sorted (start, kind, end)."""
    base = base_spans(text)
    # Base spans may overlap each other, so the free ones are cut by their union.
    busy: list[list[int]] = []
    for start, _, end in base:
        if busy and start <= busy[-1][1]:
            busy[-1][1] = max(busy[-1][1], end)
        else:
            busy.append([start, end])
    more, k = [], 0
    for start, end in entropy_spans(text, classes, allowed):
        while k < len(busy) and busy[k][1] <= start:
            k += 1
        # What lies between the base spans that the span meets, before and after them.
        at, j = start, k
        while j < len(busy) and busy[j][0] < end:
            if busy[j][0] > at:
                more.append((at, 3, busy[j][0]))
            at, j = max(at, busy[j][1]), j + 1
        if at < end:
            more.append((at, 3, end))
    return base, sorted(base + more)


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    classes: tuple[CharClass, ...] = CLASSES, allowed: tuple[str, ...] = ALLOWED,
) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans for every row.

    ``spans`` lists kind:start:end (code points, end exclusive) by start, then
    kind. A null or empty text has none. Repeated rows are scanned alike, a null
    doc_id stays null, an empty table gives an empty result.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                base, spans = scan(text, classes, allowed)
                kinds = [kind for _, kind, _ in base]
                digest = hashlib.sha256(listed(base).encode()).hexdigest()
                out.append((doc_id, kinds.count(0), kinds.count(1), kinds.count(2), digest, listed(spans)))
            yield pd.DataFrame(out, columns=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    lean, restored = texts(docs, id_col, text_col)
    return restored(
        lean.mapInPandas(
            run, "doc_id string, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
        )
    )


def masked(text: str, mask: str, classes=CLASSES, allowed=ALLOWED) -> str:
    """``text`` with every span replaced; overlapping spans are one."""
    out, at = [], 0
    for start, _, end in scan(text, classes, allowed)[1]:
        if start >= at:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join([*out, text[at:]]) if at else text


def mask_secrets(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars", mask: str = "[secret]") -> DataFrame:
    """``docs`` with secrets masked in ``text_col``; where a text changes, ``length_col`` is counted anew.

    No row is dropped; other columns, and null texts, stay as they are.
    """

    def run(texts_: pd.Series) -> pd.Series:
        return texts_.map(lambda t: None if t is None else masked(t, mask))

    rows = docs.select(whole(docs), F.pandas_udf(run, "string")(column(text_col)).alias("clean"))
    changes = {text_col: F.col("clean").cast(docs.schema[text_col].dataType)}
    if length_col in docs.columns:
        recounted = F.char_length("clean").cast(docs.schema[length_col].dataType)
        changes[length_col] = F.when(field(text_col).eqNullSafe(F.col("clean")), field(length_col)).otherwise(recounted)
    return rows.select(*[changes.get(c, field(c)).alias(c) for c in docs.columns])
