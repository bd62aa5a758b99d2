"""Secrets in texts: three patterns, and values in a credential's context that are hard to guess.

The guess cost of a value is the least sum, over its segmentations, of the
log10 guesses of each part: a word by its rank in a public vocabulary, a date,
a repeated block, a walk along a keyboard row or the alphabet, or brute force
character by character. A value of at least GUESS_COST is taken for a secret; a
password made of common words, dates and runs is not.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import math
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

VOCABULARY = "/opt/tokenizers/word_bpe_49k.json"
#: log10 of the guesses from which a value is a secret, and the least length of one.
GUESS_COST, LEAST_VALUE = 10.0, 8
#: Longest word, walk or block that a part can be, and what each part costs beside its guesses.
LONGEST, PART = 24, 0.3

# Fixed patterns of the base scan.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_ASSIGN, LEAST_ACCESS = 6, 20

_ASSIGN_HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_CONTEXT_HINTS = (
    "pass", "pwd", "secret", "token", "key", "credential", "auth", "bearer", "api", "access", "private", "client", "signing", "encryption"
)
#: A name may stand after an underscore or begin in camel case; blanks around the separator are free.
CONTEXT = re.compile(
    r"""(?:(?<![A-Za-z0-9])|(?-i:(?<=[a-z0-9])(?=[A-Z])))"""
    r"""(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|credentials?|auth(?:orization)?|bearer|"""
    r"""(?:(?:api|access|private|secret|client|signing|encryption)[_\x20-]?){1,3}(?:key|token|secret|id)(?:[_\x20-]?id)?)"""
    r"""["']?[\x20\t]*(?::=|=>|->|[:=]|\bis\b)[\x20\t]*["'`]?(?:(?:bearer|basic|token)[\x20\t]+)?([^\s"'`<>,;]{8,})""",
    re.ASCII | re.IGNORECASE,
)

KINDS = ("assign", "access", "hex", "guess")
_ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm", "abcdefghijklmnopqrstuvwxyz")
_STEP = np.zeros((129, 129), bool)
for _row in _ROWS:
    for _line in (_row, _row[::-1]):
        for _a, _b in zip(_line, _line[1:]):
            _STEP[ord(_a), ord(_b)] = True
_YEAR, _MONTH, _DAY = r"(?:19|20)\d\d", r"(?:0?[1-9]|1[0-2])", r"(?:0?[1-9]|[12]\d|3[01])"
_DATES = tuple(
    (re.compile(pattern), math.log10(guesses))
    for pattern, guesses in (
        (rf"{_YEAR}", 200),
        (rf"{_YEAR}([-/.]?){_MONTH}\1{_DAY}", 200 * 365),
        (rf"{_DAY}([-/.]?){_MONTH}\1{_YEAR}", 200 * 365),
        (rf"{_MONTH}([-/.]?){_DAY}\1{_YEAR}", 200 * 365),
    )
)


def word_ranks(path: str = VOCABULARY) -> dict[str, int]:
    """Ranks of the whole words of three letters and more in a public BPE vocabulary."""
    with open(path, encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    words = sorted((rank, token.removesuffix("</w>")) for token, rank in vocabulary.items() if token.endswith("</w>"))
    return {word: n for n, (_, word) in enumerate(words, 1) if len(word) >= 3 and word.isalpha()}


def _brute(char: str) -> float:
    if char.isdigit():
        return 1.0
    if "a" <= char <= "z" or "A" <= char <= "Z":
        return math.log10(26)
    return math.log10(33 if char < "\x80" else 1000)


def _in_a_row(holds: np.ndarray) -> np.ndarray:
    """For each place, how many from there on hold."""
    places = np.arange(len(holds))
    return np.minimum.accumulate(np.where(holds, len(holds), places)[::-1])[::-1] - places


class _Parts:
    """Words, dates, repeats and walks that begin at a place of a value.

    How far blocks repeat and walks go on is worked out once for all places, so a
    value of any length and kind takes time in proportion to its length.
    """

    def __init__(self, value: str, ranks: dict[str, int]):
        self.value, self.ranks = value, ranks
        # a character for a character, also where lower case takes two
        self.lower = "".join(low if len(low := c.lower()) == 1 else c for c in value)
        codes = np.frombuffer(value.encode("utf-32-le", "surrogatepass"), "<u4")
        low = np.minimum(np.frombuffer(self.lower.encode("utf-32-le", "surrogatepass"), "<u4"), 128)
        self.agree = [_in_a_row(codes[:-k] == codes[k:]) for k in range(1, min(LONGEST, len(value) - 1) + 1)]
        self.walk = _in_a_row(_STEP[low[:-1], low[1:]])

    def at(self, start: int) -> Iterator[tuple[int, float]]:
        """(end, cost)"""
        value, lower, n = self.value, self.lower, len(self.value)
        for end in range(start + 3, min(n, start + LONGEST) + 1):
            if (rank := self.ranks.get(lower[start:end])) is not None:
                yield end, math.log10(rank + 1) + (0.3 if value[start:end] != lower[start:end] else 0.0)
        for pattern, cost in _DATES:
            if match := pattern.match(value, start):
                yield match.end(), cost
        length = 1 + (int(self.walk[start]) if start < n - 1 else 0)
        if length >= 3:
            yield start + length, math.log10(80) + math.log10(length)
        for block, agree in enumerate(self.agree, 1):
            times = 1 + (int(agree[start]) // block if start < len(agree) else 0)
            if times > 1 and times * block > 2:
                yield start + times * block, sum(map(_brute, value[start : start + block])) + math.log10(times)


def guess_cost(value: str, ranks: dict[str, int], limit: float = math.inf) -> float:
    """log10 of the guesses that a value takes by its cheapest segmentation; 0 for an empty one.

    Beyond ``limit`` the limit stands for the cost: places that no cheaper
    segmentation reaches are left out, which spares most of a long value.
    """
    if not value:
        return 0.0
    parts, best = _Parts(value, ranks), {0: 0.0}
    ahead = [0]
    while ahead:
        start = heapq.heappop(ahead)
        cost = best[start]
        if start == len(value):
            return min(cost, limit)
        steps = chain(((end, more + PART) for end, more in parts.at(start)), [(start + 1, _brute(value[start]))])
        for end, more in steps:
            if cost + more < best.get(end, limit):
                if end not in best:
                    heapq.heappush(ahead, end)
                best[end] = cost + more
    return limit


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the patterns' matches, in code points."""
    found = []
    lower = text.lower()
    if any(hint in lower for hint in _ASSIGN_HINTS):
        found += [(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    found += [(*m.span(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    found += [(*m.span(), "hex") for m in HEX.finditer(text)]
    return found


def guessed_spans(text: str, ranks: dict[str, int], known: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """(start, end, "guess") of values in a credential's context that cost enough and are in no known span as a whole."""
    lower = text.lower()
    if not any(hint in lower for hint in _CONTEXT_HINTS):
        return []
    found = []
    for match in CONTEXT.finditer(text):
        start, end = match.span(1)
        value = match[1].rstrip(".:!?)]}")
        end = start + len(value)
        if len(value) < LEAST_VALUE or any(a <= start and end <= b for a, b, _ in known):
            continue
        if guess_cost(value, ranks, GUESS_COST) >= GUESS_COST:
            found.append((start, end, "guess"))
    return found


def _ordered(spans: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def _shown(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in _ordered(spans))


def all_spans(text: str | None, ranks: dict[str, int]) -> tuple[list, list]:
    """The patterns' spans and the guessed ones."""
    base = base_spans(text or "")
    return base, guessed_spans(text or "", ranks, base)


def masked(text: str | None, ranks: dict[str, int], mark: str = "<secret>") -> str | None:
    """A text with every secret, overlapping ones as one, replaced by a mark; null stays null."""
    if text is None:
        return None
    base, guessed = all_spans(text, ranks)
    out, at = [], 0
    for start, end, _ in _ordered(base + guessed):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def secret_scan(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """Secrets of every row of `docs` (doc_id, text).

    n_assign, n_access, n_hex and n_guess count the spans of each kind; base_sha256
    is the digest of the patterns' spans and `spans` shows all, as
    kind:start:end in code points, by start. A null text is empty. Repeated
    rows are returned each, other columns are ignored.
    """
    ranks = docs.sparkSession.sparkContext.broadcast(word_ranks(path))  # a fixed vocabulary

    @F.pandas_udf("n_assign long, n_access long, n_hex long, n_guess long, base_sha256 string, spans string")
    def scan(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            base, guessed = all_spans(text, ranks.value)
            kinds = [kind for _, _, kind in base]
            digest = hashlib.sha256(_shown(base).encode()).hexdigest()
            rows.append((*(kinds.count(k) for k in KINDS[:3]), len(guessed), digest, _shown(base + guessed)))
        return pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "n_guess", "base_sha256", "spans"])

    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), scan("text").alias("found"))
    return found.select("doc_id", "found.*")


def without_secrets(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """`docs`, with its columns, every secret in its texts masked; n_chars, if there, follows."""
    ranks = docs.sparkSession.sparkContext.broadcast(word_ranks(path))

    @F.pandas_udf("string")
    def mask(texts: pd.Series) -> pd.Series:
        return pd.Series([masked(t, ranks.value) for t in texts], dtype=object)

    changed = docs.withColumn("text", mask("text"))
    return changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else changed
