"""Secret scans: fixed patterns, and guess costs of the values in credential contexts.

``find`` looks in every whole text for the three fixed patterns (assignments,
access keys, long hexadecimal runs) and for credential contexts: a word such as
password, token or Kennwort, a sign of assignment, and a value; a bearer value;
the password of a URL.  A value is a secret if guessing it is dear.  Its cost is the least
sum of log10 guesses over all ways to cut it into

* words: the rank in the dictionary, times the ways to write capitals and
  digits for letters,
* dates: a year, or day, month and year in any usual order,
* repeats: the cost of the unit, times the number of its copies,
* keyboard walks (alphabet included): a first key and a choice at each turn,
* brute-force spans: ten guesses a character,

with a factor two for every further segment, by dynamic programming over the
places of the value.  A value of ``threshold`` or more that overlaps no span of
the fixed patterns is added as a span of kind ``guess``; those spans all stay.

The dictionary is the corpus itself: ``dictionary`` counts the words of all
documents (values in credential contexts left out, so that no secret makes
itself known) and keeps the ``size`` most frequent with their ranks, as word
lists of password meters do.  That bound is the size of what is sent to the tasks; a
rarer word costs what its letters cost.

Offsets are code points, ends exclusive; the span of a pattern is its whole
match, that of a guess the value.  Defined cases: null, empty and blank texts
have no spans; every row is judged for itself, so repeated rows and null ids
are kept; values of any length are judged whole in time linear in them; an empty
table gives an empty result; only the columns named are read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from . import words as W
from .store import written

#: fixed by the contract of the base patterns: kind, pattern, group and least characters of it
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "guess")
MIN_ASSIGN, MIN_ACCESS = 12, 18

#: words that announce a credential, in English, German, French and Spanish
_NAMES = (r"pass(?:word|wd|phrase|code)|passwort|kennwort|mot\x20de\x20passe|contrase(?:ñ|n)a|pwd|secret|token|credentials?"
          r"|(?:api|access|private|auth|client)[_-]?key")
_SIGN = r"""["'`]?\x20*(?::=|=>|[:=])\x20*"""
_VALUE = r"""["'`]?([^\s"'`<>,;]+)"""
CONTEXT = re.compile(f"(?:{_NAMES}){_SIGN}{_VALUE}|\\bbearer\\x20+([A-Za-z0-9+/_.=~-]+)|://[^\\s/:@]+:([^\\s/@]+)@", re.I | re.A)
#: what any of the patterns needs, for a first look at a text
_MAYBE = r"(?i)pass(?:w|phrase|code)|kennwort|mot de passe|contrase|pwd|secret|token|credential|(?:api|access|private|auth|client)[_-]?key|bearer|akia|://[^\s/:@]+:|[0-9a-f]{16}"

THRESHOLD = 8.0
DICTIONARY = 1 << 16
SHORTEST, LONGEST = 3, 24
MAX_UNIT = 16
_JOIN = math.log10(2)
_YEARS = 200

#: fixed values: keys of the US layout row by row, each row half a key to the right of the one above; shifted keys
KEYS = ("1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
SHIFTED = ("!@#$%^&*()_+", "QWERTYUIOP{}", 'ASDFGHJKL:"', "ZXCVBNM<>?")
_PLACE = {c: (x, y) for rows in (KEYS, SHIFTED) for y, row in enumerate(rows) for x, c in enumerate(row)}
_STEPS = {(1, 0), (-1, 0), (0, 1), (-1, 1), (0, -1), (1, -1)}
_SHIFT_KEYS = frozenset("".join(SHIFTED))
#: fixed values: digits and signs written for letters
LEET = str.maketrans("013457@$", "oieastas")

_D, _M, _Y = "(?:0[1-9]|[12][0-9]|3[01])", "(?:0[1-9]|1[0-2])", "(?:19|20)[0-9]{2}"
_SHORT_D, _SHORT_M = "(?:0?[1-9]|[12][0-9]|3[01])", "(?:0?[1-9]|1[0-2])"
_DAY = math.log10(365 * _YEARS)
_DATES = [(re.compile(p), cost) for p, cost in (
    (_Y, math.log10(_YEARS)),
    (f"{_D}{_M}{_Y}|{_M}{_D}{_Y}|{_Y}{_M}{_D}", _DAY),
    (f"{_D}{_M}[0-9]{{2}}|{_M}{_D}[0-9]{{2}}|[0-9]{{2}}{_M}{_D}", math.log10(365 * 100)),
    (f"{_SHORT_D}([-/._]){_SHORT_M}\\1{_Y}|{_SHORT_M}([-/._]){_SHORT_D}\\2{_Y}|{_Y}([-/._]){_SHORT_M}\\3{_SHORT_D}", _DAY + math.log10(4)),
)]

LETTERS = np.zeros(256, dtype=bool)
LETTERS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


class Dictionary:
    """Ranks (1 is the most frequent) of words by hash."""

    def __init__(self, hashes: np.ndarray):
        order = np.argsort(hashes)
        self.hashes, self.rank = hashes[order], order + 1

    def ranks(self, words: list[str]) -> list[int]:
        """Rank of each word (letters only), 0 if it is not known."""
        if not words or not len(self.hashes):
            return [0] * len(words)
        _, _, w = next(W.slices(pa.array([" ".join(words)]), LETTERS, True, 1 << 40))
        place = np.minimum(np.searchsorted(self.hashes, w.hash), len(self.hashes) - 1)
        return np.where(self.hashes[place] == w.hash, self.rank[place], 0).tolist()


def _capitals(word: str) -> float:
    upper = sum(c.isupper() for c in word)
    lower = sum(c.islower() for c in word)
    if not upper:
        return 0.0
    if not lower or upper == 1 and (word[0].isupper() or word[-1].isupper()):
        return math.log10(2)
    return math.log10(sum(math.comb(upper + lower, i) for i in range(1, min(upper, lower) + 1)))


def _letters(text: str) -> bool:
    return all("a" <= c.lower() <= "z" or c >= "\x80" for c in text)


def _word_segments(value: str, known: Dictionary) -> Iterator[tuple[int, int, float]]:
    plain = value.translate(LEET)
    for base in range(0, len(value), 4096):  # the substrings of a stretch of places at once
        found, texts = [], []
        for i in range(base, min(base + 4096, len(value))):
            for read, digits in ((value, False), (plain, True)):
                for j in range(i + SHORTEST, min(i + LONGEST, len(value)) + 1):
                    if not _letters(read[j - 1]) or j == i + SHORTEST and not _letters(read[i:j]):
                        break
                    if not digits or read[i:j] != value[i:j]:
                        found.append((i, j))
                        texts.append(read[i:j])
        for (i, j), text, rank in zip(found, texts, known.ranks(texts)):
            if rank:
                changed = sum(a != b for a, b in zip(text, value[i:j]))
                yield i, j, math.log10(rank) + _capitals(text) + changed * math.log10(2)


def _walk_segments(value: str) -> Iterator[tuple[int, int, float]]:
    def step(a: str, b: str) -> tuple | None:
        if a in _PLACE and b in _PLACE:
            d = _PLACE[b][0] - _PLACE[a][0], _PLACE[b][1] - _PLACE[a][1]
            if d in _STEPS:
                return d
        if a.isascii() and b.isascii() and a.isalpha() and b.isalpha() and abs(ord(b) - ord(a)) == 1:
            return ("abc", ord(b) - ord(a))
        return None

    steps = [step(a, b) for a, b in zip(value, value[1:])]
    end = 0
    for i in range(len(value)):
        if end <= i:
            end = i + 1
            while end < len(value) and steps[end - 1] is not None:
                end += 1
            turns_to = [0]  # turns before each step of this walk
            for k in range(i + 1, end - 1):
                turns_to.append(turns_to[-1] + (steps[k] != steps[k - 1]))
            shifts_to = [0]
            for k in range(i, end):
                shifts_to.append(shifts_to[-1] + (value[k] in _SHIFT_KEYS))
            first = i
        length = end - i
        if length >= 3:
            turns = turns_to[end - 2 - first] - turns_to[i - first]
            shifts = shifts_to[end - first] - shifts_to[i - first]
            yield i, end, (math.log10(len(_PLACE)) + math.log10(length) + turns * math.log10(len(_STEPS) * length)
                           + min(shifts, length - shifts) * math.log10(2))


def _repeat_segments(value: str, known: Dictionary) -> Iterator[tuple[int, int, float]]:
    for unit in range(1, min(MAX_UNIT, len(value) // 2) + 1):
        end = 0
        for i in range(len(value) - 2 * unit + 1):
            if end < i + unit:  # value[i:end] has this period as far as it goes
                end = i + unit
                while end < len(value) and value[end] == value[end - unit]:
                    end += 1
            copies = (end - i) // unit
            if copies >= 2 and copies * unit >= 3:
                yield i, i + copies * unit, guesses(value[i:i + unit], known) + math.log10(copies)


def segments(value: str, known: Dictionary) -> list[tuple[int, int, float]]:
    """``(from, to, log10 guesses)`` of the words, dates, repeats and keyboard walks of a value.

    Walks and repeats go as far as they can from where they begin.
    """
    out = [*_word_segments(value, known), *_walk_segments(value), *_repeat_segments(value, known)]
    for pattern, cost in _DATES:
        out += [(m.start(), m.end(), cost) for i in range(len(value)) if (m := pattern.match(value, i))]
    return out


@lru_cache(maxsize=1 << 14)
def guesses(value: str, known: Dictionary) -> float:
    """Least log10 guesses over all segmentations of ``value``."""
    ends: dict[int, list[tuple[int, float]]] = {}
    for i, j, cost in segments(value, known):
        ends.setdefault(j, []).append((i, cost))
    best, brute = [-_JOIN], math.inf  # the first segment joins nothing
    for j in range(1, len(value) + 1):
        brute = 1.0 + min(brute, best[j - 1] + _JOIN)
        best.append(min([brute, *(best[i] + _JOIN + cost for i, cost in ends.get(j, ()))]))
    return best[-1] if value else 0.0


def _value(m: re.Match) -> tuple[int, int]:
    """Place of a context's value, without the marks that end a sentence or close a bracket."""
    group = m.lastindex
    start, end = m.span(group)
    if group == 1:
        end = start + len(m.group(1).rstrip(".:!?)]}"))
    return start, end


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, place of the kind, end)`` of the fixed patterns, in order."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= MIN_ASSIGN]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m.group()) >= MIN_ACCESS]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def spans(text: str, known: Dictionary, threshold: float = THRESHOLD) -> list[tuple[int, int, int, float | None]]:
    """``(start, place of the kind, end, log10 guesses)`` of all spans, in order; only values have guesses."""
    base = base_spans(text)
    out: list[tuple[int, int, int, float | None]] = []
    cost: dict[tuple[int, int], float] = {}
    b = 0
    for m in CONTEXT.finditer(text):
        start, end = _value(m)
        if start >= end or "://" in text[start:end]:
            continue
        g = guesses(text[start:end], known)
        while b < len(base) and max(e for _, _, e in base[b:b + 1]) <= start:
            b += 1
        over = [s for s in base[b:b + 3] if s[0] < end and s[2] > start]
        for s in over:
            cost[s[0], s[1]] = g
        if not over and g >= threshold:
            out.append((start, 3, end, g))
    return sorted([*out, *((s, k, e, cost.get((s, k))) for s, k, e in base)], key=lambda s: s[:3])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``(word, n)``: the words of texts outside credential values."""
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def merged() -> tuple[np.ndarray, np.ndarray]:
        hashes, at = np.unique(np.concatenate([h for h, _ in held]), return_inverse=True)
        return hashes, np.bincount(at, np.concatenate([n for _, n in held])).astype(np.int64)

    def batch(h: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], names=["word", "n"])

    for rows in batches:
        texts = rows.column(0)
        which = pc.fill_null(pc.match_substring_regex(texts, _MAYBE), False)
        if pc.any(which).as_py():
            hidden = [CONTEXT.sub(lambda m: m.group()[:_value(m)[0] - m.start()], t) for t in texts.filter(which).to_pylist()]
            texts = pc.replace_with_mask(texts, which, pa.array(hidden, pa.string()))
        for _, _, w in W.slices(texts, LETTERS, True):
            size = w.end - w.start
            found = np.unique(w.hash[(size >= SHORTEST) & (size <= LONGEST)], return_counts=True)
            held.append(found)
            if sum(len(h) for h, _ in held) > 1 << 20:
                held = [merged()]
                if len(held[0][0]) > 1 << 19:
                    yield batch(*held.pop())
    if held:
        yield batch(*merged())


def dictionary(docs: DataFrame, text: str = "text", size: int = DICTIONARY) -> Dictionary:
    """The ``size`` most frequent words of all texts (ties by hash)."""
    counts = docs.select(F.col(f"`{text}`").alias("t")).mapInArrow(_counted, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    top = counts.orderBy(F.desc("n"), "word").limit(size).toArrow()  # at most ``size`` rows
    return Dictionary(top["word"].to_numpy().view(np.uint64))


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("guesses", pa.float64())])


def find(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text", threshold: float = THRESHOLD,
         size: int = DICTIONARY) -> DataFrame:
    """``keep`` columns and the array ``spans`` of (kind, start, end, log10 guesses of a context's value) of every row."""
    names = [f"k{i}" for i in range(len(keep))]
    source = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names)], F.col(f"`{text}`").alias("t"))
    span_type = StructType([StructField("kind", StringType()), StructField("start", LongType()), StructField("end", LongType()),
                            StructField("guesses", DoubleType())])
    schema = StructType([*(source.schema[n] for n in names), StructField("spans", ArrayType(span_type))])
    sent = docs.sparkSession.sparkContext.broadcast(dictionary(docs, text, size))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            texts = batch.column(len(names))
            which = pc.fill_null(pc.match_substring_regex(texts, _MAYBE), False).to_numpy(zero_copy_only=False)
            found: list[list] = [[]] * batch.num_rows
            for r in np.flatnonzero(which).tolist():
                found[r] = [{"kind": KINDS[k], "start": s, "end": e, "guesses": g} for s, k, e, g in spans(texts[r].as_py(), known, threshold)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.list_(_SPAN))], names=[*names, "spans"])

    return source.mapInArrow(run, schema).withColumnsRenamed(dict(zip(names, keep)))
