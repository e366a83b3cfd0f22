"""Secret scans: fixed patterns, and password guess cost for values in a credential context.

Fixed patterns (``assign``, ``access``, ``hex``) are found leftmost and without overlap in each kind. A fourth
kind, ``guess``, is a value after a credential word (``password =``, ``pwd:``, ``passphrase is``, ``Bearer`` ...), whether or not a fixed pattern
covers it, that is expensive to guess: a dynamic programme finds the cheapest segmentation of the value into
dictionary words, dates, repeats, keyboard walks, sequences and brute-force spans, each with its log10 number of
guesses, and the value is a secret from ``min_cost`` upwards; the cost alone decides.

The dictionary comes from the documents themselves: words of ``WORD_LETTERS`` letters or more by the number of documents that have them outside
credential values, of which those in ``LEAST_DOCUMENTS`` and ``WORD_SHARE`` of all documents get a rank. A document can add to the share of
no more words than it has, so the dictionary has at most (mean number of different words a document) / ``WORD_SHARE`` entries whatever the
corpus; it is broadcast. The usual passwords have ranks of their own.

Defined results: null text is empty and has no spans; repeated rows are each scanned (and counted); a text is read whole
whatever its length, and so is a value (in time linear in it); words in equally many documents are ranked in alphabetical order; an empty table gives
an empty result; only doc_id and text are read, other columns are carried by :func:`redact` whatever their names; offsets are code
points, end exclusive.
"""

from __future__ import annotations

import functools
import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator, Mapping
from itertools import accumulate

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uelumen.llm.common import bound_batches, map_texts, slices, text_values, trimmed

KINDS = ("assign", "access", "hex", "guess")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a run of 24 or more; shorter runs fail
CONTEXT = re.compile(
    r"""(?:\b(?:pwd|pass|passphrase|passcode|pin|auth|credentials?|login|private[_\x20-]?key|access[_\x20-]?key|client[_\x20-]?secret|password|passwd|secret|token|api[_-]?key)"""
    r"""["']?\x20*(?:[:=]|\x20is\x20)\x20*|\bBearer\x20+|\bBasic\x20+)["']?([^\s"'<>,;]{6,})""",
    re.I | re.A,
)
CONTEXT_HINTS = ("pwd", "pass", "pin", "auth", "credential", "login", "key", "secret", "token", "bearer", "basic")
ASSIGN_HINTS = ("passw", "secret", "token", "api")

# fixed values: common password words by rank
WORDS = {w: i + 2 for i, w in enumerate("password admin letmein welcome monkey dragon master login qwerty iloveyou princess sunshine football baseball shadow superman test guest root user secret token key pass access changeme default example sample demo hello world love summer winter spring autumn company office system server database true false none null".split())}
# fixed values: keyboard rows
ROWS = ("qwertyuiop", "asdfghjkl", "zxcvbnm", "1234567890", "abcdefghijklmnopqrstuvwxyz", "1qaz2wsx3edc4rfv5tgb6yhn7ujm8ik9ol0p")
LEET = str.maketrans("013457@$!", "oieastasi")
DATE = re.compile(r"(?:19|20)\d\d[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:0[1-9]|[12]\d|3[01])|(?:0[1-9]|[12]\d|3[01])[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:19|20)\d\d|(?:19|20)\d\d")


WORD_LETTERS = 3
WORD_SHARE = 1e-4
LEAST_DOCUMENTS = 5
HELD_WORDS = 200_000
LETTERS = re.compile(rf"[^\W\d_]{{{WORD_LETTERS},}}")


def _values(text: str, lower: str) -> Iterator[tuple[int, int]]:
    """(start, end) of the values in a credential context."""
    if any(h in lower for h in CONTEXT_HINTS):
        for m in CONTEXT.finditer(text):
            value = m[1].rstrip(".!?)]}")
            if len(value) >= 6:
                yield m.start(1), m.start(1) + len(value)


def words_of(text: str) -> set[str]:
    """Different words of a text, those in credential values left out."""
    lower = text.lower()
    if len(lower) == len(text):  # else places differ; the values then are few letters among the words of the corpus
        rest, at = [], 0
        for start, end in _values(text, lower):
            rest.append(lower[at:start])
            at = end
        lower = " ".join([*rest, lower[at:]])
    return set(LETTERS.findall(" ".join(set(lower.split()))))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter[str] = Counter()

    def rows() -> pa.RecordBatch:
        out = pa.RecordBatch.from_pydict({"word": pa.array(list(held), pa.string()), "n": pa.array(list(held.values()), pa.int64())})
        held.clear()
        return out

    for batch in batches:
        for part in slices(batch):
            for text in text_values(part.column("text")):
                held.update(words_of(text))
            if len(held) > HELD_WORDS:
                yield rows()
    yield rows()


def word_ranks(docs: DataFrame) -> dict[str, int]:
    """The dictionary of a corpus: word -> rank, 1 for that in most documents."""
    bound_batches(docs.sparkSession)
    counted = docs.select("text").mapInArrow(trimmed(_count_words), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    least = max(LEAST_DOCUMENTS, math.ceil(WORD_SHARE * docs.count()))
    rows = counted.filter(F.col("n") >= least).toArrow()
    order = sorted(zip(rows["n"].to_pylist(), rows["word"].to_pylist()), key=lambda r: (-r[0], r[1]))
    return {word: rank for rank, (_, word) in enumerate(order, 1)}


def _rate(ch: str) -> float:
    """log10 guesses of one character by brute force."""
    return 1.0 if ch.isdigit() else math.log10(26) if ch.isascii() and ch.isalpha() else math.log10(33)


def _lower(value: str) -> list[str]:
    """Lower case, character by character."""
    return [c if len(low := c.lower()) > 1 else low for c in value]


def _segments(value: str, words: Dictionary) -> list[list[tuple[int, float]]]:
    """For each end position, the (start, cost) of each word, date and keyboard segment that ends there. Words are found by one walk of an automaton, whatever their length."""
    n, letters = len(value), _lower(value)
    lower = "".join(letters)
    plain = lower.translate(LEET)
    out: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
    capital = [0, *accumulate(c != c.lower() for c in value)]  # how many before a place
    changed = [0, *accumulate(c != p for c, p in zip(lower, plain))]
    for spelling in {lower, plain}:
        for last, (size, cost) in words.automaton.iter(spelling):
            start, end = last + 1 - size, last + 1
            disguised = spelling != lower and changed[end] > changed[start]
            out[end].append((start, cost + 0.3 * (capital[end] > capital[start]) + 0.3 * disguised))
    for i in range(n):
        if m := DATE.match(value, i):
            out[m.end()].append((i, 2.0 if m.end() - i == 4 else 4.5))
        for row in ROWS:
            for line in (row, row[::-1]):
                at = line.find(lower[i : i + 3]) if i + 3 <= n else -1
                if at >= 0:
                    size = 3
                    while i + size < n and at + size < len(line) and lower[i + size] == line[at + size]:
                        size += 1
                    for k in range(3, size + 1):
                        out[i + k].append((i, math.log10(len(line) * 4 * k)))
    return out


class _Repeats:
    """Cheapest segment of a repeated unit of ``period`` characters, end by end.

    A segment costs its unit and log10 of its length. A start is dropped once another is cheaper at this end and at every later
    one, which leaves few in a run of any length.
    """

    def __init__(self, period: int):
        self.period, self.least = period, max(3, 2 * period)
        self.same = 0  # characters up to here that equal the one a period before
        self.starts: list[tuple[float, int]] = []  # cost without the length, start

    def cost(self, end: int, lower: list[str], rates: list[float], best: list[float]) -> float:
        """Least cost of the value up to ``end`` with a repeat as its last segment."""
        period = self.period
        if end <= period or lower[end - 1] != lower[end - 1 - period]:
            self.same = 0
            self.starts.clear()
            return math.inf
        self.same += 1
        if self.same >= self.least - period:
            start = end - self.least
            base = best[start] + sum(rates[start : start + period]) + 0.3
            while self.starts and self.starts[-1][0] >= base:  # later and no dearer: cheaper at every end
                self.starts.pop()
            self.starts.append((base, start))
        low, kept = math.inf, []
        for base, start in self.starts:
            if (own := base + math.log10(end - start)) < low:  # an earlier start that is cheaper here stays so
                low = own
                kept.append((base, start))
        self.starts = kept
        return low


class Dictionary:
    """Ranked words beside the usual passwords."""

    def __init__(self, ranks: Mapping[str, int]):
        self.ranks = ranks

    @functools.cached_property
    def automaton(self) -> ahocorasick.Automaton:
        """Finds every word of either list that a text holds: (its length, log10 of its lower rank)."""
        made = ahocorasick.Automaton()
        for word in self.ranks.keys() | WORDS.keys():
            ranks = [r for r in (WORDS.get(word), self.ranks.get(word)) if r]
            if len(word) >= WORD_LETTERS and ranks:
                made.add_word(word, (len(word), math.log10(min(ranks))))
        made.make_automaton()
        return made

    def __getstate__(self) -> dict:
        return {"ranks": self.ranks}  # each worker builds its own


NO_WORDS = Dictionary({})


def guess_cost(value: str, words: Dictionary = NO_WORDS) -> float:
    """log10 guesses of the cheapest segmentation; each further segment costs a little too."""
    segments = _segments(value, words)
    lower, rates = _lower(value), list(map(_rate, value))
    repeats = [_Repeats(period) for period in (1, 2, 3, 4)]
    best = [0.0] + [math.inf] * len(value)
    for end in range(1, len(value) + 1):
        best[end] = min(best[end - 1] + rates[end - 1], *[r.cost(end, lower, rates, best) for r in repeats])  # or brute force
        for start, cost in segments[end]:
            best[end] = min(best[end], best[start] + cost + 0.3)
    return best[-1]


def base_spans(text: str, lower: str | None = None) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, by start and kind."""
    lower = text.lower() if lower is None else lower
    spans = []
    if any(h in lower for h in ASSIGN_HINTS):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def all_spans(text: str, min_cost: float = 10.0, words: Dictionary = NO_WORDS) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """The spans of the fixed patterns, and these with the values that are expensive to guess."""
    lower = text.lower()
    base = base_spans(text, lower)
    more = [(start, 3, end) for start, end in _values(text, lower) if guess_cost(text[start:end], words) >= min_cost]
    return base, sorted(base + more)


def spell(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def _ship(docs: DataFrame, ranks: Mapping[str, int] | None):
    return docs.sparkSession.sparkContext.broadcast(Dictionary(word_ranks(docs) if ranks is None else ranks))


def scan(docs: DataFrame, *, min_cost: float = 10.0, ranks: Mapping[str, int] | None = None) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_guess, base_sha256, spans of each row; ``ranks``: a dictionary other than that of ``docs``."""
    words = _ship(docs, ranks)

    def kernel(batch: pa.RecordBatch) -> dict:
        counts, digests, spelt = [], [], []
        for text in text_values(batch.column("text")):
            base, every = all_spans(text, min_cost, words.value)
            counts.append([sum(k == kind for _, k, _ in every) for kind in range(len(KINDS))])
            digests.append(hashlib.sha256(spell(base).encode()).hexdigest())
            spelt.append(spell(every))
        out = {"doc_id": batch.column("doc_id")}
        out |= {f"n_{k}": pa.array([c[i] for c in counts], pa.int64()) for i, k in enumerate(KINDS)}
        return out | {"base_sha256": pa.array(digests, pa.string()), "spans": pa.array(spelt, pa.string())}

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_texts(docs.select("doc_id", "text"), kernel, f"doc_id {kind}, n_assign long, n_access long, n_hex long, n_guess long, base_sha256 string, spans string")


def mask(text: str, min_cost: float = 10.0, words: Dictionary = NO_WORDS) -> str:
    """The text with each run of overlapping spans replaced by ``[SECRET]``."""
    out, at = [], 0
    for start, _, end in all_spans(text, min_cost, words)[1]:
        if start >= at:
            out += [text[at:start], "[SECRET]"]
        at = max(at, end)
    return "".join(out) + text[at:] if out else text


def redact(docs: DataFrame, *, min_cost: float = 10.0, ranks: Mapping[str, int] | None = None) -> DataFrame:
    """The documents with their secrets masked, in the columns of ``docs``; ``n_chars`` follows the text."""
    columns, words = docs.columns, _ship(docs, ranks)

    def kernel(batch: pa.RecordBatch) -> dict:
        out = {n: batch.column(n) for n in columns}
        old = batch.column("text").to_pylist()
        new = [t if t is None else mask(t, min_cost, words.value) for t in old]
        out["text"] = pa.array(new, pa.string())
        if "n_chars" in columns:
            sizes = [n if a == b else len(b) for n, a, b in zip(batch.column("n_chars").to_pylist(), old, new)]
            out["n_chars"] = pa.array(sizes, batch.column("n_chars").type)
        return out

    return map_texts(docs, kernel, docs.schema)
