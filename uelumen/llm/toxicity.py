"""Toxicity by class-conditional Kneser-Ney models.

Two models, of toxic and of ordinary text, predict each byte of a word, and its end, from the up to ``DEPTH`` bytes before it in the word
(its start counts as one). A run of a script without spaces (Chinese, Japanese, Thai and their like) is read as the pairs of
neighbouring characters in it. With c(h b) the documents of a class whose words have byte b after context h, D(1) = 1, D(2) = 2 and D = 3
beyond (``DISCOUNT``; a sequence in so few documents tells nothing yet),

    P(b | h) = (c(h b) - D) / c(h) + freed(h) / c(h) * S(b | last bytes of h),    freed(h) = sum of D over the bytes after h,

where S is the Kneser-Ney distribution of shorter contexts (``ORDERS`` bytes), the same for both classes: it counts in how many different
longer contexts a sequence occurs in either class, discounts that by 0.75 and backs off to the next shorter context, at last to one in 256. A rare
expression thus gets nearly the same probability from both models, an inflected form the evidence of its stem, and only what one
class says more often moves the log-likelihood ratio. Sequences whose counts are all discounted away need no row of
their own: their ratio is that of the freed shares, so the table that the workers get holds the other sequences (more than
``DISCOUNT`` documents of a class) and their contexts; it grows with the input, more slowly than the text.

Over a whole text the common words move the ratio with its language and topic rather than its tone: on sf0.1 the plain mean of the word
ratios finds 11 of 120 held-out toxic documents. So a word's ratio counts from ``MARGIN`` upwards, a smaller
difference as none. The mean over the words of a text, its length-normalised value, becomes a score by a logistic curve (over its logarithm) fitted on
labelled rows that the counts have not seen.

Counting, summing and smoothing are grouped DataFrame aggregates and joins; a group (the bytes after one context) has at most 256 rows.

Folds: crc32(doc_id as text) mod 4: 0 and 1 count, 3 calibrates, 2 is held out and its labels are never read.

Defined results: null text is empty and scores at the curve's value for ratio 0; rows with a null doc_id are scored and are in
no fold; several labels of a document count as toxic if one is; null labels are ignored; repeated rows are each scored (and counted, if labelled);
without labels of both classes every score is 0; texts are whole; only doc_id and text are read, whatever other columns there are; an empty table
gives an empty result. Expressions of several words are seen word by word.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from uelumen.llm.common import map_texts, slices, stage_table, text_bytes
from uelumen.llm.lookup import Lookup

DEPTH = 8
ORDERS = (5, 3, 2, 1, 0)
DISCOUNT = 3
LOWER_DISCOUNT = 0.75
MARGIN = 2.0
BROADCAST_LABELS = 2_000_000
HELD_WORDS = 150_000
BLOCK = 20_000
BINS = 100
START, STOP = b"\x02", b"\x03"
#: Signs become spaces, letters lower case.
FOLD = bytes(32 if chr(b) in "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~" else b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Runs of characters of scripts without spaces: Thai, Lao, Myanmar, Khmer, kana, Han.
SOLID = re.compile(rb"(?s:\xe0[\xb8-\xbb].|\xe1[\x80-\x82\x9e\x9f].|\xe3[\x81-\x83\x90-\xbf].|[\xe4-\xe9]..|\xef[\xa4-\xab].|\xf0[\xa0-\xb3]..)+")


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def _pairs(run: re.Match) -> bytes:
    chars = run[0].decode("utf-8", "replace")
    return b" " + " ".join(chars[i : i + 2] for i in range(len(chars))).encode() + b" "


def words_of(text: bytes) -> list[bytes]:
    folded = text.translate(FOLD)
    return (folded if folded.isascii() else SOLID.sub(_pairs, folded)).split()


def sequences(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each byte of each word and for its end: the context (up to ``DEPTH`` bytes before it, as a number), the byte, the word's index."""
    raw = np.frombuffer(START + (STOP + START).join(words) + STOP, np.uint8)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    place = np.arange(len(raw)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    context = np.zeros(len(raw), np.uint64)
    for k in range(1, DEPTH + 1):
        at = np.flatnonzero(place >= k)
        context[at] |= raw[at - k].astype(np.uint64) << np.uint64(8 * (k - 1))
    inner = place > 0
    return context[inner].view(np.int64), raw[inner], np.repeat(np.arange(len(words)), sizes)[inner]


def _key(context: np.ndarray, byte: np.ndarray) -> np.ndarray:
    mixed = (context.view(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93) + byte


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (context, byte, documents of either class), summed over what a task holds at a time."""
    held: tuple[Counter, Counter] = Counter(), Counter()

    def rows() -> Iterator[pa.RecordBatch]:
        words = list(held[0] | held[1])
        for i in range(0, len(words), BLOCK):
            part = words[i : i + BLOCK]
            context, byte, own = sequences(part)
            order = np.lexsort((byte, context))
            context, byte, own = context[order], byte[order], own[order]
            first = np.flatnonzero(np.concatenate([[True], (context[1:] != context[:-1]) | (byte[1:] != byte[:-1])]))
            out = {"c": context[first], "b": byte[first].astype(np.int32)}
            for name, counter in zip(("o", "t"), held):
                out[name] = np.add.reduceat(np.fromiter(map(counter.__getitem__, part), np.int64, len(part))[own], first)
            yield pa.RecordBatch.from_pydict({n: pa.array(a) for n, a in out.items()})
        for counter in held:
            counter.clear()

    for batch in batches:
        for part in slices(batch):
            for text, toxic in zip(text_bytes(part.column("text")), part.column("toxic").to_pylist()):
                held[toxic].update(set(words_of(text)))
            if len(held[0]) + len(held[1]) > HELD_WORDS:
                yield from rows()
    yield from rows()


def _last(name: str, size: int) -> Column:
    """The last ``size`` bytes of a context."""
    return F.col(name).bitwiseAND(F.lit((1 << 8 * size) - 1))


def shared(grams: DataFrame) -> DataFrame:
    """(c, b, p): the Kneser-Ney distribution of contexts of ``ORDERS[0]`` bytes, from the distinct sequences of the full contexts."""
    counts, longer = [], grams
    for size in ORDERS:
        longer = stage_table(longer.groupBy(_last("c", size).alias("c"), "b").agg(F.count("*").alias("n")), f"order{size}")
        counts.append((size, longer))
    below: DataFrame | None = None
    for size, own in reversed(counts):
        sums = own.groupBy("c").agg(F.sum("n").alias("total"), F.count("*").alias("kinds"))
        rows = own.join(sums, "c")
        if below is None:
            low = F.lit(1 / 256)
        else:
            rows = rows.withColumn("s", _last("c", shorter)).join(below.select(F.col("c").alias("s"), "b", F.col("p").alias("low")), ["s", "b"])
            low = F.col("low")
        p = (F.col("n") - LOWER_DISCOUNT + LOWER_DISCOUNT * F.col("kinds") * low) / F.col("total")
        below, shorter = stage_table(rows.select("c", "b", p.alias("p")), f"shared{size}"), size
    return below


def ratios_of(grams: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(c, b, ratio) of the sequences with more than ``DISCOUNT`` documents of a class, (c, freed) of their contexts."""
    freed = {k: F.least(F.col(k), F.lit(DISCOUNT)) for k in "ot"}
    contexts = grams.groupBy("c").agg(
        *[F.sum(k).alias(f"n_{k}") for k in "ot"], *[F.sum(freed[k]).alias(f"f_{k}") for k in "ot"], F.max(F.greatest("o", "t")).alias("most")
    )
    contexts = stage_table(contexts.filter(F.col("most") > DISCOUNT).drop("most"), "contexts")
    share = {k: F.when(F.col(f"n_{k}") > 0, F.col(f"f_{k}") / F.col(f"n_{k}")).otherwise(1.0) for k in "ot"}
    kept = grams.filter(F.greatest("o", "t") > DISCOUNT).join(contexts, "c").withColumn("s", _last("c", ORDERS[0]))
    kept = kept.join(shared(grams).select(F.col("c").alias("s"), "b", "p"), ["s", "b"])
    p = {k: F.coalesce((F.col(k) - freed[k]) / F.nullif(F.col(f"n_{k}"), F.lit(0)), F.lit(0.0)) + share[k] * F.col("p") for k in "ot"}
    return kept.select("c", "b", F.ln(p["t"] / p["o"]).alias("ratio")), contexts.select("c", F.ln(share["t"] / share["o"]).alias("freed"))


class Model:
    """Log-likelihood ratios of sequences, and of the freed shares of contexts for all other bytes."""

    def __init__(self, keys: np.ndarray, ratio: np.ndarray, contexts: np.ndarray, freed: np.ndarray, ready: bool):
        self.keys, self.ratio, self.contexts, self.freed, self.ready = keys, ratio.astype(np.float32), contexts, freed.astype(np.float32), ready
        self.a, self.b = 0.0, -math.inf
        self._open()

    def _open(self) -> None:
        self.sequence = Lookup(self.keys, np.arange(len(self.keys), dtype=np.int32))
        self.context = Lookup(self.contexts, np.arange(len(self.contexts), dtype=np.int32))
        self.known: dict[bytes, float] = {}

    def __getstate__(self) -> dict:
        return {k: v for k, v in vars(self).items() if k not in ("sequence", "context", "known")}

    def __setstate__(self, state: dict) -> None:
        vars(self).update(state)
        self._open()

    def word_ratios(self, words: list[bytes]) -> np.ndarray:
        """Log-likelihood ratio of each word, toxic against ordinary."""
        return np.concatenate([self._block_ratios(words[i : i + BLOCK]) for i in range(0, len(words), BLOCK)])

    def _block_ratios(self, words: list[bytes]) -> np.ndarray:
        context, byte, own = sequences(words)
        value = np.zeros(len(own))
        at = self.context.get(context)
        some = np.flatnonzero(at >= 0)  # a sequence of the table has its context there too
        value[some] = self.freed[at[some]]
        at = self.sequence.get(_key(context[some], byte[some]))
        value[some[at >= 0]] = self.ratio[at[at >= 0]]
        return np.bincount(own, weights=value, minlength=len(words))

    def ratios(self, texts: list[bytes]) -> np.ndarray:
        """Mean excess ratio per word of each text, on a logarithmic scale."""
        cut = [words_of(t) for t in texts]
        new = set().union(*cut).difference(self.known)
        if len(self.known) + len(new) > HELD_WORDS:
            self.known.clear()
            new = set().union(*cut)
        if new:
            new = list(new)
            self.known.update(zip(new, np.maximum(self.word_ratios(new) - MARGIN, 0).tolist()))
        get = self.known.__getitem__
        return np.log1p(200 * np.array([math.fsum(map(get, words)) / len(words) if words else 0.0 for words in cut]))

    def release(self) -> None:
        """Let the words go."""
        self.known = {}

    def scores(self, texts: list[bytes]) -> np.ndarray:
        if not self.ready or self.b == -math.inf:
            return np.zeros(len(texts))
        return 1 / (1 + np.exp(-np.clip(self.a * self.ratios(texts) + self.b, -500, 500)))

    def calibrate(self, bins: list[tuple[int, int, int]]) -> None:
        """Logistic regression on (bin, label, rows) by Newton steps, with a weak prior on the slope."""
        x = np.array([b for b, _, _ in bins], float) / BINS
        y, n = (np.array([r[i] for r in bins], float) for i in (1, 2))
        if not len(bins) or not 0 < (y * n).sum() < n.sum():
            return
        scale = max(1e-6, math.sqrt((n * x * x).sum() / n.sum()))
        z = np.stack([x / scale, np.ones_like(x)])
        theta, prior = np.zeros(2), np.diag([0.05, 1e-6])
        for _ in range(60):
            p = 1 / (1 + np.exp(-np.clip(theta @ z, -500, 500)))
            step = np.linalg.solve((z * (n * p * (1 - p))) @ z.T + prior, z @ (n * (y - p)) - prior @ theta)
            theta += step * min(1, 4 / max(1e-9, np.abs(step).max()))
        self.a, self.b = float(theta[0] / scale), float(theta[1])


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Counts from folds 0 and 1, calibration from fold 3."""
    spark = docs.sparkSession
    known = labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    known = stage_table(known.filter(fold(F.col("doc_id")) != 2), "labels")
    rows = docs.select("doc_id", "text").filter(fold(F.col("doc_id")) != 2)
    rows = rows.join(F.broadcast(known) if known.count() <= BROADCAST_LABELS else known, "doc_id")  # 2 million rows of 12 bytes
    counting = rows.filter(fold(F.col("doc_id")) != 3).select("text", "toxic")
    grams = counting.mapInArrow(_count, "c long, b int, o long, t long").groupBy("c", "b").agg(F.sum("o").alias("o"), F.sum("t").alias("t"))
    grams = stage_table(grams, "grams")
    sequence, context = ratios_of(grams)
    # the classes that have any word: its start is a context of its own
    seen = grams.filter(F.col("c") == START[0]).agg(F.sum("o"), F.sum("t")).first()
    sequence, context = sequence.toArrow(), context.toArrow()
    keys = _key(sequence["c"].to_numpy(), sequence["b"].to_numpy().astype(np.uint64))
    model = Model(keys, sequence["ratio"].to_numpy(), context["c"].to_numpy(), context["freed"].to_numpy(), bool(seen[0] and seen[1]))
    if model.ready:
        shipped = spark.sparkContext.broadcast(model)

        def kernel(batch: pa.RecordBatch) -> dict:
            ratio = shipped.value.ratios(text_bytes(batch.column("text")))
            return {"bin": pa.array(np.floor(ratio * BINS).astype(np.int64)), "toxic": batch.column("toxic")}

        held = rows.filter(fold(F.col("doc_id")) == 3).select("text", "toxic")
        counted = map_texts(held, kernel, "bin long, toxic int", after=lambda: shipped.value.release()).groupBy("bin", "toxic").count()
        model.calibrate([tuple(r) for r in counted.collect()])
        shipped.destroy()  # the calibrated model is sent anew
    return model


def score(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted of each row."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels))

    def kernel(batch: pa.RecordBatch) -> dict:
        value = model.value.scores(text_bytes(batch.column("text")))
        return {"doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"), "score": pa.array(value), "predicted": pa.array((value >= threshold).astype(np.int32))}

    rows = docs.select("doc_id", F.coalesce(fold(F.col("doc_id")) == 2, F.lit(False)).alias("held_out"), "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_texts(rows, kernel, f"doc_id {kind}, held_out boolean, score double, predicted int", after=lambda: model.value.release())
