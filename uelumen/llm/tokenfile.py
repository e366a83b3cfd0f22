"""Token-id files: an adaptive context-mixing range coder over independent, checksummed blocks.

A file is a sequence of *segments*; a segment holds whole documents in ascending doc_id order, their ids in one
stream cut into *blocks* of ``BLOCK`` ids. Every block starts from a reset model and carries the CRC-32 of its ids, so
any block can be decoded, checked or lost on its own.

Model of a block. Order 2 and order 1 each predict one id, the last seen after the same two ids or the same one id, with a
small confidence. The confidences (and whether the two agree) choose an adaptive mix over three outcomes: the order-2 id,
the order-1 id, another id; another id has the adaptive frequencies of order 0. Both choices narrow the interval of a carry-less
range coder at once (64-bit low end, 16-bit output words).

A block is cut into as many as ``LANES`` runs of consecutive ids, which are coded and decoded in step, one array operation for all lanes:
step t codes the t-th id of every lane with the model that all lanes share, which then learns the ids of that step. Each lane has an
interval and words of its own. The frequencies of order 0 are summed anew whenever the block has grown by a quarter, or
by 16 steps of all lanes.

Layout of a segment (little endian): ``ULTK`` | header length u32 | CRC-32 of the header u32 | header | words of each lane u16 | words u16. Header:
partition i64, sequence i64, documents u32, blocks u32; for each document: valid u8, doc_id i64, ids u32; for each block:
ids u32, words u32, lanes u32, greatest id and 1 u32, CRC-32 u32. A line feed follows each segment.

Defined results: null text is empty and has the end id only; a null doc_id sorts first; rows with equal doc_id are ordered
by a hash of the text, then by text, and may lie in several files; repeated rows are each written; texts are whole; only the columns doc_id and text are
read, whatever others there are; an id of 2 ** 30 or more is an error; an empty table writes no segment.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from uelumen.llm.bpe import load
from uelumen.llm.common import bound_batches, scratch_path, slices, stage_table, trimmed

BLOCK = 1 << 21
STEPS = 256
LANES = 8192
BLOCKS_PER_SEGMENT = 1
SEGMENTS_PER_FILE = 4
PAIR_BITS = 18
SHARE_BITS = 12
SHARES = 1 << SHARE_BITS
GAIN = 24
LEAST_SUM = 4096
MOST_IDS = 1 << 30
U = np.uint64
WORD, TOP = U(16), U(48)
FLOOR = U(1 << 48)
BELOW = FLOOR - U(1)
SURE = np.uint32(3)


class Mixer:
    """The adaptive model that all lanes of a block share: it learns what a step has shown before the next one."""

    def __init__(self, span: int):
        self.seen = [np.zeros(span, np.uint32), np.zeros(1 << PAIR_BITS, np.uint32)]  # id * 4 + confidence, after one id and after two
        self.outcomes = np.tile(np.array([2, 1, 6], np.int64), (32, 1))
        self.counts = np.ones(span, np.int64)
        self.taken = 0
        self._share()
        self._sum()

    def _share(self) -> None:
        """Where the shares of the order-2 id, the order-1 id and other ids begin, and how large they are, by confidences."""
        total = self.outcomes.sum(axis=1)
        self.one = 1 + self.outcomes[:, 0] * (SHARES - 3) // total
        self.other = self.one + 1 + self.outcomes[:, 1] * (SHARES - 3) // total
        at = np.stack([np.zeros_like(self.one), self.one, self.other, np.full_like(self.one, SHARES)], axis=1).astype(np.uint64)
        self.first, self.share = np.ascontiguousarray(at[:, :3]).ravel(), np.diff(at, axis=1).ravel()

    def _sum(self) -> None:
        self.cum = np.concatenate([[0], np.cumsum(self.counts)])
        self.total = int(self.cum[-1])
        # an outcome that isn't another id has the whole of its share: place ``span`` stands for it
        self.begin = np.append(self.cum[:-1], 0).astype(np.uint64)
        self.count = np.append(self.counts, self.total).astype(np.uint64)
        self.slots = None

    def interval(self, own: np.ndarray, outcome: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and width of what is coded, out of ``SHARES`` times the sum of counts."""
        self.case = self.row * 3 + outcome
        at = np.where(outcome == 2, own, len(self.counts))
        share = self.share.take(self.case)
        return self.first.take(self.case) * U(self.total) + share * self.begin.take(at), share * self.count.take(at)

    def slot(self, target: np.ndarray) -> np.ndarray:
        """The id whose cumulative count covers each target."""
        if self.slots is None:
            self.shift = max(0, self.total.bit_length() - 14)
            self.slots = np.searchsorted(self.cum, np.arange((self.total >> self.shift) + 1) << self.shift, "right") - 1
        ids = self.slots[target >> self.shift]
        past = np.flatnonzero(self.cum[ids + 1] <= target)
        ids[past] = np.searchsorted(self.cum, target[past], "right") - 1
        return ids

    def look(self, a: np.ndarray, b: np.ndarray) -> None:
        pair = ((a * np.uint32(0x85EBCA6B)) ^ (b * np.uint32(0xC2B2AE35))) * np.uint32(0x27D4EB2F) >> np.uint32(32 - PAIR_BITS)
        self.at = a.astype(np.int64), pair.astype(np.int64)
        self.held = one, two = self.seen[0].take(self.at[0]), self.seen[1].take(self.at[1])
        self.id1, self.id2 = one >> 2, two >> 2
        self.row = ((two & SURE) << 3 | (one & SURE) << 1 | (self.id1 == self.id2)).astype(np.int64)

    def learn(self, grid: np.ndarray, t: int, own: np.ndarray) -> None:
        for table, where, held, known in zip(self.seen, self.at, self.held, (self.id1, self.id2)):
            sure = held & SURE
            table[where] = np.where(known == own, held + (sure < 3), np.where(sure > 1, held ^ sure ^ np.uint32(1), own << 2))
        self.outcomes += np.bincount(self.case, minlength=96).reshape(32, 3) * 4
        self.outcomes[self.outcomes.sum(axis=1) > 1 << 16] >>= 1
        self.outcomes |= self.outcomes == 0
        self._share()
        fresh = (t + 1 - self.taken) * grid.shape[1]
        if fresh >= max(LEAST_SUM, min((t + 1) * grid.shape[1] >> 2, 16 * LANES)):
            self.counts += GAIN * np.bincount(grid[self.taken : t + 1].ravel(), minlength=len(self.counts))
            self.taken = t + 1
            self._sum()


def _shape(n: int) -> tuple[int, int]:
    """Steps and lanes of a block of n ids; the last lane may be shorter."""
    lanes = min(LANES, max(1, n // STEPS))
    steps = -(-n // lanes)
    return steps, -(-n // steps)


def _cut(low: np.ndarray, width: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Narrow intervals whose leading word is settled: those that cross a border of it end there."""
    cross = (low ^ (low + width - U(1))) >> TOP != 0
    return low, np.where(cross, FLOOR - (low & BELOW), width)


def encode_block(ids: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """The words of all lanes, one lane after the other, and how many each has. Ids are below ``span``."""
    n = len(ids)
    steps, lanes = _shape(n)
    grid = np.zeros(steps * lanes, np.uint32)
    grid[:n] = ids
    grid = np.ascontiguousarray(grid.reshape(lanes, steps).T)
    last = n - (lanes - 1) * steps
    mixer = Mixer(span)
    low, width = np.zeros(lanes, np.uint64), np.full(lanes, ~U(0))
    out, size = np.zeros((2 * steps + 16, lanes), np.uint16), np.zeros(lanes, np.int64)
    before = [np.zeros(lanes, np.uint32), np.zeros(lanes, np.uint32)]
    for t in range(steps):
        k = lanes if t < last else lanes - 1
        own = grid[t, :k]
        mixer.look(before[0][:k], before[1][:k])
        start, part = mixer.interval(own, np.where(own == mixer.id2, 0, np.where(own == mixer.id1, 1, 2)))
        unit = width[:k] // U(mixer.total << SHARE_BITS)
        low[:k] += unit * start
        width[:k] = unit * part
        if size.max() + 16 >= len(out):
            out = np.concatenate([out, np.zeros_like(out)])
        flat = out.reshape(-1)
        narrow = np.flatnonzero(width < FLOOR)
        while len(narrow):
            own_low, own_width = _cut(low.take(narrow), width.take(narrow))
            place = size.take(narrow)
            flat[place * lanes + narrow] = own_low >> TOP
            size[narrow] = place + 1
            low[narrow], width[narrow] = own_low << WORD, own_width << WORD
            narrow = narrow[own_width < FLOOR >> WORD]
        mixer.learn(grid, t, own)
        before = [own if k == lanes else np.append(own, np.uint32(0)), before[0]]
    for _ in range(4):
        out[size, np.arange(lanes)] = low >> TOP
        size += 1
        low = low << WORD
    return out.T[np.arange(len(out)) < size[:, None]], size


def decode_block(words: np.ndarray, size: np.ndarray, n: int, span: int) -> np.ndarray:
    """The n ids of a block from the words of its lanes."""
    steps, lanes = _shape(n)
    grid = np.zeros((steps, lanes), np.uint32)
    last = n - (lanes - 1) * steps
    mixer = Mixer(span)
    words = np.concatenate([words, np.zeros(4, words.dtype)]).astype(np.uint64)
    at = np.cumsum(size, dtype=np.int64) - size
    low, width, value = np.zeros(lanes, np.uint64), np.full(lanes, ~U(0)), np.zeros(lanes, np.uint64)  # value: the code less the low end
    for _ in range(4):
        value = value << WORD | words[at]
        at += 1
    before = [np.zeros(lanes, np.uint32), np.zeros(lanes, np.uint32)]
    for t in range(steps):
        k = lanes if t < last else lanes - 1
        mixer.look(before[0][:k], before[1][:k])
        total = mixer.total
        unit = width[:k] // U(total << SHARE_BITS)
        target = np.minimum(value[:k] // unit, U((total << SHARE_BITS) - 1)).astype(np.int64)
        share, first = target // total, mixer.other.take(mixer.row)
        outcome = (share >= mixer.one.take(mixer.row)).astype(np.int64) + (share >= first)
        own = np.where(outcome == 0, mixer.id2, mixer.id1)
        other = np.flatnonzero(outcome == 2)
        first = first[other]
        # below 2 ** 37 by 2 ** 12: the quotient of floats has the right whole part
        own[other] = mixer.slot(((target[other] - first * total) / (SHARES - first)).astype(np.int64))
        start, part = mixer.interval(own, outcome)
        below = unit * start
        low[:k] += below
        value[:k] -= below
        width[:k] = unit * part
        narrow = np.flatnonzero(width < FLOOR)
        while len(narrow):
            own_low, own_width = _cut(low.take(narrow), width.take(narrow))
            place = at.take(narrow)
            value[narrow] = value.take(narrow) << WORD | words.take(place)
            at[narrow] = place + 1
            low[narrow], width[narrow] = own_low << WORD, own_width << WORD
            narrow = narrow[own_width < FLOOR >> WORD]
        grid[t, :k] = own
        mixer.learn(grid, t, own)
        before = [own if k == lanes else np.append(own, np.uint32(0)), before[0]]
    return grid.T.ravel()[:n] if n == steps * lanes else np.concatenate([grid[:, :-1].T.ravel(), grid[:last, -1]])


DOC = np.dtype([("valid", "u1"), ("doc_id", "<i8"), ("ids", "<u4")])
PART = np.dtype([("ids", "<u4"), ("words", "<u4"), ("lanes", "<u4"), ("span", "<u4"), ("crc", "<u4")])


def pack_segment(partition: int, sequence: int, doc_ids: list, counts: np.ndarray | list[int], ids: np.ndarray) -> bytes:
    docs = np.zeros(len(doc_ids), DOC)
    docs["valid"] = [d is not None for d in doc_ids]
    docs["doc_id"] = [d or 0 for d in doc_ids]
    docs["ids"] = counts
    rows, lanes, words = [], [], []
    for i in range(0, len(ids), BLOCK):
        own = ids[i : i + BLOCK].astype("<u4")
        span = int(own.max()) + 1
        if span > MOST_IDS:
            raise ValueError(f"id {span - 1} is too large for a token file")
        coded, size = encode_block(own, span)
        rows.append((len(own), len(coded), len(size), span, zlib.crc32(own)))
        lanes.append(size.astype("<u2").tobytes())
        words.append(coded.astype("<u2").tobytes())
    header = np.array([partition, sequence], "<i8").tobytes() + np.array([len(docs), len(rows)], "<u4").tobytes() + docs.tobytes() + np.array(rows, PART).tobytes()
    return b"".join([b"ULTK", np.array([len(header), zlib.crc32(header)], "<u4").tobytes(), header, *lanes, *words])


def unpack_segments(data: bytes) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(partition, sequence, documents, ids) of each segment of a file; raises if a checksum fails."""
    at = 0
    while at < len(data):
        size, crc = np.frombuffer(data, "<u4", 2, at + 4).tolist()
        header = data[at + 12 : at + 12 + size]
        if data[at : at + 4] != b"ULTK" or zlib.crc32(header) != crc:
            raise ValueError(f"no sound segment at byte {at}")
        partition, sequence = np.frombuffer(header, "<i8", 2).tolist()
        n_docs, n_blocks = np.frombuffer(header, "<u4", 2, 16).tolist()
        docs = np.frombuffer(header, DOC, n_docs, 24)
        blocks = np.frombuffer(header, PART, n_blocks, 24 + n_docs * DOC.itemsize)
        lane = at + 12 + size
        at = lane + 2 * int(blocks["lanes"].sum())
        out: list[np.ndarray] = []
        for n, words, lanes, span, crc in blocks.tolist():
            own = decode_block(np.frombuffer(data, "<u2", words, at), np.frombuffer(data, "<u2", lanes, lane), n, span).astype("<u4", copy=False)
            if zlib.crc32(np.ascontiguousarray(own)) != crc:
                raise ValueError(f"a block of segment {partition}/{sequence} fails its checksum")
            out.append(own)
            lane, at = lane + 2 * lanes, at + 2 * words
        yield partition, sequence, docs, np.concatenate(out)
        at += 1


def write(docs: DataFrame, path: str, tokenizer: str, *, end_id: int = 2) -> None:
    """Encode ``docs`` (doc_id, text) and write them to ``path`` in ascending doc_id order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(tokenizer)
        partition, sequence = TaskContext.get().partitionId(), 0
        names, sizes, coded, held = [], [], [], 0

        def segment() -> pa.RecordBatch:
            packed = pack_segment(partition, sequence, names, np.concatenate(sizes), np.concatenate(coded))
            return pa.RecordBatch.from_pydict({"segment": pa.array([packed], pa.binary())})

        try:
            for batch in batches:
                for part in slices(batch):
                    ids, counts = bpe.encode_all(part.column("text"))
                    names += part.column("doc_id").to_pylist()
                    sizes.append(counts + 1)
                    coded.append(np.insert(ids, np.cumsum(counts), end_id))
                    held += len(coded[-1])
                    if held >= BLOCKS_PER_SEGMENT * BLOCK:
                        yield segment()
                        names, sizes, coded, held, sequence = [], [], [], 0, sequence + 1
            bpe.release()
            if names:
                yield segment()
        finally:
            bpe.release()

    # only ids and hashes are sampled for the ranges, and many rows of one id are split by their hash
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("ul_hash", F.xxhash64("text"))
    ordered = keyed.repartitionByRange("doc_id", "ul_hash").sortWithinPartitions("doc_id", "ul_hash", "text").drop("ul_hash")
    bound_batches(docs.sparkSession)
    segments = ordered.mapInArrow(trimmed(run), "segment binary")
    segments.select(F.col("segment").cast("string").alias("value")).write.option("maxRecordsPerFile", SEGMENTS_PER_FILE).option("lineSep", "\n").text(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """partition, sequence, place, doc_id, before (ids before it in its segment), n_tokens, ids_crc32 of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                for partition, sequence, docs, ids in unpack_segments(content.as_py()):
                    ends = np.cumsum(docs["ids"].astype(np.int64))
                    starts = ends - docs["ids"]
                    raw = memoryview(np.ascontiguousarray(ids))
                    n = len(docs)
                    yield pa.RecordBatch.from_pydict({
                        "partition": pa.array(np.full(n, partition)), "sequence": pa.array(np.full(n, sequence)), "place": pa.array(np.arange(n)),
                        "doc_id": pa.array(docs["doc_id"].astype(np.int64), mask=docs["valid"] == 0), "before": pa.array(starts),
                        "n_tokens": pa.array(docs["ids"].astype(np.int64)),
                        "ids_crc32": pa.array([zlib.crc32(raw[i:j]) for i, j in zip(starts.tolist(), ends.tolist())], pa.int64()),
                    })

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(trimmed(run), "partition long, sequence long, place long, doc_id long, before long, n_tokens long, ids_crc32 long")


def write_and_read(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document, from files written to the shared folder."""
    spark = docs.sparkSession
    path = scratch_path(spark, "tokens")
    write(docs, path, tokenizer)
    own = stage_table(read(spark, path), "documents")
    # one row per segment: millions of ids each, so their running sum is small
    totals = own.groupBy("partition", "sequence").agg(F.sum("n_tokens").alias("total"))
    order = Window.orderBy("partition", "sequence").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("partition", "sequence", F.coalesce(F.sum("total").over(order), F.lit(0)).alias("base"))
    return own.join(bases, ["partition", "sequence"]).select("doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")
