"""Best-fit packing of token ids into sequences, by hierarchical residual packing.

A document is its ids and an end id. One longer than ``capacity`` is cut into pieces of ``capacity`` ids (the last may be shorter); no other is cut.

Leaves: each task encodes its documents and packs their pieces best-fit, longest first, some ``NODE_ROWS`` pieces at a time. Bins that are nearly full
(``capacity - slack`` ids and more) are done. Tree: the bins that aren't become items themselves, with their members inside. They are dealt to nodes,
each of which takes in the bins of ``FAN`` nodes of the level below and packs them best-fit again; nearly full ones leave, the others go up, until one node is left.
Bins are dealt by a hash, so that every node has all lengths alike. A node never holds more than about ``NODE_ROWS`` rows: a level
has as many nodes as that takes, and the tree ends early where such a level has saved less than a thousandth of its bins (when no two of them fit together, say).

Only the number of open bins of a level comes to the driver. Pieces in bins that were full at once never move; the others look up where their bin has gone.

Defined results: a null or empty text is the end id alone; a null doc_id is kept; rows with equal doc_id are documents of their own, each with pieces from 0; of bins that fit equally
well the last opened is taken; sequence ids are unique and otherwise mean nothing; texts are whole; an empty table gives an empty result; only doc_id and text are
read, whatever others there are.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uelumen.llm.bpe import load
from uelumen.llm.common import bound_batches, slices, stage_table, trimmed

CAPACITY = 2048
SLACK = 4
NODE_ROWS = 200_000
FAN = 8


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and place of each item, and how full each bin is: longest items first, each into the fullest bin that has room."""
    order = np.argsort(-lengths, kind="stable")
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]  # by the room they have
    room, bins, places, n = 0, [], [], 0  # room: bit r is set where a bin has room r
    for size in lengths[order].tolist():
        fitting = room >> size
        if fitting:
            free = size + (fitting & -fitting).bit_length() - 1
            own = open_bins[free].pop()
            if not open_bins[free]:
                room ^= 1 << free
        else:
            free, own, n = capacity, n, n + 1
        bins.append(own)
        places.append(capacity - free)
        if free > size:
            open_bins[free - size].append(own)
            room |= 1 << free - size
    bin_of, place_of = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
    bin_of[order], place_of[order] = bins, places
    return bin_of, place_of, np.bincount(bin_of, lengths, minlength=n).astype(np.int64)


def pieces_of(ids: np.ndarray, counts: np.ndarray, end_id: int, capacity: int) -> dict[str, np.ndarray | list]:
    """doc (its number), piece, start, length, ids and their CRC-32 of every piece of some documents."""
    whole = np.insert(ids, np.cumsum(counts), end_id).astype("<u4", copy=False)
    sizes = counts + 1
    n = -(-sizes // capacity)
    doc = np.repeat(np.arange(len(sizes)), n)
    piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
    start = piece * capacity
    length = np.minimum(sizes[doc] - start, capacity)
    ends = np.cumsum(length)
    raw = memoryview(np.ascontiguousarray(whole)).cast("B")
    spans = [raw[4 * i : 4 * j] for i, j in zip((ends - length).tolist(), ends.tolist())]
    return {"doc": doc, "piece": piece, "start": start, "length": length, "spans": spans, "ids_crc32": [*map(zlib.crc32, spans)]}


def leaves(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, ids: bool) -> DataFrame:
    """Every piece with the bin that its own task has put it in, its place there and how full the bin is."""
    names, most = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * ids], NODE_ROWS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, task, made, held = load(tokenizer), TaskContext.get().partitionId(), 0, []

        def node() -> pa.RecordBatch:
            own = pa.Table.from_batches(held).combine_chunks()
            bins, places, fill = best_fit(own.column("length").to_numpy(), capacity)
            number = (task << 40) + made + bins
            return pa.RecordBatch.from_arrays(
                [*(own.column(c).combine_chunks() for c in names), pa.array(np.full(len(bins), task << 40 | made)), pa.array(number), pa.array(places), pa.array(fill[bins])],
                names=[*names, "node", "bin", "offset", "fill"],
            )

        rows = 0
        try:
            for batch in batches:
                for part in slices(batch):
                    cut = pieces_of(*bpe.encode_all(part.column("text")), end_id, capacity)
                    columns = [part.column("doc_id").take(pa.array(cut["doc"])), *(pa.array(cut[c], pa.int64()) for c in names[1:5])]
                    held.append(pa.RecordBatch.from_arrays(columns + [pa.array(map(bytes, cut["spans"]), pa.binary())] * ids, names=names))
                    rows += len(cut["doc"])
                    if rows >= most:
                        yield node()
                        held, rows, made = [], 0, made + rows  # there are no more bins than rows
            if rows:
                yield node()
        finally:
            bpe.release()

    bound_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece long, start long, length long, ids_crc32 long, {'ids binary, ' * ids}node long, bin long, offset long, fill long"
    return docs.select("doc_id", "text").mapInArrow(trimmed(run), schema)


def merge(capacity: int, table: pa.Table) -> pa.Table:
    """One node: bins (``root``, with the bins inside them and where these begin) packed into each other; the first bin of each names it."""
    root, shift, fill = (table.column(c).to_numpy() for c in ("root", "shift", "fill"))
    first = np.flatnonzero(shift == 0)
    first = first[np.argsort(root[first], kind="stable")]
    item = np.searchsorted(root[first], root)
    bins, places, full = best_fit(fill[first], capacity)
    head = np.empty(len(full), np.int64)
    head[bins[places == 0]] = root[first][places == 0]
    return pa.table({"bin": table.column("bin"), "root": head[bins[item]], "shift": shift + places[item], "fill": full[bins[item]]})


def pack(docs: DataFrame, tokenizer: str, *, capacity: int = CAPACITY, end_id: int = 0, slack: int = SLACK, ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of each piece of each document, and with ``ids`` its ids (little-endian u32)."""
    held = stage_table(leaves(docs, tokenizer, capacity, end_id, ids), "pieces")
    full = capacity - slack
    zero = F.lit(0).cast("long")
    # every bin has one piece at its beginning
    going = held.filter((F.col("offset") == 0) & (F.col("fill") < full)).select("bin", F.col("bin").alias("root"), zero.alias("shift"), "fill")
    width = held.select("node").distinct().count()
    rows = roots = going.count()
    settled = []

    def node(table: pa.Table) -> pa.Table:
        return merge(capacity, table)

    while width > 1 and roots > 1:
        least = -(-rows // NODE_ROWS)
        nodes = max(least, -(-width // FAN))
        dealt = going.withColumn("node", F.pmod(F.xxhash64("root", F.lit(len(settled))), F.lit(nodes)))
        merged = stage_table(dealt.groupBy("node").applyInArrow(node, "bin long, root long, shift long, fill long"), "bins")
        settled.append(merged.filter(F.col("fill") >= full))
        going = merged.filter(F.col("fill") < full)
        after = merged.filter("shift = 0").count()
        stuck = nodes == least and after > roots - roots / 1000
        rows, roots = merged.agg(F.count_if(F.col("fill") < full), F.count_if((F.col("fill") < full) & (F.col("shift") == 0))).first()
        width = 1 if stuck else nodes
    gone = functools.reduce(DataFrame.union, settled, going).select("bin", "root", "shift")
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    rest = ["ids"] * ids
    still = held.filter(F.col("fill") >= full).select(*names, F.col("bin").alias("sequence_id"), "offset", *rest)
    moved = held.filter(F.col("fill") < full).join(gone, "bin").select(*names, F.col("root").alias("sequence_id"), (F.col("offset") + F.col("shift")).alias("offset"), *rest)
    return still.union(moved)
