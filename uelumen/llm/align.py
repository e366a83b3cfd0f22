"""Alignment of two tokenizers: which tokens of a byte-level BPE (A) and of a sentence-piece BPE (B) cover the same bytes.

Both encode a space and the text. Byte offsets where a token of A and a token of B end cut the text into *groups*; two tokens are
*linked* where their byte ranges overlap. A pair of ids counts as many links as all documents hold.

Segment deduplication. A text is cut before its runs of white space, where no token of either vocabulary can reach across:

* the word pattern of a byte-level BPE takes no white space after another character, and A merges within its words only;
* no piece of B holds the white-space character after another character, so no merge joins the two sides. A segment is encoded behind
  the space that B puts first; one that begins with a line feed or a tab loses that token again, which no piece joins to either.

:meth:`Pair.verify` checks that A has that pattern and reads the condition on B off its pieces for each ASCII white-space character; only those that hold
cut (a carriage return doesn't, with the given B). A run that begins with another white-space character isn't cut.

Documents are dealt into blocks of ``BLOCK_BYTES``, each with a table of its own segments. The rows of all tables are dealt and sorted by segment; each distinct
segment is tokenised and aligned once there, in chunks, whose distinct pairs are counted and looked up. Each chunk then sends the alignments back to the blocks that
hold its segments, and each block composes its documents.

Defined results: a text that is null, empty or holds U+2581 (which B gives back as a space) has no tokens: zeros, and groups ''; special strings in a text
are plain text; texts are whole, and one without white space is one segment; repeated rows are each aligned and counted; of ids that tie as the most linked
of a B id each counts; a null doc_id is kept; an empty table gives an empty result; only doc_id and text are read, whatever others there are.
"""

from __future__ import annotations

import functools
import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2
from tokenizers import Tokenizer

from uelumen.llm.bpe import _byte_chars
from uelumen.llm.common import bound_batches, forget_shuffles, stage_table, trimmed

BLOCK_BYTES = 32 << 20
CHUNK_BYTES = 12 << 20
SPACE_PIECE = "▁"
ASCII_SPACE = b" \t\n\v\f\r"
#: UTF-8 of the white space beyond ASCII that a word pattern may know: a run that follows one of these isn't cut.
WIDE_SPACE = [chr(c).encode() for c in (0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
#: ASCII after which a run isn't cut: white space, and the separators that some take for it.
BEFORE = np.isin(np.arange(256), np.frombuffer(ASCII_SPACE + b"\x1c\x1d\x1e\x1f", np.uint8))
LOW = (1 << 32) - 1


class Pair:
    """Both tokenizers, the bytes of their tokens, and the characters that are safe to cut before."""

    def __init__(self, a_path: str, b_path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self.a, self.b = Tokenizer.from_file(a_path), SentencePieceProcessor(model_file=b_path)
        self.a.encode_special_tokens = True
        byte_of = {c: i for i, c in enumerate(_byte_chars())}
        entries = self.a.get_vocab(with_added_tokens=False)
        a_bytes: dict[int, bytes] = {i: bytes(map(byte_of.__getitem__, t)) for t, i in entries.items()}
        model = sentencepiece_model_pb2.ModelProto()
        with open(b_path, "rb") as f:
            model.ParseFromString(f.read())
        b_bytes: dict[int, bytes] = {}
        for i, piece in enumerate(model.pieces):
            if piece.type == piece.BYTE:
                b_bytes[i] = bytes([int(piece.piece[3:5], 16)])
            elif piece.type == piece.NORMAL:
                b_bytes[i] = piece.piece.replace(SPACE_PIECE, " ").encode()
        self.safe = self.verify(a_bytes, model)
        self.a_size, self.b_size = 1 + max(a_bytes), len(model.pieces)
        self.a_len, self.b_len = np.zeros(self.a_size, np.int64), np.zeros(self.b_size, np.int64)
        for size, known in ((self.a_len, a_bytes), (self.b_len, b_bytes)):
            size[list(known)] = [*map(len, known.values())]
        ids = [range(self.a_size), range(self.b_size)]
        self.names = pa.array([f"{i}{end}" for own, ends in zip(ids, (",|", ",;")) for end in ends for i in own], pa.string())

    def verify(self, a_bytes: dict[int, bytes], model: sentencepiece_model_pb2.ModelProto) -> np.ndarray:
        """Whether a run that begins with a byte may be cut off from a character before it that isn't white space."""
        norm, kind = model.normalizer_spec, model.trainer_spec
        pre = self.a.pre_tokenizer.__getstate__()
        if self.a.normalizer is not None or b'"ByteLevel"' not in pre or b'"use_regex":true' not in pre or b'"add_prefix_space":false' not in pre:
            raise ValueError("A must be a byte-level BPE with its word pattern, without normaliser or prefix")
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix or not kind.byte_fallback or kind.model_type != kind.BPE:
            raise ValueError("B must be a BPE with a space put first, bytes for unknown characters and no other normalisation")
        if any(p.type == p.USER_DEFINED for p in model.pieces):
            raise ValueError("B must have no user-defined pieces")
        if {bytes([i]) for i in range(256)} - set(a_bytes.values()) or sum(p.type == p.BYTE for p in model.pieces) < 256:
            raise ValueError("both vocabularies must hold every byte")
        pieces = [p.piece for p in model.pieces if p.type == p.NORMAL]
        safe = np.zeros(256, bool)
        for c in ASCII_SPACE:
            own = SPACE_PIECE if c == 32 else chr(c)
            crossing = any(x == own and not (w == SPACE_PIECE or w.isspace()) for p in pieces if own in p[1:] for w, x in zip(p, p[1:]))
            joined = c != 32 and any(SPACE_PIECE + own in p for p in pieces)
            safe[c] = not (crossing or joined)
        if not safe[32]:
            raise ValueError("a token reaches across a space")
        return safe

    def cuts(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Where segments begin in texts that lie one after the other and begin at ``starts``."""
        mark = self.safe[data]
        mark[:1] = False
        at = np.flatnonzero(mark)
        before = data[at - 1]
        whole = ~BEFORE[before]
        wide = np.flatnonzero(before >= 0x80)
        for space in WIDE_SPACE:
            if not len(wide):
                break
            own = at[wide]
            same = own >= len(space)
            for k, byte in enumerate(reversed(space), 1):
                same &= data[np.maximum(own - k, 0)] == byte
            whole[wide[same]] = False
        mark[at] = whole
        mark[starts] = True
        return np.flatnonzero(mark)

    def align(self, segments: list[bytes]) -> dict[str, pa.Array]:
        """n_a, n_b, n_groups, n_links, groups (each with a closing ``;``) and pairs (A id * 2 ** 32 + B id) of each segment."""
        n = len(segments)
        texts = [s.decode() for s in segments]
        coded = [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        n_a = np.fromiter(map(len, coded), np.int64, n)
        a = np.fromiter((i for ids in coded for i in ids), np.int64, int(n_a.sum()))
        plain = np.fromiter((s[0] == 32 for s in segments), bool, n)
        pieces = self.b.encode([t[1:] if p else t for t, p in zip(texts, plain.tolist())], num_threads=1)
        if not plain.all():
            pieces = [ids if p else ids[1:] for ids, p in zip(pieces, plain.tolist())]
        only = [i for i, s in enumerate(segments) if s == b" "]
        for i in only:  # the space alone, which B has no text for
            pieces[i] = [self.b.piece_to_id(SPACE_PIECE)]
        n_b = np.fromiter(map(len, pieces), np.int64, n)
        b = np.fromiter((i for ids in pieces for i in ids), np.int64, int(n_b.sum()))

        end = np.cumsum(np.fromiter(map(len, segments), np.int64, n))
        end_a, end_b = np.cumsum(self.a_len[a]), np.cumsum(self.b_len[b])
        last_a, last_b = np.cumsum(n_a) - 1, np.cumsum(n_b) - 1
        if not (np.array_equal(end_a[last_a], end) and np.array_equal(end_b[last_b], end)):
            raise ValueError("a segment's tokens don't give its bytes")
        both = end_a[np.isin(end_a, end_b, assume_unique=True)]
        group_a, group_b = np.searchsorted(both, end_a), np.searchsorted(both, end_b)
        groups = np.diff(np.searchsorted(both, end, "right"), prepend=0)
        # the B tokens that overlap each A token
        first = np.searchsorted(end_b, end_a - self.a_len[a], "right")
        reach = np.searchsorted(end_b, end_a) - first + 1
        links = np.cumsum(reach)
        other = np.repeat(first - (links - reach), reach) + np.arange(links[-1] if len(links) else 0)
        pairs = np.repeat(a, reach) << 32 | b[other]
        link_end = links[last_a] if n else links
        # the text of the groups: ids of A, then of B, each with what follows it
        part = np.zeros(len(a) + len(b), np.int64)
        in_a, in_b = np.bincount(group_a, minlength=len(both)), np.bincount(group_b, minlength=len(both))
        closes_a, closes_b = np.append(group_a[1:] != group_a[:-1], True)[: len(a)], np.append(group_b[1:] != group_b[:-1], True)[: len(b)]
        part[np.arange(len(a)) + (np.cumsum(in_b) - in_b)[group_a]] = a + self.a_size * closes_a
        part[np.arange(len(b)) + np.cumsum(in_a)[group_b]] = 2 * self.a_size + b + self.b_size * closes_b
        spelt = self.names.take(pa.array(part))
        _, places, text = spelt.buffers()
        border = np.frombuffer(places, np.int32, len(spelt) + 1)[np.concatenate([[0], np.cumsum(n_a + n_b)])] if n else np.zeros(1, np.int32)
        return {
            "n_a": pa.array(n_a), "n_b": pa.array(n_b), "n_groups": pa.array(groups), "n_links": pa.array(np.diff(link_end, prepend=0)),
            "groups": pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(border), text]),
            "pairs": pa.ListArray.from_arrays(pa.array(np.concatenate([[0], link_end]), pa.int32()), pa.array(pairs)),
        }


def squeeze(numbers: np.ndarray) -> bytes:
    """32-bit numbers, compressed byte by byte of their places."""
    planes = np.ascontiguousarray(numbers.astype("<i4", copy=False).view(np.uint8).reshape(-1, 4).T)
    return len(numbers).to_bytes(8, "little") + pa.compress(planes, "zstd", asbytes=True)


def unsqueeze(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    planes = np.frombuffer(pa.decompress(data[8:], 4 * n, "zstd"), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, n).T).view("<i4").ravel()


def in_list(values: pa.Array) -> pa.Array:
    """One row that holds all values."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def wrap(rows: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(rows)
    return sink.getvalue().to_pybytes()


def unwrap(parcels: pa.ChunkedArray) -> pa.Table | None:
    return pa.concat_tables([pa.ipc.open_stream(p.as_buffer()).read_all() for p in parcels]) if len(parcels) else None


def parcels(rows: pa.RecordBatch, key: str, order: str) -> pa.RecordBatch:
    """(key, rows): the rows of each key in their order, compressed together, so that a shuffle carries less."""
    rows = rows.take(pa.array(np.lexsort((rows.column(order).to_numpy(), rows.column(key).to_numpy()))))
    keys = rows.column(key).to_numpy()
    border = np.flatnonzero(np.diff(keys, prepend=keys[:1] - 1, append=keys[-1:] + 1)).tolist()
    rest = rows.select([n for n in rows.schema.names if n != key])
    return pa.RecordBatch.from_pydict({key: pa.array(keys[border[:-1]]), "rows": pa.array([wrap(rest.slice(i, j - i)) for i, j in zip(border, border[1:])], pa.binary())})


@functools.lru_cache(maxsize=2)
def load(a_path: str, b_path: str) -> Pair:
    return Pair(a_path, b_path)


def block_of(pair: Pair, texts: pa.Array) -> dict[str, pa.Array | bytes]:
    """A block of documents: the segments that it holds, how often, and the number of each segment in the order of the texts (``sizes``: how many, -1 without tokens)."""
    texts = texts.cast(pa.large_string())
    sound = pc.fill_null(pc.and_not(pc.greater(pc.binary_length(texts), 0), pc.match_substring(texts, SPACE_PIECE)), False)
    spaced = pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), texts.filter(sound), pa.scalar("", pa.large_string()))
    sizes = np.full(len(texts), -1, np.int64)
    _, starts, data = spaced.buffers()
    starts = np.frombuffer(starts, np.int64, len(spaced) + 1) if len(spaced) else np.zeros(1, np.int64)
    data = data if len(spaced) else pa.py_buffer(b"")
    cut = pair.cuts(np.frombuffer(data, np.uint8, int(starts[-1])), starts[:-1])
    sizes[sound.to_numpy(zero_copy_only=False)] = np.diff(np.searchsorted(cut, starts))
    coded = pa.Array.from_buffers(pa.large_binary(), len(cut), [None, pa.py_buffer(np.append(cut, starts[-1])), data]).dictionary_encode()
    codes = coded.indices.to_numpy()
    counts = np.bincount(codes, minlength=len(coded.dictionary))
    return {"sizes": sizes.astype("<i8").tobytes(), "codes": squeeze(codes), "segments": coded.dictionary.cast(pa.binary()), "counts": pa.array(counts, pa.int64())}


def blocks(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """block, doc_ids, sizes, codes, segments, counts: see :func:`block_of`."""
    kind, most = docs.schema["doc_id"].dataType, BLOCK_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, task, made = load(a_path, b_path), TaskContext.get().partitionId(), 0
        held, size = [], 0

        def block() -> pa.RecordBatch:
            own = block_of(pair, pa.concat_arrays([part.column("text") for part in held]))
            return pa.RecordBatch.from_pydict({
                "block": pa.array([task << 32 | made], pa.int64()), "doc_ids": in_list(pa.concat_arrays([part.column("doc_id") for part in held])),
                "sizes": pa.array([own["sizes"]], pa.binary()), "codes": pa.array([own["codes"]], pa.binary()), "segments": in_list(own["segments"]), "counts": in_list(own["counts"]),
            })

        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size >= most:
                yield block()
                held, size, made = [], 0, made + 1
        if size:
            yield block()

    bound_batches(docs.sparkSession)
    schema = f"block long, doc_ids array<{kind.simpleString()}>, sizes binary, codes binary, segments array<binary>, counts array<long>"
    return docs.select("doc_id", "text").mapInArrow(trimmed(run), schema)


FACTS = ["n_a", "n_b", "n_groups", "n_links", "groups"]
SUMS = ["n_best", "count_sum"]


def chunks(places: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Align the segments of (block, place, count, segment), rows of equal segments one after the other, some ``CHUNK_BYTES`` at a time.

    chunk, ``places`` (block, place and the number of the segment in the chunk), ``facts`` (what is known of each segment), and its distinct pairs with their links."""
    most = CHUNK_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, task, made = load(a_path, b_path), TaskContext.get().partitionId(), 0
        held, size = [], 0

        def chunk() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            coded = rows.column("segment").dictionary_encode()
            code = coded.indices.to_numpy()
            known = pair.align(coded.dictionary.to_pylist())
            weight = np.bincount(code, rows.column("count").to_numpy(), minlength=len(coded.dictionary)).astype(np.int64)  # exact below 2 ** 53
            pairs, at = np.unique(known["pairs"].values.to_numpy(), return_inverse=True)
            per = np.diff(known["pairs"].offsets.to_numpy())
            links = np.zeros(len(pairs), np.int64)
            np.add.at(links, at, np.repeat(weight, per))
            own = pa.RecordBatch.from_arrays([rows.column("block"), rows.column("place"), pa.array(code)], names=["block", "place", "code"])
            facts = pa.RecordBatch.from_arrays([*(known[n] for n in FACTS), pa.ListArray.from_arrays(known["pairs"].offsets, pa.array(at.astype(np.int32)))], names=[*FACTS, "pairs"])
            return pa.RecordBatch.from_pydict({
                "chunk": pa.array([task << 32 | made], pa.int64()), "places": pa.array([wrap(own)], pa.binary()), "facts": pa.array([wrap(facts)], pa.binary()),
                "pairs": in_list(pa.array(pairs)), "links": in_list(pa.array(links)),
            })

        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size >= most:
                yield chunk()
                held, size, made = [], 0, made + 1
        if size:
            yield chunk()

    schema = "chunk long, places binary, facts binary, pairs array<long>, links array<long>"
    return places.mapInArrow(trimmed(run), schema)


def align(docs: DataFrame, a_path: str, b_path: str, *, digest: bool = False, groups: bool = True) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum of each document, with its ``groups`` (``a1,a2|b1;a3|b2,b3``) or, with ``digest``, their hash."""
    held = stage_table(blocks(docs, a_path, b_path), "blocks")
    places = held.select("block", F.posexplode(F.arrays_zip("segments", "counts")).alias("place", "own"))
    places = places.select("block", "place", F.col("own.counts").alias("count"), F.col("own.segments").alias("segment"))
    # a segment has a row for each block that holds it, so none has more than one of that block's many rows
    told = stage_table(chunks(places.repartition("segment").sortWithinPartitions("segment"), a_path, b_path), "chunks")
    counted = told.select(F.inline(F.arrays_zip("pairs", "links"))).groupBy("pairs").agg(F.sum("links").alias("links"))
    top = F.max("links").over(Window.partitionBy(F.col("pairs").bitwiseAND(F.lit(LOW))))  # an id of B has as many rows as A has ids at most
    counts = stage_table(counted.select(F.col("pairs").alias("pair"), "links", (F.col("links") == top).alias("best")), "counts")
    forget_shuffles(docs.sparkSession)

    def by_chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from (parcels(b, "of_chunk", "place") for b in batches if b.num_rows)

    asked = told.select(F.col("chunk").alias("of_chunk"), F.posexplode("pairs").alias("place", "pair"))
    answers = asked.join(counts, "pair").select("of_chunk", "place", "links", "best").mapInArrow(trimmed(by_chunk), "of_chunk long, rows binary")

    def spread(left: pa.Table, right: pa.Table) -> pa.Table:
        """What each block is told of its segments."""
        own, facts, answer = unwrap(left.column("places")), unwrap(left.column("facts")), unwrap(right.column("rows")).sort_by("place")
        pairs = facts.column("pairs").combine_chunks()
        at, code, cuts = pairs.values.to_numpy(), own.column("code").to_numpy(), pairs.offsets.to_numpy()[:-1]
        for name, of in zip(SUMS, ("best", "links")):  # every segment has a pair
            value = answer.column(of).to_numpy().astype(np.int64)
            facts = facts.append_column(name, pa.array(np.add.reduceat(value[at], cuts)))
        rows = facts.drop_columns("pairs").take(pa.array(code)).append_column("of_block", own.column("block")).append_column("place", own.column("place"))
        return pa.Table.from_batches([parcels(rows.combine_chunks().to_batches()[0], "of_block", "place")])

    facts = told.select("chunk", "places", "facts").groupBy("chunk").cogroup(answers.groupBy("of_chunk")).applyInArrow(spread, "of_block long, rows binary")
    number = [*FACTS[:-1], *SUMS]

    def compose(left: pa.Table, right: pa.Table) -> pa.Table:
        own = unwrap(right.column("rows"))
        own = own and own.take(pa.array(np.argsort(own.column("place").to_numpy())))
        spelt = own.column("groups").to_pylist() if own else []
        out: dict[str, pa.Array] = {"doc_id": left.column("doc_ids").combine_chunks().flatten()}
        sizes = np.frombuffer(left.column("sizes")[0].as_py(), "<i8")
        codes = unsqueeze(left.column("codes")[0].as_py())
        lengths = np.maximum(sizes, 0)
        ends = np.cumsum(lengths)
        for name in number:
            total = np.concatenate([[0], np.cumsum(own.column(name).to_numpy()[codes])]) if own else np.zeros(1, np.int64)
            out[name] = pa.array(total[ends] - total[ends - lengths], pa.int64())
        if digest or groups:
            texts = []
            for size, end in zip(lengths.tolist(), ends.tolist()):
                text = b"".join(map(spelt.__getitem__, codes[end - size : end].tolist()))[:-1]
                texts.append(hashlib.sha256(text).hexdigest() if digest and text else text)
            out["groups_sha256" if digest else "groups"] = pa.array(texts, pa.binary()).cast(pa.string())
        return pa.table(out)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, " + ", ".join(f"{n} long" for n in number) + (", groups_sha256 string" if digest else ", groups string" if groups else "")
    return held.select("block", "doc_ids", "sizes", "codes").groupBy("block").cogroup(facts.groupBy("of_block")).applyInArrow(compose, schema)
