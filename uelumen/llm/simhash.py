"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two 64-bit fingerprints that differ in at most three bits have a word between them that is at most one flip from
one and two flips from the other. Every fingerprint emits its variants within half the radius; equal variants meet in a
shuffle. Two observations keep the balls small without losing a link:

* parity: fingerprints at distance 2 have equal parity and meet at one flip each; those at distance 1 or 3 have unequal
  parity, so only those of odd parity need the two-flip variants (and themselves);
* of three differing bits two lie in the same half, so two-flip variants within a half are enough: the one-flip
  variants of the other side supply the third bit.

That is 64 variants for a fingerprint of even parity and 1057 for one of odd parity. Those that share a variant with a
one-flip member are all within three bits of that member, so a colliding group becomes a star around it instead of all
its pairs; nothing is capped. Variants travel as sorted blocks by the leading bits of a bijective mix, about 10 bytes
each, to buckets whose number follows the count of fingerprints (``PER_BUCKET`` variants each): a variant and the number of the flips that
made it give the fingerprint back, so nothing else is sent.

:func:`keep_one` wants groups of at least 0.8 similarity on five-word shingles, which moves more than three bits of a
64-bit fingerprint. Beside the fingerprint of the whole text it therefore takes keys of samples of the shingles (the smallest under a hash of each
sample): 48 of 8 shingles, of which two such texts share one with probability 0.9998, and for short texts 20 of 4 (0.9999). A passage that
many documents share rarely fills a sample of 8 (one that makes up 40 % of a document, in one of 1,500 samples), so documents with nothing else in
common hardly meet. Fingerprints that share a key are candidates, verified on the whole texts: first all against one hub of each
key, then against hubs with most links, and, once hubs find few, every pair that the links do not connect yet. Of these the sketches (a bit for
each shingle, 8 to 16 bits a shingle) tell how many shingles two texts have in common at most, so only pairs that may be alike are asked; the others can't be. Sketches
meet within the keys in blocks of ``PAIR_BLOCK``, a hub's text its members in blocks of ``HUB_BLOCK``, so a hot key or hub is dealt over many tasks.

Defined results: null text is empty; a text of fewer words than a shingle is one shingle, one without words has
fingerprint zero and links like any other; repeated rows and equal texts share a fingerprint, so they share a
component; a null doc_id counts only if a component has no other; of rows of equal doc_id in one group the first in the input stays; further columns
are carried whatever their names (:func:`keep_one`) or not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uelumen.llm.common import forget_shuffles, map_texts, slices, stage_table, text_bytes, trimmed, whole_row
from uelumen.llm.components import components, local_stars

PER_BUCKET = 2_000_000
LEAST_BITS = 6
SHINGLE, SIMILAR = 5, 0.8
#: Samples: how many, of how many shingles, for texts of so many shingles; both kinds where the ranges overlap by more than 0.8.
SAMPLES = ((20, 4, 0, 64), (48, 8, 48, 1 << 62))
AT_ONCE = 1 << 18
BLOCK = 4096
HUB_BLOCK = 256
PAIR_BLOCK = 256
SKETCH_BITS = 1 << 16
MIX = np.uint64(0x9E3779B97F4A7C15)
UNMIX = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
ONE_FLIP = np.array([1 << i for i in range(64)], np.uint64)
TWO_FLIPS = np.array([0] + [1 << i | 1 << j for half in (range(32), range(32, 64)) for i, j in combinations(half, 2)], np.uint64)
FLIPS = np.concatenate([ONE_FLIP, TWO_FLIPS])


def fingerprint(text: bytes, size: int = 3) -> int:
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < size:
        return xxhash.xxh64_intdigest(b" ".join(words), 42)
    n = len(words) - size + 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter([digest(s, 42) for s in map(b" ".join, zip(*(words[i:] for i in range(size))))], np.uint64, n)
    counts = np.zeros(64, np.int64)
    for i in range(0, n, 8192):
        part = hashes[i : i + 8192]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


_SEEDS = np.random.default_rng(1).integers(1, 2**63, size=(sum(n for n, *_ in SAMPLES), 1), dtype=np.uint64) | np.uint64(1)


def shingles(text: bytes) -> np.ndarray:
    """Distinct hashes of the five-word shingles (a shorter text is one)."""
    words = text.lower().split()
    parts = map(b" ".join, zip(*(words[i:] for i in range(SHINGLE)))) if len(words) >= SHINGLE else [b" ".join(words)]
    return np.unique(np.array([xxhash.xxh64_intdigest(p, 42) for p in parts], np.uint64))


def samples(text: bytes) -> list[int]:
    """A key of each sample of the shingles, as signed longs that also tell the sample."""
    own, first, keys = shingles(text), 0, []
    for count, size, least, most in SAMPLES:
        if least <= len(own) <= most:
            take, step = min(size, len(own)), max(1, AT_ONCE // len(own))
            for at in range(first, first + count, step):
                seeds = _SEEDS[at : min(at + step, first + count)]
                mixed = (own ^ (own >> np.uint64(31))) * seeds
                mixed = (mixed ^ (mixed >> np.uint64(29))) * MIX
                mixed.partition(take - 1, axis=1)
                chosen = mixed[:, :take]  # the hash of a sample is one to one, so its smallest values tell the shingles
                total = (chosen ^ (chosen >> np.uint64(32))).sum(axis=1, dtype=np.uint64)
                keys.append((total * MIX ^ (total >> np.uint64(32))) * seeds.ravel())
        first += count
    return np.concatenate(keys).view(np.int64).tolist()


def fingerprints(docs: DataFrame, *, size: int = 3, rows: bool = False) -> DataFrame:
    """doc_id and ``fp`` (the 64 bits as a signed long) of each row; with ``rows`` the row too, as ``ul_row``, and its sample fingerprints."""
    source = whole_row(docs, doc_id=F.col("doc_id"), ul_text=F.col("text"))
    source = source if rows else source.drop("ul_row")

    def kernel(batch: pa.RecordBatch) -> dict:
        out = {n: batch.column(n) for n in batch.schema.names if n != "ul_text"}
        bits = np.array([fingerprint(t, size) for t in text_bytes(batch.column("ul_text"))], np.uint64)
        out["fp"] = pa.array(bits.view(np.int64))
        if rows:
            out["samples"] = pa.array([samples(t) for t in text_bytes(batch.column("ul_text"))], pa.list_(pa.int64()))
        return out

    carried = ", ".join(f"{c.name} {c.dataType.simpleString()}" for c in source.schema if c.name != "ul_text")
    return map_texts(source, kernel, f"{carried}, fp long" + ", samples array<long>" * rows)


def mix(v: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose leading bits depend on all."""
    v = v * MIX
    v = (v ^ (v >> np.uint64(32))) * MIX
    return v


def unmix(v: np.ndarray) -> np.ndarray:
    v = v * UNMIX
    return (v ^ (v >> np.uint64(32))) * UNMIX


def variants(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mixed variants of each fingerprint, and the number of the flips of each."""
    odd = fps[(np.bitwise_count(fps) & 1).astype(bool)]
    near, far = fps[:, None] ^ ONE_FLIP, odd[:, None] ^ TWO_FLIPS
    flips = np.concatenate([np.tile(np.arange(64, dtype=np.uint16), len(fps)), np.tile(np.arange(64, len(FLIPS), dtype=np.uint16), len(odd))])
    return mix(np.concatenate([near.ravel(), far.ravel()])), flips


def _planes(a: np.ndarray) -> bytes:
    """Byte planes, the leading bytes first: those of sorted words compress in the shuffle."""
    return np.ascontiguousarray(a.view(np.uint8).reshape(len(a), -1).T[::-1]).tobytes()


def _unplane(raw: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, -1)[::-1].T).view(kind).ravel()


def emit(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = batch.column(0).to_numpy().view(np.uint64)
            for at in range(0, len(every), BLOCK):
                keys, flips = variants(every[at : at + BLOCK])
                order = np.argsort(keys)
                keys, flips = keys[order], flips[order]
                edges = np.searchsorted(keys, np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits))
                cuts = [0, *edges.tolist(), len(keys)]
                rows = [(b, i, j) for b, (i, j) in enumerate(zip(cuts, cuts[1:])) if i < j]
                yield pa.RecordBatch.from_pydict({
                    "bucket": pa.array([b for b, _, _ in rows], pa.int32()),
                    "keys": pa.array([_planes(keys[i:j]) for _, i, j in rows], pa.binary()),
                    "flips": pa.array([_planes(flips[i:j]) for _, i, j in rows], pa.binary()),
                })

    return trimmed(run)


def collide(table: pa.Table) -> pa.Table:
    """Stars between the fingerprints of one bucket that share a variant, verified."""
    parts = [(_unplane(k, np.uint64), _unplane(f, np.uint16)) for k, f in zip(*(table.column(n).to_pylist() for n in ("keys", "flips")))]
    key, flips = (np.concatenate(x) for x in zip(*parts))
    fp = unmix(key) ^ FLIPS[flips]
    order = np.argsort(key, kind="stable")
    key, fp = key[order], fp[order]
    same = key[1:] == key[:-1]
    member = np.zeros(len(key), bool)
    member[1:] |= same
    member[:-1] |= same
    key, fp = key[member], fp[member]
    pairs = np.zeros((0, 2), np.int64)
    if len(key):
        group = np.cumsum(np.concatenate([[True], key[1:] != key[:-1]])) - 1
        odd = (np.bitwise_count(fp) & 1).astype(bool)
        evens = np.bincount(group, weights=~odd) > 0
        # around an even member where there is one (all others are within three bits of it); without one, the
        # group is either all one-flip variants of odd members or all two-flip variants, which need no link
        candidate = np.where(evens[group], ~odd, True)
        at = np.flatnonzero(candidate)
        first = at[np.unique(group[at], return_index=True)[1]]
        centre = fp[first][group]
        near = (np.bitwise_count(centre ^ fp) <= 3) & (centre != fp)
        pairs = np.stack([centre[near].view(np.int64), fp[near].view(np.int64)], axis=1)
        pairs = np.unique(pairs, axis=0)
    star = [(x, r) for x, r in local_stars(map(tuple, pairs.tolist())).items() if x != r]
    return pa.table({"a": pa.array([x for x, _ in star], pa.int64()), "b": pa.array([r for _, r in star], pa.int64())})


def links(fps: DataFrame) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column fp) whose components are those of all pairs within three bits."""
    count = fps.count()
    bits = max(LEAST_BITS, int(np.ceil(np.log2(max(1, count * 561 / PER_BUCKET)))))
    blocks = fps.mapInArrow(emit(bits), "bucket int, keys binary, flips binary")
    return blocks.groupBy("bucket").applyInArrow(collide, "a long, b long")


def cluster(table: DataFrame, more: DataFrame | None = None) -> DataFrame:
    """(fp, component_id) for each fingerprint of a staged table with doc_id and fp, ``more`` being further edges."""
    smallest = stage_table(table.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "fps")
    edges = links(smallest.select("fp"))
    roots = components(edges if more is None else edges.union(more)).withColumnRenamed("node", "fp")
    rooted = smallest.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    rooted = stage_table(rooted, "roots")
    whole = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return rooted.join(whole, "root").select("root", "fp", "component_id")


def similar(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two sets of shingles are alike."""
    if min(len(x), len(y)) < SIMILAR * max(len(x), len(y)):
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both >= SIMILAR * (len(x) + len(y) - both)


def sketch(own: np.ndarray) -> bytes:
    """A bit for the trailing bits of each shingle, in a power of two of at least 8 bits a shingle (64 at least, ``SKETCH_BITS`` at most)."""
    bits = np.zeros(min(SKETCH_BITS, max(64, 1 << (8 * len(own) - 1).bit_length())), np.uint8)
    bits[own & np.uint64(len(bits) - 1)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def may_be_alike(sketches: list[bytes], counts: np.ndarray, roots: np.ndarray, second: np.ndarray, *, apart: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs of different roots whose sketches don't rule out that they are alike; ``apart``: only of one that is second and one that isn't.

    A shingle whose bit the other sketch lacks isn't in the other text: a text has as many of these at least as it has such bits. Alike texts have
    sketches of one width or of neighbouring ones; a wider one is folded.
    """
    widths = np.fromiter(map(len, sketches), np.int64, len(sketches))
    words = lambda at, width: np.frombuffer(b"".join(sketches[i] for i in at.tolist()), np.uint64).reshape(len(at), width // 8)
    out: list[tuple[np.ndarray, np.ndarray]] = []
    for width in np.unique(widths).tolist():
        same, wide = np.flatnonzero(widths == width), np.flatnonzero(widths == 2 * width)
        folded = words(wide, 2 * width).reshape(len(wide), 2, width // 8)
        at, grid = np.concatenate([same, wide]), np.concatenate([words(same, width), folded[:, 0] | folded[:, 1]])
        n, root, side, place = counts[at], roots[at], second[at], np.arange(len(at))
        loose = n - np.bitwise_count(grid).sum(axis=1, dtype=np.int64)
        step = max(1, AT_ONCE // grid.size)
        for i in range(0, len(same), step):
            own = slice(i, min(i + step, len(same)))
            both = np.bitwise_count(grid[own, None] & grid).sum(axis=2, dtype=np.int64)
            most = both + np.minimum(loose[own, None], loose)
            ok = (most >= SIMILAR * (n[own, None] + n - most)) & (root[own, None] != root) & (place[own, None] < place)
            if apart:
                ok &= side[own, None] != side
            x, y = np.nonzero(ok)
            out.append((at[x + i], at[y]))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _may_be_alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows by key and blocks i, j, the pairs (a, b) that may be alike."""

    def pairs(part: pa.RecordBatch, cuts: list[int], blocks: np.ndarray) -> pa.RecordBatch:
        fp, root, counts, second = (part.column(n).to_numpy(zero_copy_only=False) for n in ("fp", "root", "shingles", "second"))
        sketches, found = part.column("sketch").to_pylist(), set()
        for i, j in zip(cuts, cuts[1:]):
            x, y = may_be_alike(sketches[i:j], counts[i:j].astype(np.int64), root[i:j], second[i:j], apart=blocks[0, i] != blocks[1, i])
            x, y = fp[i:j][x], fp[i:j][y]
            found.update(zip(np.minimum(x, y).tolist(), np.maximum(x, y).tolist()))
        return pa.RecordBatch.from_pydict({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        (part,) = pa.Table.from_batches([*rest, batch]).combine_chunks().to_batches()
        key, *blocks = (part.column(n).to_numpy() for n in ("key", "i", "j"))
        new = (key[1:] != key[:-1]) | (blocks[0][1:] != blocks[0][:-1]) | (blocks[1][1:] != blocks[1][:-1])
        cuts = [0, *(np.flatnonzero(new) + 1).tolist()]
        if len(cuts) > 1:
            yield pairs(part, cuts, np.stack(blocks))
        rest = [part.slice(cuts[-1])]  # the last group may go on in the next batch
    for part in rest:
        yield pairs(part, [0, part.num_rows], np.stack([part.column(n).to_numpy() for n in ("i", "j")]))


def possible_pairs(members: DataFrame, text: DataFrame) -> DataFrame:
    """(a, b): the pairs of members (key, fp, root) that share a key, have different roots and may be alike, each once."""

    def kernel(batch: pa.RecordBatch) -> dict:
        own = [shingles(t) for t in text_bytes(batch.column("text"))]
        return {"fp": batch.column("fp"), "shingles": pa.array(list(map(len, own)), pa.int64()), "sketch": pa.array(list(map(sketch, own)), pa.binary())}

    sketches = map_texts(text.join(members.select("fp").distinct(), "fp", "left_semi").select("fp", "text"), kernel, "fp long, shingles long, sketch binary")
    sketches = stage_table(sketches, "sketches")
    sizes = members.groupBy("key").agg(F.ceil(F.count("*") / PAIR_BLOCK).cast("int").alias("blocks"))
    dealt = members.join(sizes, "key").withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).alias("second"), "fp", "root")
    rows = dealt.join(sketches, "fp").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return rows.mapInArrow(trimmed(_may_be_alike), "a long, b long").distinct()


def _alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows by hub and block, the hub's first, the (hub, member) that are alike."""
    block, own = None, None
    for batch in batches:
        for part in slices(batch):
            found = []
            for hub, no, member, first, text in zip(*(part.column(n).to_pylist() for n in ("hub", "block", "member", "first")), text_bytes(part.column("text"))):
                if first:
                    block, own = (hub, no), shingles(text)
                elif block == (hub, no) and similar(own, shingles(text)):
                    found.append((hub, member))
            if found:
                yield pa.RecordBatch.from_pydict({"a": pa.array([min(p) for p in found], pa.int64()), "b": pa.array([max(p) for p in found], pa.int64())})


def _ask(pairs: DataFrame, text: DataFrame) -> DataFrame:
    """Those of the pairs (a, b, hub) whose whole texts are alike; (a, b) in order."""
    oriented = pairs.select("hub", F.when(F.col("hub") == F.col("a"), F.col("b")).otherwise(F.col("a")).alias("member"))
    hubs = stage_table(oriented.groupBy("hub").agg(F.ceil(F.count("*") / HUB_BLOCK).cast("int").alias("blocks")), "hubs")
    members = oriented.join(hubs, "hub").withColumn("block", F.pmod(F.xxhash64("member"), F.col("blocks")).cast("int")).withColumn("first", F.lit(False))
    heads = hubs.withColumn("member", F.col("hub")).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("first", F.lit(True))
    names = ["hub", "block", "member", "first"]
    asked = members.select(names).unionByName(heads.select(names))
    rows = asked.join(text.withColumnRenamed("fp", "member"), "member").repartition("hub", "block").sortWithinPartitions("hub", "block", F.desc("first"))
    return stage_table(rows.mapInArrow(trimmed(_alike), "a long, b long"), "sampled")


def _still_open(shared: DataFrame, found: DataFrame) -> tuple[DataFrame, int]:
    """The members, with root and number of links, of the keys whose members are in several components, and the number of pairs across these."""
    ends = found.select(F.col("a").alias("fp")).union(found.select(F.col("b").alias("fp")))
    state = components(found).withColumnRenamed("node", "fp").join(ends.groupBy("fp").agg(F.count("*").alias("degree")), "fp")
    members = shared.join(state, "fp", "left").select("key", "fp", F.coalesce("root", "fp").alias("root"), F.coalesce("degree", F.lit(0)).alias("degree"))
    members = stage_table(members, "members")
    sizes = members.groupBy("key", "root").agg(F.count("*").alias("n")).groupBy("key").agg(F.expr("(sum(n) * sum(n) - sum(n * n)) div 2").alias("across"))
    sizes = stage_table(sizes.filter("across > 0"), "across")
    return members.join(sizes.select("key"), "key", "left_semi"), sizes.agg(F.sum("across")).first()[0] or 0


def sampled_links(table: DataFrame) -> DataFrame:
    """Verified edges between fingerprints that share a sample fingerprint, from a table with ul_id, fp, samples and ul_row.text.

    Their components are those of all alike pairs that share a key: a pair is left out only if the edges connect it already.
    """
    keys = table.select("fp", F.explode("samples").alias("key")).distinct()
    several = keys.groupBy("key").agg(F.min("fp").alias("low"), F.max("fp").alias("top")).filter("low < top")
    shared = stage_table(keys.join(several.select("key"), "key", "left_semi"), "shared")
    chosen = table.groupBy("fp").agg(F.min("ul_id").alias("ul_id")).join(shared.select("fp").distinct(), "fp", "left_semi").select("ul_id")
    text = table.select("ul_id", "fp", F.col("ul_row.text").alias("text")).join(chosen, "ul_id", "left_semi").select("fp", "text")
    text = stage_table(text, "texts")
    members = shared.select("key", "fp", F.col("fp").alias("root"), F.lit(0).alias("degree"))
    found = asked = None
    few = shared.count()
    while True:
        # against one of each key, that with most links so far: the original of many copies comes second at the latest
        other = members.groupBy("key").agg(F.max_by(F.struct(F.col("fp").alias("hub"), F.col("root").alias("root2")), F.struct("degree", "fp")).alias("h")).select("key", "h.*")
        ends = members.join(other, "key").filter("root <> root2").select(F.least("fp", "hub").alias("a"), F.greatest("fp", "hub").alias("b"), "hub")
        pairs = ends.groupBy("a", "b").agg(F.max("hub").alias("hub"))
        pairs = stage_table(pairs if asked is None else pairs.join(asked.select("a", "b"), ["a", "b"], "left_anti"), "pairs")
        new = _ask(pairs, text)
        asked, found = (pairs, new) if asked is None else (asked.union(pairs), found.union(new))
        members, left = _still_open(shared, found)
        if not left:
            return found
        if left * new.count() <= few * pairs.count():  # at the rate of this round few links are left: the rest by sketches, pair by pair
            rest = possible_pairs(members, text).join(asked.select("a", "b"), ["a", "b"], "left_anti").withColumn("hub", F.col("b"))
            return found.union(_ask(stage_table(rest, "pairs"), text))


def near_duplicates(docs: DataFrame, *, size: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (the smallest doc_id within reach) of each row."""
    table = stage_table(fingerprints(docs, size=size), "fingerprints")
    return table.join(cluster(table), "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, *, size: int = 3) -> DataFrame:
    """One row of each group, in the columns of ``docs``: that of the smallest doc_id, one of equals."""
    table = fingerprints(docs, size=size, rows=True).withColumn("ul_id", F.monotonically_increasing_id())
    table = stage_table(table, "fingerprints")
    more = sampled_links(table)
    forget_shuffles(docs.sparkSession)  # those of the texts, before the variants come
    joined = table.select("ul_id", "doc_id", "fp").join(cluster(table, more), "fp")
    best = joined.groupBy("root").agg(F.min_by("ul_id", F.struct(F.col("doc_id").isNull(), "doc_id", "ul_id")).alias("ul_id"))
    best = stage_table(best, "best")
    forget_shuffles(docs.sparkSession)  # those of the variants, before the rows are dealt
    return table.join(best.select("ul_id"), "ul_id", "left_semi").select("ul_row.*")
