"""Token alignment, centroid clustering and packing against plain versions: nulls, empty and long texts, ties, repeats, clashing names."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from uelumen.llm import align, centroids, packing
from uelumen.llm.bpe import _byte_chars

A, B, VOCAB = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model", "word_bpe_49k.json"))
RNG = random.Random(11)
WORDS = ["".join(RNG.choice("abcdeéilmnößrstu") for _ in range(RNG.randint(1, 9))) for _ in range(200)]
PROSE = [" ".join(RNG.choices(WORDS, k=RNG.randint(5, 90))) for _ in range(40)]
ODD = [
    None, "", " ", "  ", "\n", "\n\n", "a\n b", "▁a", "a▁", "a\t\tb", "a\r\nb;\r\nc", "a  b", "x   y", "x   y", "　 　x", "<s> <|endoftext|> </s>", "it's 's",
    " \n \n a \n b  \n", "日本 語  本", "\x00 \x01", "é  é\n", "x\x1c y", "\x85 a \x85b", "x᠎ y", "a\x0bb\x0c c", "end \t", "😀 😀", "a" * 5000, " " * 70, "<0x0A>",
]
COLUMNS = "doc_id long, text string, block long, segment string, bin int"


def table(spark, texts, ids=None):
    return spark.createDataFrame([(i, t, 1, "x", 2) for i, t in zip(ids or range(len(texts)), texts)], COLUMNS)


def ends(tokens):
    return np.cumsum([len(t) for t in tokens]).tolist()


def plain_alignment(texts):
    """Whole texts through both libraries, no segments; a dict of columns for each text."""
    a, b = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    byte_of = {c: i for i, c in enumerate(_byte_chars())}
    rows, count = [], Counter()
    for text in texts:
        own_a = a.encode(" " + (text or ""), add_special_tokens=False).ids
        own_b = b.encode(text or "")
        raw_a = [bytes(byte_of[c] for c in a.id_to_token(i)) for i in own_a]
        raw_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in own_b]
        if not text or not b"".join(raw_a) == b"".join(raw_b) == (" " + text).encode():
            rows.append(([], [], [], ""))
            continue
        end_a, end_b = ends(raw_a), ends(raw_b)
        links = [(i, j) for i, e, x in zip(own_a, end_a, raw_a) for j, f, y in zip(own_b, end_b, raw_b) if max(e - len(x), f - len(y)) < min(e, f)] if len(own_a) < 400 else None
        if links is None:
            links, j = [], 0
            for i, e, x in zip(own_a, end_a, raw_a):
                while end_b[j] <= e - len(x):
                    j += 1
                k = j
                while k < len(end_b) and end_b[k] - len(raw_b[k]) < e:
                    links.append((i, own_b[k]))
                    k += 1
        groups, last = [], 0
        for cut in sorted(set(end_a) & set(end_b)):
            groups.append(",".join(str(i) for i, e in zip(own_a, end_a) if last < e <= cut) + "|" + ",".join(str(i) for i, e in zip(own_b, end_b) if last < e <= cut))
            last = cut
        count.update(links)
        rows.append((own_a, own_b, links, ";".join(groups)))
    best = Counter()
    for (_, j), n in count.items():
        best[j] = max(best[j], n)
    return [
        {"n_a": len(x), "n_b": len(y), "n_groups": g.count("|"), "n_links": len(ls), "n_best": sum(count[p] == best[p[1]] for p in ls), "count_sum": sum(count[p] for p in ls), "groups": g}
        for x, y, ls, g in rows
    ]


def test_alignment(spark):
    texts = [*ODD, *PROSE, PROSE[0], " ".join(RNG.choices(WORDS, k=800)) + "\n" + PROSE[1]]
    ids = [None, None, *range(len(texts) - 2)]
    found = align.align(table(spark, texts, ids), A, B).collect()
    want = [(i, *w.values()) for i, w in zip(ids, plain_alignment(texts))]
    assert sorted(map(tuple, found), key=str) == sorted(want, key=str)
    hashed = align.align(table(spark, texts, ids), A, B, digest=True).collect()
    assert sorted((r.doc_id or -1, r.groups_sha256) for r in hashed) == sorted((i or -1, hashlib.sha256(w[-1].encode()).hexdigest() if w[-1] else "") for i, w in zip(ids, want))
    assert align.align(table(spark, []), A, B).count() == 0


def test_alignment_over_several_blocks(spark, monkeypatch):
    texts = [*PROSE, *PROSE, *ODD]
    pair = align.load(A, B)
    parts = [align.block_of(pair, pa.array([t], pa.string())) for t in texts]
    for t, own in zip(texts, parts):
        segments = [bytes(x.as_py()) for x in own["segments"]]
        back = b"".join(segments[c] for c in align.unsqueeze(own["codes"]))
        assert back == (b"" if not t or "▁" in t else b" " + t.encode())
    monkeypatch.setattr(align, "BLOCK_BYTES", 400)
    monkeypatch.setattr(align, "CHUNK_BYTES", 500)
    many = align.align(table(spark, texts).repartition(9), A, B).drop("doc_id").collect()
    assert sorted(map(tuple, many)) == sorted(tuple(w.values()) for w in plain_alignment(texts))


def test_safe_cuts():
    safe = align.load(A, B).safe
    assert [c for c in b" \t\n\v\f\r" if safe[c]] == [*b" \t\n\v\f"]  # pieces such as ";\r" reach across a carriage return


def plain_means(rows, k, rounds, dim, scale):
    kept = [(i, [int(np.floor(scale * float(x))) for x in v]) for i, v in rows if v is not None and len(v) == dim and all(x is not None and np.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), np.array(r[1], "<i4").tobytes()))
    cents = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((x - y) ** 2 for x, y in zip(v, c)), j) for j, c in enumerate(cents))

    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in kept]
        cents = [[sum(x) // len(x) for x in zip(*(v for (_, v), o in zip(kept, own) if o == j))] or c for j, c in enumerate(cents)]
    own = [nearest(v) for _, v in kept]
    inertia = Counter()
    for d, j in own:
        inertia[j] += d
    return [(i, j, d, inertia[j], sum(inertia.values()), hashlib.sha256(",".join(map(str, cents[j])).encode()).hexdigest(), cents[j]) for (i, _), (d, j) in zip(kept, own)]


VECTORS = "vec_id long, embedding array<float>, cluster string, was int"


@pytest.mark.parametrize("scale, n", [(64, 300), (1, 300), (64, 5), (64, 0), (1 << 20, 40)])
def test_clustering(spark, scale, n):
    rng = np.random.default_rng(scale + n)
    centers = rng.normal(0, 1, (6, 8))
    rows = [(i, [float(np.float32(x)) for x in centers[i % 6] + rng.normal(0, 0.3, 8)], "c", 0) for i in range(n)]
    if n:
        rows += [(None, rows[0][1], "c", 0), (3, rows[1][1], "c", 0), (3, rows[1][1], "c", 0), (900, None, "c", 0), (901, [1.0] * 7, "c", 0), (902, [None] + [1.0] * 7, "c", 0)]
        rows += [(903, [float("nan")] + [1.0] * 7, "c", 0), (904, [float("inf")] + [1.0] * 7, "c", 0), (905, [], "c", 0)]
    got = centroids.cluster(spark.createDataFrame(rows, VECTORS), k=7, rounds=4, dim=8, scale=scale).collect()
    assert sorted(map(tuple, got), key=str) == sorted(plain_means([r[:2] for r in rows], 7, 4, 8, scale), key=str)


def test_bounds_hold_and_spare_distances():
    rng = np.random.default_rng(1)
    centers = rng.normal(0, 1, (16, 64))
    for scale in (64, 1):  # with 1 most distances tie
        v = np.floor(scale * (centers[rng.integers(0, 16, 3000)] + rng.normal(0, 0.2, (3000, 64)))).astype(int)
        c, took = v[:16].copy(), []
        own = centroids.Bounds.scan(v, c, 4)
        for _ in range(7):
            new = np.array([v[own.cluster == j].sum(axis=0) // max(1, (own.cluster == j).sum()) if (own.cluster == j).any() else c[j] for j in range(16)])
            moves, c = np.sqrt(((new - c) ** 2).sum(axis=1)) * centroids.UP, new
            took.append(own.follow(v, c, moves))
            d = ((v[:, None] - c[None]) ** 2).sum(axis=2)
            assert np.array_equal(d.argmin(axis=1), own.cluster)
            assert (own.upper**2 >= d.min(axis=1) * (1 - 1e-12)).all()
            assert (own.lower[:, :4] <= np.sqrt(np.take_along_axis(d, own.near, 1))).all()
            known = np.column_stack([own.cluster, own.near])
            rest = np.where((np.arange(16)[None, :, None] == known[:, None, :]).any(axis=2), np.inf, np.sqrt(d))
            assert (own.lower[:, 4] <= rest.min(axis=1)).all()
        if scale == 64:
            assert took[-1] < 2 * len(v)  # of 16 distances each


def test_component_too_large(spark):
    with pytest.raises(Exception, match="don't fit a long"):
        centroids.cluster(spark.createDataFrame([(1, [1e30] * 8)], "vec_id long, embedding array<float>"), dim=8).collect()


@pytest.mark.parametrize("parts, node_rows, slack", [(1, 200_000, 4), (9, 200_000, 4), (9, 40, 4), (9, 15, 0)])
def test_packing(spark, monkeypatch, parts, node_rows, slack):
    monkeypatch.setattr(packing, "NODE_ROWS", node_rows)
    library = Tokenizer.from_file(VOCAB)
    texts = [None, "", " ", *PROSE, *PROSE, " ".join(RNG.choices(WORDS, k=900)), "x " * 63, "x " * 64, "x " * 127, "x " * 128]
    ids = [None, *range(5), *range(5), *range(20, 20 + len(texts) - 11)]
    capacity = 64
    rows = packing.pack(table(spark, texts, ids).repartition(parts), VOCAB, capacity=capacity, slack=slack, ids=True).collect()
    want = Counter()
    for i, t in zip(ids, texts):
        whole = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        for piece, start in enumerate(range(0, len(whole), capacity)):
            raw = np.array(whole[start : start + capacity], "<u4").tobytes()
            want[i, piece, start, len(raw) // 4, zlib.crc32(raw), raw] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, bytes(r.ids)) for r in rows) == want
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    best = packing.best_fit(np.array([r.length for r in rows]), capacity)[2]
    assert len(bins) <= len(best) * (1.03 if node_rows > 1000 else 1.25) + 1
    assert packing.pack(table(spark, []), VOCAB).count() == 0


def test_packing_where_no_two_fit(spark, monkeypatch):
    monkeypatch.setattr(packing, "NODE_ROWS", 10)
    rows = packing.pack(table(spark, ["x " * 40] * 60).repartition(6), VOCAB, capacity=64).collect()
    assert len({r.sequence_id for r in rows}) == 60 and {r.offset for r in rows} == {0}


def test_best_fit():
    rng = np.random.default_rng(5)
    for _ in range(20):
        sizes = rng.integers(1, 65, 200)
        bins, places, fill = packing.best_fit(sizes, 64)
        seen = {}
        for i in np.argsort(-sizes, kind="stable").tolist():
            fits = [f for f in seen.values() if f + sizes[i] <= 64]
            own = seen.get(bins[i], 0)
            assert own == (max(fits) if fits else 0) == places[i]
            seen[bins[i]] = own + sizes[i]
        assert fill.tolist() == [seen[b] for b in range(len(fill))]
