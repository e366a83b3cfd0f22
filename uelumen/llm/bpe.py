"""BPE encoding by speculation and verification, and decoding; all steps on arrays of many words at once.

A word is cut greedily from the left into the longest tokens of the vocabulary. That cut is the BPE result exactly if every
token is the BPE result of its own string and every two neighbours are *compatible*, that is, the BPE of their
joined string is those two tokens: as long as no merge crosses a token border, the merges inside two
neighbours happen in the order in which they happen when the two stand alone, so the first crossing merge of
the whole word would also be the first crossing merge of the pair.

Proposals: at each border the longest token comes first; if it is not compatible with the token before, the next shorter one
is proposed, and where none is the token before is shortened, up to ``TRIES`` times a word. Verification: the merges of both tokens are undone in reverse order, always the later one, and each
two pieces that then meet at the border must have no merge of their own before the one undone last. Only words that
fail then are merged exactly, all of them in step: the pair of the lowest rank of each word at a time.

Plain texts (Latin letters and general punctuation, no special strings) are lower-cased and cut into words as whole arrays of bytes, some ``CHUNK`` bytes of
text at a time (long texts in parts): a word begins where the kind of character changes, at each number and after a contraction. Arrow numbers the words, each different one
is looked at once, and the ids of the texts are gathered from those of the words. Words repeat, so those of the chunk before are kept.

Of other texts the runs between ASCII white space are numbered in the same way, and cut by the patterns. A worker keeps the ids of the runs that it has seen lately, in two generations of at
most ``CACHE_BYTES`` each (plus the runs of one chunk). Words and runs are let go at the end of each task.

Defined results: null text is empty and has no tokens; the special strings of the vocabulary become their ids as in
the library; texts are read whole; repeated rows are each encoded; an empty table gives an empty result; only the columns
doc_id and text are read, whatever others there are. There are no ties: of pairs of equal rank the leftmost is merged first.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from uelumen.llm.common import map_texts
from uelumen.llm.lookup import FREE, Lookup

CACHE_BYTES = 24 << 20
ENTRY_BYTES = 200
CHUNK = 4 << 20
AT_ONCE = 40_000
LONG = 64
TRIES = 24
VERDICT_BITS = 18
MARK = b"\xff\xff\xff\xff"  # no id: it stays the only one whose last byte isn't zero
END = "</w>"
STOP = 0xFF
LAST = np.int32(2**31 - 1)
PLAIN_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"  # what _cut_words does
WHITE = [b" ", b"\t", b"\n", b"\v", b"\f", b"\r"]
SPACE, LETTER, NUMBER, OTHER, ODD = range(5)


def _byte_chars() -> list[str]:
    """The printable stand-in of each byte, a fixed table of the file format: itself where printable, else the next free code point from 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    free = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(free)) for b in range(256)]


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a.astype(np.int64) << 32 | b


class Bpe:
    """A tokenizer file of kind BPE with word ends, its normaliser and its word pattern."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.path = path
        vocab: dict[str, int] = spec["model"]["vocab"]
        merges = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.splitter = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.word = regex.compile(pattern)
        ascii_pattern = pattern.replace(r"\p{L}", "a-zA-Z").replace(r"\p{N}", "0-9")
        self.ascii_word = re.compile(ascii_pattern.encode())
        self.lines, self.ascii_lines = regex.compile(pattern + "|\n"), re.compile((ascii_pattern + "|\n").encode())
        self.plain = pattern == PLAIN_PATTERN
        self.stand_in = _byte_chars()
        self.byte_of = {c: i for i, c in enumerate(self.stand_in)}
        self.base = np.array([vocab[c] for c in self.stand_in], np.int32)
        self.base_end = np.array([vocab[c + END] for c in self.stand_in], np.int32)
        self.size = 1 + max([*vocab.values(), *self.special.values()])
        names = [""] * self.size
        for text, i in [*vocab.items(), *self.special.items()]:
            names[i] = text
        self.names = pa.array(names, pa.string())

        made = np.array([[vocab[a], vocab[b], vocab[a + b]] for a, b in merges], np.int32).reshape(-1, 3)
        if len(np.unique(made[:, 2])) != len(made):
            raise ValueError(f"{path}: two merges make the same token")
        self.ranks = Lookup(_pair(made[:, 0], made[:, 1]), np.arange(len(made), dtype=np.int32))
        self.made = made[:, 2].copy()
        self.rank_of = np.full(self.size, -1, np.int32)  # of the merge that makes a token; symbols have none
        self.rank_of[made[:, 2]] = np.arange(len(made))
        self.left, self.right = np.arange(self.size, dtype=np.int32), np.arange(self.size, dtype=np.int32)
        self.left[made[:, 2]], self.right[made[:, 2]] = made[:, 0], made[:, 1]
        self._grow_trie(names, self._sound(made))
        self._library: Tokenizer | None = None
        self.verdict_keys, self.verdicts = np.full(1 << VERDICT_BITS, FREE), np.zeros(1 << VERDICT_BITS, bool)
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.held = 0
        self.known: tuple[pa.Array, np.ndarray, np.ndarray] | None = None  # the words of the chunk before, their ids and how many each has
        self.words = self.settled = self.at_first = 0

    @property
    def library(self) -> Tokenizer:
        """Only its normaliser and word splitter, for letters that Unicode versions disagree on."""
        self._library = self._library or Tokenizer.from_file(self.path)
        return self._library

    def _sound(self, made: np.ndarray) -> list[int]:
        """The tokens that are the BPE result of their own string: no merge crosses their two halves before the last one."""
        rank = np.arange(len(made), dtype=np.int32)
        alone = self._apart(made[:, 0], made[:, 1], rank)
        good = np.ones(self.size, bool)
        for ok, (a, b, own) in zip(alone.tolist(), made.tolist()):
            good[own] = ok and good[a] and good[b]
        symbols = [*self.base.tolist(), *self.base_end.tolist()]
        return [*symbols, *(i for i in made[:, 2].tolist() if good[i])]

    def _grow_trie(self, names: list[str], tokens: list[int]) -> None:
        """Tokens by their bytes; a word end is the byte ``STOP``, which no text has."""
        spelt = [bytes(map(self.byte_of.__getitem__, names[i].removesuffix(END))) + bytes([STOP]) * names[i].endswith(END) for i in tokens]
        sizes = np.array(list(map(len, spelt)))
        grid = np.zeros((len(spelt), int(sizes.max())), np.int64)
        for i, s in enumerate(spelt):
            grid[i, : len(s)] = list(s)
        node, parents, keys = np.zeros(len(spelt), np.int64), [np.zeros(1, np.int64)], []
        total = 1
        for depth in range(grid.shape[1]):
            live = np.flatnonzero(sizes > depth)
            new, back = np.unique(node[live] << 8 | grid[live, depth], return_inverse=True)
            keys.append(new)
            parents.append(new >> 8)
            node[live] = total + back
            total += len(new)
        self.child = Lookup(np.concatenate(keys), np.arange(1, total, dtype=np.int32))
        self.token_at = np.full(total, -1, np.int32)
        self.token_at[node] = tokens
        before = np.full(total, -1, np.int32)  # the longest token that is a shorter beginning
        at = 1
        for parent in parents[1:]:
            own = self.token_at[parent]
            before[at : at + len(parent)] = np.where(own >= 0, own, before[parent])
            at += len(parent)
        # the node of each two bytes and the longest token of them, so that the search starts with the third
        one = self.child.get(np.arange(256, dtype=np.int64)).astype(np.int64)
        pairs = np.arange(1 << 16)
        self.two = np.where(one[pairs >> 8] >= 0, self.child.get(np.maximum(one[pairs >> 8], 0) << 8 | (pairs & 255)), -1).astype(np.int64)
        start = np.where(one >= 0, self.token_at[np.maximum(one, 0)], -1)[pairs >> 8]
        own = np.where(self.two >= 0, self.token_at[np.maximum(self.two, 0)], -1)
        self.best_of_two = np.where(own >= 0, own, start).astype(np.int32)
        self.shorter = np.full(self.size, -1, np.int32)
        self.shorter[tokens] = before[node]
        self.length = np.zeros(self.size, np.int64)
        self.length[tokens] = sizes
        self.ends = np.zeros(self.size, bool)
        self.ends[tokens] = grid[np.arange(len(sizes)), sizes - 1] == STOP

    # exact merging -------------------------------------------------------------------------------------------

    def merge_all(self, ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exact BPE of consecutive words of symbols, in step: in each round every word merges its pair of the lowest rank."""
        own = np.repeat(np.arange(len(sizes)), sizes)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        rank = np.full(len(ids), LAST)
        inner = np.flatnonzero(own[1:] == own[:-1])
        rank[inner] = self._rank(ids[inner], ids[inner + 1])
        while len(ids):
            starts = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            low = np.minimum.reduceat(rank, starts)
            lowest = np.repeat(low, np.diff(starts, append=len(ids)))
            if (low == LAST).any():  # nothing left to merge in these
                over = lowest == LAST
                done.append((own[over], ids[over]))
                own, ids, rank, lowest = own[~over], ids[~over], rank[~over], lowest[~over]
            chosen = rank == lowest
            chosen[1:] &= ~chosen[:-1]  # of overlapping ones the first; the others have their turn in the next round
            at = np.flatnonzero(chosen)
            ids[at] = self.made[rank[at]]
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            ids, own = ids[keep], own[keep]
            rank = rank[keep]
            at -= np.arange(len(at))
            ending = (at + 1 == len(ids)) | (own[np.minimum(at + 1, len(own) - 1)] != own[at])
            rank[at[ending]] = LAST
            follow = at[~ending]
            rank[follow] = self._rank(ids[follow], ids[follow + 1])
            ahead = at[(at > 0) & (own[at - 1] == own[at])]
            rank[ahead - 1] = self._rank(ids[ahead - 1], ids[ahead])
        if not done:
            return np.zeros(0, np.int32), np.zeros(len(sizes), np.int64)
        words, flat = (np.concatenate(x) for x in zip(*done))
        return flat[np.argsort(words, kind="stable")], np.bincount(words, minlength=len(sizes))

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        got = self.ranks.get(_pair(a, b))
        return np.where(got < 0, LAST, got)

    def merge_long(self, word: bytes) -> np.ndarray:
        """The same for one long word, with a queue."""
        parts = self._symbols(np.frombuffer(word, np.uint8), np.array([len(word)])).tolist()
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        made, known = self.made, {}

        def rank(a: int, b: int) -> int:
            if (got := known.get((a, b))) is None:
                got = known[a, b] = int(self.ranks.get(np.array([a << 32 | b], np.int64))[0])
            return got

        queue = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1) if (r := rank(parts[i], parts[i + 1])) >= 0]
        heapify(queue)
        while queue:
            r, i, a, b = heappop(queue)
            j = after[i]
            if parts[i] != a or j >= n or parts[j] != b:
                continue
            parts[i], parts[j] = int(made[r]), -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := rank(parts[i], parts[k])) >= 0:
                    heappush(queue, (r, i, parts[i], parts[k]))
            h = before[i]
            if h >= 0 and (r := rank(parts[h], parts[i])) >= 0:
                heappush(queue, (r, h, parts[h], parts[i]))
        return np.array([p for p in parts if p >= 0], np.int32)

    def _symbols(self, raw: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        ids = self.base[raw]
        last = np.cumsum(sizes) - 1
        ids[last] = self.base_end[raw[last]]
        return ids

    # speculation ---------------------------------------------------------------------------------------------

    def _apart(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray | None = None) -> np.ndarray:
        """Whether no merge crosses the border of tokens a and b (before the merge of rank ``limit``).

        Undoing the later of the merges that made the two border pieces goes back in time; a piece lives until the merge undone
        before. Of equal pairs the leftmost is merged first, so at its own rank the piece on the left is gone, that on the right is not.
        """
        until_a = np.full(len(a), LAST) if limit is None else limit
        until_b = until_a if limit is None else limit - 1
        out = np.ones(len(a), bool)
        at = np.arange(len(a))
        while len(at):
            rank = self._rank(a, b)
            clash = (rank < until_a) & (rank <= until_b) & (rank != LAST)
            out[at[clash]] = False
            made_a, made_b = self.rank_of[a], self.rank_of[b]
            go = np.flatnonzero(~clash & (np.maximum(made_a, made_b) >= 0))
            at, a, b, until_a, until_b, made_a, made_b = (x[go] for x in (at, a, b, until_a, until_b, made_a, made_b))
            first = made_a > made_b
            until_a, until_b = np.where(first, made_a, until_a), np.where(first, until_b, made_b)
            a, b = np.where(first, self.right[a], a), np.where(first, b, self.left[b])
        return out

    def _longest(self, flat: np.ndarray) -> np.ndarray:
        """The longest token that starts at each byte of a word; ``flat`` ends with a byte more."""
        pairs = flat[:-1].astype(np.int64) << 8 | flat[1:]
        best = self.best_of_two.take(pairs)
        node = self.two.take(pairs)
        at = np.flatnonzero((node >= 0) & (flat[1:] != STOP) & (flat[:-1] != STOP))
        node, step = node[at], 2
        while len(at):
            byte = flat.take(at + step)
            node = self.child.get(node << 8 | byte).astype(np.int64)
            on = np.flatnonzero(node >= 0)
            at, node = at[on], node[on]
            token = self.token_at.take(node)
            hit = np.flatnonzero(token >= 0)
            best[at[hit]] = token[hit]
            on = np.flatnonzero(byte[on] != STOP)
            at, node, step = at[on], node[on], step + 1
        return best

    def _compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """:meth:`_apart` for whole tokens, remembering ``1 << VERDICT_BITS`` pairs."""
        keys = _pair(a, b).view(np.uint64)
        slot = ((keys * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - VERDICT_BITS)).astype(np.int64)
        out = self.verdicts[slot]
        new = np.flatnonzero(self.verdict_keys[slot] != keys)
        if len(new):
            out[new] = found = self._apart(a[new], b[new])
            # of pairs that share a slot the last one stays, in both arrays
            self.verdict_keys[slot[new]], self.verdicts[slot[new]] = keys[new], found
        return out

    def speculate(self, raw: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the words whose cut holds, one word after the other, how many each has, and the words that are left; ``raw`` has the bytes of all words."""
        n = len(sizes)
        flat = np.full(len(raw) + n + 1, STOP, np.uint8)
        flat[np.arange(len(raw)) + np.repeat(np.arange(n), sizes)] = raw
        best = self._longest(flat)
        sizes = sizes + 1
        pos = np.cumsum(sizes) - sizes
        cut = np.full((int(sizes.max()) + 1, n), -1, np.int32)  # after row 0, the tokens of each word so far
        depth, tries = np.zeros(n, np.int64), np.zeros(n, np.int32)
        shut = np.zeros(len(flat), bool)  # places where no token fits: the cut up to a place is always the same
        going, token, left = np.arange(n), best[pos], []
        while len(going):
            at, before = pos[going], cut[depth[going], going]
            after = at + self.length[token]
            fits = self.ends[token] | (flat[after] != STOP) & ~shut[after]
            ask = np.flatnonzero(fits & (before >= 0))
            fits[ask] = self._compatible(before[ask], token[ask])
            # a token that fits stays, and the next one is proposed
            on = going[fits]
            depth[on] += 1
            cut[depth[on], on] = own = token[fits]
            pos[on] += self.length[own]
            on = on[~self.ends[own]]
            # instead of one that doesn't a shorter one is, or else the token before is shortened
            back = going[~fits]
            tries[back] += 1
            shorter = self.shorter[token[~fits]]
            while len(none := np.flatnonzero(shorter < 0)):
                words_back = back[none]
                shut[pos[words_back]] = True
                over = (depth[words_back] == 0) | (tries[words_back] > TRIES)
                left.append(words_back[over])
                words_back, none_over = words_back[~over], none[over]
                taken = cut[depth[words_back], words_back]
                pos[words_back] -= self.length[taken]
                depth[words_back] -= 1
                shorter[none[~over]] = self.shorter[taken]
                keep = np.ones(len(back), bool)
                keep[none_over] = False
                back, shorter = back[keep], shorter[keep]
            going, token = np.concatenate([on, back]), np.concatenate([best[pos[on]], shorter])
        failed = np.sort(np.concatenate(left)) if left else np.zeros(0, np.int64)
        depth[failed] = 0
        self.words += n
        self.settled += n - len(failed)
        self.at_first += int((tries == 0).sum())
        taken = np.arange(1, len(cut))[:, None] <= depth
        return cut[1:].T[taken.T], depth, failed

    def encode_array(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words (binary, none of them empty), one word after the other, and how many each has."""
        raw, ends = _buffers(words)
        sizes = np.diff(ends)
        short = np.flatnonzero(sizes <= LONG)
        if len(short) < len(words):
            raw, ends = _buffers(words.take(pa.array(short)))
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # numbers of words, how many ids each has, and the ids
        for k in range(0, len(short), AT_ONCE):
            part = short[k : k + AT_ONCE]
            at, own = ends[k : k + len(part) + 1], sizes[part]
            ids, counts, left = self.speculate(raw[at[0] : at[-1]], own)
            done.append((part, counts, ids))
            if len(left):
                rest = raw[np.repeat(at[left] - (np.cumsum(own[left]) - own[left]), own[left]) + np.arange(own[left].sum())]
                ids, counts = self.merge_all(self._symbols(rest, own[left]), own[left])
                done.append((part[left], counts, ids))
        for i in np.flatnonzero(sizes > LONG).tolist():
            ids = self.merge_long(words[i].as_py())
            done.append((np.array([i]), np.array([len(ids)]), ids))
        if not done:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        numbers, counts, ids = (np.concatenate(x) for x in zip(*done))
        if (numbers[1:] < numbers[:-1]).any():
            ids = ids[np.argsort(np.repeat(numbers, counts), kind="stable")]
        return ids, np.bincount(numbers, counts, len(words)).astype(np.int64)

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word, little-endian u32."""
        ids, counts = self.encode_array(pa.array(words, pa.large_binary()))
        raw, ends = ids.astype("<u4").tobytes(), np.cumsum(counts * 4).tolist()
        return [raw[i:j] for i, j in zip([0, *ends], ends)]

    # texts ---------------------------------------------------------------------------------------------------

    def _pieces(self, run: bytes) -> list[bytes | int]:
        """Words, and ids of special strings, of a run without ASCII white space."""
        if self.splitter is None or b"<|" not in run:
            return self._words_of(run)
        out: list[bytes | int] = []
        for part in self.splitter.split(run.decode()):
            out += [self.special[part]] if part in self.special else self._words_of(part.encode())
        return out

    def _words_of(self, run: bytes) -> list[bytes]:
        if run.isascii():
            return self.ascii_word.findall(run.lower())
        text = run.decode()
        if RARE.search(text):
            shown = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
            return [bytes(map(self.byte_of.__getitem__, w)) for w, _ in shown]
        return [w.encode() for w in self.word.findall(unicodedata.normalize("NFC", text).lower())]

    def _learn(self, fresh: pa.Array) -> Iterator[tuple[bytes, bytes]]:
        """(run, ids) of runs not seen before: words and line feeds of all runs, a line each, then the ids of all, then of each."""
        special = pc.match_substring(fresh, "<|")
        ascii_ = pc.and_not(pc.string_is_ascii(fresh), special)
        plain, other = byte_list(fresh.filter(ascii_)), byte_list(fresh.filter(pc.invert(ascii_)))
        odd: list[bytes] = []
        if RARE.search(b"\n".join(other).decode()) or pc.any(special).as_py():
            odd = [r for r in other if b"<|" in r or RARE.search(r.decode())]
            away = set(odd)
            other = [r for r in other if r not in away]
        words: list[bytes | int] = self.ascii_lines.findall(b"\n".join([*plain, b""]).lower())
        if other:
            words += map(str.encode, self.lines.findall(unicodedata.normalize("NFC", b"\n".join([*other, b""]).decode()).lower()))
        for run in odd:
            words += [*self._pieces(run), b"\n"]
        new = list(set(words) - {b"\n"})
        told = [w for w in new if isinstance(w, bytes)] if odd else new
        ids = dict(zip(told, self.encode_words(told)))
        if odd:
            ids |= {w: w.to_bytes(4, "little") for w in new if isinstance(w, int)}
        ids[b"\n"] = MARK
        return zip([*plain, *other, *odd], b"".join(map(ids.__getitem__, words)).split(MARK))

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of strings (null: none), one text after the other, and how many each has; some ``CHUNK`` bytes of text at a time."""
        ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        ids, counts, at = [], [], 0
        while at < len(texts):
            done = int(ends[at - 1]) if at else 0
            after = max(at + 1, int(np.searchsorted(ends, done + CHUNK, "right")))
            part = texts.slice(at, after - at)
            if int(ends[after - 1]) - done > 2 * CHUNK:  # one long text
                parts = _parts(part)
                own = np.concatenate([self._encode(parts.slice(i, 1))[0] for i in range(len(parts))])
                count = np.array([len(own)])
            else:
                own, count = self._encode(part)
            ids.append(own)
            counts.append(count)
            at = after
        return np.concatenate(ids) if ids else np.zeros(0, "<u4"), np.concatenate(counts) if counts else np.zeros(0, np.int64)

    def _encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if not self.plain:
            return self._encode_runs(texts)
        flat, begins = _buffers(texts)
        lead = np.flatnonzero(flat >= 0xC0)
        code = _code_points(flat, lead)
        odd = pc.match_substring(texts, "<|").to_numpy(zero_copy_only=False)
        strange = lead[KIND.take(code) == ODD]
        odd[np.searchsorted(begins, strange, "right") - 1] = True
        if not odd.any():
            return self._encode_plain(flat, begins, lead, code)
        # each kind of text by its own way, in the order of the texts
        counts = np.zeros(len(texts), np.int64)
        plain = texts.filter(pa.array(~odd))
        flat, begins = _buffers(plain)
        lead = np.flatnonzero(flat >= 0xC0)
        ids, counts[~odd] = self._encode_plain(flat, begins, lead, _code_points(flat, lead))
        odd_ids, counts[odd] = self._encode_runs(texts.filter(pa.array(odd)))
        own = np.repeat(odd, counts)
        out = np.empty(len(own), "<u4")
        out[own], out[~own] = odd_ids, ids
        return out, counts

    def _encode_plain(self, flat: np.ndarray, begins: np.ndarray, lead: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        words, borders = _cut_words(flat, begins, lead, code)
        coded = words.dictionary_encode()
        distinct = coded.dictionary
        counts = np.zeros(len(distinct), np.int64)
        if self.known is not None:
            words, store, size = self.known
            at = pc.index_in(distinct, words)
            fresh = at.is_null().to_numpy(zero_copy_only=False)
            own, counts[~fresh] = _gather(store, size, at.drop_null().to_numpy())
            ids, counts[fresh] = self.encode_array(distinct.filter(pa.array(fresh)))
            new = np.repeat(fresh, counts)
            store = np.empty(len(new), np.int32)
            store[new], store[~new] = ids, own
        else:
            store, counts = self.encode_array(distinct)
        self.known = distinct, store, counts
        ids, per_word = _gather(store, counts, coded.indices.to_numpy())
        return ids.astype("<u4", copy=False), np.diff(np.concatenate([[0], np.cumsum(per_word)])[borders])

    def _encode_runs(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if self.held > CACHE_BYTES:
            self.old, self.young, self.held = self.young, {}, 0
        runs, old = self.young, self.old
        cut = pc.ascii_split_whitespace(texts)  # the word pattern never crosses ASCII white space
        coded = cut.flatten().dictionary_encode()
        code, distinct = coded.indices.to_numpy(), byte_list(coded.dictionary)
        found = list(map(runs.get, distinct))
        if new := [i for i, ids in enumerate(found) if ids is None]:
            again = {r: ids for i in new if (ids := old.get(r := distinct[i])) is not None}
            if len(again) < len(new):
                again.update(self._learn(coded.dictionary.take(pa.array([i for i in new if distinct[i] not in again] if again else new)).cast(pa.string())))
            runs.update(again)
            for i in new:
                found[i] = again[distinct[i]]
            self.held += ENTRY_BYTES * len(again) + sum(map(len, again)) + sum(map(len, again.values()))
        # the ids of each run, from those of the distinct ones
        store = np.frombuffer(b"".join(found), "<u4")
        size = np.fromiter(map(len, found), np.int64, len(found)) >> 2
        flat, per_run = _gather(store, size, code)
        borders = np.concatenate([[0], np.cumsum(per_run)])[cut.offsets.to_numpy() - cut.offsets[0].as_py()]
        return flat, np.diff(borders)

    def release(self) -> None:
        """Let words and runs go."""
        self.known = None
        self.young, self.old, self.held = {}, {}, 0

    def decode_all(self, ids: np.ndarray, counts: np.ndarray) -> pa.Array:
        """The text of each, as the library without a decoder gives it: token strings joined by a space."""
        ends = np.concatenate([[0], np.cumsum(counts)])
        parts = self.names.take(pa.array(ids.astype(np.int32)))
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), parts), " ")


def byte_list(texts: pa.Array) -> list[bytes]:
    """The UTF-8 of each string of an array without nulls."""
    width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, width, len(texts) + 1, texts.offset * np.dtype(width).itemsize).tolist() if len(texts) else [0]
    raw = data.to_pybytes() if data is not None else b""
    return [raw[i:j] for i, j in zip(ends, ends[1:])]


def _parts(text: pa.Array) -> pa.Array:
    """One long text in parts of some ``CHUNK`` bytes, cut before ASCII white space: no word, special string or accent goes across."""
    raw = text[0].as_buffer()
    data, cuts = raw.to_pybytes(), [0]
    while len(data) - cuts[-1] > CHUNK:
        start, end = cuts[-1] + 1, cuts[-1] + CHUNK
        at = max(data.rfind(c, start, end) for c in WHITE)
        if at < 0:
            at = min((i for c in WHITE if (i := data.find(c, end)) >= 0), default=len(data))
        cuts.append(at)
    if cuts[-1] < len(data):
        cuts.append(len(data))
    return pa.Array.from_buffers(pa.large_string(), len(cuts) - 1, [None, pa.py_buffer(np.array(cuts)), raw])


def _buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of large strings without nulls, one after the other, and where each begins and the last ends."""
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64, len(texts) + 1, texts.offset * 8) if len(texts) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, ends - ends[0]


def _gather(store: np.ndarray, size: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of entries, one after the other, and how many each has; ``store`` has those of all entries."""
    per = size.take(code)
    ends = np.cumsum(per)
    shift = (np.cumsum(size) - size).take(code) - (ends - per)
    place = np.repeat(shift, per)
    place += np.arange(len(place))
    return store.take(place), per


def _code_points(flat: np.ndarray, lead: np.ndarray) -> np.ndarray:
    """The code points of the characters of two bytes and more that begin at ``lead``; those past the table count as its last one."""
    first = flat.take(lead).astype(np.int32)
    second, third = (flat.take(lead + k, mode="clip").astype(np.int32) & 63 for k in (1, 2))
    code = np.where(first < 0xE0, (first & 31) << 6 | second, (first & 15) << 12 | second << 6 | third)
    return np.where(first < 0xF0, np.minimum(code, len(KIND) - 1), len(KIND) - 1)


def _cut_words(flat: np.ndarray, begins: np.ndarray, lead: np.ndarray, code: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The words of plain texts (``PLAIN_PATTERN``), lower-cased, and the first word of each text; ``lead`` and ``code`` are the characters beyond ASCII."""
    n = len(flat)
    kind, flat = KIND[:256].take(flat), _lowered(flat, lead, code)
    own = KIND.take(code)
    kind[lead] = kind[lead + 1] = own
    three = np.flatnonzero(code >= 0x800)
    kind[lead[three] + 2] = own[three]
    first = np.zeros(n + 3, bool)  # where texts begin, and past the end
    first[begins] = first[n:] = True
    start = np.ones(n + 3, bool)
    np.not_equal(kind[1:], kind[:-1], out=start[1:n])
    start[:n] |= kind == NUMBER
    start[lead[own == NUMBER] + 1] = False  # those of three bytes aren't plain
    start |= first
    quote = np.flatnonzero((flat == ord("'")) & start[:n])
    if len(quote):
        quote = quote[~first[quote + 1]]
        one = flat.take(quote + 1)
        short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
        two = one.astype(np.int64) << 8 | flat.take(quote + 2, mode="clip")
        long = ~first[quote + 2] & np.isin(two, [int.from_bytes(x) for x in (b"re", b"ve", b"ll")])
        start[quote[short | long] + 1] = False
        start[quote[short] + 2] = start[quote[long] + 3] = True
    shown = kind != SPACE
    at = np.flatnonzero(start[:n] & shown)
    flat = flat[shown]
    place = np.cumsum(shown, dtype=np.int32 if n < 1 << 31 else np.int64).take(at).astype(np.int64) - 1
    starts = np.append(place, len(flat))
    words = pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(starts), pa.py_buffer(flat)])
    return words, np.searchsorted(at, begins)


def _lowered(flat: np.ndarray, lead: np.ndarray, code: np.ndarray) -> np.ndarray:
    flat = BYTE_LOWER.take(flat)
    two = np.flatnonzero(code < 0x800)
    low = LOWER.take(code[two])
    flat[lead[two]], flat[lead[two] + 1] = 0xC0 | low >> 6, 0x80 | low & 63
    return flat


def _kinds() -> tuple[np.ndarray, np.ndarray]:
    """The kind of each code point, and what it is in lower case; those after the last one are odd, and so is what the patterns must see."""
    kind, lower = np.full(0x20C1, ODD, np.uint8), np.arange(0x20C1)
    for i in range(len(kind) - 1):
        c = chr(i)
        if RARE.match(c) or len(low := c.lower()) > 1 or len(low.encode()) != len(c.encode()):
            continue
        space = c in " \t\n\v\f\r\x85\xa0"
        kind[i] = SPACE if space else LETTER if regex.match(r"\p{L}", c) else NUMBER if regex.match(r"\p{N}", c) else OTHER
        lower[i] = ord(low)
    return kind, lower


# beyond Latin letters and general punctuation; the capital sigma and dotted I also lower-case by context
RARE = re.compile("[^\x00-įı-ɏ‐-‧‰-⁞₠-₿]")
KIND, LOWER = _kinds()
BYTE_LOWER = np.array([*range(65), *range(97, 123), *range(91, 256)], np.uint8)


@functools.lru_cache(maxsize=2)
def load(path: str) -> Bpe:
    return Bpe(path)


def encode(docs: DataFrame, path: str, *, digest: bool = False, ids: bool = True) -> DataFrame:
    """doc_id, ``ids`` (binary, little-endian u32) and n_tokens; with ``digest`` the hashes of ids and decoded text."""

    def kernel(batch: pa.RecordBatch) -> dict:
        bpe = load(path)
        flat, counts = bpe.encode_all(batch.column("text"))
        raw, ends = flat.tobytes(), np.concatenate([[0], np.cumsum(counts * 4)])
        out = {"doc_id": batch.column("doc_id"), "n_tokens": pa.array(counts, pa.int64())}
        if ids:
            out["ids"] = pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(raw)])
        if digest:
            view, cuts = memoryview(raw), ends.tolist()
            texts = bpe.decode_all(flat, counts).cast(pa.binary())
            out["ids_sha256"] = pa.array([hashlib.sha256(view[i:j]).hexdigest() for i, j in zip(cuts, cuts[1:])], pa.string())
            out["decoded_sha256"] = pa.array([hashlib.sha256(t.as_buffer()).hexdigest() for t in texts], pa.string())
        return out

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long" + ", ids binary" * ids + ", ids_sha256 string, decoded_sha256 string" * digest
    return map_texts(docs.select("doc_id", "text"), kernel, schema, after=lambda: load(path).release())
