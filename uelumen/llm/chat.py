"""Chat formatting as prefix trees.

Conversations that share their initial turns are merged: in depth-first order every shared turn is emitted once, and a
conversation is the path from a root to its leaf. A pack holds the text of such a traversal, its nodes and the leaf of each
of its conversations. One code point is one position. A node carries

* ``start, end``: its interval in the pack's text, ``loss_start, loss_end``: the assistant text inside it (empty
  otherwise);
* ``position``: the position id of its first code point; ids go on from the parent's last, so siblings share theirs;
* ``attends``: the intervals of its ancestors in the pack, adjoining ones joined, which with the causal part of its own
  interval are all that it may attend to.

Depth-first order is the order of the path of turn hashes, so conversations are range-partitioned by path (and id, so that
any number of equal ones is split), and each task streams through its range with the current path as a stack. A pack closes
at ``PACK_CHARS`` code points or ``PACK_CONVERSATIONS`` leaves; the next one starts with the path it needs again.

Template: ``[INST] text [/INST]`` for users, ``text</s>`` for assistants, ``[SYS] text [/SYS]`` for systems, ``[ROLE name]
text [/ROLE]`` for others. A control string inside a text gets a backslash after its first character, one more if it has
some, so that removing one restores it.

A pack is cut where it would pass these sizes, so a turn that the conversations of two packs share stands in both: the shared turns of a tree of
any size are emitted once for each ``PACK_CHARS`` code points or ``PACK_CONVERSATIONS`` conversations of it, as a training sequence has an end.

Defined results: null text and null role are empty; turns are ordered by turn, then role and text, null first, and repeated
rows are kept as turns; rows with a null conv_id are one conversation; texts are whole; further columns are not read, whatever their names; an empty
table gives no packs.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uelumen.llm.common import stage_table

PACK_CHARS = 1 << 16
PACK_CONVERSATIONS = 4096
CONTROL = re.compile(r"([<\[])(\\*)(/?s>|/?INST\]|/?SYS\]|/?ROLE(?=[ \]]))")
ESCAPED = re.compile(r"([<\[])\\(\\*)(/?s>|/?INST\]|/?SYS\]|/?ROLE(?=[ \]]))")

NODE = "struct<parent:int,role:string,start:int,end:int,loss_start:int,loss_end:int,position:int,attends:array<struct<start:int,end:int>>>"
PACK = f"text string, nodes array<{NODE}>, conv_ids array<long>, leaves array<int>"
_SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32())])
_NODE = pa.struct([("parent", pa.int32()), ("role", pa.string()), *((n, pa.int32()) for n in ("start", "end", "loss_start", "loss_end", "position")), ("attends", pa.list_(_SPAN))])


def escape(text: str) -> str:
    return CONTROL.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1\2\3", text)


def frame(role: str) -> tuple[str, str]:
    """What stands before and after a turn's text."""
    if role == "user":
        return "[INST] ", " [/INST]"
    if role == "assistant":
        return "", "</s>"
    if role == "system":
        return "[SYS] ", " [/SYS]"
    return f"[ROLE {escape(role)}] ", " [/ROLE]"


def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation and turn into one row per conversation, with its path of turn hashes."""
    out: list[tuple] = []
    size = 0
    current, path, roles, texts, begun = None, [], [], [], False

    def close() -> None:
        nonlocal size
        out.append((current, b"".join(path), roles, texts))
        size += sum(map(len, texts)) + 16 * len(path)

    def batch() -> pa.RecordBatch:
        ids, paths, rs, ts = zip(*out)
        return pa.RecordBatch.from_pydict({"conv_id": pa.array(ids, pa.int64()), "path": pa.array(paths, pa.binary()), "roles": pa.array(rs, pa.list_(pa.string())), "texts": pa.array(ts, pa.list_(pa.string()))})

    for rows in batches:
        for conv, role, text in zip(*(rows.column(n).to_pylist() for n in ("conv_id", "role", "text"))):
            if not begun or conv != current:
                if begun:
                    close()
                    if size > 4 << 20 or len(out) >= 5000:
                        yield batch()
                        out, size = [], 0
                current, path, roles, texts, begun = conv, [], [], [], True
            above = path[-1] if path else b""
            path.append(xxhash.xxh3_128_digest(above + len(role).to_bytes(4, "little") + role.encode() + text.encode()))
            roles.append(role)
            texts.append(text)
    if begun:
        close()
    if out:
        yield batch()


class Pack:
    """A prefix tree under way."""

    def __init__(self):
        self.parts: list[str] = []
        self.size = 0
        self.nodes: list[dict] = []
        self.conv_ids: list[int] = []
        self.leaves: list[int] = []
        self.stack: list[tuple[bytes, int]] = []  # turn hash, node

    def shared(self, path: list[bytes]) -> int:
        n = 0
        while n < len(path) and n < len(self.stack) and self.stack[n][0] == path[n]:
            n += 1
        return n

    def add(self, conv, path: list[bytes], roles: list[str], texts: list[str]) -> None:
        del self.stack[self.shared(path) :]
        for key, role, text in list(zip(path, roles, texts))[len(self.stack) :]:
            before, after = frame(role)
            body = escape(text)
            whole = before + body + after
            parent = self.stack[-1][1] if self.stack else -1
            above = self.nodes[parent] if self.stack else None
            spans = [dict(s) for s in above["attends"]] if above else []
            if above and spans and spans[-1]["end"] == above["start"]:
                spans[-1]["end"] = above["end"]
            elif above:
                spans.append({"start": above["start"], "end": above["end"]})
            start = self.size
            loss = (start + len(before), start + len(before) + len(body)) if role == "assistant" else (start, start)
            position = above["position"] + above["end"] - above["start"] if above else 0
            self.nodes.append(
                {"parent": parent, "role": role, "start": start, "end": start + len(whole), "loss_start": loss[0], "loss_end": loss[1], "position": position, "attends": spans}
            )
            self.parts.append(whole)
            self.size += len(whole)
            self.stack.append((key, len(self.nodes) - 1))
        self.conv_ids.append(conv)
        self.leaves.append(self.stack[-1][1])

    def row(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({
            "text": pa.array(["".join(self.parts)], pa.string()), "nodes": pa.array([self.nodes], pa.list_(_NODE)),
            "conv_ids": pa.array([self.conv_ids], pa.list_(pa.int64())), "leaves": pa.array([self.leaves], pa.list_(pa.int32())),
        })


def traverse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conversations sorted by path into packs."""
    pack = Pack()
    for batch in batches:
        for conv, raw, roles, texts in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "path", "roles", "texts"))):
            path = [raw[i : i + 16] for i in range(0, len(raw), 16)]
            fresh = sum(map(len, texts[pack.shared(path) :]))
            if pack.conv_ids and (pack.size + fresh > PACK_CHARS or len(pack.conv_ids) >= PACK_CONVERSATIONS):
                yield pack.row()
                pack = Pack()
            pack.add(conv, path, roles, texts)
    if pack.conv_ids:
        yield pack.row()


def format_packs(conversations: DataFrame) -> DataFrame:
    """Packs (text, nodes, conv_ids, leaves) of conv_id, turn, role, text, written to the shared folder."""
    rows = conversations.select("conv_id", "turn", *(F.coalesce(F.col(n), F.lit("")).alias(n) for n in ("role", "text")))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    whole = stage_table(rows.mapInArrow(assemble, "conv_id long, path binary, roles array<string>, texts array<string>"), "conversations")
    ordered = whole.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
    return stage_table(ordered.mapInArrow(traverse, PACK), "packs")


def read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation of a pack, from the pack's text, nodes and leaves alone."""
    for batch in batches:
        for text, nodes, conv_ids, leaves in zip(*(batch.column(n).to_pylist() for n in ("text", "nodes", "conv_ids", "leaves"))):
            rows, told = [], []
            for node in nodes:
                before, after = frame(node["role"])
                body = unescape(text[node["start"] + len(before) : node["end"] - len(after)])
                told.append((f"{node['role']}\n{body}\n".encode(), unescape(text[node["loss_start"] : node["loss_end"]])))
            for conv, leaf in zip(conv_ids, leaves):
                path, at = [], leaf
                while at >= 0:
                    path.append(at)
                    at = nodes[at]["parent"]
                path.reverse()
                turns, loss, learnt, chars = hashlib.sha256(), hashlib.sha256(), 0, 0
                for i in path:
                    turns.update(told[i][0])
                    loss.update(told[i][1].encode())
                    learnt += len(told[i][1])
                    chars += nodes[i]["end"] - nodes[i]["start"]
                rows.append((conv, len(path), turns.hexdigest(), learnt, loss.hexdigest(), chars))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            names = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=list(names))


def digests(packs: DataFrame) -> DataFrame:
    return packs.mapInArrow(read_back, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


_ESCAPED = r"(length({0}) + len(regexp_extract_all({0}, '[<\[]\\*(?:/?s>|/?INST\]|/?SYS\]|/?ROLE[ \]])')))"

#: The digests of ``conversations`` and the control conversation in DuckDB; a control string is one code point longer when escaped.
ORACLE_SQL = f"""
WITH r AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM (SELECT conv_id, turn, role, text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))),
t AS (SELECT *, {_ESCAPED.format('text')} + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 4 WHEN 'system' THEN 13 ELSE 16 + {_ESCAPED.format('role')} END AS chars FROM r)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars FROM t GROUP BY conv_id
"""
