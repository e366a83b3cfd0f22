"""Quality rules with cross-document line frequency.

Each text gets the usual word and repetition counts. Beside them, lines are normalised (ASCII lower case,
digits as ``0``, white space collapsed) and hashed; a line found in so many distinct documents of a host that they are ``min_docs`` at least
and ``share`` of the host's distinct documents counts as boilerplate and is removed, and a document of which less than ``min_left`` of its words
remain is rejected. The limit thus means the same on a host of a hundred pages and on one of a billion.

*Distinct documents*: copies of one document must not turn its lines into boilerplate, so of the rows of a host whose
texts have the same words in the same lines one votes. Texts that differ in a word are distinct documents: a page that is mostly
boilerplate is as close to the others of its host as a near copy, so no similarity of whole texts can tell the two apart.

Defined results: null text is an empty text (no words, fails); null host is a host of its own; repeated
rows are separate documents that have one vote together; a line with exactly the limit of documents is boilerplate; texts of any length are read whole; an empty table gives an
empty result; further columns are ignored, and carried by :func:`filter_documents`, whatever their names.
"""

from __future__ import annotations

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uelumen.llm.common import map_texts, stage_table, text_bytes, text_values, whole_row

SPACE = b" \t\n\v\f\r"
SYMBOLS = b"#*$%&|<>"
CONTINUATION = bytes(range(0x80, 0xC0))
FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789", b"abcdefghijklmnopqrstuvwxyz000000000")

FEATURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "lines array<long>, line_words array<long>, digest binary"
)


def line_key(line: bytes) -> int:
    """Signed 64-bit hash of a normalised line."""
    return xxhash.xxh64_intdigest(b" ".join(line.translate(FOLD).split())) - (1 << 63)


def repeat_words(words: list[bytes], size: int = 5) -> int:
    """Words inside a window of ``size`` words that occurs twice or more, its first occurrence included."""
    n = len(words) - size + 1
    if n < 2:
        return 0
    windows = list(zip(*(words[i:] for i in range(size))))
    if len(set(windows)) == n:
        return 0
    first: dict[tuple, int] = {}
    twice = bytearray(n)
    for i, w in enumerate(windows):
        j = first.setdefault(w, i)
        if j != i:
            twice[j] = twice[i] = 1
    covered, end = 0, 0
    for i, hit in enumerate(twice):
        if hit:
            covered += i + size - max(i, end)
            end = i + size
    return covered


def digest(text: bytes) -> bytes:
    """128-bit hash of the words of each line that has any."""
    return xxhash.xxh3_128_digest(b"\n".join(b" ".join(words) for x in text.split(b"\n") if (words := x.split())))


def features(text: bytes) -> tuple:
    words = text.split()
    seen: set[bytes] = set()
    keys: dict[int, int] = {}
    dup = 0
    for line in text.split(b"\n"):
        own = len(line.split())
        if own:
            dup += line in seen
            seen.add(line)
            key = line_key(line)
            keys[key] = keys.get(key, 0) + own
    chars = len(text.translate(None, SPACE + CONTINUATION))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    return len(words), chars, symbols, dup, repeat_words(words), list(keys), list(keys.values()), digest(text)


def _features(batch: pa.RecordBatch) -> dict:
    rows = [features(t) for t in text_bytes(batch.column("ul_text"))]
    columns = list(zip(*rows))
    out = {name: batch.column(name) for name in batch.schema.names if name != "ul_text"}
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    out |= {n: pa.array(c, pa.int64()) for n, c in zip(names, columns)}
    out |= {n: pa.array(c, pa.list_(pa.int64())) for n, c in zip(["lines", "line_words"], columns[5:])}
    return out | {"digest": pa.array(columns[7], pa.binary())}


def judge(
    docs: DataFrame, *, host: str = "source", min_docs: int = 10, share: float = 0.02, min_left: float = 0.3, min_words: int = 10, max_repeat: int = 20, rows: bool = False
) -> DataFrame:
    """One row per document: doc_id, the counts, ``base_failed``, ``left_words``, ``kept``.

    With ``rows`` the input row comes too, as ``ul_row``, with ``removed``: the keys of its lines that go.
    """
    host_of = F.coalesce(F.col(f"`{host}`").cast("string"), F.lit(""))
    has_host = host in docs.columns
    kept_row = whole_row(docs, doc_id=F.col("doc_id"), ul_host=host_of if has_host else F.lit(""), ul_text=F.col("text"))
    source = (kept_row if rows else kept_row.drop("ul_row")).withColumn("ul_id", F.monotonically_increasing_id())
    carried = ", ".join(f"{c.name} {c.dataType.simpleString()}" for c in source.schema if c.name != "ul_text")
    table = stage_table(map_texts(source, _features, f"{carried}, {FEATURES}"), "quality")

    lines = table.select("ul_id", "ul_host", F.explode(F.arrays_zip("lines", "line_words")).alias("l")).select(
        "ul_id", "ul_host", F.col("l.lines").alias("line"), F.col("l.line_words").alias("words")
    )
    voters = table.groupBy("ul_host", "digest").agg(F.min("ul_id").alias("ul_id")).select("ul_host", "ul_id")
    votes = lines.join(voters.select("ul_id"), "ul_id", "left_semi").groupBy("ul_host", "line").agg(F.count("*").alias("votes")).filter(F.col("votes") >= min_docs)
    hosts = voters.groupBy("ul_host").agg(F.count("*").alias("documents"))
    common = votes.join(hosts, "ul_host").filter(F.col("votes") >= F.lit(share) * F.col("documents")).select("ul_host", "line")
    lost = (
        lines.join(common, ["ul_host", "line"])
        .groupBy("ul_id").agg(F.sum("words").alias("lost_words"), *([F.collect_list("line").alias("removed")] if rows else []))
    )
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat * F.col("n_words"))
    left = F.col("n_words") - F.coalesce("lost_words", F.lit(0))
    out = table.drop("lines", "line_words", "digest").join(lost, "ul_id", "left").withColumn("base_failed", failed).withColumn("left_words", left)
    out = out.withColumn("kept", ~F.col("base_failed") & (F.col("left_words") >= F.lit(min_left) * F.col("n_words")))
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "left_words", "kept"]
    return out.select(*(["ul_row", "removed"] if rows else []), *names)


def filter_documents(docs: DataFrame, **limits) -> DataFrame:
    """The documents that pass, without their boilerplate lines, in the columns of ``docs``."""
    judged = judge(docs, rows=True, **limits).filter("kept").select("ul_row", "removed")
    columns = docs.columns
    has_chars = "n_chars" in columns

    def strip(batch: pa.RecordBatch) -> dict:
        out = dict(zip(columns, batch.column("ul_row").flatten()))
        gone = batch.column("removed")
        if gone.null_count == len(gone):
            return out
        old = out["text"]
        texts, drop = text_values(old), gone.to_pylist()
        for i, keys in enumerate(drop):
            if keys:
                away = set(keys)
                texts[i] = "\n".join(x for x in texts[i].split("\n") if not x.encode().split() or line_key(x.encode()) not in away)
        out["text"] = pa.array([t if o.is_valid else None for t, o in zip(texts, old)], pa.string())
        if has_chars:
            out["n_chars"] = pa.array([len(t) if k else c for t, k, c in zip(texts, drop, out["n_chars"].to_pylist())], out["n_chars"].type)
        return out

    return map_texts(judged, strip, docs.schema)


_BLANK = r"[ \t\n\x0b\f\r]+"
_WORDS = f"list_filter(string_split_regex({{0}}, '{_BLANK}'), lambda x: x <> '')"

#: The query in DuckDB: lines are compared by their normalised text instead of its hash.
ORACLE_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, doc_id, host, t, {_WORDS.format('t')} AS ws FROM d),
win AS (SELECT rid, p, array_to_string(ws[p : p + 4], ' ') AS g FROM (SELECT rid, ws, unnest(range(1, len(ws) - 3)) AS p FROM w)),
twice AS (SELECT rid, p FROM (SELECT rid, p, count(*) OVER (PARTITION BY rid, g) AS c FROM win) WHERE c > 1),
again AS (SELECT rid, count(DISTINCT q) AS n_repeat_words FROM (SELECT rid, unnest(range(p, p + 5)) AS q FROM twice) GROUP BY rid),
raw AS (SELECT rid, host, unnest(string_split(t, chr(10))) AS line, unnest(range(len(string_split(t, chr(10))))) AS i FROM d),
l AS (SELECT rid, host, line, i, {_WORDS.format('line')} AS ws, array_to_string({_WORDS.format("translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789', 'abcdefghijklmnopqrstuvwxyz000000000')")}, ' ') AS k FROM raw),
own AS (SELECT * FROM l WHERE len(ws) > 0),
dup AS (SELECT rid, count(*) - count(DISTINCT line) AS n_dup_lines FROM own GROUP BY rid),
whole AS (SELECT d.rid, d.host, coalesce(string_agg(array_to_string(own.ws, ' '), chr(10) ORDER BY own.i), '') AS digest FROM d LEFT JOIN own USING (rid) GROUP BY d.rid, d.host),
voters AS (SELECT host, min(rid) AS rid FROM whole GROUP BY host, digest),
hosts AS (SELECT host, count(*) AS documents FROM voters GROUP BY host),
votes AS (SELECT own.host, own.k, count(DISTINCT own.rid) AS votes FROM own JOIN voters USING (rid) GROUP BY own.host, own.k),
common AS (SELECT host, k FROM votes JOIN hosts USING (host) WHERE votes >= 10 AND votes >= 0.02::DOUBLE * documents),
lost AS (SELECT rid, sum(len(ws)) AS lost_words FROM own JOIN common USING (host, k) GROUP BY rid),
counts AS (SELECT doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars, length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
  coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, CAST(len(ws) - coalesce(lost_words, 0) AS BIGINT) AS left_words
  FROM w LEFT JOIN dup USING (rid) LEFT JOIN again USING (rid) LEFT JOIN lost USING (rid))
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND left_words >= 0.3::DOUBLE * n_words AS kept FROM counts
"""
