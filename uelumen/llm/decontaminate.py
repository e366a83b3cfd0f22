"""Benchmark decontamination by template canonicalisation, in DataFrame functions only.

A text is reduced to words of letters and digits in lower case. Its *template* has the slot ``¹`` (name) for a word with a capital, wherever
it stands, the slot ``#`` for a run of digits and the slot ``²`` for a unit after a number; its *plain template* keeps the names as words in lower
case, so that a copy in any case matches. Layout plays no part: white space only separates words. Every ``SIZE`` words of either template form
a window, of which at least ``PLAIN`` words must be no slot. Documents and benchmark items are hash-joined on
their windows, and hits of one document and item at the same offset form an alignment. It counts if it has ``RUN`` windows in
a row (13 words), or as many as the item itself has. Slot consistency then decides: over the alignment each slot
value of the item must stand for one value of the document and the reverse, as in a copy (``verbatim``) or a
re-parameterised question.

A run of k windows holds one at every k-th place, so only every k-th window of a document is looked up, k being the
shortest run that an item asks for; a hit is then extended word by word. The windows of the benchmark (hash, item, place: 16 bytes) are broadcast in blocks
of at most about ``BROADCAST_ROWS``, each of which passes over the documents once; the words of the items follow to the hits, broadcast up to
``BROADCAST_WORDS`` words. Windows carry a hash and their place alone, and only documents that have a hit are read again for their words, so the work
is linear in a text. Nothing of a document is shuffled before it has a hit.

Defined results: null text is empty; items of fewer than ``SIZE`` words have no window and match nothing; repeated
rows of a document give one row of the result, as do items of equal id; of several alignments the longest counts, and one without a changed value makes the pair
verbatim; further columns are not read, and carried by :func:`clean_documents`, whatever their names; empty tables give an empty result; texts are read whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from uelumen.llm.common import stage_table, whole_row

SIZE = 8
PLAIN = 5
RUN = 6
BROADCAST_ROWS = 500_000
BROADCAST_WORDS = 2_000_000
HITS = 512
# fixed values: units of measure
UNITS = "mm cm m km in ft yd mi g mg kg lb oz t ml l s ms min h hr hrs day days week weeks month months year years usd eur gbp percent hz khz mhz ghz kb mb gb tb w kw v a c f k"
_UNIT = "|".join(UNITS.split())


def words_of(text: Column) -> Column:
    """Cleaned text, words with a capital marked by a leading ``¹``."""
    t = F.coalesce(text.cast("string"), F.lit(""))
    t = F.when(t.contains("#") | t.contains("¹") | t.contains("²"), F.regexp_replace(t, "[¹²#]", " ")).otherwise(t)
    t = F.regexp_replace(t, r"[^\p{L}\p{N}\s]+", "")
    return F.lower(F.regexp_replace(t, r"(?<!\S)(?=\p{Lu})", "¹"))


def template_of(cleaned: Column) -> Column:
    """The same words with slots in place of marked names, numbers and units."""
    t = F.regexp_replace(cleaned, r"¹[^\s]+", "¹")
    t = F.regexp_replace(t, r"[\p{Nd}\p{No}\p{Nl}&&[^¹]]+", "#")
    t = F.regexp_replace(t, rf"#(\s?)({_UNIT})(\s|$)", "#$1²$3")
    return F.when(cleaned.rlike(r"[\p{N}]"), t).otherwise(cleaned)


def _split(table: DataFrame, keep: list[str]) -> DataFrame:
    """Columns ``keep`` with ``tpl`` and ``ptpl``, the words of both templates, and ``cleaned``, the text that :func:`_words` splits alike."""
    cut = table.withColumn("ul_raw", words_of(F.col("ul_text")))
    cut = cut.select(*keep, "ul_raw", template_of(F.col("ul_raw")).alias("ul_tpl"), template_of(F.replace(F.col("ul_raw"), F.lit("¹"), F.lit(""))).alias("ul_ptpl"))
    return cut.select(*keep, _words("ul_tpl").alias("tpl"), _words("ul_ptpl").alias("ptpl"), F.col("ul_raw").alias("cleaned"))


def _words(name: str) -> Column:
    return F.array_remove(F.split(name, r"\s+"), "")


def _hash(tpl: str, at: str) -> str:
    return "xxhash64(" + ", ".join(f"get({tpl}, {at} + {k})" for k in range(SIZE)) + ")"


_RUN_OF = "aggregate({0}, struct(-2 AS last, 0 AS run, 0 AS best), (s, j) -> struct(j AS last, if(j = s.last + 1, s.run + 1, 1) AS run, greatest(s.best, if(j = s.last + 1, s.run + 1, 1)) AS best)).best"
_SLOT = "({0} = '¹' OR {0} = '²' OR contains({0}, '#'))"


def items_of(benchmark: DataFrame) -> DataFrame:
    """Each item in both templates: ``ino``, item_id, ``plain`` (the kind), words, places of its windows with enough plain words, the run it asks for (``need``)."""
    items = _split(whole_row(benchmark, item_id=F.col("item_id"), ul_text=F.col("text")).drop("ul_row"), ["item_id"])
    raw = _words("cleaned")
    kinds = F.array(F.struct(F.lit(False).alias("plain"), F.col("tpl").alias("itpl"), raw.alias("iraw")), F.struct(F.lit(True).alias("plain"), F.col("ptpl").alias("itpl"), F.transform(raw, lambda w: F.translate(w, "¹", "")).alias("iraw")))
    items = items.select("item_id", F.inline(kinds))
    items = items.withColumn("slot", F.expr(f"transform(itpl, w -> if({_SLOT.format('w')}, 1, 0))")).filter(F.size("itpl") >= SIZE)
    plain = f"filter(sequence(0, size(itpl) - {SIZE}), j -> aggregate(sequence(j, j + {SIZE - 1}), 0, (n, q) -> n + slot[q]) <= {SIZE - PLAIN})"
    items = items.withColumn("places", F.expr(plain)).filter("size(places) > 0").withColumn("need", F.least(F.expr(_RUN_OF.format("places")), F.lit(RUN)))
    return items.select(F.monotonically_increasing_id().alias("ino"), "item_id", "plain", "itpl", "iraw", "places", "need")


def _words_at(hits: DataFrame, source: DataFrame) -> DataFrame:
    """Hits with the words of their documents that the item covers: ``tpl`` and ``raw``, and ``shift``, by how much the item begins before them (0 or less).

    Only documents with a hit are read again. Some ``HITS`` hits of a document share a row, so that its words are cut out once for all of them.
    """
    ids = hits.select("ul_id").distinct()
    ids = F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids
    held = _split(source.select("ul_id", "doc_id", "ul_text").join(ids, "ul_id", "left_semi"), ["ul_id", "doc_id"])
    held = held.select("ul_id", "doc_id", "tpl", "ptpl", _words("cleaned").alias("raw"))
    number = F.row_number().over(Window.partitionBy("ul_id").orderBy("ino", "shift"))
    asked = hits.withColumn("part", F.floor((number - 1) / HITS)).groupBy("ul_id", "part").agg(F.collect_list(F.struct("ino", "plain", "shift", "n")).alias("hits"))
    cut = "slice({0}, greatest(x.shift, 0) + 1, greatest(x.n + least(x.shift, 0), 0))"
    words = F.expr(f"transform(hits, x -> struct(x.ino, x.plain, least(x.shift, 0) AS shift, {cut.format('if(x.plain, ptpl, tpl)')} AS tpl, {cut.format('raw')} AS raw))")
    cut_out = held.join(asked, "ul_id").select("ul_id", "doc_id", words.alias("ul_found"))
    return cut_out.select("ul_id", "doc_id", F.inline_outer("ul_found"))


def matches(docs: DataFrame, benchmark: DataFrame, *, rows: bool = False) -> DataFrame:
    """doc_id, item_id, n_windows (in the longest run), verbatim; with ``rows`` keyed by the input's ul_id."""
    items = stage_table(items_of(benchmark), "items")
    total, stride, words = items.agg(F.sum(F.size("places")), F.min("need"), F.sum(F.size("itpl"))).first()
    blocks = max(1, -(-(total or 0) // BROADCAST_ROWS))
    # rows that agree in all that is read are one; a stray equal hash would only cost a check, which reads the text itself
    source = docs if rows else whole_row(docs, doc_id=F.col("doc_id"), ul_text=F.col("text")).drop("ul_row").withColumn("ul_id", F.xxhash64("doc_id", "ul_text"))
    own = _split(source.select("ul_id", "doc_id", "ul_text"), ["ul_id"])
    # a filter on the words, or one that Spark infers from an inner explode, would be pushed to the scan with a copy of all the
    # work on the text: short texts get no windows, and the outer form keeps Spark from inferring
    places = f"sequence(0, size(tpl) - {SIZE}, {stride or 1})"
    looked = [f"if(size(tpl) >= {SIZE}, transform({places}, i -> {_hash(name, 'i')}), cast(null AS array<bigint>))" for name in ("tpl", "ptpl")]
    own = own.select("ul_id", F.arrays_zip(F.expr(looked[0]).alias("t"), F.expr(looked[1]).alias("p")).alias("ul_w"))
    own = own.select("ul_id", F.posexplode_outer("ul_w").alias("step", "w"))  # hashes alone: a text isn't copied into its windows
    # the two are mostly one: a window without names
    both = F.when(F.col("w.t") == F.col("w.p"), F.array("w.t")).otherwise(F.array("w.t", "w.p"))
    own = own.select("ul_id", (F.col("step") * (stride or 1)).alias("step"), F.explode_outer(both).alias("h"))
    found = None
    for block in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("ino"), F.lit(blocks)) == block)
        bench = part.select("ino", "plain", "itpl", F.explode("places").alias("ipos"))
        bench = bench.select("ino", "plain", F.size("itpl").alias("n"), F.col("ipos").cast("int"), F.expr(_hash("itpl", "ipos")).alias("h"))
        hits = own.join(F.broadcast(bench), "h").select("ul_id", "ino", "plain", "n", (F.col("step") - F.col("ipos")).alias("shift"))
        hits = hits.dropDuplicates(["ul_id", "ino", "shift"])
        found = hits if found is None else found.unionByName(hits)
    found = _words_at(stage_table(found, "hits"), source)
    found = found.join(F.broadcast(items.drop("plain")) if (words or 0) <= BROADCAST_WORDS else items.drop("plain"), "ino")
    same = f"filter(places, j -> forall(sequence(j, j + {SIZE - 1}), q -> q + shift >= 0 AND get(tpl, q + shift) <=> get(itpl, q)))"
    runs = found.withColumn("at", F.expr(same)).withColumn("n_windows", F.expr(_RUN_OF.format("at")).cast("long")).filter("n_windows >= need")
    covered = f"array_distinct(flatten(transform(at, j -> sequence(j, j + {SIZE - 1}))))"
    pairs = f"array_distinct(transform(filter({covered}, q -> {_SLOT.format('itpl[q]')}), q -> struct(itpl[q] AS t, iraw[q] AS mine, get(raw, q + shift) AS theirs)))"
    runs = runs.withColumn("raw", F.when(F.col("plain"), F.transform("raw", lambda w: F.translate(w, "¹", ""))).otherwise(F.col("raw"))).withColumn("pairs", F.expr(pairs))
    consistent = "size(pairs) = size(array_distinct(transform(pairs, x -> struct(x.t, x.mine)))) AND size(pairs) = size(array_distinct(transform(pairs, x -> struct(x.t, x.theirs))))"
    runs = runs.filter(consistent).withColumn("verbatim", F.expr("forall(pairs, x -> x.mine = x.theirs)"))
    return runs.groupBy(*(["ul_id"] if rows else ["doc_id", "item_id"])).agg(F.max("n_windows").alias("n_windows"), F.bool_or("verbatim").alias("verbatim"))


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no benchmark item, in the columns of ``docs``."""
    table = stage_table(whole_row(docs, doc_id=F.col("doc_id"), ul_text=F.col("text")).withColumn("ul_id", F.monotonically_increasing_id()), "documents")
    leaks = matches(table, benchmark, rows=True)
    return table.join(leaks.select("ul_id"), "ul_id", "left_anti").select("ul_row.*")


def _sql_words(text: str) -> str:
    t = f"regexp_replace(coalesce({text}, ''), '[¹²#]', ' ', 'g')"
    t = rf"regexp_replace({t}, '[^\p{{L}}\p{{N}}\s]+', '', 'g')"
    return rf"lower(regexp_replace({t}, '(^|\s)(\p{{Lu}})', '\1¹\2', 'g'))"


def _sql_template(cleaned: str) -> str:
    t = rf"regexp_replace({cleaned}, '¹[^\s]+', chr(1), 'g')"
    t = rf"replace(regexp_replace({t}, '\p{{N}}+', '#', 'g'), chr(1), '¹')"
    return rf"regexp_replace({t}, '#(\s?)({_UNIT})(\s|$)', '#\1²\3', 'g')"


def _sql_windows(name: str, key: str, table: str) -> str:
    words = r"list_filter(string_split_regex({0}, '\s+'), lambda w: w <> '')"
    return rf"""
{name}_a AS (SELECT {key}, rid, kind, CASE kind WHEN 0 THEN c ELSE replace(c, '¹', '') END AS c FROM (SELECT {key}, row_number() OVER () AS rid, {_sql_words('text')} AS c FROM {table}), (VALUES (0), (1)) k(kind)),
{name}_b AS (SELECT {key}, rid, kind, {words.format('c')} AS raw, {words.format(_sql_template('c'))} AS tpl FROM {name}_a),
{name}_c AS (SELECT {key}, rid, kind, raw, tpl, unnest(range(1, len(tpl) - {SIZE - 2})) AS p FROM {name}_b WHERE len(tpl) >= {SIZE}),
{name} AS (SELECT {key}, rid, kind, p, array_to_string(tpl[p : p + {SIZE - 1}], ' ') AS h,
  list_filter(range(p, p + {SIZE}), lambda k: regexp_matches(tpl[k], '[¹²#]')) AS sl, raw, tpl FROM {name}_c)"""


ORACLE_SQL = f"""
WITH {_sql_windows('d', 'doc_id', 'documents')}, {_sql_windows('b', 'item_id', 'benchmark')},
d_ok AS (SELECT * FROM d WHERE len(sl) <= {SIZE - PLAIN}), b_ok AS (SELECT * FROM b WHERE len(sl) <= {SIZE - PLAIN}),
b_run AS (SELECT rid, kind, count(*) AS n FROM (SELECT rid, kind, p - row_number() OVER (PARTITION BY rid, kind ORDER BY p) AS g FROM b_ok) GROUP BY rid, kind, g),
needs AS (SELECT rid AS brid, kind, least(max(n), {RUN}) AS need FROM b_run GROUP BY rid, kind),
hits AS (SELECT d_ok.doc_id, kind, d_ok.rid, d_ok.p, b_ok.item_id, b_ok.rid AS brid, d_ok.p - b_ok.p AS shift,
  list_transform(b_ok.sl, lambda k: {{'t': b_ok.tpl[k], 'mine': b_ok.raw[k], 'theirs': d_ok.raw[k + d_ok.p - b_ok.p]}}) AS pairs
  FROM d_ok JOIN b_ok USING (h, kind)),
isl AS (SELECT *, p - row_number() OVER (PARTITION BY rid, brid, kind, shift ORDER BY p) AS g FROM hits),
best AS (SELECT rid, brid, kind, shift, max(n) AS n_windows FROM (SELECT rid, brid, kind, shift, g, count(*) AS n FROM isl GROUP BY ALL) GROUP BY ALL),
runs AS (SELECT doc_id, rid, item_id, brid, kind, shift, list_distinct(flatten(list(pairs))) AS pairs FROM hits GROUP BY ALL)
SELECT doc_id, item_id, max(n_windows) AS n_windows, bool_or(len(list_filter(pairs, lambda x: x.mine <> x.theirs)) = 0) AS verbatim
FROM runs JOIN best USING (rid, brid, kind, shift) JOIN needs USING (brid, kind)
WHERE n_windows >= need
  AND len(pairs) = len(list_distinct(list_transform(pairs, lambda x: {{'t': x.t, 'v': x.mine}})))
  AND len(pairs) = len(list_distinct(list_transform(pairs, lambda x: {{'t': x.t, 'v': x.theirs}})))
GROUP BY doc_id, item_id
"""
