"""Per-subscriber sequences in batch: too-late events, count windows, sample ids and feature encoding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from uelumen.contract import Contract
from uelumen.functions import times
from uelumen.functions.text import sha256
from uelumen.operators import scans
from uelumen.operators.routes import Routed, settle

TOLERANCE_MS = 30_000
# Fields shown as evidence.
EVIDENCE = "event_id event_name event_result event_result_label duration_ms event_time msisdn imsi mtmsi imeisv mmegi mmec sub_cause_code msc tac eci sgw sgsn pdn_pgw".split()


def evidence_map(df: DataFrame, names: list[str] = EVIDENCE) -> Column:
    """name -> text of the named columns, else of the raw fields in upper case; null is left out, '' kept."""
    names = [n.strip().lower() for n in names]
    if "" in names or len(set(names)) != len(names):
        raise ValueError("evidence fields must be distinct and not blank")
    shown = {f.name: F.col(f"display.{f.name}") for f in df.schema["display"].dataType.fields} if "display" in df.columns else {}
    own = [F.col(n).cast("string") if n in df.columns else shown.get(n, F.try_element_at("raw_fields", F.lit(n.upper()))) for n in names]
    return F.map_filter(F.map_from_arrays(F.array(*map(F.lit, names)), F.array(*own)), lambda k, v: v.isNotNull())


def to_gold_events(silver: DataFrame, contract: Contract | None = None, carry: list[str] = ()) -> DataFrame:
    """Silver rows as sequence events, with the columns ``carry`` beside; a row without the raw cause fields fails the job."""
    contract = contract or Contract()
    codes = contract.categorical

    def required(name: str) -> Column:
        value = F.try_element_at("raw_fields", F.lit(name))
        return F.when(value.isNull(), F.raise_error(F.lit(f"raw field {name} is missing"))).otherwise(value)

    lookup = lambda c, words: F.try_element_at(F.create_map(*[F.lit(x) for kv in words.items() for x in kv]), c)
    q = lambda n: F.col(f"quality.{n}")
    quality = F.create_map(
        F.lit("identity_resolution_source"), F.lower(q("identity_resolution_source")), F.lit("event_id_changed"), q("event_id_changed").cast("string"), F.lit("event_result_changed"), q("event_result_changed").cast("string"),
        F.lit("event_result_recognized"), q("event_result_recognized").cast("string"), F.lit("warnings"), F.array_join(q("warnings"), "|"),
    )
    return silver.select(
        "ue_key", "imsi", "event_id", "event_result", required("CAUSE_CODE").alias("normalized_cause_code"), required("SUB_CAUSE_CODE").alias("sub_cause_code"), "duration_ms", "request_retries",
        lookup(F.col("event_id"), codes["event_code"]).alias("event_code"), lookup(F.col("event_result"), codes["event_result_code"]).alias("event_result_code"),
        times.epoch_millis(F.col("event_time")).alias("event_time_epoch_ms"), evidence_map(silver).alias("feature_source_fields"),
        F.create_map(F.lit("event_name"), F.col("display.event_name"), F.lit("event_result_label"), F.col("display.event_result_label"), F.lit("event_time"), F.col("event_time"), F.lit("tac"), F.coalesce("tac", F.lit("")), F.lit("eci"), F.coalesce("eci", F.lit(""))).alias("display_fields"),
        quality.alias("quality_fields"), F.col("raw_record_id").alias("source_order_key"), *carry,
    )


def split_too_late(events: DataFrame, *, key: str = "ue_key", ts: str = "event_time_epoch_ms", arrival: list[str], tolerance_ms: int = TOLERANCE_MS, block: Column | None = None) -> Routed:
    """``accepted`` and ``too_late``: at or before what was already released, the greatest time so far less the tolerance.

    ``block``: stretches of the arrival, each a task of its own (:data:`scans.OFFSETS` wide where it isn't given)."""
    block = scans.default_block(events, arrival[0], scans.OFFSETS) if block is None else block
    rows = scans.seen_before(events, ts, arrival, [F.col(key)], block, "ul_seen")
    late = F.coalesce(F.col(ts) <= F.col("ul_seen") - tolerance_ms, F.lit(False))
    return Routed({"accepted": rows.filter(~late).drop("ul_seen"), "too_late": rows.filter(late).drop("ul_seen")})


#: Windows that begin in a stretch of so many strides are one task's.
STRETCH = 512


def windows(events: DataFrame, *, key: str = "ue_key", order: tuple[str, ...] = ("event_time_epoch_ms", "source_order_key"), length: int = 32, stride: int = 8, block: Column | None = None, stretch: int = STRETCH) -> DataFrame:
    """(key, window_no, events): every ``stride`` rows of a key in order, ``length`` rows; no partial windows.

    One shuffle by key serves the numbering, the chunks of ``stride`` rows and the windows, each some chunks in a row: a row is
    copied once into its chunk and once into each window that holds it.

    With ``block`` (stretches of the order, such as hours) no key is one task's: rows are numbered by blocks and prefix sums, and dealt by stretches of
    ``stretch`` strides. A stretch also gets the first ``length - stride`` rows of the next one, the halo that its last windows reach into. ``events`` is read twice then.
    """
    by, mine = [key], F.lit(True)
    if block is None:
        w = Window.partitionBy(key).orderBy(*order)
        rows = events.withColumn("ul_n", F.row_number().over(w) - 1)
    else:
        stretch = max(stretch, -(-length // stride))  # the halo lies in one stretch
        size = stretch * stride
        own = F.floor(F.col("ul_n") / size).cast("long")
        halo = (own > 0) & (F.col("ul_n") % size < length - stride)
        rows = scans.numbered(events, [key], list(order), block, "ul_n").withColumn("ul_stretch", F.explode(F.when(halo, F.array(own, own - 1)).otherwise(F.array(own))))
        rows = rows.repartition(key, "ul_stretch")
        by, mine = [key, "ul_stretch"], F.floor(F.col("window_no") / stretch) == F.col("ul_stretch")
    chunks = rows.groupBy(*by, F.floor(F.col("ul_n") / stride).alias("window_no")).agg(F.array_sort(F.collect_list(F.struct("ul_n", F.struct(*events.columns).alias("e"))), lambda a, b: (a["ul_n"] - b["ul_n"]).cast("int")).alias("chunk"))
    by_chunk = Window.partitionBy(*by).orderBy("window_no")
    empty = F.slice("chunk", 1, 0)
    whole = F.concat("chunk", *[F.coalesce(F.lead("chunk", k).over(by_chunk), empty) for k in range(1, -(-length // stride))])
    made = chunks.select(*by, "window_no", F.slice(whole, 1, length).alias("ul_w")).filter((F.size("ul_w") == length) & mine)
    return made.select(key, "window_no", F.transform("ul_w", lambda x: x["e"]).alias("events"))


def ordered(events: Column, ts: str = "event_time_epoch_ms") -> Column:
    """True if no event is before its predecessor and all are of one subscriber."""
    times_ = F.transform(events, lambda e: e[ts])
    keys = F.array_distinct(F.transform(events, lambda e: F.struct(e["ue_key"], e["imsi"])))
    return (times_ == F.array_sort(times_)) & (F.size(keys) == 1)


def sample_id(ue: Column, start: Column, end: Column, parts: Column) -> Column:
    """SHA-256 of subscriber, start, end and ``id@key`` of every event, joined by ``|``."""
    return sha256(ue, F.lit("|"), start, F.lit("|"), end, F.lit("|"), F.array_join(parts, "|"))


def _codes(words: dict[str, int]) -> Column:
    return F.create_map(*[F.lit(x) for kv in words.items() for x in kv])


def categorical(value: Column, words: dict[str, int]) -> Column:
    """struct(code, reason): the id of the trimmed lower-case word, or MISSING_VALUE or UNKNOWN_CATEGORY."""
    word = F.lower(F.regexp_replace(value, r"\A[\x00-\x20]+|[\x00-\x20]+\z", ""))
    code = F.try_element_at(_codes(words), word).cast("long")
    missing = word.isNull() if "" in words else word.isNull() | (word == "")
    return F.struct(F.when(~missing, code).alias("code"), F.when(missing, "MISSING_VALUE").when(code.isNull(), "UNKNOWN_CATEGORY").alias("reason"))


def numeric(value: Column, rule) -> Column:
    """Float in [0, 1], or the missing value for null; cast to float before the last clamp."""
    clipped = F.least(F.greatest(value.cast("double"), F.lit(float(rule.bottom))), F.lit(float(rule.top)))
    if rule.top == rule.bottom:
        scaled = F.lit(0.0)
    elif rule.transform == "log1p_minmax":
        low, high = F.log1p(F.lit(float(rule.bottom))), F.log1p(F.lit(float(rule.top)))
        scaled = (F.log1p(clipped) - low) / (high - low)
    else:
        scaled = (clipped - rule.bottom) / (rule.top - rule.bottom)
    fit = F.least(F.greatest(scaled.cast("float"), F.lit(0.0).cast("float")), F.lit(1.0).cast("float"))
    return F.when(value.isNull(), F.lit(rule.missing).cast("float")).otherwise(fit)


# The field each categorical feature reads.
SOURCES = {"event_code": "event_id", "event_result_code": "event_result", "normalized_cause_code": "normalized_cause_code", "sub_cause_code": "sub_cause_code"}


def encode(samples: DataFrame, contract: Contract | None = None) -> DataFrame:
    """``x_cat``, ``x_num`` and ``fault`` (feature_name, reason, rejected_value of the first failure by time step and feature)."""
    contract = contract or Contract()
    cats, nums = list(contract.categorical.items()), contract.numeric
    coded = F.transform("events", lambda e: F.array(*[categorical(e[SOURCES[n]], words) for n, words in cats]))
    out = settle(samples, ul_coded=coded)
    faults = F.flatten(
        F.transform(
            F.arrays_zip(F.col("events").alias("events"), F.col("ul_coded").alias("coded")),
            lambda z: F.filter(
                F.array(*[F.struct(F.lit(n).alias("feature_name"), z["coded"][i]["reason"].alias("reason"), z["events"][SOURCES[n]].alias("rejected_value")) for i, (n, _) in enumerate(cats)]),
                lambda f: f["reason"].isNotNull(),
            ),
        )
    )
    shape = F.struct(F.lit("sequence").alias("feature_name"), F.lit("INVALID_SEQUENCE_LENGTH").alias("reason"), F.size("events").cast("string").alias("rejected_value"))
    hollow = F.struct(F.lit("sequence").alias("feature_name"), F.lit("NULL_SEQUENCE_EVENT").alias("reason"), F.lit(None).cast("string").alias("rejected_value"))
    fault = F.when(F.size("events") != contract.length, shape).when(F.exists("events", lambda e: e.isNull()), hollow).otherwise(F.get(faults, F.lit(0)))
    x_num = F.transform("events", lambda e: F.array(*[numeric(e[r.name], r) for r in nums]))
    x_cat = F.transform("ul_coded", lambda t: F.transform(t, lambda s: s["code"]))
    return settle(out, fault=fault, x_cat=x_cat, x_num=x_num).drop("ul_coded")


def gold_samples(events: DataFrame, contract: Contract | None = None, *, failed_at: Column | None = None, block: Column | None = None) -> Routed:
    """``gold`` samples and ``invalid_feature`` records of the windows of accepted events."""
    contract = contract or Contract()
    return samples_of(windows(events, length=contract.length, stride=contract.stride, block=block), contract, failed_at=failed_at)


def samples_of(made: DataFrame, contract: Contract | None = None, *, failed_at: Column | None = None) -> Routed:
    """The same of windows (ue_key, window_no, events). A window out of order, or of two subscribers, fails the job."""
    contract = contract or Contract()
    made = made.withColumn("events", F.when(ordered(F.col("events")), F.col("events")).otherwise(F.raise_error(F.lit("the events of a window are out of order"))))
    first, last = F.get("events", F.lit(0)), F.get("events", F.lit(contract.length - 1))
    iso = lambda ms: times.normalise(F.lpad(ms.cast("string"), 13, "0"))
    made = settle(made, start_ms=first["event_time_epoch_ms"], end_ms=last["event_time_epoch_ms"], imsi=first["imsi"])
    made = settle(made, window_start_event_time=iso(F.col("start_ms")), window_end_event_time=iso(F.col("end_ms")))
    parts = F.transform("events", lambda e: F.concat(e["event_id"], F.lit("@"), e["source_order_key"]))
    made = settle(made, sample_id=sample_id(F.col("ue_key"), F.col("window_start_event_time"), F.col("window_end_event_time"), parts))
    coded = encode(made, contract)
    gold = coded.filter("fault IS NULL").select(
        F.lit("gold-sequence-v1").alias("schema_version"), F.lit(contract.version).alias("feature_version"), "sample_id", "ue_key", "imsi", "window_start_event_time", "window_end_event_time",
        F.lit(contract.length).alias("sequence_length"), F.lit(contract.stride).alias("stride"), F.struct("x_cat", "x_num").alias("model_input"), F.struct("events").alias("evidence"),
    )
    window = F.struct(F.lit("gold-sequence-v1").alias("schema_version"), F.lit(contract.version).alias("feature_version"), "sample_id", "ue_key", "imsi", F.col("start_ms").alias("window_start_event_time_epoch_ms"), F.col("end_ms").alias("window_end_event_time_epoch_ms"), F.lit(contract.length).alias("sequence_length"), F.lit(contract.stride).alias("stride"), "events")
    invalid = coded.filter("fault IS NOT NULL").select(
        F.lit("invalid-gold-feature-v1").alias("schema_version"), F.concat_ws(":", "sample_id", "fault.feature_name", "fault.reason").alias("invalid_feature_id"), "sample_id", "ue_key", "imsi",
        F.lit(contract.version).alias("feature_version"), F.col("fault.feature_name").alias("feature_name"), F.col("fault.reason").alias("reason"), F.col("fault.rejected_value").alias("rejected_value"),
        F.concat(F.lit("feature "), F.col("fault.feature_name"), F.lit(": "), F.col("fault.reason")).alias("error_message"), (failed_at if failed_at is not None else times.now_iso()).alias("failed_at"), window.alias("rejected_window"),
    )
    return Routed({"gold": gold, "invalid_feature": invalid})


def contract_fault(contract: Contract | None = None) -> Column:
    """The first violation of the contract by a gold sample (null if none): version, shape, ids, ranges, evidence."""
    contract = contract or Contract()
    x_cat, x_num = F.col("model_input.x_cat"), F.col("model_input.x_num")
    ranges = [(min(w.values()), max(w.values())) for w in contract.categorical.values()]
    ids = F.forall(x_cat, lambda row: F.forall(F.transform(row, lambda v, i: (v >= F.get(F.array(*[F.lit(a) for a, _ in ranges]), i)) & (v <= F.get(F.array(*[F.lit(b) for _, b in ranges]), i))), lambda ok: F.coalesce(ok, F.lit(False))))
    reals = F.forall(x_num, lambda row: F.forall(row, lambda v: (v == -1.0) | ((v >= 0.0) & (v <= 1.0))))
    checks = [
        (F.col("schema_version") != "gold-sequence-v1", "schema_version"),
        (F.col("feature_version") != contract.version, "feature_version"),
        (F.col("sequence_length") != contract.length, "sequence_length"),
        (F.col("stride") != contract.stride, "stride"),
        (F.coalesce("sample_id", F.lit("")) == "", "sample_id"),
        (F.coalesce("ue_key", F.lit("")) == "", "ue_key"),
        ((F.size(x_cat) != contract.length) | ~F.forall(x_cat, lambda r: F.size(r) == len(ranges)), "x_cat shape"),
        ((F.size(x_num) != contract.length) | ~F.forall(x_num, lambda r: F.size(r) == len(contract.numeric)), "x_num shape"),
        (~ids, "x_cat range"),
        (~reals, "x_num range"),
        (F.size("evidence.events") != contract.length, "evidence length"),
    ]
    out = F.lit(None).cast("string")
    for fault, name in reversed(checks):
        out = F.when(F.coalesce(fault, F.lit(True)), name).otherwise(out)
    return out
