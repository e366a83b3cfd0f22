"""The feature contract: sequence shape, vocabularies and numeric ranges, checked exactly at start-up."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

# The 52 fields of a raw line in order.
RAW_FIELDS = (
    "EVENT_ID EVENT_RESULT DURATION REQUEST_RETRIES SUB_TYPE MSISDN IMSI MTMSI IMEISV MMEGI MMEC TAC ECI SGW SGSN L_CAUSE_PROT_TYPE CAUSE_CODE SUB_CAUSE_CODE APN "
    "PDN_DEFAULT_BEARER_ID PDN_PAA PDN_PGW ORIGINATING_CAUSE_PROT_TYPE ORIGINATING_CAUSE_CODE CSG_ID OLD_MTMSI OLD_TAC OLD_MMEGI OLD_MMEC OLD_ECI OLD_SGW OLD_SGSN MSC "
    "TARGET_LAC LAC RAC CI HANDOVER_NODE_ROLE HANDOVER_RAT_CHANGE_TYPE HANDOVER_SGW_CHANGE_TYPE TARGET_RNC_ID TARGET_MACRO_ENODEB_ID SRVCC_TYPE CS_FALLBACK_SERVICE_TYPE "
    "CSFB_TRIGGERED L_SERVICE_REQ_TRIGGER COMBINED_TAU_TYPE DETACH_TRIGGER EVENT_TIME PAGING_ATTEMPTS UE_REQUESTED_APN DATE_HOUR"
).split()

# Vocabularies; an id is the position in lexicographic order, from the given start.
EVENT_IDS = "l_attach l_bearer_modify l_dedicated_bearer_activate l_dedicated_bearer_deactivate l_detach l_handover l_pdn_connect l_pdn_disconnect l_service_request l_tau".split()
EVENT_RESULTS = ["", "abort", "reject", "success"]
CAUSES = ["", *"0 10 11 13 15 16 17 26 3 30 31 32 34 38 39 40 43 53 6 65 7 73 87 88 9 unspecified".split()]
SUB_CAUSES = ["", *"1 102 104 107 108 109 11 12 13 14 15 16 17 2 204 3 304 306 308 311 312 315 316 317 318 403 405 410 413 419 420 422 423 424 427 428 429 430 435 440 441 5 503 504 505 506 507 509 603 605 606 607 608 610 611 7 704 706 709 710 8 9".split()]


class ContractError(ValueError):
    """A contract, configuration or vocabulary that can't be used."""


def vocabulary(words: list[str], start: int = 0) -> dict[str, int]:
    return {w: i for i, w in enumerate(sorted(words), start)}


def check_vocabulary(name: str, entries: dict) -> dict[str, int]:
    """Trimmed, lower-cased keys with distinct non-negative ids."""
    if not entries:
        raise ContractError(f"{name}: empty vocabulary")
    out: dict[str, int] = {}
    for key, code in entries.items():
        if key is None or not isinstance(code, int) or isinstance(code, bool) or code < 0:
            raise ContractError(f"{name}: bad entry {key!r}: {code!r}")
        word = key.strip().lower()
        if word in out or code in out.values():
            raise ContractError(f"{name}: {key!r} or its id {code} is there twice")
        out[word] = code
    return out


@dataclass(frozen=True)
class Numeric:
    name: str
    top: float
    transform: str  # log1p_minmax or clipped_minmax
    bottom: float = 0.0
    missing: float = -1.0


@dataclass(frozen=True)
class Contract:
    version: str = "gold-ue-sequence-feature-v2"
    length: int = 32
    stride: int = 8
    padding: str = "LEFT"
    categorical: dict = field(
        default_factory=lambda: {
            "event_code": vocabulary(EVENT_IDS, 1),
            "event_result_code": vocabulary(EVENT_RESULTS),
            "normalized_cause_code": vocabulary(CAUSES),
            "sub_cause_code": vocabulary(SUB_CAUSES),
        }
    )
    numeric: tuple = (Numeric("duration_ms", 600_000, "log1p_minmax"), Numeric("request_retries", 10, "clipped_minmax"))

    def __post_init__(self):
        if self.length <= 0 or not 1 <= self.stride <= self.length:
            raise ContractError("length must be positive and stride between 1 and length")
        for name, words in self.categorical.items():
            check_vocabulary(name, words)
        for n in self.numeric:
            if n.transform not in ("log1p_minmax", "clipped_minmax") or n.top < n.bottom:
                raise ContractError(f"{n.name}: bad range or transform")


def require_exact(given: Contract, expected: Contract | None = None) -> Contract:
    """The contract, or an error that names what differs. Vocabularies compare without order."""
    a, b = asdict(given), asdict(expected or Contract())
    wrong = [k for k in b if a[k] != b[k]]
    if wrong:
        raise ContractError("the feature contract differs in " + ", ".join(wrong))
    return given


def load(path: str) -> Contract:
    """A contract from YAML or JSON, held against the built-in one."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    if path.endswith(".json"):
        raw = json.loads(text)
    else:
        import yaml

        raw = yaml.safe_load(text)
    raw["numeric"] = tuple(Numeric(**n) for n in raw.get("numeric", [])) or Contract().numeric
    return require_exact(Contract(**raw))
