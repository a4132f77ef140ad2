"""The risk model: vocabulary, threat patterns, weights, caps and thresholds.

A model is a small immutable value on the driver. Its parts are inlined as
literals in column expressions, so scoring needs neither a join nor a broadcast.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

# --- Fixed values -----------------------------------------------------------
# Scores must agree with the published rules, so these are given as they are.
VIOLENT_TERMS = (
    "kill",
    "killing",
    "murder",
    "attack",
    "shoot",
    "shooting",
    "bomb",
    "bombing",
    "stab",
    "stabbing",
    "genocide",
    "execute",
    "execution",
    "lynch",
    "slaughter",
    "massacre",
    "terrorist",
    "terrorism",
)
HATE_TERMS = (
    "racist",
    "racism",
    "nazi",
    "nazis",
    "hitler",
    "subhuman",
    "vermin",
    "garbage",
    "retard",
    "retarded",
    "scum",
    "freaks",
    "trash",
    "animals",
)
INTENSIFIER_TERMS = (
    "very",
    "really",
    "extremely",
    "super",
    "totally",
    "literally",
    "so",
    "utterly",
    "completely",
)
THREAT_PATTERNS = (
    r"\bi[' ]?m going to (kill|hurt|beat|destroy)\b",
    r"\bi will (kill|hurt|beat|destroy)\b",
    r"\bwe should (kill|bomb|lynch|wipe out)\b",
    r"\b(deserve|deserves) to die\b",
    r"\bshould be (killed|shot|bombed|wiped out)\b",
)
# (feature, weight); the weighted sum runs left to right in this order.
WEIGHTS = (
    ("violent", 0.30),
    ("hate", 0.25),
    ("keyword_density", 0.15),
    ("threat", 0.15),
    ("all_caps", 0.10),
    ("intensifiers", 0.05),
)
LEXICON_CAP = 3.0
DENSITY_CAP = 0.1
CAPS_CAP = 0.3
HIGH = 0.8
MEDIUM = 0.5
# ----------------------------------------------------------------------------

FEATURES = ("violent", "hate", "keyword_density", "intensifiers", "threat", "all_caps")

_WORD = re.compile(r"\w+")


@dataclass(frozen=True)
class RiskModel:
    violent: tuple[str, ...] = VIOLENT_TERMS
    hate: tuple[str, ...] = HATE_TERMS
    intensifiers: tuple[str, ...] = INTENSIFIER_TERMS
    threats: tuple[str, ...] = THREAT_PATTERNS
    weights: tuple[tuple[str, float], ...] = WEIGHTS
    lexicon_cap: float = LEXICON_CAP
    density_cap: float = DENSITY_CAP
    caps_cap: float = CAPS_CAP
    high: float = HIGH
    medium: float = MEDIUM

    def __post_init__(self) -> None:
        for term in self.violent + self.hate + self.intensifiers:
            if not _WORD.fullmatch(term) or term != term.lower():
                raise ValueError(f"lexicon terms must be single lower-case words: {term!r}")
        unknown = {name for name, _ in self.weights} - set(FEATURES)
        if unknown:
            raise ValueError(f"unknown features in weights: {sorted(unknown)}")

    @property
    def vocabulary(self) -> tuple[str, ...]:
        return tuple(dict.fromkeys(self.violent + self.hate + self.intensifiers))


DEFAULT_MODEL = RiskModel()
