"""Job options.

Everything here is a small driver-side constant that ends up as a literal inside column expressions.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, fields
from typing import Any

# The default order in which extraction modes are tried.
DEFAULT_CHAIN = ("standard", "paddle_ocr", "ocr", "high_accuracy")


@dataclass(frozen=True)
class Normalization:
    bullet_char: str = "-"
    max_consecutive_newlines: int = 2

    def __post_init__(self) -> None:
        if self.max_consecutive_newlines < 0:
            raise ValueError("max_consecutive_newlines must not be negative")


@dataclass(frozen=True)
class Validation:
    min_char_count: int = 50
    max_repetition_count: int = 5
    repetition_min_length: int = 10
    min_extraction_ratio: float = 0.01

    def __post_init__(self) -> None:
        if self.max_repetition_count < 1 or self.repetition_min_length < 1:
            raise ValueError("repetition thresholds must be at least 1")


@dataclass(frozen=True)
class Modes:
    chain: tuple[str, ...] = DEFAULT_CHAIN
    extension_overrides: Mapping[str, str] = field(default_factory=dict)

    def escalation_order(self) -> tuple[str, ...]:
        """The configured chain; an empty one means the default."""
        return tuple(self.chain) or DEFAULT_CHAIN


@dataclass(frozen=True)
class Batch:
    continue_on_error: bool = True


@dataclass(frozen=True)
class Settings:
    normalization: Normalization = Normalization()
    validation: Validation = Validation()
    modes: Modes = Modes()
    batch: Batch = Batch()

    @classmethod
    def from_dict(cls, raw: Mapping[str, Any] | None) -> Settings:
        """Build settings from nested dictionaries; unset keys keep their defaults, unknown keys are ignored."""
        raw = raw or {}
        sections = {}
        for section in fields(cls):
            kind = type(section.default)
            given = raw.get(section.name) or {}
            known = {f.name: given[f.name] for f in fields(kind) if given.get(f.name) is not None}
            if "chain" in known:
                known["chain"] = tuple(known["chain"])
            sections[section.name] = kind(**known)
        return cls(**sections)
