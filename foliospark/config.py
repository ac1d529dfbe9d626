"""Configuration of a corpus: closed, typed settings from YAML; an unknown key or a value out of bounds is an error."""

from __future__ import annotations

from dataclasses import dataclass, field, fields, is_dataclass
from pathlib import Path
from typing import Any, get_type_hints

from .operators.cleaning import CleanupRules
from .sources.files import DEFAULT_RULES, Rule


def _bounds(name: str, value: float, low: float, high: float = float("inf"), open_low: bool = False) -> None:
    if not low <= value <= high or (open_low and value == low):
        raise ValueError(f"{name} = {value} is out of bounds")


@dataclass(frozen=True)
class FamilySettings:
    threshold: float = 0.95
    shingle_size: int = 5
    num_perm: int = 64
    hash_family: str = "linear"

    def __post_init__(self):
        _bounds("threshold", self.threshold, 0, 1, open_low=True)
        _bounds("shingle_size", self.shingle_size, 1)
        _bounds("num_perm", self.num_perm, 1)


@dataclass(frozen=True)
class ChunkSettings:
    kind: str = "markdown"  # a name among the registered chunkers
    size: int = 1000
    overlap: int = 200

    def __post_init__(self):
        _bounds("size", self.size, 1)
        _bounds("overlap", self.overlap, 0, self.size)


@dataclass(frozen=True)
class RetrievalSettings:
    top_k: int = 5
    page_tolerance: int = 2
    near_copy_threshold: float | None = None
    width: int = 64
    temperature: float = 0.0

    def __post_init__(self):
        _bounds("top_k", self.top_k, 1)
        _bounds("width", self.width, 1)
        _bounds("temperature", self.temperature, 0, 2)


@dataclass(frozen=True)
class Config:
    input_targets: list[str] = field(default_factory=lambda: ["data/raw"])
    output: str = "data/tables"
    extract: bool = True
    clean: bool = True
    cleanup: CleanupRules = CleanupRules()
    families: FamilySettings = FamilySettings()
    chunks: ChunkSettings = ChunkSettings()
    retrieval: RetrievalSettings = RetrievalSettings()
    file_rules: list[Rule] = field(default_factory=lambda: list(DEFAULT_RULES))


def build(kind: type, data: Any, at: str = "") -> Any:
    """An instance of a settings class from plain mappings and lists."""
    if not isinstance(data, dict):
        raise ValueError(f"{at or 'the configuration'} must be a mapping")
    hints, known = get_type_hints(kind), {f.name for f in fields(kind)}
    if unknown := sorted(set(data) - known):
        raise ValueError(f"unknown settings: {', '.join(at + str(u) for u in unknown)}")
    out = {}
    for k, v in data.items():
        hint = hints[k]
        if is_dataclass(hint):
            v = build(hint, v, f"{at}{k}.")
        elif k == "file_rules":
            v = [build(Rule, r, f"{at}{k}.") for r in v]
        elif isinstance(v, list) and str(hint).startswith("tuple"):
            v = tuple(v)
        elif hint in (int, float) and (isinstance(v, bool) or not isinstance(v, (int, float)) or (hint is int and int(v) != v)):
            raise ValueError(f"{at}{k} must be a number")
        elif hint is bool and not isinstance(v, bool):
            raise ValueError(f"{at}{k} must be true or false")
        out[k] = v
    return kind(**out)


def load(path: str) -> Config:
    """The settings in a YAML file; a missing file is an error, an empty one gives the defaults."""
    import yaml

    return build(Config, yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {})
