"""Batch configuration: a mapping from YAML, with names filled in, looked up by path, and defaults."""

from __future__ import annotations

from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

from ..model import LIMITS, Limits, Profile, profile


def lookup(config: Any, *keys: str, default: Any = None) -> Any:
    """The value at a path of keys; the default where a level is missing or no mapping, but an explicit null stays null."""
    for key in keys:
        if not isinstance(config, dict) or key not in config:
            return default
        config = config[key]
    return config


@dataclass(frozen=True)
class Batch:
    """A batch's configuration, with every default resolved; its values enter plans as literals."""

    raw: dict = field(default_factory=dict)
    source: str = ""

    @property
    def batch_id(self) -> str:
        return str(self.raw.get("batch_id") or self.raw.get("batch_name") or "batch")

    @property
    def time_key(self) -> str:
        return str(lookup(self.raw, "runtime", "time_key", default=self.batch_id))

    @property
    def cameras(self) -> list[str]:
        return [f"CAM_{r}{c}" for r in lookup(self.raw, "camera", "rows", default=[]) for c in lookup(self.raw, "camera", "columns", default=[])]

    def path(self, name: str, given: str | None = None) -> str | None:
        """A path: given on the command line, else configured."""
        return given or lookup(self.raw, "paths", name)

    def required_path(self, name: str, given: str | None = None) -> str:
        found = self.path(name, given)
        if not found:
            raise ValueError(f"no path for {name}: neither given nor configured")
        return found

    def output_root(self, profile_name: str, given: str | None = None) -> tuple[str, bool]:
        """The output folder, and whether it is the profile's own folder already."""
        if given:
            return given, False
        own = lookup(self.raw, "paths", "profile_roots", profile_name)
        return (own, True) if own else (self.required_path("output_root"), False)

    @property
    def fps(self) -> float:
        return float(lookup(self.raw, "camera", "nominal_fps", default=59.94))

    def profile(self, name: str | None = None) -> Profile:
        name = name or str(lookup(self.raw, "export", "default_profile", default="benchmark"))
        own = lookup(self.raw, "export", name, default={}) or {}
        size = own.get("resize_target")
        return profile(name, jpeg_quality=own.get("jpeg_quality"), bit_depth=own.get("bit_depth"), resize=tuple(size) if size else None)

    @property
    def limits(self) -> Limits:
        own = lookup(self.raw, "export_validation", default={}) or {}
        names = {"samples": "default_samples", "upgraded_samples": "upgraded_samples", "black_ratio": "black_border_fail_threshold", "near_ratio": "near_black_warning_threshold"}
        return Limits(**{k: type(getattr(LIMITS, k))(own[v]) for k, v in names.items() if v in own})


def load(path: str | Path) -> Batch:
    import yaml

    file = Path(path).expanduser().resolve()
    raw = yaml.safe_load(file.read_text(encoding="utf-8"))
    if not isinstance(raw, dict):
        raise ValueError(f"{file} holds no mapping")
    return Batch(raw, str(file))


def named(batches: dict[str, dict], name: str, base: dict | None = None) -> Batch:
    """A batch by name: its own values over those that all batches share. An unknown name is an error."""
    if name not in batches:
        raise ValueError(f"unknown batch {name}; known: {', '.join(sorted(batches))}")

    def over(low, high):
        return {k: over(low[k], high[k]) if isinstance(low.get(k), dict) and isinstance(high.get(k), dict) else high.get(k, low.get(k)) for k in low | high}

    return Batch(over({"batch_id": name} | (base or {}), batches[name]), name)
