"""UDF-2: named source profiles, looked up instead of importing code from configured paths."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class SourceProfile:
    """What is specific to one source: its labels, its columns and how a payload is flattened."""

    name: str
    kind: str = "cars"
    labels: Mapping[str, str] = field(default_factory=dict)
    columns: tuple[str, ...] = ()
    flatten: Callable[..., DataFrame] | None = None


_PROFILES: dict[str, SourceProfile] = {}


def register_source(profile: SourceProfile, replace: bool = False) -> None:
    if profile.name in _PROFILES and not replace:
        raise ValueError(f"source {profile.name!r} is registered already")
    _PROFILES[profile.name] = profile


def get_source(name: str, kind: str = "cars") -> SourceProfile:
    """The profile, or the plain profile of its kind when the name is unknown."""
    fallback = SourceProfile(kind if kind == "cars" else "realestate", kind)
    return _PROFILES.get(name, fallback)


def registered_sources() -> list[str]:
    return sorted(_PROFILES)
