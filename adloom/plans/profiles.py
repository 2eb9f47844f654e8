"""Built-in source profiles (UDF-2): what differs between kinds of sources, under neutral names."""

from __future__ import annotations

from adloom.functions import fixed_values as V
from adloom.plans import flatten as L
from adloom.plans import listings as P
from adloom.sources.registry import SourceProfile, register_source
from adloom.sources.schemas import COLUMNS

BUILT_IN = [
    SourceProfile("unified", labels=V.GENERIC_LABELS, columns=tuple(COLUMNS["unified"]), flatten=P.parse_listings),
    SourceProfile("unified_reversed", labels=V.REVERSED_LABELS, columns=tuple(COLUMNS["unified"]), flatten=P.parse_listings),
    SourceProfile("classified_raw", columns=tuple(COLUMNS["classified_raw"]), flatten=L.flatten_classified),
    SourceProfile("classified_wide", columns=tuple(COLUMNS["classified_wide"]), flatten=L.flatten_classified_wide),
    SourceProfile("advert_raw", labels=V.ADVERT_LABELS, columns=tuple(COLUMNS["advert_raw"]), flatten=L.flatten_advert),
    SourceProfile("advert_wide", labels=V.ADVERT_LABELS, columns=tuple(COLUMNS["advert_wide"]), flatten=L.flatten_advert_wide),
    SourceProfile("portal_raw", labels=V.PORTAL_LABELS, columns=tuple(COLUMNS["portal_raw"]), flatten=P.portal_listings),
    SourceProfile("portal_wide", labels=V.PORTAL_LABELS, columns=tuple(COLUMNS["portal_wide"]), flatten=P.portal_listings),
    SourceProfile("grid_raw", labels=V.GRID_LABELS, columns=tuple(COLUMNS["grid_raw"]), flatten=P.grid_details),
    SourceProfile("accordion_wide", labels=V.ACCORDION_LABELS, columns=tuple(COLUMNS["accordion_wide"]), flatten=P.accordion_details),
]


def register_built_in() -> None:
    for profile in BUILT_IN:
        register_source(profile, replace=True)
