"""Default model configuration (the reference's own CASE lists and ranges).

A bound dataset (``torque.sources.bindings``) brings its own configuration;
these defaults describe the reference's car maker and are what the
generators and ``default_config`` use.
"""

from __future__ import annotations

import datetime as dt

from torque.sources.bindings import ModelConfig

# ---- fixed values: the reference's CASE lists (region by province, segment by model)
REGION_BY_PROVINCE = {
    "Catalonia": ["Barcelona", "Girona", "Lleida", "Tarragona"],
    "Madrid": ["Madrid"],
    "Valencia": ["Valencia", "Alicante", "Castellon"],
    "Andalusia": ["Seville", "Malaga", "Granada", "Cordoba", "Cadiz"],
    "Basque Country": ["Vizcaya", "Guipuzcoa", "Alava"],
}
SEGMENT_BY_MODEL = {
    "Electric": ["Born"],
    "SUV": ["Q3", "Arona", "Tiguan", "Formentor"],
    "Subcompact": ["Ibiza", "Polo"],
    "Compact": ["Leon", "Golf", "A3"],
}
# ---- fixed values: calendar range and generator date range of the reference
CALENDAR_START = dt.date(2022, 1, 1)
CALENDAR_END = dt.date(2025, 12, 31)
GENERATOR_START = dt.date(2023, 1, 1)
GENERATOR_END = dt.date(2024, 6, 30)


def default_config(now: dt.datetime | None = None, as_of: dt.date | None = None) -> ModelConfig:
    today = dt.date.today()
    return ModelConfig(segment_by_model=SEGMENT_BY_MODEL, region_by_province=REGION_BY_PROVINCE,
                       calendar_start=CALENDAR_START, calendar_end=CALENDAR_END,
                       as_of=as_of or today, now=now or dt.datetime.now())
