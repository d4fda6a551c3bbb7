"""What is particular to a region: its places, words and searches, as one configuration object."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, fields

from pyspark.sql import Column

from . import scalars


@dataclass(frozen=True)
class Region:
    """name; domestic: markers of a domestic place; languages; searches: templates by kind of entity, with {name} and {year}."""

    name: str = "Turkey"
    domestic: tuple[str, ...] = tuple(scalars.DOMESTIC)
    languages: tuple[str, ...] = ("tr", "en")
    searches: dict[str, tuple[str, ...]] = field(default_factory=lambda: {"startup": ("{name} yatırım {year}", "{name} funding {year}"), "investor": ("{name} portfolio {year}",), "ecosystem": ("{name} program {year}",)})

    def is_domestic(self, place: Column) -> Column:
        from pyspark.sql import functions as F

        return scalars.has_any(F.lower(place), list(self.domestic))

    def queries(self, kind: str, name: str, year: int) -> list[str]:
        return [t.format(name=name, year=year) for t in self.searches.get(kind, ("{name}",))]


def load(path: str | None = None) -> Region:
    """The region of a JSON file; fields that it does not name, and no file, keep the defaults. Unknown fields are an error."""
    if path is None:
        return Region()
    with open(path, encoding="utf-8") as f:
        given = json.load(f)
    unknown = set(given) - {x.name for x in fields(Region)}
    if unknown:
        raise ValueError(f"unknown fields of a region: {sorted(unknown)}")
    return Region(**{k: tuple(v) if isinstance(v, list) else {a: tuple(b) for a, b in v.items()} if isinstance(v, dict) else v for k, v in given.items()})
