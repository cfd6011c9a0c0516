"""Source registry: a new source is a spec with a parser, nothing more."""

from __future__ import annotations

from dataclasses import dataclass

from firmfold.sources import parsers
from firmfold.sources.parsers import Parser, Provenance


@dataclass(frozen=True)
class SourceSpec:
    id: str
    license: str
    base_url: str
    parse: Parser
    paginated: bool = True
    default_limit: int | None = None   # records per region; None takes all
    sensitive: bool = False            # holds natural persons; off unless enabled

    @property
    def provenance(self) -> Provenance:
        return Provenance(self.id, self.base_url, self.license)


_REGISTRY: dict[str, SourceSpec] = {}


def register(spec: SourceSpec) -> SourceSpec:
    _REGISTRY[spec.id] = spec
    return spec


# Ids and order of the built-in sources. The order decides which
# record comes first where several sources know one business. Base addresses
# are placeholders; pass your own spec to point a source elsewhere.
for _spec in (
    SourceSpec("overpass", "ODbL", "https://www.openstreetmap.org", parsers.parse_poi_pages,
               paginated=False),
    SourceSpec("directory", "open directory data", "https://directory.example",
               parsers.parse_directory_pages),
    SourceSpec("htmldir", "open listing data", "https://listing.example",
               parsers.parse_listing_html),
    SourceSpec("ebeszamolo", "public company data", "https://companies.example",
               parsers.parse_registry_pages),
    SourceSpec("kozbeszerzes", "public procurement data", "https://awards.example",
               parsers.parse_award_pages),
    SourceSpec("mkik", "public chamber data", "https://chamber.example",
               parsers.parse_registry_pages),
    SourceSpec("opencorporates", "open company data", "https://opencompanies.example",
               parsers.parse_registry_pages),
    SourceSpec("evny", "sole-trader register, personal data", "https://soletraders.example",
               parsers.parse_sole_trader_pages, sensitive=True),
):
    register(_spec)


def get_source(source_id: str) -> SourceSpec:
    if source_id not in _REGISTRY:
        raise ValueError(f"unknown source {source_id!r}; known: {', '.join(_REGISTRY)}")
    return _REGISTRY[source_id]


def list_sources() -> list[SourceSpec]:
    return list(_REGISTRY.values())


def gate_sensitive_sources(requested: list[str] | None, enabled: frozenset[str] | set[str] = frozenset()
                           ) -> list[SourceSpec]:
    """Sources of a run, in registry order.

    With nothing requested, sensitive sources that are not enabled are left
    out; asking for one by name raises.
    """
    if requested is None:
        return [s for s in list_sources() if not s.sensitive or s.id in enabled]
    chosen = [get_source(i) for i in requested]
    for spec in chosen:
        if spec.sensitive and spec.id not in enabled:
            raise PermissionError(f"source {spec.id!r} holds personal data and is not enabled")
    return chosen


def source_ordinal(source_id: str) -> int:
    return list(_REGISTRY).index(get_source(source_id).id)
