"""Job parameters. Small driver-side values, checked when they are built."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from datetime import date

from lexspark.functions.ids import CELEX, PROCEDURE

DOCUMENT_TYPES = ("regulation", "directive", "decision", "proposal")
TYPE_CODES = {"regulation": "R", "directive": "L", "decision": "D", "proposal": "PC"}


@dataclass(frozen=True)
class Metadata:
    project_name: str = "Legal corpus dataset"
    author: str = ""
    description: str = "A dataset of structured legal documents."
    date_created: date = field(default_factory=date.today)
    version: str = "1.0"


@dataclass(frozen=True)
class DiscoverSpec:
    """Select documents by type, date, sector and keyword concept."""

    start_date: date
    end_date: date
    document_types: frozenset[str] = frozenset({"regulation", "directive", "decision"})
    filter_keywords: frozenset[str] = frozenset()
    include_corrigenda: bool = False
    include_consolidated_texts: bool = False
    include_national_transpositions: bool = False

    def __post_init__(self):
        object.__setattr__(self, "document_types", frozenset(self.document_types))
        object.__setattr__(self, "filter_keywords", frozenset(self.filter_keywords))
        for name in ("start_date", "end_date"):
            value = getattr(self, name)
            if not isinstance(value, date):
                raise ValueError(f"{name} must be a date")
            if value >= date.today():
                raise ValueError(f"{name} must be in the past")
        if self.start_date > self.end_date:
            raise ValueError("start_date must not be after end_date")
        unknown = sorted(self.document_types - set(DOCUMENT_TYPES))
        if unknown:
            raise ValueError(f"unknown document types: {', '.join(unknown)}")

    @property
    def type_codes(self) -> list[str]:
        return [TYPE_CODES[t] for t in DOCUMENT_TYPES if t in self.document_types]


@dataclass(frozen=True)
class ListSpec:
    """Select documents by identifier and/or procedure number."""

    celex_ids: frozenset[str] = frozenset()
    procedure_numbers: frozenset[str] = frozenset()

    def __post_init__(self):
        ids = {i.strip().upper() for i in self.celex_ids}
        bad = sorted(i for i in ids if not re.match(CELEX, i))
        if bad:
            raise ValueError(f"invalid document ids: {', '.join(bad)}")
        # numbers are checked as given, before they are normalised
        bad = sorted(n for n in self.procedure_numbers if not re.match(PROCEDURE, n))
        if bad:
            raise ValueError(f"invalid procedure numbers: {', '.join(bad)}")
        if not ids and not self.procedure_numbers:
            raise ValueError("give at least one document id or procedure number")
        numbers = {n.strip().upper().replace("(", "/").replace(")", "") for n in self.procedure_numbers}
        object.__setattr__(self, "celex_ids", frozenset(ids))
        object.__setattr__(self, "procedure_numbers", frozenset(numbers))


@dataclass(frozen=True)
class ExtractionSpec:
    include_recitals: bool = True
    include_articles: bool = True
    include_annexes: bool = True

    @property
    def unit_types(self) -> list[str]:
        flags = (self.include_recitals, self.include_articles, self.include_annexes)
        return [t for t, on in zip(("recital", "article", "annex"), flags) if on]


@dataclass(frozen=True)
class RelationSpec:
    include_relations: bool = True
    include_original_act_relations: bool = False


@dataclass(frozen=True)
class OutputSpec:
    formats: frozenset[str] = frozenset({"csv", "parquet"})
    include_raw_full_text: bool = False

    def __post_init__(self):
        object.__setattr__(self, "formats", frozenset(self.formats))
        unknown = sorted(self.formats - {"csv", "parquet"})
        if unknown:
            raise ValueError(f"unknown output formats: {', '.join(unknown)}")


@dataclass(frozen=True)
class JobSpec:
    data: DiscoverSpec | ListSpec
    metadata: Metadata = field(default_factory=Metadata)
    extraction: ExtractionSpec = ExtractionSpec()
    relations: RelationSpec = RelationSpec()
    output: OutputSpec = OutputSpec()

    @property
    def mode(self) -> str:
        return "discover" if isinstance(self.data, DiscoverSpec) else "list"


