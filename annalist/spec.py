"""Column registry: which columns a table has and what role each one plays.

Everything else in the package takes a :class:`TableSpec` and derives its column
lists from it, so tracking one more column is a single registry entry.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

KEY = "key"  # identifies the entity
TRACKED = "tracked"  # a change opens a new period
FIXED = "fixed"  # a change is written over every period
TRANSIENT = "transient"  # used on the way in, not kept in the history table
ENGINEERED = "engineered"  # kept in the history table, not in the source


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    dtype: T.DataType
    role: str
    comment: str
    #: True: the source keeps the column's past values; False: only the present one
    source_historized: bool | None = None
    in_source: bool = True


@dataclass(frozen=True)
class TableSpec:
    columns: tuple[ColumnSpec, ...]
    #: names of the columns that carry a meaning for the operators
    effective_from: str
    effective_to: str
    treated_at: str
    period_count: str
    created_on: str
    state: str
    sector: str
    area: str
    start: str = "start_at"
    end: str = "end_at"
    batch_created: str = "batch_created"
    batch_closed: str = "batch_closed"
    batch_date: str = "batch_date"
    active_state: str = "A"
    closed_state: str = "F"
    #: names of the address struct and of the array of periods in nested records
    nested_address: str = "adresseEtablissement"
    nested_periods: str = "periodesEtablissement"

    def _names(self, *roles: str) -> list[str]:
        return [c.name for c in self.columns if c.role in roles]

    @property
    def key(self) -> str:
        return self._names(KEY)[0]

    @property
    def tracked(self) -> list[str]:
        return self._names(TRACKED)

    @property
    def fixed(self) -> list[str]:
        return self._names(FIXED)

    @property
    def attributes(self) -> list[str]:
        return self._names(TRACKED, FIXED)

    @property
    def history_columns(self) -> list[str]:
        """Columns of the history table, in registry order."""
        return self._names(KEY, TRACKED, FIXED, ENGINEERED)

    @property
    def source_tracked(self) -> list[str]:
        return [c.name for c in self.columns if c.source_historized is True]

    @property
    def source_current_only(self) -> list[str]:
        return [c.name for c in self.columns if c.source_historized is False]

    @property
    def source_columns(self) -> list[ColumnSpec]:
        return [c for c in self.columns if c.in_source]

    def column(self, name: str) -> ColumnSpec:
        return next(c for c in self.columns if c.name == name)

    def history_schema(self) -> T.StructType:
        return T.StructType([T.StructField(n, self.column(n).dtype) for n in self.history_columns])

    def source_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.dtype) for c in self.source_columns])


_STR, _BOOL, _DATE, _DBL = T.StringType(), T.BooleanType(), T.DateType(), T.DoubleType()
# Registry time stamps carry no zone, so they are read as zone-less ones.
_TS = T.TimestampNTZType()

# Names, types and order of the columns in the registry's files.
ESTABLISHMENTS = TableSpec(
    columns=(
        ColumnSpec("siret", _STR, KEY, "Establishment number"),
        ColumnSpec("dateCreationEtablissement", _DATE, FIXED, "Day the establishment was created"),
        ColumnSpec("etatAdministratifEtablissement", _STR, TRACKED, "A when open, F when closed", True),
        ColumnSpec("activitePrincipaleEtablissement", _STR, TRACKED, "Main activity, second nomenclature", True),
        ColumnSpec("activitePrincipaleNAF25Etablissement", _STR, TRACKED, "Main activity, 2025 nomenclature", False),
        ColumnSpec("caractereEmployeurEtablissement", _STR, TRACKED, "O when it employs people, else N", True),
        ColumnSpec("trancheEffectifsEtablissement", _STR, TRACKED, "Head count class", False),
        ColumnSpec("etablissementSiege", _BOOL, TRACKED, "Whether it is the head office", False),
        ColumnSpec("codePostalEtablissement", _STR, FIXED, "Postal code", False),
        ColumnSpec("codeCommuneEtablissement", _STR, FIXED, "Municipality code", False),
        ColumnSpec("libelleCommuneEtablissement", _STR, FIXED, "Municipality name", False),
        ColumnSpec("coordonneeLambertAbscisseEtablissement", _DBL, FIXED, "Lambert X, NULL when withheld", False),
        ColumnSpec("coordonneeLambertOrdonneeEtablissement", _DBL, FIXED, "Lambert Y, NULL when withheld", False),
        ColumnSpec("nombrePeriodesEtablissement", _STR, TRANSIENT, "Number of periods, as text"),
        ColumnSpec("dateDernierTraitementEtablissement", _TS, TRANSIENT, "Time the record was last treated"),
        ColumnSpec("dateDebut", _DATE, TRANSIENT, "First day of the present source period"),
        ColumnSpec("dateFin", _DATE, TRANSIENT, "Last day of a past source period", None, False),
        ColumnSpec("batch_created", _DATE, ENGINEERED, "Batch that created the row", None, False),
        ColumnSpec("batch_closed", _DATE, ENGINEERED, "Batch that closed the row", None, False),
        ColumnSpec("start_at", _DATE, ENGINEERED, "First day of the period", None, False),
        ColumnSpec("end_at", _DATE, ENGINEERED, "Day the period ended, NULL while it is open", None, False),
    ),
    effective_from="dateDebut",
    effective_to="dateFin",
    treated_at="dateDernierTraitementEtablissement",
    period_count="nombrePeriodesEtablissement",
    created_on="dateCreationEtablissement",
    state="etatAdministratifEtablissement",
    sector="activitePrincipaleEtablissement",
    area="codeCommuneEtablissement",
)
