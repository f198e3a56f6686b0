"""Declarations of the tables a pipeline reads, conforms and publishes."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, replace

from pyspark.sql import types as T


def schema_of(columns: Mapping[str, str] | T.StructType) -> T.StructType:
    """A schema from names and types such as ``string``, ``long`` or ``double``.

    Needs no session, so specs can be declared at import.
    """
    if isinstance(columns, T.StructType):
        return columns
    schema = T.StructType()
    for name, type_name in columns.items():
        schema.add(name, type_name)
    return schema


@dataclass(frozen=True)
class TableSpec:
    """A conformed table: its columns in published order and its rules.

    ``clean`` names the columns turned into upper-case ASCII; ``required`` the
    columns that may be neither null nor empty; ``key`` the columns that
    identify a row; ``stamp`` the ingestion timestamp appended last.
    """

    name: str
    schema: Mapping[str, str] | T.StructType
    key: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    clean: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()
    stamp: str | None = "dt_ingestion"
    format: str = "parquet"

    def __post_init__(self) -> None:
        object.__setattr__(self, "schema", schema_of(self.schema))
        for rule in ("key", "required", "clean", "partition_by"):
            unknown = [c for c in getattr(self, rule) if c not in self.columns]
            if unknown:
                raise ValueError(f"{self.name}: {rule} names undeclared columns {unknown}")
        other = [c for c in self.clean if not isinstance(self.schema[c].dataType, T.StringType)]
        if other:
            raise ValueError(f"{self.name}: only text can be cleaned, not {other}")
        loose = [c for c in self.partition_by if c not in self.required]
        if loose:
            # A file-based partition cannot tell '' from null, so neither may reach it.
            raise ValueError(f"{self.name}: partition columns {loose} must be required")

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    @property
    def published_schema(self) -> T.StructType:
        if self.stamp is None:
            return self.schema
        return T.StructType(self.schema.fields + [T.StructField(self.stamp, T.TimestampType())])

    def narrowed(self, columns: Iterable[str], *extra: T.StructField) -> TableSpec:
        """The same rules over fewer columns, plus ``extra`` pass-through fields."""
        kept = [c for c in self.columns if c in set(columns)]
        return replace(
            self,
            schema=T.StructType([self.schema[c] for c in kept] + list(extra)),
            key=(),
            required=tuple(c for c in self.required if c in kept),
            clean=tuple(c for c in self.clean if c in kept),
            partition_by=(),
            stamp=None,
        )


@dataclass(frozen=True)
class CountSpec:
    """A published count of rows per ``keys``.

    ``quantity_type`` is part of the published schema. A narrower type than the
    default can be declared; an integer fails beyond 2,147,483,647 rows in a group.
    """

    name: str
    keys: tuple[str, ...]
    quantity: str = "quantity"
    quantity_type: T.DataType = T.LongType()
    stamp: str | None = "dt_ingestion"
    format: str = "parquet"

    def table(self, source: TableSpec) -> TableSpec:
        """The spec of the table this count publishes from ``source``."""
        fields = [source.schema[k] for k in self.keys]
        fields.append(T.StructField(self.quantity, self.quantity_type))
        return TableSpec(
            self.name, T.StructType(fields), key=self.keys, stamp=self.stamp, format=self.format
        )
