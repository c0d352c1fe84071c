"""What a load needs to know about its datasets."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import StructField, StructType

from tidemark.operators.sizes import BROADCAST_LIMIT
from tidemark.sources.table_pages import TablePages


@dataclass(frozen=True)
class Dataset:
    """A remote dataset: its landing name, staging schema and reader options.

    With ``table`` its pages come from a Spark table instead.
    """

    name: str
    schema: StructType
    reader: dict[str, str] = field(default_factory=dict, repr=False)  # may hold a token
    table: TablePages | None = field(default=None, repr=False)

    @property
    def staging_name(self) -> str:
        return f"stg_{self.name}"


@dataclass(frozen=True)
class Lookup:
    """The reference value that is nested next to a column of the main dataset."""

    column: str
    reference_name: str
    reference_value: str
    value_field: str


@dataclass(frozen=True)
class LoadSpec:
    """One target table fed by a main and a reference dataset."""

    main: Dataset
    reference: Dataset
    lookup: Lookup
    target_name: str
    target_columns: tuple[str, ...]
    keys: tuple[str, ...]
    keep_target: tuple[str, ...] = ()
    null_safe_keys: bool = False
    strict: bool = True
    # Partition the target by month of this key column and rewrite single months.
    month_of: str | None = None
    broadcast_limit: int = BROADCAST_LIMIT
    # Bytes from which a side is worth measuring the other for; None is the default.
    worth_sparing: int | None = None

    def __post_init__(self):
        if self.month_of is not None and self.month_of not in self.keys:
            # Only a key column keeps a row and its match in the same month.
            raise ValueError(f"month_of must be one of the keys {self.keys}: {self.month_of}")

    @property
    def target_schema(self) -> StructType:
        """Staging types, with the looked-up column as a struct; order of the target."""
        value = self.reference.schema[self.lookup.reference_value].dataType
        fields = []
        for name in self.target_columns:
            declared = self.main.schema[name]
            if name == self.lookup.column:
                nested = StructType().add(name, declared.dataType)
                declared = StructField(name, nested.add(self.lookup.value_field, value))
            fields.append(declared)
        return StructType(fields)
