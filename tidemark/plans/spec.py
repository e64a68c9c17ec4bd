"""What varies between collections, as data."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import types as T

from tidemark.functions.docs import CHANGED_AT, ENVELOPE_KEY, KEY, SEQ, DATE_FIELD, is_wrapped_date


@dataclass(frozen=True)
class CollectionSpec:
    """One collection of the document store and the table kept for it.

    name            landing sub-directory
    doc_schema      document fields of the snapshot
    keys            merge key, names of table columns
    change_schema   document fields of the changes, where they differ
    array           nested array to flatten, with `child_fields` and `child_prefix`
    flatten_changes False where change documents are flat already
    unwrap          wrapped dates that become bare numbers
    parents         set: merge whole documents by these columns (children that are gone go)
    options         further options of `merge`
    keep_bad        documents that cannot be parsed go to a side table and not into the merge
    on_read         batches are appended and resolved when the table is read, until it is compacted
    buckets         the table is cut into so many buckets of its key, or more if its snapshot is
                    large; a merge reads and writes the touched ones only
    """

    name: str
    doc_schema: T.StructType
    keys: tuple[str, ...] = (KEY,)
    change_schema: T.StructType | None = None
    array: str | None = None
    child_fields: tuple[str, ...] = ()
    child_prefix: str = ""
    flatten_changes: bool = True
    unwrap: tuple[str, ...] = ()
    parents: tuple[str, ...] = ()
    options: Mapping[str, Any] = field(default_factory=dict)
    seq_type: T.DataType = field(default_factory=T.LongType)
    keep_bad: bool = False
    on_read: bool = False
    buckets: int = 64

    def with_(self, **changes: Any) -> CollectionSpec:
        return replace(self, **changes)

    @property
    def bucket_keys(self) -> tuple[str, ...]:
        return self.parents or self.keys

    def table_schema(self) -> T.StructType:
        """Columns of the curated table: envelope, document fields, child fields last."""
        fields = [
            T.StructField(ENVELOPE_KEY, T.StringType()),
            T.StructField(SEQ, self.seq_type),
            T.StructField(CHANGED_AT, T.TimestampType()),
        ]
        for f in self.doc_schema:
            if f.name == self.array:
                continue
            bare = f.name in self.unwrap and is_wrapped_date(f.dataType)
            fields.append(T.StructField(f.name, f.dataType[DATE_FIELD].dataType if bare else f.dataType))
        if self.array:
            element = self.doc_schema[self.array].dataType.elementType
            fields += [T.StructField(self.child_prefix + c, element[c].dataType) for c in self.child_fields]
        return T.StructType(fields)

    def change_fields(self) -> list[str]:
        """Document fields a change needs: those the table takes, and the array."""
        schema = self.change_schema or self.doc_schema
        taken = set(self.table_schema().fieldNames()) | {self.array}
        return [f.name for f in schema if f.name in taken]
