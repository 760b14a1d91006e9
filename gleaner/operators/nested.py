"""Deeply nested records as flat child tables.

The merged schema is inferred over all records; each array level of it becomes a child table whose
rows carry the surrogate key of their parent, the place of the parent in its own list and their own
place. Where the lists and the wrappers around records stand is read from that schema. Two passes: one
infers it, one parses each payload once, as VARIANT, and gives all tables without a shuffle.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The kinds that occur at each path of the records. A path has field names, and '[]' for the elements of a list.
Schema = dict[tuple[str, ...], set[str]]


@dataclass(frozen=True)
class Level:
    """One array level: `path` within the parent element, and whether a value standing alone is a list of one."""

    name: str
    path: str
    lone: bool = True
    children: tuple[Level, ...] = field(default=())


def _kinds(value: Any, found: set[tuple[tuple[str, ...], str]]) -> None:
    """Adds the (path, kind) of a JSON value and of all it holds; text that is a JSON list or object counts as both."""
    stack: list[tuple[tuple[str, ...], Any]] = [((), value)]
    while stack:
        at, v = stack.pop()
        kind = "OBJECT" if isinstance(v, dict) else "ARRAY" if isinstance(v, list) else "NULL" if v is None else "STRING" if isinstance(v, str) else "OTHER"
        found.add((at, kind))
        if kind == "OBJECT":
            stack.extend(((*at, k), x) for k, x in v.items())
        elif kind == "ARRAY":
            stack.extend(((*at, "[]"), x) for x in v)
        elif kind == "STRING" and at and v.lstrip()[:1] in ("[", "{"):
            inner = _read_json(v)
            if isinstance(inner, (dict, list)):
                stack.append((at, inner))


def _read_json(text: str | None) -> Any:
    try:
        return None if text is None else json.loads(text, strict=False)
    except (ValueError, RecursionError):
        return None


def merged_schema(df: DataFrame, value: str) -> Schema:
    """The merged schema of a column of JSON text (or VARIANT), over all rows.

    Payloads are read once, each task gives its set of (path, kind), and only their union, which has
    the size of the schema, comes to the driver. An empty table gives no path.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: set[tuple[tuple[str, ...], str]] = set()
        for b in batches:
            for text in b.column(0).to_pylist():
                _kinds(_read_json(text), found)
        rows = sorted(found)
        yield pa.RecordBatch.from_arrays([pa.array([list(p) for p, _ in rows], pa.list_(pa.string())), pa.array([k for _, k in rows], pa.string())], ["path", "kind"])

    text = F.to_json(value) if df.schema[value].dataType.typeName() == "variant" else F.col(value)
    schema: Schema = {}
    for path, kind in df.select(text.alias("v")).where("v is not null").mapInArrow(read, "path array<string>, kind string").distinct().collect():
        schema.setdefault(tuple(path), set()).add(kind)
    return schema


def wrapper_paths(schema: Schema, marks: Sequence[str]) -> list[tuple[str, ...]]:
    """The paths of the objects that have one of the fields `marks`, outermost first: where records may stand."""
    found = {p[:-1] for p in schema if p and p[-1] in marks and "[]" not in p}
    return sorted((p for p in found if "OBJECT" in schema.get(p, ())), key=lambda p: (len(p), p))


def unwrapped(schema: Schema, wrappers: Sequence[tuple[str, ...]]) -> Schema:
    """The schema of the records that stand at any of `wrappers`; without wrappers the schema itself."""
    out: Schema = {}
    for w in wrappers or [()]:
        deeper = [x for x in wrappers if len(x) > len(w) and x[: len(w)] == w]
        for path, kinds in schema.items():
            if path[: len(w)] == w and not any(path[: len(x)] == x for x in deeper):
                out.setdefault(path[len(w) :], set()).update(kinds)
    return out


def levels_of(schema: Schema, only_lists: Sequence[tuple[str, ...]] = (), lists: Sequence[str] = ()) -> tuple[Level, ...]:
    """The array levels of a merged schema, outermost first.

    A path is a level if it is a list in any record, or is a field named in `lists`. Where other
    records hold a single value there, that value is a list of one and its fields are those of an
    element, unless the path is in `only_lists`; JSON text of a list or an object counts as what it holds.
    """

    def is_list(path: tuple[str, ...], kinds: set[str]) -> bool:
        return "ARRAY" in kinds or (path[-1:] != ("[]",) and path[-1:] and path[-1] in lists)

    folded: Schema = {}
    for path, kinds in schema.items():
        inside: tuple[str, ...] = ()
        for i, step in enumerate(path):
            inside = (*inside, step)
            if is_list(path[: i + 1], schema.get(path[: i + 1], set())) and path[i + 1 : i + 2] != ("[]",) and i + 1 < len(path):
                inside = (*inside, "[]")
        folded.setdefault(inside, set()).update(kinds)

    def under(prefix: tuple[str, ...]) -> tuple[Level, ...]:
        out = []
        for path, kinds in sorted(folded.items()):
            inner = path[len(prefix) :]
            if inner and is_list(path, kinds) and path[: len(prefix)] == prefix and not any(is_list(path[:i], folded.get(path[:i], set())) for i in range(len(prefix) + 1, len(path))) and "[]" not in inner:
                out.append(Level(inner[-1], "$" + "".join(f"['{p}']" for p in inner), path not in set(only_lists), under((*path, "[]"))))
        return tuple(out)

    return under(())


def parse_objects(df: DataFrame, payload: str, wrappers: Sequence[tuple[str, ...]] = (), marks: Sequence[str] = ()) -> DataFrame:
    """`df` with VARIANT `record`: the JSON object of `payload`, null where it is no readable object.

    A record may stand inside the objects at the paths `wrappers`, outermost first; the first of them
    that has a field in `marks` is the record, and the payload's own object if none has.
    """
    v = F.try_parse_json(F.col(payload))
    whole = F.when(F.schema_of_variant(v).startswith("OBJECT<"), v)
    df = df.withColumn("__whole", whole)

    def marked(path: tuple[str, ...]) -> Column:
        p = "$" + "".join(f"['{x}']" for x in path)
        inner = F.try_variant_get("__whole", p, "variant")
        has = F.lit(False)
        for m in marks:
            has = has | F.try_variant_get("__whole", f"{p}['{m}']", "variant").isNotNull()
        return F.when(has, inner)

    record = F.coalesce(*[marked(p) for p in wrappers], F.col("__whole")) if wrappers else F.col("__whole")
    return df.withColumn("record", record).drop("__whole")


#: Text that may hold a list or an object.
JSON_TEXT = r"^\s*[\[{]"


def _entries(value: Column, level: Level) -> Column:
    as_list = F.try_variant_get(value, level.path, "array<variant>")
    if not level.lone:
        return as_list
    text = F.try_variant_get(value, level.path, "string")
    inside = F.when(text.rlike(JSON_TEXT), F.try_parse_json(text))
    alone = F.coalesce(inside, F.try_variant_get(value, level.path, "variant"))
    return F.coalesce(as_list, F.try_variant_get(inside, "$", "array<variant>"), F.when(alone.isNotNull() & ~F.is_variant_null(alone), F.array(alone)))


def _rows(value: Column, key: Column, parent_pos: Column, level: Level, names: dict[str, str]) -> Column:
    table = names.get(level.name, level.name)
    entries = _entries(value, level)
    child_key = lambda i: F.xxhash64(key, F.lit(table), i)
    own = F.transform(
        entries,
        lambda x, i: F.struct(
            F.lit(table).alias("child_table"), key.alias("parent_key"), parent_pos.cast("long").alias("parent_pos"), i.cast("long").alias("pos"), child_key(i).alias("child_key"), x.alias("value")
        ),
    )

    def below(child: Level) -> Column:
        return F.flatten(F.transform(entries, lambda x, i: _rows(x, child_key(i), i, child, names)))

    parts = [own, *map(below, level.children)]
    if len(parts) == 1:
        return F.coalesce(own, F.array().cast(ROWS))
    return F.concat(*[F.coalesce(p, F.array().cast(ROWS)) for p in parts])


ROWS = "array<struct<child_table:string,parent_key:bigint,parent_pos:bigint,pos:bigint,child_key:bigint,value:variant>>"


def child_rows(df: DataFrame, keep: Sequence[str], levels: Sequence[Level], names: dict[str, str] | None = None, rejected: str | None = None) -> DataFrame:
    """All child rows of VARIANT `record`, one for each non-null list entry.

    Columns: `keep`, child_table, parent_key (surrogate key of the parent), parent_pos (-1 below the
    record itself), pos (from 0 in the list as delivered, nulls counted), child_key and value. A missing
    or empty list gives no row, a null record none or, if `rejected` names a table for them, one of
    that table with places -1 and a null value. Clashing column names cannot occur: `keep` is selected
    by name and the rest is ours.
    """
    key = F.xxhash64(*[F.col(c).cast("string") for c in keep])
    every = F.concat(*[_rows(F.col("record"), key, F.lit(-1), lv, names or {}) for lv in levels]) if levels else F.array().cast(ROWS)
    there = F.col("value").isNotNull() & ~F.is_variant_null("value")
    if rejected:
        nowhere = F.lit(-1).cast("long")
        bad = F.struct(F.lit(rejected).alias("child_table"), key.alias("parent_key"), nowhere.alias("parent_pos"), nowhere.alias("pos"), key.alias("child_key"), F.lit(None).cast("variant").alias("value"))
        every = F.when(F.col("record").isNull(), F.array(bad)).otherwise(every)
        there = there | (F.col("child_table") == rejected)
    return df.select(*keep, F.inline(every)).where(there)


def as_text(v: Column) -> Column:
    """A VARIANT as text: a string as it is, anything else as JSON."""
    return F.coalesce(F.try_variant_get(v, "$", "string"), F.to_json(v))


# The fields that mark a record, the fields of a record that are lists however they are
# written, and the names and item fields of its child tables.
MARKS = ("evidence_data", "eligibility", "identity")
LISTS = ("evidence_data", "linked_eligibility_documents", "other_eligibility_rules", "entries_sample")
TABLES = {"value": "evidence_value"}
ITEMS = {"evidence_data": "$.field", "linked_eligibility_documents": "$.url"}
#: A list here is a child table, a single value is a value.
FREE_VALUES = (("evidence_data", "[]", "value"),)


def raw_layout(raw: DataFrame) -> tuple[list[tuple[str, ...]], tuple[Level, ...]]:
    """Where the records of raw_records stand in their payloads, and their array levels, both from the merged schema."""
    schema = merged_schema(raw, "payload")
    wrappers = wrapper_paths(schema, MARKS)
    return wrappers, levels_of(unwrapped(schema, wrappers), FREE_VALUES, LISTS)


def raw_children(raw: DataFrame) -> DataFrame:
    """(record_id, child_table, parent_pos, pos, item) of raw_records.

    A payload that is no readable JSON object (null included) gives one row 'rejected', -1, -1, ''.
    Only the tables of the problem come out; a child without its item field has the item ''.
    """
    wrappers, levels = raw_layout(raw)
    records = parse_objects(raw.select("record_id", "payload"), "payload", wrappers, MARKS)
    rows = child_rows(records, ["record_id"], levels, TABLES, "rejected")
    item = F.lit(None).cast("string")
    for t, p in ITEMS.items():
        item = F.when(F.col("child_table") == t, F.try_variant_get("value", p, "string")).otherwise(item)
    plain = ~F.col("child_table").isin(*ITEMS)
    return (
        rows.where(F.col("child_table").isin(*LISTS, *TABLES.values(), "rejected"))
        .select("record_id", "child_table", "parent_pos", "pos", F.coalesce(F.when(plain, as_text(F.col("value"))).otherwise(item), F.lit("")).alias("item"))
        .distinct()
    )
