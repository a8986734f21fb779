"""Raw values into the types of a table, at any depth; what does not fit is kept as text with its path.

Types form a lattice: two of them have a narrowest one that holds both, so types
found in different files can be merged in any order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.functions import qualified

# A CSV record that has more or fewer values than there are columns, as it was read.
RECORD = "__record"
# What a whole record is called among the rescued values.
RECORD_NAME = "_record"

NESTED = (T.StructType, T.ArrayType, T.MapType)
_NUMBERS = [T.IntegerType(), T.LongType(), T.DoubleType()]
_TIMES = [T.DateType(), T.TimestampType()]


def holding(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that holds the values of both; text holds everything."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return merged_fields(a, b, holding)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(holding(a.elementType, b.elementType))
    if isinstance(a, T.MapType) and isinstance(b, T.MapType) and a.keyType == b.keyType:
        return T.MapType(a.keyType, holding(a.valueType, b.valueType))
    for chain in (_NUMBERS, _TIMES):
        if a in chain and b in chain:
            return max(a, b, key=chain.index)
    return T.StringType()


def widened(known: T.DataType, found: T.DataType) -> T.DataType:
    """``known`` with the fields that ``found`` has beyond it, at any depth; what is known keeps its type."""
    if isinstance(known, T.StructType) and isinstance(found, T.StructType):
        return merged_fields(known, found, widened)
    if isinstance(known, T.ArrayType) and isinstance(found, T.ArrayType):
        return T.ArrayType(widened(known.elementType, found.elementType))
    if isinstance(known, T.MapType) and isinstance(found, T.MapType):
        return T.MapType(known.keyType, widened(known.valueType, found.valueType))
    return known


def merged_fields(a: T.StructType, b: T.StructType, merge) -> T.StructType:
    """Fields of both by name, in order of appearance; those of both are merged."""
    fields = {f.name.lower(): f for f in a.fields}
    for f in b.fields:
        old = fields.get(f.name.lower())
        new = T.StructField(old.name, merge(old.dataType, f.dataType), metadata=old.metadata) if old else f
        fields[f.name.lower()] = T.StructField(new.name, new.dataType, metadata=new.metadata)
    return T.StructType(list(fields.values()))


def as_text(kind: T.DataType) -> T.DataType:
    """The same shape with every plain value as text."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, as_text(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(as_text(kind.elementType))
    if isinstance(kind, T.MapType):
        return T.MapType(T.StringType(), as_text(kind.valueType))
    return T.StringType()


#: A place in a value: its path, its text, and whether it was lost.
Misfit = tuple[str, Column, Column]


def converted(raw: Column, found: T.DataType, wanted: T.DataType, path: str) -> tuple[Column, list[Misfit]]:
    """``raw`` as ``wanted``, and the places below ``path`` that do not fit.

    Within lists and maps a misfit loses its whole list or map to the rescued
    values, since its place there has no name.
    """
    if found == wanted:
        return raw, []
    if isinstance(wanted, T.StringType):
        return (F.to_json(raw) if isinstance(found, NESTED) else raw.cast("string")), []
    if isinstance(found, T.StructType) and isinstance(wanted, T.StructType):
        return _struct(raw, found, wanted, path)
    if isinstance(found, T.StringType) and isinstance(wanted, NESTED):
        # Text that holds a document is read as one; only text that is none is a misfit as a whole.
        shape = as_text(wanted)
        document = F.from_json(raw, shape.simpleString() if not isinstance(shape, T.StructType) else shape, {"mode": "PERMISSIVE"})
        opened = F.when(F.trim(raw).startswith("[" if isinstance(wanted, T.ArrayType) else "{"), document)
        value, misfits = converted(opened, shape, wanted, path)
        return value, [(path, raw, raw.isNotNull() & opened.isNull()), *misfits]
    if isinstance(found, T.ArrayType) and isinstance(wanted, T.ArrayType):
        value = F.transform(raw, lambda x: converted(x, found.elementType, wanted.elementType, path)[0])
        lost = F.exists(raw, lambda x: _any_lost(converted(x, found.elementType, wanted.elementType, path)[1]))
        return value, [(path, F.to_json(raw), F.coalesce(lost, F.lit(False)))]
    if isinstance(found, T.MapType) and isinstance(wanted, T.MapType):
        value = F.transform_values(raw, lambda _, x: converted(x, found.valueType, wanted.valueType, path)[0])
        lost = F.exists(F.map_values(raw), lambda x: _any_lost(converted(x, found.valueType, wanted.valueType, path)[1]))
        return value, [(path, F.to_json(raw), F.coalesce(lost, F.lit(False)))]
    if isinstance(found, NESTED) or isinstance(wanted, NESTED):
        text = F.to_json(raw) if isinstance(found, NESTED) else raw.cast("string")
        return F.lit(None).cast(wanted), [(path, text, raw.isNotNull())]
    value = raw.try_cast(wanted)
    return value, [(path, raw.cast("string"), raw.isNotNull() & value.isNull())]


def _struct(raw: Column, found: T.StructType, wanted: T.StructType, path: str) -> tuple[Column, list[Misfit]]:
    fields, misfits = [], []
    have = {f.name.lower(): f for f in found.fields}
    for target in wanted.fields:
        source = have.pop(target.name.lower(), None)
        if source is None:
            fields.append(F.lit(None).cast(target.dataType).alias(target.name))
            continue
        value, below = converted(raw.getField(source.name), source.dataType, target.dataType, f"{path}.{target.name}")
        fields.append(value.alias(target.name))
        misfits += below
    for unknown in have.values():
        value = raw.getField(unknown.name)
        text = F.to_json(value) if isinstance(unknown.dataType, NESTED) else value.cast("string")
        misfits.append((f"{path}.{unknown.name}", text, value.isNotNull()))
    return F.when(raw.isNotNull(), F.struct(*fields)), misfits


def _any_lost(misfits: list[Misfit]) -> Column:
    lost = F.lit(False)
    for _, _, condition in misfits:
        lost = lost | condition
    return lost


def typed(
    df: DataFrame, schema: T.StructType, rescued_column: str | None = None, unseen: Sequence[str] = ()
) -> DataFrame:
    """Convert columns to ``schema``; what does not fit becomes null, as do absent columns.

    With a ``rescued_column`` the raw text of every misfit is kept there as a
    JSON object ``{path: text}``, null if the whole row fits; the columns of
    ``unseen`` are kept nowhere else, nor are values beyond the last column,
    whose whole record is kept as ``_record``.
    """
    outputs: list[Column] = []
    misfits: list[Misfit] = []
    targets = {f.name.lower(): f for f in schema.fields}
    for found in df.schema.fields:
        raw = qualified(found.name)
        if found.name == RECORD:
            misfits.append((RECORD_NAME, raw, raw.isNotNull()))
            continue
        if found.name in unseen:
            misfits.append((found.name, converted(raw, found.dataType, T.StringType(), found.name)[0], raw.isNotNull()))
            continue
        target = targets.pop(found.name.lower(), None)
        value, below = converted(raw, found.dataType, target.dataType, found.name) if target else (raw, [])
        outputs.append(value.alias(found.name))
        misfits += below
    outputs += [F.lit(None).cast(absent.dataType).alias(absent.name) for absent in targets.values()]
    if rescued_column:
        outputs.append(_rescued(misfits).alias(rescued_column))
    return df.select(*outputs)


def _rescued(misfits: list[Misfit]) -> Column:
    if not misfits:
        return F.lit(None).cast("string")
    entries: list[Column] = []
    for name, text, lost in misfits:
        entries += [F.lit(name), F.when(lost, text)]
    kept = F.map_filter(F.create_map(*entries), lambda _, text: text.isNotNull())
    return F.when(F.size(kept) > 0, F.to_json(kept))
