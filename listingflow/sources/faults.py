"""What is wrong with a document, field by field: ``array<struct<path, fault>>`` from a declared schema.

The declaration is compiled to column expressions over the parsed document (a variant), so every document is checked where
it is read and no part of it leaves the JVM. Paths are as a reader would write them: ``groups.0.results.3.price``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.patterns import bind

FAULTS = "array<struct<path: string, fault: string>>"
_KINDS = {"VOID": "null", "STRING": "string", "BOOLEAN": "boolean", "ARRAY": "array", "OBJECT": "object"} | dict.fromkeys(("BIGINT", "DOUBLE", "DECIMAL", "FLOAT"), "number")


@dataclass(frozen=True)
class Rules:
    """What a schema does not say. Names are paths without positions (``groups.results.id``): ``required`` fields must be
    there and not null, ``enums`` lists the values a field may have, ``nullable`` fields may hold a null though they are
    required."""

    required: frozenset[str] = frozenset()
    nullable: frozenset[str] = frozenset()
    enums: Mapping[str, Sequence[str]] = field(default_factory=dict)


def _declared(kind: T.DataType) -> str:
    if isinstance(kind, (T.StructType, T.MapType)):
        return "object"
    if isinstance(kind, T.ArrayType):
        return "array"
    return "boolean" if isinstance(kind, T.BooleanType) else "number" if isinstance(kind, T.NumericType) else "string"


def _fault(path: Column, text: Column) -> Column:
    return F.array(F.struct(path.alias("path"), text.alias("fault")))


class _Compiler:
    """Column expressions of one schema; what every field uses is made once."""

    def __init__(self, rules: Rules):
        self.rules = rules
        self.none = F.array().cast(FAULTS)
        self.kinds = F.create_map(*[F.lit(x) for pair in _KINDS.items() for x in pair])
        self.itself, self.dot, self.required = F.lit("$"), F.lit("."), F.lit("required")
        self.whole = F.lit("expected a whole number")

    def kind(self, value: Column) -> Column:
        """What a variant holds, in the words of JSON."""
        return F.element_at(self.kinds, F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0))

    def check(self, value: Column, kind: T.DataType, path: Column, name: str) -> Column:
        """Faults of one value, which is null where the field is missing."""
        return bind(value, lambda v: self._faults(v, kind, path, name))

    def _faults(self, value: Column, kind: T.DataType, path: Column, name: str) -> Column:
        required, wanted = name in self.rules.required, _declared(kind)
        found = self.kind(value)
        wrong = _fault(path, F.concat(F.lit(f"expected {wanted}, found "), found))
        out = F.when(value.isNull(), _fault(path, self.required) if required else self.none)
        if not required or name in self.rules.nullable:
            out = out.when(F.is_variant_null(value), self.none)
        out = out.when(found != wanted, wrong)
        inside = self._inside(value, kind, path, name)
        return out.otherwise(self.none if inside is None else F.coalesce(inside, self.none))

    def _inside(self, value: Column, kind: T.DataType, path: Column, name: str) -> Column | None:
        get = lambda of: F.try_variant_get(value, self.itself, of)
        if isinstance(kind, T.StructType):
            return self.members(value, kind, path, name)
        if isinstance(kind, T.ArrayType):
            return F.flatten(F.transform(get("array<variant>"), lambda item, i: self.check(item, kind.elementType, F.concat(path, self.dot, i.cast("string")), name)))
        if isinstance(kind, T.MapType):
            return F.flatten(F.transform(F.map_entries(get("map<string,variant>")), lambda e: self.check(e["value"], kind.valueType, F.concat(path, self.dot, e["key"]), name)))
        if name in self.rules.enums:
            text, listed = get("string"), self.rules.enums[name]
            return F.when(text.isin(*listed), self.none).otherwise(_fault(path, F.concat(F.lit(f"expected one of {', '.join(listed)}, found "), text)))
        if isinstance(kind, T.IntegralType):
            number = get("double")
            return F.when(number == F.floor(number), self.none).otherwise(_fault(path, self.whole))
        return None

    def members(self, value: Column, kind: T.StructType, path: Column | None, name: str) -> Column:
        parts = []
        for f in kind.fields:
            own = F.lit(f.name) if path is None else F.concat(path, F.lit(f".{f.name}"))
            parts.append(self.check(F.try_variant_get(value, F.lit(f"$['{f.name}']"), "variant"), f.dataType, own, f"{name}.{f.name}" if name else f.name))
        return F.flatten(F.array(*parts))


def document_faults(text: Column, schema: str | T.StructType, rules: Rules = Rules()) -> Column:
    """The faults of a JSON document, in the order of the schema; empty for a sound one. Text that is no JSON, or no
    object, has one fault at the root. Fields that the schema does not name are ignored."""
    kind = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    compiler, root = _Compiler(rules), F.lit("(root)")

    def checked(document: Column) -> Column:
        found = compiler.kind(document)
        return (
            F.when(document.isNull(), _fault(root, F.lit("not valid JSON")))
            .when(found != "object", _fault(root, F.concat(F.lit("expected object, found "), found)))
            .otherwise(compiler.members(document, kind, None, ""))
        )

    return bind(F.try_parse_json(text), checked)


def fault_rows(documents: DataFrame, key: str, text: str, schema: str | T.StructType, rules: Rules = Rules()) -> DataFrame:
    """``key, path, fault``: one row per fault."""
    return documents.select(F.col(key).alias(key), F.explode(document_faults(F.col(text), schema, rules)).alias("f")).select(key, "f.path", "f.fault")


def require_sound(documents: DataFrame, key: str, text: str, schema: str | T.StructType, rules: Rules = Rules()) -> DataFrame:
    """``documents``; a job that reads a faulty one fails and names the document, the paths and what is wrong there."""
    faults = document_faults(F.col(text), schema, rules)
    lines = F.array_join(F.transform(F.slice(faults, 1, 20), lambda f: F.concat(f["path"], F.lit(": "), f["fault"])), "; ")
    said = F.concat(F.col(key).cast("string"), F.lit(" failed schema validation: "), lines)
    return documents.withColumn(text, F.when(F.size(faults) == 0, F.col(text)).otherwise(F.raise_error(said).cast("string")))


#: What a capture document must hold beyond its schema.
CAPTURE_RULES = Rules(
    required=frozenset({
        "source", "captured_at", "groups", "groups.origin", "groups.mode", "groups.max_travel_minutes", "groups.results", "groups.results.id", "groups.results.address",
    }),
    enums={"groups.mode": ("walk", "drive", "transit"), "gone": ("leased", "withdrawn", "unmatched")},
)
