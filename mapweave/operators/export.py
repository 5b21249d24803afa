"""Export schema: domains, typed conversion, relationships and catalog."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exact import exact_double, fits_integer, outside_range
from .errors import error, first_error

# Field types, their Spark types and integer ranges.
FIELD_TYPES = {
    "INT16": "smallint",
    "INT32": "int",
    "INT64": "bigint",
    "FLOAT32": "float",
    "FLOAT64": "double",
    "STRING": "string",
    "XML": "string",
    "GUID": "string",
    "DATE": "date",
    "TIME": "string",
    "DATETIME": "timestamp",
    "DATETIME_WITH_OFFSET": "string",
    "BINARY": "binary",
}
INTEGER_BITS = {"INT16": 16, "INT32": 32, "INT64": 64}
KEY_TYPES = ("INT16", "INT32", "INT64", "STRING", "GUID")
GUID = r"^\{?[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}\}?$"
OFFSET_DATETIME = r"^-?[0-9]{4,}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,9})?)?(Z|[+-][0-9]{2}:[0-9]{2}(:[0-9]{2})?)$"

# The members of each object of a version 1 schema document, as
# "name: kind of value"; "!" marks required members.
MEMBERS = {
    "schema": "$schema: text, schemaVersion: number!, domains: list of domain, datasets: list of dataset, relationships: list of relationship",
    "domain": "name: text!, description: text, type: text!, fieldType: text!, values: list of code, minValue: text, maxValue: text, "
    "splitPolicy: text, mergePolicy: text",
    "code": "code: text!, label: text!",
    "dataset": "name: text!, kind: text!, fields: list of field!, geometry: geometry",
    "field": "source: text, name: text!, type: text!, nullable: flag, length: number, domain: text",
    "geometry": "source: text!, name: text!, type: text!, dimension: text!, crs: text!, precisionMode: text, xyResolution: number, "
    "xyTolerance: number, xOrigin: number, yOrigin: number, spatialIndex: flag",
    "relationship": "name: text!, origin: text!, destination: text!, originKey: text!, foreignKey: text!, cardinality: text!, "
    "forwardLabel: text, backwardLabel: text",
}
DOMAIN_TYPES = ("CODED", "RANGE")
DATASET_KINDS = ("TABLE", "FEATURE_CLASS")
CARDINALITIES = ("ONE_TO_ONE", "ONE_TO_MANY")

#: coded values compared in the expression; longer lists are joined
INLINE_CODES = 500


@dataclass(frozen=True)
class Domain:
    """CODED (codes with labels) or RANGE (inclusive bounds), values as text."""

    name: str
    field_type: str
    codes: tuple = ()  # (code, label)
    low: str | None = None
    high: str | None = None
    description: str = ""
    split_policy: str = "DEFAULT_VALUE"
    merge_policy: str = "DEFAULT_VALUE"

    @property
    def kind(self) -> str:
        return "RANGE" if self.low is not None else "CODED"


@dataclass(frozen=True)
class Field:
    name: str
    type: str
    nullable: bool = False
    length: int | None = None
    domain: str | None = None
    source: str | None = None

    @property
    def source_name(self) -> str:
        return self.source or self.name

    @property
    def width(self) -> int:
        return self.length or 255


@dataclass(frozen=True)
class Geometry:
    source: str
    name: str
    type: str
    dimension: str
    crs: str
    options: dict = field(default_factory=dict)


@dataclass(frozen=True)
class Dataset:
    name: str
    kind: str
    fields: tuple[Field, ...]
    geometry: Geometry | None = None


@dataclass(frozen=True)
class Relationship:
    name: str
    origin: str
    destination: str
    origin_key: str
    foreign_key: str
    cardinality: str
    forward_label: str = ""
    backward_label: str = ""


@dataclass(frozen=True)
class ExportSchema:
    domains: tuple[Domain, ...]
    datasets: tuple[Dataset, ...]
    relationships: tuple[Relationship, ...]

    def dataset(self, name: str) -> Dataset:
        for d in self.datasets:
            if d.name == name:
                return d
        raise ValueError(f"Unknown schema dataset: {name}")

    def domain(self, name: str) -> Domain:
        return next(d for d in self.domains if d.name == name)


def load_export_schema(text: str, existing: ExportSchema | None = None) -> ExportSchema:
    """Read a schema document (version 1); an error lists everything wrong.

    With an ``existing`` store its domains and datasets may be referred to, and
    the document needs no dataset.  A domain equal to an existing one is reused.
    """
    raw = json.loads(text, object_pairs_hook=_Members)
    problems = list(_shape(raw, "schema", "schema"))
    if not problems:
        problems = list(_meaning(raw, existing))
    if problems:
        raise ValueError("Invalid export schema: " + "; ".join(problems))
    reused = {d.name: d for d in existing.domains} if existing else {}
    domains = tuple(map(_domain, _items(raw, "domains")))
    datasets = tuple(map(_dataset, _items(raw, "datasets")))
    return ExportSchema(tuple(d for d in domains if reused.get(d.name) != d), datasets, tuple(map(_relationship, _items(raw, "relationships"))))


class _Members(dict):
    """An object of the document that knows its repeated members."""

    def __init__(self, pairs):
        super().__init__(pairs)
        names = [k for k, _ in pairs]
        self.repeated = sorted({k for k in names if names.count(k) > 1})


_KINDS = {"text": (str, int, float), "number": (int, float), "flag": (bool,)}


def _items(raw, member) -> list:
    return raw.get(member) or []


def _shape(item, kind: str, path: str):
    """Problems with the members of an object, from the declared table."""
    if not isinstance(item, _Members):
        yield f"{path} is no object"
        return
    yield from (f"{path}.{k} is given twice" for k in item.repeated)
    declared = dict(m.split(": ") for m in MEMBERS[kind].split(", "))
    yield from (f"{path}.{k} is no member of a {kind}" for k in item if k not in declared)
    for member, value_kind in declared.items():
        value, wanted = item.get(member), value_kind.rstrip("!")
        if value is None or value == "":
            if value_kind.endswith("!") or value == "" and member == "source":
                yield f"{path}.{member} is missing"
        elif wanted.startswith("list of "):
            if not isinstance(value, list):
                yield f"{path}.{member} is no list"
                continue
            for i, part in enumerate(value):
                yield from _shape(part, wanted.removeprefix("list of "), f"{path}.{member}[{i}]")
        elif wanted in MEMBERS:
            yield from _shape(value, wanted, f"{path}.{member}")
        elif not isinstance(value, _KINDS[wanted]) or wanted != "flag" and isinstance(value, bool):
            yield f"{path}.{member} is no {wanted}"


def _names(places: list[tuple[str, str]], limit: int, taken=()):
    """Problems with names that must be valid and different in one scope."""
    used = {t.lower() for t in taken}
    for path, name in places:
        name = str(name)
        if not re.fullmatch(r"[^\W\d]\w*", name) or len(name) > limit or name.upper().startswith("GDB_"):
            yield f"{path}: {name!r} is no valid name"
        elif name.lower() in used:
            yield f"{path}: the name {name!r} is taken"
        used.add(name.lower())


def _meaning(raw, existing: ExportSchema | None):
    """Problems between members, of a document whose shape is right."""
    domains, datasets, relationships = (_items(raw, m) for m in ("domains", "datasets", "relationships"))
    if raw["schemaVersion"] != 1:
        yield f"schemaVersion is {raw['schemaVersion']}, not 1"
    if not datasets and existing is None:
        yield "there is no dataset"
    old = {d.name: d for d in existing.domains} if existing else {}
    top = [(f"domains[{i}]", d["name"]) for i, d in enumerate(domains) if d["name"] not in old]
    top += [(f"datasets[{i}]", d["name"]) for i, d in enumerate(datasets)]
    yield from _names(top + [(f"relationships[{i}]", r["name"]) for i, r in enumerate(relationships)], 160)
    for i, d in enumerate(domains):
        problem = _domain_problem(d)
        if problem:
            yield f"domains[{i}]: {problem}"
        elif d["name"] in old and old[d["name"]] != _domain(d):
            yield f"domains[{i}]: the store has another domain {d['name']!r}"
    types = {n: d.field_type for n, d in old.items()} | {d["name"]: d["fieldType"] for d in domains}
    fields = {d.name.lower(): {f.name: f.type for f in d.fields} for d in existing.datasets} if existing else {}
    for i, d in enumerate(datasets):
        path, shape = f"datasets[{i}]", d.get("geometry")
        if d["kind"] not in DATASET_KINDS:
            yield f"{path}: kind {d['kind']!r} is none of {', '.join(DATASET_KINDS)}"
        elif (d["kind"] == "FEATURE_CLASS") != (shape is not None):
            yield f"{path}: a {d['kind']} {'needs a' if shape is None else 'has no'} geometry"
        inner = [(f"{path}.geometry", shape["name"])] if shape is not None else []
        yield from _names(inner + [(f"{path}.fields[{j}]", f["name"]) for j, f in enumerate(d["fields"])], 64, ("objectid",))
        for j, f in enumerate(d["fields"]):
            if f["type"] not in FIELD_TYPES:
                yield f"{path}.fields[{j}]: type {f['type']!r} is unknown"
            if f.get("length") is not None and not 1 <= f["length"] <= 65535:
                yield f"{path}.fields[{j}]: length {f['length']} is not within 1 and 65535"
            if f.get("domain") is not None and types.get(f["domain"]) != f["type"]:
                yield f"{path}.fields[{j}]: there is no domain {f['domain']!r} of type {f['type']}"
        fields[d["name"].lower()] = {f["name"]: f["type"] for f in d["fields"]}
    for i, r in enumerate(relationships):
        ends = [fields.get(r[side].lower(), {}).get(r[key]) for side, key in (("origin", "originKey"), ("destination", "foreignKey"))]
        if r["cardinality"] not in CARDINALITIES:
            yield f"relationships[{i}]: cardinality {r['cardinality']!r} is none of {', '.join(CARDINALITIES)}"
        if None in ends:
            yield f"relationships[{i}]: both keys must be declared fields of declared datasets"
        elif ends[0] != ends[1] or ends[0] not in KEY_TYPES:
            yield f"relationships[{i}]: keys of types {ends[0]} and {ends[1]} cannot be related"


def _domain_problem(d) -> str | None:
    codes, low, high = _items(d, "values"), d.get("minValue"), d.get("maxValue")
    if d["type"] not in DOMAIN_TYPES or d["fieldType"] not in FIELD_TYPES:
        return "unknown type or fieldType"
    if d["type"] == "CODED":
        good = codes and low is None and high is None and len({str(c["code"]) for c in codes}) == len(codes)
        return None if good else "a CODED domain has different codes and no bounds"
    good = not codes and low is not None and high is not None and d["fieldType"] not in ("STRING", "GUID", "BINARY", "XML")
    return None if good else "a RANGE domain has both bounds, no codes and a type with an order"


def _domain(d) -> Domain:
    low, high = (None if d.get(k) is None else str(d[k]) for k in ("minValue", "maxValue"))
    policies = (d.get(k) or "DEFAULT_VALUE" for k in ("splitPolicy", "mergePolicy"))
    return Domain(d["name"], d["fieldType"], tuple((str(c["code"]), c["label"]) for c in _items(d, "values")), low, high, d.get("description") or "", *policies)


def _dataset(d) -> Dataset:
    shape = d.get("geometry")
    plain = ("source", "name", "type", "dimension", "crs")
    geometry = shape and Geometry(*({**shape, "type": shape["type"].upper()}[k] for k in plain), {k: v for k, v in shape.items() if k not in plain})
    fields = (Field(f["name"], f["type"], bool(f.get("nullable")), f.get("length"), f.get("domain"), f.get("source")) for f in d["fields"])
    return Dataset(d["name"], d["kind"], tuple(fields), geometry)


def _relationship(r) -> Relationship:
    labels = (r.get(k) or "" for k in ("forwardLabel", "backwardLabel"))
    return Relationship(*(r[k] for k in ("name", "origin", "destination", "originKey", "foreignKey", "cardinality")), *labels)


# -- values --------------------------------------------------------------------


def _outside(value: Column, domain: Domain, kind: T.DataType) -> Column:
    """Whether a value of this type is outside its domain; NULL is not."""
    if domain.kind == "CODED":
        return value.isNotNull() & ~value.cast("string").isin([c for c, _ in domain.codes])
    if domain.field_type in ("DATE", "DATETIME", "TIME", "DATETIME_WITH_OFFSET"):
        to = FIELD_TYPES[domain.field_type]
        return value.isNotNull() & ~value.cast(to).between(F.lit(domain.low).cast(to), F.lit(domain.high).cast(to))
    return outside_range(value, kind, domain.low, domain.high)


def domain_error(value: Column, domain: Domain, kind: T.DataType) -> Column:
    """Message for a value outside its domain; NULL is the field's business.

    Codes are compared as text, range bounds as instants or as exact numbers of
    any size.
    """
    return F.when(_outside(value, domain, kind), f"Value outside domain {domain.name}")


def validate_domains(df: DataFrame, fields: dict[str, Domain], required=()) -> DataFrame:
    """Add ``error``: the first column whose value leaves its domain, or is
    NULL although required.  Long code lists are looked up by a join."""
    errors = []
    for name, domain in fields.items():
        if name in required:
            errors.append(F.when(F.col(name).isNull(), error("DOMAIN", name, "NULL is not allowed")))
        if domain.kind == "CODED" and len(domain.codes) > INLINE_CODES:
            mark = f"_in_{name}"
            codes = df.sparkSession.createDataFrame([(c,) for c, _ in domain.codes], "_code string")
            codes = codes.withColumn(mark, F.lit(True))
            df = df.join(codes, F.col(name).cast("string") == F.col("_code"), "left").drop("_code")
            wrong = F.col(name).isNotNull() & F.col(mark).isNull()
        else:
            wrong = _outside(F.col(name), domain, df.schema[name].dataType)
        errors.append(F.when(wrong, error("DOMAIN", name, f"Value outside domain {domain.name}")))
    marks = [c for c in df.columns if c.startswith("_in_")]
    return df.withColumn("error", first_error(*errors)).drop(*marks)


def _accepts(f: Field, kind: T.DataType) -> bool:
    if f.type in INTEGER_BITS or f.type in ("FLOAT32", "FLOAT64"):
        return isinstance(kind, (T.NumericType, T.BooleanType))
    if f.type in ("DATE", "TIME", "DATETIME"):
        return isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType))
    if f.type == "BINARY":
        return isinstance(kind, T.BinaryType)
    return isinstance(kind, T.StringType)


def convert_field(f: Field, value: Column, kind: T.DataType, whole_seconds: bool = False) -> tuple[Column, Column]:
    """(exact value of the field type, error message or NULL)."""
    none = F.lit(None).cast("string")
    if isinstance(kind, T.BooleanType):
        value, kind = value.cast("int"), T.IntegerType()
    if f.type in INTEGER_BITS:
        bits = INTEGER_BITS[f.type]
        number = fits_integer(value, -(2 ** (bits - 1)), 2 ** (bits - 1) - 1)
        out = number.cast(FIELD_TYPES[f.type])
        message = F.when(number.isNull(), f"Not an exact {f.type}")
    elif f.type in ("FLOAT32", "FLOAT64"):
        number = value.try_cast("double")
        bad = F.isnan(number) | (F.abs(number) == float("inf"))
        lost = F.lit(False)
        if not isinstance(kind, (T.DoubleType, T.FloatType)):
            lost = exact_double(value.cast("string")).isNull()
        if f.type == "FLOAT32":
            single = number.cast("float")
            bad = bad | (F.abs(single) == float("inf"))
            lost = lost | (single.cast("double") != number)
        message = F.when(bad, "Nonfinite or overflowing number").when(
            lost, "Value cannot be represented without loss"
        )
        out = number.cast(FIELD_TYPES[f.type])
    elif f.type in ("STRING", "XML"):
        # Length in UTF-16 units, as the target counts it.
        units = F.length(value) + F.length(F.regexp_replace(value, "[\\x{0}-\\x{ffff}]", ""))
        message = F.when(units > f.width, "String exceeds field length") if f.type == "STRING" else none
        out = value
    elif f.type == "GUID":
        message = F.when(~value.rlike(GUID), "Expected GUID")
        out = F.lower(F.regexp_replace(value, "[{}]", ""))
    elif f.type == "DATETIME_WITH_OFFSET":
        message = F.when(~value.rlike(OFFSET_DATETIME), "Expected ISO offset date and time")
        out = value
    elif f.type in ("DATE", "TIME", "DATETIME"):
        moment = value.cast("timestamp")
        fraction = F.unix_micros(moment) % 1000000 != 0
        message = F.when(
            fraction & F.lit(whole_seconds and f.type != "DATE"),
            "Target datetime field does not support fractional seconds",
        )
        if f.type == "DATE":
            out = value.cast("date")
        elif f.type == "TIME":
            out = F.date_format(moment, "HH:mm:ss.SSSSSS")
        else:
            out = moment
    else:
        message, out = none, value
    missing = none if f.nullable else F.when(value.isNull(), "NULL is not allowed")
    return F.when(message.isNull(), out), F.coalesce(missing, F.when(value.isNotNull(), message))


def convert_fields(
    df: DataFrame, dataset: Dataset, domains: dict[str, Domain], *, append: bool = False, whole_seconds: bool = False
) -> DataFrame:
    """Rows of a dataset in its declared types, with an ``error`` column.

    A source OBJECTID becomes SOURCE_OBJECTID on create and is rejected on
    append.
    """
    lower = {c.lower(): c for c in df.columns}
    if "objectid" in lower:
        if append:
            raise ValueError("OBJECTID is generated; rename it to SOURCE_OBJECTID")
        df = df.withColumnRenamed(lower["objectid"], "SOURCE_OBJECTID")
    outputs, errors = [], []
    for f in dataset.fields:
        if f.source_name not in df.columns:
            raise ValueError(f"Input field not found: {f.source_name}")
        kind = df.schema[f.source_name].dataType
        if not _accepts(f, kind):
            raise ValueError(f"Incompatible input type for {f.name}: {kind.simpleString()} -> {f.type}")
        value, message = convert_field(f, F.col(f.source_name), kind, whole_seconds)
        if f.domain is not None:
            message = F.coalesce(message, domain_error(value, domains[f.domain], T.DataType.fromDDL(FIELD_TYPES[f.type])))
        outputs.append(value.alias(f.name))
        errors.append(F.when(message.isNotNull(), error("EXPORT", f"{dataset.name}.{f.name}", message)))
    if dataset.geometry is not None:
        outputs.append(F.col(dataset.geometry.source).alias(dataset.geometry.name))
    return df.select(*outputs, first_error(*errors).alias("error"))


# -- catalog -------------------------------------------------------------------

# Columns of the five catalog modes.
CATALOG = {
    "DOMAINS": "domain type field_type description min_value max_value split_policy merge_policy",
    "DOMAIN_VALUES": "domain code description field_type",
    "FIELD_DOMAINS": "dataset field domain field_type",
    "RELATIONSHIPS": "relationship origin destination cardinality forward_label backward_label composite attributed attachment",
    "RELATIONSHIP_KEYS": "relationship side role field",
}


def catalog_rows(schema: ExportSchema, mode: str) -> list[tuple]:
    if mode == "DOMAINS":
        return [
            (d.name, d.kind, d.field_type, d.description, d.low, d.high, d.split_policy, d.merge_policy)
            for d in schema.domains
        ]
    if mode == "DOMAIN_VALUES":
        return [(d.name, code, label, d.field_type) for d in schema.domains for code, label in d.codes]
    if mode == "FIELD_DOMAINS":
        return [(d.name, f.name, f.domain, f.type) for d in schema.datasets for f in d.fields if f.domain]
    if mode == "RELATIONSHIPS":
        return [
            (r.name, r.origin, r.destination, r.cardinality, r.forward_label, r.backward_label, "false", "false", "false")
            for r in schema.relationships
        ]
    return [
        row
        for r in schema.relationships
        for row in (
            (r.name, "ORIGIN", "ORIGIN_PRIMARY", r.origin_key),
            (r.name, "ORIGIN", "ORIGIN_FOREIGN", r.foreign_key),
        )
    ]


def catalog_frame(spark: SparkSession, schema: ExportSchema, mode: str) -> DataFrame:
    """One catalog mode as a DataFrame of strings."""
    if mode not in CATALOG:
        raise ValueError(f"Unknown catalog mode: {mode}")
    kind = T.StructType([T.StructField(n, T.StringType()) for n in CATALOG[mode].split()])
    return spark.createDataFrame(catalog_rows(schema, mode), kind)


def filter_catalog(catalog: DataFrame, name: str | None = None) -> DataFrame:
    """Exact, case-sensitive filter on the first column; blank keeps all."""
    return catalog if not (name or "").strip() else catalog.filter(F.col(catalog.columns[0]) == name)
