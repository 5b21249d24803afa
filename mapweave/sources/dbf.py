"""DBF attribute rules: reading raw text, and conforming columns."""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exact import exact_long
from ..operators.errors import warnings_of

# Language driver ids and their character sets.
LDID = {
    1: "cp437", 2: "cp850", 3: "cp1252", 0x57: "cp1252", 0x64: "cp852", 0x65: "cp866", 0x66: "cp865",
    0x67: "cp861", 0x6A: "cp737", 0x6B: "cp857", 0x7A: "gbk", 0x7B: "cp932", 0x7C: "big5", 0xC8: "cp1250",
    0xC9: "cp1251", 0xCA: "cp1254", 0xCB: "cp1253",
}
DEFAULT_CHARSET = "iso-8859-1"


@dataclass(frozen=True)
class DbfField:
    """Name, type (C, N, F, D, L), width in bytes and decimal places."""

    name: str
    type: str
    width: int
    scale: int = 0

    @property
    def integer(self) -> bool:
        return self.type in "NF" and self.scale == 0 and self.width <= 20

    @property
    def spark_type(self) -> str:
        if self.integer:
            return "bigint"
        return {"C": "string", "D": "timestamp", "L": "boolean"}.get(self.type) or _decimal(self.width, self.scale)


def _decimal(width: int, scale: int) -> str:
    """Widest decimal that a column of this width can hold; text beyond."""
    return f"decimal({min(38, max(width, scale + 1))},{scale})" if width <= 38 else "string"


def input_charset(option: str | None, cpg: str | None, ldid: int) -> tuple[str, bool]:
    """(character set, is a fallback): option, else CPG, else language id."""
    for name in (option, (cpg or "").strip().lstrip("\ufeff")):
        if name:
            return ("utf-8" if name.upper().replace("-", "") == "UTF8" else name), False
    return (LDID[ldid], False) if ldid in LDID else (DEFAULT_CHARSET, True)


def dbf_value(raw, field: DbfField, tz: str = "UTC") -> Column:
    """Typed value of the raw text of a field.

    Blank, ``?``, NUL-filled text, zero dates and asterisks are NULL; anything
    else that does not parse stops the job.  Dates start in ``tz``.
    """
    raw = F.col(raw) if isinstance(raw, str) else raw
    if field.type == "C":
        nul = (F.length(raw) > 0) & raw.rlike(r"^\x00+$")
        return F.when(~nul, F.regexp_replace(raw, r"\s+$", ""))
    text = F.trim(F.regexp_replace(raw, r"[\x00\s]+", " "))
    blank = (text == "") | (text == "?")
    bad = F.raise_error(F.concat(F.lit(f"Invalid DBF value in {field.name}: "), text))
    if field.type == "D":
        day = F.when(text.rlike("^[0-9]{8}$"), F.try_to_date(text, "yyyyMMdd"))
        moment = F.to_utc_timestamp(day.cast("timestamp"), tz)
        empty = blank | text.isin("00000000", "0")
        return F.when(~empty, F.coalesce(moment, bad.cast("timestamp")))
    if field.type == "L":
        upper = F.upper(text)
        known = F.when(upper.isin("T", "Y"), True).when(upper.isin("F", "N"), False)
        return F.when(~blank, F.coalesce(known, bad.cast("boolean")))
    empty = blank | text.rlike(r"^\*+$")
    plain = F.regexp_replace(text, r"^\+", "")
    if field.integer:
        return F.when(~empty, F.coalesce(exact_long(plain), bad.cast("bigint")))
    if field.spark_type == "string":
        return F.when(~empty, plain)
    return F.when(~empty, F.coalesce(plain.try_cast(field.spark_type), bad.cast(field.spark_type)))


# -- writing -------------------------------------------------------------------------


@dataclass(frozen=True)
class DbfOverride:
    target: str | None = None
    width: int = 0
    scale: int = -1


def dbf_schema(df: DataFrame, overrides: dict[str, DbfOverride] | None = None, skip=()) -> tuple[dict[str, DbfField], list]:
    """({column: field}, warnings): names of ten characters and widths.

    Accents are stripped, other characters become ``_``, a leading digit gets
    ``_`` and collisions get ``_1``, ``_2``, ...
    """
    overrides = overrides or {}
    for name in overrides:
        if name not in df.columns or name in skip:
            raise ValueError(f"Unknown attribute: {name}")
    fields, used, notes = {}, set(), []
    for column in df.schema:
        if column.name in skip:
            continue
        o = overrides.get(column.name, DbfOverride())
        name = _field_name(o.target or column.name, used)
        if name != column.name:
            notes.append((column.name, "field-name"))
        kind, width, scale = _default_type(column)
        width, scale = o.width if o.width > 0 else width, o.scale if o.scale >= 0 else scale
        if kind == "C" and width > 254:
            width = 254
            notes.append((column.name, "field-width"))
        fixed = {"D": 8, "L": 1}.get(kind, width)
        if not 1 <= width <= 254 or not 0 <= scale < width or width != fixed or (kind != "N" and scale):
            raise ValueError(f"Invalid DBF width/scale for {column.name}")
        fields[column.name] = DbfField(name, kind, width, scale)
    if len(fields) > 255 or 1 + sum(f.width for f in fields.values()) > 65535:
        raise ValueError("DBF schema exceeds field/record limits")
    return fields, notes


def _field_name(text: str, used: set) -> str:
    bare = "".join(c for c in unicodedata.normalize("NFD", text) if not unicodedata.category(c).startswith("M"))
    stem = re.sub(r"[^A-Za-z0-9_]", "_", bare)
    if not stem or stem[0].isdigit():
        stem = "_" + stem
    name, n = stem[:10], 0
    while name.lower() in used:
        n += 1
        suffix = f"_{n}"
        if len(suffix) >= 10:
            raise ValueError("Too many colliding DBF field names")
        name = stem[: 10 - len(suffix)] + suffix
    used.add(name.lower())
    return name


def _default_type(column: T.StructField):
    kind = column.dataType
    if isinstance(kind, T.StringType):
        return "C", column.metadata.get("length", 254), 0
    if isinstance(kind, T.IntegralType):
        return "N", 20, 0
    if isinstance(kind, T.DecimalType):
        return "N", kind.precision + 2, kind.scale
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return "N", 33, 15
    if isinstance(kind, T.BooleanType):
        return "L", 1, 0
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "D", 8, 0
    raise ValueError(f"Convert unsupported attribute before export: {column.name}")


def conform_dbf(df: DataFrame, fields: dict[str, DbfField], charset: str = "UTF-8", tz: str = "UTC") -> DataFrame:
    """Columns under their DBF names with ``warnings`` and ``error``.

    NULL, rounding, replaced characters, cut text and a lost time of day are
    warnings; a number that does not fit its width is an error.
    """
    outputs, conditions, errors = [], {}, []
    for name, f in fields.items():
        value = F.col(f"`{name}`")
        conditions[(f.name, "null-attribute")] = value.isNull()
        if f.type == "C":
            out, replaced, cut = _text(value, f.width, charset)
            conditions[(f.name, "encoding-replacement")] = replaced
            conditions[(f.name, "text-truncation")] = cut
        elif f.type == "N":
            out, changed, problem = _number(value, f, df.schema[name].dataType)
            conditions[(f.name, "rounding")] = changed
            errors.append(F.when(problem, F.struct(
                F.lit("DBF").alias("code"), F.lit(f.name).alias("field"), F.lit("Number exceeds field width").alias("message")
            )))
        elif f.type == "D":
            moment = F.from_utc_timestamp(value.cast("timestamp"), tz)
            if isinstance(df.schema[name].dataType, T.DateType):
                moment = value.cast("timestamp")
            out = F.to_date(moment)
            conditions[(f.name, "date-time-loss")] = moment != F.date_trunc("day", moment)
        else:
            out = value
        outputs.append(out.alias(f.name))
    kept = [F.col(c) for c in df.columns if c not in fields]
    found = F.coalesce(*errors, F.lit(None)) if errors else F.lit(None)
    kind = "struct<code:string,field:string,message:string>"
    return df.select(*kept, *outputs, warnings_of(conditions).alias("warnings"), found.cast(kind).alias("error"))


# Character sets of one byte per character that Spark encodes.
_ONE_BYTE = {"US-ASCII": r"[^\x{0}-\x{7f}]", "ISO-8859-1": r"[^\x{0}-\x{ff}]"}


def _text(value: Column, width: int, charset: str):
    """(text cut to the width, has replacements, was cut)."""
    name = charset.upper()
    if name in _ONE_BYTE:
        safe = F.regexp_replace(value, _ONE_BYTE[name], "?")
        return F.substring(safe, 1, width), safe != value, F.length(safe) > width
    if name != "UTF-8":
        raise ValueError(f"Unsupported DBF character set: {charset}")
    # Cut bytes may end inside a character; its rest shows as one U+FFFD.
    size = F.octet_length(value)
    cut = F.make_valid_utf8(F.encode(value, "UTF-8").substr(F.lit(1), F.lit(width)).cast("string"))
    return F.when(size > width, F.regexp_replace(cut, "\ufffd$", "")).otherwise(value), F.lit(False), size > width


def _number(value: Column, f: DbfField, kind: T.DataType):
    """(rounded half up, was rounded, does not fit)."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        exact = value.cast("string").cast("decimal(38,18)")
    else:
        exact = value.cast("decimal(38,18)")
    rounded = F.round(exact, f.scale).cast(f"decimal(38,{f.scale})")
    too_wide = F.length(rounded.cast("string")) > f.width
    out = rounded.cast(f"decimal({min(38, max(f.width, f.scale + 1))},{f.scale})")
    return F.when(~too_wide, out), rounded.cast("decimal(38,18)") != exact, too_wide
