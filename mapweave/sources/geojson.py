"""Feature documents: reading collections and lines, writing collections."""

from __future__ import annotations

import codecs
import itertools
import json
import re
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions import geojson as G
from ..operators.errors import with_errors
from ..operators.feature_rules import broken_rules
from ..operators.features import FeatureOptions, decode_features, encode_features, profile_of
from . import json_ranges
from .files import open_file, size
from .publish import published

ROOT_LIMIT = 64 * 1024 * 1024
CHUNK = 1 << 20
#: documents beyond so many bytes are read by more than one task
LARGE = 64 * 1024 * 1024
_TOKEN = re.compile(r'\\.|["{}\[\],]', re.S)
_KEY = re.compile(r'\s*"(?:[^"\\]|\\.)*"\s*:', re.S)
_FEATURES = re.compile(r'\s*"features"\s*:\s*')


def _chunks(path: str):
    """Decoded text of a file; a chunk never ends inside an escape."""
    with open_file(path) as f:
        yield from _decoded(iter(lambda: f.read(CHUNK), b""))


def _decoded(blocks):
    decoder, rest = codecs.getincrementaldecoder("utf-8")(), ""
    for data in itertools.chain(blocks, [b""]):
        text = rest + decoder.decode(data, final=not data)
        if not data:
            if text:
                yield text
            return
        slashes = len(text) - len(text.rstrip("\\"))
        rest = text[len(text) - 1 :] if slashes % 2 else ""
        yield text[: len(text) - len(rest)]


def split_document(chunks, features: bool):
    """The members of a root object as text, in one pass over a stream.

    With ``features`` the elements of the features array are returned,
    otherwise all other members, and ``None`` once for the array itself.  Only
    the current piece is kept in memory.
    """
    depth, quoted, inside, kept = 0, False, False, []
    ended = False
    for chunk in chunks:
        start = 0
        for token in _TOKEN.finditer(chunk):
            c, at = token.group(), token.start()
            if quoted or c[0] == "\\":
                quoted = quoted and c != '"'
                continue
            if c == '"':
                if depth == 0:
                    raise ValueError("Expected JSON object")
                quoted = True
                continue
            if c in "{[":
                depth += 1
                if depth == 1:
                    if c != "{" or ended or "".join(kept).strip() or chunk[start:at].strip(" \t\r\n\ufeff"):
                        raise ValueError("Expected JSON object")
                    start, kept = at + 1, []
                elif depth == 2 and c == "[" and _FEATURES.fullmatch("".join(kept) + chunk[start:at]):
                    inside, start, kept = True, at + 1, []
                    if not features:
                        yield None
                continue
            ends = c in "}]"
            if inside and depth == 2 or not inside and depth == 1:
                if inside == features or not inside:
                    piece = "".join(kept) + chunk[start:at]
                    if piece.strip() and inside == features:
                        yield piece
                    elif c == "," and inside and features:
                        raise ValueError("Feature array element must be an object")
                start, kept = at + 1, []
                inside = inside and not ends
            if ends:
                depth -= 1
                ended = depth == 0
        if inside and not features:
            kept = []
        else:
            kept.append(chunk[start:])
    if depth or quoted or not ended or "".join(kept).strip():
        raise ValueError("Trailing or missing JSON data")


def read_root(path: str) -> tuple[dict, bool]:
    """Root members of a document and whether it has a features array."""
    return _root_of(_chunks(path))


def _root_of(chunks) -> tuple[dict, bool]:
    pieces, size, collection = [], 0, False
    for piece in split_document(chunks, False):
        if piece is None:
            collection = True
            continue
        size += len(piece)
        if size > ROOT_LIMIT:
            raise ValueError("GeoJSON root metadata exceeds 64 MiB")
        pieces.append(piece)
    return G.parse("{" + ",".join(pieces) + "}"), collection


def check_collection(root: dict, selected: str) -> None:
    """Document rules that hold even without features."""
    wrong = broken_rules(root, None, profile_of(selected, root, {}))
    if wrong:
        raise ValueError("; ".join(wrong))


class DocumentSource(DataSource):
    """``path, root, feature``: one partition per file, read as a stream.

    A collection without features but with metadata gives one row whose
    ``feature`` is NULL, so that its warning is not lost.
    """

    @classmethod
    def name(cls):
        return "feature_documents"

    def schema(self):
        return "path string, root string, feature string"

    def reader(self, schema):
        return DocumentReader(json.loads(self.options["paths"]), self.options["profile"])


class DocumentReader(DataSourceReader):
    def __init__(self, paths, profile):
        self.paths, self.profile = paths, profile

    def partitions(self):
        return [InputPartition(p) for p in self.paths]

    def read(self, partition):
        yield from document_rows(partition.value, self.profile)


def document_rows(path: str, profile: str):
    """``path, root, feature`` of a whole document."""
    root, collection = read_root(path)
    if collection != (root.get("type") == "FeatureCollection"):
        raise ValueError("FeatureCollection requires a features array; Feature must not have one")
    if not collection:
        if root.get("type") != "Feature":
            raise ValueError("Expected a Feature or FeatureCollection")
        yield path, None, G.dump(root)
        return
    yield from _feature_rows(path, root, split_document(_chunks(path), True), profile)


def _feature_rows(path: str, root: dict, pieces, profile: str, alone: bool = True):
    """Rows of the elements; ``alone``: no other task has elements of this
    document, so that none here means an empty collection."""
    check_collection(root, profile)
    context = G.dump({k: v for k, v in root.items() if k not in ("type", "bbox")})
    empty = alone
    for piece in pieces:
        empty = False
        if not piece.lstrip().startswith("{"):
            raise ValueError("Feature array element must be an object")
        yield path, context, piece
    if empty and any(k not in ("type", "conformsTo", "bbox") for k in root):
        yield path, context, None


def _range_rows(row, profile: str):
    """Rows of the elements that begin in one range of a large document."""
    path, first, last = row["path"], row["first"], row["last"]
    if first is None:
        # no features array, or several: the document is read as a whole
        if row["start"] == 0:
            yield from document_rows(path, profile)
        return
    if last is None:
        raise ValueError("Trailing or missing JSON data")
    if row["end"] <= first or row["start"] >= last:
        return
    root, collection = _root_of(_decoded(json_ranges.rest_of(path, first, last)))
    if not collection or root.get("type") != "FeatureCollection":
        raise ValueError("FeatureCollection requires a features array; Feature must not have one")
    pieces = json_ranges.elements(path, row["start"], row["end"], row["quoted"], row["depth"], first, last)
    yield from _feature_rows(path, root, pieces, profile, alone=row["start"] <= first)


def document_features(spark: SparkSession, paths: list[str], profile: str) -> DataFrame:
    """``path, root, feature`` of documents: small ones by one task each, large
    ones by a task per byte range."""
    large = [p for p in paths if size(p) > LARGE]
    small = [p for p in paths if p not in set(large)]
    spark.dataSource.register(DocumentSource)
    rows = None
    if small or not large:
        rows = spark.read.format("feature_documents").options(paths=json.dumps(small), profile=profile).load()
    if large:
        ranges = json_ranges.document_ranges(spark, large)
        tasks = min(sum(-(-size(p) // json_ranges.RANGE) for p in large), json_ranges.MOST_TASKS)

        def run(batches):
            for batch in batches:
                for row in batch.to_pylist():
                    found = _range_rows(row, profile)
                    while part := list(itertools.islice(found, 1000)):
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*part, strict=True)], ["path", "root", "feature"])

        many = ranges.repartitionByRange(tasks, "path", "start").mapInArrow(run, "path string, root string, feature string")
        rows = many if rows is None else rows.unionByName(many)
    return rows


def read_geojson(
    spark: SparkSession, paths, options: FeatureOptions = FeatureOptions(), layout: str = "DOCUMENT", errors: str = "FAIL"
):
    """Features with the fixed columns of the options.

    DOCUMENT reads collections or single Features; a document beyond
    :data:`LARGE` bytes is read by many tasks (see ``json_ranges``), a smaller
    one by one.  LINES reads one Feature per line and splits large files.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    if layout == "LINES":
        rows = spark.read.text(paths).filter(F.trim("value") != "").withColumnRenamed("value", "_feature")
        done = decode_features(rows, "_feature", options)
    elif layout == "DOCUMENT":
        rows = document_features(spark, paths, options.profile)
        rows = rows.filter(F.col("feature").isNotNull()).select(
            F.col("feature").alias("_feature"), F.col("root").alias("_root")
        )
        done = decode_features(rows, "_feature", options, root="_root")
    else:
        raise ValueError(f"Unknown layout: {layout}")
    new = [*options.payload_fields, *(m.field for m in options.mappings)]
    good, bad = with_errors(done, errors, new)
    good = good.select(*new)
    return (good, bad) if errors == "ROUTE_TO_ERROR" else good


def empty_collections(spark: SparkSession, paths, profile: str = "AUTO") -> DataFrame:
    """Documents whose root metadata no feature carries (a warning)."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    rows = document_features(spark, paths, profile)
    return rows.filter(F.col("feature").isNull()).select("path", F.lit("empty-collection-context").alias("cause"))


def _canonical(value):
    """A JSON value in one form: equal numbers are equal texts, members are
    ordered by name."""
    if isinstance(value, G.Number):
        number = Decimal(value)
        sign, digits, exponent = number.as_tuple()
        text = "".join(map(str, digits)).lstrip("0")
        kept = text.rstrip("0")
        return ("-" if sign and kept else "") + f"{kept or 0}e{exponent + len(text) - len(kept) if kept else 0}"
    if isinstance(value, dict):
        return "{" + ",".join(json.dumps(k) + ":" + _canonical(v) for k, v in sorted(value.items())) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(_canonical, value)) + "]"
    return json.dumps(value)


def _members(text: str):
    """(key, raw text, canonical text) of a root object's members; a class list
    is given URI by URI."""
    for piece in split_document([text], False):
        if piece is None:
            raise ValueError("Root metadata must not hold features")
        (key, value), = G.parse("{" + piece + "}").items()
        raw = piece[_KEY.match(piece).end() :].strip()
        if key in ("type", "bbox"):
            continue
        if key != "conformsTo":
            yield key, raw, _canonical(value)
        elif not isinstance(value, list) or not all(isinstance(u, str) and not isinstance(u, G.Number) for u in value):
            raise ValueError("conformsTo must be an array of strings")
        else:
            for uri in value:
                yield key, json.dumps(uri), json.dumps(uri)


def merge_root_metadata(df: DataFrame, root: str, by=()) -> DataFrame:
    """Root members of a collection: the union over its rows.

    ``conformsTo`` is a set union; any other member must be equal in all rows,
    else ``conflict`` is true ("partition the rows").  Numbers are compared
    exactly and returned as they are written; of equal members the smallest text
    is returned.  One row per member.
    """
    # Distinct texts first: rows of one document mostly repeat the same root.
    roots = df.select(*by, F.col(root).alias("_root")).filter("_root IS NOT NULL").distinct()
    schema = T.StructType([*roots.schema.fields[:-1], *T.StructType.fromDDL("key string, value string, canonical string").fields])

    def run(batches):
        for batch in batches:
            rows, found = [], []
            for i, text in enumerate(batch.column("_root").to_pylist()):
                for member in _members(text):
                    rows.append(i)
                    found.append(member)
            own = [batch.column(c).take(pa.array(rows, pa.int64())) for c in by]
            new = [pa.array([m[j] for m in found], pa.string()) for j in range(3)]
            yield pa.RecordBatch.from_arrays([*own, *new], schema.fieldNames())

    members = roots.mapInArrow(run, schema)
    plain = members.filter("key <> 'conformsTo'").groupBy(*by, "key").agg(
        F.min("value").alias("value"), (F.min("canonical") != F.max("canonical")).alias("conflict")
    )
    classes = members.filter("key = 'conformsTo'").select(*by, "key", "value").distinct()
    merged = classes.groupBy(*by, "key").agg(
        F.concat(F.lit("["), F.array_join(F.array_sort(F.collect_list("value")), ","), F.lit("]")).alias("value")
    )
    return plain.unionByName(merged.withColumn("conflict", F.lit(False)))


def collected_root(merged: DataFrame) -> list:
    """All members of one collection's root, which every file repeats.

    A conflict anywhere stops the job, and so does a root beyond
    :data:`ROOT_LIMIT`, which no reader accepts.
    """
    clash = merged.filter("conflict").agg(F.min("key")).first()[0]
    if clash is not None:
        raise ValueError(f"Collection metadata '{clash}' differs between rows; partition the rows into separate files")
    size = merged.agg(F.sum(F.octet_length("key") + F.octet_length("value"))).first()[0] or 0
    if size > ROOT_LIMIT:
        raise ValueError(f"Collection metadata of {size} bytes exceeds {ROOT_LIMIT}")
    return merged.orderBy("key").collect()


def root_text(rows, profile: str) -> str:
    """JSON members of the merged root, with a leading comma."""
    found = {r["key"]: r["value"] for r in rows}
    if any(r["conflict"] for r in rows):
        name = next(r["key"] for r in rows if r["conflict"])
        raise ValueError(f"Collection metadata '{name}' differs between rows; partition the rows into separate files")
    if profile == "JSONFG10":
        found.setdefault("conformsTo", json.dumps([G.CONF + "core"]))
    return "".join("," + json.dumps(k) + ":" + v for k, v in found.items())


def write_geojson(
    df: DataFrame, path: str, options: FeatureOptions = FeatureOptions(), overwrite: bool = False, layout: str = "DOCUMENT"
) -> None:
    """Write a layer; every part file is a valid collection (DOCUMENT) or has
    one Feature per line (LINES).  Conflicting root members stop the job."""
    if layout == "LINES":
        rows, _ = with_errors(encode_features(df, options, "_feature"), "FAIL")
        with published(df.sparkSession, path, overwrite) as folder:
            rows.select("_feature").write.text(folder)
        return
    rows, _ = with_errors(encode_features(df, options, "_feature", root="_root"), "FAIL")
    merged = merge_root_metadata(rows.select("_root"), "_root")
    tail = root_text(collected_root(merged), options.profile)

    def collection(batches):
        first = True
        for batch in batches:
            lines = []
            for text in batch.column("_feature").to_pylist():
                lines.append(('{"type":"FeatureCollection","features":[\n' if first else ",") + text)
                first = False
            if lines:
                yield pa.RecordBatch.from_pydict({"value": pa.array(lines, pa.string())})
        lines = ['{"type":"FeatureCollection","features":['] if first else []
        yield pa.RecordBatch.from_pydict({"value": pa.array(lines + ["]" + tail + "}"], pa.string())})

    with published(df.sparkSession, path, overwrite) as folder:
        rows.select("_feature").mapInArrow(collection, "value string").write.text(folder)
