"""A store: a directory of Parquet datasets with a small catalog.

The catalog is a set of versions; a write puts its datasets under new folder
names and publishes them by one new catalog file.  A job that fails leaves the
last version as it was.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import export as X
from ..operators.append import AppendPlan, append_rows, check_layer_name, generated_key_name, plan_append
from ..operators.append import TargetColumn, TargetSchema
from ..operators.errors import with_errors
from ..operators.vector import GeometrySchema, conform_layer, has_geometry, infer_geometry_schema, layer_extent, merge_extent


def resolve_layer(names: list[str], name: str | None) -> str:
    """Blank means the first layer; else the exact name, then any case."""
    if not names:
        raise ValueError("Vector dataset contains no layers")
    if not (name or "").strip():
        return names[0]
    for match in (lambda n: n == name, lambda n: n.lower() == name.lower()):
        for n in names:
            if match(n):
                return n
    raise ValueError(f"Layer '{name}' not found")


class Store:
    """Datasets of one directory, in any file system Spark can reach."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        jvm = spark._jvm
        self._path = lambda p: jvm.org.apache.hadoop.fs.Path(p)
        self._fs = self._path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())

    # -- catalog -----------------------------------------------------------------

    def _versions(self) -> list[int]:
        root = self._path(f"{self.folder}/_catalog")
        if not self._fs.exists(root):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(root)]
        return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))

    def catalog(self) -> dict:
        """Layers, domains and relationships of the last published version."""
        versions = self._versions()
        if not versions:
            return {"version": 0, "layers": {}, "schema": {"schemaVersion": 1}}
        path = f"{self.folder}/_catalog/v{versions[-1]:010d}.json"
        rows = self.spark.read.text(path, wholetext=True).collect()
        return json.loads(rows[0][0])

    def _publish(self, catalog: dict) -> None:
        """Write the next version; losing a race against another writer fails."""
        catalog = {**catalog, "version": catalog["version"] + 1}
        target = self._path(f"{self.folder}/_catalog/v{catalog['version']:010d}.json")
        out = self._fs.create(target, False)
        try:
            out.write(bytearray(json.dumps(catalog).encode()))
        finally:
            out.close()

    def layers(self) -> DataFrame:
        """One row per layer and field, for display and for tools."""
        rows = []
        for name, layer in self.catalog()["layers"].items():
            g = layer.get("geometry") or {}
            for f in layer["fields"]:
                rows.append(
                    (name, layer["kind"], g.get("name"), g.get("type"), g.get("dimension"), g.get("srid"), f["name"], f["type"])
                )
        return self.spark.createDataFrame(
            rows, "layer string, kind string, geometry string, type string, dimension string, srid int, field string, field_type string"
        )

    def read_catalog(self, mode: str, name: str | None = None) -> DataFrame:
        """DOMAINS, DOMAIN_VALUES, FIELD_DOMAINS, RELATIONSHIPS or
        RELATIONSHIP_KEYS; all values are text."""
        return X.filter_catalog(X.catalog_frame(self.spark, self._schema(), mode), name)

    def _schema(self) -> X.ExportSchema:
        saved = self.catalog().get("export")
        return _schema_from(saved) if saved else X.ExportSchema((), (), ())

    # -- reading -----------------------------------------------------------------

    def table(self, name: str | None = None) -> DataFrame:
        layers = self.catalog()["layers"]
        layer = layers[resolve_layer(list(layers), name)]
        parts = [f"{self.folder}/{p}" for p in layer["parts"]]
        return self.spark.read.parquet(*parts)

    def extent(self, name: str):
        return self.catalog()["layers"][name].get("extent")

    # -- writing -----------------------------------------------------------------

    def write(self, df: DataFrame, layer: str, mode: str, geom: str | None = None, schema: GeometrySchema | None = None) -> None:
        """CREATE (an empty store), ADD_LAYER (a new layer) or APPEND."""
        catalog = self.catalog()
        if mode == "APPEND":
            return self._append(df, layer, geom, catalog)
        check_layer_name(layer)
        if mode == "CREATE" and catalog["version"]:
            raise ValueError(f"Output already exists: {self.folder}")
        if mode == "ADD_LAYER" and not catalog["version"]:
            raise ValueError(f"Store does not exist: {self.folder}")
        if mode not in ("CREATE", "ADD_LAYER"):
            raise ValueError(f"Unknown write mode: {mode}")
        if layer.lower() in {n.lower() for n in catalog["layers"]}:
            raise ValueError(f"Layer already exists: {layer}")
        entry = {"kind": "TABLE", "fid": generated_key_name(df.columns)}
        if geom is not None:
            schema = schema or infer_geometry_schema(df, geom)
            if schema is None:
                return  # no rows and no schema: nothing to write
            df, _ = with_errors(conform_layer(df, geom, schema).drop("warnings"), "FAIL")
            entry.update(
                kind="FEATURE_CLASS",
                geometry={"name": geom, "type": schema.type, "dimension": schema.dimension, "srid": schema.srid},
            )
        entry["fields"] = [{"name": f.name, "type": f.dataType.simpleString()} for f in df.schema if f.name != geom]
        self._publish(self._with_part(catalog, layer, entry, df, geom))

    def _with_part(self, catalog, layer, entry, df, geom) -> dict:
        part = f"data/{layer}/{uuid.uuid4().hex}"
        path = f"{self.folder}/{part}"
        df.write.mode("errorifexists").parquet(path)
        entry = {**entry, "parts": entry.get("parts", []) + [part]}
        if geom is not None:
            written = self.spark.read.parquet(path)
            new = layer_extent(written, geom).first()
            old = entry.get("extent") or [None] * 4
            entry["extent"] = list(merge_extent(old, new))
        entry["changed"] = datetime.now(timezone.utc).isoformat()
        return {**catalog, "layers": {**catalog["layers"], layer: entry}}

    def target(self, layer: str) -> TargetSchema:
        """The append target that a layer offers."""
        catalog = self.catalog()
        name = resolve_layer(list(catalog["layers"]), layer)
        entry = catalog["layers"][name]
        g = entry.get("geometry") or {}
        columns = [TargetColumn(entry["fid"], "INTEGER", primary=True)]
        columns += [TargetColumn(f["name"], _sql_type(f["type"])) for f in entry["fields"]]
        if g:
            columns.append(TargetColumn(g["name"], g["type"]))
        return TargetSchema(name, tuple(columns), g.get("name"), g.get("type", "GEOMETRY"), g.get("srid", 0))

    def preview(self, df: DataFrame, layer: str, geom: str | None = None) -> str:
        return plan_append(df, self.target(layer), geom).preview()

    def _append(self, df, layer, geom, catalog) -> None:
        if not (layer or "").strip():
            raise ValueError("Select a target layer for appending")
        target = self.target(layer)
        plan: AppendPlan = plan_append(df, target, geom)
        rows, _ = with_errors(append_rows(df, plan, geom), "FAIL")
        entry = catalog["layers"][target.layer]
        wanted = {f["name"]: f["type"] for f in entry["fields"]}
        rows = rows.select(*[F.col(c).cast(wanted[c]) if c in wanted else F.col(c) for c in rows.columns])
        if rows.isEmpty():
            return  # no rows: the catalog stays untouched
        has = target.geometry if target.geometry and has_geometry(rows, target.geometry) else None
        self._publish(self._with_part(catalog, target.layer, entry, rows, has))

    def export_datasets(self, inputs: dict[str, DataFrame], schema: X.ExportSchema | None, existing: bool = False) -> None:
        """Write several datasets and their relationships, all or nothing.

        ``inputs`` maps a dataset to its rows.  On create every dataset needs a
        schema entry; on append none may have one.  All rows are converted and
        checked while they are written under new folder names; the catalog
        that makes them visible comes last.
        """
        catalog = self.catalog()
        if not existing and catalog["version"]:
            raise ValueError(f"Output already exists: {self.folder}")
        saved = _schema_from(catalog["export"]) if catalog.get("export") else X.ExportSchema((), (), ())
        schema = schema or X.ExportSchema((), (), ())
        domains = {d.name: d for d in (*saved.domains, *schema.domains)}
        for name, df in inputs.items():
            declared = [d for d in schema.datasets if d.name == name]
            known = [d for d in saved.datasets if d.name == name]
            if known and declared:
                raise ValueError(f"Appended dataset must not be declared: {name}")
            if not known and not declared:
                raise ValueError(f"Unknown schema dataset: {name}")
            dataset = (known or declared)[0]
            rows, _ = with_errors(X.convert_fields(df, dataset, domains, append=bool(known)), "FAIL")
            geom = dataset.geometry.name if dataset.geometry else None
            if geom is not None:
                shape = GeometrySchema.explicit(dataset.geometry.type, dataset.geometry.dimension, dataset.geometry.crs)
                rows, _ = with_errors(conform_layer(rows, geom, shape).drop("warnings"), "FAIL")
            entry = catalog["layers"].get(name) or {
                "kind": dataset.kind,
                "fid": "OBJECTID",
                "fields": [{"name": f.name, "type": X.FIELD_TYPES[f.type]} for f in dataset.fields],
                "geometry": geom and {
                    "name": geom, "type": shape.type, "dimension": shape.dimension, "srid": shape.srid
                },
            }
            catalog = self._with_part(catalog, name, entry, rows, geom)
        missing = [d.name for d in schema.datasets if d.name not in inputs]
        if missing:
            raise ValueError(f"No input for datasets: {missing}")
        merged = X.ExportSchema(
            (*saved.domains, *schema.domains), (*saved.datasets, *schema.datasets),
            (*saved.relationships, *schema.relationships),
        )
        self._publish({**catalog, "export": asdict(merged)})


def _schema_from(saved: dict) -> X.ExportSchema:
    return X.ExportSchema(
        tuple(X.Domain(**{**d, "codes": tuple(tuple(c) for c in d["codes"])}) for d in saved["domains"]),
        tuple(
            X.Dataset(
                d["name"], d["kind"], tuple(X.Field(**f) for f in d["fields"]),
                X.Geometry(**d["geometry"]) if d["geometry"] else None,
            )
            for d in saved["datasets"]
        ),
        tuple(X.Relationship(**r) for r in saved["relationships"]),
    )


def _sql_type(kind: str) -> str:
    """Declared type of a column for the append rules."""
    # Spark types and their declared names.
    names = {
        "tinyint": "TINYINT", "smallint": "SMALLINT", "int": "MEDIUMINT", "bigint": "INTEGER", "float": "FLOAT",
        "double": "DOUBLE", "string": "TEXT", "boolean": "BOOLEAN", "binary": "BLOB", "date": "DATE",
        "timestamp": "DATETIME",
    }
    return "DOUBLE" if kind.startswith("decimal") else names[kind]


def open_store(spark: SparkSession, folder: str) -> Store:
    return Store(spark, folder)
