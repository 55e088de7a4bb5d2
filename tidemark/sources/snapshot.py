"""A table as immutable Parquet folders plus a small file that names the current ones.

``<table>/<base>/tm_gen=<token>/[tm_part=<value>/]*.parquet`` hold the rows; a commit adds
``<table>/_versions/<n>.json``, which lists the folders that make up version ``n``. Readers take
the highest version, so they see either the old rows or the new ones. A commit names the version
its rows were decided on and fails if another one has followed meanwhile; only plain appends are
put on top of it. All files of a base folder have the same columns: added columns start a further
base folder, and rows of the older ones read as NULL there. Versions and folders are removed by
``forget`` alone, by age, so a reader that started before some commits can finish.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable, Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import col, cols, qualified, quote, text_literal
from tidemark.functions.flags import is_live
from tidemark.functions.stamps import decode, encode, floor_literal
from tidemark.operators.layout import PART, arrange, part_between
from tidemark.operators.merge import FLAG
from tidemark.sources.fs import Fs
from tidemark.spec import KeyBuckets, Layout

GEN = "tm_gen"
_NULL_DIR = "__HIVE_DEFAULT_PARTITION__"

# How long replaced rows stay readable, and how many versions stay in any case.
RETENTION = timedelta(days=7)
KEEP = 3


class CommitConflict(RuntimeError):
    """Another writer has committed this version."""


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def _typed(df: DataFrame, fields: Sequence[T.StructField]) -> DataFrame:
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[
        quote(f.name) if types.get(f.name) == f.dataType
        else col(f.name).cast(f.dataType).alias(f.name)
        for f in fields
    ])


class SnapshotTable:
    def __init__(self, spark: SparkSession, path: str, name: str | None = None):
        self.spark, self.path, self.name = spark, path.rstrip("/"), name
        self._fs = Fs(spark, self.path)
        self._text: tuple[int | None, str] = (None, "")

    # versions

    def versions(self) -> list[int]:
        names = self._fs.names(f"{self.path}/_versions")
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def manifest(self, version: int | None = None) -> dict | None:
        if version is None:
            found = self.versions()
            if not found:
                return None
            version = found[-1]
        if self._text[0] != version:  # a version never changes
            self._text = version, self._fs.read_text(self._version_path(version))
        return json.loads(self._text[1])

    def current(self) -> dict:
        manifest = self.manifest()
        if manifest is None:
            raise ValueError(f"table {self.name or self.path} does not exist")
        return manifest

    def exists(self) -> bool:
        return bool(self.versions())

    def _version_path(self, version: int) -> str:
        return f"{self.path}/_versions/{version:08d}.json"

    # description

    def schema(self) -> T.StructType:
        return T.StructType.fromJson(self.current()["schema"])

    def layout(self) -> Layout:
        return Layout.from_json(self.current()["layout"])

    def description(self) -> str:
        return self.current()["description"]

    def stamp(self) -> str | None:
        return self.current()["stamp"]

    def is_empty(self) -> bool:
        return self.row_count() == 0

    def row_count(self, at: dict | None = None) -> int:
        """Stored rows, tombstones included."""
        return sum(p["rows"] for p in (at or self.current())["parts"])

    def watermark(self, stamp: str, at: dict | None = None) -> Column | None:
        """Highest stamp as a constant, from the version file: nothing is scanned, unless the
        table was created without naming its stamp column."""
        manifest = at or self.current()
        dtype = T.StructType.fromJson(manifest["schema"])[stamp].dataType
        if manifest["stamp"] == stamp:
            marks = [p["stamp"] for p in manifest["parts"] if p["stamp"] is not None]
        else:
            high = self.read(at=manifest).agg(encode(F.max(col(stamp)), dtype)).first()[0]
            marks = [] if high is None else [high]
        return decode(max(marks), dtype) if marks else floor_literal(dtype)

    # reading

    def read(self, low=None, high=None, at: dict | None = None) -> DataFrame:
        """Current rows, or those of version ``at``. ``low``/``high`` bound the partition column
        and prune partitions."""
        manifest = at or self.current()
        rows = self._frame(manifest, manifest["parts"])
        layout = Layout.from_json(manifest["layout"])
        schema = T.StructType.fromJson(manifest["schema"])
        if low is not None or high is not None:
            if layout.partition is None or isinstance(layout.partition, KeyBuckets):
                raise ValueError("the table has no partition column to bound")
            column = layout.partition.column
            rows = rows.where(part_between(layout, schema, low, high))
            if low is not None:
                rows = rows.where(col(column) >= F.lit(low).cast(schema[column].dataType))
            if high is not None:
                rows = rows.where(col(column) <= F.lit(high).cast(schema[column].dataType))
        if manifest["tombstones"]:
            rows = rows.where(is_live(F.col(FLAG)))
        return rows.select(*self._shown(schema))

    @staticmethod
    def _shown(schema: T.StructType) -> list:
        return [
            col(f.name).alias(f.name, metadata=f.metadata) if f.metadata else quote(f.name)
            for f in schema.fields
        ]

    def stored(
        self, parts: Iterable[str | None] | None = None, at: dict | None = None
    ) -> DataFrame:
        """Rows as stored, with partition value (and flag, where tombstones are kept)."""
        manifest = at or self.current()
        chosen = manifest["parts"]
        if parts is not None:
            wanted = set(parts)
            chosen = [p for p in chosen if p["part"] in wanted]
        return self._frame(manifest, chosen)

    def _physical(self, manifest: dict) -> T.StructType:
        fields = list(T.StructType.fromJson(manifest["schema"]).fields)
        if manifest["tombstones"]:
            fields.append(T.StructField(FLAG, T.StringType()))
        fields.append(T.StructField(PART, T.StringType()))
        return T.StructType(fields)

    def _frame(self, manifest: dict, parts: list[dict]) -> DataFrame:
        schema = self._physical(manifest)
        partitioned = Layout.from_json(manifest["layout"]).partition is not None
        live: dict[str, list] = {}
        for p in parts:
            for token in p["dirs"]:
                live.setdefault(token, []).append(p["part"])
        if not live:
            return empty_frame(self.spark, schema)
        paths: dict[str, list[str]] = {}
        for token, values in live.items():
            base = manifest["bases"].get(token, manifest["base"])
            folder = f"{self.path}/{base}/{GEN}={token}"
            if not partitioned or len(values) == manifest["gens"][token]:
                found = [folder]
            else:
                found = [f"{folder}/{PART}={_NULL_DIR if v is None else v}" for v in values]
            paths.setdefault(base, []).extend(found)
        rows = None
        for base, found in paths.items():
            reader = self.spark.read.schema(schema).option("basePath", f"{self.path}/{base}")
            part = reader.parquet(*found)
            rows = part if rows is None else rows.unionByName(part)
        if not partitioned:
            rows = rows.withColumn(PART, F.lit(None).cast("string"))
        return rows.select(*cols(schema.names))

    # writing

    def create(
        self,
        schema: T.StructType,
        layout: Layout = Layout(),
        description: str = "",
        stamp: str | None = None,
        tombstones: bool = False,
        replace: bool = False,
    ) -> SnapshotTable:
        """Commit an empty version; an existing table is kept unless ``replace``."""
        found = self.versions()
        if found and not replace:
            return self
        schema = schema.toNullable()
        layout.check(schema)
        version = found[-1] + 1 if found else 1
        self._commit({
            "version": version,
            "base": f"base{version:08d}",
            "schema": schema.jsonValue(),
            "layout": layout.to_json(),
            "description": description,
            "stamp": stamp,
            "tombstones": tombstones,
            "parts": [],
            "gens": {},
            "bases": {},
            "meta": {},
        })
        return self

    def overwrite(self, df: DataFrame, keys: Sequence[str] = (), meta: dict | None = None,
                  schema: T.StructType | None = None, at: dict | None = None) -> dict:
        """All rows replaced in one commit."""
        return self.replace_parts(df, None, keys, meta, schema, at=at)

    def append(self, df: DataFrame, keys: Sequence[str] = (), meta: dict | None = None) -> dict:
        """Add rows; a version that others commit meanwhile is kept, and these rows put on top."""
        return self.replace_parts(df, (), keys, meta, rebase=True)

    def with_columns(self, manifest: dict, new: Sequence[T.StructField]) -> dict:
        """The version to commit on when columns are added: no stored row is touched."""
        have = T.StructType.fromJson(manifest["schema"])
        bases = {t: manifest["bases"].get(t, manifest["base"]) for t in manifest["gens"]}
        schema = T.StructType([*have.fields, *new]).toNullable()
        base = f"base{manifest['version'] + 1:08d}"
        return {**manifest, "schema": schema.jsonValue(), "bases": bases, "base": base}

    def replace_parts(
        self,
        df: DataFrame,
        parts: Iterable[str | None] | None,
        keys: Sequence[str] = (),
        meta: dict | None = None,
        schema: T.StructType | None = None,
        settled: DataFrame | None = None,
        at: dict | None = None,
        rebase: bool = False,
    ) -> dict:
        """Commit: drop the named partitions (all for ``None``), then add the rows of ``df``, and
        those of ``settled``, which keep the arrangement they were stored in.

        ``at`` is the version the rows were decided on, the current one by default. If another
        version has followed it, CommitConflict is raised and nothing changes; with ``rebase`` the
        rows are added to that version instead, as long as its columns and layout are the same.
        """
        manifest = dict(at or self.current())
        version = manifest["version"] + 1
        token = f"{version:08d}_{uuid.uuid4().hex[:8]}"
        if schema is not None:
            if parts is not None:
                raise ValueError("columns change only with all rows")
            schema = schema.toNullable()
            before = T.StructType.fromJson(manifest["schema"])
            if [(f.name, f.dataType) for f in before] != [(f.name, f.dataType) for f in schema]:
                manifest.update(base=f"base{version:08d}", gens={}, bases={})
            manifest["schema"] = schema.jsonValue()
        added = self._write(df, settled, manifest, token, keys)
        while True:
            new = self._joined(manifest, added, token, parts, meta)
            try:
                self._commit(new)
                return new
            except CommitConflict:
                following = self.current()
                same = all(following[k] == manifest[k] for k in ("schema", "layout", "base"))
                if not (rebase and same):
                    raise
                manifest = following

    @staticmethod
    def _joined(manifest: dict, added: list[dict], token: str, parts, meta: dict | None) -> dict:
        gone = {p["part"] for p in manifest["parts"]} if parts is None else set(parts)
        kept = {p["part"]: p for p in manifest["parts"] if p["part"] not in gone}
        for new in added:
            old = kept.get(new["part"])
            if old:
                marks = [m for m in (old["stamp"], new["stamp"]) if m is not None]
                new = {
                    "part": new["part"],
                    "dirs": old["dirs"] + new["dirs"],
                    "rows": old["rows"] + new["rows"],
                    "stamp": max(marks) if marks else None,
                }
            kept[new["part"]] = new
        gens = {**manifest["gens"], token: len(added)}
        used = {token for p in kept.values() for token in p["dirs"]}
        return {
            **manifest,
            "version": manifest["version"] + 1,
            "parts": list(kept.values()),
            "gens": {t: n for t, n in gens.items() if t in used},
            "bases": {t: b for t, b in manifest["bases"].items() if t in used},
            "meta": {**manifest["meta"], **(meta or {})},
        }

    def _write(self, df, settled, manifest: dict, token: str, keys: Sequence[str]) -> list[dict]:
        layout = Layout.from_json(manifest["layout"])
        path = f"{self.path}/{manifest['base']}/{GEN}={token}"
        fields = [f for f in self._physical(manifest).fields if f.name != PART]
        old = None if settled is None else _typed(settled, fields)
        rows = arrange(_typed(df, fields), layout, keys, old)
        seen = None
        if layout.partition is None:  # counted by the tasks that write
            seen = Observation()
            rows = rows.observe(seen, F.count(F.lit(1)).alias("rows"), self._mark(rows, manifest))
        writer = rows.write
        if layout.partition is not None:
            writer = writer.partitionBy(PART)
        if layout.bloom:  # the filter's size follows the values of a row group
            writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
        for name in layout.bloom:
            writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true")
        writer.parquet(path)  # session.SETTINGS: timestamps as micros, else no statistics to skip by
        if seen is None:
            return self._measure(manifest, token)
        found = seen.get
        return [{"part": None, "dirs": [token], **found}] if found["rows"] else []

    @staticmethod
    def _mark(rows: DataFrame, manifest: dict) -> Column:
        """Highest stamp, as it is kept in version files."""
        stamp = manifest["stamp"]
        mark = encode(F.max(col(stamp)), rows.schema[stamp].dataType) if stamp else F.max(F.lit(None))
        return mark.alias("stamp")

    def _measure(self, manifest: dict, token: str) -> list[dict]:
        """Rows and highest stamp of each partition just written: one column of the new files."""
        written = self._fs.names(f"{self.path}/{manifest['base']}/{GEN}={token}")
        if not [n for n in written if n[0] not in "_."]:
            return []
        probe = {**manifest, "gens": {token: 1}}
        rows = self._frame(probe, [{"part": None, "dirs": [token]}])
        count = F.count(F.lit(1)).alias("rows")
        counted = rows.groupBy(PART).agg(count, self._mark(rows, manifest))
        return [
            {"part": r[PART], "dirs": [token], "rows": r["rows"], "stamp": r["stamp"]}
            for r in counted.collect()
        ]

    def _commit(self, manifest: dict) -> None:
        target = self._version_path(manifest["version"])
        temporary = f"{self.path}/_versions/.{uuid.uuid4().hex}.tmp"
        try:
            self._fs.create_new(target, temporary, json.dumps({**manifest, "committed": time.time()}))
        except Exception as err:
            if self._fs.exists(target):
                raise CommitConflict(f"{self.path}: version {manifest['version']} exists") from err
            raise
        self.publish()

    def forget(self, age: timedelta = RETENTION, keep: int = KEEP) -> list[int]:
        """Drop versions replaced at least ``age`` ago, but not the last ``keep``, with the folders
        only they used; returns them. Readers and writers that take longer than ``age`` would lose
        their files."""
        found = self.versions()
        limit = time.time() - age.total_seconds()
        old = []
        for version, following in zip(found, found[1:]):
            if following > found[-max(1, keep)] or self.manifest(following)["committed"] > limit:
                break
            old.append(version)
        kept = found[len(old):]
        if not old:
            return []

        def folders(versions):
            out = set()
            for v in versions:
                m = self.manifest(v)
                partitioned = Layout.from_json(m["layout"]).partition is not None
                for p in m["parts"]:
                    for token in p["dirs"]:
                        gen = f"{m['bases'].get(token, m['base'])}/{GEN}={token}"
                        value = _NULL_DIR if p["part"] is None else p["part"]
                        out.add((gen, f"{gen}/{PART}={value}" if partitioned else gen))
            return out

        needed = folders(kept)
        gens = {gen for gen, _ in needed}
        for gen, folder in folders(old) - needed:
            self._fs.delete(f"{self.path}/{folder if gen in gens else gen}")
        for v in old:
            self._fs.delete(self._version_path(v))
        return old

    def drop_orphans(self) -> list[str]:
        """Remove folders left by failed writes; only for a table nobody is writing to."""
        used = set()
        for v in self.versions():
            m = self.manifest(v)
            used |= {f"{m['bases'].get(token, m['base'])}/{GEN}={token}" for token in m["gens"]}
        orphans = []
        for base in self._fs.names(self.path):
            if base.startswith("base"):
                found = {f"{base}/{n}" for n in self._fs.names(f"{self.path}/{base}")}
                orphans += sorted(found - used)
        for folder in orphans:
            self._fs.delete(f"{self.path}/{folder}")
        return orphans

    # SQL name

    def publish(self) -> None:
        """Point the table's name in the catalog at the current version."""
        if not self.name:
            return
        manifest = self.current()
        schema = T.StructType.fromJson(manifest["schema"])
        listed = ", ".join(
            quote(f.name) + (
                f" COMMENT {text_literal(f.metadata['comment'])}" if "comment" in f.metadata else ""
            )
            for f in schema.fields
        )
        comment = text_literal(manifest["description"] or "")
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {qualified(self.name)} ({listed}) COMMENT {comment} "
            f"TBLPROPERTIES ('tidemark.path' = {text_literal(self.path)}) "
            f"AS {self._select(manifest, schema)}"
        )

    def _select(self, manifest: dict, schema: T.StructType) -> str:
        if not manifest["parts"]:
            nulls = ", ".join(
                f"CAST(NULL AS {f.dataType.simpleString()}) AS {quote(f.name)}"
                for f in schema.fields
            )
            return f"SELECT {nulls} WHERE false"
        layout = Layout.from_json(manifest["layout"])
        partitioned = layout.partition is not None
        # Spark reads years as numbers here and would lose their leading zeros.
        year = partitioned and getattr(layout.partition, "grain", "") == "year"
        part = f"lpad(CAST({PART} AS STRING), 4, '0')" if year else f"CAST({PART} AS STRING)"
        live: dict[str, list] = {}
        for p in manifest["parts"]:
            for token in p["dirs"]:
                live.setdefault(token, []).append(p["part"])
        tests: dict[str, list[str]] = {}
        for token, values in live.items():
            test = f"{GEN} = '{token}'"
            if partitioned and len(values) != manifest["gens"][token]:
                given = [f"'{v}'" for v in values if v is not None]
                among = [f"{part} IN ({', '.join(given)})"] if given else []
                if None in values:
                    among.append(f"{PART} IS NULL")
                test = f"({test} AND ({' OR '.join(among)}))"
            tests.setdefault(manifest["bases"].get(token, manifest["base"]), []).append(test)
        selects = []
        for base, found in tests.items():
            where = " OR ".join(found)
            if manifest["tombstones"]:
                where = f"({where}) AND coalesce({FLAG}, 'I') <> 'D'"
            root = f"{self.path}/{base}"
            older = base != manifest["base"]
            have = {c.lower() for c in self.spark.read.parquet(root).columns} if older else set()
            names = ", ".join(
                quote(f.name) if not older or f.name.lower() in have
                else f"CAST(NULL AS {f.dataType.simpleString()}) AS {quote(f.name)}"
                for f in schema.fields
            )
            selects.append(f"SELECT {names} FROM parquet.{quote(root)} WHERE {where}")
        return " UNION ALL ".join(selects)
