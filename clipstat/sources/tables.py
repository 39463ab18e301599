"""The table store: staging and history as atomic loads, core in hash buckets under a manifest.

Layout under ``root``::

    staging/load=<first>_<last>_<token>/extraction_day=YYYY-MM-DD/part-*.parquet
    history/load=<first>_<last>_<token>/recorded_date=YYYY-MM-DD/part-*.parquet
    audit/load=<first>_<last>_<token>/run_day=YYYY-MM-DD/part-*.parquet
    core/v=000007/_bucket=12/part-*.parquet   rows of bucket 12 as a publish wrote them
    core/_manifest/000007.json                where each bucket's current rows are, and their zones

An append writes a hidden folder and publishes it by one rename: its rows appear together or not at
all, and its token appears with them, so a replayed append finds that it was done.  ``first`` and
``last`` are the days it holds; a read of some days lists the loads' names and opens only their folders.

A publish of core writes the buckets it touches as a new version folder, then the manifest that names
them together with the untouched buckets' older folders.  Readers follow the newest manifest, so a
publish that died midway is never visible, and no file that is being read is overwritten.  A snapshot of
few videos rewrites few buckets, however large core is.  Buckets are Spark's own (``CLUSTERED BY``), so a
join on ``video_id`` reads core without moving it.  The manifest keeps each bucket's number of rows and
the least and greatest values of the columns in ``ZONES``; reads for a range skip the other buckets.
"""

from __future__ import annotations

import contextlib
import datetime as dt
import decimal
import hashlib
import json
import uuid
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipstat import schemas
from clipstat.functions.columns import ntz
from clipstat.sources import fs

SCHEMAS = {"staging": schemas.STAGING, "core": schemas.CORE, "history": schemas.HISTORY, "audit": schemas.AUDIT}
PARTITION = {"staging": ("extraction_day", "extraction_date"),
             "history": ("recorded_date", "recorded_at"),
             "audit": ("run_day", "at")}
LOAD = "load"
WRITING = "_writing-"
# The load that SQL inserts go to: it may hold any day, and unlike the others it grows.
SQL_TOKEN = "sql"
SQL_LOAD = f"0001-01-01_9999-12-31_{SQL_TOKEN}"
VERSION_PREFIX = "v="
BUCKET = "_bucket"
# Columns of core whose range each bucket's zone keeps.
ZONES = ["extraction_date", "channel_handle", "published_at", "engagement_ratio"]
# Ids of one append: partition number * ROWS_PER_PARTITION + row in the partition.
ROWS_PER_PARTITION = 1 << 24
PARTITIONS_PER_APPEND = 1 << 16
IDS_PER_APPEND = ROWS_PER_PARTITION * PARTITIONS_PER_APPEND
KEPT_RESERVATIONS = 8


def work_table(df: DataFrame, name: str, made: list[str] | None = None) -> DataFrame:
    """Write an intermediate result to a fresh folder under the cluster's shared checkpoint
    folder (``spark.checkpoint.dir``) and read it back.

    Used for a result that several branches of the next step consume: it is computed
    once, each reader still prunes columns, and lineage stops here (a lost executor
    recomputes nothing before it).  Every call has a folder of its own, so concurrent
    runs on one store do not meet.  The folder is added to ``made``, whose owner removes it
    with :func:`drop_work` once the step that reads it has committed."""
    from clipstat.session import ensure_checkpoint_dir

    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/clipstat-{name}-{uuid.uuid4().hex[:12]}"
    if made is not None:
        made.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_work(spark: SparkSession, made: list[str]) -> None:
    while made:
        fs.delete(spark, made.pop())


class Load(NamedTuple):
    """A published append: its folder's name, the first and last day it holds and its token."""
    folder: str
    first: str
    last: str
    token: str


def _zone_value(v):
    return v.isoformat() if isinstance(v, dt.datetime) else None if v is None else str(v)


@dataclass
class TableStore:
    """``core_buckets``: buckets of a new core table (an existing one keeps its number); size
    them at a few hundred MB.  ``keep_versions``: manifests kept for readers; bucket folders
    that none of them names are removed."""
    spark: SparkSession
    root: str
    core_buckets: int = 16
    keep_versions: int = 5

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    # ---- versions of core -------------------------------------------------------------
    def versions(self) -> list[int]:
        """Committed versions of core that are kept, from the manifest names."""
        names = fs.list_names(self.spark, self.path("core/_manifest"))
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def version_path(self, version: int) -> str:
        return f"{self.path('core')}/{VERSION_PREFIX}{version:06d}"

    def manifest(self, version: int | None = None) -> dict:
        """``{"version": v, "buckets": B, "wrote": w, "at": {bucket: folder}, "zones": {bucket: zone}}`` of a
        version (default: the newest; an empty table has version 0 and no bucket).  ``wrote`` is the folder
        number of the version's own publish; a zone has the ``rows`` of a bucket and, for each column of
        ``ZONES``, the least and greatest value as text (None: no value)."""
        kept = self.versions()
        if version is None and not kept:
            return {"version": 0, "buckets": self.core_buckets, "wrote": 0, "at": {}, "zones": {}}
        version = version or kept[-1]
        found = json.loads(fs.read_text(self.spark, self.path(f"core/_manifest/{version:06d}.json")))
        return {"version": version, "buckets": found["buckets"], "wrote": found["wrote"],
                "at": {int(b): v for b, v in found["at"].items()}, "zones": {int(b): z for b, z in found["zones"].items()}}

    def next_folder(self) -> int:
        """Past every folder, those of publishes that did not finish among them."""
        folders = [n[len(VERSION_PREFIX):] for n in fs.list_names(self.spark, self.path("core")) if n.startswith(VERSION_PREFIX)]
        return max([0, *(int(n) for n in folders if n.isdigit())]) + 1

    def bucket_folder(self, bucket: int, version: int) -> str:
        return f"{self.version_path(version)}/{BUCKET}={bucket}"

    def bucket_of(self, manifest: dict):
        """The bucket that Spark's ``CLUSTERED BY (video_id)`` puts a row into."""
        return F.pmod(F.hash("video_id"), F.lit(manifest["buckets"])).cast("int")

    def read_core(self, manifest: dict, buckets=None) -> DataFrame:
        """Core as ``manifest`` has it, or some of its buckets only."""
        paths = [self.bucket_folder(b, v) for b, v in sorted(manifest["at"].items()) if buckets is None or b in buckets]
        if not paths:
            return self.spark.createDataFrame([], schemas.CORE)
        return self.spark.read.schema(schemas.CORE).parquet(*paths)

    def buckets_where(self, manifest: dict, **ranges) -> list[int]:
        """Buckets whose zones meet every ``column=(least, greatest)`` (None: open; both ends count)."""
        def meets(zone, column, least, greatest):
            low, high = zone[column]
            if low is None:
                return False  # no value at all
            if column == "engagement_ratio":
                low, high, least, greatest = (None if v is None else decimal.Decimal(str(v)) for v in (low, high, least, greatest))
            elif column != "channel_handle":
                low, high = dt.datetime.fromisoformat(low), dt.datetime.fromisoformat(high)
            return (least is None or high >= least) and (greatest is None or low <= greatest)

        unknown = set(ranges) - set(ZONES)
        if unknown:
            raise ValueError(f"core keeps no zones of {sorted(unknown)}")
        return [b for b in sorted(manifest["at"]) if all(meets(manifest["zones"][b], c, *r) for c, r in ranges.items())]

    def core_where(self, manifest: dict | None = None, **ranges) -> DataFrame:
        """Rows of core inside every ``column=(least, greatest)``; opens only buckets whose zones meet them."""
        manifest = manifest or self.manifest()
        rows = self.read_core(manifest, set(self.buckets_where(manifest, **ranges)))
        for column, (least, greatest) in ranges.items():
            value = lambda v: ntz(v) if isinstance(v, dt.datetime) else F.lit(v)
            if least is not None:
                rows = rows.where(F.col(column) >= value(least))
            if greatest is not None:
                rows = rows.where(F.col(column) <= value(greatest))
        return rows

    @contextlib.contextmanager
    def bucketed_core(self, manifest: dict, buckets):
        """Some buckets of core as a table of the session catalog that Spark knows to be clustered by
        ``video_id``: a join on that key moves only the other side.  The table is external and gone on exit."""
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.CORE.fields)
        with self._catalog_table() as name:
            self.spark.sql(f"CREATE TABLE {name} ({columns}, {BUCKET} INT) USING parquet PARTITIONED BY ({BUCKET}) "
                           f"CLUSTERED BY (video_id) SORTED BY (video_id) INTO {manifest['buckets']} BUCKETS "
                           f"LOCATION '{self.path('core/_none')}'")
            there = " ".join(f"PARTITION ({BUCKET}={b}) LOCATION '{self.bucket_folder(b, manifest['at'][b])}'"
                             for b in sorted(buckets) if b in manifest["at"])
            if there:
                self.spark.sql(f"ALTER TABLE {name} ADD {there}")
            yield self.spark.table(name).select(*[f.name for f in schemas.CORE.fields])

    @contextlib.contextmanager
    def _catalog_table(self):
        name = f"clipstat_core_{uuid.uuid4().hex[:12]}"
        try:
            yield name
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def write_buckets(self, rows: DataFrame, manifest: dict) -> int:
        """Write ``rows`` (core columns) bucketed by ``video_id`` as a new folder, which no reader sees
        before :meth:`commit_core`; a task writes one file for each bucket it holds rows of."""
        folder = self.next_folder()
        with self._catalog_table() as name:
            (rows.withColumn(BUCKET, self.bucket_of(manifest)).write.mode("errorifexists").partitionBy(BUCKET)
                 .bucketBy(manifest["buckets"], "video_id").sortBy("video_id")
                 .option("path", self.version_path(folder)).saveAsTable(name))
        return folder

    def _zones(self, folder: int) -> dict[int, dict]:
        """Zones of the buckets in a folder (one row a bucket; reads only the columns of ``ZONES``)."""
        if not any(n.startswith(BUCKET + "=") for n in fs.list_names(self.spark, self.version_path(folder))):
            return {}
        schema = T.StructType([*(schemas.CORE[c] for c in ZONES), T.StructField(BUCKET, T.IntegerType())])
        rows = self.spark.read.schema(schema).parquet(self.version_path(folder))
        ends = [f(c).alias(f"{f.__name__}_{c}") for c in ZONES for f in (F.min, F.max)]
        found = rows.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("rows"), *ends).collect()
        return {r[BUCKET]: {"rows": r["rows"]} | {c: [_zone_value(r[f"min_{c}"]), _zone_value(r[f"max_{c}"])] for c in ZONES}
                for r in found}

    def commit_core(self, folder: int, manifest: dict, touched) -> int:
        """Make the touched buckets that ``folder`` holds current and return the new version, the next after
        that of ``manifest``; then retire old folders.  Fails if another publish was committed since
        ``manifest`` was read: of two, one creates the next manifest."""
        zones = self._zones(folder)
        at = {b: v for b, v in manifest["at"].items() if b not in touched} | {b: folder for b in zones}
        kept_zones = {b: z for b, z in manifest["zones"].items() if b not in touched}
        version = manifest["version"] + 1
        content = {"buckets": manifest["buckets"], "wrote": folder, "at": at, "zones": kept_zones | zones}
        if not fs.write_new(self.spark, self.path(f"core/_manifest/{version:06d}.json"), json.dumps(content)):
            raise RuntimeError(f"another publish changed core after version {manifest['version']}")
        kept = self.versions()
        for old in kept[:-self.keep_versions]:
            fs.delete(self.spark, self.path(f"core/_manifest/{old:06d}.json"))
        held = [self.manifest(k) for k in kept[-self.keep_versions:]]
        named = {(b, v) for m in held for b, v in m["at"].items()}
        for name in fs.list_names(self.spark, self.path("core")):
            number = name[len(VERSION_PREFIX):]
            # folders after the oldest kept version's own may belong to a publish that is still writing
            if name.startswith(VERSION_PREFIX) and number.isdigit() and int(number) < held[0]["wrote"]:
                inside = [n for n in fs.list_names(self.spark, f"{self.path('core')}/{name}") if n.startswith(BUCKET + "=")]
                gone = [n for n in inside if (int(n.split("=")[1]), int(number)) not in named]
                for n in gone:
                    fs.delete(self.spark, f"{self.path('core')}/{name}/{n}")
                if len(gone) == len(inside):
                    fs.delete(self.spark, f"{self.path('core')}/{name}")
        return version

    # ---- loads of the append-only tables ---------------------------------------------------
    def loads(self, name: str) -> list[Load]:
        """Published appends of staging or history, from one listing of names."""
        found = [n for n in fs.list_names(self.spark, self.path(name)) if n.startswith(LOAD + "=")]
        return sorted(Load(n, *n[len(LOAD) + 1:].split("_", 2)) for n in found)

    def find_load(self, name: str, token: str) -> Load | None:
        return next((x for x in self.loads(name) if x.token == token), None)

    def writing_path(self, name: str, token: str) -> str:
        """Hidden folder of an append; what an earlier attempt with this token left is removed."""
        path = f"{self.path(name)}/{WRITING}{token}"
        fs.delete(self.spark, path)
        return path

    def publish_load(self, name: str, token: str) -> Load | None:
        """Make a written append visible by one rename (None: it holds no rows)."""
        written = f"{self.path(name)}/{WRITING}{token}"
        days = sorted(self._days_in(name, written))
        if not days:
            fs.delete(self.spark, written)
            return None
        load = Load(f"{LOAD}={days[0]}_{days[-1]}_{token}", days[0], days[-1], token)
        target = f"{self.path(name)}/{load.folder}"
        if fs.exists(self.spark, target) or not fs.rename(self.spark, written, target):
            raise RuntimeError(f"another append published {target}")
        return load

    def _days_in(self, name: str, folder: str) -> list[str]:
        prefix = PARTITION[name][0] + "="
        return [n[len(prefix):] for n in fs.list_names(self.spark, folder) if n.startswith(prefix)]

    # ---- reads -------------------------------------------------------------------------
    def _read_paths(self, name: str, paths: list[str] | None) -> DataFrame:
        part_col, _ = PARTITION[name]
        full = T.StructType([*SCHEMAS[name].fields, T.StructField(LOAD, T.StringType()), T.StructField(part_col, T.DateType())])
        kept = [*(f.name for f in SCHEMAS[name].fields), part_col, LOAD]
        if paths == [] or (paths is None and not self.loads(name)):
            return self.spark.createDataFrame([], full).select(*kept)
        reader = self.spark.read.schema(full).option("basePath", self.path(name))
        return reader.parquet(*(paths or [self.path(name)])).select(*kept)

    def read(self, name: str) -> DataFrame:
        """Whole table with its declared schema; an absent table reads as empty."""
        if name == "core":
            return self.read_core(self.manifest())
        return self._read_paths(name, None).drop(LOAD)

    def read_loads(self, name: str, folders) -> DataFrame:
        """Rows of some loads, with the column ``load`` (a load's folder name without ``load=``)."""
        return self._read_paths(name, [f"{self.path(name)}/{f}" for f in folders])

    def days_of(self, name: str, load: Load) -> list[str]:
        """Days that a load holds; one of several days is looked into."""
        return [load.first] if load.first == load.last else sorted(self._days_in(name, f"{self.path(name)}/{load.folder}"))

    def days(self, name: str) -> list[str]:
        """Days (``YYYY-MM-DD``) held by an append-only table, from the listing."""
        return sorted({d for x in self.loads(name) for d in self.days_of(name, x)})

    def units(self, name: str) -> dict[str, str]:
        """``{unit: load folder}``: names that stand for what a load holds.  A load never changes, so its
        name does; the one of SQL inserts is named with its files."""
        out = {}
        for x in self.loads(name):
            files = ""
            if x.token == SQL_TOKEN:
                inside = [f"{d}/{f}" for d in self.days_of(name, x)
                          for f in fs.list_names(self.spark, f"{self.path(name)}/{x.folder}/{PARTITION[name][0]}={d}")]
                files = "#" + hashlib.sha256("\n".join(sorted(inside)).encode()).hexdigest()[:12]
            out[x.folder[len(LOAD) + 1:] + files] = x.folder
        return out

    def read_days(self, name: str, days) -> DataFrame:
        """Some days of an append-only table.  Only their folders are listed, so the cost does not grow
        with the number of days stored."""
        part_col, _ = PARTITION[name]
        wanted = sorted({d.isoformat() if hasattr(d, "isoformat") else str(d) for d in days})
        paths = []
        for x in self.loads(name):
            inside = [d for d in wanted if x.first <= d <= x.last]
            if x.first != x.last and inside:
                held = self.days_of(name, x)
                inside = [d for d in inside if d in held]
            paths += [f"{self.path(name)}/{x.folder}/{part_col}={d}" for d in inside]
        return self._read_paths(name, paths).drop(LOAD)

    def read_day(self, name: str, day) -> DataFrame:
        return self.read_days(name, [day])

    def read_latest_day(self, name: str) -> DataFrame:
        """The newest day only (empty table -> empty DataFrame)."""
        days = self.days(name)
        return self.read_day(name, days[-1]) if days else self._read_paths(name, []).drop(LOAD)

    def lookup(self, name: str, video_ids) -> DataFrame:
        """Rows of staging or history of the given videos.  The filter reaches the scan: files are sorted
        by ``video_id`` within a day and carry Bloom filters of it, so row groups without them are skipped."""
        return self.read(name).where(F.col("video_id").isin(list(video_ids)))

    # ---- work tables ------------------------------------------------------------------
    def stage(self, name: str, df: DataFrame, made: list[str] | None = None) -> DataFrame:
        """:func:`work_table`: computed once for all branches that read it."""
        return work_table(df, name, made)

    # ---- serial ids --------------------------------------------------------------------
    def reserve_ids(self, name: str, id_col: str) -> int:
        """Reserve the next ``IDS_PER_APPEND`` ids of ``name`` and return the last id before them.

        A reservation is an empty file named by its greatest id, created exclusively: of
        several appenders one gets each range, a failed write leaves a gap and never a
        duplicate, and there is no content that could be torn.  Without a reservation (a
        store that was filled otherwise) ids continue after the table's own maximum.
        """
        folder = self.path(f"_seq/{name}")
        taken = [int(n) for n in fs.list_names(self.spark, folder) if n.isdigit()]
        if taken:
            base = max(taken)
        elif fs.exists(self.spark, self.path(name)):
            base = int(self.read(name).agg(F.max(id_col)).first()[0] or 0)
        else:
            base = 0
        while not fs.create_new(self.spark, f"{folder}/{base + IDS_PER_APPEND}"):
            base += IDS_PER_APPEND
        for old in sorted(taken)[:-KEPT_RESERVATIONS]:
            fs.delete(self.spark, f"{folder}/{old}")
        return base
