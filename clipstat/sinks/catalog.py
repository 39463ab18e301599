"""The store's tables under names of the session catalog: DDL with column defaults, SQL over the store.

All three are external tables over the store's own folders, so SQL and the pipelines see the same
rows.  Staging and history take SQL inserts: these land in a load of their own that spans all days, and
columns that have a default may be left out.  Core is written by upserts only; its table is clustered by
``video_id`` and its partitions are the buckets where the newest manifest has them.
"""

from __future__ import annotations

import json

from clipstat import schemas
from clipstat.sources.tables import BUCKET, LOAD, PARTITION, SCHEMAS, SQL_LOAD, TableStore

# The names of the three tables.
NAMES = {"staging": "staging.youtube_videos_raw", "core": "core.youtube_videos", "history": "core.youtube_videos_history"}
# Columns that the load time fills.
DEFAULTS = {"staging": {"loaded_at": "localtimestamp()"}, "core": {"updated_at": "localtimestamp()"},
            "history": {"recorded_at": "localtimestamp()"}}
_AT = "clipstat.buckets"


def _columns(table: str) -> list[str]:
    out = []
    for f in SCHEMAS[table].fields:
        limit = schemas.VARCHAR_LIMITS.get(table, {}).get(f.name)
        default = DEFAULTS[table].get(f.name)
        out.append(f"{f.name} {f'VARCHAR({limit})' if limit else f.dataType.simpleString()}"
                   + (" NOT NULL" if f.name in schemas.NOT_NULL.get(table, []) else "") + (f" DEFAULT {default}" if default else ""))
    return out


def ddl(store: TableStore) -> list[str]:
    """The statements that :func:`create_tables` runs: schemas, then tables, each if it does not exist."""
    out = [f"CREATE SCHEMA IF NOT EXISTS {s}" for s in dict.fromkeys(n.split(".")[0] for n in NAMES.values())]
    for table in ("staging", "history"):
        day = PARTITION[table][0]
        columns = [*_columns(table), f"{LOAD} STRING DEFAULT '{SQL_LOAD}'", f"{day} DATE"]
        out.append(f"CREATE TABLE IF NOT EXISTS {NAMES[table]} ({', '.join(columns)}) USING parquet "
                   f"PARTITIONED BY ({LOAD}, {day}) LOCATION '{store.path(table)}'")
    buckets = store.manifest()["buckets"]
    out.append(f"CREATE TABLE IF NOT EXISTS {NAMES['core']} ({', '.join([*_columns('core'), f'{BUCKET} INT'])}) USING parquet "
               f"PARTITIONED BY ({BUCKET}) CLUSTERED BY (video_id) SORTED BY (video_id) INTO {buckets} BUCKETS "
               f"LOCATION '{store.path('core/_none')}'")
    return out


def create_tables(store: TableStore) -> None:
    """Create the schemas and tables that do not exist and let them show what the store holds."""
    for statement in ddl(store):
        store.spark.sql(statement)
    refresh(store)


def refresh(store: TableStore) -> None:
    """Let the catalog's tables show the store's newest loads and buckets (call it after a run).

    Only names of new partitions and of buckets that moved pass through the driver."""
    spark = store.spark
    for table in ("staging", "history"):
        day = PARTITION[table][0]
        known = {r[0] for r in spark.sql(f"SHOW PARTITIONS {NAMES[table]}").collect()}
        there = [(x.folder[len(LOAD) + 1:], d) for x in store.loads(table) for d in store.days_of(table, x)]
        new = [f"PARTITION ({LOAD}='{x}', {day}=DATE'{d}')" for x, d in there if f"{LOAD}={x}/{day}={d}" not in known]
        if new:
            spark.sql(f"ALTER TABLE {NAMES[table]} ADD IF NOT EXISTS {' '.join(new)}")
    core, at = NAMES["core"], store.manifest()["at"]
    found = spark.sql(f"SHOW TBLPROPERTIES {core}").where(f"key = '{_AT}'").first()
    shown = {int(b): v for b, v in json.loads(found["value"]).items()} if found else {}
    gone = [b for b in shown if at.get(b) != shown[b]]
    if gone:
        spark.sql(f"ALTER TABLE {core} DROP IF EXISTS {', '.join(f'PARTITION ({BUCKET}={b})' for b in sorted(gone))}")
    new = [b for b in sorted(at) if at[b] != shown.get(b)]
    if new:
        spark.sql(f"ALTER TABLE {core} ADD IF NOT EXISTS " + " ".join(
            f"PARTITION ({BUCKET}={b}) LOCATION '{store.bucket_folder(b, at[b])}'" for b in new))
    if gone or new:
        spark.sql(f"ALTER TABLE {core} SET TBLPROPERTIES ('{_AT}' = '{json.dumps(at)}')")
    for name in NAMES.values():
        spark.catalog.refreshTable(name)


def drop_tables(store: TableStore) -> None:
    """Take the names out of the catalog; the store's files stay."""
    for name in NAMES.values():
        store.spark.sql(f"DROP TABLE IF EXISTS {name}")
