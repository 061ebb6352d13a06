"""Removing what no reader, no version and no running work needs any more.

What is live is found first: the tables that the kept versions select from, and the folders that their notes name.
Everything else below the root and the shared folder that is older than a given time goes. What is younger stays whatever it is, since a
run may be writing it, and readers that planned on an older version still read its files.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession

from annalist.plans.versions import MADE_FROM, newest_number, read_version
from annalist.session import shared_dir

_PATH = re.compile(r"parquet\.`([^`]+)`")
_TABLE = re.compile(r"(?:FROM|JOIN) (\w+_[0-9a-f]{32})\b")
#: how the folders that the library makes for one run end
_OWN = re.compile(r"(?:^|[-_])[0-9a-f]{32}$")


def _plain(path: str) -> str:
    """A path without what differs between ways to write it."""
    return re.sub(r"^file:/+", "/", path).rstrip("/")


def _live(spark: SparkSession, names: list[str], root: str, keep: int) -> tuple[set[str], set[str]]:
    """Paths and tables that the newest versions of the names read or note."""
    kept = {}
    for name in names:
        last = newest_number(spark, name, root)
        kept |= {(name, n): read_version(spark, name, root, n) for n in range(max(1, last - keep + 1), last + 1)}
    for version in list(kept.values()):
        # what a table was made from is compared with its successor when the table is brought up to date, and so are
        # the keys that the versions between have touched
        of, _, number = version.notes.get(MADE_FROM, "").rpartition(":")
        if of in names:
            kept |= {(of, n): read_version(spark, of, root, n) for n in range(int(number), newest_number(spark, of, root) + 1)}
    paths, tables = set(), set()
    for version in kept.values():
        needed = " ".join([version.query, *(f"FROM {s}" for s in (version.layout or {}).values() if isinstance(s, str))])
        paths |= {_plain(p) for p in _PATH.findall(needed)}
        paths |= {_plain(v) for v in version.notes.values()}
        tables |= set(_TABLE.findall(needed))
    return paths, tables


def _published(spark: SparkSession, root: str) -> list[str]:
    """The names that have versions below the root."""
    return [name for name, folder, _ in _children(spark, root) if any(n == "_versions" for n, _, _ in _children(spark, folder))]


def _children(spark: SparkSession, folder: str) -> list[tuple[str, str, dt.datetime]]:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return []
    out = []
    for status in files.listStatus(path):
        if status.isDirectory():
            at = dt.datetime.fromtimestamp(status.getModificationTime() / 1000, dt.timezone.utc)
            out.append((status.getPath().getName(), status.getPath().toString(), at))
    return out


def unreferenced(spark: SparkSession, root: str, older_than: dt.datetime, keep: int = 1) -> DataFrame:
    """Rows ``(path, name, modified)``: folders of snapshots and intermediates that nothing needs.

    ``keep`` versions of each published name are live. Only folders that the library has named for a single run are looked at, below the
    root and in the shared folder, and of these only those not modified since ``older_than`` (with a time zone).
    There is one row per folder, not per file.
    """
    names = _published(spark, root)
    paths, tables = _live(spark, names, root, keep)
    described = [spark.sql(f"DESCRIBE TABLE EXTENDED {t}").filter("col_name = 'Location'").collect() for t in tables if spark.catalog.tableExists(t)]
    paths |= {_plain(rows[0]["data_type"]) for rows in described if rows}
    found = []
    places = [folder for name, folder, _ in _children(spark, root)]
    for place in [*places, shared_dir(spark)]:
        for name, path, modified in _children(spark, place):
            plain = _plain(path)
            needed = any(p == plain or p.startswith(f"{plain}/") for p in paths)
            if _OWN.search(name) and not needed and modified < older_than:
                found.append((path, name, modified.replace(tzinfo=None)))
    return spark.createDataFrame(found, "path string, name string, modified timestamp_ntz")


def expire(spark: SparkSession, root: str, older_than: dt.datetime, keep: int = 1) -> int:
    """Remove what :func:`unreferenced` lists, and the tables over it; gives the number of folders."""
    gone = unreferenced(spark, root, older_than, keep).collect()  # one row per folder
    tables = {t.name for t in spark.catalog.listTables() if not t.isTemporary}
    for row in gone:
        parts = _plain(row["path"]).split("/")
        table = f"{parts[-2]}_{parts[-1]}"
        if table in tables:
            spark.sql(f"DROP TABLE {table}")  # its files lie outside the warehouse and go below
        path = spark._jvm.org.apache.hadoop.fs.Path(row["path"])
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return len(gone)
