"""The versions of a published name: one small file each, and who comes first wins.

A version is the file ``<root>/<name>/_versions/<number>``. It is written aside and then given its name in one step
that fails if the name is taken, so of two runs that both read version 7 only one makes version 8. A
view shows readers the newest version. The files decide, and the view follows: a run that dies between the two
steps is finished by the next one.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

#: what the names of notes begin with
NOTE = "annalist."
#: the note that holds the number of the version a view shows
NUMBER = f"{NOTE}version"
#: the note that names the version of another table that this one was made from, as ``name:number``
MADE_FROM = f"{NOTE}made_from"


class Conflict(Exception):
    """Another run has published since this one read its base; nothing was switched."""


@dataclass(frozen=True)
class Version:
    number: int
    #: the SELECT that the view consists of
    query: str = ""
    notes: Mapping[str, str] = field(default_factory=dict)
    #: the tables that the query reads, if they have parts of their own (``tiers``)
    layout: Mapping | None = None


#: what there is before anything was published
NOTHING = Version(0)


def _files(spark: SparkSession, path: str):
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _folder(name: str, root: str) -> str:
    return f"{root.rstrip('/')}/{name}/_versions"


def write_text(spark: SparkSession, path: str, text: str) -> None:
    files, where = _files(spark, path)
    out = files.create(where, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    files, where = _files(spark, path)
    size = files.getFileStatus(where).getLen()
    stream = files.open(where)
    try:
        return bytes(stream.readNBytes(int(size))).decode()
    finally:
        stream.close()


def exists(spark: SparkSession, path: str) -> bool:
    files, where = _files(spark, path)
    return files.exists(where)


def _link(spark: SparkSession, source, target) -> None:
    jvm = spark._jvm
    present, wanted = (jvm.java.io.File(p.toUri().getPath()).toPath() for p in (source, target))
    jvm.java.nio.file.Files.createLink(wanted, present)


def _rename(spark: SparkSession, source, target) -> None:
    fs, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    files = source.getFileSystem(conf)
    no_options = spark._sc._gateway.new_array(getattr(fs, "Options$Rename"), 0)
    context = fs.FileContext.getFileContext(files.getUri(), conf)
    context.rename(files.makeQualified(source), files.makeQualified(target), no_options)


def _take_name(spark: SparkSession, written: str, wanted: str) -> bool:
    """Give a written file its name in one step; False if the name is taken.

    A local file gets a second link, others are renamed without overwriting, which the store must do in one step.
    """
    files, source = _files(spark, written)
    _, target = _files(spark, wanted)
    try:
        (_link if files.getUri().getScheme() == "file" else _rename)(spark, source, target)
    except Py4JJavaError as error:
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    return True


def newest_number(spark: SparkSession, name: str, root: str) -> int:
    """Number of the newest version, 0 if there is none."""
    files, folder = _files(spark, _folder(name, root))
    if not files.exists(folder):
        return 0
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    return max((int(n) for n in names if n.isdigit()), default=0)


def read_version(spark: SparkSession, name: str, root: str, number: int) -> Version:
    if number == 0:
        return NOTHING
    return Version(number, **json.loads(read_text(spark, f"{_folder(name, root)}/{number:012d}")))


def newest(spark: SparkSession, name: str, root: str) -> Version:
    return read_version(spark, name, root, newest_number(spark, name, root))


def commit(
    spark: SparkSession,
    name: str,
    root: str,
    query: str,
    notes: Mapping[str, str] | None = None,
    base: int | None = None,
    layout: Mapping | None = None,
) -> int:
    """Make a query the next version, and switch the view; gives the version's number.

    With ``base``, the version that the query was made from, this succeeds only if it is still the newest. Without, the query
    takes the place of whatever is there. Notes of the version before stay, unless they are given anew.
    """
    while True:
        before = newest(spark, name, root) if base is None else read_version(spark, name, root, base)
        written = f"{_folder(name, root)}/_{uuid.uuid4().hex}"
        content = {"query": query, "notes": {**before.notes, **(notes or {})}, "layout": layout}
        write_text(spark, written, json.dumps(content))
        taken = _take_name(spark, written, f"{_folder(name, root)}/{before.number + 1:012d}")
        files, where = _files(spark, written)
        files.delete(where, False)  # it has its name by now, or is not wanted
        if taken:
            show_newest(spark, name, root)
            return before.number + 1
        if base is not None:
            raise Conflict(f"{name}: version {base} was read, but version {newest_number(spark, name, root)} is published")


def show_newest(spark: SparkSession, name: str, root: str) -> Version:
    """Let the view show the newest version; does nothing if it does.

    A run that is late with its switch could put an older version in a newer one's place. It looks again after its
    switch, so the last to switch has seen the newest version.
    """
    while True:
        version = newest(spark, name, root)
        shown = int(read_notes(spark, name).get(NUMBER, "0")) if spark.catalog.tableExists(name) else 0
        if version.number in (0, shown):
            return version
        notes = {**version.notes, NUMBER: str(version.number)}
        properties = ", ".join(f"{quoted(k)} = {quoted(v)}" for k, v in notes.items())
        spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ({properties}) AS {version.query}")


def quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def read_notes(spark: SparkSession, name: str) -> dict[str, str]:
    """The notes left with the published snapshot."""
    found = spark.sql(f"SHOW TBLPROPERTIES {name}").filter(F.col("key").startswith(NOTE)).collect()
    return {r["key"]: r["value"] for r in found}


def read_note(spark: SparkSession, name: str, key: str) -> str:
    """A note left with the published snapshot, empty if there is none."""
    return read_notes(spark, name).get(key, "")
