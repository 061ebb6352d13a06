import datetime as dt
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import types as T

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from annalist.spec import ENGINEERED, FIXED, KEY, TRACKED, TRANSIENT, ColumnSpec, TableSpec  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    builder = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(warehouse))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.maxMetadataStringLength", "10000")
        .config("spark.sql.debug.maxToStringFields", "1000")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


_S, _D = T.StringType(), T.DateType()

#: a registry with few columns, to write test rows by hand
SMALL = TableSpec(
    columns=(
        ColumnSpec("id", _S, KEY, "Key"),
        ColumnSpec("created", _D, FIXED, "Created"),
        ColumnSpec("state", _S, TRACKED, "State", True),
        ColumnSpec("sector", _S, TRACKED, "Sector", True),
        ColumnSpec("size", _S, TRACKED, "Size", False),
        ColumnSpec("area", _S, FIXED, "Area", False),
        ColumnSpec("periods", _S, TRANSIENT, "Counter"),
        ColumnSpec("treated", T.TimestampNTZType(), TRANSIENT, "Treated"),
        ColumnSpec("since", _D, TRANSIENT, "From"),
        ColumnSpec("until", _D, TRANSIENT, "To", None, False),
        ColumnSpec("batch_created", _D, ENGINEERED, "Batch", None, False),
        ColumnSpec("batch_closed", _D, ENGINEERED, "Batch", None, False),
        ColumnSpec("start_at", _D, ENGINEERED, "Start", None, False),
        ColumnSpec("end_at", _D, ENGINEERED, "End", None, False),
    ),
    effective_from="since",
    effective_to="until",
    treated_at="treated",
    period_count="periods",
    created_on="created",
    state="state",
    sector="sector",
    area="area",
)


def day(text):
    return None if text is None else dt.date.fromisoformat(text)


_RECORD = T.StructType(

    [T.StructField(c, SMALL.column(c).dtype) for c in ["id", *SMALL.attributes, "treated", "since"]]
)


@pytest.fixture
def history(spark):
    """Rows of a history table from keyword dicts; what is left out has a default."""

    def make(*rows):
        base = {"created": day("2000-01-01"), "state": "A", "sector": "s1", "size": "1", "area": "01001"}
        base |= {"batch_created": day("2001-01-01"), "batch_closed": None, "end_at": None}
        full = [base | r for r in rows]
        for r in full:
            r["start_at"], r["end_at"] = _date(r["start_at"]), _date(r["end_at"])
            r["created"] = _date(r["created"])
        return spark.createDataFrame([[r[c] for c in SMALL.history_columns] for r in full], SMALL.history_schema())

    return make


@pytest.fixture
def batch(spark):
    """Records of a batch; ``on`` sets both dates, ``batch`` adds the batch date."""

    def make(*rows):
        base = {"created": day("2000-01-01"), "state": "A", "sector": "s1", "size": "1", "area": "01001"}
        data, schema = [], _RECORD
        if any("batch" in r for r in rows):
            schema = T.StructType([*_RECORD.fields, T.StructField("batch_date", _D)])
        for r in rows:
            full = base | r
            on = _date(full.get("on"))
            full["since"] = _date(full.get("since", on))
            treated = full.get("treated", on)
            full["treated"] = dt.datetime.combine(_date(treated), dt.time(3)) if treated else None
            full["batch_date"] = _date(full.get("batch"))
            full["created"] = _date(full["created"])
            data.append([full[f.name] for f in schema.fields])
        return spark.createDataFrame(data, schema)

    return make


def _date(value):
    return day(value) if isinstance(value, str) else value


def rows(df, *cols):
    """Rows as sorted tuples with dates as text."""
    picked = df.select(*cols) if cols else df
    out = [tuple(v.isoformat() if isinstance(v, dt.date) else v for v in r) for r in picked.collect()]
    return sorted(out, key=repr)
