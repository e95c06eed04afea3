import json
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from paylode.contracts import CONTRACTS  # noqa: E402
from paylode.session import build_session  # noqa: E402
from paylode.sources.lake import Lake  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "paylode-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lake(tmp_path) -> Lake:
    return Lake(root=str(tmp_path / "tables"), landing=str(tmp_path / "feeds"))


def record(entity, when="2031-03-04T05:06:07", **values):
    """A record that the contract accepts: every required column filled by its type, ``values`` on top.

    References hold because text columns have their own name as value: a payment refers to the merchant
    ``MERCHANT_ID`` and a refund to the payment ``PAYMENT_ID``.
    """
    filled = {}
    for column in CONTRACTS[entity].columns:
        if column.required:
            by_type = {"string": column.name.upper(), "double": 250.5, "timestamp": when}
            filled[column.name] = column.allowed[-1] if column.allowed else by_type[column.type]
    return filled | values


def deliver(lake, entity, day, *records):
    """One more file of a feed's day; a str is a line as it is."""
    folder = Path(lake.landing, entity, f"ingest_date={day}")
    folder.mkdir(parents=True, exist_ok=True)
    lines = "".join(f"{r if isinstance(r, str) else json.dumps(r)}\n" for r in records)
    Path(folder, f"{len(list(folder.iterdir()))}.jsonl").write_text(lines, encoding="utf-8")


def recall(lake, entity, day):
    """Take back what was delivered for a day; the day itself stays landed."""
    for file in Path(lake.landing, entity, f"ingest_date={day}").iterdir():
        file.write_text("")


def rows(df, *columns):
    """Rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
