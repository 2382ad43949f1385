import contextlib
import io
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from farebox.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "farebox-tests", "local[8]", shuffle_partitions=8,
        extra={
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.checkpoint.dir": f"file:{tmp_path_factory.mktemp('shared')}",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def database(spark, tmp_path):
    """A database whose managed tables lie in the test's folder."""
    name = f"db_{tmp_path.name.replace('-', '_')}"
    spark.sql(f"create database {name} location 'file:{tmp_path}/db'")
    yield name
    spark.sql(f"drop database {name} cascade")


@pytest.fixture
def plan_of():
    """The physical plan's text; ``executed=True`` runs the query first, so adaptive changes show."""

    def text(df, executed=False):
        if executed:
            df.collect()
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            df.explain("formatted")
        return out.getvalue()

    return text


def rows(df, *order):
    """Collected rows as tuples, sorted."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
