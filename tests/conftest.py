import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from loadlens.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "loadlens-tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture
def write_file(tmp_path):
    """Write bytes or text under the test's folder and return the path."""

    def write(name, body):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        if isinstance(body, str):
            body = body.encode()
        if name.endswith(".gz"):
            import gzip

            body = gzip.compress(body)
        path.write_bytes(body)
        return str(path)

    return write


def rows(df, *columns):
    """Rows as sorted tuples of the named columns."""
    got = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(got, key=lambda r: tuple((x is not None, str(x)) for x in r))
