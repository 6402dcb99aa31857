from __future__ import annotations

import contextlib
import io

import pytest

from tallyline.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        "tests",
        4,
        shuffle_partitions=4,
        driver_memory="4g",
        **{
            "spark_checkpoint_dir": str(tmp_path_factory.mktemp("shared")),
            "spark_sql_warehouse_dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    yield session
    session.stop()


def rows_of(df, *columns):
    """Rows as a sorted list of tuples, for comparing without order."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def plan_of(df) -> str:
    """The physical plan as ``explain`` prints it."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()
