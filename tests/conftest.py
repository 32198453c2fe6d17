from __future__ import annotations

import os

import pytest

from gleanery.session import build_session


def local_session():
    return build_session(
        "gleanery-tests",
        master=f"local[{os.environ.get('BENCH_CPUS', '8')}]",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
        spark__ui__enabled="false",
        spark__driver__host="127.0.0.1",
    )


@pytest.fixture(scope="session")
def spark():
    session = local_session()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
