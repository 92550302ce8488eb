import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from scoreloom.session import build_session

    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="6g",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def docs(spark):
    """Documents from ``{path: content}``, content text or bytes."""

    def build(contents):
        rows = [
            (path, c if isinstance(c, (bytes, bytearray)) else c.encode()) for path, c in contents.items()
        ]
        frame = spark.createDataFrame(
            [(p, p.rsplit("/", 1)[-1], bytearray(c)) for p, c in rows],
            "path string, source_filename string, content binary",
        )
        return frame.selectExpr("path", "source_filename", "cast(content as string) content")

    return build
