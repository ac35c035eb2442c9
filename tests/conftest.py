import sys
import uuid
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from vintage.schemas import Layers, create_tables  # noqa: E402
from vintage.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": 4,
            # On a handful of rows compiling a plan takes longer than interpreting it.
            "spark.sql.codegen.wholeStage": False,
            "spark.ui.showConsoleProgress": False,
            "spark.sql.warehouse.dir": tmp_path_factory.mktemp("warehouse"),
            "spark.checkpoint.dir": tmp_path_factory.mktemp("shared"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def layers(spark, tmp_path):
    names = Layers.prefixed(f"t{uuid.uuid4().hex[:10]}_")
    create_tables(spark, names, str(tmp_path / "tables"))
    return names
