import os
import sys
import tempfile
from pathlib import Path

import pytest

HERE = str(Path(__file__).resolve().parent.parent)
sys.path.insert(0, HERE)
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [HERE, os.environ.get("PYTHONPATH")]))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    session = (SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.driver.memory", "6g").config("spark.sql.session.timeZone", "UTC")
               .config("spark.local.dir", folder).config("spark.sql.warehouse.dir", f"{folder}/warehouse").config("spark.checkpoint.dir", f"{folder}/shared").config("spark.ui.showConsoleProgress", "false").getOrCreate())
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()
