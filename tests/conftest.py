import pytest
from pyspark.sql import SparkSession

from personweave.session import configured


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (configured(SparkSession.builder).master("local[8]").appName("tests")
               .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
               .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
               .config("spark.sql.shuffle.partitions", "2").config("spark.driver.memory", "8g")
               # Inputs are tiny: compiling a plan would take longer than running it.
               .config("spark.sql.codegen.wholeStage", "false"))
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
