import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = os.pathsep.join([str(ROOT), str(ROOT / "tests"), os.environ.get("PYTHONPATH", "")])


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def pages(spark):
    """Build a response table from bodies: ``pages("a", "b", seed=..., status=[...], headers=[...])``."""
    from pyspark.sql import functions as F

    import pageframe as pf

    def build(*bodies, seed="http://h/p", urls=None, status=None, headers=None, page_nos=None):
        rows = []
        for i, body in enumerate(bodies):
            url = urls[i] if urls else (seed if i == 0 else f"{seed}?{i}")
            raw = body if isinstance(body, (bytes, type(None))) else body.encode()
            no = page_nos[i] if page_nos else i
            rows.append((seed, no, url, status[i] if status else 200, headers[i] if headers else None, raw))
        df = spark.createDataFrame(
            rows, "seed string, page_no long, url string, status int, headers map<string,array<string>>, body binary"
        )
        return pf.as_responses(df.select(*[F.col(c) for c in df.columns]))

    return build


@pytest.fixture
def parsed(spark, pages):
    """Entries of bodies, in order, as (record, code, message) tuples."""
    import pageframe as pf

    def run(options, *bodies, **kw):
        # many small plans: compiling each would take most of the time
        spark.conf.set("spark.sql.codegen.wholeStage", "false")
        spark.conf.set("spark.sql.codegen.factoryMode", "NO_CODEGEN")
        rows = pf.parse_pages(pages(*bodies, **kw), options).orderBy("page_no", "entry_no").collect()
        spark.conf.unset("spark.sql.codegen.wholeStage")
        spark.conf.unset("spark.sql.codegen.factoryMode")
        return [(tuple(r.record) if r.record else None, r.error.code if r.error else None, r.error.message if r.error else None) for r in rows]

    return run
