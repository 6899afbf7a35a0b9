import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def compare():
    """Rows of a Spark query against its SQL in DuckDB, columns by name."""
    import duckdb

    def run(spark, query, sql, sf_dir):
        con = duckdb.connect()
        for p in Path(sf_dir).glob("*.parquet"):
            con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
        found = con.execute(sql)
        names = [c[0] for c in found.description]
        df = query(spark, sf_dir)
        assert sorted(df.columns) == sorted(names)
        pick = sorted(names)
        theirs = sorted((tuple(r[names.index(c)] for c in pick) for r in found.fetchall()), key=repr)
        ours = sorted((tuple(r[c] for c in pick) for r in df.collect()), key=repr)
        assert ours == theirs
        return ours

    return run
