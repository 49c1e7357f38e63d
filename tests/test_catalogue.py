"""Every query of the catalogue against its SQL, at the smallest scale."""

from pathlib import Path

import duckdb
import pytest

from driftline.plans import more  # noqa: F401  registers its queries
from driftline.plans.catalogue import QUERIES
from driftline.plans.more_sql import MORE
from driftline.plans.oracle import ORACLE as FIRST

ORACLE = {**FIRST, **MORE}

SF = "/root/testdata/sf0.001"


def rows(df):
    df = df[sorted(df.columns)]
    return list(df.columns), sorted(tuple(f"{v:.9g}" if isinstance(v, float) else str(v) for v in r) for r in df.itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        c.sql(f"create view {p.stem} as select * from '{p}'")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, duck, name):
    assert rows(QUERIES[name](spark, SF).toPandas()) == rows(duck.sql(ORACLE[name]).df())


def test_midpoints_on_the_bounds_of_areas(spark, tmp_path):
    """Neighbours around the corners of the areas, a unit apart, so that midpoints of edges lie on the bounds."""
    at = [(x + i, y + j) for x, y in ((500, 500), (500, -2001), (-501, 1000), (-501, -501), (3000, 3000)) for i in range(2) for j in range(2)]
    spark.createDataFrame([(100 + i, [x / 1e5, y / 1e5], 0) for i, (x, y) in enumerate(at)], "vec_id long, embedding array<float>, label int").coalesce(1).write.parquet(str(tmp_path / "embeddings.parquet"))
    c = duckdb.connect()
    c.sql(f"create view embeddings as select * from '{tmp_path}/embeddings.parquet/*.parquet'")
    for name in ("edges_in_areas", "pip_tag"):
        assert rows(QUERIES[name](spark, str(tmp_path)).toPandas()) == rows(c.sql(ORACLE[name]).df())


def test_all_queries_are_covered(spark):
    assert set(QUERIES) - set(ORACLE) == {"line_simplify_safely"}
    got, plain = (QUERIES[q](spark, SF).toPandas().set_index("walk").sort_index() for q in ("line_simplify_safely", "line_simplify"))
    assert (got["after"] >= 2).all() and (got["after"] <= got["before"]).all() and (got["before"] == plain["before"]).all()


def test_entry(spark):
    import __spark_entry__ as e

    assert set(ORACLE) <= set(e.oracle_sql()) and set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() == 4
