import pytest

from daygrain.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": "4",
            # Tiny tables: compiling every plan would take most of the time.
            "spark.sql.codegen.wholeStage": "false",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """A frame from tuples of text, cast to the declared types inside Spark."""

    def make(rows, ddl):
        names = [c.strip().split(" ", 1) for c in ddl.split(", ")]
        plain = ", ".join(f"{n} string" for n, _ in names)
        texts = [tuple(None if v is None else str(v) for v in r) for r in rows]
        df = spark.createDataFrame(texts, plain)
        return df.selectExpr(*[f"cast({n} as {t}) as {n}" for n, t in names])

    return make


def collected(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted([tuple(r) for r in picked.collect()], key=lambda r: tuple(map(str, r)))
