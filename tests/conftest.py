import sys
from datetime import datetime, timezone
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from flowspark.session import local_session  # noqa: E402

NOW = datetime(2024, 1, 31, tzinfo=timezone.utc)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(8, shuffle_partitions=4, **{"spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))})
    yield session
    session.stop()


@pytest.fixture()
def rows(spark):
    """Build a DataFrame of a source: rows as dicts, absent columns null, times as text."""
    from pyspark.sql import functions as F
    from pyspark.sql.types import StructType

    def build(ddl: str, *records: dict):
        fields = StructType.fromDDL(ddl).fields
        text = ", ".join(
            f"{f.name} {'string' if f.dataType.simpleString() == 'timestamp' else f.dataType.simpleString()}"
            for f in fields
        )
        data = [tuple(r.get(f.name) for f in fields) for r in records]
        df = spark.createDataFrame(data, text)
        return df.select(*[F.col(f.name).cast(f.dataType) for f in fields])

    return build


def plan_of(df) -> str:
    """The physical plan as text, before adaptive execution."""
    return df._jdf.queryExecution().executedPlan().toString()


def as_set(df):
    return sorted((tuple(sorted(r.asDict().items())) for r in df.collect()), key=repr)


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def carried(df, *names: str) -> list[str]:
    """Exchanges, sorts and windows of the plan that carry a column of these names; not the exchange and sort by
    which payloads themselves are dealt out and made unique under their digest."""
    found = []

    def visit(node):
        kind = node.nodeName()
        if kind in ("Exchange", "Sort", "Window"):
            columns = {node.output().apply(i).name() for i in range(node.output().size())}
            # By digest, and nothing but digest and payload: the table of payloads itself.
            if columns & set(names) and not columns <= {"digest", "payload", "max"}:
                found.append(node.simpleString(200))
        children = node.children()
        for i in range(children.size()):
            visit(children.apply(i))

    plan = df._jdf.queryExecution().executedPlan()
    visit(plan.inputPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan)
    return found
