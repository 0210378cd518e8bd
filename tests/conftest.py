import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from velogrid.schemas import TRIP_SCHEMA  # noqa: E402
from velogrid.session import local_session  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests", **{"spark__sql__shuffle__partitions": "4"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def make_trips(spark):
    """Typed trips from short dictionaries; times are texts."""

    def make(*rows: dict):
        defaults = {"duracion_recorrido": 600, "id_estacion_origen": 1, "id_estacion_destino": 2}
        names = [f.name for f in TRIP_SCHEMA.fields]
        values = []
        for i, row in enumerate(rows):
            full = {"id_recorrido": i, **defaults, **row}
            values.append(tuple(None if full.get(n) is None else str(full[n]) for n in names))
        text = spark.createDataFrame(values, ", ".join(f"{n} string" for n in names))
        return text.selectExpr(*[f"cast({f.name} as {f.dataType.simpleString()}) as {f.name}" for f in TRIP_SCHEMA.fields])

    return make


def trip(leave, arrive, origin=1, dest=2, **more):
    return {
        "fecha_origen_recorrido": leave and f"2024-03-04 {leave}",
        "fecha_destino_recorrido": arrive and f"2024-03-04 {arrive}",
        "id_estacion_origen": origin,
        "id_estacion_destino": dest,
        **more,
    }
