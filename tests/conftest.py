import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from staymill.functions.session import session

    s = session(
        "tests", "local[8]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false", spark__driver__memory="6g",
        spark__ui__showConsoleProgress="false", spark__checkpoint__dir=str(tmp_path_factory.mktemp("scratch")),
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture(scope="session")
def raw_like(spark):
    """22 bookings with one case per cleaning rule."""
    from staymill import schema as S

    def row(i, y, **over):
        base = {**S.EXAMPLE, "children": 0.0, **over}
        return {"booking_id": i, **base, "is_canceled": y, "arrival_date_year": 2016, "assigned_room_type": "A",
                "required_car_parking_spaces": 0, "reservation_status": "Canceled" if y else "Check-Out", "reservation_status_date": "2016-08-15"}

    rows = [
        row(0, 1),
        row(1, 0, hotel="Resort Hotel", lead_time=10, adr=80.0),
        row(2, 0, agent=None, country=None, company=None),
        row(3, 0, adults=0, children=0.0, babies=0),
        row(4, 1, stays_in_week_nights=0, stays_in_weekend_nights=0),
        row(5, 1, adr=6000.0),
        *[row(6 + i, i % 2, lead_time=i * 5) for i in range(16)],
    ]
    names = [f.name for f in S.RAW_SCHEMA]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], S.RAW_SCHEMA)
