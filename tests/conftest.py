import json
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]

from contrail.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"

# A full and a sparse vector of the wire format.
FULL = ["a1b2c3", "UAL123  ", "United States", 1700000000.0, 1700000005.0, -87.6298, 41.8781, 10500.0, False, 245.3,
        90.0, 1.5, None, 10600.0, "1234", False, 0]
NULLS = ["deadbe", "CSN302", "China", None, 1700000010.0, None, None, None, True, 80.0, 270.0, 0.0, None, None, None,
         False, 0]


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, shuffle_partitions=4, memory="4g")
    yield session
    session.stop()


@pytest.fixture
def full():
    return list(FULL)


@pytest.fixture
def nulls():
    return list(NULLS)


def event(**fields):
    """A message of the event schema as a dict. Those of the full vector, as an event."""
    base = {
        "schema_version": 1, "event_time_utc": "2023-11-14T22:13:20Z", "source": "opensky", "icao24": "a1b2c3",
        "ingestion_time_utc": "2023-11-14T22:13:21Z", "callsign": "UAL123", "lat": 41.8781, "lon": -87.6298,
        "altitude_m": 10600.0, "velocity_mps": 245.3, "heading_deg": 90.0, "vertical_rate_mps": 1.5,
        "on_ground": False, "last_contact_utc": "2023-11-14T22:13:25Z", "origin_country": "United States",
        "geo_altitude_m": 10600.0, "squawk": "1234", "spi": False, "position_source": 0,
        "bbox_id": "24.0_50.0_-125.0_-66.0",
    }
    base.update(fields)
    return base


def put_lines(folder, name, items):
    """Land one file of JSON lines; strings are written as they are."""
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as file:
        for item in items:
            file.write((item if isinstance(item, str) else json.dumps(item)) + "\n")
