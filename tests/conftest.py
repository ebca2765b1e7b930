from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tidemark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app="tidemark-tests", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture()
def landing(tmp_path: Path) -> Path:
    d = tmp_path / "landing"
    d.mkdir()
    return d


@pytest.fixture()
def root(tmp_path: Path) -> str:
    return str(tmp_path / "lake")


@pytest.fixture()
def zones_csv(tmp_path: Path) -> str:
    """Zone lookup with ids 1..3; id 2 and 3 share a name (ids merge by name)."""
    p = tmp_path / "zones.csv"
    p.write_text(
        '"LocationID","Borough","Zone","service_zone"\n'
        '1,"Manhattan","Alphabet City","Yellow Zone"\n'
        '2,"Queens","Jamaica Bay","Boro Zone"\n'
        '3,"Queens","Jamaica Bay","Boro Zone"\n'
    )
    return str(p)
