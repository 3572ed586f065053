import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

# Folder of historical observation documents (one JSON per file) for the
# golden-answer tests; those tests are skipped when it is not set.
HIST_DATA = os.environ.get("CIRRUS_HISTORY_DIR", "")
SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from cirrus.session import build_session
    s = build_session("local[4]", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture
def tmp_json(tmp_path):
    """Write documents (text) as individual files into a fresh folder."""
    def write(docs):
        folder = tmp_path / "stage"
        folder.mkdir(exist_ok=True)
        for i, text in enumerate(docs):
            (folder / f"doc_{i:04d}.json").write_text(text)
        return str(folder)
    return write
