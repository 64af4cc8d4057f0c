import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return DATA


SAMPLE = """\
name: "{slug}"
slug: {slug}
description: a sample record
group: {group}
members: [Ada, Lin]
kind: backend
mount_path: /{group}/{slug}
entry: apps.{module}.main:app
"""


@pytest.fixture
def write_manifest(tmp_path):
    """Write one manifest below ``tmp_path/apps``; a field given replaces its line, None leaves it out."""
    root = tmp_path / "apps"
    root.mkdir()

    def write(group, slug, text=None, folder=None, **fields):
        place = root / (folder or f"{group}/{slug}".replace("-", "_"))
        place.mkdir(parents=True, exist_ok=True)
        if text is None:
            module = f"{group}.{slug}".replace("-", "_")
            lines = dict(x.split(": ", 1) for x in SAMPLE.format(group=group, slug=slug, module=module).splitlines())
            text = "".join(f"{k}: {x}\n" for k, x in (lines | fields).items() if x is not None)
        (place / "project.yaml").write_text(text)
        return place

    write.root = str(root)
    return write


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
