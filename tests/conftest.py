import json
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from adloom.session import build_session  # noqa: E402
from adloom.sources.vocabulary import read_vocabulary  # noqa: E402

LISTS = {
    "fuel_type": ["بنزين", "ديزل / مازوت", "كهربائي", "هجين"],
    "transmission": ["أوتوماتيك", "شبه أوتوماتيك", "يدوي"],
    "vehicle_type": ["SUV", "سيدان", "كوبيه", "نقل", "هاتشباك"],
    "location": ["دمشق", "ريف دمشق", "حمص", "حلب", "حماة"],
    "color": ["أبيض", "أسود", "رمادي", "فضي"],
    "interior_color": ["بيج", "رمادي"],
    "doors": ["بابين", "3 أبواب", "4 أبواب"],
    "condition": ["جديد", "مستعمل"],
    "imported": ["أمريكي", "خليجي", "كوري"],
    "drive_type": ["دفع أمامي", "دفع خلفي", "دفع رباعي"],
}
BRANDS = {
    "ماركة": ["Name"],
    "هيونداي": [" سوناتا", "ماتريكس", "إلنترا", "سوناتا", "توسان"],
    "كيا": ["ريو", "سيراتو", "K5"],
    "مرسيدس بنز": ["الفئة C", "الفئة S"],
    "لكزس": ["IS", "RX"],
    "بلا": [],
}
ALIASES = {"tucson": "توسان", "rio": "ريو"}


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def vocabulary(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("vocabulary")
    lists = {k: [{"name": n} for n in names] for k, names in LISTS.items()}
    (folder / "lists.json").write_text(json.dumps(lists, ensure_ascii=False), encoding="utf-8")
    (folder / "brands.json").write_text(json.dumps(BRANDS, ensure_ascii=False), encoding="utf-8")
    (folder / "aliases.json").write_text(json.dumps(ALIASES, ensure_ascii=False), encoding="utf-8")
    return read_vocabulary(
        spark,
        str(folder / "lists.json"),
        [str(folder / "missing.json"), str(folder / "brands.json")],
        str(folder / "aliases.json"),
    )


@pytest.fixture(scope="session")
def evaluate(spark):
    """Value of a column expression over one row of text columns ``c0, c1, ...``."""

    def run(make, *values):
        from pyspark.sql import functions as F

        names = [f"c{i}" for i in range(len(values))]
        schema = ", ".join(f"{n} string" for n in names) or "c0 string"
        row = tuple(values) or (None,)
        frame = spark.createDataFrame([row], schema)
        return frame.select(make(*[F.col(n) for n in names]).alias("r")).first()["r"]

    return run
