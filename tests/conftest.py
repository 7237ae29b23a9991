import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tickerloom.session import build  # noqa: E402

TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
    })
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def tables():
    return TABLES


@pytest.fixture(scope="session")
def smoke_posts(spark):
    """Thirteen posts: three written out, ten alike."""
    now = "2024-01-01 10:00:00"
    written = [
        ("0", "delta_hedger", "Gold stock futures rally hard to a green high as buyers lift prices past resistance and gain more. #gold #rally", 31, 6, 2, ["gold", "rally"]),
        ("1", "ridge_shorts", "Crude market slides lower on weak demand, sellers press and the loss may deepen. #crude #selloff", 12, 19, 7, ["crude", "selloff"]),
        ("2", "quiet_quant", "Rupee trading holds steady against the dollar while desks wait for the policy call. #rupee #forex", 30, 12, 4, ["rupee", "forex"]),
    ]
    alike = [
        (str(i + 3), f"user_{i}", f"Plain market remark number {i} carrying no opinion at all. #nifty50", 2 * i, i, i // 2, ["nifty50"])
        for i in range(10)
    ]
    schema = "id string, username string, content string, likes bigint, retweets bigint, replies bigint, hashtags array<string>"
    posts = spark.createDataFrame(written + alike, schema)
    return posts.selectExpr(
        "*", "cast(array() as array<string>) AS mentions", f"timestamp '{now}' AS timestamp", "id AS hashtag_source"
    )
