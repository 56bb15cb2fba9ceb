import pytest
from deedflow.llm import url_rules

from .test_native import RULES, decide


@pytest.mark.parametrize("inline", [url_rules.INLINE_RULES, 0])
def test_very_long_urls(spark, inline):
    urls = ["http://example.org/es/" + "a-b/" * 50000, "http://" + "sub." * 20000 + "example.org/en/1", "http://x.com/" + "?" * 100000, "x" * 100000]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id int, url string")
    got = url_rules.judge_urls(df, RULES, inline_rules=inline).select("page_id", "host", "path", "rule", "verdict")
    assert sorted(map(tuple, got.collect())) == sorted((i, *decide(u, RULES)) for i, u in enumerate(urls))
