"""Dimension payload parsing (SRC3-8)."""

import pytest
from pyspark.sql.utils import AnalysisException  # noqa: F401

from runlens.sources.dimensions import (dedupe_metadata, latest_thresholds, parse_metadata, parse_thresholds,
                                        platform_defaults)


def _payloads(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "payload string")


def test_metadata_malformed_item_dropped(spark):
    text = ('{"metrics":[{"metric_name":"a","display_name":"A","description":"d","unit":null,"category":"c"},'
            '{"metric_name":"b","display_name":"B","description":"d","category":"c"},'
            '{"metric_name":"c","display_name":"C","description":"d","unit":"u","category":"c",'
            '"higher_is_better":"maybe"}]}')
    rows = parse_metadata(_payloads(spark, [text])).collect()
    assert [(r["metric_name"], r["higher_is_better"], r["unit"]) for r in rows] == [("a", True, None)]


def test_metadata_last_duplicate_wins(spark):
    a = '{"metric_name":"a","display_name":"%s","description":"d","unit":"u","category":"c"}'
    text = '{"metrics":[' + (a % "first") + "," + (a % "second") + "]}"
    rows = dedupe_metadata(parse_metadata(_payloads(spark, [text]))).collect()
    assert [r["display_name"] for r in rows] == ["second"]


def test_thresholds_iso_z_and_bad_time(spark):
    text = ('{"thresholds":[{"metric_name":"a","critical_threshold":1,"warning_threshold":2,"experiment_id":null,'
            '"updated_at":"2024-01-01T00:00:00Z","updated_by":"x"},'
            '{"metric_name":"b","critical_threshold":1,"warning_threshold":2,"experiment_id":"",'
            '"updated_at":"yesterday","updated_by":"x"}]}')
    rows = parse_thresholds(_payloads(spark, [text])).collect()
    assert [r["metric_name"] for r in rows] == ["a"]
    assert rows[0]["experiment_id"] is None


def test_platform_defaults_fail_whole_call(spark):
    text = ('{"thresholds":[{"metric_name":"a","critical_threshold":1,"warning_threshold":2,'
            '"updated_at":"2024-01-01T00:00:00","updated_by":"x"},'
            '{"metric_name":"b","critical_threshold":"x","warning_threshold":2,'
            '"updated_at":"2024-01-01T00:00:00","updated_by":"x"}]}')
    with pytest.raises(Exception):
        platform_defaults(_payloads(spark, [text])).collect()


def test_latest_threshold_per_key(spark):
    text = ('{"thresholds":[{"metric_name":"a","critical_threshold":1,"warning_threshold":2,'
            '"updated_at":"2024-01-01T00:00:00","updated_by":"x"},'
            '{"metric_name":"a","critical_threshold":5,"warning_threshold":6,'
            '"updated_at":"2024-01-02T00:00:00","updated_by":"y"}]}')
    rows = latest_thresholds(parse_thresholds(_payloads(spark, [text]))).collect()
    assert [(r["critical_threshold"], r["updated_by"]) for r in rows] == [(5.0, "y")]


def test_last_response_wins_however_payloads_are_partitioned(spark):
    def text(unit):
        return ('{"metrics":[{"metric_name":"m","display_name":"M","description":"d","category":"c","unit":"%s"}]}' % unit)

    given = spark.createDataFrame([(3, text("a")), (1, text("b")), (2, text("c"))], "response_ordinal int, payload string")
    for parts in (1, 2, 5):
        assert [r["unit"] for r in dedupe_metadata(parse_metadata(given.repartition(parts))).collect()] == ["a"]
        plain = given.drop("response_ordinal").repartition(parts)
        assert [r["unit"] for r in dedupe_metadata(parse_metadata(plain)).collect()] == ["c"]
