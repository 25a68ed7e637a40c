"""params handling: lower-cased keys, key_params JSON (PRJ7-8)."""

import pytest
from pyspark.sql import functions as F

from runlens.functions.maps import key_params_json, lower_keys

# Ordered map literals: a Python dict would arrive as a hash map with no entry order.
@pytest.mark.parametrize("params,expected", [
    ("map('Model', 'a', 'model', 'b')", '{"model":"b"}'),
    ("map('model', 'b', 'Model', 'a')", '{"model":"a"}'),
    ("map('lr', '1')", '{"model":"unknown"}'),
    ("cast(map() as map<string,string>)", '{"model":"unknown"}'),
    ("cast(null as map<string,string>)", "{}"),
])
def test_key_params(spark, params, expected):
    df = spark.range(1).select(F.expr(params).alias("params"))
    assert df.select(key_params_json(lower_keys(F.col("params")))).first()[0] == expected


def test_lower_keys_last_wins(spark):
    df = spark.range(1).select(F.expr("map('A', '1', 'a', '2', 'B', '3')").alias("params"))
    assert df.select(lower_keys(F.col("params"))).first()[0] == {"a": "2", "b": "3"}
