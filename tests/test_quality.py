import pytest

from doorstep.operators import quality


def keys(spark, values, source="v1"):
    return spark.createDataFrame(
        [(v, source) for v in values], "uprn string, addressbase_source string"
    )


@pytest.mark.parametrize(
    "source, target, status",
    [
        (["1", "2"], ["2", "1"], "match"),
        (["1", "2", "2"], ["1", "2"], "match"),  # the source may repeat
        (["1", "2"], ["1", "2", "2"], "mismatch"),  # the target may not
        (["1", "2"], ["1", "3"], "mismatch"),
        (["1", "2"], ["1"], "mismatch"),
        (["1"], ["1", "2"], "mismatch"),
        (["1", None], ["1"], "mismatch"),
        (["1"], ["1", None], "mismatch"),
        (["1", None], ["1", None], "mismatch"),  # rows exceed distinct keys
        ([], [], "mismatch"),
    ],
)
def test_key_sets(spark, source, target, status):
    row = quality.key_set_check(keys(spark, source), keys(spark, target)).first()
    assert row["match_status"] == status
    assert row["source_row_count"] == len(source)
    assert row["target_row_count"] == len(target)
    assert row["source_distinct_count"] == len({v for v in source if v is not None})
    assert row["target_distinct_count"] == len({v for v in target if v is not None})
    if status == "match":
        assert row["source_uprn_checksum"] == row["target_uprn_checksum"]


def test_checksum_ignores_order_and_repeats(spark):
    a = quality.key_set_check(keys(spark, ["1", "2", "3"]), keys(spark, ["3", "3", "2", "1"])).first()
    assert a["source_uprn_checksum"] == a["target_uprn_checksum"]
    b = quality.key_set_check(keys(spark, ["1", "2", "3"]), keys(spark, ["1", "2", "4"])).first()
    assert b["source_uprn_checksum"] != b["target_uprn_checksum"]


def test_single_source(spark):
    one = keys(spark, ["1", "2"])
    assert quality.assert_single_source(one)["source_count"] == 1
    with pytest.raises(quality.NotOneSource):
        quality.assert_single_source(one.union(keys(spark, ["3"], "v2")))
    with pytest.raises(quality.NotOneSource):
        quality.assert_single_source(keys(spark, []))
    with pytest.raises(quality.NotOneSource):
        quality.assert_single_source(keys(spark, ["1"], None))


def test_check_layer_gathers_all_failures(spark):
    raw = keys(spark, ["1", "2"])
    quality.check_layer(raw, raw)
    bad = keys(spark, ["1"]).union(keys(spark, ["3"], "v2"))
    with pytest.raises(quality.LayerCheckFailed) as error:
        quality.check_layer(raw, bad)
    assert [type(f) for f in error.value.failures] == [
        quality.KeySetMismatch,
        quality.NotOneSource,
    ]
