import pytest
from pyspark.sql import functions as F

from visitlake import functions as fn

ACCOUNT = "123456789012"


def masked(spark, text, expression=fn.mask_text):
    return spark.createDataFrame([(text,)], "text string").select(expression("text")).head()[0]


@pytest.mark.parametrize("text, expected", [
    (f"arn:aws:iam::{ACCOUNT}:role/x in {ACCOUNT}", "<arn> in <account-id>"),
    (f"{ACCOUNT} {ACCOUNT}", "<account-id> <account-id>"),
    (f"1{ACCOUNT}", f"1{ACCOUNT}"),
    ("s3://shop-t1-bronzebucket-a1b2c3/key", "s3://<bronze-bucket>/key"),
    ("s3://shop-ATHENARESULTSbucket-A1/q", "s3://<athena-results-bucket>/q"),
    ("a-bronzebucket-x-goldbucket-y", "<bronze-bucket>-goldbucket-y"),
    ("my-silverbucket-z and prod-gold-lake-goldbucket-abc", "<silver-bucket> and <gold-bucket>"),
    ("owner is someone.name@example.com today", "owner is <email> today"),
    ("a@b.com_x@y.org", "<email><email>"),
    ("x@y z..@a.bc, a.b@c.d.ef_ @g.hi", "x@y <email>, <email>_ @g.hi"),
    ("nothing private", "nothing private"),
    (None, None)])
def test_mask_text(spark, text, expected):
    assert masked(spark, text) == expected


def test_mask_versions(spark):
    version = "a1" * 16
    mask = lambda column: fn.mask_versions(F.col(column))
    assert masked(spark, f'"VersionId": "xyz", {version}', mask) == '"VersionId": "<version-id>", <version-id>'
    assert masked(spark, f"path/{version}", mask) == f"path/{version}"
    assert masked(spark, "b" * 32, mask) == "b" * 32


def test_mask_visit_hides_only_the_visit_part_of_its_click_ids(spark):
    mask = lambda column: fn.mask_visit(column, F.lit(42))
    assert masked(spark, "uci553-42-7 uci553-421-7 42", mask) == "uci553-visit A-7 uci553-421-7 42"


def test_mask_visit_fields_of_json(spark):
    text = '{"visit_id": 42, "other": 42, "rows": [{"visit_id":"42"}, {"visit_id": null}]}'
    assert masked(spark, text, fn.mask_visit_fields) == (
        '{"visit_id": "visit A", "other": 42, "rows": [{"visit_id":"visit A"}, {"visit_id": null}]}')


def test_addresses_are_those_of_the_plain_pattern(spark):
    import random
    import re

    from visitlake.functions import masking
    draw = random.Random(3)
    texts = ["".join(draw.choice("ab.@_-+ c1") for _ in range(draw.randint(1, 60))) + draw.choice(["", "a@b.cde_f@g.hij"]) for _ in range(400)]
    frame = spark.createDataFrame([(text,) for text in texts], "text string")
    found = [row[0] for row in frame.select(masking.mask_emails(F.col("text"))).collect()]
    assert found == [re.sub(masking.EMAIL, "<email>", text) for text in texts]


def test_a_long_word_without_an_address_costs_no_quadratic_time(spark):
    assert masked(spark, "x" * 300_000 + " @") == "x" * 300_000 + " @"
