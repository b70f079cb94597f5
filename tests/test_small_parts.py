"""Rounding, settings, schemas, episode lists."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from framelake import schemas
from framelake.functions import columns as C
from framelake.functions import settings as S
from framelake.sources import discovery, resolve


def test_rounding_follows_the_binary_value(spark):
    r = random.Random(2)
    xs = [2.675, 0.125, 0.375, -0.125, 1e-9, 0.0, 5e-3, 1.005, 2.5, 3.5, -2.5, 1e15 + 0.3, float(2**53), None] + [r.randint(-(10**6), 10**6) / 1000 + 0.0005 for _ in range(2000)] + [r.randint(0, 10**5) / 2**r.randint(0, 8) for _ in range(2000)] + [r.uniform(-1e6, 1e6) for _ in range(500)]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, x double").select("i", *(C.rounded(F.col("x"), k).alias(f"k{k}") for k in (0, 1, 2, 3, 4, 6)))
    for row in df.collect():
        x = xs[row.i]
        for k in (0, 1, 2, 3, 4, 6):
            assert row[f"k{k}"] == (None if x is None else round(x, k)), (x, k, Decimal(x))
    with pytest.raises(ValueError, match="decimals"):
        C.rounded(F.lit(1.0), 9)


def test_settings_by_their_chains(spark):
    kinds = (S.ProviderKind("one", ("ONE_KEY",), "https://one", "one-small", True), S.ProviderKind("two", ("TWO_KEY", "TWO_OLD"), "https://two", "two-small"))
    cases = [
        ({}, ("one", "one-small", "", "https://one", True)),
        ({"VLM_API_PROVIDER": " TWO ", "VLM_API_KEY": "g", "TWO_OLD": " t "}, ("two", "two-small", "t", "https://two", False)),
        ({"VLM_API_PROVIDER": "other", "VLM_API_KEY": "g"}, ("other", "last", "g", "https://one", False)),
        ({"VLM_CAPTION_MODEL": " ", "VLM_DEFAULT_MODEL": "d"}, ("one", "d", "", "https://one", True)),
        ({"VLM_CAPTION_MODEL": "c", "VLM_MODEL": "m"}, ("one", "c", "", "https://one", True)),
        ({"VLM_API_PROVIDER": "  ", "VLM_MODEL": "m", "VLM_DEFAULT_MODEL": "d"}, ("one", "m", "", "https://one", True)),
    ]
    m = F.col("m")
    df = spark.createDataFrame([(i, c) for i, (c, _) in enumerate(cases)], "i int, m map<string,string>").select("i", S.provider(m, "one"), S.model(m, kinds, "one", "caption", "last"), S.key(m, kinds, "one"), S.address(m, kinds, "one"), S.takes_batches(m, kinds, "one"))
    assert {r[0]: tuple(r)[1:] for r in df.collect()} == {i: w for i, (_, w) in enumerate(cases)}


def test_records_conform(spark):
    df = spark.createDataFrame([("7", 1, 2.0, "more")], "episode string, n int, fps float, other string")
    got = schemas.conform(df, schemas.EPISODE)
    assert got.schema.simpleString() == "struct<episode:bigint,n:bigint,fps:double>" and got.first().episode == 7
    with pytest.raises(ValueError, match="missing columns: s, e"):
        schemas.conform(df.withColumn("instruction", F.lit("x")), schemas.SEGMENT)


def test_episode_lists(spark, tmp_path):
    for p in ("b/rgb.mp4", "a/only.mov", "c/one.mp4", "c/two.mp4", "d/notes.txt", "e/VIDEO.MP4", "e/x.mp4", "b/segments/s1/rgb.mp4"):
        (tmp_path / "root" / p).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "root" / p).write_text("x")
    tree = resolve.read_tree(spark, str(tmp_path))
    top = f"{tmp_path}/root"
    got = discovery.episode_list(tree, ["root/c/", f"{top}/none", "root/b"], "root", str(tmp_path)).collect()
    assert [r.episode for r in sorted((r for r in got if r.place is not None), key=lambda r: r.place)] == [f"{top}/{x}" for x in ("c", "b", "a", "b", "e")]
    assert [(r.episode, r.note) for r in got if r.place is None] == [(f"{top}/none", "episode folder not found")]
    only = discovery.episode_list(tree, f"{top}/a", f"{tmp_path}/gone").collect()
    assert sorted((r.episode, r.note) for r in only) == [(f"{tmp_path}/gone", "episode root not found"), (f"{top}/a", None)] if f"{tmp_path}/gone" < f"{top}/a" else True


def test_time_of_the_query(spark):
    import re
    from datetime import datetime, timezone

    now = spark.range(1).select(C.utc_now()).first()[0]
    assert re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ", now) and abs(datetime.now(timezone.utc).timestamp() - datetime.fromisoformat(now.replace("Z", "+00:00")).timestamp()) < 120
