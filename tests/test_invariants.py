"""Invariants on the driver feed: counts add up, results do not depend on
partitioning, input order, strategy or repetition."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from rowgate import evaluate, report
from rowgate.plans import fixtures as fx
from tests.conftest import SF


def _verdict(df, **kw):
    v = evaluate(df, fx.feed_contract(), as_of=fx.AS_OF, **kw)
    return Counter((r.order_key, r.rejection_reasons) for r in v.select("order_key", "rejection_reasons").collect())


@pytest.fixture(scope="module")
def feed(spark):
    return fx.dirty_orders(spark, SF)


@pytest.fixture(scope="module")
def baseline(feed):
    return _verdict(feed)


def test_counts_add_up(feed):
    v = evaluate(feed, fx.feed_contract(), as_of=fx.AS_OF)
    tot = v.agg(F.count("*").alias("n"), F.count_if("is_valid").alias("ok"),
                F.count_if(~F.col("is_valid")).alias("bad"),
                F.sum(F.size("violations")).alias("nv")).first()
    assert tot.ok + tot.bad == tot.n == feed.count()
    assert report(v).count() == tot.nv
    assert v.where(F.col("is_valid") != (F.col("rejection_reasons") == "")).count() == 0


@pytest.mark.parametrize("parts", [1, 3, 17])
def test_partitioning_and_order_do_not_matter(feed, baseline, parts):
    shuffled = feed.repartition(parts).orderBy(F.rand(7))
    assert _verdict(shuffled) == baseline


def test_strategies_and_repeats_agree(feed, baseline):
    assert _verdict(feed, unique_strategy="window") == baseline
    assert _verdict(feed, hot_key_rows=2) == baseline
    assert _verdict(feed, hot_key_rows=2, unique_strategy="window") == baseline
    assert _verdict(feed) == baseline
