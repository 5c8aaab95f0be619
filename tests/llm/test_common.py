import random

import pytest

from lakeshift.llm import common as c


def brute(links):
    parent = {x: x for p in links for x in p}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    return {x: find(x) for x in parent}


def got(spark, links):
    df = spark.createDataFrame(links, "a long, b long")
    rows = c.components(df).collect()
    assert len(rows) == len({r.node for r in rows})
    return {r.node: r.component for r in rows}


@pytest.mark.parametrize("hub", [1000, 3])
def test_components(spark, monkeypatch, hub):
    monkeypatch.setattr(c, "HUB", hub)
    rng = random.Random(6)
    path = [(k, k + 1) for k in range(100, 160)]
    star = [(500, 501 + k) for k in range(40)] + [(520, 700 + k) for k in range(30)]
    loose = [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(60)]
    links = path + star + loose + [(5, 5), (100, 101), (101, 100)]
    want = {x: y for x, y in brute(links).items() if x != 5 and any(x in p and p[0] != p[1] for p in links)}
    assert got(spark, links) == want


@pytest.mark.parametrize("hub", [1000, 3])
def test_components_of_many_nodes(spark, monkeypatch, hub):
    monkeypatch.setattr(c, "FEW", 0)
    monkeypatch.setattr(c, "HUB", hub)
    rng = random.Random(7)
    links = [(k, k + 1) for k in range(100, 130)] + [(k, 500) for k in range(501, 540)] + [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(60)]
    links = [(a, b) for a, b in links if a != b]
    assert got(spark, links + links[:5]) == brute(links)


def stages(spark, run):
    """How many stages have run meanwhile."""
    status = spark.sparkContext.statusTracker()

    def mark():
        spark.sparkContext.setJobGroup(group := f"mark {random.random()}", "")
        spark.sparkContext.parallelize([1], 1).count()
        return status.getJobInfo(status.getJobIdsForGroup(group)[0]).stageIds[0]

    first = mark()
    run()
    found = [status.getStageInfo(k) for k in range(first + 1, mark())]
    return sum(x is not None and x.numCompletedTasks > 0 for x in found)


def test_a_round_has_few_stages(spark):
    star, path = [(1, k) for k in range(2, 50)], [(100 + k, 101 + k) for k in range(6)]
    counts = [stages(spark, lambda links=links: got(spark, links)) for links in (star, path)]
    assert counts[0] <= 10 and counts[1] <= 50, counts  # a step's rows are written, not made again


def test_no_links(spark):
    assert got(spark, [(1, 1)]) == {}


def test_words_and_bytes(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("ABc Éß",), ("plain TEXT",), ("",), (None,)], "t string")
    assert [r.x for r in df.select(c.ascii_lower(F.col("t")).alias("x")).collect()] == ["abc Éß", "plain text", "", None]
