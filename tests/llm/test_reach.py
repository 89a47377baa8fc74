"""Partners of a set by the place of the first common shingle."""

import pytest

from lanepulse.llm.jaccard_join import Threshold


@pytest.mark.parametrize("percent", [50, 80])
def test_reach_holds_the_partners_that_can_share_enough(spark, percent):
    limit = Threshold(percent)
    rows = spark.range(1, 25).selectExpr("id AS n", "explode(sequence(0, id - 1)) AS rank")
    for n, rank, reach in rows.selectExpr("n", "rank", limit.reach()).collect():
        can = [m for m in limit.partners(n) if limit.overlap(n, m) <= n - rank]
        assert can == [m for m in limit.partners(n) if m <= reach]
