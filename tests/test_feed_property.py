"""A8/G2/G3 stated as properties of what is kept, on random feeds."""
import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cartwright.contracts import FeedContract
from cartwright.sources import feed as feed_src

feeds = st.lists(st.one_of(st.integers(min_value=1, max_value=60), st.none()), max_size=40)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ts=feeds, wm=st.integers(min_value=0, max_value=60), page_size=st.integers(1, 5), max_pages=st.integers(1, 4))
def test_what_a_pull_keeps(spark, ts, wm, page_size, max_pages):
    df = spark.createDataFrame([(json.dumps({"last_modified_t": t}), i) for i, t in enumerate(ts)], "j string, seq long")
    feed = df.select(F.parse_json("j").alias("payload"), F.col("seq").alias("feed_seq"))
    contract = FeedContract(page_size=page_size, max_pages=max_pages)
    time = {i: t or 0 for i, t in enumerate(ts)}

    def kept(**how):
        return [r.feed_seq for r in feed_src.extract(feed, wm, contract, tie_breaks=["feed_seq"], **how).collect()]

    everything, capped = kept(), kept(capped=True)
    fresh = {i for i, t in time.items() if t > wm}
    # all rows above the mark and no others, newest first, the later of two in a second first
    assert set(everything) == fresh and len(everything) == len(fresh)
    assert all((time[a], a) > (time[b], b) for a, b in zip(everything, everything[1:]))
    # the cap takes the front of that order: no row kept is older than a fresh one left
    assert capped == everything[:page_size * max_pages]
    assert feed_src.left_behind(feed, wm, contract) == len(everything) - len(capped)
