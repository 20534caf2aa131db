"""A topic fetched long ago survives copies without one, whatever the lookback."""

import pytest
from conftest import rows, ts
from pyspark.sql import functions as F

from kerbside.operators import silver
from kerbside.plans import medallion
from kerbside.plans.catalog import Tables
from kerbside.sources import messages

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("between", [False, True])
def test_a_topic_of_an_older_day_is_kept(spark, tmp_path, between):
    t, layout = Tables(spark, SF), medallion.Layout(str(tmp_path))
    now = F.lit("2024-01-31 00:00:00").cast("timestamp")
    key = silver.silver_requests(t.messages).select("channel", F.col("message_id").alias("id")).orderBy("channel", "id").limit(1)
    one = silver.latest_copy(t.messages).join(key, ["channel", "id"], "left_semi")
    for day, topic in ((10, 7), (20, None)):
        copy = one.withColumns({"topic_id": F.lit(topic).cast(one.schema["topic_id"].dataType), "scraped_at_gmt8": F.lit(ts(f"2024-01-{day} 12:00:00")).cast("timestamp_ntz")})
        messages.append_messages(layout.at("bronze"), copy.select(*t.messages.columns), f"r{day}")
        if between or day == 20:
            medallion.transform_run(spark, layout, t.gazetteer, f"2024-01-{day} 13:00:00", f"r{day}", now, hours=6)
    requests = medallion.read_silver(spark, layout)
    assert [r.topic_id for r in requests.collect()] == [7]
    want, _ = medallion.full_refresh(messages.read_message_table(spark, layout.at("bronze")), medallion.read_geocodes(spark, layout, now))
    assert rows(requests) == rows(want)


def test_silver_keeps_a_topic_that_a_newer_run_lacks(spark):
    row = silver.silver_requests(Tables(spark, SF).messages).limit(1)
    older = row.withColumns({"topic_id": F.lit(7).cast(row.schema["topic_id"].dataType), "scraped_at_gmt8": F.col("scraped_at_gmt8") - F.expr("interval 1 day")})
    newer = row.withColumn("topic_id", F.lit(None).cast(row.schema["topic_id"].dataType))
    assert [r.topic_id for r in medallion._newest_requests(older.unionByName(newer)).collect()] == [7]
