"""Write PLANS.md: the physical plan of each operator's core DataFrame.

For sinks this is the frame handed to the writer, not the read-back.
usage: python scripts/show_plans.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, HERE)


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("simple")
    text = buf.getvalue()
    text = re.sub(r"#\d+L?", "", text)  # expression ids
    text = re.sub(r"file:[^,\]\s]*", "<path>", text)
    return "\n".join(line[:220] for line in text.strip().splitlines())


def main(argv):
    from tidewater.functions.codec import decode_events
    from tidewater.functions.timefn import with_event_hour
    from tidewater.operators.basic import take_rows, where_equals
    from tidewater.operators.bucketing import drop_table, skewed_values
    from tidewater.operators.catalog import partition_inventory
    from tidewater.operators.compaction import retain
    from tidewater.operators.files import list_files
    from tidewater.operators.jsonmap import map_json
    from tidewater.operators.keys import duplicate_keys, orphans
    from tidewater.operators.stats import column_stats
    from tidewater.plans import queries as Qs
    from tidewater.plans import sql as Q
    from tidewater.session import build_session, ship_package, unique_name
    from tidewater.sources.fixtures import envelope_fixture, event_fixture
    from tidewater.sources.landed import read_landed
    from tidewater.sources.tables import read_table, register_catalog

    sf = argv[0] if argv else "/root/testdata/sf0.1"
    spark = build_session(master="local[8]", shuffle_partitions=16)
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    landed = Qs._landed_table(spark, sf)
    fx = with_event_hour(event_fixture(spark, sf))
    lo = read_landed(spark, landed)
    register_catalog(spark, sf, ("region", "nation", "customer", "supplier", "orders", "lineitem"))
    tables = unique_name("orders_b"), unique_name("lineitem_b")
    items = [
        ("A13 equality filter on the fixture (pushed to Parquet)", where_equals(event_fixture(spark, sf), "event_type", "purchase")),
        ("A11 partitioned append: frame handed to the writer", fx.hint("rebalance", "event_date", "event_hour")),
        ("A5 pruned scan of one date", read_landed(spark, landed, date="20240101")),
        ("A14 ordered limit", take_rows(read_landed(spark, landed, date="20240101"), 100, order_by="event_time")),
        ("R1+A7 encode then decode (one Python evaluation)", decode_events(envelope_fixture(spark, sf), keep=("key",))),
        ("R3 partition inventory", partition_inventory(lo)),
        ("R4 column statistics (approximate distinct)", column_stats(lo)),
        ("R7 primary-key duplicates", duplicate_keys(read_table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])),
        ("R7 foreign-key orphans", orphans(read_table(spark, sf, "orders"), read_table(spark, sf, "lineitem"), "o_orderkey", "l_orderkey")),
        ("R9 skewed values", skewed_values(read_table(spark, sf, "events"), "event_type", 0.2)),
        ("R10 retention (newest date from the file listing; subquery in PartitionFilters)",
         retain(lo, "event_date", 7, dates=list_files(spark, landed))),
        ("R11 JSON mapping", map_json(read_table(spark, sf, "events").select("event_id", "props"), "props", Qs.JSON_MAPPING)),
        ("S1", spark.sql(Q.S1)), ("S2", spark.sql(Q.S2)), ("S3", spark.sql(Q.S3)), ("S4", spark.sql(Q.S4)),
        ("S5 landed report", spark.sql(Q.S5_TEMPLATE.format(table="landed_v")) if
         lo.createOrReplaceTempView("landed_v") is None else None),
        ("R8 bucketed join (lineitem aggregated inside its buckets)", Qs.bucketed_revenue(spark, sf, *tables)),
    ]
    print("# PLANS\n")
    print(f"Physical plans at `{os.path.basename(sf)}`, local[8], AQE on (plans before AQE re-planning; "
          "generated by `scripts/show_plans.py`). Expression ids and paths removed.\n")
    for title, df in items:
        print(f"## {title}\n\n```\n{plan(df)}\n```\n")
    for t in tables:
        drop_table(spark, t)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
