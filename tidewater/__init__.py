"""tidewater: e-commerce event ingest and table services on PySpark.

The main entry points, by job:

* streaming ingest: ``event_envelope`` -> ``start_ingest`` / ``run_ingest``,
  ``ingest_metrics``, ``start_preview``
* codec: ``encode_events``, ``decode_events``, ``decode_rejects``
* landed table: ``append_events``, ``read_landed``, ``read_partition_dir``,
  ``with_event_hour``
* batch jobs: ``where_equals``, ``take_rows``, ``overwrite_csv``,
  ``overwrite_parquet``, ``preview``, ``inline_rows``
* table services: ``register_landed``, ``sync_partitions``,
  ``partition_inventory``, ``column_stats``, ``compact``, ``retain``,
  ``apply_retention``, ``drop_expired_partitions``, ``duplicate_keys``,
  ``orphans``, ``write_bucketed``, ``skewed_values``, ``map_json``,
  ``register_catalog``, ``save_view``
"""

from tidewater.functions.codec import decode_events, decode_rejects, encode_events
from tidewater.functions.schema import EVENT_SCHEMA, LANDED_SCHEMA, TOPIC
from tidewater.functions.timefn import with_event_hour
from tidewater.operators.basic import take_rows, where_equals
from tidewater.operators.bucketing import heavy_values, read_skewed, skewed_values, write_bucketed, write_skewed
from tidewater.operators.catalog import (
    analyze_columns, drop_expired_partitions, partition_inventory, register_landed, sync_partitions,
)
from tidewater.operators.keyindex import check_batch
from tidewater.operators.refresh import refresh
from tidewater.operators.sketches import merge_sketches, refresh_sketches
from tidewater.operators.skipping import scan_values, update_index
from tidewater.operators.compaction import apply_retention, compact, compact_table, retain
from tidewater.operators.jsonmap import map_json
from tidewater.operators.keys import duplicate_keys, orphans
from tidewater.operators.sinks import append_events, overwrite_csv, overwrite_parquet, preview
from tidewater.operators.stats import column_stats
from tidewater.session import build_session, workspace
from tidewater.sources.envelope import event_envelope, publish_events, write_replay
from tidewater.sources.inline import inline_rows
from tidewater.sources.landed import read_landed, read_partition_dir
from tidewater.sources.tables import register_catalog, save_view
from tidewater.streaming.ingest import delivered_once, ingest_metrics, run_ingest, start_ingest, start_preview, start_record_log

__all__ = [
    "EVENT_SCHEMA", "LANDED_SCHEMA", "TOPIC", "analyze_columns", "append_events", "apply_retention",
    "build_session", "check_batch", "column_stats", "compact", "compact_table", "decode_events", "decode_rejects",
    "delivered_once", "drop_expired_partitions", "duplicate_keys", "encode_events", "event_envelope",
    "heavy_values", "ingest_metrics", "inline_rows", "map_json", "merge_sketches", "orphans", "overwrite_csv",
    "overwrite_parquet", "partition_inventory", "preview", "publish_events", "read_landed", "read_partition_dir",
    "read_skewed", "refresh", "refresh_sketches", "register_catalog", "register_landed", "retain", "run_ingest",
    "save_view", "scan_values", "skewed_values", "start_ingest", "start_preview", "start_record_log",
    "sync_partitions", "take_rows", "update_index", "where_equals", "with_event_hour", "workspace",
    "write_bucketed", "write_replay", "write_skewed",
]
