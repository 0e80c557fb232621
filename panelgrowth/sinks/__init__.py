from panelgrowth.sinks.writers import (  # noqa: F401
    BATCH_SIZES, SinkTarget, scratch_path, with_position_index, write_feed_tsv,
    write_reports, write_table,
)
