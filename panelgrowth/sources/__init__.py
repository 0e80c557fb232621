from panelgrowth.sources.feeds import (  # noqa: F401
    FACT_COLUMNS, LookupSource, date_ref_from_column, date_ref_row, fact_schema,
    read_facts, read_lookup,
)
