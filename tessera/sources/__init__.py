from tessera.sources.tables import (  # noqa: F401
    DRIVER_TABLES, table, register_tables, read_csv, drop_unnamed, read_processed_pair,
    split_part, write_table, write_summary_json, write_representation,
    read_representation, save_model, load_pipeline_model,
)
