from cirrus.sources.landing import (  # noqa: F401
    LANDING_COLUMN, ZONES, create_table, insert_select, read_json_documents,
    read_table, write_table, zone_path,
)
