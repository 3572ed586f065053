from cirrus.functions.scalars import (  # noqa: F401
    CANONICAL_TIMEZONE, CITY_ALLOW_LIST, UTC_OFFSET_LABELS,
    epoch_to_timestamp, round_coordinate, timestamp_to_epoch, timezone_override,
    to_date, utc_offset_label, wind_direction,
)
from cirrus.functions.paths import (  # noqa: F401
    CITY_FIELDS, OBSERVATION_FIELDS, extract,
)
