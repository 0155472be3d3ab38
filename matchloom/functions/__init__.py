"""Column expressions."""

from matchloom.functions.dates import (  # noqa: F401
    current_season,
    month_end,
    parse_date,
    season_end_year,
    season_label,
    season_slug,
    season_start_year,
)
from matchloom.functions.events import (  # noqa: F401
    event_half,
    event_minute,
    event_players,
    event_time,
    event_type,
    formation,
    is_shootout,
    penalty_number,
    score_progression,
    squish,
)
from matchloom.functions.values import (  # noqa: F401
    cast_to,
    expected_families,
    float_to_int,
    has_advanced,
    map_value,
    page_path,
    quoted,
    to_double,
    url_segment,
)
