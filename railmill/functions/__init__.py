"""Column expressions: keys, lenient parsing, text, times and code labels."""

from railmill.functions.keys import surrogate_key, unknown_key
from railmill.functions.labels import code_label
from railmill.functions.parsing import (
    blank_to_null,
    date_midnight,
    day_flags,
    iso_to_date,
    json_text,
    parse_bool,
    parse_int,
    parse_millis,
    safe_cast,
    sector_code_number,
    strict_cast,
)
from railmill.functions.text import (
    area_of_station,
    category_colour,
    code_normalise,
    concat_or_null,
    signalling_id,
    slug_code,
    text_from,
)
from railmill.functions.timing import (
    allowance_minutes,
    at_time_of_day,
    delay_bucket,
    hhmm_time,
    runs_on,
    runs_on_column,
    service_date,
    weekday_number,
)

__all__ = [name for name in dir() if not name.startswith("_")]
