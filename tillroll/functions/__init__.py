"""Column expressions shared by the views (all built-in Spark functions)."""

from tillroll.functions.calendar import (  # noqa: F401
    WEEKDAY_NAMES, SLOT_HOURS, created_date, created_hour, days_between, month_start,
    parse_day_header, parse_month_header, two_hour_slot, week_start_thursday,
    weekday_name, weekday_number, year_month,
)
from tillroll.functions.text import (  # noqa: F401
    csv_fields, joined_with_blank, naive_fields, upper_label,
)
