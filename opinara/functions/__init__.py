from opinara.functions.scalar import (  # noqa: F401
    exact_mean,
    fixed_text,
    half_even,
    half_up,
    parse_instant,
    pct_change,
    percent_text,
    rating_band,
    ratio_or_zero,
    shorten,
    strip_prefix,
    to_epoch_ns,
)
from opinara.functions.validation import (  # noqa: F401
    MAX_TEXT_CHARS,
    register_sql_functions,
    review_check,
    review_is_valid,
)
