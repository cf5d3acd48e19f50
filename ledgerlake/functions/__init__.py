"""Column -> Column scalar functions (key normalisation, parsing, months)."""

from .keys import (  # noqa: F401
    as_text,
    changed_by_normalising,
    clean_text,
    compose_key,
    digits_key,
    ident_key,
    is_blank,
    key_for_mode,
    keyword_flag,
    lookup_key,
    lowered_in,
    meaning_tag,
    parse_date,
    parse_number_text,
    py_strip,
    segment_key,
    strip_trailing_zero,
    text_key,
    to_number,
    to_text,
)
from .months import (  # noqa: F401
    discover_month_columns,
    month_header_parts,
    month_label,
    month_label_col,
    parse_month_header,
    previous_month_starts,
    previous_months,
)
