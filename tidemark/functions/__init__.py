from tidemark.functions.dates import (  # noqa: F401
    day_bounds,
    day_suffix,
    effective_change,
    key_bounds,
    lake_columns,
    window_bounds,
)
from tidemark.functions.keys import hash_key, surrogate_key, uuid_v5, version_key  # noqa: F401
from tidemark.functions.measures import (  # noqa: F401
    MONEY,
    UNKNOWN,
    discount_amount,
    discount_level,
    discounted_price,
    money,
    or_unknown,
    removal,
    safe_ratio,
    signed,
)
from tidemark.functions.text import quoted_items, strip_chars  # noqa: F401
