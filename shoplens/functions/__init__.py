from shoplens.functions.columns import (  # noqa: F401
    date_label,
    datetime_label,
    id_list,
    kv_field,
    kv_key,
    millis_from_ntz,
    minute_label,
    ntz_from_millis,
    pairs_json,
    pairs_json_object,
    percent_of,
    round_half_up,
    split_like_java,
    words,
)
