from shoplens.operators.city_share import city_share, register_city_ratio_function  # noqa: F401
from shoplens.operators.filters import action_categories, action_kind, filter_actions, range_filter  # noqa: F401
from shoplens.operators.joins import bounded_broadcast, is_bounded, join_dimension  # noqa: F401
from shoplens.operators.sequence import consecutive_pairs, flow_pairs  # noqa: F401
from shoplens.operators.topk import top_k, top_k_per_group  # noqa: F401
