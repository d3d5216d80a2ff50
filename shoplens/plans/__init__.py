from shoplens.plans.ads import (  # noqa: F401
    ads_after_ban,
    ban_list,
    daily_user_ad_count,
    date_area_city_ad_count,
    date_area_top_ads,
    last_window_ad_clicks,
    last_window_ad_clicks_json,
    parse_ads_lines,
    running_word_count,
)
from shoplens.plans.area_product import area_product_count, area_product_share, area_product_top3  # noqa: F401
from shoplens.plans.category import (  # noqa: F401
    category_counts,
    category_session_counts,
    category_session_top10,
    category_top10,
    filter_actions,
)
from shoplens.plans.page_jump import page_jump_count, page_jump_ratio, page_visit_count  # noqa: F401
