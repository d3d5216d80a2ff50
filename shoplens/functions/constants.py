"""Fixed values that results must reproduce exactly.

These are stated once, here, in natural order.  Everything else is derived.
"""

# --- fixed values ------------------------------------------------------------
# Label of the "all other cities" share in the city click-share text; note the
# full-width colon.  Example of the whole text: "甲市:50.0%,乙市:30.0%,其它：20.0%".
OTHER_CITIES_LABEL = "其它："
# Separators inside the city click-share text.
SHARE_ITEM_SEPARATOR = ","
SHARE_CITY_SEPARATOR = ":"
SHARE_PERCENT_SIGN = "%"
# How many leading cities the share text names.
SHARE_TOP_CITIES = 2
# Separator of multi-valued id columns, as in "4,15".
ID_LIST_SEPARATOR = ","
# Field separator of an ad-click wire line "timestamp area city userid adid".
ADS_LINE_SEPARATOR = " "
# Word separator of the running word count.
WORD_SEPARATOR = " "
# Sentinel for "not a click" in click_category_id / click_product_id.
NOT_A_CLICK = -1
# Clicks of one user on one ad in one day that put the user on the ban list.
BAN_THRESHOLD = 100
# Default job sizes: top categories, top sessions per category, top products
# per area (ties kept), top ads per day and area.
TOP_CATEGORIES = 10
TOP_SESSIONS = 10
TOP_PRODUCTS = 3
TOP_ADS = 3
# Trailing window of the per-minute ad click report, in minutes.
AD_WINDOW_MINUTES = 60
# Time-label formats.
DATE_FORMAT = "yyyy-MM-dd"
DATETIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
MINUTE_FORMAT = "HH:mm"
# Keys of the keyed result tables.
KEY_DATE_USER_AD = "date_user_ad_"
KEY_DATE_AREA_CITY_AD = "date_area_city_ad_"
KEY_TOP3_ADS_PER_DAY = "top3_ads_per_day:"
KEY_LAST_HOUR_ADS_CLICK = "last_hour_ads_click"
KEY_BLACKLIST = "BlackList"
KEY_FIELD_SEPARATOR = ":"
# Default page flow of the page-jump job and the default job conditions.
DEFAULT_PAGE_FLOW = "1,2,3,4,5,6,7"
DEFAULT_CONDITIONS = {
    "targetPageFlow": DEFAULT_PAGE_FLOW,
}
# Prefix of the run id written with each batch result ("aaa--<epoch ms>").
TASK_ID_PREFIX = "aaa--"
# --- end of fixed values -----------------------------------------------------

# Seconds that a click's clock may run ahead of its arrival.
AHEAD_SECONDS = 60
