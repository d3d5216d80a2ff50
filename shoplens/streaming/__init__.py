from shoplens.streaming.ads_app import (  # noqa: F401
    read_area_counts,
    read_filtered,
    read_window,
    start_area_counts,
    start_ban_filter,
    start_window_clicks,
)
from shoplens.streaming.ban_filter import bans, kept_clicks  # noqa: F401
from shoplens.streaming.control import run_until_marker, stop_gracefully, stop_on_signal  # noqa: F401
from shoplens.streaming.word_count import read_word_counts, start_word_count  # noqa: F401
