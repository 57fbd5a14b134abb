"""Column functions: nothing here touches a DataFrame or leaves the JVM."""

from mixloom.functions.artists import pick_artists, pick_artists_with_cover
from mixloom.functions.ids import mix_id, stable_mix_id
from mixloom.functions.lists import last_items, ordered_values
from mixloom.functions.text import clean_title
from mixloom.functions.time import at_date, day_slice_start, months_before, updated_millis

__all__ = [
    "at_date",
    "clean_title",
    "day_slice_start",
    "last_items",
    "mix_id",
    "months_before",
    "ordered_values",
    "pick_artists",
    "pick_artists_with_cover",
    "stable_mix_id",
    "updated_millis",
]
