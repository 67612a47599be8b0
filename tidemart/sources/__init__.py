from tidemart.sources.raw import RAW_COLUMNS, read_raw  # noqa: F401
from tidemart.sources.seeds import load_country_regions  # noqa: F401
from tidemart.sources.spine import time_spine  # noqa: F401
