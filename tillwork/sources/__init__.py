from tillwork.sources.bronze import BRONZE_TABLES, compare_contents, copy_bronze, read_bronze  # noqa: F401
from tillwork.sources.derived import DerivedBronze  # noqa: F401
