from riskmart.sources.bucketed import read_bucketed, write_bucketed  # noqa: F401
from riskmart.sources.fixtures import fixture_sources  # noqa: F401
from riskmart.sources.readers import read_sources, validate_sources  # noqa: F401
from riskmart.sources.schemas import SOURCE_TABLES  # noqa: F401
