"""All registered queries; importing the modules fills the catalog."""

from . import acknowledging, configuring, converting, publishing, reading, reporting  # noqa: F401
from .catalog import ORACLES, QUERIES  # noqa: F401
