"""All registered queries; importing the modules fills the catalog."""

from . import audit, customers, decisions, streams, telemetry  # noqa: F401
from .catalog import CHECKS, QUERIES  # noqa: F401
