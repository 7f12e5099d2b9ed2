"""Imports every query module so their registrations run."""

from . import q_shipments  # noqa: F401
from . import q_series  # noqa: F401
from . import q_eval  # noqa: F401
from . import q_text  # noqa: F401
from . import q_cluster  # noqa: F401
from . import q_events  # noqa: F401
from . import q_pipeline  # noqa: F401
from . import q_forecast  # noqa: F401
