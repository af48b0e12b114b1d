"""Importing this module registers every query of the library."""

from . import q_kpi, q_loads, q_master, q_products, q_views, q_demand_loads, q_files  # noqa: F401
from . import q_demand_view, q_erp, q_scalar, q_suites  # noqa: F401
from . import q_relational  # noqa: F401
from . import q_allocate  # noqa: F401
from . import q_validate  # noqa: F401
from . import q_reports  # noqa: F401
from . import q_sources  # noqa: F401
