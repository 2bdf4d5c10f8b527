"""salesmart: a PySpark sales-analytics warehouse.

Landing -> ordered data-quality cleansing -> monthly metrics per customer,
employee, payment type and product -> quarterly / yearly roll-ups, plus
previews, ad-hoc SQL, CSV export, per-client daily query quotas and
latest-run reporting.  Everything is DataFrame / SQL / Structured Streaming.
"""

__version__ = "0.1.0"

from .plans.warehouse import Warehouse, from_csv, warehouse  # noqa: E402
from .session import build_session, configure  # noqa: E402

__all__ = ["Warehouse", "build_session", "configure", "from_csv", "warehouse"]
