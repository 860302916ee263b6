"""rollwise: marketplace sales, inventory and purchase-order rollups on Spark.

Entry points: ``rollwise.reports`` (one function per report and incremental
load), ``rollwise.operators.dashboard`` (D1-D13), ``rollwise.plans.backfill``
and ``rollwise.plans.incremental`` (table maintenance), ``rollwise.sources``
(feeds, fixtures, report tables).
"""

from .session import apply_conf, build_session
from .specs import BLINKIT, INSTAMART, ZEPTO, PlatformSpec, platform
from .windows import DateWindow

__version__ = "0.1.0"
__all__ = ["apply_conf", "build_session", "BLINKIT", "INSTAMART", "ZEPTO", "PlatformSpec",
           "platform", "DateWindow"]
