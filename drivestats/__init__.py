"""drivestats: hourly, daily and monthly driving statistics on Spark.

Main entry points::

    from drivestats import build_stats, run, HOURLY, DAILY, MONTHLY, MONTHLY_CALENDAR
"""

from drivestats.plans.grains import DAILY, GRAINS, HOURLY, MONTHLY, MONTHLY_CALENDAR, Grain
from drivestats.plans.job import RunResult, run
from drivestats.plans.stats import build_stats

__all__ = ["DAILY", "GRAINS", "HOURLY", "MONTHLY", "MONTHLY_CALENDAR", "Grain", "RunResult", "build_stats", "run"]
