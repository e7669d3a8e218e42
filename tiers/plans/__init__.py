"""Layer plans: bronze, silver, gold, dashboard, preflight, and the pipeline runner."""

from tiers.plans import dashboard, gold, silver
from tiers.plans.bronze import bronze
from tiers.plans.pipeline import RunReport, bootstrap, run
from tiers.plans.preflight import PreflightError, preflight_report, require

__all__ = ["dashboard", "gold", "silver", "bronze", "RunReport", "bootstrap", "run", "PreflightError",
           "preflight_report", "require"]
