"""sylva: forest-carbon table operators on Spark DataFrames.

Cohorts are collapsed into groups, yearly disturbance events are resolved to one per
stand, disturbed cohorts are split into new groups, growth is looked up by curve and
age, pool transfers are applied from proportion tables, and emissions, products, NPP
and stocks are reported by year and stand.  Everything is DataFrame / Spark SQL work.
"""

from sylva.session import get_session, shared_dir

__all__ = ["get_session", "shared_dir"]
