"""periodlens: period-impact analytics as Spark DataFrame plans.

Observations (hourly counts per unit) are mapped to areas, labelled with a
calendar period phase and rolled up to facts; reports compare the phases.

Main entry points::

    from periodlens import configure, population_fact, ridership_fact, REPORTS
    configure(spark)
    pop = population_fact(observations, units, calendar)
    REPORTS["young_population_lift"].build(pop, ridership)
"""

from .operators.facts import Measure, population_fact, ridership_fact, rollup_fact
from .operators.joins import join_dimension
from .operators.metrics import did, group_phase_avg, phase_avg, ranked, with_zscores
from .operators.periods import expand_calendar, label_periods, overlapping_periods
from .plans.reports import REPORTS, run_report
from .session import configure

__version__ = "0.1.0"

__all__ = [
    "Measure", "REPORTS", "configure", "did", "expand_calendar", "group_phase_avg", "join_dimension",
    "label_periods", "overlapping_periods", "phase_avg", "population_fact", "ranked", "ridership_fact",
    "rollup_fact", "run_report", "with_zscores",
]
