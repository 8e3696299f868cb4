"""DataFrame -> DataFrame operators (usable with ``df.transform``)."""

from epistand.operators.cells import count_cells, null_safe_join, with_denominators
from epistand.operators.charts import chart_data, label_from_keys, project_chart
from epistand.operators.counts import counts_with_total
from epistand.operators.extract import (death_events, first_per_patient_year, select_codes,
                                        select_window, stack_episodes, stay_flags, stay_rollup, valid_sex)
from epistand.operators.incidence import incident_events
from epistand.operators.population import area_population_long, population_cells
from epistand.operators.residency import resident_by_country, resident_by_lookup, treated_in_board
from epistand.operators.standardise import (collapse_bands, pooled_both_sexes, rates_within_bands,
                                            standardised_rates)

__all__ = [
    "count_cells", "null_safe_join", "with_denominators", "chart_data", "label_from_keys",
    "project_chart", "counts_with_total", "death_events", "first_per_patient_year", "select_codes",
    "select_window", "stack_episodes", "stay_flags", "stay_rollup", "valid_sex", "incident_events",
    "area_population_long", "population_cells", "resident_by_country", "resident_by_lookup",
    "treated_in_board", "collapse_bands", "pooled_both_sexes", "rates_within_bands",
    "standardised_rates",
]
