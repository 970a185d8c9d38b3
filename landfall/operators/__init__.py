"""DataFrame to DataFrame operators; none reads, writes or starts a job."""

from landfall.operators.dimensions import (
    code_list,
    date_dim,
    known_ports,
    malformed_lines,
    port_places,
    port_rejects,
    ports_dim,
    state_names,
    well_formed_port,
)
from landfall.operators.keys import cells_for, folded, met_cells, merged, summarise_keys, suspects
from landfall.operators.merging import latest, replaced
from landfall.operators.quarantine import quarantined, reason
from landfall.operators.rankings import port_totals, rank_totals, visits_by
from landfall.operators.staging import (
    distinct_where_repeated,
    keep_arrivals,
    keep_listed,
    keep_present,
    repeated_values,
    stage_arrivals,
    stage_temperatures,
)
from landfall.operators.visits import build_visits, port_coverage

__all__ = [
    "build_visits", "cells_for", "code_list", "date_dim", "distinct_where_repeated", "folded", "keep_arrivals",
    "keep_listed", "keep_present", "known_ports", "latest", "malformed_lines", "merged", "met_cells", "port_coverage",
    "port_places", "port_rejects", "port_totals", "ports_dim", "quarantined", "rank_totals", "reason", "repeated_values",
    "replaced", "stage_arrivals", "stage_temperatures", "state_names", "summarise_keys", "suspects", "visits_by",
    "well_formed_port",
]
