"""Values that results depend on."""

# Table names under the output root.
STAGE_ARRIVALS = "stage_i94_immigration"
STAGE_TEMPERATURES = "stage_city_temperatures"
DIM_COUNTRIES = "dim_countries"
DIM_TRAVEL_MODES = "dim_travel_modes"
DIM_VISAS = "dim_us_visas"
DIM_PORTS = "dim_us_ports"
DIM_DATE = "dim_date"
FACT_VISITS = "fact_i94_visits"

# Tables about what the dimensions and the fact leave out.
REJECTED_PORTS = "rejected_us_ports"
PORT_COVERAGE = "port_coverage"
QUARANTINED = "quarantined_rows"

# Tables kept beside the fact: which keys a month has, and sums by date and port.
KEY_SUMMARIES = "key_summaries"
PORT_TOTALS = "port_totals"

# Columns of the visits fact, in order.
VISIT_COLUMNS = [
    "cicid", "arrdate", "depdate", "stay", "i94port",
    "i94cit", "i94mode", "i94visa", "visatype", "avgtemperature",
]

# Arrivals without one of these are not staged.
REQUIRED_COLUMNS = ["depdate", "i94mode", "matflag"]

# Markers of unusable lookup entries, and the names they get.
JUNK_COUNTRIES = ["No Country", "INVALID", "Collapsed"]
OTHER_COUNTRIES = "Other countries"
JUNK_PORTS = ["No PORT Code", "Collapsed"]
OTHER_PORTS = "Other US ports"

# Fixed value: day 0 of the arrival and departure serials.
SERIAL_EPOCH = "1960-01-01"
