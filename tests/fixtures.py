"""Small hand-written inputs that hold every edge case, as files of a landing folder."""

from pathlib import Path

from landfall.plans.warehouse import Inputs

COUNTRIES = (
    "582 =  'FREEDONIA Air, Sea (A-1, no land)'\r\n"
    " 0  =  'INVALID: NOWHERE'\r\n"
    " 54 =  'No Country Code (54)'\r\n"
    "311 =  'Collapsed Sylvania (should not show)' \r\n"
    "687 =  'ZEMBLA '\r\n"
    "\r\n"
    "717 =  'RURITANIA'  "
)
TRAVEL_MODES = "1 = 'Air'\n2 = 'Sea'\n9 = 'Not reported'"
VISAS = "1 = Business\n2 = Pleasure"
STATES = "\t'AL'='ALABAMA'\n\t'ST'='STATE OF T' \n\t'NP'='NO PORTS'\n\t'99'='All Other Codes'"
PORTS = "\n".join([
    "   'ABC'\t=\t'CITY, ST        '",
    "   'DEF'\t=\t'CITY,ST'",
    "   'INX'\t=\t'IN''L FALLS, ST      '",
    "   'MOB'\t=\t'MOBILE, AL            '           ",
    "   'NOT'\t=\t'UNMEASURED, AL'",
    "   'GHI'\t=\t'GROVE, ST (XYZ)'",
    "   'JKL'\t=\t'A, B, ST'",
    "   'MNO'\t=\t'MEADOW ST'",
    "   'FOR'\t=\t'FARAWAY, FREEDONIA'",
    "   'PQR'\t=\t'No PORT Code (PQR)'",
    "   'STU' \t=\t'Collapsed (X) 06/15'",
    "   'VWX'\t=\t'Collapsed into Y, ST'",
    "   'AB '\t=\t'No PORT Code (AB)'",
])

# cicid, i94cit, i94port, arrdate, i94mode, depdate, i94visa, visatype, matflag
ARRIVALS = [
    (1.0, 582.0, "ABC", 20545.0, 1.0, 20550.5, 2.0, "B2", "M"),
    (1.0, 582.0, "ABC", 20545.0, 1.0, 20550.5, 2.0, "B2", "M"),  # exact copy
    (2.0, 717.0, "DEF", 20546.5, 2.0, 20540.2, 1.0, "B1", "M"),  # fraction, leaves earlier
    (3.0, 717.0, "INX", 20545.0, 1.0, 20545.0, 1.0, "B1", "M"),  # doubled quote in the place
    (4.0, 717.0, "MOB", 20547.0, 1.0, 20549.0, 1.0, "B1", "M"),
    (5.0, 717.0, "NOT", 20545.0, 1.0, 20549.0, 1.0, "B1", "M"),  # no temperature
    (6.0, 717.0, "GHI", 20545.0, 1.0, 20549.0, 1.0, "B1", "M"),  # known port outside the dim
    (7.0, 717.0, "ABC", None, 1.0, 20549.0, 1.0, "B1", "M"),  # no arrival date
    (8.0, 717.0, "ABC", 20700.0, 1.0, 20749.0, 1.0, "B1", "M"),  # another month
    (10.0, 717.0, "???", 20545.0, 1.0, 20549.0, 1.0, "B1", "M"),  # from here on not staged
    (11.0, 717.0, "PQR", 20545.0, 1.0, 20549.0, 1.0, "B1", "M"),
    (12.0, 717.0, "VWX", 20545.0, 1.0, 20549.0, 1.0, "B1", "M"),
    (13.0, 717.0, "ABC", 20545.0, 1.0, None, 1.0, "B1", "M"),
    (14.0, 717.0, "ABC", 20545.0, None, 20549.0, 1.0, "B1", "M"),
    (15.0, 717.0, "ABC", 20545.0, 1.0, 20549.0, 1.0, "B1", None),
    (16.0, 717.0, "ABC", 20545.0, 1.0, float("nan"), 1.0, "B1", "M"),
    (17.0, 717.0, None, 20545.0, 1.0, 20549.0, 1.0, "B1", "M"),
]
ARRIVAL_SCHEMA = (
    "cicid double, i94cit double, i94port string, arrdate double, i94mode double, "
    "depdate double, i94visa double, visatype string, matflag string"
)

TEMPERATURES = """Region,Country,State,City,Month,Day,Year,AvgTemperature
North,US,State of T,City,4,1,2016,50.5
North,US,State of T,City,4,2,2016,51.25
North,US,State of T,Inl Falls,4,1,2016,30.0
North,US,Alabama,Mobile,4,3,2016,70.5
North,US,Alabama,MOBILE,4,3,2016,70.5
North,US,State of T,City,5,1,2016,99.0
North,US,State of T,City,4,1,2015,99.0
South,XX,State of T,City,4,1,2016,99.0
"""


def land(spark, folder: Path, arrivals=ARRIVALS, temperatures=TEMPERATURES) -> Inputs:
    folder.mkdir(parents=True)
    texts = {
        "countries": COUNTRIES, "travel_modes": TRAVEL_MODES, "visas": VISAS,
        "states": STATES, "ports": PORTS, "temperatures": temperatures,
    }
    for name, text in texts.items():
        (folder / name).write_bytes(text.encode())
    spark.createDataFrame(arrivals, ARRIVAL_SCHEMA).write.parquet(str(folder / "arrivals"))
    paths = {name: str(folder / name) for name in texts}
    return Inputs(arrivals=str(folder / "arrivals"), **paths)


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]
