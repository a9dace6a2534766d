"""Writes landing and census fixtures in the shapes the reference consumes."""

from __future__ import annotations

import os
import random

from paneltide.sources.census import SURVEY_VARIABLES
from paneltide.sources.landing import CRIME_TYPES

BOM = "﻿"
YEARS = list(range(2014, 2025))
MONTHS = [f"{m:02d}-{y}" for y in YEARS for m in range(1, 13)]

# (ori, series name, county, GEOID, types)
AGENCIES = [
    ("MN0010000", "Aitkin", "AITKIN", "27001", CRIME_TYPES),
    ("MN0240000", "Alden", "FREEBORN", "27047", CRIME_TYPES),
    ("MN0240200", "Alden", "FREEBORN", "27047", CRIME_TYPES),     # same series name (Q4)
    ("MN0640400", "Lamberton", "REDWOOD", "27127", ["arson", "burglary", "larceny"]),
    ("MN0620900", "St Paul", "RAMSEY", "27123", CRIME_TYPES),
    ("MNMHP0100", "Highway Patrol", "RAMSEY", "27123", CRIME_TYPES),
]
OFFICER_ONLY = ["MN0601300", "MNDI00500"]


def _cell(rng, blank_p=0.1):
    return "" if rng.random() < blank_p else str(rng.randint(0, 9))


def write_landing(d: str, seed: int = 7) -> dict:
    rng = random.Random(seed)
    os.makedirs(d, exist_ok=True)
    header = BOM + "series," + ",".join(f'"{m}"' for m in MONTHS)
    n_crime = 0
    for ori, series, _c, _g, types in AGENCIES:
        for t in types:
            row = [series] + [_cell(rng) for _ in MONTHS]
            clear = [f"{series} Clearances"] + [_cell(rng) for _ in MONTHS]
            lines = [header, ",".join(row), ",".join(clear)]
            if t == "homicides" and ori == "MN0010000":       # junk trailer (Q8)
                lines[-1] = lines[-1][: lines[-1].rfind(",")] + ",_homicides"
                lines += ["_homicides ", "_homicides ", "_homicides 1 "]
            with open(os.path.join(d, f"{ori}_{t}.csv"), "w", encoding="utf-8") as f:
                f.write("\n".join(lines) + "\n")
            n_crime += 1
    oyears = list(range(2014, 2026))
    oheader = BOM + "series," + ",".join(f'"{y}"' for y in oyears)
    for ori in [a[0] for a in AGENCIES] + OFFICER_ONLY:
        if ori == "MN0601300":
            vals = [""] * len(oyears)                           # all blank
        else:
            vals = [f"{rng.uniform(0.5, 4):.2f}" for _ in oyears[:-1]] + [""]
            vals[2] = "0"                                       # 0 means missing
        with open(os.path.join(d, f"{ori}_officers.csv"), "w", encoding="utf-8") as f:
            f.write(oheader + "\nOfficers per 1000 People," + ",".join(vals) + "\n")
    return {"crime_files": n_crime, "months": len(MONTHS)}


def write_census(d: str, seed: int = 11) -> None:
    rng = random.Random(seed)
    counties = sorted({(a[3], a[2]) for a in AGENCIES})
    for sub in ("acs1", "acs5", "decennial", "mapping", "attributes", "rings"):
        os.makedirs(os.path.join(d, sub), exist_ok=True)

    def survey_rows(years, geoids):
        out = []
        for g in geoids:
            for y in years:
                pop = rng.randint(20000, 900000)
                for name, code in SURVEY_VARIABLES:
                    val = pop if name == "total_population" else rng.randint(100, pop // 3)
                    out.append(f"{g},{code},{val},{y}")
        return out

    all_g = [g for g, _ in counties]
    acs1_g = [g for g in all_g if g != "27127"]                 # one county not in acs1
    acs1_years = [y for y in range(2008, 2025) if y != 2020]
    with open(os.path.join(d, "acs1", "part.csv"), "w") as f:
        f.write("GEOID,variable,estimate,year\n" + "\n".join(survey_rows(acs1_years, acs1_g)) + "\n")
    with open(os.path.join(d, "acs5", "part.csv"), "w") as f:
        f.write("GEOID,variable,estimate,year\n" + "\n".join(survey_rows([2018, 2023], all_g)) + "\n")
    with open(os.path.join(d, "decennial", "part.csv"), "w") as f:
        f.write("GEOID,variable,value,year\n" +
                "\n".join(f"{g},P1_001N,{rng.randint(20000, 900000)},2020" for g in all_g) + "\n")
    with open(os.path.join(d, "mapping", "part.csv"), "w") as f:
        f.write("ori,GEOID,county,type\n" +
                "\n".join(f"{a[0]},{a[3]},{a[2]},{'city' if i % 2 else 'county'}"
                          for i, a in enumerate(AGENCIES)) + "\n")
    with open(os.path.join(d, "attributes", "part.csv"), "w") as f:
        f.write("Location,Binge drinking prevalence,Cost per person,Total cost,Productivity loss costs,"
                "Other societal costs,Health care costs\n")
        f.write("State total,19.0,1111,9000,5000,3000,1000\n")
        for _g, c in counties:
            f.write(f"{c.title()},{rng.uniform(15, 25):.1f},{rng.randint(900, 1500)},1000,500,300,200\n")
    with open(os.path.join(d, "rings", "part.csv"), "w") as f:
        f.write("GEOID,ring_id,seq,lon,lat\n")
        for i, g in enumerate(all_g):
            lon0, lat0 = -96.0 + i * 0.5, 44.0 + i * 0.3
            for s, (x, y) in enumerate([(0, 0), (0.4, 0), (0.4, 0.3), (0, 0.3)]):
                f.write(f"{g},0,{s},{lon0 + x},{lat0 + y}\n")
